"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import frame
from pressbeat.operators import joins as ops
from pressbeat.functions.aggregates import row_count
from pressbeat.plans.base import query



@query("join_inner", "SELECT l.log_id, l.action, a.title FROM logs l JOIN articles a ON l.post_id = a.post_id", "logs", "articles")
def _(t):
    joined = ops.dimension_join(t.logs.select("log_id", "action", "post_id"), t.articles.select("post_id", "title"), "post_id")
    return joined.select("log_id", "action", "title")


@query("join_left", "SELECT u.user_id, u.city, count(l.log_id) AS n FROM users u LEFT JOIN logs l ON u.user_id = l.user_id GROUP BY ALL", "logs", "users")
def _(t):
    seen = t.logs.groupBy("user_id").agg(row_count().alias("n"))
    return t.users.select("user_id", "city").join(seen, "user_id", "left").fillna(0, ["n"])


@query("join_full", """
SELECT coalesce(a.author, p.author) AS author, a.articles, p.posts
FROM (SELECT 'author_' || replace(author, 'Brand#', '') AS author, count(*) AS articles FROM articles GROUP BY 1) a
FULL JOIN (SELECT author, count(*) AS posts FROM posts GROUP BY 1) p ON a.author = p.author""", "articles", "posts")
def _(t):
    name = F.concat(F.lit("author_"), F.replace(F.col("author"), F.lit("Brand#"), F.lit("")))
    articles = t.articles.groupBy(name.alias("author")).agg(row_count().alias("articles"))
    return articles.join(t.posts.groupBy("author").agg(row_count().alias("posts")), "author", "full")


@query("join_diff_keys", """
SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def _(t):
    orders, customer = t.raw("orders"), t.raw("customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.groupBy("c_mktsegment", "o_orderstatus").agg(row_count().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


NEEDLES = "(SELECT DISTINCT substr(c_mktsegment, 1, 2) AS needle FROM customer UNION SELECT DISTINCT trim(unnest(string_split(tags, ','))) FROM articles)"


def needles(t):
    segments = t.raw("customer").select(F.substring("c_mktsegment", 1, 2).alias("needle"))
    tags = t.articles.select(F.explode(F.split("tags", " *, *")).alias("needle"))
    return segments.union(tags).distinct()


@query("join_contains", f"SELECT post_id, needle FROM articles JOIN {NEEDLES} ON contains(upper(title) || title, needle)", "articles")
def _(t):
    texts = t.articles.select("post_id", F.concat(F.upper("title"), "title").alias("text"))
    return ops.contains_join(texts, "text", needles(t), "needle", "post_id").select("post_id", "needle")


@query("join_contains_left", """
SELECT post_id, needle FROM articles LEFT JOIN (SELECT DISTINCT lower(p_type) AS needle FROM part) ON contains(title, needle)""", "articles")
def _(t):
    types = t.raw("part").select(F.lower("p_type").alias("needle")).distinct()
    return ops.contains_join(t.articles.select("post_id", "title"), "title", types, "needle", "post_id", "left").select("post_id", "needle")


@query("combine_first", """
SELECT coalesce(a.post_id, b.post_id) AS post_id, coalesce(a.views, b.views) AS views, coalesce(a.likes, b.likes) AS likes
FROM (SELECT post_id, nullif(views, 900) AS views, likes FROM articles WHERE category <> 'SMALL') a
FULL JOIN (SELECT post_id, views, likes FROM posts WHERE status = 'draft') b USING (post_id)""", "articles", "posts")
def _(t):
    left = t.articles.filter("category <> 'SMALL'").select("post_id", F.expr("nullif(views, 900)").alias("views"), "likes")
    return ops.combine_first(left, t.posts.filter("status = 'draft'").select("post_id", "views", "likes"), ["post_id"])


@query("join_semi", "SELECT user_id, city FROM users WHERE user_id IN (SELECT user_id FROM logs WHERE action = 'like' AND user_id IS NOT NULL)", "logs", "users")
def _(t):
    return frame.members(t.users.select("user_id", "city"), t.logs.filter("action = 'like'"), ["user_id"])


@query("join_anti", "SELECT user_id, city FROM users WHERE user_id NOT IN (SELECT user_id FROM logs WHERE user_id IS NOT NULL)", "logs", "users")
def _(t):
    return frame.non_members(t.users.select("user_id", "city"), t.logs, ["user_id"])
