"""Projections, predicates, casts, reshaping and set logic."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import frame as ops
from pressbeat.operators import traffic
from pressbeat.functions.aggregates import row_count
from pressbeat.plans.base import query
from pressbeat.storage import materialize

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("proj_exprs", """
SELECT post_id, views + likes AS total, views * 2 AS doubled, CAST(year(publish_date) AS INTEGER) AS y, upper(category) AS cat FROM posts""", "posts")
def _(t):
    wide = t.posts.selectExpr("post_id", "views + likes AS total", "views * 2 AS doubled", "year(publish_date) AS y", "upper(category) AS cat", "status")
    return wide.drop("status")


@query("proj_rename", "SELECT post_id AS P_ID, views AS P_HITS, category AS P_CATEGORY FROM posts", "posts")
def _(t):
    renamed = ops.rename(t.posts.select("post_id", "views", "category"), {"post_id": "id", "views": "hits"})
    return ops.upper_names(ops.add_prefix(renamed, "p_"))


@query("proj_alias_join", """
SELECT a.category, b.status, count(*) AS n FROM posts a JOIN posts b ON a.post_id = b.post_id GROUP BY ALL""", "posts")
def _(t):
    a, b = t.posts.alias("a"), t.posts.alias("b")
    joined = a.join(b, F.col("a.post_id") == F.col("b.post_id"))
    return joined.groupBy(F.col("a.category").alias("category"), F.col("b.status").alias("status")).agg(row_count().alias("n"))


@query("filt_bool", "SELECT post_id, views, likes FROM posts WHERE (views > 3000 AND likes > 200 OR status = 'draft') AND NOT category = '5-LOW'", "posts")
def _(t):
    rule = ((F.col("views") > 3000) & (F.col("likes") > 200) | (F.col("status") == "draft")) & ~(F.col("category") == "5-LOW")
    return t.posts.filter(rule).select("post_id", "views", "likes")


@query("filt_pattern", """
SELECT post_id, title FROM articles WHERE title LIKE '%ring%' OR contains(title, 'bolt') OR starts_with(title, 'red')
 OR ends_with(title, 'gear') OR regexp_matches(title, '^b.*t$')""", "articles")
def _(t):
    c = F.col("title")
    rule = c.like("%ring%") | c.contains("bolt") | c.startswith("red") | c.endswith("gear") | c.rlike("^b.*t$")
    return t.articles.filter(rule).select("post_id", "title")


@query("filt_in_between", """
SELECT log_id, action FROM logs WHERE action IN ('view', 'like') AND duration BETWEEN 5 AND 20 AND user_id IS NOT NULL AND NOT (ip IS NULL)""", "logs")
def _(t):
    rule = F.col("action").isin("view", "like") & F.col("duration").between(5, 20) & F.col("user_id").isNotNull() & ~F.col("ip").isNull()
    return t.logs.filter(rule).select("log_id", "action")


@query("cond_clip", """
SELECT log_id, greatest(5::DOUBLE, least(50::DOUBLE, duration)) AS clipped, CASE WHEN duration > 10 THEN duration END AS kept,
       CASE WHEN duration > 10 THEN -1::DOUBLE ELSE duration END AS masked FROM logs""", "logs")
def _(t):
    d = F.col("duration")
    return t.logs.select(
        "log_id", ops.clip(d, 5.0, 50.0).alias("clipped"), ops.keep_where(d, d > 10).alias("kept"), ops.keep_where(d, ~(d > 10), -1.0).alias("masked")
    )


@query("map_values", """
SELECT label, count(*) AS n FROM (SELECT CASE action WHEN 'view' THEN 'read' WHEN 'like' THEN 'liked' END AS label FROM logs) GROUP BY label""", "logs")
def _(t):
    return ops.map_values(t.logs, "action", {"view": "read", "like": "liked"}, "label").groupBy("label").agg(row_count().alias("n"))


@query("eval_expr", """
SELECT post_id, likes::DOUBLE / nullif(views, 0) AS ratio, likes::DOUBLE / nullif(views, 0) * 100 AS pct FROM posts""", "posts")
def _(t):
    return ops.eval_columns(t.posts, ["ratio = try_divide(cast(likes as double), views)", "pct = ratio * 100"]).select("post_id", "ratio", "pct")


@query("cast_safe", """
SELECT post_id, TRY_CAST(category AS BIGINT) AS n, TRY_CAST(substr(category, 1, 1) AS BIGINT) AS level,
       CAST(publish_date AS DATE) AS d, CAST(NULL AS TIMESTAMP) AS ts FROM posts""", "posts")
def _(t):
    staged = t.posts.withColumns({"first": F.substring("category", 1, 1), "day": F.col("publish_date").cast("string")})
    return staged.select(
        "post_id", ops.safe_cast("category", "bigint").alias("n"), ops.safe_cast("first", "bigint").alias("level"),
        ops.safe_cast("day", "date", "yyyy-MM-dd").alias("d"),
        ops.safe_cast("day", "timestamp", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("ts"),
    )


@query("sample_n")
def _(t):
    return ops.sample_rows(t.logs, 100, "log_id", 42)


@query("sample_fraction")
def _(t):
    return ops.sample_fraction(t.logs, 0.1, 42)


@query("pipe_chain", """
SELECT category, count(*) AS n, CAST(sum(views + likes * 5) AS BIGINT) AS score FROM posts WHERE status = 'published' GROUP BY category""", "posts")
def _(t):
    return ops.pipe(
        t.posts,
        lambda df: df.filter(F.col("status") == "published"),
        lambda df: df.withColumn("score", F.col("views") + F.col("likes") * 5),
        lambda df: df.groupBy("category").agg(row_count().alias("n"), F.sum("score").alias("score")),
    )


@query("set_union_all", "SELECT src, count(*) AS n, count(author) AS authors FROM (SELECT 'p' AS src, author FROM posts UNION ALL SELECT 'l', NULL FROM logs) GROUP BY src", "posts", "logs")
def _(t):
    both = ops.union_all(t.posts.select(F.lit("p").alias("src"), "author"), t.logs.select(F.lit("l").alias("src")))
    return both.groupBy("src").agg(row_count().alias("n"), F.count("author").alias("authors"))


@query("set_union", "SELECT post_id FROM logs WHERE action = 'view' UNION SELECT post_id FROM logs WHERE action = 'like'", "logs")
def _(t):
    by_action = ops.split_by(t.logs.select("action", "post_id"), "action", ["view", "like"])
    return ops.union_distinct(by_action["view"].select("post_id"), by_action["like"].select("post_id"))


@query("concat_columns", """
SELECT post_id, views, c_name FROM (SELECT *, row_number() OVER (ORDER BY post_id) AS pos FROM posts) p
FULL JOIN (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer) c USING (pos)""", "posts")
def _(t):
    names = t.raw("customer").select("c_custkey", "c_name")
    return ops.concat_columns(t.posts.select("post_id", "views"), names, ["post_id"], ["c_custkey"]).drop("c_custkey")


MEMBERS = "(SELECT DISTINCT user_id FROM logs WHERE action = '{}' AND user_id IS NOT NULL AND event_date = DATE '2024-01-0{}')"


def members(t, action, day):
    rule = (F.col("action") == action) & F.col("user_id").isNotNull() & (F.col("event_date") == F.lit(f"2024-01-0{day}").cast("date"))
    return t.logs.filter(rule).select("user_id")


@query("set_intersect", f"SELECT user_id FROM {MEMBERS.format('view', 2)} INTERSECT SELECT user_id FROM {MEMBERS.format('like', 3)}", "logs")
def _(t):
    return ops.intersect(members(t, "view", 2), members(t, "like", 3))


@query("set_except", f"SELECT user_id FROM {MEMBERS.format('view', 2)} EXCEPT SELECT user_id FROM {MEMBERS.format('like', 3)}", "logs")
def _(t):
    return ops.subtract(members(t, "view", 2), members(t, "like", 3))


@query("array_set_ops", """
SELECT post_id, array_to_string(list_sort(list_intersect(a, b)), ',') AS both, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS any_of,
       array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS only_a
FROM (SELECT post_id, string_split(title, ' ') AS a, [lower(category), 'ring', 'red', 'bolt'] AS b FROM articles)""", "articles")
def _(t):
    sets = t.articles.select("post_id", F.split("title", " ").alias("a"), F.array(F.lower("category"), F.lit("ring"), F.lit("red"), F.lit("bolt")).alias("b"))
    return sets.select(
        "post_id", *[
            F.array_join(F.array_sort(op("a", "b")), ",").alias(name)
            for name, op in (("both", F.array_intersect), ("any_of", F.array_union), ("only_a", F.array_except))
        ],
    )


@query("reshape_melt", """
SELECT post_id, variable, value FROM (SELECT post_id, views, likes, comments FROM posts) UNPIVOT (value FOR variable IN (views, likes, comments))""", "posts")
def _(t):
    return ops.melt(t.posts, ["post_id"], ["views", "likes", "comments"])


@query("reshape_pivot", """
SELECT event_date, max(n) FILTER (action = 'view') AS "view", max(n) FILTER (action = 'like') AS "like", max(n) FILTER (action = 'comment') AS "comment"
FROM (SELECT event_date, action, count(*) AS n FROM logs GROUP BY ALL) GROUP BY event_date""", "logs")
def _(t):
    long = t.logs.groupBy("event_date", "action").agg(row_count().alias("n"))
    return long.groupBy("event_date").pivot("action", ["view", "like", "comment"]).agg(F.first("n"))


@query("one_hot", """
SELECT post_id, """ + ", ".join(f"""CAST(category = '{p}' AS INTEGER) AS "cat_{p}" """ for p in PRIORITIES) + ", 0 AS cat_rest FROM posts", "posts")
def _(t):
    return ops.one_hot(t.posts.select("post_id", "category"), "category", "cat").drop("category")


@query("split_by_type", "SELECT action, count(*) AS n, count(DISTINCT post_id) AS posts FROM logs WHERE action IN ('view', 'comment') GROUP BY action", "logs")
def _(t):
    parts = ops.split_by(t.logs.select("action", "post_id"), "action", ["view", "comment"])
    counted = [part.groupBy("action").agg(row_count().alias("n"), F.count_distinct("post_id").alias("posts")) for part in parts.values()]
    return counted[0].union(counted[1])


@query("join_cross", """
SELECT s.status, c.category, count(p.post_id) AS n FROM (SELECT DISTINCT status FROM posts) s CROSS JOIN (SELECT DISTINCT category FROM posts) c
LEFT JOIN posts p ON p.status = s.status AND p.category = c.category GROUP BY ALL""", "posts")
def _(t):
    cells = ops.grid(t.posts, "status", "category")
    counts = t.posts.groupBy("status", "category").agg(row_count().alias("n"))
    return cells.join(counts, ["status", "category"], "left").fillna(0, ["n"])


@query("cache_reuse", """
SELECT 'published' AS status, count(*) AS n, max(views) AS top FROM posts WHERE status = 'published'
UNION ALL SELECT 'draft', count(*), max(views) FROM posts WHERE status = 'draft'""", "posts")
def _(t):
    shared = materialize(t.posts.select("status", "views"), "reused")
    parts = [shared.filter(F.col("status") == s).groupBy("status").agg(row_count().alias("n"), F.max("views").alias("top")) for s in ("published", "draft")]
    return parts[0].union(parts[1])


@query("foreach_partition", "SELECT count(*) AS n, TRUE AS all_visited FROM logs", "logs")
def _(t):
    context = t.spark.sparkContext
    rows = context.accumulator(0)

    def visit(partition):
        for _row in partition:
            rows.add(1)

    t.logs.select("log_id").foreachPartition(visit)
    # a retried task adds its rows again, so the accumulator may exceed the count but not fall short
    return t.logs.agg(row_count().alias("n")).withColumn("all_visited", F.lit(rows.value) >= F.col("n"))


@query("share_by_city_filter", """
SELECT city, count(*) AS n FROM logs l JOIN users u ON l.user_id = u.user_id WHERE balance > 0 GROUP BY city""", "logs", "users")
def _(t):
    per_user = t.logs.groupBy("user_id").agg(row_count().alias("n"))
    return traffic.with_city(per_user, t.users.filter("balance > 0")).groupBy("city").agg(F.sum("n").alias("n"))
