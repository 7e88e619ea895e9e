"""Cleaning, filling, deduplication and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import clean as ops
from pressbeat.functions.aggregates import row_count
from pressbeat.plans.base import query

# the stored tables hold no NULLs, so some are put in on both sides
GAPPY = "(SELECT log_id, post_id, user_id, event_date, event_time, nullif(action, 'search') AS action, CASE WHEN duration >= 5 THEN duration END AS duration FROM logs)"


def gappy(t):
    return t.logs.select(
        "log_id", "post_id", "user_id", "event_date", "event_time", F.expr("nullif(action, 'search')").alias("action"),
        F.when(F.col("duration") >= 5, F.col("duration")).alias("duration"),
    )


@query("missing_stats", f"""
SELECT s.c AS "column", n - s.k AS missing, round((n - s.k)::DOUBLE / n, 9) AS ratio FROM (
 SELECT count(*) AS n, unnest([{{'c': 'user_id', 'k': count(user_id)}}, {{'c': 'action', 'k': count(action)}},
   {{'c': 'duration', 'k': count(duration)}}, {{'c': 'post_id', 'k': count(post_id)}}]) AS s FROM {GAPPY})""", "logs")
def _(t):
    return ops.missing_stats(gappy(t).select("user_id", "action", "duration", "post_id"))


@query("dropna_variants", f"""
SELECT count(*) FILTER (user_id IS NOT NULL AND action IS NOT NULL AND duration IS NOT NULL) AS any_missing,
 count(*) FILTER (user_id IS NOT NULL OR action IS NOT NULL OR duration IS NOT NULL) AS all_missing,
 count(*) FILTER ((user_id IS NOT NULL)::INT + (action IS NOT NULL)::INT + (duration IS NOT NULL)::INT >= 2) AS two_present,
 count(action) AS has_action FROM {GAPPY}""", "logs")
def _(t):
    df = gappy(t).select("user_id", "action", "duration")
    kept = {"any_missing": df.dropna("any"), "all_missing": df.dropna("all"), "two_present": df.dropna(thresh=2), "has_action": df.dropna(subset=["action"])}
    counts = {name: frame.agg(row_count()).scalar() for name, frame in kept.items()}
    return df.agg(row_count().alias("n")).select(*[c.alias(name) for name, c in counts.items()])


@query("fill_const", f"SELECT log_id, coalesce(action, 'unknown') AS action, coalesce(duration, 0) AS duration FROM {GAPPY}", "logs")
def _(t):
    return gappy(t).select("log_id", "action", "duration").fillna({"action": "unknown", "duration": 0.0})


@query("fill_mean", f"SELECT log_id, round(coalesce(duration, (SELECT avg(duration) FROM {GAPPY})), 6) AS duration FROM {GAPPY}", "logs")
def _(t):
    return ops.fill_mean(gappy(t).select("log_id", "duration"), "duration").withColumn("duration", F.round("duration", 6))


@query("fill_forward", f"""
SELECT log_id, last_value(duration IGNORE NULLS) OVER (PARTITION BY post_id ORDER BY event_time, log_id ROWS UNBOUNDED PRECEDING) AS duration FROM {GAPPY}""", "logs")
def _(t):
    df = gappy(t).select("log_id", "post_id", "event_time", "duration")
    return ops.forward_fill(df, "duration", ["event_time", "log_id"], ["post_id"]).select("log_id", "duration")


@query("fill_linear", f"""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY log_id) AS i FROM {GAPPY}),
sides AS (SELECT *, last_value(duration IGNORE NULLS) OVER b AS lo, max(CASE WHEN duration IS NOT NULL THEN i END) OVER b AS lo_i,
  first_value(duration IGNORE NULLS) OVER f AS hi, min(CASE WHEN duration IS NOT NULL THEN i END) OVER f AS hi_i
 FROM numbered WINDOW b AS (ORDER BY i ROWS UNBOUNDED PRECEDING), f AS (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT log_id, round(CASE WHEN duration IS NOT NULL THEN duration WHEN hi IS NULL THEN lo
  WHEN lo IS NOT NULL THEN lo + (hi - lo) / (hi_i - lo_i) * (i - lo_i) END, 6) AS duration FROM sides""", "logs")
def _(t):
    done = ops.interpolate(gappy(t).select("log_id", "duration"), "duration", ["log_id"])
    return done.withColumn("duration", F.round("duration", 6))


@query("replace_values", """
SELECT status, category, count(*) AS n, count(*) FILTER (likes = -1) AS marked FROM (
 SELECT CASE status WHEN 'draft' THEN 'unpublished' ELSE status END AS status,
  CASE category WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' ELSE category END AS category,
  CASE likes WHEN 0 THEN -1 ELSE likes END AS likes FROM posts) GROUP BY ALL""", "posts")
def _(t):
    df = t.posts.replace("draft", "unpublished", ["status"]).replace(["1-URGENT", "2-HIGH"], "top", ["category"]).replace(0, -1, ["likes"])
    return df.groupBy("status", "category").agg(row_count().alias("n"), F.count_if(F.col("likes") == -1).alias("marked"))


@query("distinct_cols", "SELECT DISTINCT action, device, post_id FROM logs", "logs")
def _(t):
    return t.logs.select("action", "device", "post_id").distinct()


@query("distinct_rows", "SELECT count(*) AS n FROM (SELECT DISTINCT text, lang FROM documents)")
def _(t):
    # whole rows are compared by digest, so the texts themselves are not shuffled
    return t.docs.select(ops.row_digest("text", "lang").alias("digest")).distinct().agg(row_count().alias("n"))


@query("dedup_first", """
SELECT user_id, post_id, log_id, action FROM (SELECT *, row_number() OVER (PARTITION BY user_id, post_id ORDER BY event_time, log_id) AS r FROM logs) WHERE r = 1""", "logs")
def _(t):
    df = t.logs.select("user_id", "post_id", "event_time", "log_id", "action")
    return ops.keep_one(df, ["user_id", "post_id"], ["event_time", "log_id"]).drop("event_time")


@query("dedup_last", """
SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS r FROM documents) WHERE r = 1""")
def _(t):
    hashed = t.docs.select(ops.row_digest("text").alias("digest"), "doc_id", "lang")
    return ops.keep_one(hashed, ["digest"], ["doc_id"], keep="last").select("doc_id", "lang")


@query("dup_flag", """
SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS duplicate FROM documents""")
def _(t):
    hashed = t.docs.select("doc_id", ops.row_digest("text").alias("digest"))
    return ops.duplicate_flag(hashed, ["digest"], "doc_id").select("doc_id", "duplicate")


@query("tag_normalise", """
SELECT post_id, lower(regexp_replace(tags, '\\s+', '', 'g')) AS tags, CAST(len(string_split(tags, ',')) AS INTEGER) AS tag_count FROM articles""", "articles")
def _(t):
    return t.articles.select("post_id", ops.normal_tags("tags").alias("tags"), ops.tag_count("tags").alias("tag_count"))


@query("engagement_score", """
SELECT post_id, views + likes * 5 + comments * 10 AS full_score, views + likes * 5 AS liked_score, views + likes AS plain_score FROM posts""", "posts")
def _(t):
    return t.posts.select(
        "post_id", ops.engagement().alias("full_score"), ops.engagement(comments=None).alias("liked_score"), ops.engagement(1, None).alias("plain_score")
    )


DIRTY_POSTS = """(SELECT post_id, CASE WHEN category = '5-LOW' AND status = 'draft' THEN ' ' ELSE '  ' || title || ' ' END AS title, ' ' || author AS author,
  category, ' ' || tags || ' ' AS tags, CASE WHEN comments = 7 THEN -views ELSE nullif(views, 0) END AS views, nullif(likes, 3) AS likes, comments,
  CASE WHEN comments = 13 THEN 'bad-date' ELSE strftime(publish_date, '%Y-%m-%d') END AS publish_date, status FROM posts)"""


def dirty_posts(t):
    return t.posts.select(
        "post_id",
        F.expr("CASE WHEN category = '5-LOW' AND status = 'draft' THEN ' ' ELSE concat('  ', title, ' ') END").alias("title"),
        F.concat(F.lit(" "), "author").alias("author"), "category", F.concat(F.lit(" "), "tags", F.lit(" ")).alias("tags"),
        F.expr("CASE WHEN comments = 7 THEN -views ELSE nullif(views, 0) END").alias("views"), F.expr("nullif(likes, 3)").alias("likes"), "comments",
        F.expr("CASE WHEN comments = 13 THEN 'bad-date' ELSE date_format(publish_date, 'yyyy-MM-dd') END").alias("publish_date"), "status",
    )


CLEAN_POSTS = f"""
SELECT post_id, trim(title) AS title, trim(author) AS author, category, lower(regexp_replace(trim(tags), '\\s+', '', 'g')) AS tags, v AS views, l AS likes,
 comments, CAST(publish_date AS DATE) AS publish_date, status, CAST(year(publish_date::DATE) AS INTEGER) AS "year", CAST(month(publish_date::DATE) AS INTEGER) AS "month",
 CAST(len(string_split(tags, ',')) AS INTEGER) AS tag_count, v + l * 5 + comments * 10 AS engagement,
 CASE WHEN v >= 3000 THEN 'hot' WHEN v >= 1500 THEN 'normal' ELSE 'cold' END AS popularity
FROM (SELECT *, greatest(coalesce(views, 0), 0) AS v, greatest(coalesce(likes, 0), 0) AS l FROM {DIRTY_POSTS})
WHERE trim(title) <> '' AND trim(author) <> '' AND publish_date <> 'bad-date'"""


@query("etl_clean_posts", CLEAN_POSTS, "posts")
def _(t):
    return ops.clean_posts(dirty_posts(t))


@query("etl_clean_logs", """
SELECT log_id, user_id, post_id, action, strftime(event_time, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS event_time, event_date, CAST(hour(event_time) AS INTEGER) AS event_hour
FROM logs WHERE user_id IS NOT NULL AND device <> 'tablet'""", "logs")
def _(t):
    raw = t.logs.select(
        "log_id", "user_id", "post_id", F.concat(F.lit(" "), F.upper("action"), F.lit(" ")).alias("action"),
        F.when(F.col("device") == "tablet", "not a time").otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
    )
    cleaned = ops.clean_access_logs(raw).drop("timestamp")
    return cleaned.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("describe_stats", """
SELECT col AS "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
 round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
FROM (SELECT 'views' AS col, views::DOUBLE AS v FROM posts UNION ALL SELECT 'likes', likes::DOUBLE FROM posts UNION ALL SELECT 'comments', comments::DOUBLE FROM posts)
GROUP BY col""", "posts")
def _(t):
    stats = ops.describe_columns(t.posts, ["views", "likes", "comments"])
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})
