"""Rollups and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.operators import quality, rollup
from pressbeat.plans.base import query

CUT = "2024-01-16"
LOG_CITY = "(SELECT l.*, city FROM logs l JOIN users u ON l.user_id = u.user_id)"


def halves(t, df):
    """Rows before and from the middle of the month: an existing table and a new delta."""
    day = F.lit(CUT).cast("date")
    return df.filter(F.col("event_date") < day), df.filter(F.col("event_date") >= day)


def day_rollup(t):
    old, new = halves(t, t.logs)
    return rollup.rollup_merge(rollup.day_rollup(old, t.users), rollup.day_rollup(new, t.users), rollup.DAY_KEYS)


def post_rollup(t):
    old, new = halves(t, t.logs)
    return rollup.rollup_merge(rollup.post_rollup(old), rollup.post_rollup(new), rollup.POST_KEYS)


@query("rollup_day", f"""
SELECT event_date, city, device, count(*) AS pv, count(DISTINCT user_id) AS uv, count(*) FILTER (action = 'comment') AS comments,
 count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'share') AS shares FROM {LOG_CITY} GROUP BY ALL""", "logs", "users")
def _(t):
    return day_rollup(t)


@query("rollup_post", """
SELECT post_id, event_date, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments,
 count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'share') AS shares FROM logs GROUP BY ALL""", "logs")
def _(t):
    return post_rollup(t)


@query("rollup_requery", """
SELECT post_id, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments,
 count(*) FILTER (action = 'like') AS likes, count(*) FILTER (action = 'share') AS shares FROM logs GROUP BY post_id ORDER BY views DESC, post_id LIMIT 10""", "logs")
def _(t):
    totals = rollup.requery(post_rollup(t), ["post_id"], ["views", "comments", "likes", "shares"])
    return totals.orderBy(F.desc("views"), "post_id").limit(10)


@query("rollup_city_additive", f"""
SELECT city, CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(uv) AS BIGINT) AS uv FROM (
 SELECT event_date, city, device, count(*) AS pv, count(DISTINCT user_id) AS uv FROM {LOG_CITY} GROUP BY ALL) GROUP BY city""", "logs", "users")
def _(t):
    return rollup.requery(day_rollup(t), ["city"], ["pv", "uv"])


def device_sketches(t):
    """Visitor sketches per device, merged from daily ones of two loads."""
    old, new = halves(t, t.logs)
    keys = ["event_date", "device"]
    return rollup.sketch_requery(rollup.sketch_rollup(old, keys).unionByName(rollup.sketch_rollup(new, keys)), ["device"])


@query("rollup_uv_sketch", """
SELECT device, count(*) AS pv, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, count(DISTINCT user_id) AS exact, TRUE AS within,
 CASE WHEN count(DISTINCT user_id) <= 16384 THEN 0 ELSE round(count(DISTINCT user_id) * 3 / sqrt(16384), 6) END::DOUBLE AS bound FROM logs GROUP BY device""", "logs")
def _(t):
    exact = t.logs.groupBy("device").agg(F.count_distinct("user_id").alias("exact"))
    bound = F.round(rollup.sketch_error(F.col("exact")), 6)
    known = device_sketches(t).join(exact, "device")
    return known.select("device", "pv", "uv", "exact", (F.abs(F.col("uv") - F.col("exact")) <= bound).alias("within"), bound.alias("bound"))


@query("rollup_uv_overlap", """
WITH v AS (SELECT DISTINCT device, user_id FROM logs WHERE user_id IS NOT NULL)
SELECT a.device, b.device AS other, (SELECT count(*) FROM v x JOIN v y USING (user_id) WHERE x.device = a.device AND y.device = b.device) AS "both",
 (SELECT count(*) FROM v x WHERE x.device = a.device AND user_id NOT IN (SELECT user_id FROM v y WHERE y.device = b.device)) AS only_left,
 (SELECT count(*) FROM v x WHERE x.device = b.device AND user_id NOT IN (SELECT user_id FROM v y WHERE y.device = a.device)) AS only_right
FROM (SELECT DISTINCT device FROM v) a JOIN (SELECT DISTINCT device FROM v) b ON a.device < b.device""", "logs")
def _(t):
    """Visitors that two devices share, from their sketches alone."""
    sketches = device_sketches(t).select("device", "visitors")
    # one sketch for each device
    listed = sketches.agg(F.collect_list(F.struct("device", "visitors"))).scalar()
    pairs = sketches.withColumn("listed", listed).select("device", "visitors", F.explode(F.filter("listed", lambda x: x["device"] > F.col("device"))).alias("x"))
    pairs = pairs.select("device", "visitors", F.col("x.device").alias("other"), F.col("x.visitors").alias("other_visitors"))
    return pairs.select("device", "other", *(c.alias(n) for n, c in rollup.sketch_overlap(F.col("visitors"), F.col("other_visitors")).items()))


@query("rollup_uv_exact", "SELECT device, count(DISTINCT user_id) AS uv FROM logs GROUP BY device", "logs")
def _(t):
    old, new = halves(t, t.logs)
    keys = ["event_date", "device"]
    pairs = rollup.visitor_pairs(old, keys).union(rollup.visitor_pairs(new, keys)).distinct()
    return pairs.groupBy("device").agg(F.count_distinct("user_id").alias("uv"))


@query("replace_latest", """
SELECT event_date, count(*) AS total_pv, 2 AS version FROM logs GROUP BY event_date""", "logs")
def _(t):
    full = t.logs.groupBy("event_date").agg(F.count(F.lit(1)).alias("total_pv")).withColumn("version", F.lit(2))
    early = t.logs.filter("action = 'view'").groupBy("event_date").agg(F.count(F.lit(1)).alias("total_pv")).withColumn("version", F.lit(1))
    return rollup.replace_latest(full.union(early), ["event_date"], "version")


ROW_CHECK = """SELECT 'posts_rows' AS check_name, CASE WHEN count(*) >= 100 THEN 'PASS' ELSE 'FAIL' END AS status, count(*)::DOUBLE AS value, 100::DOUBLE AS threshold FROM posts"""
NULL_CHECK = """SELECT 'logs_nulls:' || c AS check_name, CASE WHEN ratio <= 0.05 THEN 'PASS' ELSE 'FAIL' END AS status, round(ratio, 9) AS value, 0.05::DOUBLE AS threshold FROM (
 SELECT 'user_id' AS c, count(*) FILTER (user_id IS NULL)::DOUBLE / count(*) AS ratio FROM logs
 UNION ALL SELECT 'action', count(*) FILTER (action IS NULL)::DOUBLE / count(*) FROM logs)"""
FRESH_CHECK = """SELECT 'logs_fresh' AS check_name, CASE WHEN age <= 24 THEN 'PASS' ELSE 'FAIL' END AS status, round(age, 6) AS value, 24::DOUBLE AS threshold FROM (
 SELECT date_diff('microsecond', max(event_time), TIMESTAMP '2024-01-31 12:00:00') / 3.6e9 AS age FROM logs)"""
BAND_CHECK = """SELECT 'published_share' AS check_name, CASE WHEN v < 30 THEN 'PASS' WHEN v < 90 THEN 'WARN' ELSE 'FAIL' END AS status, v AS value, 90::DOUBLE AS threshold FROM (
 SELECT round(count(*) FILTER (status = 'published') * 100::DOUBLE / count(*), 6) AS v FROM posts)"""


def row_check(t):
    return quality.row_count_check(t.posts, "posts_rows", 100)


def null_check(t):
    return quality.null_ratio_check(t.logs, "logs_nulls", ["user_id", "action"])


def fresh_check(t):
    return quality.freshness_check(t.logs, "logs_fresh", "event_time", F.lit("2024-01-31 12:00:00").cast("timestamp"))


def band_check(t):
    share = F.round(F.count_if(F.col("status") == "published").cast("double") * 100 / F.count(F.lit(1)), 6)
    return quality.band_check(t.posts, "published_share", share, warn=30)


@query("dq_row_count", ROW_CHECK, "posts")
def _(t):
    return row_check(t)


@query("dq_null_ratio", NULL_CHECK, "logs")
def _(t):
    return null_check(t)


@query("dq_freshness", FRESH_CHECK, "logs")
def _(t):
    return fresh_check(t)


@query("dq_band", BAND_CHECK, "posts")
def _(t):
    return band_check(t)


@query("dq_report", f"""
SELECT count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail,
 max(CASE status WHEN 'PASS' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END)::INT AS overall
FROM ({ROW_CHECK} UNION ALL {NULL_CHECK} UNION ALL {FRESH_CHECK} UNION ALL {BAND_CHECK})""", "posts", "logs")
def _(t):
    return quality.report(quality.union_checks(row_check(t), null_check(t), fresh_check(t), band_check(t)))
