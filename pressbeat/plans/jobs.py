"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat import jobs
from pressbeat.operators import rollup
from pressbeat.plans import lakes, streams
from pressbeat.plans.base import query
from pressbeat.plans.cleaning import CLEAN_POSTS, dirty_posts
from pressbeat.sources import events as source
from pressbeat.sources import files
from pressbeat.storage import scratch_path


@query("job_etl", f"""SELECT "year", "month", count(*) AS "rows" FROM ({CLEAN_POSTS}) GROUP BY ALL""", "posts")
def _(t):
    raw, target = scratch_path(t.spark, "raw-posts"), scratch_path(t.spark, "clean-posts")
    # leading blanks are part of the dirt, so the writer must keep them
    files.write_out(dirty_posts(t), raw, "csv", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return jobs.etl_posts(t.spark, raw, target, scratch_path(t.spark, "quarantine"))


@query("job_analysis", """
SELECT 'author_stats' AS report, count(DISTINCT author) AS "rows" FROM posts UNION ALL SELECT 'action_distribution', count(DISTINCT action) FROM logs
UNION ALL SELECT 'category_stats', count(DISTINCT category) FROM posts UNION ALL SELECT 'conversion_funnel', 1
UNION ALL SELECT 'dau_stats', count(DISTINCT event_date) FROM logs WHERE action = 'view' UNION ALL SELECT 'device_distribution', count(DISTINCT device) FROM logs
UNION ALL SELECT 'hourly_activity', count(DISTINCT hour(event_time)) FROM logs WHERE action = 'view'
UNION ALL SELECT 'tag_stats', count(DISTINCT trim(tag)) FROM (SELECT unnest(string_split(lower(tags), ',')) AS tag FROM posts)
UNION ALL SELECT 'top_engagement', 10 UNION ALL SELECT 'top_views', 10
UNION ALL SELECT 'top_visited', 10 UNION ALL SELECT 'user_actions', count(DISTINCT coalesce(user_id, 0)) FROM logs""", "posts", "logs")
def _(t):
    paths = jobs.analysis_suite(t.posts, t.logs, scratch_path(t.spark, "reports"), "parquet")
    counted = [t.spark.read.parquet(path).groupBy(F.lit(name).alias("report")).agg(F.count(F.lit(1)).alias("rows")) for name, path in paths.items()]
    together = counted[0]
    for part in counted[1:]:
        together = together.union(part)
    return together


@query("job_fluent", f"""
WITH p AS ({CLEAN_POSTS}) SELECT 'author' AS kind, author AS item, count(*) AS n_posts, CAST(sum(views) AS BIGINT) AS all_views, round(avg(views), 9) AS mean_views,
 round(avg(engagement), 9) AS mean_engagement, round(avg(length(title)), 9) AS mean_title_length, count(*) FILTER (popularity = 'hot') AS n_hot FROM p GROUP BY author
UNION ALL SELECT 'month', strftime(publish_date, '%Y-%m'), count(*), CAST(sum(views) AS BIGINT), round(avg(views), 9), NULL, NULL, NULL FROM p GROUP BY 2""", "posts")
def _(t):
    paths = jobs.post_reports(dirty_posts(t), scratch_path(t.spark, "reports"))
    kinds = "author string, n_posts bigint, all_views bigint, all_likes bigint, mean_views double, mean_engagement double, mean_title_length double, n_hot bigint"
    authors = files.read_csv(t.spark, paths["authors"], kinds, corrupt_column=None).drop("all_likes").withColumnRenamed("author", "item")
    months = t.spark.read.schema("month string, posts bigint, sum_views bigint, avg_views double").json(paths["months"])
    months = months.toDF("item", "n_posts", "all_views", "mean_views").withColumn("kind", F.lit("month"))
    return authors.withColumn("kind", F.lit("author")).unionByName(months, allowMissingColumns=True)


@streams.stream_query("job_stream_stats", streams.PIVOT, "logs")
def _(t):
    path, end = streams.topic(t)
    return jobs.stream_post_stats(source.read_events(t.spark, path, files_per_trigger=streams.FILES), end)


@query("job_rollup", """
SELECT event_date, count(*) FILTER (action = 'view') AS views, count(*) FILTER (action = 'comment') AS comments, count(*) FILTER (action = 'like') AS likes,
 count(*) FILTER (action = 'share') AS shares FROM logs GROUP BY event_date""", "logs")
def _(t):
    day = F.lit("2024-01-16").cast("date")
    old = rollup.post_rollup(t.logs.filter(F.col("event_date") < day))
    return jobs.rollup_dashboard(old, t.logs.filter(F.col("event_date") >= day), scratch_path(t.spark, "post-stats"))["daily"]


@query("job_export", """
SELECT 'exported_documents' AS check_name, 'PASS' AS status, count(*)::DOUBLE AS value, 1::DOUBLE AS threshold FROM posts WHERE status = 'published'""", "posts")
def _(t):
    columns = ["post_id", "title", "author", "category", "publish_date", "views", "likes", "comments", "status"]
    return jobs.export_published(lakes.table(t), scratch_path(t.spark, "bulk"), columns)
