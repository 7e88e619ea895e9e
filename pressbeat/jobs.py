"""End-to-end jobs made of the operators. Every output is written by the tasks; jobs return frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.operators import clean, quality, rollup, traffic
from pressbeat.operators.lake import VersionedTable
from pressbeat.sources import export, files
from pressbeat.sources.catalog import partition_counts
from pressbeat.streaming import events as stream_events
from pressbeat.streaming import sinks, windows

RAW_POSTS = (
    "post_id bigint, title string, author string, category string, tags string, views bigint, likes bigint,"
    " comments bigint, publish_date string, status string"
)


def etl_posts(spark: SparkSession, csv_path: str, target: str, quarantine: str | None = None) -> DataFrame:
    """CSV posts, cleaned, into a table partitioned by year and month; returns the rows per partition."""
    raw = files.read_csv(spark, csv_path, RAW_POSTS)
    if quarantine:
        # a query on the corrupt column alone is refused by the CSV reader, so whole rows are kept
        files.write_out(files.split_corrupt(raw)[1], quarantine, "json", "overwrite")
    files.load_partitioned(clean.clean_posts(raw).withColumnsRenamed({"year": "y", "month": "m"}), target, {"year": F.col("y"), "month": F.col("m")})
    return partition_counts(spark.read.parquet(target), "year", "month")


def analysis_suite(posts: DataFrame, logs: DataFrame, output: str, fmt: str = "csv") -> dict[str, str]:
    """The standing reports, each in its own folder: {report: path}."""
    listed = ["post_id", "title", "author", "category", "views", "likes", "comments"]
    scored = posts.select(*listed, clean.engagement().alias("engagement"))
    reports = {
        "dau_stats": traffic.dau(logs),
        "user_actions": traffic.user_activity(logs),
        "top_views": posts.select(*listed).orderBy(F.desc("views"), "post_id").limit(10),
        "top_engagement": scored.orderBy(F.desc("engagement"), "post_id").limit(10),
        "top_visited": traffic.hot_posts(logs, posts),
        "author_stats": traffic.author_stats(posts),
        "category_stats": traffic.category_stats(posts),
        "conversion_funnel": traffic.funnel(logs),
        "tag_stats": traffic.tag_stats(posts),
        "hourly_activity": traffic.hourly(logs.filter("action = 'view'")),
        **{f"{name}_distribution": traffic.share_by_subquery(logs, name) for name in ("action", "device")},
    }
    paths = {}
    for name, report in reports.items():
        paths[name] = f"{output}/{name}"
        files.write_out(report, paths[name], fmt, "overwrite")
    return paths


def described(posts: DataFrame) -> DataFrame:
    """Cleaned posts with the length of their title and the month they appeared in."""
    return posts.withColumns({"title_length": F.length("title"), "month": traffic.month_of("publish_date")})


def by_author(posts: DataFrame) -> DataFrame:
    whole, mean = (lambda c: F.sum(c)), (lambda c: F.round(F.avg(c), 9))
    return posts.groupBy("author").agg(
        F.count(F.lit(1)).alias("n_posts"), whole("views").alias("all_views"), whole("likes").alias("all_likes"), mean("views").alias("mean_views"),
        mean("engagement").alias("mean_engagement"), mean("title_length").alias("mean_title_length"), F.count_if(F.col("popularity") == "hot").alias("n_hot"),
    )


#: report -> (how it is made of the described posts, the format it is written in)
POST_REPORTS = {"authors": (by_author, "csv"), "months": (traffic.monthly_trend, "json"), "tags": (traffic.tag_stats, "csv")}


def post_reports(raw: DataFrame, folder: str) -> dict[str, str]:
    """Clean and describe raw posts, store them, and write the reports that are made of what was stored: {output: path}."""
    paths = {name: f"{folder}/{name}" for name in ("posts", *POST_REPORTS)}
    ready = raw.transform(clean.clean_posts).transform(described)
    files.write_out(ready, paths["posts"], "parquet", "overwrite")
    stored = raw.sparkSession.read.schema(ready.schema).parquet(paths["posts"])
    for name, (report, fmt) in POST_REPORTS.items():
        files.write_out(stored.transform(report), paths[name], fmt, "overwrite")
    return paths


def stream_post_stats(records: DataFrame, end: str | None = None) -> DataFrame:
    """Views, comments and likes per post and minute from a record stream, upserted by (post, window)."""
    events = stream_events.timed(stream_events.parse_events(records), end)
    return sinks.run_upsert(windows.post_pivot(events), ["post_id", "window_start"])


def rollup_dashboard(old: DataFrame, new_logs: DataFrame, target: str, n: int = 10) -> dict[str, DataFrame]:
    """Adds new facts to the per-post summary, writes it to ``target`` and answers from the summary only."""
    merged = rollup.rollup_merge(old, rollup.post_rollup(new_logs), rollup.POST_KEYS)
    files.write_out(merged, target, "parquet", "errorifexists")
    stored = old.sparkSession.read.schema(merged.schema).parquet(target)
    measures = ["views", "comments", "likes", "shares"]
    return {
        "daily": rollup.requery(stored, ["event_date"], measures),
        "hot": rollup.requery(stored, ["post_id"], measures).orderBy(F.desc("views"), "post_id").limit(n),
    }


def export_published(lake: VersionedTable, target: str, columns: list[str], index: str = "blog_posts") -> DataFrame:
    """Published rows of the newest version as search bulk lines; returns the document count as a check."""
    bulk = export.to_bulk(lake.read(where=F.col("status") == "published"), index, "post_id", columns)
    files.write_out(bulk, target, "text")
    # two lines per document
    lines = files.read_text(lake.spark, target)
    documents = lines.filter(F.col("value").startswith('{"index":{'))
    return quality.row_count_check(documents, "exported_documents", 1)
