"""Versioned tables: append, update, merge, column changes, versions, differences, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressbeat.functions.aggregates import row_count
from pressbeat.operators.lake import VersionedTable, expired
from pressbeat.plans.base import query
from pressbeat.sources.catalog import partition_counts
from pressbeat.storage import scratch_path

_TABLES: dict[tuple[str, str], VersionedTable] = {}
APPENDED, UPDATED, MERGED, WIDENED, FILLED = 2, 3, 4, 5, 6


def table(t) -> VersionedTable:
    """The posts in six commits, one a day; built once per session and data directory."""
    known = (t.spark.sparkContext.applicationId, t.sf_dir)
    if known in _TABLES:
        return _TABLES[known]
    month = F.date_format("publish_date", "yyyy-MM")
    lake = VersionedTable(t.spark, scratch_path(t.spark, "lake"), ["post_id"], ("month", month), fixed=["publish_date"])
    posts = t.posts.drop("tags")
    lake.create(posts.schema, "2025-01-01 00:00:00")
    lake.append(posts.filter("publish_date < '1998-01-01'"), "2025-01-02 00:00:00")
    lake.append(posts.filter("publish_date >= '1998-01-01'"), "2025-01-03 00:00:00")
    lake.update_where(F.col("category") == "1-URGENT", {"likes": F.col("likes") + 10}, "2025-01-04 00:00:00")
    source = t.posts.filter("comments IN (5, 6)").select(
        F.expr("CASE WHEN comments = 5 THEN post_id ELSE -post_id - 1 END").alias("post_id"), (F.col("views") + 1000).alias("views"), "likes"
    )
    fields = {"views": F.col("source.views"), "likes": F.col("source.likes")}
    defaults = {**fields, "title": F.lit("new post"), "author": F.lit("unknown"), "comments": F.lit(0), "status": F.lit("draft"),
                "publish_date": F.lit("2002-01-01").cast("date")}
    lake.merge(source, fields, defaults, "2025-01-05 00:00:00")
    lake.add_column("read_minutes", "bigint", "2025-01-06 00:00:00", after="views")
    lake.update_where(F.col("status") == "archived", {"read_minutes": F.floor(F.col("views") / 200)}, "2025-01-07 00:00:00")
    _TABLES[known] = lake
    return lake


UPDATED_SQL = "(SELECT * REPLACE (CASE WHEN category = '1-URGENT' THEN likes + 10 ELSE likes END AS likes) FROM posts)"
MERGED_SQL = f"""(SELECT post_id, title, author, category, CASE WHEN comments = 5 THEN views + 1000 ELSE views END AS views,
  CASE WHEN comments = 5 THEN raw_likes ELSE likes END AS likes, comments, publish_date, status FROM (SELECT u.*, p.likes AS raw_likes FROM {UPDATED_SQL} u JOIN posts p USING (post_id))
 UNION ALL SELECT -post_id - 1, 'new post', 'unknown', NULL, views + 1000, likes, 0, DATE '2002-01-01', 'draft' FROM posts WHERE comments = 6)"""


def by_status(rows):
    return rows.groupBy("status", "category").agg(
        row_count().alias("n"), F.sum("views").alias("views"), F.sum("likes").alias("likes"), F.max("publish_date").alias("latest")
    )


def by_status_sql(rows):
    return f"""SELECT status, category, count(*) AS n, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes, max(publish_date) AS latest
 FROM {rows} GROUP BY ALL"""


@query("lake_append", by_status_sql("posts"), "posts")
def _(t):
    return by_status(table(t).read(APPENDED))


@query("lake_pruned_read", """
SELECT category, count(*) AS n, CAST(sum(views) AS BIGINT) AS views, max(likes) AS top FROM posts
WHERE strftime(publish_date, '%Y-%m') IN ('1997-12', '1998-01') AND status = 'published' GROUP BY category""", "posts")
def _(t):
    rows = table(t).read(APPENDED, F.col("status") == "published", ["1997-12", "1998-01"])
    return rows.groupBy("category").agg(row_count().alias("n"), F.sum("views").alias("views"), F.max("likes").alias("top"))


@query("lake_update", by_status_sql(UPDATED_SQL), "posts")
def _(t):
    return by_status(table(t).read(UPDATED))


@query("lake_merge", f"SELECT post_id, title, author, category, views, likes, comments, publish_date, status FROM {MERGED_SQL}", "posts")
def _(t):
    return table(t).read(MERGED)


@query("lake_add_column", f"""
SELECT post_id, views, CASE WHEN status = 'archived' THEN views // 200 END AS read_minutes, likes, status FROM {MERGED_SQL}""", "posts")
def _(t):
    return table(t).read(FILLED).select("post_id", "views", "read_minutes", "likes", "status")


@query("lake_snapshots", f"""
SELECT 0::BIGINT AS snapshot_id, NULL::BIGINT AS parent_id, TIMESTAMP '2025-01-01' AS committed_at, 'create' AS operation, 0::BIGINT AS added, 0::BIGINT AS deleted
UNION ALL SELECT 1, 0, TIMESTAMP '2025-01-02', 'append', count(*), 0 FROM posts WHERE publish_date < DATE '1998-01-01'
UNION ALL SELECT 2, 1, TIMESTAMP '2025-01-03', 'append', count(*), 0 FROM posts WHERE publish_date >= DATE '1998-01-01'
UNION ALL SELECT 3, 2, TIMESTAMP '2025-01-04', 'update', count(*), count(*) FROM posts WHERE category = '1-URGENT'
UNION ALL SELECT 4, 3, TIMESTAMP '2025-01-05', 'merge', count(*), count(*) FILTER (comments = 5) FROM posts WHERE comments IN (5, 6)
UNION ALL SELECT 5, 4, TIMESTAMP '2025-01-06', 'add-column', 0, 0
UNION ALL SELECT 6, 5, TIMESTAMP '2025-01-07', 'update', count(*), count(*) FROM posts WHERE status = 'archived'""", "posts")
def _(t):
    return table(t).snapshots().withColumn("committed_at", F.col("committed_at").cast("timestamp_ntz"))


@query("lake_as_of", """
SELECT 'first' AS version, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes FROM posts WHERE publish_date < DATE '1998-01-01'
UNION ALL SELECT 'at time', count(*), CAST(sum(likes) AS BIGINT) FROM posts""", "posts")
def _(t):
    lake = table(t)
    at_time = lake.read(lake.version_at("2025-01-03 12:00:00"))
    frames = [df.groupBy(F.lit(name).alias("version")).agg(row_count().alias("n"), F.sum("likes").alias("likes")) for name, df in (("first", lake.read(1)), ("at time", at_time))]
    return frames[0].union(frames[1])


@query("lake_compacted", by_status_sql(MERGED_SQL), "posts")
def _(t):
    month = F.date_format("publish_date", "yyyy-MM")
    lake = VersionedTable(t.spark, scratch_path(t.spark, "lake-compacted"), ["post_id"], ("month", month), fixed=["publish_date"])
    rows = table(t).read(MERGED)
    lake.create(rows.schema, "2025-02-01 00:00:00")
    lake.append(rows.withColumn("likes", F.lit(0)), "2025-02-02 00:00:00")
    true_likes = rows.select("post_id", "likes")
    lake.merge(true_likes, {"likes": F.col("source.likes")}, {}, "2025-02-03 00:00:00")
    lake.compact("2025-02-04 00:00:00")
    return by_status(lake.read())


@query("lake_expire", """
SELECT snapshot_id::BIGINT AS snapshot_id, operation FROM (VALUES (0, 'create', 1), (1, 'append', 1), (2, 'append', 1)) v(snapshot_id, operation, one)
WHERE (SELECT count(*) FROM posts) > 0""", "posts")
def _(t):
    return expired(table(t).snapshots(), "2025-01-04 00:00:00", 3).select("snapshot_id", "operation")


@query("lake_files")
def _(t):
    return table(t).files(APPENDED)


@query("lake_diff", f"""
SELECT change, category, count(*) AS n, CAST(sum(gain) AS BIGINT) AS gain FROM (
 SELECT CASE WHEN o.post_id IS NULL THEN 'added' ELSE 'changed' END AS change, n.category, n.views - coalesce(o.views, 0) AS gain
 FROM {MERGED_SQL} n LEFT JOIN posts o ON n.post_id = o.post_id
 WHERE o.post_id IS NULL OR n.views <> o.views OR n.likes <> o.likes) GROUP BY ALL""", "posts")
def _(t):
    changes = table(t).diff(APPENDED, MERGED)
    gain = F.col("new_row.views") - F.coalesce(F.col("old_row.views"), F.lit(0))
    return changes.groupBy("change", F.col("new_row.category").alias("category")).agg(row_count().alias("n"), F.sum(gain).alias("gain"))


@query("lake_partition_counts", "SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS \"rows\" FROM posts GROUP BY 1", "posts")
def _(t):
    return partition_counts(table(t).read(APPENDED).withColumn("month", F.date_format("publish_date", "yyyy-MM")), "month")
