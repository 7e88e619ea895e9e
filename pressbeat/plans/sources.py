"""Scans, sinks, imports, exports and catalog views."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from pressbeat.operators import traffic
from pressbeat.plans.base import query
from pressbeat.plans.traffic import OVERVIEW
from pressbeat.sources import catalog, export, files, imports
from pressbeat.storage import scratch_path

POST_SCHEMA = (
    "post_id bigint, title string, author string, category string, tags string, views bigint, likes bigint,"
    " comments bigint, publish_date date, status string"
)
BY_CATEGORY = """
SELECT category, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views, min(publish_date) AS first_date, max(title) AS last_title
FROM posts GROUP BY category"""


def by_category(posts):
    return posts.groupBy("category").agg(
        F.count(F.lit(1)).alias("posts"), F.sum("views").alias("sum_views"), F.min("publish_date").alias("first_date"), F.max("title").alias("last_title")
    )


def csv_of_posts(t, label):
    path = scratch_path(t.spark, label)
    files.write_out(t.posts, path, "csv")
    return path


@query("src_csv_roundtrip", BY_CATEGORY, "posts")
def _(t):
    good, _bad = files.split_corrupt(files.read_csv(t.spark, csv_of_posts(t, "csv"), POST_SCHEMA))
    return by_category(good)


@query("src_csv_infer", BY_CATEGORY, "posts")
def _(t):
    path = scratch_path(t.spark, "csv-semicolon")
    files.write_out(t.posts, path, "csv", sep=";", quote="'", nullValue="-")
    return by_category(files.read_csv_infer(t.spark, path, sep=";", quote="'", null_value="-").withColumns(
        {"views": F.col("views").cast("bigint"), "publish_date": F.col("publish_date").cast("date")}))


@query("src_csv_glob", BY_CATEGORY, "posts")
def _(t):
    root = scratch_path(t.spark, "csv-many")
    files.write_out(t.posts.withColumn("part", F.col("status")), root, "csv", partition_by=["part"])
    return by_category(files.read_csv(t.spark, f"{root}/part=*/*.csv", POST_SCHEMA, corrupt_column=None))


@query("src_csv_project", "SELECT post_id, CAST(views AS INTEGER) AS views FROM posts ORDER BY post_id LIMIT 100", "posts")
def _(t):
    typed = POST_SCHEMA.replace("views bigint", "views int")
    picked = files.read_csv(t.spark, csv_of_posts(t, "csv-project"), typed, corrupt_column=None).select("post_id", "views")
    return picked.orderBy("post_id").limit(100)


@query("src_chunk_agg", "SELECT category, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views FROM posts GROUP BY category", "posts")
def _(t):
    def per_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
        return chunk.groupby("category", as_index=False).agg(posts=("views", "size"), sum_views=("views", "sum"))

    chunks = files.chunk_aggregate(t.posts.select("category", "views"), per_chunk, "category string, posts bigint, sum_views bigint")
    return chunks.groupBy("category").agg(F.sum("posts").alias("posts"), F.sum("sum_views").alias("sum_views"))


@query("src_json_nested", """
SELECT tag, city_author AS author, count(*) AS posts FROM (
  SELECT author AS city_author, trim(unnest(string_split(tags, ','))) AS tag FROM articles) GROUP BY ALL""", "articles")
def _(t):
    path = scratch_path(t.spark, "json")
    nested = t.articles.select("post_id", F.struct(F.col("author").alias("name")).alias("author"), F.split("tags", ", *").alias("tags"))
    files.write_out(nested, path, "json")
    schema = "post_id bigint, author struct<name: string>, tags array<string>"
    read = files.read_json(t.spark, path, schema)
    return read.select(F.explode("tags").alias("tag"), F.col("author.name").alias("author")).groupBy("tag", "author").agg(F.count(F.lit(1)).alias("posts"))


@query("src_text_lines", """
SELECT count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars, count(*) FILTER (line = '') AS blank FROM (
  SELECT unnest(string_split(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), chr(10))) AS line FROM documents)""")
def _(t):
    path = scratch_path(t.spark, "text")
    files.write_out(t.docs.select("text"), path, "text")
    lines = files.read_text(t.spark, path)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value").cast("bigint")).alias("chars"), F.count_if(F.col("value") == "").alias("blank")
    )


@query("src_parquet_pruned", """
SELECT l_returnflag, count(*) AS items, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY l_returnflag""")
def _(t):
    recent = F.col("l_shipdate") >= F.expr("timestamp_ntz'1998-01-01 00:00:00'")
    items = files.read_parquet(t.spark, t.path("lineitem"), ["l_returnflag", "l_quantity"], recent)
    return items.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity"))


@query("src_orc_roundtrip", BY_CATEGORY, "posts")
def _(t):
    path = scratch_path(t.spark, "orc")
    files.write_out(t.posts, path, "orc")
    return by_category(t.spark.read.orc(path))


@query("load_partitioned_month", """
SELECT strftime(publish_date, '%Y-%m') AS publish_month, count(*) AS posts, CAST(sum(views) AS BIGINT) AS sum_views FROM posts GROUP BY 1""", "posts")
def _(t):
    path = scratch_path(t.spark, "by-month")
    staged = files.read_csv(t.spark, csv_of_posts(t, "staging"), POST_SCHEMA, corrupt_column=None)
    files.load_partitioned(staged, path, {"publish_month": F.date_format("publish_date", "yyyy-MM")})
    loaded = t.spark.read.option("basePath", path).parquet(path).withColumn("publish_month", F.date_format(F.col("publish_month").cast("date"), "yyyy-MM"))
    return loaded.groupBy("publish_month").agg(F.count(F.lit(1)).alias("posts"), F.sum("views").alias("sum_views"))


@query("src_literal_rows", """
SELECT label, count(*) AS posts FROM posts JOIN (VALUES ('published', 'live'), ('draft', 'hidden'), ('archived', 'old')) s(status, label)
USING (status) GROUP BY label""", "posts")
def _(t):
    labels = files.literal_rows(t.spark, [("published", "live"), ("draft", "hidden"), ("archived", "old")], "status string, label string")
    return t.posts.join(labels, "status").groupBy("label").agg(F.count(F.lit(1)).alias("posts"))


@query("src_to_pandas", "SELECT category, count(*) AS posts FROM posts GROUP BY category ORDER BY posts DESC, category LIMIT 3", "posts")
def _(t):
    counts = t.posts.groupBy("category").agg(F.count(F.lit(1)).alias("posts")).orderBy(F.desc("posts"), "category")
    frame = files.to_pandas(counts, ["category", "posts"], 3)
    return t.spark.createDataFrame(frame, "category string, posts bigint")


@query("sink_formats_roundtrip", """
SELECT format, count(*) AS posts, CAST(sum(likes) AS BIGINT) AS sum_likes FROM posts, (VALUES ('parquet'), ('orc'), ('csv'), ('json')) f(format)
GROUP BY format""", "posts")
def _(t):
    parts = []
    compression = {"parquet": "snappy", "orc": "zlib", "csv": "gzip", "json": "gzip"}
    for fmt, codec in compression.items():
        path = scratch_path(t.spark, fmt)
        files.write_out(t.posts, path, fmt, compression=codec)
        reader = t.spark.read.option("header", True) if fmt == "csv" else t.spark.read
        back = reader.schema(POST_SCHEMA).format(fmt).load(path)
        parts.append(back.select(F.lit(fmt).alias("format"), "likes"))
    together = parts[0]
    for part in parts[1:]:
        together = together.union(part)
    return together.groupBy("format").agg(F.count(F.lit(1)).alias("posts"), F.sum("likes").alias("sum_likes"))


@query("sink_modes", """
SELECT 'overwrite' AS mode, count(*) AS posts FROM posts UNION ALL SELECT 'append', 2 * count(*) FROM posts
UNION ALL SELECT 'ignore', 2 * count(*) FROM posts UNION ALL SELECT 'error', 2 * count(*) FROM posts""", "posts")
def _(t):
    path = scratch_path(t.spark, "modes")
    counts = []
    for mode in ("overwrite", "append", "ignore", "error"):
        try:
            files.write_out(t.posts, path, "parquet", mode)
        except Exception as error:
            if "ALREADY_EXISTS" not in str(error).upper():
                raise
        # counted now: a later mode may change the folder
        counts.append((mode, t.spark.read.schema(POST_SCHEMA).parquet(path).count()))
    return t.spark.createDataFrame(counts, "mode string, posts bigint")


@query("sink_partitioned", "SELECT status, category, count(*) AS posts, max(views) AS max_views FROM posts GROUP BY ALL", "posts")
def _(t):
    path = scratch_path(t.spark, "partitioned")
    files.write_partitioned(t.posts, path, ["status"])
    return t.spark.read.parquet(path).groupBy("status", "category").agg(F.count(F.lit(1)).alias("posts"), F.max("views").alias("max_views"))


@query("sink_bucketed", "SELECT author, count(*) AS posts, max(views) AS max_views FROM posts GROUP BY author", "posts")
def _(t):
    table = f"posts_bucketed_{uuid.uuid4().hex}"
    files.write_bucketed(t.posts, table, scratch_path(t.spark, "bucketed"), 8, "author")
    return t.spark.table(table).groupBy("author").agg(F.count(F.lit(1)).alias("posts"), F.max("views").alias("max_views"))


@query("sink_coalesced", "SELECT month, posts FROM (SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS posts FROM posts GROUP BY 1)", "posts")
def _(t):
    path = scratch_path(t.spark, "single")
    files.write_single_file(traffic.monthly_trend(t.posts).select("month", "posts"), path)
    return t.spark.read.parquet(path)


@query("export_bulk", """
SELECT '{"index":{"_index":"blog_posts","_id":"' || post_id || '"}}' || chr(10) ||
       '{"post_id":' || post_id || ',"title":"' || title || '","author":"' || author || '","views":' || views || ',"publish_date":"' ||
       strftime(publish_date, '%Y-%m-%d') || '"}' AS value
FROM posts WHERE status = 'published'""", "posts")
def _(t):
    return export.to_bulk(t.posts, "blog_posts", "post_id", ["post_id", "title", "author", "views", "publish_date"], F.col("status") == "published")


@query("bulk_audit", """
SELECT CAST(CASE WHEN views < 250 THEN 429 WHEN likes = 0 THEN 400 ELSE 201 END AS INTEGER) AS status,
       count(*) FILTER (NOT (views < 250 OR likes = 0)) AS succeeded, count(*) FILTER (views < 250 OR likes = 0) AS failed
FROM posts GROUP BY 1""", "posts")
def _(t):
    status = F.when(F.col("views") < 250, 429).when(F.col("likes") == 0, 400).otherwise(201)
    item = F.struct(F.struct(F.col("post_id").cast("string").alias("_id"), status.alias("status")).alias("index"))
    return export.bulk_audit(t.posts.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("value")))


@query("import_daily", """
SELECT event_date, count(*) AS total_pv, count(DISTINCT user_id) AS total_uv FROM logs GROUP BY event_date""", "logs")
def _(t):
    daily = traffic.daily_trend(t.logs)
    zero = F.lit(0).cast("bigint")
    out = scratch_path(t.spark, "daily-csv")
    rows = daily.select(
        "event_date", F.col("pv").alias("total_pv"), F.col("uv").alias("total_uv"), zero.alias("new_users"), zero.alias("new_posts"),
        F.col("comments").alias("total_comments"), F.col("likes").alias("total_likes"), F.lit(0.0).alias("bounce_rate"), F.lit(0.0).alias("avg_duration"),
    )
    files.write_out(rows, out, "csv")
    imported = imports.import_daily(t.spark, out, scratch_path(t.spark, "daily"))
    return imported.select("event_date", "total_pv", "total_uv")


@query("import_logs", "SELECT action, device, count(*) AS n, max(event_time) AS latest, count(user_id) AS signed_in FROM logs GROUP BY ALL", "logs")
def _(t):
    out = scratch_path(t.spark, "logs-csv")
    facts = t.logs.select("log_id", "user_id", "post_id", "action", "ip", "device", "event_time")
    files.write_out(facts, out, "csv", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    imported = imports.import_logs(t.spark, out, scratch_path(t.spark, "logs"))
    return imported.groupBy("action", "device").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time").cast("timestamp_ntz").alias("latest"), F.count("user_id").alias("signed_in")
    )


@query("import_rejects", """
SELECT 'imported' AS result, count(*) AS "rows" FROM logs WHERE action <> 'share' UNION ALL SELECT 'rejected', count(*) FROM logs WHERE action = 'share'""", "logs")
def _(t):
    """Every share is written with a number no integer column takes; the import sets those rows aside and counts both halves."""
    out, target = scratch_path(t.spark, "bad-csv"), scratch_path(t.spark, "checked-logs")
    post = F.when(F.col("action") == "share", F.lit("not a number")).otherwise(F.col("post_id").cast("string"))
    facts = t.logs.select("log_id", "user_id", post.alias("post_id"), "action", "ip", "device", "event_time")
    files.write_out(facts, out, "csv", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    imports.import_logs(t.spark, out, target)
    return imports.import_counts(t.spark, target)


@query("object_inventory")
def _(t):
    return files.list_objects(t.spark, t.sf_dir).select("name", "bytes", "modified")


@query("object_totals")
def _(t):
    return files.object_totals(files.list_objects(t.spark, t.sf_dir))


@query("catalog_view", OVERVIEW, "logs")
def _(t):
    view = f"v_daily_overview_{uuid.uuid4().hex}"
    catalog.register_views({view: traffic.daily_overview(t.logs)})
    return t.spark.sql(f"SELECT * FROM {view}")


@query("catalog_persistent_view", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _(t):
    """A view in a database of its own, read by another session of the same catalog."""
    database = f"blog_{uuid.uuid4().hex}"
    catalog.create_database(t.spark, database)
    catalog.persist_view(t.spark, f"{database}.v_actions", f"SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM parquet.`{t.path('events')}` GROUP BY event_type")
    return t.spark.newSession().table(f"{database}.v_actions")


@query("profile_schema", """
SELECT (SELECT count(*) FROM events) AS "rows", CAST(ordinal AS INTEGER) AS "position", name AS "column", kind AS "type" FROM (VALUES
 (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'), (3, 'event_type', 'string'), (4, 'value', 'double'),
 (5, 'props', 'string')) v(ordinal, name, kind)""")
def _(t):
    return catalog.profile_schema(t.raw("events"))


@query("partition_counts", "SELECT strftime(publish_date, '%Y-%m') AS month, count(*) AS \"rows\" FROM posts GROUP BY 1", "posts")
def _(t):
    path = scratch_path(t.spark, "month-partitions")
    files.write_partitioned(t.posts.withColumn("month", F.date_format("publish_date", "yyyy-MM")), path, ["month"])
    stored = t.spark.read.schema("post_id bigint, month string").parquet(path)
    return catalog.partition_counts(stored, "month")


@query("load_verify", """
SELECT 'posts' AS table_name, status AS part, count(*) AS "rows" FROM posts GROUP BY status
UNION ALL SELECT 'logs', action, count(*) FROM logs GROUP BY action""", "posts", "logs")
def _(t):
    posts = t.posts.groupBy(F.lit("posts").alias("table_name"), F.col("status").alias("part"))
    logs = t.logs.groupBy(F.lit("logs").alias("table_name"), F.col("action").alias("part"))
    rows = F.count(F.lit(1)).alias("rows")
    return posts.agg(rows).union(logs.agg(rows))
