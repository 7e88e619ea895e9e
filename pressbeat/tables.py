"""The blog's logical tables (logs, posts, articles, users, docs) over the stored Parquet tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.session import configure
from pressbeat.storage import file_system

# Stored event type -> blog action.
ACTION_OF_EVENT = {
    "view": "view",
    "click": "like",
    "purchase": "comment",
    "signup": "share",
    "error": "search",
}
# Order status -> post status.
STATUS_OF_ORDER = {"O": "published", "F": "archived", "P": "draft"}
DEVICES = ("desktop", "mobile", "tablet")


def relabel(column: str, mapping: dict[str, str]):
    """The value each key maps to; keys that are not mapped become NULL."""
    result = F.lit(None).cast("string")
    for key, value in mapping.items():
        result = F.when(F.col(column) == key, F.lit(value)).otherwise(result)
    return result


class Tables:
    """Lazily read tables of one data directory; every scan keeps only the columns asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def is_folder(self, name: str) -> bool:
        store, path = file_system(self.spark, self.path(name))
        return store.getFileStatus(path).isDirectory()

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def logs(self) -> DataFrame:
        """Access log: anonymous visitors have a NULL user_id."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("event_id").alias("log_id"),
            F.expr("nullif(user_id, 0)").alias("user_id"),
            k.alias("post_id"),
            relabel("event_type", ACTION_OF_EVENT).alias("action"),
            F.concat(F.lit("10.0."), k.cast("string"), F.lit(".1")).alias("ip"),
            F.element_at(F.array(*map(F.lit, DEVICES)), (k % 3) + 1).alias("device"),
            F.col("value").alias("duration"),
            F.col("ts").cast("timestamp").alias("event_time"),
            F.col("ts").cast("date").alias("event_date"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        """Posts with a publish date, status and counters."""
        price = F.floor("o_totalprice").cast("bigint")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("post_id"),
            F.concat(F.lit("Post "), F.col("o_orderkey").cast("string")).alias("title"),
            F.concat(F.lit("author_"), F.col("o_custkey").cast("string")).alias("author"),
            F.col("o_orderpriority").alias("category"),
            F.concat(F.lower("o_orderstatus"), F.lit(" , "), F.col("o_orderpriority")).alias("tags"),
            (price % 5000).alias("views"),
            (price % 500).alias("likes"),
            (price % 60).alias("comments"),
            F.col("o_orderdate").cast("date").alias("publish_date"),
            relabel("o_orderstatus", STATUS_OF_ORDER).alias("status"),
        )

    @cached_property
    def articles(self) -> DataFrame:
        """Posts with comma-separated tags; post_id matches the access log."""
        return self.raw("part").select(
            F.col("p_partkey").alias("post_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            F.col("p_type").alias("category"),
            F.expr("replace(p_name, ' ', ', ')").alias("tags"),
            F.floor("p_retailprice").cast("bigint").alias("views"),
            F.col("p_size").cast("bigint").alias("likes"),
        )

    @cached_property
    def users(self) -> DataFrame:
        customer, nation = self.raw("customer"), self.raw("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("register_date"),
        )

    @cached_property
    def docs(self) -> DataFrame:
        return self.raw("documents")


# The same tables for the checking engine.
SQL_TABLES = {
    "logs": """
  SELECT event_id AS log_id, nullif(user_id, 0) AS user_id, k AS post_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'like' WHEN 'purchase' THEN 'comment'
                         WHEN 'signup' THEN 'share' WHEN 'error' THEN 'search' END AS action,
         '10.0.' || k || '.1' AS ip,
         CASE k % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
         value AS duration, ts AS event_time, CAST(ts AS DATE) AS event_date
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events)""",
    "posts": """
  SELECT o_orderkey AS post_id, 'Post ' || o_orderkey AS title, 'author_' || o_custkey AS author,
         o_orderpriority AS category, lower(o_orderstatus) || ' , ' || o_orderpriority AS tags,
         price % 5000 AS views, price % 500 AS likes, price % 60 AS comments,
         CAST(o_orderdate AS DATE) AS publish_date,
         CASE o_orderstatus WHEN 'O' THEN 'published' WHEN 'F' THEN 'archived' WHEN 'P' THEN 'draft' END AS status
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders)""",
    "articles": """
  SELECT p_partkey AS post_id, p_name AS title, p_brand AS author, p_type AS category,
         replace(p_name, ' ', ', ') AS tags, CAST(floor(p_retailprice) AS BIGINT) AS views,
         CAST(p_size AS BIGINT) AS likes
  FROM part""",
    "users": """
  SELECT c_custkey AS user_id, c_name AS username, n_name AS city, c_mktsegment AS segment, c_acctbal AS balance,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS register_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "docs": "SELECT * FROM documents",
}
