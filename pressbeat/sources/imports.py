"""Typed batch imports of facts and daily summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.sources.files import read_csv, split_corrupt, write_out

FACT_SCHEMA = "log_id bigint, user_id bigint, post_id int, action string, ip string, device string, event_time timestamp"
DAILY_SCHEMA = (
    "event_date date, total_pv bigint, total_uv bigint, new_users bigint, new_posts bigint,"
    " total_comments bigint, total_likes bigint, bounce_rate double, avg_duration double"
)


def quarantine_of(target: str) -> str:
    return f"{target.rstrip('/')}.rejected"


def import_table(spark: SparkSession, csv_path: str, schema: str, target: str, mode: str = "append") -> DataFrame:
    """CSV rows of the declared types into a Parquet table; rows that do not fit go to :func:`quarantine_of` it."""
    good, bad = split_corrupt(read_csv(spark, csv_path, schema))
    write_out(good, target, "parquet", mode)
    write_out(bad, quarantine_of(target), "parquet", mode)
    return spark.read.parquet(target)


def import_counts(spark: SparkSession, target: str) -> DataFrame:
    """(result, rows) of what :func:`import_table` took in and rejected."""
    rows = F.count(F.lit(1)).alias("rows")
    sides = {"imported": target, "rejected": quarantine_of(target)}
    parts = [spark.read.parquet(path).agg(rows).select(F.lit(name).alias("result"), "rows") for name, path in sides.items()]
    return parts[0].union(parts[1])


def import_logs(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    return import_table(spark, csv_path, FACT_SCHEMA, target)


def import_daily(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    return import_table(spark, csv_path, DAILY_SCHEMA, target)
