"""Views, tables and partitions in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def persist_view(spark: SparkSession, name: str, select: str) -> None:
    """A view that the catalog keeps, for all sessions that share it; its text may name tables and files, not temporary views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def show_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def add_partition(spark: SparkSession, table: str, spec: dict[str, str]) -> None:
    pairs = ", ".join(f"{k}='{v}'" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({pairs})")


def partition_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column with its position and type, beside the row count."""
    types = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type")) for i, (n, t) in enumerate(df.dtypes)])
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.inline(types))
