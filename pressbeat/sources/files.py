"""File sources and sinks: CSV, JSON, text, Parquet, ORC, binary listings, partitioned and bucketed writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


CORRUPT = "_corrupt_record"
SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")
FORMATS = ("parquet", "orc", "csv", "json", "text")


def read_csv(spark: SparkSession, path, schema: T.StructType | str, corrupt_column: str | None = CORRUPT, **options) -> DataFrame:
    """CSV with a declared schema, bound by position. Malformed rows are kept in ``corrupt_column``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    defaults = {"header": True, "mode": "PERMISSIVE", "encoding": "UTF-8", "enforceSchema": True}
    if corrupt_column:
        defaults["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.options(**{**defaults, **options}).schema(schema).csv(path)


def read_csv_infer(spark: SparkSession, path, sep=",", quote='"', escape="\\", null_value="", date_format="yyyy-MM-dd", **options) -> DataFrame:
    """CSV whose types are taken from the data; costs one more pass over the files."""
    given = dict(header=True, inferSchema=True, sep=sep, quote=quote, escape=escape, nullValue=null_value, dateFormat=date_format)
    return spark.read.options(**{**given, **options}).csv(path)


def split_corrupt(df: DataFrame, corrupt_column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows), whatever columns are used later.

    A CSV scan judges only the columns it reads. The second condition holds for every row; it keeps all columns in the scan.
    """
    whole = F.xxhash64(*df.columns) >= F.lit(-(2**63)).cast("bigint")
    judged = df.filter(whole)
    return (
        judged.filter(F.col(corrupt_column).isNull()).drop(corrupt_column),
        judged.filter(F.col(corrupt_column).isNotNull()),
    )


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None, multiline: bool = False, **options) -> DataFrame:
    reader = spark.read.options(multiLine=multiline, **options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_text(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path, columns: list[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Parquet with the filter and the column list stated first, so that both reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def write_out(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    compression: str | None = None,
    **options,
) -> None:
    if fmt not in FORMATS or mode not in SAVE_MODES:
        raise ValueError(f"format {fmt!r} or mode {mode!r} is not supported")
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        options.setdefault("header", True)
    if compression:
        options["compression"] = compression
    writer = writer.options(**options) if options else writer
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "append") -> None:
    """Partitioned Parquet: rows of one partition value come together, a value of many rows in several tasks."""
    write_out(gathered(df, columns), path, "parquet", mode, partition_by=columns)


def gathered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows brought together by ``columns``; adaptive execution splits a large value and joins small ones by their size."""
    return df.hint("rebalance", *columns)


def load_partitioned(df: DataFrame, path: str, derive: dict[str, Column], mode: str = "overwrite") -> None:
    """Staged rows into a table partitioned by derived columns; only the partitions present are replaced."""
    spread = gathered(df.withColumns(derive), list(derive))
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*derive).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, column: str, sort: str | None = None, mode: str = "overwrite") -> None:
    """Bucketed, sorted table: joins and aggregates on ``column`` need no further shuffle."""
    writer = df.write.mode(mode).option("path", path).bucketBy(buckets, column)
    writer.sortBy(sort or column).saveAsTable(table)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet", max_rows: int = 1_000_000) -> None:
    """One output file, for results proven small; a larger result is refused, not cut."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows: write several files instead")
    write_out(df.coalesce(1), path, fmt)


def chunk_aggregate(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` per chunk; a chunk is one Arrow batch of a partition, never a whole partition."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(chunks, schema)


def list_objects(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Objects below ``path`` whose name starts with ``prefix``: name, size, modification time.

    Only the listing columns are selected, so file contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    return listed.filter(F.col("name").startswith(prefix))


def object_totals(objects: DataFrame) -> DataFrame:
    return objects.agg(F.count(F.lit(1)).alias("objects"), F.sum("bytes").alias("bytes"), F.max("modified").alias("latest"))


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table from rows, tuples or a pandas frame."""
    return spark.createDataFrame(rows, schema)


def to_pandas(df: DataFrame, columns: list[str], n: int) -> pd.DataFrame:
    """The hand-off to pandas is bounded by a row count the caller states."""
    return df.select(*columns).limit(n).toPandas()
