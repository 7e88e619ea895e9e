"""Shared scratch space: intermediate tables that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

LEVELS = ("MEMORY_ONLY", "MEMORY_AND_DISK", "DISK_ONLY", "MEMORY_AND_DISK_2", "OFF_HEAP")


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pressbeat-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage and freezes the rows.

    A written table survives the loss of executors and, unlike a cached one, lets later reads
    prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


UNKNOWN_BYTES = 1 << 60


def pieces_by_size(df: DataFrame, bytes_each: int, least: int = 4) -> int:
    """How many pieces of ``bytes_each`` bytes ``df`` makes, by its estimated size and not by any setting.

    The optimizer takes a join for the product of its sides, so the estimate is held to four times what the plan reads. Rows
    that come from no stored table have no size; then the session's shuffle partitions have to do.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if any(size >= UNKNOWN_BYTES for size in sizes):
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, min(estimated_bytes(df), 4 * sum(sizes)) // bytes_each)


SPREAD_BYTES_PER_CORE = 16 * 1024 * 1024


def use_all_cores(df: DataFrame) -> DataFrame:
    """Spread a small input over the cores before costly per-row work.

    A small file may be a single split, which would leave one core busy. An input with more than 16 MB
    per core has splits enough and is returned as it is, so no large table is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or estimated_bytes(df) > cores * SPREAD_BYTES_PER_CORE:
        return df
    return df.repartition(cores)


@contextmanager
def persisted(df: DataFrame, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """``df`` kept by the executors inside the block and released after it.

    Kept rows are worked out again when their executor is lost; :func:`materialize` keeps them for good.
    """
    if level not in LEVELS:
        raise ValueError(f"unknown storage level {level!r}")
    kept = df.persist(getattr(StorageLevel, level))
    try:
        yield kept
    finally:
        kept.unpersist()


def file_system(spark: SparkSession, path: str):
    """The store that holds ``path``, and the path as the store names it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none where it does not exist."""
    store, named = file_system(spark, path)
    if not store.exists(named):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(named) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    store, named = file_system(spark, path)
    return store.exists(named)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making."""
    store, named = file_system(spark, path)
    store.delete(named, True)
