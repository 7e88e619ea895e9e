"""Running tables with one row per key, kept in buckets of which each batch rewrites only those it touches.

A bucket is a folder below that of the batch that wrote it last. A batch reads the buckets its keys fall into, combines them with its
rows, writes them below its own number and then deletes the folders they replace. A batch that is run again after a failure
finds either its finished write or the buckets as they were, so it has the same effect twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressbeat.operators.rollup import replace_latest, requery
from pressbeat.storage import exists, persisted, remove, subfolders

BUCKETS = 8
BUCKET, BATCH, NEWER = "_bucket", "_batch", "_newer"
Combine = Callable[[DataFrame, Sequence[str]], DataFrame]


def number(folder: str) -> int:
    return int(folder.split("=", 1)[1])


def newest(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> the batch (below ``before``) that wrote it last: at most as many entries as there are buckets."""
    found: dict[int, int] = {}
    for batch in sorted(number(f) for f in subfolders(spark, path) if f.startswith(f"{BATCH}=")):
        if (before is None or batch < before) and exists(spark, f"{path}/{BATCH}={batch}/_SUCCESS"):
            for folder in subfolders(spark, f"{path}/{BATCH}={batch}"):
                if folder.startswith(f"{BUCKET}="):
                    found[number(folder)] = batch
    return found


def read_keyed(spark: SparkSession, schema: T.StructType, path: str, before: int | None = None, with_bucket: bool = False) -> DataFrame:
    """The table as the last finished batch (below ``before``) left it."""
    folders = [f"{path}/{BATCH}={batch}/{BUCKET}={bucket}" for bucket, batch in newest(spark, path, before).items()]
    kind = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    rows = spark.read.schema(kind).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], kind)
    return rows.drop(BATCH) if with_bucket else rows.drop(BATCH, BUCKET)


def replaced(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changed row of each key where there is one."""
    return replace_latest(rows, keys, NEWER).drop(NEWER)


def summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive columns of rows of one key added up."""
    return requery(rows, keys, [c for c in rows.columns if c not in (*keys, NEWER)])


def merge_batch(changes: DataFrame, batch: int, path: str, keys: Sequence[str], combine: Combine = replaced, buckets: int = BUCKETS) -> None:
    """Bring the rows of one batch into the table at ``path``."""
    spark, here = changes.sparkSession, f"{path}/{BATCH}={batch}"
    if not exists(spark, f"{here}/_SUCCESS"):
        placed = changes.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        if newest(spark, path, batch):
            with persisted(placed) as new:
                # as many rows as buckets
                touched = F.broadcast(new.select(BUCKET).distinct())
                old = read_keyed(spark, changes.schema, path, batch, with_bucket=True).join(touched, BUCKET, "left_semi")
                both = old.withColumn(NEWER, F.lit(0)).unionByName(new.withColumn(NEWER, F.lit(1)))
                write(combine(both, [*keys, BUCKET]), here)
        else:
            write(combine(placed.withColumn(NEWER, F.lit(1)), [*keys, BUCKET]), here)
    written = set(subfolders(spark, here))
    for folder in subfolders(spark, path):
        if folder.startswith(f"{BATCH}=") and number(folder) < batch:
            left = {f for f in subfolders(spark, f"{path}/{folder}") if f.startswith(f"{BUCKET}=")}
            for bucket in left & written:
                remove(spark, f"{path}/{folder}/{bucket}")
            if left <= written:
                remove(spark, f"{path}/{folder}")


def write(rows: DataFrame, here: str) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(here)
