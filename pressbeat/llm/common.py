"""What the operators share: tables, words, free column names, frozen row numbers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.storage import materialize, scratch_path, scratch_root

#: ASCII white space, the word separator of every operator here.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null counted as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none of an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, whatever ``use`` does with it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` with a row number that is written once, so that it stays the same in every later read."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), label)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that materialize() wrote and no later step reads."""
    spark = df.sparkSession
    root = scratch_root(spark)
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if root.split(":", 1)[-1].rstrip("/") + "/" not in folder:
            raise ValueError(f"not a scratch table: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lengthy(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes, or one row that is longer."""
    for batch in batches:
        pieces = max(1, -(-batch.nbytes // most))
        step = max(1, -(-batch.num_rows // pieces))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


#: Ids that a broadcast may hold: 8 MB of them.
MOST_BROADCAST = 1_000_000


def bounded_broadcast(ids: DataFrame, label: str) -> DataFrame:
    """One column of ids, written and counted: up to MOST_BROADCAST they are to be broadcast, more are joined by a shuffle."""
    listed = materialize(ids, label)
    return F.broadcast(listed) if listed.count() <= MOST_BROADCAST else listed


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` less the rows whose ``key`` is in the one column of ``ids``; rows without a key stay.

    Up to MOST_BROADCAST ids are broadcast and no text is shuffled.
    """
    gone = free_name(docs, "gone_id")
    side = bounded_broadcast(ids.toDF(gone).filter(F.col(gone).isNotNull()).distinct(), "ids")
    return docs.join(side, docs[key].cast("bigint") == side[gone], "left_anti")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, in the way Spark distributes Python files."""
    context = spark.sparkContext
    if getattr(context, "_pressbeat_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="pressbeat-py-"), "pressbeat.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._pressbeat_shipped = True


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


__all__ = ["SPACE", "SPACES", "bounded_broadcast", "discard", "free_name", "lengthy", "let", "map_arrow", "materialize", "numbered", "scratch_path", "ship", "table", "text_of", "without", "words_of"]
