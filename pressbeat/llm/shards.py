"""Shards by a two-pass external shuffle.

The first pass scatters the records uniformly into buckets by a seeded hash; the number of buckets follows from the counted bytes, so
that a bucket fits in a task's memory. The second pass brings each bucket into one task, shuffles it by Fisher-Yates and writes it. The order is
that of the buckets one after another; shard s is the s-th of equal runs of it, so the law is ``rows``: counts are at most one apart.

The hash is over the seed, the name of the record's file and its place there, so copies, rows of one id and rows without one scatter
like all others, and a repeated task or a second read of the table draws the same. A table that is not read straight from files is
written once first. Within a bucket the records are put in the order of their hashes before they are shuffled, so the result does
not depend on the order of their arrival; it depends on the files, and on the seed.

Defined cases: null and empty texts have no bytes; a bucket holds at least one whole record, however long; with fewer records than
shards the last shards are empty; an empty table makes no file. Records are written as one struct column, so their columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from pressbeat.llm.common import map_arrow, materialize, scratch_path, text_of

BUCKET_BYTES = 64 << 20
#: Beyond so many buckets their offsets are joined by a shuffle instead of a broadcast.
MOST_BROADCAST = 1_000_000


def located(docs: DataFrame, seed: int) -> DataFrame:
    """(key, record): a hash of the record's place in its file, and the record."""

    def draw(frame: DataFrame) -> DataFrame:
        place = frame.metadataColumn("_metadata")
        return frame.select(F.xxhash64(F.lit(seed), place["file_name"], place["row_index"]).alias("key"), F.struct(*[frame[f"`{c}`"] for c in frame.columns]).alias("record"))

    try:
        return draw(docs)
    except AnalysisException:  # not the rows of files as they are
        return draw(materialize(docs, "records"))


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0 to n - 1."""
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)) if n > 1 else ()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def place_of(position: np.ndarray, total: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard and the slot of places in the whole order: the first ``total % shards`` shards hold one record more."""
    each, more = divmod(total, shards)
    wide = more * (each + 1)
    late = position >= wide
    shard = np.where(late, more + (position - wide) // max(each, 1), position // (each + 1))
    start = shard * each + np.minimum(shard, more)
    return shard, position - start


def write_shards(docs: DataFrame, path: str, shards: int = 24, bucket_bytes: int = BUCKET_BYTES, seed: int = 12) -> None:
    """Write all records to ``path``/shard=s as (slot, record), each file in the order of its slots."""
    rows = located(docs, seed)
    sizes = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_of()) + 8).alias("bytes")).first()
    total, buckets = sizes.n, max(1, -(-(sizes.bytes or 0) // bucket_bytes))
    named = rows.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    # one row for each bucket
    counts = named.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("start")), "starts")
    known = named.join(F.broadcast(starts) if buckets <= MOST_BROADCAST else starts, "bucket")

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        bucket = pa.Table.from_batches(held)
        rng = np.random.default_rng([seed, bucket.column("bucket")[0].as_py()])
        arrived = np.argsort(bucket.column("key").to_numpy(), kind="stable")
        order = arrived[fisher_yates(bucket.num_rows, rng)]
        shard, slot = place_of(bucket.column("start")[0].as_py() + np.arange(bucket.num_rows), total, shards)
        record = bucket.column("record")
        for at in range(0, len(order), 1000):
            taken = record.take(pa.array(order[at : at + 1000])).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(shard[at : at + 1000], pa.int32()), pa.array(slot[at : at + 1000], pa.int64()), taken], ["shard", "slot", "record"])

    kind = StructType().add("shard", "integer").add("slot", "long").add(rows.schema["record"])
    dealt = map_arrow(known.select("bucket", "key", "start", "record").repartitionById(buckets, F.col("bucket")), shuffle, kind)
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, record: StructType) -> DataFrame:
    """shard, slot and record of the files that write_shards() wrote."""
    kind = StructType().add("slot", "long").add("record", record).add("shard", "integer")
    return spark.read.schema(kind).parquet(path)


def reports(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shuffle the records into shards, and read back where each is, with the size and the crc32 of its text."""
    path = scratch_path(docs.sparkSession, "shards")
    write_shards(docs, path, shards)
    back = read_shards(docs.sparkSession, path, docs.schema)
    text = F.coalesce(F.col("record.text").cast("string"), F.lit(""))
    return back.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
