"""Run a streaming frame live, at a pace, or over everything its source holds now, and hand back the written result.

Results are written below the shared scratch root by the tasks; nothing but batch numbers passes the
driver. A batch that is run again after a failure replaces its own folder, so every sink is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pressbeat.session import derived_session
from pressbeat.storage import scratch_path
from pressbeat.streaming.keyed import BUCKETS, merge_batch, read_keyed, replaced, summed

BYTES_PER_STATE_PARTITION = 64 * 1024 * 1024
#: How often a live stream starts a batch.
EVERY = "30 seconds"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, input_bytes: int, rocks: bool = True, **settings: str) -> SparkSession:
    """A session for streams over ``input_bytes``; the caller's own is left as it is.

    With ``rocks`` state is in RocksDB, on the executors' disks and in the checkpoint, so its size is not bound by their memory; windows that close behind a
    watermark keep little and do without, timers need it. The number of state partitions is fixed when a checkpoint begins, and adaptive execution does not merge them: one per 64 MB of input, at least one per core and at
    most the shuffle partitions of ``spark``.
    """
    setting = "spark.sql.shuffle.partitions"
    number = min(int(spark.conf.get(setting)), max(spark.sparkContext.defaultParallelism, input_bytes // BYTES_PER_STATE_PARTITION))
    store = {"spark.sql.streaming.stateStore.providerClass": ROCKS} if rocks else {}
    return derived_session(spark, **{setting: str(number), **store, **settings})


def paced(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A batch ``every`` so often, or all there is now in as many batches as it takes and then the end."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def finish(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for a bounded run, without a limit unless the caller sets one; raises what the query raised, or on a time-out."""
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


def append_to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """A bounded run that has ended or, with ``every``, a live query."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    query = paced(writer, every).start(path)
    return query if every else finish(query)


def run_append(stream: DataFrame) -> DataFrame:
    """Closed results only, each written once; state is dropped as the watermark passes."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "append")
    append_to_parquet(stream, path, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, mode: str, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch into its own ``batch=N`` folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return finish(paced(writer, None).start())


def batches(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).option("basePath", path).parquet(path)


def upsert(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str, mode: str = "update", every: str | None = EVERY, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the table at ``path`` at the newest row of each key: a live query, or a bounded run that has ended if ``every`` is None."""

    def write(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, path, keys, replaced, buckets)

    query = paced(stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write), every).start()
    return query if every else finish(query)


def run_upsert(stream: DataFrame, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """The newest row per key after all the input there is."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "upsert")
    upsert(stream, keys, path, scratch_path(spark, "checkpoint"), mode, every=None)
    return read_keyed(spark, stream.schema, path)


def run_complete(stream: DataFrame) -> DataFrame:
    """The whole result table of the last batch."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "complete")
    run_batches(stream, "complete", path, scratch_path(spark, "checkpoint"))
    written = batches(spark, stream.schema, path)
    newest = written.agg(F.max("batch")).scalar()
    return written.filter(F.col("batch") == newest).drop("batch")


def run_rollup(stream: DataFrame, delta: Callable[[DataFrame], DataFrame], keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """A summary table to which each batch's summary is added, key by key."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "rollup")
    kinds = []

    def write(batch: DataFrame, number: int) -> None:
        change = delta(batch)
        kinds.append(change.schema)
        merge_batch(change, number, path, keys, summed, buckets)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", scratch_path(spark, "checkpoint")).foreachBatch(write)
    finish(paced(writer, None).start())
    return read_keyed(spark, kinds[-1] if kinds else delta(spark.createDataFrame([], stream.schema)).schema, path)


def run_console(stream: DataFrame, mode: str = "update", rows: int = 20) -> StreamingQuery:
    """Prints each batch, for a look while developing."""
    return finish(stream.writeStream.outputMode(mode).format("console").option("numRows", rows).trigger(availableNow=True).start())
