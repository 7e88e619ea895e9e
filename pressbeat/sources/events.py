"""Event records and the topics they travel on: Kafka where its connector is installed, files elsewhere."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.storage import file_system, pieces_by_size, scratch_path

FILE_BYTES = 64 * 1024 * 1024
RECORD_SCHEMA = "key string, value string"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
END_ACTION = "end-of-input"
# Starting points of a topic: option name and value of the Kafka source.
START_OPTIONS = {
    "earliest": ("startingOffsets", "earliest"),
    "latest": ("startingOffsets", "latest"),
    "offsets": ("startingOffsets", None),
    "timestamp": ("startingTimestamp", None),
}


def iso_time(column: str = "event_time") -> Column:
    return F.date_format(column, TIME_FORMAT)


def to_event_records(logs: DataFrame, shape: str = "nested") -> DataFrame:
    """(key, value, event_time) per log row; keyed by post, searches unkeyed.

    ``nested`` is the envelope with a ``data`` object, ``flat`` the one-level form.
    """
    search = F.col("action") == "search"
    post = F.when(~search, F.col("post_id"))
    keyword = F.when(search, F.concat(F.lit("kw"), F.col("post_id").cast("string")))
    user = F.col("user_id").cast("string")
    if shape == "nested":
        value = F.struct(
            F.concat(F.lit("evt_"), F.col("log_id").cast("string")).alias("eventId"),
            F.col("action").alias("eventType"),
            F.lit("1.0").alias("version"),
            iso_time().alias("timestamp"),
            F.lit("log-replay").alias("source"),
            F.struct(post.alias("postId"), user.alias("userId"), F.col("ip"), keyword.alias("keyword"), F.col("duration")).alias("data"),
        )
    elif shape == "flat":
        value = F.struct(
            F.col("action").alias("type"), post.alias("postId"), user.alias("userId"), keyword.alias("keyword"),
            F.col("duration"), iso_time().alias("event_time"),
        )
    else:
        raise ValueError(f"unknown record shape {shape!r}")
    return logs.select(post.cast("string").alias("key"), F.to_json(value).alias("value"), "event_time")


def publish(records: DataFrame, path: str, slices: int = 3, files: int | None = None, order: list[int] | None = None) -> str:
    """Append the records to a file topic in ``slices`` steps of event time.

    A slice is written as one file per 64 MB of the records' estimated size, four at least, unless ``files`` says otherwise.
    ``order`` replays the slices in another order, which makes the earlier ones late.
    """
    files = files or pieces_by_size(records, slices * FILE_BYTES)
    cuts = [i / slices for i in range(1, slices)]
    # slices - 1 numbers reach the driver
    marks = records.agg(F.percentile_approx(F.unix_micros("event_time"), cuts)).first()[0] if cuts else []
    micros = F.unix_micros("event_time")
    edges = [None, *marks, None]
    for step, i in enumerate(order or range(slices)):
        if step:
            # the reader orders files by modification time, which some stores keep in whole seconds
            time.sleep(1)
        low, high = edges[i], edges[i + 1]
        piece = records
        if low is not None:
            piece = piece.filter(micros > low)
        if high is not None:
            piece = piece.filter(micros <= high)
        piece.select("key", "value").repartition(files).write.mode("append").parquet(path)
    return path


def publish_in_order(records: DataFrame, path: str, steps: int, each: int = 1) -> str:
    """Append the records to a file topic in ``steps`` steps of event time, each of ``each`` files that tasks write and read side by side.

    The reader takes files by their modification times, which are set a second apart up to now; the names of all files pass the driver. Where
    many records have one time there are fewer files; empty ones then fill the last step, so that a later file is in a step of its own.
    """
    spark = records.sparkSession
    staged = scratch_path(spark, "ordered")
    ranged = records.repartitionByRange(steps * each, "event_time").sortWithinPartitions("event_time")
    ranged.select("key", "value").write.parquet(staged)
    target, last = spark._jvm.org.apache.hadoop.fs.Path(path), int(time.time()) - 1
    store, parts = _parts(spark, staged)
    store.mkdirs(target)
    for _ in range(-len(parts) % each):
        empty = scratch_path(spark, "ordered")
        spark.createDataFrame([], RECORD_SCHEMA).write.parquet(empty)
        parts += _parts(spark, empty)[1]
    for i, part in enumerate(parts):
        moved = spark._jvm.org.apache.hadoop.fs.Path(target, f"{i:06d}-{part.getName()}")
        store.rename(part, moved)
        store.setTimes(moved, (last - len(parts) + i) * 1000, -1)
    return path


def _parts(spark: SparkSession, path: str) -> tuple:
    """The store of a written folder, and its part files in the order of their tasks."""
    store, folder = file_system(spark, path)
    found = [s.getPath() for s in store.listStatus(folder)]
    return store, sorted((p for p in found if p.getName().startswith("part-")), key=lambda p: p.getName())


def publish_end(spark: SparkSession, path: str, at: str) -> None:
    """A last record that carries the watermark past every open window, as a bounded input's end does."""
    time.sleep(1)
    value = f'{{"eventId":"{END_ACTION}","eventType":"{END_ACTION}","timestamp":"{at}","data":{{}}}}'
    spark.createDataFrame([(None, value)], RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_events(spark: SparkSession, source: str, fmt: str = "files", files_per_trigger: int = 4, start: str = "earliest", at: str | None = None, **options) -> DataFrame:
    """Streaming (key, value) records from a topic.

    ``fmt='kafka'``: ``source`` is the topic, ``options`` carry ``kafka.bootstrap.servers``; ``start`` is
    earliest, latest, offsets or timestamp (the last two with ``at``). ``fmt='files'``: ``source`` is a folder.
    """
    if fmt == "kafka":
        option, value = START_OPTIONS[start]
        reader = spark.readStream.format("kafka").option("subscribe", source).option(option, value or at).options(**options)
        return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
    if fmt != "files":
        raise ValueError(f"unknown topic format {fmt!r}")
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).options(**options).parquet(source)


def kafka_rows(records: DataFrame, topic: str | None = None) -> DataFrame:
    """What the Kafka sink takes: key and value as bytes, a record without a post keyless, so that it goes to any partition."""
    named = [F.lit(topic).alias("topic")] if topic else []
    return records.select(*named, F.col("key").cast("binary").alias("key"), F.encode("value", "UTF-8").alias("value"))


def kafka_options(servers: str, topic: str | None = None, acks: str = "all", **more: str) -> dict[str, str]:
    """Options of the Kafka sink: every record acknowledged by all replicas and not doubled by the producer's own retries."""
    if not servers:
        raise ValueError("the sink needs at least one server")
    options = {"kafka.bootstrap.servers": servers, "kafka.acks": acks, "kafka.enable.idempotence": "true" if acks == "all" else "false"}
    if topic:
        options["topic"] = topic
    return options | more


def write_events(records: DataFrame, target: str, fmt: str = "files", servers: str = "", checkpoint: str | None = None, every: str | None = None, **options: str):
    """Send (key, value) records to a topic: a folder, or with ``fmt='kafka'`` a topic of that name.

    A batch frame is appended; a streaming one needs a ``checkpoint`` and gives its running query, a batch ``every`` so often or all there is now.
    Delivery is at least once; readers drop repeated event ids (``streaming.windows.once``).
    """
    if fmt == "kafka":
        rows, options, name = kafka_rows(records), kafka_options(servers, target, **options), "kafka"
    elif fmt == "files":
        rows, options, name = records.select("key", "value"), {**options, "path": target}, "parquet"
    else:
        raise ValueError(f"unknown topic format {fmt!r}")
    if not records.isStreaming:
        return rows.write.format(name).mode("append").options(**options).save()
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = rows.writeStream.format(name).outputMode("append").options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
