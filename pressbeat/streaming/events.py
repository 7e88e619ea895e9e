"""From raw records to events: both record shapes, event time, watermark. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.sources.events import END_ACTION

PAYLOAD = "postId int, userId string, ip string, content string, keyword string, duration double"
RECORD = (
    f"eventId string, eventType string, type string, timestamp string, event_time string, {PAYLOAD}, data struct<"
    + PAYLOAD.replace(" int", ": int").replace(" string", ": string").replace(" double", ": double")
    + ">"
)
DELAY = "10 seconds"


def event_time_of(text: Column) -> Column:
    """ISO text with or without a zone, or epoch milliseconds; NULL when neither fits."""
    return F.coalesce(F.try_to_timestamp(text), F.timestamp_millis(text.try_cast("bigint")))


def parse_events(records: DataFrame) -> DataFrame:
    """Typed events from nested or flat JSON; unreadable fields are NULL, a missing type is 'unknown'."""
    parsed = records.withColumn("r", F.from_json("value", RECORD))

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"r.data.{name}"), F.col(f"r.{name}"))

    return parsed.select(
        F.col("r.eventId").alias("event_id"),
        F.coalesce("r.eventType", "r.type", F.lit("unknown")).alias("action"),
        either("postId").alias("post_id"),
        either("userId").alias("user_id"),
        either("content").alias("content"),
        either("keyword").alias("keyword"),
        either("duration").alias("duration"),
        event_time_of(F.coalesce("r.timestamp", "r.event_time")).alias("event_time"),
        "value",
    )


def valid(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_time").isNotNull())


def quarantine(events: DataFrame) -> DataFrame:
    """Records without a usable event time, with their text."""
    return events.filter(F.col("event_time").isNull()).select("value")


def timed(events: DataFrame, end: str | None = None, delay: str = DELAY) -> DataFrame:
    """Events with a watermark.

    ``end`` is the time of the end-of-input record. The watermark has to see that record before it is
    dropped, and the optimizer moves a filter below the watermark unless it reads the event time; so
    the other columns are made to depend on it.
    """
    marked = valid(events).drop("value").withWatermark("event_time", delay)
    if end is None:
        return marked.filter(F.col("action") != END_ACTION)
    inside = F.col("event_time") < F.lit(end).cast("timestamp")
    return marked.withColumns({c: F.when(inside, F.col(c)) for c in marked.columns if c != "event_time"}).filter(inside)
