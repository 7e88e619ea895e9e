"""Windowed and running statistics; the same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.operators.traffic import HEAT_WEIGHTS, action_count, tier


def flat_window(df: DataFrame) -> DataFrame:
    """The window struct as two columns without a time zone."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"), *rest
    )


def tumbling(events: DataFrame, size: str, keys: Sequence[str], **measures: Column) -> DataFrame:
    measures = measures or {"n": F.count(F.lit(1))}
    grouped = events.groupBy(F.window("event_time", size), *keys)
    return flat_window(grouped.agg(*[c.alias(n) for n, c in measures.items()]))


def hopping(events: DataFrame, size: str, slide: str, keys: Sequence[str]) -> DataFrame:
    grouped = events.groupBy(F.window("event_time", size, slide), *keys)
    return flat_window(grouped.agg(F.count(F.lit(1)).alias("n")))


def sessions(events: DataFrame, gap: str, keys: Sequence[str]) -> DataFrame:
    """Activity separated by more than ``gap``; the session ends ``gap`` after its last event."""
    grouped = events.groupBy(F.session_window("event_time", gap).alias("window"), *keys)
    return flat_window(grouped.agg(F.count(F.lit(1)).alias("n")))


def cumulating(events: DataFrame, step: str, size: str, steps: int, keys: Sequence[str]) -> DataFrame:
    """Counts from the start of each ``size`` window to the end of each of its ``steps`` steps.

    Events are first counted per step; only those counts are repeated for the later steps.
    """
    per_step = events.groupBy(F.window("event_time", step), *keys).agg(F.count(F.lit(1)).alias("n"))
    at = per_step.select(F.window_time("window").alias("event_time"), F.col("window.end").alias("step_end"), *keys, "n")
    spread = at.withColumn("later", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    placed = spread.withColumn("upto", F.col("step_end") + F.expr(f"later * interval {step}"))
    grouped = placed.groupBy(F.window("event_time", size), "upto", *keys).agg(F.sum("n").alias("n"))
    # a step never reaches beyond its own window
    inside = grouped.filter(F.col("upto") <= F.col("window.end"))
    return inside.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("upto").cast("timestamp_ntz").alias("window_end"), *keys, "n"
    )


def counts_by(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def once(events: DataFrame, key: str, spread: int = 16) -> DataFrame:
    """One event per key although the reader may deliver it again (within the watermark delay).

    Copies are first dropped per key and share of the tasks, so the many copies of one event do not
    all meet in one task.
    """
    shared = events.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(spread)))
    return shared.dropDuplicatesWithinWatermark([key, "_share"]).drop("_share").dropDuplicatesWithinWatermark([key])


def visitors(events: DataFrame, key: str) -> DataFrame:
    """Running table of (key, user) with its last event time; distinct users per key are its row counts.

    An aggregate, unlike a streaming deduplication, combines a very active user's rows before the shuffle.
    """
    return events.filter(F.col("user_id").isNotNull()).groupBy(key, "user_id").agg(F.max("event_time").alias("latest"))


def longest_by(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(
        F.max("duration").alias("longest"), F.min("duration").alias("shortest"), F.round(F.sum("duration"), 4).alias("total")
    )


def post_pivot(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Views, comments and likes per post and window."""
    measures = {"views": action_count("view"), "comments": action_count("comment"), "likes": action_count("like")}
    return tumbling(events.filter(F.col("post_id").isNotNull()), size, ["post_id"], **measures)


def hot_tiers(events: DataFrame, hot: int = 100, warm: int = 50) -> DataFrame:
    counted = counts_by(events.filter(F.col("action") == "view"), "post_id")
    return counted.withColumn("level", tier(F.col("n"), [(hot, "hot"), (warm, "warm")], "normal"))


def heat(events: DataFrame, weights: dict[str, int] = HEAT_WEIGHTS) -> DataFrame:
    weight = F.lit(1)
    for action, value in weights.items():
        weight = F.when(F.col("action") == action, value).otherwise(weight)
    return events.groupBy("post_id").agg(F.sum(weight).alias("heat"))
