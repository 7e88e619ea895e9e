"""Summary tables kept up to date by adding the summary of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.operators.traffic import action_count, with_city

DAY_KEYS = ("event_date", "city", "device")
POST_KEYS = ("post_id", "event_date")


def day_rollup(logs: DataFrame, users: DataFrame) -> DataFrame:
    """Additive daily counters per city and device; ``uv`` is additive only within one delta.

    The log is reduced to one row per day, device and user before it meets the users; visitors are then rows.
    """
    per_user = logs.filter(F.col("user_id").isNotNull()).groupBy("event_date", "device", "user_id").agg(
        F.count(F.lit(1)).alias("pv"),
        action_count("comment").alias("comments"),
        action_count("like").alias("likes"),
        action_count("share").alias("shares"),
    )
    return with_city(per_user, users).groupBy(*DAY_KEYS).agg(
        F.sum("pv").alias("pv"),
        F.count(F.lit(1)).alias("uv"),
        F.sum("comments").alias("comments"),
        F.sum("likes").alias("likes"),
        F.sum("shares").alias("shares"),
    )


def post_rollup(logs: DataFrame) -> DataFrame:
    return logs.groupBy(*POST_KEYS).agg(
        action_count("view").alias("views"),
        action_count("comment").alias("comments"),
        action_count("like").alias("likes"),
        action_count("share").alias("shares"),
    )


def rollup_merge(old: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal key summed; both sides are summaries, so only summaries are shuffled."""
    measures = [c for c in old.columns if c not in keys]
    return old.unionByName(delta).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def requery(rollup: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return rollup.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def sketch_rollup(logs: DataFrame, keys: Sequence[str], lg_k: int = 14) -> DataFrame:
    """Counters with a mergeable visitor sketch in place of a visitor count.

    A Theta sketch is a sample of the visitors' hashes below a threshold of its own, so sketches give overlaps and differences besides unions; up
    to ``2 ** lg_k`` visitors are counted exactly.
    """
    return logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("pv"), F.theta_sketch_agg("user_id", lg_k).alias("visitors"))


def sketch_requery(rollup: DataFrame, keys: Sequence[str], lg_k: int = 14) -> DataFrame:
    """pv, the merged sketch and its estimate per key."""
    merged = rollup.groupBy(*keys).agg(F.sum("pv").alias("pv"), F.theta_union_agg("visitors", lg_k).alias("visitors"))
    return merged.withColumn("uv", F.theta_sketch_estimate("visitors"))


def sketch_error(uv: Column, lg_k: int = 14, deviations: int = 3) -> Column:
    """How far an estimate may be off: ``deviations`` standard deviations of a sketch in estimation mode, none below its size."""
    return F.when(uv <= 1 << lg_k, F.lit(0.0)).otherwise(uv * deviations / (1 << lg_k) ** 0.5)


def sketch_overlap(left: Column, right: Column) -> dict[str, Column]:
    """Visitors that both sketches saw, that only the first and only the second saw."""
    return {
        "both": F.theta_sketch_estimate(F.theta_intersection(left, right)),
        "only_left": F.theta_sketch_estimate(F.theta_difference(left, right)),
        "only_right": F.theta_sketch_estimate(F.theta_difference(right, left)),
    }


def visitor_pairs(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The exact mergeable form of visitors: one row per key and user. Deltas merge by distinct union."""
    return logs.filter(F.col("user_id").isNotNull()).select(*keys, "user_id").distinct()


def replace_latest(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the highest version per key, reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return latest.select(*keys, "_row.*")
