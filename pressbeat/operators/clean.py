"""Cleaning and profiling of posts and access logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressbeat.operators.ordered import quantiles, running
from pressbeat.operators.traffic import tier
from pressbeat.sources.files import CORRUPT


def missing_stats(df: DataFrame) -> DataFrame:
    """Missing count and ratio per column, all columns in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counted.unpivot(["_rows"], df.columns, "column", "missing")
    ratio = F.round(F.try_divide(F.col("missing").cast("double"), F.col("_rows").cast("double")), 9)
    return long.select("column", "missing", ratio.alias("ratio"))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Missing values replaced by the column mean, worked out once as a scalar."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def forward_fill(df: DataFrame, column: str, order: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """Missing values replaced by the last one seen before them in the group."""
    filled = running(df, {"_filled": ("last", F.col(column))}, order, part)
    return filled.withColumn(column, F.col("_filled")).drop("_filled")


def interpolate(df: DataFrame, column: str, order: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation by row position. Leading gaps stay, trailing ones take the last value."""
    known = F.col(column).isNotNull()
    back = running(
        df, {"_at": ("sum", F.lit(1).cast("bigint")), "_low": ("last", F.col(column))}, order, part
    )
    # position of the last known value: running maximum over known positions
    back = running(back, {"_low_at": ("max", F.when(known, F.col("_at")))}, order, part)
    both = running(
        back, {"_high": ("last", F.col(column)), "_high_at": ("min", F.when(known, F.col("_at")))}, order, part, reverse=True
    )
    slope = (F.col("_high") - F.col("_low")) / (F.col("_high_at") - F.col("_low_at"))
    inside = F.col("_low") + slope * (F.col("_at") - F.col("_low_at"))
    value = F.when(known, F.col(column)).when(F.col("_high").isNull(), F.col("_low")).when(F.col("_low").isNotNull(), inside)
    return both.withColumn(column, value).drop("_at", "_low", "_low_at", "_high", "_high_at")


def row_digest(*columns: str) -> Column:
    """SHA-256 of the columns: a short stand-in for long values as a grouping key."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key, the first or last in the order. Reduced map-side, so copies of a key do not pile up."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    pick = F.min if keep == "first" else F.max
    position = F.struct(*order)
    chosen = (F.min_by if keep == "first" else F.max_by)(row, position) if rest else pick(row)
    kept = df.groupBy(*keys).agg(chosen.alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def duplicate_flag(df: DataFrame, keys: Sequence[str], order: str, keep: str = "first") -> DataFrame:
    """True on every row of a key but the kept one. ``order`` is unique."""
    pick = F.min if keep == "first" else F.max
    kept = df.groupBy(*keys).agg(pick(order).alias("_kept"))
    # rows that are kept have the only order value listed, so the join key is unique on both sides
    marked = kept.select(F.col("_kept").alias(order), F.lit(False).alias("_other"))
    return df.join(marked, order, "left").withColumn("duplicate", F.coalesce("_other", F.lit(True))).drop("_other")


def trim_all(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.trim(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def not_negative(column: str) -> Column:
    """Missing and negative values become 0."""
    return F.greatest(F.coalesce(F.col(column), F.lit(0)), F.lit(0))


def normal_tags(column: str) -> Column:
    return F.when(F.col(column).isNull() | (F.col(column) == ""), F.lit("")).otherwise(F.lower(F.regexp_replace(column, r"\s+", "")))


def tag_count(column: str) -> Column:
    return F.when(F.col(column).isNull() | (F.col(column) == ""), F.lit(0)).otherwise(F.size(F.split(column, ",")))


def engagement(likes: int | None = 5, comments: int | None = 10) -> Column:
    """views + weighted likes + weighted comments; a weight of None leaves the term out."""
    terms = [F.col("views")]
    if likes:
        terms.append(F.col("likes") * likes)
    if comments:
        terms.append(F.col("comments") * comments)
    return reduce(lambda a, b: a + b, terms)


def without_corrupt(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def clean_posts(df: DataFrame, popular=((3000, "hot"), (1500, "normal"))) -> DataFrame:
    """Posts with required title and author, valid date, counters of at least 0, normal tags and derived columns."""
    required = [F.col(c).isNotNull() & (F.trim(c) != "") for c in ("title", "author")]
    kept = trim_all(without_corrupt(df).filter(required[0] & required[1]))
    counters = {c: not_negative(c) for c in ("views", "likes", "comments") if c in df.columns}
    dated = kept.withColumns({**counters, "publish_date": F.try_to_date(F.col("publish_date").cast("string"), "yyyy-MM-dd")})
    dated = dated.filter(F.col("publish_date").isNotNull())
    derived = {
        "year": F.year("publish_date"),
        "month": F.month("publish_date"),
        "tag_count": tag_count("tags"),
        "engagement": engagement(comments=10 if "comments" in df.columns else None),
        "popularity": tier(F.col("views"), list(popular), "cold"),
        "tags": normal_tags("tags"),
    }
    return dated.withColumns(derived)


def clean_access_logs(df: DataFrame, time_column: str = "timestamp", fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Log rows with user, post, action and a valid time; action in lower case; date and hour added."""
    kept = without_corrupt(df).filter(F.col("user_id").isNotNull() & F.col("post_id").isNotNull() & F.col("action").isNotNull())
    timed = kept.withColumn("event_time", F.try_to_timestamp(time_column, F.lit(fmt))).filter(F.col("event_time").isNotNull())
    trimmed = trim_all(timed)
    return trimmed.withColumns(
        {"action": F.lower("action"), "event_date": F.to_date("event_time"), "event_hour": F.hour("event_time")}
    )


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum, one row per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = quantiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    return basic.join(quartiles, "column")
