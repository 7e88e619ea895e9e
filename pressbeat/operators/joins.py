"""Joins beyond the plain equi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.storage import estimated_bytes, materialize


HOT_SHARE = 0.01


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is within the session's broadcast threshold."""
    threshold = df.sparkSession.sql("SET spark.sql.autoBroadcastJoinThreshold").first()["value"]
    return estimated_bytes(df) <= threshold_bytes(threshold)


def threshold_bytes(text: str) -> int:
    """10485760, 10485760b, 10MB, -1 … in bytes."""
    units = {"k": 10, "m": 20, "g": 30}
    number = text.lower().rstrip("b")
    return int(number[:-1]) << units[number[-1]] if number[-1] in units else int(number)


def dimension_join(facts: DataFrame, dimension: DataFrame, key: str, hot_share: float = HOT_SHARE) -> DataFrame:
    """Inner join of facts with a dimension whose ``key`` is unique, whatever share of the facts one key holds.

    A small dimension is broadcast by Spark. Otherwise the keys that each hold more than ``hot_share``
    of the facts, at most 1 / ``hot_share`` of them, are joined by broadcasting just their dimension
    rows, and only the remaining facts are shuffled.
    """
    if fits_broadcast(dimension):
        return facts.join(dimension, key)
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg(F.sum("n") * hot_share).scalar()
    hot = materialize(counts.filter(F.col("n") > limit).select(key), "hot-keys")
    hot_rows = dimension.join(F.broadcast(hot), key, "left_semi")
    often = facts.join(F.broadcast(hot_rows), key)
    rarely = facts.join(F.broadcast(hot), key, "left_anti").join(dimension, key)
    return often.unionByName(rarely)


#: Lengths of the leading pieces that texts and needles meet by: a needle uses the longest that fits in it.
SEED_LENGTHS = tuple(1 << i for i in range(7))


def contains_join(left: DataFrame, text: str, right: DataFrame, needle: str, key: str, how: str = "inner") -> DataFrame:
    """Rows of ``right`` whose needle occurs in the text of a row of ``left``; ``key`` is unique in ``left``.

    Instead of comparing every pair, each needle is found by its seed, its first 1, 2, 4, … or 64 characters. Only
    (key, piece) of the texts' distinct pieces of these lengths meet the seeds; the texts come back by key and are searched for the
    whole needle. Both small sides are written, so a broadcast is decided by their true size. Empty needles match no text.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    length = F.lit(SEED_LENGTHS[0])
    for n in SEED_LENGTHS[1:]:
        length = F.when(F.length(needle) >= n, F.lit(n)).otherwise(length)
    usable = right.filter(F.length(needle) > 0)
    seeds = usable.select(needle).distinct().withColumn("_seed", F.substr(F.col(needle), F.lit(1), length))
    seeds = materialize(seeds, "seeds")
    used = [r[0] for r in seeds.select(F.length("_seed")).distinct().collect()]  # at most as many as SEED_LENGTHS

    def cut(n: int) -> Column:
        places = F.sequence(F.lit(1), F.length(text) - n + 1)
        pieces = F.transform(places, lambda at: F.substr(F.col(text), at, F.lit(n)))
        return F.when(F.length(text) >= n, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))

    pieces = left.select(key, F.explode(F.concat(*map(cut, used or SEED_LENGTHS[:1]))).alias("_seed"))
    # an explode is estimated at the size of its input, so the pieces must never be chosen for a broadcast
    seeds = F.broadcast(seeds) if fits_broadcast(seeds) else seeds.hint("merge")
    met = materialize(pieces.join(seeds, "_seed").select(key, F.col(needle).alias("_needle")), "met")
    found = left.join(met, key).filter(F.contains(F.col(text), F.col("_needle")))
    found = found.join(usable, F.col("_needle") == usable[needle]).drop("_needle")
    if how == "inner":
        return found
    missing = left.join(found.select(key).distinct(), key, "left_anti")
    return found.unionByName(missing, allowMissingColumns=True)


def combine_first(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys of both; each column from the left, and from the right where the left has none."""
    other = right.toDF(*[c if c in keys else f"_r_{c}" for c in right.columns])
    joined = left.join(other, list(keys), "full")
    columns = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in keys]
    picked = []
    for c in columns:
        sides = [F.col(c)] if c in left.columns else []
        sides += [F.col(f"_r_{c}")] if c in right.columns else []
        picked.append(F.coalesce(*sides).alias(c))
    return joined.select(*keys, *picked)
