"""Top-k, paging and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressbeat.operators.ordered import rank_by


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of the order; each task keeps ``n`` rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], n: int, *order: Column | str, name: str = "place") -> DataFrame:
    """The first ``n`` rows of each group. Groups are cut to ``n`` rows before the shuffle (WindowGroupLimit)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def page(df: DataFrame, start: int, size: int, *order: Column | str) -> DataFrame:
    """Rows start … start+size of the order."""
    return df.orderBy(*order).offset(start).limit(size)


def page_after(df: DataFrame, size: int, key: str, last_seen) -> DataFrame:
    """The page after ``last_seen`` in descending key order; costs the same however deep the page."""
    return df.filter(F.col(key) < F.lit(last_seen)).orderBy(F.desc(key)).limit(size)


def latest_n(df: DataFrame, key: str, value: str, n: int, *newest_first: Column) -> DataFrame:
    """The newest ``n`` values per key as a list, newest first."""
    newest = top_n_per_group(df, [key], n, *newest_first, name="_place")
    listed = newest.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_place", value))).alias("_items"))
    return listed.select(key, F.transform("_items", lambda item: item[value]).alias("latest"))


def leaderboard(scores: DataFrame, member: str, score: str, n: int) -> DataFrame:
    best = top_n(scores, n, F.desc(score), member)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc(score), member)))


def leaderboard_ranks(scores: DataFrame, member: str, score: str) -> DataFrame:
    """Rank of every member: 1 + the members with a higher score."""
    return rank_by(scores, score, descending=True).select(member, score, "rank")


def leaderboard_summary(scores: DataFrame, score: str, low, high) -> DataFrame:
    """Members in all, within [low, high], and at or above ``low``."""
    return scores.agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(F.col(score).between(low, high)).alias("in_range"),
        F.count_if(F.col(score) >= low).alias("at_least"),
    )
