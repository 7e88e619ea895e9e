"""Statistics, pivots, word counts, calendar buckets and bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.operators.ordered import quantiles
from pressbeat.storage import use_all_cores


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value; missing values are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 9))


def open_values(df: DataFrame, column: str, most: int = 50) -> list[str]:
    """The ``most`` frequent values of a column in their order, for columns of their own; a bounded look before a pivot."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sorted(r[0] for r in counts.orderBy(F.desc("n"), column).limit(most).collect())


def with_rest(df: DataFrame, column: str, values: Sequence[str], rest: str) -> DataFrame:
    """Values without a column of their own, and missing ones, under ``rest``."""
    return df.withColumn(column, F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(rest))


def pivot_sum(df: DataFrame, row: str, column: str, measure: str, values: Sequence[str] | None = None, rest: str = "rest", most: int = 50) -> DataFrame:
    """Sum per row and column value, 0 where there is none; the values are found if not given, and ``rest`` holds all others."""
    values = open_values(df, column, most) if values is None else list(values)
    return with_rest(df, column, values, rest).groupBy(row).pivot(column, [*values, rest]).agg(F.sum(measure)).fillna(0)


def crosstab_margins(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None, label: str = "All", rest: str = "rest", most: int = 50) -> DataFrame:
    """Counts per (row, column) with row and column totals under ``label`` and further column values under ``rest``."""
    kept = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    values = open_values(kept, column, most) if values is None else list(values)
    rolled = with_rest(kept, column, values, rest).cube(row, column).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(row).alias("_gr"), F.grouping(column).alias("_gc")
    )
    named = rolled.select(
        F.when(F.col("_gr") == 1, label).otherwise(F.col(row)).alias(row),
        F.when(F.col("_gc") == 1, label).otherwise(F.col(column)).alias("_column"),
        "n",
    )
    return named.groupBy(row).pivot("_column", [*values, rest, label]).agg(F.sum("n")).fillna(0)


def group_transform(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Group mean beside each row and the row's distance from it.

    Means are reduced first and joined back, so a large group is not gathered in one window.
    """
    means = df.groupBy(key).agg(F.avg(measure).alias("group_mean")).withColumnRenamed(key, "_key")
    joined = df.join(means, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.withColumn("difference", F.col(measure) - F.col("group_mean"))


def words(df: DataFrame, column: str) -> DataFrame:
    """One row per whitespace-separated token."""
    texts = use_all_cores(df.select(column))
    return texts.select(F.explode(F.split(F.trim(F.regexp_replace(column, r"\s+", " ")), " ")).alias("word")).filter(F.col("word") != "")


def word_count(df: DataFrame, column: str) -> DataFrame:
    return words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def reduce_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Sums ``word<TAB>count`` lines; lines without a tab or with a count that is no integer are skipped."""
    trimmed = F.trim(column)
    word, count = F.split_part(trimmed, F.lit("\t"), F.lit(1)), F.split_part(trimmed, F.lit("\t"), F.lit(2)).try_cast("bigint")
    pairs = lines.filter(F.contains(F.col(column), F.lit("\t"))).select(word.alias("word"), count.alias("n"))
    return pairs.filter(F.col("n").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))


def calendar(df: DataFrame, column: str, step: str) -> DataFrame:
    """Every bucket from the first to the last in ``column``; ``step`` is an interval literal such as '1 month'."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return ends.select(F.explode(F.expr(f"sequence(lo, hi, interval {step})")).alias(column))


def resample_week(df: DataFrame, date: str, measures: dict[str, Column]) -> DataFrame:
    """Weekly buckets labelled with their closing Sunday, empty weeks included."""
    week_end = F.date_add(F.col(date), 6 - F.weekday(date))
    weekly = df.groupBy(week_end.alias("week_end")).agg(*[c.alias(n) for n, c in measures.items()])
    return calendar(weekly, "week_end", "7 days").join(weekly, "week_end", "left")


def date_histogram(df: DataFrame, date: str) -> DataFrame:
    """Documents per calendar month, empty months included."""
    monthly = df.groupBy(F.trunc(date, "MM").alias("month")).agg(F.count(F.lit(1)).alias("docs"))
    dense = calendar(monthly, "month", "1 month").join(monthly, "month", "left")
    return dense.select(F.date_format("month", "yyyy-MM").alias("month"), F.coalesce("docs", F.lit(0).cast("bigint")).alias("docs"))


def terms_agg(df: DataFrame, key: str, size: int, nested: dict[str, Column]) -> DataFrame:
    """The ``size`` most frequent terms (ties by key) with nested aggregates."""
    terms = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("doc_count"), *[c.alias(n) for n, c in nested.items()])
    return terms.orderBy(F.desc("doc_count"), key).limit(size)


def scalar_stats(df: DataFrame, measure: str, key: str, other: str) -> DataFrame:
    """Sum, mean, median, extremes, deviation, the keys of the extremes and a correlation, in one row."""
    median = quantiles(df, measure, {"median": 0.5}).scalar()
    at_max = F.max_by(key, F.struct(F.col(measure), -F.col(key)))
    at_min = F.min_by(key, F.struct(F.col(measure), F.col(key)))
    stats = df.filter(F.col(measure).isNotNull()).agg(
        F.sum(measure).alias("sum"), F.round(F.avg(measure), 9).alias("mean"), F.max(measure).alias("max"), F.min(measure).alias("min"),
        F.round(F.stddev_samp(measure), 6).alias("std"), at_max.alias("argmax"), at_min.alias("argmin"),
        F.round(F.corr(measure, other), 9).alias("corr"),
    )
    return stats.withColumn("median", median.cast("double"))


def qcut(df: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """Quantile bin 0 … bins-1 of each row, edges closed on the right; equal values share a bin."""
    inner = {f"e{i}": i / bins for i in range(1, bins)}
    edges = quantiles(df, column, inner).select(F.array(*inner)).scalar()
    above = reduce(lambda a, b: a + b, [F.when(F.col(column) > F.col("_edges")[i], 1).otherwise(0) for i in range(bins - 1)])
    return df.withColumn("_edges", edges).withColumn(name, F.when(F.col(column).isNotNull(), above)).drop("_edges")


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge, next edge] a value falls into; NULL outside."""
    steps = [F.when((value > lo) & (value <= hi), label) for lo, hi, label in zip(edges, edges[1:], labels)]
    return reduce(lambda a, b: F.coalesce(a, b), steps)
