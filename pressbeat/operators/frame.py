"""Frame-style column operators: rename, tiers, clipping, mapping, sampling, reshaping, set logic."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressbeat.operators.ordered import row_index
from pressbeat.operators.stats import open_values



def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def clip(value: Column, lower=None, upper=None) -> Column:
    """Value limited to [lower, upper]; NULL stays NULL."""
    result = value
    if lower is not None:
        result = F.greatest(result, F.lit(lower))
    if upper is not None:
        result = F.least(result, F.lit(upper))
    return F.when(value.isNotNull(), result)


def keep_where(value: Column, condition: Column, other=None) -> Column:
    """Value where the condition holds, else ``other``."""
    return F.when(condition, value).otherwise(F.lit(other))


def map_values(df: DataFrame, column: str, mapping: Mapping, name: str) -> DataFrame:
    """Mapped value, NULL when unmapped, by a join at any size; the new column has the type of the mapping's values."""
    if not mapping:
        return df.withColumn(name, F.lit(None).cast("string"))
    table = df.sparkSession.createDataFrame(list(mapping.items()), ["_mapped_from", "_mapped_to"])
    table = table.select(F.col("_mapped_from").cast(df.schema[column].dataType).alias("_mapped_from"), "_mapped_to")
    joined = df.join(table, df[column] == table["_mapped_from"], "left")
    return joined.select(*(df[c] for c in df.columns if c != name), F.col("_mapped_to").alias(name))


def eval_columns(df: DataFrame, assignments: Sequence[str]) -> DataFrame:
    """Statements ``name = expression``, applied in order."""
    for statement in assignments:
        name, expression = (part.strip() for part in statement.split("=", 1))
        df = df.withColumn(name, F.expr(expression))
    return df


def safe_cast(column: str, kind: str, fmt: str | None = None) -> Column:
    """Cast that yields NULL for a value that does not fit."""
    if kind == "date":
        return F.try_to_date(column, fmt) if fmt else F.col(column).try_cast("date")
    if kind == "timestamp":
        return F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.col(column).try_cast("timestamp")
    return F.col(column).try_cast(kind)


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def sample_rows(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``n`` rows, the same ones on every run: smallest hashes of (key, seed)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def split_by(df: DataFrame, column: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per value."""
    return {value: df.filter(F.col(column) == value) for value in values}


def pipe(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return reduce(lambda frame, step: frame.transform(step), steps, df)


def one_hot(df: DataFrame, column: str, prefix: str, values: Sequence[str] | None = None, rest: str = "rest", most: int = 50) -> DataFrame:
    """A 0/1 column for each value, found if not given, and one for all others and missing ones: each row has one 1."""
    values = open_values(df, column, most) if values is None else list(values)
    known = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    flags = {f"{prefix}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values}
    return df.withColumns({**flags, f"{prefix}_{rest}": (~known).cast("int")})


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def concat_columns(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Columns side by side by position in each frame's order; the longer frame pads the other with NULLs."""
    numbered = row_index(left, left_order, name="_at")
    other = row_index(right, right_order, name="_at")
    return numbered.join(other, "_at", "full").drop("_at")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both. Each side is reduced to distinct rows first, so copies are not shuffled into the join."""
    return left.distinct().intersect(right.distinct())


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.distinct().subtract(right.distinct())


def members(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``others``."""
    return df.join(others.select(*keys).distinct(), list(keys), "left_semi")


def non_members(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``others``."""
    return df.join(others.select(*keys).distinct(), list(keys), "left_anti")


def grid(df: DataFrame, rows: str, column: str, limit: int = 1000) -> DataFrame:
    """Every combination of the values of two small dimensions, absent ones included.

    The second dimension travels as one array whose size is checked; a wider one is refused.
    """
    return df.select(rows).distinct().withColumn(column, F.explode(small_set(df, F.col(column), limit)))


def small_set(df: DataFrame, value: Column, limit: int) -> Column:
    """The distinct values as one array. More than ``limit`` of them are an error, noticed at one too many."""
    some = df.select(value.alias("v")).distinct().limit(limit + 1).agg(F.collect_set("v").alias("vs"))
    refused = F.raise_error(F.lit(f"more than {limit} distinct values"))
    return some.select(F.when(F.size("vs") <= limit, F.col("vs")).otherwise(refused)).scalar()
