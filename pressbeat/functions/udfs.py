"""User-defined functions. Built-in functions come first; these cover what a user brings along."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Functions shipped to the tasks are defined inside others, so they travel by value and the executors
# need no copy of this package.


def level_function():
    """Popularity of a view count, as a plain function."""

    def level_of(views: int | None) -> str | None:
        if views is None:
            return None
        return "hot" if views >= 3000 else "normal" if views >= 1500 else "cold"

    return level_of


def level_udf():
    """Row-at-a-time function; ``operators.traffic.tier`` is the built-in form."""
    return F.udf(level_function(), T.StringType())


def register_level(spark: SparkSession, name: str = "popularity_level") -> None:
    spark.udf.register(name, level_function(), T.StringType())


def tags_udf():
    """Clean tag list of a comma-separated string."""

    def parse(tags: str | None) -> list[str] | None:
        return None if tags is None else [tag.strip().lower() for tag in tags.split(",") if tag.strip()]

    return F.udf(parse, T.ArrayType(T.StringType()))


def engagement_udf():
    """Two inputs, whole Arrow batches at a time."""

    @F.pandas_udf("bigint")
    def score(views: pd.Series, likes: pd.Series) -> pd.Series:
        return views + likes * 5

    return score


def mean_udf():
    """Series to scalar: usable as an aggregate and over a bounded window frame."""

    @F.pandas_udf("double")
    def mean(values: pd.Series) -> float:
        return float(values.mean())

    return mean


def centre_groups(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Grouped map: each value minus its group's mean.

    A group is one pandas frame, so pass rows already reduced to a bounded number per group (days of a
    calendar, say); ``operators.stats.group_transform`` is the form for detail rows.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("centred", T.DoubleType())])

    def centre(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(centred=group[measure] - group[measure].mean())

    return df.groupBy(key).applyInPandas(centre, schema)


def map_rows(df: DataFrame) -> DataFrame:
    """New rows from rows, a batch at a time: one (post_id, tag) pair per tag."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = batch.assign(tag=batch["tags"].str.split(",")).explode("tag")
            yield pairs.assign(tag=pairs["tag"].str.strip())[["post_id", "tag"]]

    return df.select("post_id", "tags").mapInPandas(expand, "post_id bigint, tag string")


def lookup_udf(spark: SparkSession, table: Mapping[str, str], max_entries: int = 100_000):
    """Looks values up in a table broadcast once per executor; larger tables belong in a join."""
    if len(table) > max_entries:
        raise ValueError(f"{len(table)} entries: join against a table instead")
    shared = spark.sparkContext.broadcast(dict(table))

    @F.pandas_udf("string")
    def lookup(values: pd.Series) -> pd.Series:
        return values.map(shared.value)

    return lookup
