"""Data-quality checks; each yields rows (check_name, status, value, threshold)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITY = {"PASS": 0, "WARN": 1, "FAIL": 2}


def result(df: DataFrame, name: str, value: Column, threshold: float, status: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"), status.alias("status"), value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold")
    )


def row_count_check(df: DataFrame, name: str, minimum: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return result(counted, name, F.col("n"), minimum, F.when(F.col("n") >= minimum, "PASS").otherwise("FAIL"))


def null_ratio_check(df: DataFrame, name: str, columns: list[str], maximum: float = 0.05) -> DataFrame:
    """One row per column, all from one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot(["_n"], columns, "column", "missing")
    ratio = F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("_n").cast("double")), F.lit(0.0))
    checked = long.withColumn("ratio", F.round(ratio, 9))
    return checked.select(
        F.concat(F.lit(f"{name}:"), "column").alias("check_name"),
        F.when(F.col("ratio") <= maximum, "PASS").otherwise("FAIL").alias("status"),
        F.col("ratio").alias("value"),
        F.lit(float(maximum)).alias("threshold"),
    )


def freshness_check(df: DataFrame, name: str, time_column: str, as_of: Column, max_hours: float = 24) -> DataFrame:
    """Age of the newest row in hours against ``as_of``; an empty table fails."""
    newest = df.agg(F.max(time_column).alias("newest"))
    aged = newest.withColumn("age", (F.unix_micros(as_of) - F.unix_micros("newest")) / 3.6e9)
    return result(aged, name, F.round("age", 6), max_hours, F.when(F.col("age") <= max_hours, "PASS").otherwise("FAIL"))


def band_check(df: DataFrame, name: str, value: Column, warn: float = 80, fail: float = 90) -> DataFrame:
    """PASS below ``warn``, WARN below ``fail``, else FAIL, for an aggregate ``value``."""
    measured = df.agg(value.cast("double").alias("value"))
    status = F.when(F.col("value") < warn, "PASS").when(F.col("value") < fail, "WARN").otherwise("FAIL")
    return result(measured, name, F.col("value"), fail, status)


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def report(checks: DataFrame) -> DataFrame:
    """Counts by status and the overall code: 0 all passed, 1 some warned, 2 some failed."""
    severity = F.lit(SEVERITY["FAIL"])
    for status, code in SEVERITY.items():
        severity = F.when(F.col("status") == status, code).otherwise(severity)
    return checks.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in SEVERITY], F.max(severity).alias("overall")
    )
