"""Search bulk files and the audit of a bulk response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_bulk(df: DataFrame, index: str, id_column: str, columns: list[str], where: Column | str | None = None) -> DataFrame:
    """Two NDJSON lines per document in one ``value``: the action, then the document."""
    picked = df.filter(where) if where is not None else df
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_column).cast("string").alias("_id")).alias("index")))
    return picked.select(F.concat(action, F.lit("\n"), F.to_json(F.struct(*columns))).alias("value"))


ITEM = "index struct<_id:string, status:int, error:struct<type:string, reason:string>>"


def bulk_audit(responses: DataFrame, column: str = "value") -> DataFrame:
    """Successful and failed items by status, from response lines ``{"items":[{"index":{...}}]}``."""
    items = responses.select(F.explode(F.from_json(column, f"struct<items: array<struct<{ITEM}>>>").getField("items")).alias("item"))
    status = F.col("item.index.status")
    return items.groupBy(status.alias("status")).agg(
        F.count_if(status < 300).alias("succeeded"),
        F.count_if((status >= 300) | status.isNull()).alias("failed"),
    )
