"""Registry of the named queries and of the SQL that states their expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressbeat.tables import SQL_TABLES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def expected(sql: str, *tables: str) -> str:
    """``sql`` preceded by the definitions of the logical tables it reads."""
    if not tables:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({SQL_TABLES[name]})" for name in tables)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None, *tables: str):
    """Register ``fn(tables)`` under ``name``; ``sql`` is the equivalent query over the raw tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = expected(sql, *tables)
        return fn

    return register
