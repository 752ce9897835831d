"""Registration of queries together with their SQL and the rounding both sides apply."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog.oracle import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: dict[int, str]) -> DataFrame:
    """Round the named columns; engines add floats in different orders."""
    changes = {c: F.round(F.col(c), places) + F.lit(0.0) for places, names in digits.items() for c in names.split()}
    return df.withColumns(changes)


def register(name: str, run: Query, sql: str | None = None, digits: dict[int, str] | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    if digits:
        QUERIES[name] = lambda spark, d: rounded(run(spark, d), digits)
    else:
        QUERIES[name] = run
    if sql is None:
        return
    if digits:
        changes = ", ".join(f"round({c}, {p}) + 0.0 AS {c}" for p, names in digits.items() for c in names.split())
        sql = f"SELECT * REPLACE ({changes}) FROM ({sql}) result_"
    ORACLES[name] = oracle(sql)
