"""Queries for the streaming jobs, run over the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.joins import REALIZED_SQL
from panelcast.catalog.oracle import cents
from panelcast.catalog.registry import register
from panelcast.functions.quarters import quarter_label
from panelcast.session import scratch_dir, staged_location
from panelcast.sources import tables
from panelcast.streaming import jobs


def _error_counts(spark: SparkSession, d: str) -> DataFrame:
    schema = tables.read_table(spark, d, "events").schema
    events = jobs.stream_files(spark, d, schema, "events.parquet")
    errors = events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("check_type"),
        F.when(F.col("value") > 50, "error").otherwise("warning").alias("severity"),
    )
    folder = scratch_dir(spark, "error-counts")
    jobs.run_available(jobs.error_counts(errors), f"{folder}/out", f"{folder}/checkpoint")
    return jobs.read_updates(spark, f"{folder}/out", ["day", "check_type", "severity"])


register(
    "stream_error_counts",
    _error_counts,
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS check_type, CASE WHEN value > 50 THEN 'error' ELSE 'warning' END AS severity, count(*) AS n
       FROM events GROUP BY ALL""",
)


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    schema = tables.read_table(spark, d, "orders").schema
    orders = jobs.stream_files(spark, d, schema, "orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    folder = scratch_dir(spark, "rollup")
    rows = jobs.rollup_available(orders, tables.read_table(spark, d, "customer"), f"{folder}/out", f"{folder}/checkpoint")
    return rows.select(
        "MARKET_SEGMENT", quarter_label(F.col("qi").cast("int")).alias("QUARTER"), (F.col("cents").cast("double") / 100).alias("BB"), "n_orders"
    )


register(
    "stream_quarter_rollup",
    _rollup,
    f"""SELECT c_mktsegment AS MARKET_SEGMENT, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS QUARTER,
          CAST(sum({cents('o_totalprice')}) AS DOUBLE) / 100 AS BB, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)


def _refresh(spark: SparkSession, d: str) -> DataFrame:
    """The files of the newest snapshot arrive one by one as actuals."""
    predictions = S.predictions_all(spark, d)
    path, schema = staged_location(spark, "panel", d)
    actuals = jobs.stream_files(spark, path, schema, files_per_batch=4).filter(F.col("VERSION") == S.LATEST)
    folder = scratch_dir(spark, "refresh")
    return jobs.monitor_refresh(spark, actuals, predictions, f"{folder}/out", f"{folder}/checkpoint")


register(
    "stream_monitor_refresh",
    _refresh,
    f"SELECT PREDICTIONS_VERSION, PARTITION_COLUMN, QUARTER, MODEL_USED, BILLING_PREDICTED, BB_ACTUAL, REALIZED_APE FROM ({REALIZED_SQL})",
    {6: "REALIZED_APE"},
)
