"""Joins between panel, model results, predictions and actuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.metrics import realized_ape
from panelcast.functions.quarters import quarter_index, quarter_label
from panelcast.operators.clean import dedupe_first


def join_eval_keys(df: DataFrame, keys: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Panel rows once per model that exists for their partition."""
    return df.join(keys, key)


def join_model_payload(df: DataFrame, payload: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN", "MODEL_USED")) -> DataFrame:
    """Each group gets its own fitted payload; Catalyst broadcasts it only below its size limit."""
    return df.join(payload, list(keys))


def join_future_regressors(calendar: DataFrame, known: DataFrame, regressors: Sequence[str], keys: Sequence[str], quarter: str = "QUARTER") -> DataFrame:
    """Every calendar quarter with the regressors known for it, gaps filled from the neighbours."""
    from panelcast.operators.clean import fill_cascade

    joined = calendar.join(known.select(*keys, quarter, *regressors), [*keys, quarter], "left")
    return fill_cascade(joined.withColumn("_qi", quarter_index(quarter)), regressors, keys, "_qi").drop("_qi")


def join_forecast_right(df: DataFrame, forecast: DataFrame, keys: Sequence[str], day: str = "QUARTER_PARSED") -> DataFrame:
    """Keep every forecast row; days are compared, not clock times."""
    left = df.withColumn("_day", F.date_trunc("day", F.col(day))).drop(day)
    right = forecast.withColumn("_day", F.date_trunc("day", F.col(day))).drop(day)
    return left.join(right, [*keys, "_day"], "right").withColumnRenamed("_day", day)


def join_forecast_identity(df: DataFrame, forecast: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("BILLING_PREDICTED",)) -> DataFrame:
    """Attach forecasts on identity columns only, never on measured values."""
    return df.join(forecast.select(*keys, *columns), list(keys), "left")


def realized_actuals(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN", "QUARTER"), actual: str = "BB") -> DataFrame:
    """Open predictions that meanwhile have an actual, with the realized error.

    Actuals are reduced to one row per key first, so a duplicated actual cannot multiply predictions.
    """
    order = [F.col(actual)]
    unique = dedupe_first(actuals.select(*keys, F.col(actual)), list(keys), order)
    unique = unique.withColumnRenamed(actual, "BB_ACTUAL")
    return predictions.join(unique, list(keys)).withColumn("REALIZED_APE", realized_ape("BB_ACTUAL", "BILLING_PREDICTED"))


def estimated_vs_realized(realized: DataFrame, estimates: DataFrame, threshold: float = 2.0, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Realized error against the champion's estimate; an alert is a ratio above the threshold."""
    est = F.col("estimated_mape")
    ratio = F.when(est > 0, F.try_divide("realized_mape", est))
    return (
        realized.join(estimates.select(key, "estimated_mape"), key, "left")
        .withColumn("mape_ratio", ratio)
        .withColumn("is_alert", F.coalesce(F.col("mape_ratio") > threshold, F.lit(False)))
    )


def coverage_missing(previous: DataFrame, current: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Partitions of earlier batches that the current batch lacks."""
    return previous.select(key).distinct().join(current.select(key).distinct(), key, "left_anti")


def untrained_partitions(expected: DataFrame, results: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Partitions without any successful model, split into too little data and real failures."""
    short = F.coalesce(F.col("error").contains("Insufficient training data"), F.lit(False))
    per_key = results.groupBy(key).agg(
        F.bool_or(F.col("error").isNull()).alias("_trained"), F.bool_or(short).alias("_short")
    )
    return (
        expected.select(key)
        .distinct()
        .join(per_key, key, "left")
        .filter(~F.coalesce(F.col("_trained"), F.lit(False)))
        .select(key, F.when(F.col("_short"), "insufficient_data").otherwise("failure").alias("reason"))
    )


def missing_champions(evaluated: DataFrame, champions: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    return evaluated.select(key).distinct().join(champions.select(key), key, "left_anti")


def key_mismatch_report(models: DataFrame, data: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Keys that only one side has."""
    left = models.select(key).distinct().withColumn("_m", F.lit(True))
    right = data.select(key).distinct().withColumn("_d", F.lit(True))
    side = F.when(F.col("_d").isNull(), "only_in_models").when(F.col("_m").isNull(), "only_in_data")
    return left.join(right, key, "full_outer").withColumn("side", side).filter(F.col("side").isNotNull()).select(key, "side")


def origin_quarter_lookup(df: DataFrame, max_horizon: int = 6, version: str = "MOF_VERSION", quarter: str = "QUARTER") -> DataFrame:
    """Per version label, the origin implied by its last quarter."""
    return df.groupBy(version).agg(F.max(quarter).alias("last_quarter")).withColumn(
        "origin_quarter", quarter_label(quarter_index("last_quarter") - max_horizon)
    )
