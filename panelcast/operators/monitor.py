"""Monitoring: realized against estimated error, staleness, and their summary.

All prediction versions are scored in one plan; there is no loop over versions and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.operators.clean import unscored_predictions, valid_actuals
from panelcast.operators.joins import estimated_vs_realized, realized_actuals


def actuals_summary(df: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    return valid_actuals(df).groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("QUARTER").alias("earliest_quarter"), F.max("QUARTER").alias("latest_quarter")
    )


def version_inventory(predictions: DataFrame, newest: int = 3, version: str = "PREDICTIONS_VERSION", load: str = "LOAD_TS") -> DataFrame:
    """Partitions and rows per prediction version, the newest ones marked.

    The rank is over the versions, of which there are as many as there were runs.
    """
    sizes = predictions.groupBy(version, load).agg(
        F.countDistinct("PARTITION_COLUMN").alias("partition_count"), F.count(F.lit(1)).alias("row_count")
    )
    order = W.orderBy(F.col(load).desc(), F.col(version).desc())
    return sizes.withColumn("selected", F.row_number().over(order) <= newest)


def topk_versions(predictions: DataFrame, k: int = 3, version: str = "PREDICTIONS_VERSION", load: str = "LOAD_TS") -> DataFrame:
    return predictions.groupBy(version).agg(F.max(load).alias(load)).orderBy(F.col(load).desc(), F.col(version).desc()).limit(k)


def realized(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Rows that were open when predicted and are known now, all versions at once."""
    return realized_actuals(unscored_predictions(predictions), valid_actuals(actuals))


def realized_mape(scored: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN", "MODEL_USED", "PREDICTIONS_VERSION")) -> DataFrame:
    return scored.groupBy(*keys).agg(
        F.avg("REALIZED_APE").alias("realized_mape"),
        F.count(F.lit(1)).alias("n_quarters_scored"),
        F.avg("PREDICTION_HORIZON").alias("avg_prediction_horizon"),
    )


def realized_by_horizon(scored: DataFrame, horizon: str = "PREDICTION_HORIZON", version: str = "PREDICTIONS_VERSION") -> DataFrame:
    return scored.groupBy(version, horizon).agg(F.avg("REALIZED_APE").alias("realized_mape"), F.count(F.lit(1)).alias("n_quarters"))


def backtest_against_estimates(predictions: DataFrame, actuals: DataFrame, champions: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Realized error per partition, model and version next to the estimate the champion was chosen by."""
    estimates = champions.select("PARTITION_COLUMN", F.col("HORIZON_MAPE").alias("estimated_mape"))
    return estimated_vs_realized(realized_mape(realized(predictions, actuals)), estimates, threshold)


def model_staleness(models: DataFrame, now: Column, max_days: int = 30, keys: Sequence[str] = ("PARTITION_COLUMN", "MODEL_USED")) -> DataFrame:
    """Whole days since the last training of each champion."""
    days = F.floor((F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("last_trained").cast("timestamp"))) / 86400)
    return (
        models.filter(F.col("is_champion"))
        .groupBy(*keys)
        .agg(F.max("LOAD_TS").alias("last_trained"))
        .withColumn("model_age_days", days)
        .withColumn("is_stale", F.coalesce(F.col("model_age_days") > max_days, F.lit(False)))
    )


MONITOR_COLUMNS = [
    "PARTITION_COLUMN", "check_type", "current_version", "comparison_version", "metric_name", "current_value", "comparison_value",
    "absolute_change", "relative_change_pct", "is_alert", "alert_reason", "data_version_scored_against",
]


def monitoring_records(backtest: DataFrame, staleness: DataFrame, data_version: str, max_days: int = 30) -> DataFrame:
    """Both checks in one long table."""
    nothing = F.lit(None).cast("string")
    scored = backtest.select(
        "PARTITION_COLUMN",
        F.lit("backtest_actuals").alias("check_type"),
        F.col("PREDICTIONS_VERSION").alias("current_version"),
        nothing.alias("comparison_version"),
        F.lit("realized_vs_estimated_mape").alias("metric_name"),
        F.col("realized_mape").alias("current_value"),
        F.col("estimated_mape").alias("comparison_value"),
        F.when(F.col("estimated_mape") != 0, F.col("realized_mape") - F.col("estimated_mape")).alias("absolute_change"),
        F.col("mape_ratio").alias("relative_change_pct"),
        "is_alert",
        F.when(F.col("is_alert"), F.concat(F.lit("realized MAPE "), F.format_string("%.1f", "mape_ratio"), F.lit("x estimated"))).alias("alert_reason"),
        F.lit(data_version).alias("data_version_scored_against"),
    )
    age = F.col("model_age_days").cast("double")
    aged = staleness.select(
        "PARTITION_COLUMN",
        F.lit("model_staleness").alias("check_type"),
        nothing.alias("current_version"),
        nothing.alias("comparison_version"),
        F.lit("model_age_days").alias("metric_name"),
        age.alias("current_value"),
        F.lit(float(max_days)).alias("comparison_value"),
        (age - max_days).alias("absolute_change"),
        F.lit(None).cast("double").alias("relative_change_pct"),
        F.col("is_stale").alias("is_alert"),
        F.when(F.col("is_stale"), F.concat(F.lit("model is "), F.col("model_age_days").cast("string"), F.lit(" days old"))).alias("alert_reason"),
        nothing.alias("data_version_scored_against"),
    )
    return scored.unionByName(aged)


def health_matrix(records: DataFrame, checks: Sequence[str] = ("backtest_actuals", "model_staleness")) -> DataFrame:
    """Partition x check, 1 where the check failed."""
    failed = {c: F.max(((F.col("check_type") == c) & F.col("is_alert")).cast("int")) for c in checks}
    return records.groupBy("PARTITION_COLUMN").agg(*[e.alias(c) for c, e in failed.items()])


def check_summary(records: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """Totals per check, the alert rate as text (N/A without records) and the overall verdict."""
    per = records.groupBy("check_type").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_alert").alias("failed"))
    if checks is not None:
        per = checks.select("check_type").join(per, "check_type", "left").na.fill(0, ["total", "failed"])
    rate = F.when(F.col("total") > 0, F.concat(F.format_string("%.1f", F.try_divide(F.col("failed") * 100.0, F.col("total"))), F.lit("%")))
    every = W.partitionBy(F.lit(0))  # one row per kind of check
    status = F.when(F.max("failed").over(every) > 0, "NEEDS_ATTENTION").otherwise("PASS")
    return per.withColumns(
        {"passed": F.col("total") - F.col("failed"), "alert_rate": F.coalesce(rate, F.lit("N/A")), "status": status}
    )


def known_partitions(*parts: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    out = parts[0].select(key)
    for p in parts[1:]:
        out = out.union(p.select(key))
    return out.distinct()


def unscored_versions(candidates: DataFrame, records: DataFrame, data_version: str) -> DataFrame:
    """Candidate versions that were not yet scored against this data version."""
    done = records.filter(
        (F.col("check_type") == "backtest_actuals") & (F.col("data_version_scored_against") == data_version)
    ).select(F.col("current_version").alias("PREDICTIONS_VERSION"))
    return candidates.join(done.distinct(), "PREDICTIONS_VERSION", "left_anti")


def all_versions_scored(candidates: DataFrame, records: DataFrame, data_version: str) -> DataFrame:
    """One row: is there nothing left to score."""
    left = unscored_versions(candidates, records, data_version)
    return left.agg((F.count(F.lit(1)) == 0).alias("all_scored"), F.count(F.lit(1)).alias("versions_to_score"))
