"""Gates before training and after prediction: one aggregation each, reports as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.config import REGRESSOR_COLUMNS


def null_rate_check(df: DataFrame, columns: Sequence[str], limit: float = 0.1) -> DataFrame:
    """Share of missing values per critical column, in one pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return rates.unpivot([], list(columns), "column", "null_rate").withColumn("is_high", F.col("null_rate") > limit)


def dq_profile(
    df: DataFrame, key: str = "PARTITION_COLUMN", target: str = "BB", regressors: Sequence[str] = tuple(REGRESSOR_COLUMNS),
    val: str = "VERIFICATION_HORIZON", pred: str = "PREDICTION_HORIZON",
) -> DataFrame:
    """Everything the data-quality checks need, one row per group."""
    first_bad = F.filter(
        F.array(*[F.struct(F.lit(r).alias("name"), F.count_if(F.col(r).isNull()).alias("nulls")) for r in regressors]),
        lambda s: s["nulls"] > 0,
    )
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(target).isNull()).alias("null_targets"),
        F.count_if(F.col(target) < 0).alias("negative_targets"),
        F.get(first_bad, F.lit(0)).alias("bad_regressor"),
        F.percentile(val, F.lit(0.5)).cast("int").alias("val_h"),
        F.percentile(pred, F.lit(0.5)).cast("int").alias("pred_h"),
    )


def dq_null_target(profile: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    return profile.filter(F.col("null_targets") > 0).select(key, "null_targets")


def dq_null_regressors(profile: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    """The first regressor with gaps, in configuration order."""
    return profile.filter(F.col("bad_regressor").isNotNull()).select(
        key, F.col("bad_regressor.name").alias("regressor"), F.col("bad_regressor.nulls").alias("nulls")
    )


def dq_negative_ratio(profile: DataFrame, threshold: float = 0.2, key: str = "PARTITION_COLUMN") -> DataFrame:
    """Share of negative targets; rows without a target count in the denominator."""
    ratio = F.col("negative_targets") / F.col("n_rows")
    return profile.withColumn("negative_ratio", ratio).filter(F.col("negative_ratio") > threshold).select(key, "negative_ratio")


def dq_min_periods(profile: DataFrame, minimum: int = 6, key: str = "PARTITION_COLUMN") -> DataFrame:
    return profile.filter(F.col("n_rows") < minimum).select(key, "n_rows")


def train_rows() -> Column:
    return F.col("n_rows") - F.col("val_h") - F.col("pred_h")


def dq_train_rows(profile: DataFrame, minimum: int = 6, key: str = "PARTITION_COLUMN") -> DataFrame:
    return profile.withColumn("train_rows", train_rows()).filter(F.col("train_rows") < minimum).select(key, "train_rows", "val_h", "pred_h")


def dq_report(profile: DataFrame, target: str = "BB", minimum: int = 6, key: str = "PARTITION_COLUMN") -> DataFrame:
    """One removal reason per failed group: target gaps, regressor gaps, length, training rows."""
    reason = F.coalesce(
        F.when(F.col("null_targets") > 0, F.format_string(f"Null values in {target} (%d nulls)", F.col("null_targets"))),
        F.when(
            F.col("bad_regressor").isNotNull(),
            F.format_string("Null values in regressor %s (%d nulls)", F.col("bad_regressor.name"), F.col("bad_regressor.nulls")),
        ),
        F.when(F.col("n_rows") < minimum, F.format_string(f"Only %d periods (min: {minimum})", F.col("n_rows"))),
        F.when(
            train_rows() < minimum,
            F.format_string(
                f"Only %d training rows after split (val=%d, pred=%d, min: {minimum})", train_rows(), F.col("val_h"), F.col("pred_h")
            ),
        ),
    )
    return profile.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(key, "reason")


def dq_summary(profile: DataFrame, report: DataFrame) -> DataFrame:
    total = profile.agg(F.count(F.lit(1)).alias("total_groups"))
    removed = report.agg(F.count(F.lit(1)).alias("groups_removed"))
    return total.crossJoin(F.broadcast(removed)).withColumn("groups_remaining", F.col("total_groups") - F.col("groups_removed"))


def _pooled(prefix: str, columns: Sequence[str]) -> tuple[Column, Column]:
    """Sum and count over all columns of a kind: their mean is pooled over signals, not a mean of means."""
    names = [c for c in columns if c.startswith(prefix)]
    total = F.lit(0.0)
    known = F.lit(0).cast("bigint")
    for n in names:
        total = total + F.coalesce(F.sum(n), F.lit(0.0))
        known = known + F.count(n)
    return total, known


def sanity_checks(
    df: DataFrame, key: str = "PARTITION_COLUMN", predicted: str = "BILLING_PREDICTED", ape: str = "APE", extreme: float = 500.0,
    min_unique: int = 2, min_direction: float = 0.25, max_distance: float = 3.0, extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Per partition the five measures and their flags; predictions are never changed."""
    d_sum, d_n = _pooled("DIRECTIONAL_CORRECTNESS_", df.columns)
    v_sum, v_n = _pooled("VALIDATION_DISTANCE_", df.columns)
    out = df.groupBy(key, *extra_keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(predicted) < 0).alias("negative_rows"),
        F.avg(ape).alias("mean_ape"),
        F.countDistinct(predicted).alias("n_unique"),
        F.try_divide(d_sum, d_n.cast("double")).alias("mean_direction"),
        F.try_divide(v_sum, v_n.cast("double")).alias("mean_distance"),
    )
    flags = {
        "has_negative": F.col("negative_rows") > 0,
        "is_extreme": F.col("mean_ape") > extreme,
        "is_flat": (F.col("n_rows") >= min_unique) & (F.col("n_unique") < min_unique),
        "low_direction": F.col("mean_direction") < min_direction,
        "high_distance": F.col("mean_distance") > max_distance,
    }
    return out.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})


def sanity_report(checks: DataFrame, key: str = "PARTITION_COLUMN", extra_keys: Sequence[str] = ()) -> DataFrame:
    """Long form: one row per partition and issue."""
    issues = F.array(
        F.struct(F.col("has_negative").alias("hit"), F.lit("negative").alias("issue"), F.col("negative_rows").cast("double").alias("value")),
        F.struct(F.col("is_extreme").alias("hit"), F.lit("extreme_ape").alias("issue"), F.col("mean_ape").alias("value")),
        F.struct(F.col("is_flat").alias("hit"), F.lit("flat").alias("issue"), F.col("n_unique").cast("double").alias("value")),
        F.struct(F.col("low_direction").alias("hit"), F.lit("low_direction").alias("issue"), F.col("mean_direction").alias("value")),
        F.struct(F.col("high_distance").alias("hit"), F.lit("high_distance").alias("issue"), F.col("mean_distance").alias("value")),
    )
    return checks.select(key, *extra_keys, F.explode(F.filter(issues, lambda s: s["hit"])).alias("i")).select(
        key, *extra_keys, "i.issue", "i.value"
    )


def sanity_totals(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count(F.lit(1)).alias("total_partitions"),
        F.sum("negative_rows").alias("total_negative_rows"),
        F.count_if("has_negative").alias("partitions_with_negatives"),
        F.count_if("is_extreme").alias("partitions_extreme_ape"),
        F.count_if("is_flat").alias("partitions_flat"),
        F.count_if("low_direction").alias("partitions_low_direction"),
        F.count_if("high_distance").alias("partitions_high_distance"),
    )
