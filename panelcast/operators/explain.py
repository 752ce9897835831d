"""Explanations of fitted models as aggregations over coefficient columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.functions.quarters import quarter_index
from panelcast.operators.models import regressor_pairs


def importance_average(importances: DataFrame, top: int = 10, column: str = "importances") -> DataFrame:
    """Mean importance per feature over all models that have it (``column`` is a map)."""
    return (
        importances.select(F.explode(column).alias("feature", "importance"))
        .groupBy("feature")
        .agg(F.avg("importance").alias("avg_importance"), F.count(F.lit(1)).alias("n_models"))
        .orderBy(F.col("avg_importance").desc(), "feature")
        .limit(top)
    )


def coefficient_matrix(fits: DataFrame, features: Sequence[str], key: str = "PARTITION_COLUMN", feature: str = "regressor", value: str = "coefficient") -> DataFrame:
    """Partition x regressor with 0 for what a model does not use, and the row's largest magnitude."""
    wide = fits.groupBy(key).pivot(feature, list(features)).agg(F.first(value)).na.fill(0.0, list(features))
    return wide.withColumn("max_abs", F.greatest(*[F.abs(f) for f in features]) if len(features) > 1 else F.abs(features[0]))


def top_partitions(matrix: DataFrame, n: int = 5, key: str = "PARTITION_COLUMN") -> DataFrame:
    return matrix.orderBy(F.col("max_abs").desc(), key).limit(n)


def linear_contributions(rows: DataFrame, fits: DataFrame, xs: Sequence[str], key: str = "PARTITION_COLUMN") -> DataFrame:
    """Additive share of each regressor: coefficient times distance from the training mean.

    Exact for linear models. Returns the mean magnitude per partition and regressor with its rank; the
    means come with the fits, so the rows are read once.
    """
    long = rows.select(key, F.explode(regressor_pairs(xs)).alias("_r")).select(
        key, F.col("_r.name").alias("regressor"), F.coalesce(F.col("_r.value"), F.lit(0.0)).alias("_x")
    )
    parts = long.join(fits.select(key, "regressor", "coefficient", "x_mean"), [key, "regressor"])
    share = F.abs(F.col("coefficient") * (F.col("_x") - F.col("x_mean")))
    ranked = W.partitionBy(key).orderBy(F.col("mean_abs").desc_nulls_last(), "regressor")
    return parts.groupBy(key, "regressor").agg(F.avg(share).alias("mean_abs")).withColumn("rank", F.row_number().over(ranked))


def components(df: DataFrame, keys: Sequence[str], target: str = "BB", quarter: str = "QUARTER") -> DataFrame:
    """Trend and seasonal part of each row: a fitted line, and the mean residual of its quarter of the year."""
    series = W.partitionBy(*keys)
    df = df.withColumns({"_t": quarter_index(quarter).cast("double"), "_q": F.pmod(quarter_index(quarter), F.lit(4))})
    df = df.withColumns({"_b": F.regr_slope(target, "_t").over(series), "_a": F.regr_intercept(target, "_t").over(series)})
    df = df.withColumn("trend", F.col("_a") + F.col("_b") * F.col("_t"))
    seasonal = F.avg(F.col(target) - F.col("trend")).over(W.partitionBy(*keys, "_q"))
    return df.withColumn("seasonal", seasonal).drop("_t", "_q", "_a", "_b")


def component_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg("trend").alias("trend_mean"), F.stddev_samp("trend").alias("trend_std"),
        F.min("trend").alias("trend_min"), F.max("trend").alias("trend_max"),
        F.avg("seasonal").alias("seasonal_mean"), (F.max("seasonal") - F.min("seasonal")).alias("seasonal_amplitude"),
    )


def explain_rows(contributions: DataFrame, fits: DataFrame, champions: DataFrame, model: str, handler: str = "linear", key: str = "PARTITION_COLUMN") -> DataFrame:
    """One row per fit of ``model``: kind, whether it is its partition's champion and with what error, and its importances and coefficients as JSON."""

    def as_json(name: str, value: str):
        entries = F.sort_array(F.collect_list(F.struct(F.col(name), F.round(F.col(value), 6).alias("_v"))))
        return F.to_json(F.map_from_entries(entries))

    importances = contributions.groupBy(key).agg(as_json("regressor", "mean_abs").alias("feature_importances"))
    coefficients = fits.groupBy(key).agg(as_json("regressor", "coefficient").alias("regressor_coefficients"))
    marks = champions.filter(F.col("MODEL_USED") == model).select(key, F.col("HORIZON_MAPE").alias("mape"), F.lit(True).alias("_won"))
    return (
        importances.join(coefficients, key, "full_outer")
        .join(marks, key, "left")
        .withColumns({"MODEL_USED": F.lit(model), "handler_type": F.lit(handler), "is_champion": F.coalesce("_won", F.lit(False))})
        .drop("_won")
    )


def permute_features(rows: DataFrame, xs: Sequence[str], ids: Sequence[str], buckets: int | None = None, seed: int = 42) -> DataFrame:
    """Each row once as it is and once per feature with that feature taken from another row.

    All rows stand on one ring in the order of a hash, and every feature moves by one place, so each value is used exactly once and only a single row keeps
    its own. Tasks get ranges of the hash; the last row of a range takes the first row of the next range that has any. The number of ranges follows the number
    of shuffle partitions and does not change the result.
    """
    buckets = buckets or 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draw = F.xxhash64(*[F.col(c) for c in ids], F.lit(seed))
    ring = W.partitionBy("_bucket").orderBy("_draw", *ids)
    share = F.shiftrightunsigned("_draw", 32)  # the upper half, 0 to 2**32 - 1
    dealt = rows.withColumn("_draw", draw).withColumn("_bucket", (share * buckets / (1 << 32)).cast("long"))
    values = F.struct(*[F.col(x) for x in xs])
    # one row per range: a few thousand at most, whatever the table holds
    firsts = dealt.groupBy("_bucket").agg(F.min_by(values, F.struct("_draw", *ids)).alias("_first"))
    around = W.orderBy("_bucket")
    next_first = F.coalesce(F.lead("_first", 1).over(around), F.first("_first").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    dealt = dealt.join(firsts.select("_bucket", next_first.alias("_next")), "_bucket")
    dealt = dealt.withColumn("_last", F.lead(F.lit(1), 1).over(ring).isNull())
    dealt = dealt.withColumns({f"_p_{x}": F.when(F.col("_last"), F.col(f"_next.{x}")).otherwise(F.lead(x, 1).over(ring)) for x in xs})
    variants = F.explode(F.array(F.lit("none"), *[F.lit(x) for x in xs]))
    return (
        dealt.withColumn("permuted", variants)
        .withColumns({x: F.when(F.col("permuted") == x, F.col(f"_p_{x}")).otherwise(F.col(x)) for x in xs})
        .drop("_draw", "_bucket", "_next", "_last", *[f"_p_{x}" for x in xs])
    )


def permutation_importance(scored: DataFrame, label: str = "label", predicted: str = "BILLING_PREDICTED") -> DataFrame:
    """Increase of the mean absolute error over the unpermuted rows, per feature."""
    losses = scored.groupBy("permuted").agg(F.avg(F.abs(F.col(label) - F.col(predicted))).alias("mae"))
    base = losses.filter(F.col("permuted") == "none").select(F.col("mae").alias("base_mae"))
    return (
        losses.filter(F.col("permuted") != "none")
        .crossJoin(F.broadcast(base))
        .select(F.col("permuted").alias("feature"), "base_mae", "mae", (F.col("mae") - F.col("base_mae")).alias("importance"))
    )
