"""Scoring predictions: errors, indicators, per-horizon metrics, backtests and champions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.config import DEMAND_SIGNALS
from panelcast.functions.metrics import ape, directional_correctness, indicator, is_valid_metric, validation_distance
from panelcast.functions.quarters import quarter_diff
from panelcast.operators.clean import remove_unwanted_rows

HORIZONS = [1, 2, 3, 4, 5, 6]


def indicator_columns(signals: Sequence[str] = tuple(DEMAND_SIGNALS)) -> list[str]:
    parts = ["INDICATOR", "INDICATOR_FORECASTED", "VALIDATION_DISTANCE", "DIRECTIONAL_CORRECTNESS"]
    return [f"{p}_{s}_REFERENCED" for s in signals for p in parts]


def add_indicators(
    df: DataFrame, signals: Sequence[str] = tuple(DEMAND_SIGNALS), keys: Sequence[str] | None = None,
    actual: str = "BILLING", predicted: str = "BILLING_PREDICTED",
    val: str = "VERIFICATION_HORIZON", pred: str = "PREDICTION_HORIZON",
) -> DataFrame:
    """Observed and forecast indicator per signal, their distance and their direction.

    With ``keys`` the rows are masked by their series' horizons: training rows lose signal and both
    indicators, test rows lose the observed one. Nothing is masked where a median horizon is 0.
    """
    masked = keys is not None
    if masked:
        series = W.partitionBy(*keys)
        df = df.withColumns(
            {
                "_v": F.percentile(val, F.lit(0.5)).over(series).cast("int"),
                "_p": F.percentile(pred, F.lit(0.5)).over(series).cast("int"),
            }
        )
        active = F.coalesce((F.col("_v") != 0) & (F.col("_p") != 0) & (F.col("_v") + F.col("_p") > 0), F.lit(False))
        df = df.withColumns(
            {
                "_train": active & F.coalesce(F.col(val) > F.col("_v"), F.lit(False)),
                "_test": active & F.coalesce(F.col(val) <= 0, F.lit(False)),
            }
        ).drop("_v", "_p")
        train, test = F.col("_train"), F.col("_test")
    else:
        train = test = F.lit(False)

    classes: dict[str, Column] = {}
    for s in signals:
        classes[f"INDICATOR_{s}_REFERENCED"] = F.when(~(train | test), indicator(actual, s))
        classes[f"INDICATOR_FORECASTED_{s}_REFERENCED"] = F.when(~train, indicator(predicted, s))
    df = df.withColumns(classes)
    marks: dict[str, Column] = {}
    for s in signals:
        pair = (F.col(f"INDICATOR_{s}_REFERENCED"), F.col(f"INDICATOR_FORECASTED_{s}_REFERENCED"))
        marks[f"VALIDATION_DISTANCE_{s}_REFERENCED"] = validation_distance(*pair)
        marks[f"DIRECTIONAL_CORRECTNESS_{s}_REFERENCED"] = directional_correctness(*pair)
        if masked:
            marks[s] = F.when(~train, F.col(s))
    return df.withColumns(marks).drop("_train", "_test")


def evaluate_predictions(
    df: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN",), signals: Sequence[str] = tuple(DEMAND_SIGNALS),
    max_horizon: int = 4, actual: str = "BILLING", predicted: str = "BILLING_PREDICTED",
) -> DataFrame:
    """Error, masked indicators, then removal of unwanted rows. One shuffle: all windows share the series key."""
    scored = df.withColumn("APE", ape(actual, predicted))
    scored = add_indicators(scored, signals, keys, actual, predicted)
    return remove_unwanted_rows(scored, keys, max_horizon)


def backfill_from_q2(
    df: DataFrame, actual: str = "BILLING", keys: Sequence[str] = ("QUARTER", "MARKET_SEGMENT"), order: Sequence[str] = ("MOF_VERSION",),
    scope: Sequence[str] = (), horizon: str = "k",
) -> DataFrame:
    """Q+3 and Q+4 rows without an actual take the Q+2 actual of the same quarter and segment."""
    from panelcast.operators.windows import salted, salted_lookup

    on = [*scope, *keys]
    donors = (
        df.filter(F.col(horizon) == 2)
        .groupBy(*on)
        .agg(F.min_by(F.col(actual), F.struct(*order)).alias("_donor"))
    )
    needs = F.col(horizon).isin(3, 4) & (F.col(actual).isNull() | (F.col(actual) == 0))
    return (
        salted(df)
        .join(salted_lookup(donors), [*on, "_salt"], "left")
        .withColumn(actual, F.when(needs, F.col("_donor")).otherwise(F.col(actual)))
        .drop("_donor", "_salt")
    )


def horizon_rows(df: DataFrame, origin: str = "ORIGIN_QUARTER", quarter: str = "QUARTER", max_horizon: int = 6) -> DataFrame:
    """Rows 1..max_horizon quarters after the origin, with that distance as ``k``."""
    return df.withColumn("k", quarter_diff(quarter, origin)).filter(F.col("k").between(1, max_horizon))


def horizon_metrics(
    df: DataFrame, keys: Sequence[str], signals: Sequence[str] = tuple(DEMAND_SIGNALS),
    actual: str = "BILLING", predicted: str = "BILLING_PREDICTED",
) -> DataFrame:
    """Long form, one row per key and horizon: mean error, distance and direction per signal.

    Expects ``k`` and the indicator columns. Everything is an average, so it reduces map-side. A
    horizon without any actual has no metrics at all.
    """
    has_actual = F.count(actual) > 0
    out = [F.avg(ape(actual, predicted)).alias("MAPE"), F.count(ape(actual, predicted)).alias("n_scored")]
    for s in signals:
        for name in ("VALIDATION_DISTANCE", "DIRECTIONAL_CORRECTNESS"):
            column = F.avg(f"{name}_{s}_REFERENCED")
            out.append(F.when(has_actual, column).alias(f"{s}_{name}"))
    return df.groupBy(*keys, "k").agg(*out)


def horizon_mape_wide(
    df: DataFrame, keys: Sequence[str], start: int = 1, end: int = 6, actual: str = "BILLING", predicted: str = "BILLING_PREDICTED",
) -> DataFrame:
    """Q1..Q6 error columns and their mean over ``start..end``: a mean of means, not of rows."""
    error = ape(actual, predicted)
    per_horizon = [F.avg(F.when(F.col("k") == h, error)).alias(f"Q{h}_MAPE") for h in HORIZONS]
    wide = df.groupBy(*keys).agg(*per_horizon)
    return wide.withColumn("HORIZON_MAPE", mean_of_columns([f"Q{h}_MAPE" for h in range(start, end + 1)]))


def mean_of_columns(names: Sequence[str]) -> Column:
    total = F.lit(0.0)
    known = F.lit(0)
    for n in names:
        total = total + F.coalesce(F.col(n), F.lit(0.0))
        known = known + F.col(n).isNotNull().cast("int")
    return F.when(known > 0, total / F.nullif(known, F.lit(0)).cast("double"))


def evaluate_windows(
    df: DataFrame, windows: DataFrame, keys: Sequence[str], start: int = 1, end: int = 6,
    actual: str = "BILLING", predicted: str = "BILLING_PREDICTED", max_horizon: int = 6,
) -> DataFrame:
    """One row per key and backtest window: overall error, per-horizon errors, number of scored rows.

    ``df`` carries ``k``. The origin quarter itself (k = 0) and quarters beyond ``max_horizon`` are no forecasts and never count; in-sample rows
    count in MAPE only. A single aggregation serves all windows.
    """
    from panelcast.operators.windows import window_quarters_join

    error = ape(actual, predicted)
    bounds = ["BACKTEST_WINDOW", "WINDOW_START_QUARTER", "WINDOW_END_QUARTER"]
    return (
        window_quarters_join(df.filter((F.col("k") != 0) & (F.col("k") <= max_horizon)), windows)
        .groupBy(*keys, *bounds)
        .agg(
            F.avg(error).alias("MAPE"),
            F.count(error).cast("double").alias("prediction_count"),
            *[F.avg(F.when(F.col("k") == h, error)).alias(f"Q{h}_MAPE") for h in HORIZONS],
        )
        .withColumn("HORIZON_MAPE", mean_of_columns([f"Q{h}_MAPE" for h in range(start, end + 1)]))
    )


def backtest_aggregate(metrics: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN", "MODEL_USED"), penalty: float = 0.5) -> DataFrame:
    """Mean and spread over windows, and the score that punishes unstable models."""
    mean, spread = F.col("BT_MEAN_HORIZON_MAPE"), F.col("BT_STD_HORIZON_MAPE")
    return (
        metrics.groupBy(*keys)
        .agg(
            F.avg("HORIZON_MAPE").alias("BT_MEAN_HORIZON_MAPE"),
            F.stddev_samp("HORIZON_MAPE").alias("BT_STD_HORIZON_MAPE"),
            F.count("HORIZON_MAPE").alias("BT_N_WINDOWS"),
            F.avg("MAPE").alias("MAPE"),
            F.stddev_samp("MAPE").alias("BT_STD_MAPE"),
            F.sum("prediction_count").alias("prediction_count"),
            *[F.avg(f"Q{h}_MAPE").alias(f"Q{h}_MAPE") for h in HORIZONS],
        )
        .withColumn("BT_CV", F.coalesce(F.try_divide(spread, mean), F.lit(0.0)))
        .withColumn("BT_SELECTION_SCORE", mean * (1 + F.col("BT_CV") * penalty))
        .withColumn("HORIZON_MAPE", mean)
    )


def select_champion(
    metrics: DataFrame, key: Sequence[str] = ("PARTITION_COLUMN",), model: str = "MODEL_USED",
    score: str = "BT_SELECTION_SCORE", fallbacks: Sequence[str] = ("HORIZON_MAPE", "MAPE"), metric: str = "MAPE",
) -> DataFrame:
    """The model with the lowest score per key; equal scores go to the first name.

    The score column is the first candidate that has any value in the whole table. Only models with a
    valid error compete. ``min_by`` keeps one row per key map-side, so there is no sort. Scores are
    averages whose last bits depend on the order of addition, hence they are compared at 9 decimals: a tie
    stays a tie on every run.
    """
    rivals = metrics.filter(is_valid_metric(metric) & (F.col(metric) > 0))
    candidates = [c for c in (score, *fallbacks) if c in metrics.columns]
    if len(candidates) == 1:
        scored = rivals.withColumn("selection_score", F.col(candidates[0]))
    else:
        verdict = rivals.agg(*[F.max(F.col(c).isNotNull()).alias(f"_has_{i}") for i, c in enumerate(candidates)])
        chosen = F.lit(None).cast("double")
        for i, c in reversed(list(enumerate(candidates))):
            chosen = F.when(F.col(f"_has_{i}"), F.col(c)).otherwise(chosen)
        scored = rivals.crossJoin(F.broadcast(verdict)).withColumn("selection_score", chosen)
        scored = scored.drop(*[f"_has_{i}" for i in range(len(candidates))])
    scored = scored.filter(F.col("selection_score").isNotNull())
    rest = [c for c in scored.columns if c not in key]
    best = scored.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(F.round("selection_score", 9), model)).alias("_row"))
    return best.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def quality_gate_flags(champions: DataFrame, score: str = "selection_score", low: float = 1.0, high: float = 200.0) -> DataFrame:
    """Champions outside the plausible error range, with the reason."""
    s = F.col(score)
    reason = F.when(s > high, "above_max").when(s < low, "below_min")
    return champions.withColumn("gate_reason", reason).filter(F.col("gate_reason").isNotNull())


def champion_averages(champions: DataFrame) -> DataFrame:
    names = ["selection_score", "BT_CV", "BT_STD_HORIZON_MAPE", *[f"Q{h}_MAPE" for h in HORIZONS]]
    return champions.agg(
        F.count(F.lit(1)).alias("champions"), *[F.avg(n).alias(f"avg_{n}") for n in names if n in champions.columns]
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row per key, ties broken by the later columns of ``newest``."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
