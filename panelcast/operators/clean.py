"""Preparing a snapshot: fills, imputation, regressor repair, renames and row selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.config import DEMAND_SIGNAL_RENAMES, MOVING_AVERAGE_WINDOWS, REGRESSOR_COLUMNS, SIGNAL_COLUMNS
from panelcast.functions.metrics import zero_to_null
from panelcast.functions.quarters import label_is_parseable, origin_quarter, quarter_index
from panelcast.functions.stats import exact_cents


def _series(keys: Sequence[str], order: str):
    """Ordered window of one series. A series has at most one row per calendar quarter."""
    if not keys:
        raise ValueError("a series window needs at least one key column")
    return W.partitionBy(*keys).orderBy(order)


def ffill_target(df: DataFrame, keys: Sequence[str], order: str = "QUARTER_PARSED", target: str = "BB") -> DataFrame:
    """0 means unknown: it becomes NULL and then takes the last known value.

    ``<target>_RAW`` and ``is_actual`` keep what was really observed, so that later steps need not
    score against carried-forward values.
    """
    running = _series(keys, order).rowsBetween(W.unboundedPreceding, 0)
    return (
        df.withColumn(f"{target}_RAW", zero_to_null(target))
        .withColumn("is_actual", F.col(f"{target}_RAW").isNotNull())
        .withColumn(target, F.last(f"{target}_RAW", ignorenulls=True).over(running))
    )


def fill_cascade(df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: str = "QUARTER_PARSED") -> DataFrame:
    """Last known value, else the next known one, else 0."""
    window = _series(keys, order)
    before = window.rowsBetween(W.unboundedPreceding, 0)
    after = window.rowsBetween(0, W.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after), F.lit(0.0))
            for c in columns
        }
    )


def moving_average(
    df: DataFrame, keys: Sequence[str], order: str = "QUARTER_PARSED", target: str = "BB", prefix: str = "MA_",
    windows: Sequence[int] = tuple(MOVING_AVERAGE_WINDOWS), money: bool = False,
) -> DataFrame:
    """Trailing means including the current row; short at the start of a series.

    With ``money`` the target holds whole cents, and sums are exact; any other target is averaged as it is.
    """
    series = _series(keys, order)
    out = {}
    for n in windows:
        frame = series.rowsBetween(-(n - 1), 0)
        if money:
            cents = F.sum(exact_cents(target).cast("decimal(20,0)")).over(frame).cast("double")
            out[f"{prefix}{n}Q"] = F.try_divide(cents, F.count(target).over(frame) * F.lit(100.0))
        else:
            out[f"{prefix}{n}Q"] = F.avg(target).over(frame)
    return df.withColumns(out)


def impute_history_ma(
    df: DataFrame, keys: Sequence[str], order: str = "QUARTER_PARSED", target: str = "BB",
    prefix: str = "BILLING_MOVING_AVERAGE_",
) -> DataFrame:
    """Rebuild the moving averages from four hidden quarters before the series.

    The averages of the first row fix those quarters one by one: each longer average adds one unknown.
    A series whose first row lacks the target or an average keeps its values.
    """
    windows = MOVING_AVERAGE_WINDOWS
    series = _series(keys, order)
    whole = series.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = {n: F.first(f"{prefix}{n}Q").over(whole) for n in windows}
    df = df.withColumns(
        {"_y0": F.first(target).over(whole), "_place": F.row_number().over(series)}
        | {f"_m{n}": c for n, c in first.items()}
        | {f"_tail{n}": F.sum(target).over(series.rowsBetween(-(n - 1), 0)) for n in windows}
        | {f"_known{n}": F.count(target).over(series.rowsBetween(-(n - 1), 0)) for n in windows}
    )
    complete = F.col("_y0").isNotNull()
    # total of the n quarters ending at the first row is n * average; hidden quarter n-1 is the increment
    total: dict[int, Column] = {1: F.col("_y0")}
    for n in windows:
        complete = complete & F.col(f"_m{n}").isNotNull()
        total[n] = F.col(f"_m{n}") * n
    rebuilt = {}
    for n in windows:
        borrowed = F.lit(0.0)
        count = F.col(f"_known{n}")
        # row ``place`` still reaches n - place hidden quarters; their sum is total[n-place+1] - y0
        for place in range(1, n):
            reach = n - place
            borrowed = F.when(F.col("_place") == place, total[reach + 1] - F.col("_y0")).otherwise(borrowed)
            count = F.when(F.col("_place") == place, F.col(f"_known{n}") + reach).otherwise(count)
        value = F.try_divide(F.coalesce(F.col(f"_tail{n}"), F.lit(0.0)) + borrowed, count.cast("double"))
        # a gap inside the window is skipped, not counted
        rebuilt[f"{prefix}{n}Q"] = F.when(complete, value).otherwise(F.col(f"{prefix}{n}Q"))
    helpers = ["_y0", "_place"] + [f"{p}{n}" for n in windows for p in ("_m", "_tail", "_known")]
    return df.withColumns(rebuilt).drop(*helpers)


def adjust_regressors(
    df: DataFrame, regressors: Sequence[str] = tuple(REGRESSOR_COLUMNS), main: str = "BILLING_MOVING_AVERAGE_2Q",
    segment: str = "MARKET_SEGMENT", threshold: float = 0.1, nonzero_only: str = "GAMING",
) -> DataFrame:
    """A regressor far below the main one is taken from the main one.

    In the segment ``nonzero_only`` a 0 is real and stays. Missing regressors stay missing.
    """
    out = {}
    for r in regressors:
        low = F.col(r) < F.col(main) * threshold
        spared = (F.col(segment) == nonzero_only) & (F.col(r) == 0)
        out[r] = F.when(low & ~F.coalesce(spared, F.lit(False)), F.col(main)).otherwise(F.col(r))
    return df.withColumns(out)


def ensure_signals(df: DataFrame, signals: Sequence[str] = tuple(SIGNAL_COLUMNS)) -> DataFrame:
    absent = {s: F.lit(0.0) for s in signals if s not in df.columns}
    return df.withColumns(absent) if absent else df


def standard_renames(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Short names for target and signals; a trailing ``_x`` left by a join goes away."""
    mapping = DEMAND_SIGNAL_RENAMES if renames is None else renames
    names = [mapping.get(c, c) for c in df.columns]
    return df.toDF(*[n.removesuffix("_x") for n in names])


def prepare_for_scoring(df: DataFrame, **adjust) -> DataFrame:
    return adjust_regressors(standard_renames(df), **adjust)


def zero_regressor_fill(df: DataFrame, regressors: Sequence[str], main: str = "BILLING_MOVING_AVERAGE_2Q") -> DataFrame:
    return df.withColumns({r: F.when(F.col(r) == 0, F.col(main)).otherwise(F.col(r)) for r in regressors})


def segment_regressors(segments: DataFrame, regressors: DataFrame, excluded: DataFrame) -> DataFrame:
    """Segment x regressor pairs without the excluded ones; all three inputs are configuration."""
    return segments.crossJoin(F.broadcast(regressors)).join(
        F.broadcast(excluded), ["MARKET_SEGMENT", "regressor"], "left_anti"
    )


def cap_floor(df: DataFrame, keys: Sequence[str], target: str = "BB", factor: float = 10.0) -> DataFrame:
    """Growth limits of a series: 0 and a multiple of its largest value."""
    return df.withColumns({"cap": F.max(target).over(W.partitionBy(*keys)) * factor, "floor": F.lit(0.0)})


def output_format(df: DataFrame, columns: Sequence[str], suffix: str = "_OUTPUT") -> DataFrame:
    """Existing columns in the given order, marked with a suffix."""
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in columns if c in df.columns])


def strip_suffix(df: DataFrame, suffix: str = "_OUTPUT") -> DataFrame:
    return df.toDF(*[c.removesuffix(suffix) for c in df.columns])


def complete_row_ape(df: DataFrame, ape_col: str = "APE") -> DataFrame:
    """The error is kept only where every other column is known."""
    known = F.lit(True)
    for c in df.columns:
        if c != ape_col:
            known = known & F.col(c).isNotNull()
    return df.withColumn(ape_col, F.when(known, F.col(ape_col)))


def valid_actuals(df: DataFrame, target: str = "BB") -> DataFrame:
    return df.filter(F.col(target).isNotNull() & (F.col(target) != 0))


def valid_metrics(df: DataFrame, metric: str = "MAPE") -> DataFrame:
    return df.filter(F.col(metric).isNotNull() & ~F.isnan(metric) & (F.col(metric) > 0))


def unscored_predictions(df: DataFrame, actual: str = "BILLING") -> DataFrame:
    return df.filter(F.col(actual).isNull() | (F.col(actual) == 0))


def null_ape_missing_indicator(df: DataFrame, ape_col: str = "APE", columns: Sequence[str] | None = None) -> DataFrame:
    """APE is dropped where a column named ``*_INDICATOR`` is missing (or any of ``columns``).

    The signal indicators are named ``INDICATOR_*``, so the default rule leaves the shipped flow alone.
    """
    names = [c for c in df.columns if c.endswith("_INDICATOR")] if columns is None else list(columns)
    if not names:
        return df
    missing = F.lit(False)
    for c in names:
        missing = missing | F.col(c).isNull()
    return df.withColumn(ape_col, F.when(~missing, F.col(ape_col)))


def remove_unwanted_rows(
    df: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN",), max_horizon: int = 4, order: str = "QUARTER",
    version: str = "MOF_VERSION", quarter: str = "QUARTER",
) -> DataFrame:
    """Drop the origin quarter and, for short horizons, Q+5 and Q+6.

    Whether a series is filtered at all is decided by its first known origin label.
    """
    first = F.first(version, ignorenulls=True).over(
        _series(keys, order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    horizon = quarter_index(quarter) - quarter_index(origin_quarter(version))
    unwanted = [k for k in (5, 6) if k > max_horizon]
    hit = F.coalesce(origin_quarter(version) == F.col(quarter), F.lit(False)) | F.coalesce(
        horizon.isin(unwanted) if unwanted else F.lit(False), F.lit(False)
    )
    return (
        df.withColumn("_filter", label_is_parseable(first))
        .filter(~(F.col("_filter") & hit))
        .drop("_filter")
    )


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given order.

    ``min_by`` over the order columns reduces map-side, so a key with very many copies is no problem.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def dq_exclude(df: DataFrame, failed: DataFrame, key: str = "PARTITION_COLUMN") -> DataFrame:
    return df.join(failed.select(key).distinct(), key, "left_anti")


def restrict_to(df: DataFrame, allowed: DataFrame, keys: Sequence[str] = ("PARTITION_COLUMN",)) -> DataFrame:
    return df.join(allowed.select(*keys).distinct(), list(keys), "left_semi")
