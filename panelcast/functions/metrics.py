"""Error measures, demand indicators and their comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.quarters import as_column

# fixed values: indicator labels with their rank, and the ratio limits between them
INDICATOR_RANKS = {"VERY LOW": 1, "LOW": 2, "FLAT": 3, "HIGH": 4, "VERY HIGH": 5}
LOW_LIMIT, NEAR_LOW_LIMIT, NEAR_HIGH_LIMIT, HIGH_LIMIT = -0.2, -0.1, 0.1, 0.2


def null_if_nan(value: Column | str) -> Column:
    c = as_column(value)
    return F.when(~F.isnan(c), c)


def zero_to_null(value: Column | str) -> Column:
    c = as_column(value)
    return F.when(c != 0, c)


def ape(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute percentage error; NULL where the actual is 0 or either side is missing."""
    a, p = as_column(actual), as_column(predicted)
    return F.abs(F.try_divide(a - p, a)) * 100


def realized_ape(actual: Column | str, predicted: Column | str) -> Column:
    """Monitoring's error: divided by the signed actual, so negative actuals give negative errors."""
    a, p = as_column(actual), as_column(predicted)
    return F.try_divide(F.abs(a - p), a) * 100


def indicator(value: Column | str, signal: Column | str) -> Column:
    """Where a value lies against a demand signal, in five classes."""
    s = as_column(signal)
    ratio = F.try_divide(as_column(value) - s, s)
    return (
        F.when(ratio.isNull() | F.isnan(ratio), F.lit(None).cast("string"))
        .when(ratio < LOW_LIMIT, "VERY LOW")
        .when(ratio <= NEAR_LOW_LIMIT, "LOW")
        .when(ratio < NEAR_HIGH_LIMIT, "FLAT")
        .when(ratio < HIGH_LIMIT, "HIGH")
        .otherwise("VERY HIGH")
    )


def indicator_rank(label: Column | str) -> Column:
    c = as_column(label)
    rank = F.lit(None).cast("int")
    for name, place in INDICATOR_RANKS.items():
        rank = F.when(c == name, F.lit(place)).otherwise(rank)
    return rank


def validation_distance(observed: Column | str, forecast: Column | str) -> Column:
    """Classes between the two indicators; NULL unless both are known."""
    return F.abs(indicator_rank(observed) - indicator_rank(forecast)).cast("double")


def _side(label: Column | str) -> Column:
    """-1 below, 0 flat, 1 above."""
    return F.signum((indicator_rank(label) - INDICATOR_RANKS["FLAT"]).cast("double"))


def directional_correctness(observed: Column | str, forecast: Column | str) -> Column:
    """1.0 if both indicators are on the same side of FLAT, else 0.0; NULL unless both are known."""
    return (_side(observed) == _side(forecast)).cast("double")


def clip_negative(value: Column | str) -> Column:
    """Floor at 0 that keeps NULL."""
    c = as_column(value)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def is_valid_metric(value: Column | str) -> Column:
    c = as_column(value)
    return F.coalesce(c.isNotNull() & ~F.isnan(c), F.lit(False))
