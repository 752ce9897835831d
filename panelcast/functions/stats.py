"""Aggregate expressions that behave the same for constant, short and gappy groups."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.quarters import as_column


def varies(value: Column | str) -> Column:
    """Whether a group has two different values.

    A spread of 0 is no safe test: merging partial results leaves about 1e-16 for a constant column.
    """
    c = as_column(value)
    return F.min(c) < F.max(c)


def safe_corr(left: Column | str, right: Column | str) -> Column:
    """Pearson correlation over the pairs known on both sides; NULL for a constant side.

    ``corr`` divides by zero under ANSI rules when a side is constant, hence the spelled-out form.
    """
    a0, b0 = as_column(left), as_column(right)
    both = a0.isNotNull() & b0.isNotNull()
    a, b = F.when(both, a0), F.when(both, b0)
    return F.when(varies(a) & varies(b), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def sample_skewness(value: Column | str) -> Column:
    """Bias-corrected skewness (needs 3 values and some spread)."""
    c = as_column(value)
    n = F.count(c).cast("double")
    return F.when((n >= 3) & varies(c), F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(value: Column | str) -> Column:
    """Bias-corrected excess kurtosis (needs 4 values and some spread)."""
    c = as_column(value)
    n = F.count(c).cast("double")
    return F.when((n >= 4) & varies(c), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def jarque_bera(value: Column | str) -> Column:
    """Normality statistic from population moments."""
    c = as_column(value)
    n = F.count(c).cast("double")
    return F.when(varies(c), n / 6 * (F.pow(F.skewness(c), 2) + F.pow(F.kurtosis(c), 2) / 4))


def fourier_terms(day: Column | str, period_days: float, order: int, anchor: str = "1970-01-01") -> dict[str, Column]:
    """``sin_j`` / ``cos_j`` columns for j = 1..order over a period in days."""
    t = F.datediff(as_column(day), F.lit(anchor).cast("date")).cast("double")
    terms: dict[str, Column] = {}
    for j in range(1, order + 1):
        angle = t * (2.0 * math.pi * j / period_days)
        terms[f"sin_{j}"] = F.sin(angle)
        terms[f"cos_{j}"] = F.cos(angle)
    return terms


def exact_cents(value: Column | str) -> Column:
    """Money as whole cents, so that sums do not depend on their order."""
    return F.floor(as_column(value) * 100 + 0.5)
