"""Input diagnostics: is the panel internally consistent, and does it carry signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.config import MOVING_AVERAGE_WINDOWS
from panelcast.functions.stats import jarque_bera, safe_corr, sample_kurtosis, sample_skewness, varies
from panelcast.operators.clean import moving_average
from panelcast.operators.ranking import average_ranks, exact_quantiles

NUMERIC_COLUMNS = [
    "BB",
    *[f"BILLING_MOVING_AVERAGE_{n}Q" for n in MOVING_AVERAGE_WINDOWS],
    "MOF_0_MONTH", "MOF_PLUS_BUFFER_0_MONTH", "SELLIN_0_MONTH", "SR_0_MONTH",
    "SELLIN_MINUS3_MONTH", "MOF_MINUS3_MONTH", "SR_MINUS3_MONTH", "MOF_PLUS_BUFFER_MINUS3_MONTH",
]
SIGNAL_PAIR_COLUMNS = ["MOF_0_MONTH", "SR_0_MONTH", "SELLIN_0_MONTH", "MOF_PLUS_BUFFER_0_MONTH"]
RATIO_PAIRS = [("BB", "MOF_0_MONTH"), ("BB", "SR_0_MONTH"), ("BB", "SELLIN_0_MONTH"), ("MOF_0_MONTH", "SR_0_MONTH")]
LAG_PAIRS = [
    ("SELLIN_0_MONTH", "SELLIN_MINUS3_MONTH"),
    ("SR_0_MONTH", "SR_MINUS3_MONTH"),
    ("MOF_PLUS_BUFFER_0_MONTH", "MOF_PLUS_BUFFER_MINUS3_MONTH"),
]


def grade(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit the value exceeds."""
    out = F.lit(otherwise)
    for limit, label in reversed(list(steps)):
        out = F.when(value > limit, label).otherwise(out)
    return out


def unpivot(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(ids), list(columns), "column", "value")


def basic_stats(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS)) -> DataFrame:
    """Shares of missing, zero and negative values, range, mean and spread per column."""
    v = F.col("value")

    def share(condition: Column) -> Column:
        return F.round(F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100, 1)

    return unpivot(df, columns).groupBy("column").agg(
        share(v.isNull()).alias("null_pct"),
        share(v == 0).alias("zero_pct"),
        share(v < 0).alias("negative_pct"),
        F.round(F.min(v), 2).alias("min"),
        F.round(F.max(v), 2).alias("max"),
        F.round(F.avg(v), 2).alias("mean"),
        F.round(F.stddev_samp(v), 2).alias("std"),
        F.round(F.try_divide(F.stddev_samp(v), F.avg(v)), 3).alias("cv"),
    )


def column_flags(stats: DataFrame) -> DataFrame:
    """Suspicious columns, and whether all columns live on one scale."""
    scale = stats.filter(F.col("mean").isNotNull() & (F.col("mean") != 0)).agg(
        F.coalesce(F.try_divide(F.stddev_pop("mean"), F.avg("mean")), F.lit(0.0)).alias("scale_cv")
    )
    return (
        stats.select(
            "column",
            F.coalesce(F.col("std") < 0.01, F.lit(False)).alias("is_constant"),
            (F.col("zero_pct") > 50).alias("mostly_zero"),
            (F.col("negative_pct") > 5).alias("has_negatives"),
        )
        .crossJoin(F.broadcast(scale))
        .withColumn("similar_scale", F.col("scale_cv") < 0.3)
    )


def _pair_correlations(complete: DataFrame, columns: Sequence[str], left: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each pair ``a`` before ``b``, for rows without gaps.

    A row is laid out once per left column and grouped by that column's name: the aggregation has one
    covariance per column instead of one per pair, small enough to stay in generated code, and reduces
    map-side to one row per name.
    """
    firsts = list(left) if left is not None else list(columns[:-1])
    place = {c: i for i, c in enumerate(columns)}
    cells = F.array(*[F.struct(F.lit(place[c]).alias("i"), F.col(c).alias("x")) for c in firsts])
    long = complete.select(*columns, F.explode(cells).alias("_c")).select(*columns, F.col("_c.i").alias("_i"), F.col("_c.x").alias("_x"))
    spread = F.stddev_pop("_x")
    moments = long.groupBy("_i").agg(
        *[
            F.when(varies("_x") & varies(c), F.try_divide(F.covar_pop("_x", c), spread * F.stddev_pop(c))).alias(f"_r{place[c]}")
            for c in columns
        ]
    )
    names = F.array(*[F.lit(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(i).alias("j"), F.col(f"_r{i}").alias("corr")) for i in range(len(columns))])
    return (
        moments.select("_i", F.explode(cells).alias("_o"))
        .filter(F.col("_o.j") > F.col("_i"))
        .select(names[F.col("_i")].alias("a"), names[F.col("_o.j")].alias("b"), F.col("_o.corr").alias("corr"))
    )


def pearson_matrix(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS), left: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every pair (or of the ``left`` columns with later ones) over rows complete in all columns."""
    return _pair_correlations(df.select(*columns).dropna(), list(columns), left)


def spearman_matrix(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("PARTITION_COLUMN", "QUARTER"), buckets: int | None = None, left: Sequence[str] | None = None) -> DataFrame:
    """Pearson over mean ranks. The ranks are global, so they are computed in buckets, see ``ranking``."""
    long = unpivot(df.dropna(subset=list(columns)), columns, ids)
    ranks = average_ranks(long, "column", "value", buckets)
    wide = (
        long.join(ranks, ["column", "value"])
        .groupBy(*ids)
        .agg(*[F.max(F.when(F.col("column") == c, F.col("avg_rank"))).alias(c) for c in columns])
    )
    return _pair_correlations(wide.select(*columns), list(columns), left)


def signal_strength(pearson: DataFrame, spearman: DataFrame, target: str = "BB") -> DataFrame:
    """How strongly each feature follows the target."""
    p = pearson.filter(F.col("a") == target).select(F.col("b").alias("feature"), F.abs("corr").alias("abs_pearson"))
    s = spearman.filter(F.col("a") == target).select(F.col("b").alias("feature"), F.abs("corr").alias("abs_spearman"))
    strongest = F.greatest("abs_pearson", "abs_spearman")
    return p.join(s, "feature").withColumn("signal", grade(strongest, [(0.5, "SIGNAL"), (0.2, "WEAK")], "NOISE")).orderBy(
        F.col("abs_pearson").desc(), "feature"
    )


def intersignal_strength(pearson: DataFrame, signals: Sequence[str] = tuple(SIGNAL_PAIR_COLUMNS)) -> DataFrame:
    inside = pearson.filter(F.col("a").isin(list(signals)) & F.col("b").isin(list(signals)))
    return inside.agg(F.avg("corr").alias("avg_corr"), F.count("corr").alias("n_pairs")).withColumn(
        "strength", grade(F.col("avg_corr"), [(0.7, "STRONG"), (0.3, "MODERATE")], "WEAK/ABSENT")
    )


def _ratios(df: DataFrame, pairs: Sequence[tuple[str, str]], ids: Sequence[str] = ()) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(f"{a}/{b}").alias("ratio"), F.when(F.col(a) != 0, F.try_divide(F.col(a), F.col(b))).alias("r")) for a, b in pairs]
    )
    return df.select(*ids, F.explode(cells).alias("c")).select(*ids, "c.ratio", "c.r").filter(F.col("r").isNotNull())


def ratio_stability(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(RATIO_PAIRS), buckets: int | None = None) -> DataFrame:
    """Mean and spread of column ratios after trimming the outer percent on both sides."""
    long = _ratios(df, pairs)
    limits = exact_quantiles(long, "ratio", "r", [0.01, 0.99], buckets)
    sizes = long.groupBy("ratio").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 5)
    cv = F.try_divide(F.col("std"), F.abs("mean"))
    return (
        long.join(F.broadcast(limits), "ratio")
        .join(F.broadcast(sizes), "ratio")
        .filter(F.col("r").between(F.col("q_0"), F.col("q_1")))
        .groupBy("ratio")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"))
        .withColumn("cv", cv)
        .withColumn(
            "label",
            F.when(F.col("cv") < 0.1, "CONSTANT").when(F.col("cv") < 0.5, "LOW_VARIANCE").when(F.col("cv") < 1.0, "MODERATE").otherwise("HIGH_VARIANCE"),
        )
    )


def ratio_cv_by_series(df: DataFrame, pair: tuple[str, str] = ("BB", "MOF_0_MONTH"), key: str = "PARTITION_COLUMN") -> DataFrame:
    """Spread of a ratio inside each series of at least 3 values."""
    per = _ratios(df, [pair], [key]).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.try_divide(F.stddev_samp("r"), F.abs(F.avg("r"))).alias("ratio_cv")
    )
    return per.filter(F.col("n_rows") >= 3).withColumn("ratio_cv", F.round("ratio_cv", 4))


def ratio_cv_summary(per_series: DataFrame) -> DataFrame:
    return per_series.agg(F.count(F.lit(1)).alias("n_series"), F.avg("ratio_cv").alias("avg_cv")).withColumn(
        "label", F.when(F.col("avg_cv") < 0.2, "STABLE_WITHIN").otherwise("VARIES_WITHIN")
    )


def distribution_shape(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_COLUMNS), min_rows: int = 10) -> DataFrame:
    """Skewness, excess kurtosis, a normality statistic and a shape label per column."""
    s, k = F.col("skewness"), F.col("kurtosis")
    shape = (
        F.when((F.abs(s) < 0.5) & (F.abs(k) < 1), "SYMMETRIC")
        .when(s > 1, "RIGHT-SKEWED")
        .when(s < -1, "LEFT-SKEWED")
        .when(F.abs(k) > 3, "HEAVY-TAILED")
        .otherwise("MODERATE")
    )
    return (
        unpivot(df, columns)
        .groupBy("column")
        .agg(
            F.count("value").alias("n"),
            sample_skewness("value").alias("skewness"),
            sample_kurtosis("value").alias("kurtosis"),
            jarque_bera("value").alias("jarque_bera"),
        )
        .filter(F.col("n") >= min_rows)
        .withColumn("shape", shape)
    )


def segment_distribution(df: DataFrame, segment: str = "MARKET_SEGMENT", target: str = "BB") -> DataFrame:
    return (
        df.groupBy(segment)
        .agg(
            F.count(target).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
            sample_skewness(target).alias("skew"), F.min(target).alias("min"), F.max(target).alias("max"),
        )
        .filter(F.col("n") >= 3)
    )


def all_close(a: Column, c: Column, tolerance: float = 1e-3) -> Column:
    return F.bool_and(F.abs(a - c) <= F.abs(c) * tolerance + tolerance)


def ma_consistency(df: DataFrame, key: str = "PARTITION_COLUMN", order: str = "QUARTER_PARSED", target: str = "BB", prefix: str = "BILLING_MOVING_AVERAGE_") -> DataFrame:
    """Stored against recomputed moving averages, per series and window length."""
    rows = moving_average(df, [key], order, target, "_c")
    cells = F.array(
        *[F.struct(F.lit(n).alias("window"), F.col(f"{prefix}{n}Q").alias("a"), F.col(f"_c{n}Q").alias("c")) for n in MOVING_AVERAGE_WINDOWS]
    )
    pairs = rows.select(key, F.explode(cells).alias("x")).select(key, "x.window", "x.a", "x.c")
    pairs = pairs.filter(F.col("a").isNotNull() & F.col("c").isNotNull() & (F.col("a") != 0))
    return (
        pairs.groupBy(key, "window")
        .agg(
            F.count(F.lit(1)).alias("n_compared"),
            all_close(F.col("a"), F.col("c")).alias("exact_match"),
            F.round(safe_corr("a", "c"), 4).alias("correlation"),
            F.round(F.avg(F.abs(F.try_divide(F.col("a") - F.col("c"), F.col("a")))) * 100, 2).alias("mean_abs_rel_error_pct"),
        )
        .filter(F.col("n_compared") >= 3)
    )


def ma_summary(per_series: DataFrame) -> DataFrame:
    exact, corr = F.col("exact_pct"), F.col("avg_corr")
    return per_series.agg(
        (F.avg(F.col("exact_match").cast("double")) * 100).alias("exact_pct"),
        F.avg("correlation").alias("avg_corr"),
        F.avg("mean_abs_rel_error_pct").alias("avg_error_pct"),
    ).withColumn(
        "status",
        F.when(exact > 90, "CONSISTENT").otherwise(grade(corr, [(0.9, "APPROX CONSISTENT"), (0.5, "WEAKLY CONSISTENT")], "INCONSISTENT")),
    )


def lag_consistency(df: DataFrame, key: str = "PARTITION_COLUMN", order: str = "QUARTER_PARSED", pairs: Sequence[tuple[str, str]] = tuple(LAG_PAIRS)) -> DataFrame:
    """Does the stored lag column equal the current column one quarter earlier."""
    series = W.partitionBy(key).orderBy(order)
    rows = df.withColumns({f"_s{i}": F.lag(a, 1).over(series) for i, (a, _) in enumerate(pairs)} | {"_n": F.count(F.lit(1)).over(W.partitionBy(key))})
    cells = F.array(
        *[F.struct(F.lit(a).alias("signal"), F.col(f"_s{i}").alias("s"), F.col(b).alias("l")) for i, (a, b) in enumerate(pairs)]
    )
    long = rows.filter(F.col("_n") >= 3).select(key, F.explode(cells).alias("x")).select(key, "x.signal", "x.s", "x.l")
    usable = long.filter(F.col("s").isNotNull() & F.col("l").isNotNull() & (F.col("s") != 0) & (F.col("l") != 0))
    n = F.count(F.lit(1))
    per = (
        usable.groupBy(key, "signal")
        .agg(n.alias("n"), all_close(F.col("s"), F.col("l")).alias("exact"), F.when(n > 2, safe_corr("s", "l")).alias("corr"))
        .filter(F.col("n") >= 2)
    )
    return per.groupBy("signal").agg(
        F.count(F.lit(1)).alias("n_series"),
        (F.avg(F.col("exact").cast("double")) * 100).alias("exact_pct"),
        F.avg("corr").alias("avg_corr"),
    ).withColumn(
        "label",
        F.when(F.col("exact_pct") > 80, "REAL").otherwise(
            grade(F.col("avg_corr"), [(0.8, "APPROXIMATELY PRESERVED"), (0.3, "WEAKLY PRESERVED")], "DESTROYED")
        ),
    )


def autocorrelation(df: DataFrame, key: str = "PARTITION_COLUMN", order: str = "QUARTER_PARSED", target: str = "BB", lags: Sequence[int] = (1, 2, 3, 4), min_rows: int = 6) -> DataFrame:
    """Correlation of each series with itself 1..4 known values earlier."""
    series = W.partitionBy(key).orderBy(order)
    rows = df.filter(F.col(target).isNotNull()).withColumns(
        {f"_l{k}": F.lag(target, k).over(series) for k in lags} | {"_n": F.count(F.lit(1)).over(W.partitionBy(key))}
    )
    per = rows.filter(F.col("_n") >= min_rows).groupBy(key).agg(*[F.round(safe_corr(target, f"_l{k}"), 4).alias(str(k)) for k in lags])
    long = per.unpivot([key], [str(k) for k in lags], "lag", "autocorrelation")
    return long.withColumn("lag", F.col("lag").cast("int"))


def autocorrelation_summary(per_series: DataFrame) -> DataFrame:
    a = F.col("autocorrelation")
    return per_series.filter(a.isNotNull()).groupBy("lag").agg(
        F.count(F.lit(1)).alias("n_series"), F.avg(a).alias("avg_autocorrelation"), (F.avg((a > 0).cast("double")) * 100).alias("pct_positive")
    )


def diagnostic_verdict(ma: DataFrame, pearson: DataFrame, autocorr: DataFrame, target: str = "BB") -> DataFrame:
    """One row: state of averages, correlations and time structure, and what that says about the data."""
    cross = pearson.filter(F.col("a") == target).agg(F.coalesce(F.avg(F.abs("corr")), F.lit(0.0)).alias("avg_abs_corr"))
    lag1 = autocorr.filter(F.col("lag") == 1).select(F.col("avg_autocorrelation").alias("lag1"))
    lag1 = lag1.agg(F.max("lag1").alias("lag1"))
    consistent = F.col("ma_status").isin("CONSISTENT", "APPROX CONSISTENT")
    method = (
        F.when(consistent & (F.col("corr_status") == "STRONG"), "consistently_masked")
        .when(consistent, "signals_independent")
        .when(F.col("ma_status") == "INCONSISTENT", "all_independent")
        .otherwise("mixed")
    )
    return (
        ma.select(F.col("status").alias("ma_status"))
        .crossJoin(F.broadcast(cross))
        .crossJoin(F.broadcast(lag1))
        .withColumns(
            {
                "corr_status": grade(F.col("avg_abs_corr"), [(0.6, "STRONG"), (0.3, "MODERATE")], "WEAK/ABSENT"),
                "temporal_status": F.when(F.col("lag1").isNotNull(), grade(F.col("lag1"), [(0.5, "PRESERVED"), (0.2, "PARTIAL")], "DESTROYED")).otherwise("UNKNOWN"),
            }
        )
        .withColumn("method", method)
    )
