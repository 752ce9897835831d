"""Per-series forecasts and fits.

The rows of a series never travel to Python to be fitted. Spark reduces every (series, model) group to
means and covariances with partial aggregation, and one small k x k system per group is solved in
batches with numpy. The fit comes back as coefficient columns, so scoring is a join and an expression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.metrics import clip_negative
from panelcast.functions.quarters import quarter_index
from panelcast.functions.stats import exact_cents, varies

NAIVE_MODELS = ["MEAN4", "SEASONAL_NAIVE", "TREND"]


# --- closed-form forecasts ---------------------------------------------------------------------------


def naive_forecasts(
    df: DataFrame, keys: Sequence[str], target: str = "BB", quarter: str = "QUARTER", origin: str = "ORIGIN_QUARTER",
    season: int = 4, order_by: str = "QUARTER_PARSED", rivals: Sequence[str] = (),
) -> DataFrame:
    """Three forecasts for every quarter of a series, trained on quarters up to the origin.

    MEAN4 repeats the mean of the last four training quarters, SEASONAL_NAIVE the same quarter of the
    last known year, TREND a straight line. Inside the training range MEAN4 and SEASONAL_NAIVE are
    one-step forecasts and TREND is the fitted line. Sums are over whole cents, thus exact. Expects one row
    per calendar quarter. All windows share the series key: one shuffle, one sort. ``rivals`` names columns with forecasts of other models; they
    become rows of the model with the column's name.
    """
    series = W.partitionBy(*keys)
    order = series.orderBy(order_by)
    cents = exact_cents(target).cast("decimal(20,0)")
    df = df.withColumns({"_qi": quarter_index(quarter), "_oi": quarter_index(origin)}).withColumn("k", F.col("_qi") - F.col("_oi"))
    trained = (F.col("k") <= 0) & F.col(target).isNotNull()
    first = F.min("_qi").over(series)
    df = df.withColumn("_t", (F.col("_qi") - first + 1).cast("decimal(10,0)"))
    four = order.rowsBetween(-(season - 1), 0)
    x, y = F.when(trained, F.col("_t")), F.when(trained, cents)
    df = df.withColumns(
        {
            "_m4": F.when(F.count(target).over(four) == season, F.sum(cents).over(four).cast("double") / (100.0 * season)),
            "_n": F.count(y).over(series).cast("decimal(10,0)"),
            "_sx": F.sum(x).over(series).cast("decimal(12,0)"),
            "_sxx": F.sum(x * x).over(series).cast("decimal(14,0)"),
            "_sy": F.sum(y).over(series).cast("decimal(24,0)"),
            "_sxy": F.sum(y * x.cast("decimal(6,0)")).over(series).cast("decimal(26,0)"),
        }
    )
    num = (F.col("_n") * F.col("_sxy")).cast("double") - (F.col("_sx") * F.col("_sy")).cast("double")
    den = (F.col("_n") * F.col("_sxx")).cast("double") - (F.col("_sx") * F.col("_sx")).cast("double")
    slope = F.try_divide(num, den)
    level = F.try_divide(F.col("_sy").cast("double") - slope * F.col("_sx").cast("double"), F.col("_n").cast("double"))
    last_mean = F.max(F.when(F.col("k") == 0, F.col("_m4"))).over(series)
    year_back = F.lag(target, season).over(order)
    two_back = F.lag(target, 2 * season).over(order)
    forecasts = {
        "MEAN4": F.when(F.col("k") > 0, last_mean).otherwise(F.lag("_m4", 1).over(order)),
        "SEASONAL_NAIVE": F.when(F.col("k") > season, two_back).otherwise(year_back),
        "TREND": (level + slope * F.col("_t").cast("double")) / 100.0,
    }
    df = df.withColumns({f"_f_{m}": clip_negative(c) for m, c in forecasts.items()})
    predicted = {m: f"_f_{m}" for m in NAIVE_MODELS} | {m: m for m in rivals}
    options = F.array(*[F.struct(F.lit(m).alias("m"), F.col(c).alias("p")) for m, c in predicted.items()])
    helpers = ["_qi", "_oi", "_t", "_m4", "_n", "_sx", "_sxx", "_sy", "_sxy", "_o", *predicted.values()]
    return (
        df.withColumn("_o", F.explode(options))
        .withColumns({"MODEL_USED": F.col("_o.m"), "BILLING_PREDICTED": F.col("_o.p")})
        .drop(*helpers)
    )


def seasonal_naive(
    df: DataFrame, keys: Sequence[str], target: str = "BB", quarter: str = "QUARTER", split: str = "split", season: int = 4
) -> DataFrame:
    """The last training year repeated over validation and test rows, floored at 0.

    The last ``season`` training values are one small array per series, read by position.
    """
    series = W.partitionBy(*keys)
    train = F.col(split) == "train"
    qi = quarter_index(quarter)
    last = F.max(F.when(train, qi)).over(series)
    recent = F.map_from_entries(
        F.collect_list(F.when(train & (F.col("_qi") > F.col("_last") - season), F.struct("_qi", target))).over(series)
    )
    step = F.col("_qi") - F.col("_last")
    source = F.col("_last") - season + 1 + F.pmod(step - 1, F.lit(season))
    return (
        df.withColumns({"_qi": qi, "_last": last})
        .withColumn("_recent", recent)
        .filter(~train)
        .withColumn("BILLING_PREDICTED", clip_negative(F.col("_recent")[source]))
        .drop("_qi", "_last", "_recent")
    )


# --- sufficient statistics ---------------------------------------------------------------------------


def covariance_stats(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str) -> DataFrame:
    """Per group: ``n``, the means of xs and y, and the upper triangle of their covariance matrix.

    ``covar_pop`` merges centred partial results, so there is no cancellation and no collected group.
    """
    names = [*xs, y]
    means = F.array(*[F.avg(c) for c in names])
    pairs = [F.covar_pop(F.col(a), F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), means.alias("means"), F.array(*pairs).alias("cov"))


def training_rows(df: DataFrame, xs: Sequence[str], y: str, split: str | None = "split") -> DataFrame:
    """Rows a regression may use: training rows with a target, missing regressors as 0."""
    rows = df.filter(F.col(y).isNotNull())
    if split is not None:
        rows = rows.filter(F.col(split) == "train")
    return rows.withColumns({x: F.coalesce(F.col(x).cast("double"), F.lit(0.0)) for x in xs})


FIT_FIELDS = [
    T.StructField("n", T.LongType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("sse", T.DoubleType()),
    T.StructField("error", T.StringType()),
]


def _matrices(batch: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Stack the triangles of a batch into (rows, k, k) matrices; missing moments count as 0.

    So does a variance that is only rounding noise of merged partial results: the column is constant.
    """
    flat = np.nan_to_num(np.array(batch["cov"].tolist(), dtype=float).reshape(len(batch), -1))
    full = np.zeros((len(batch), k, k))
    upper = np.triu_indices(k)
    full[:, upper[0], upper[1]] = flat
    full[:, upper[1], upper[0]] = flat
    means = np.nan_to_num(np.array(batch["means"].tolist(), dtype=float).reshape(len(batch), k))
    constant = np.diagonal(full, axis1=1, axis2=2) <= (1e-10 * np.abs(means)) ** 2
    full[constant[:, :, None] | constant[:, None, :]] = 0.0
    return full, means


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scaled least-norm solution of many small symmetric systems; safe for singular ones. What a small penalty adds to nearly equal regressors lies above the cut-off."""
    scale = np.sqrt(np.maximum(np.diagonal(a, axis1=1, axis2=2), 0.0))
    scale[scale == 0] = 1.0
    scaled = a / (scale[:, :, None] * scale[:, None, :])
    inverse = np.linalg.pinv(scaled, rcond=1e-12, hermitian=True)
    return np.einsum("nij,nj->ni", inverse, b / scale) / scale


def solve_ridge(
    stats: DataFrame, keys: Sequence[str], n_features: int, alpha: Column | float = 1.0, min_rows: int = 3, relative: bool = False,
    active: str | None = None, penalties: Sequence[float] | None = None,
) -> DataFrame:
    """Ridge fit per row of ``covariance_stats``; too few rows give an error row, not an exception.

    With ``relative`` the penalty is in units of each regressor's variance, as if all were standardised. ``active`` names an array column of booleans, one
    per regressor: the fit of a row sees only its block of the moment matrix, and the other coefficients are 0. ``penalties`` multiply the penalty by regressor.
    """
    each = np.ones(n_features) if penalties is None else np.asarray(penalties, dtype=float)
    schema = T.StructType([stats.schema[c] for c in keys] + FIT_FIELDS)
    k = n_features + 1
    ready = stats.withColumn("_alpha", alpha if isinstance(alpha, Column) else F.lit(float(alpha)))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            cov, means = _matrices(batch, k)
            n = batch["n"].to_numpy(dtype=float)
            lam = batch["_alpha"].to_numpy(dtype=float) / n
            if active is not None:
                out_of_use = np.column_stack([~np.array(batch[active].tolist(), dtype=bool).reshape(len(batch), k - 1), np.zeros(len(batch), dtype=bool)])
                cov[out_of_use[:, :, None] | out_of_use[:, None, :]] = 0.0
            xx, xy, yy = cov[:, :-1, :-1], cov[:, :-1, -1], cov[:, -1, -1]
            if relative:
                beta = _solve(xx + (lam * n)[:, None, None] * xx * np.diag(each), xy)
            else:
                beta = _solve(xx + lam[:, None, None] * np.diag(each), xy)
            fitted = np.einsum("ni,nij,nj->n", beta, xx, beta)
            sse = np.maximum(n * (yy - 2 * np.einsum("ni,ni->n", beta, xy) + fitted), 0.0)
            short = n < min_rows
            out = batch[list(keys)].copy()
            out["n"] = batch["n"]
            out["intercept"] = np.where(short, np.nan, means[:, -1] - np.einsum("ni,ni->n", beta, means[:, :-1]))
            out["coefficients"] = [None if s else row.tolist() for s, row in zip(short, beta)]
            out["sse"] = np.where(short, np.nan, sse)
            out["error"] = [f"Insufficient training data: {int(c)} rows" if s else None for s, c in zip(short, n)]
            yield out

    fitted = ready.mapInPandas(fit, schema)
    return fitted.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("intercept", "sse")})


def fit_ridge(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str = "BB", alpha: float = 1.0, split: str | None = "split") -> DataFrame:
    return solve_ridge(covariance_stats(training_rows(df, xs, y, split), keys, xs, y), keys, len(xs), alpha)


def usable_regressors(df: DataFrame, keys: Sequence[str], xs: Sequence[str], segment: str, excluded: dict[str, Sequence[str]]) -> DataFrame:
    """One row per series with ``selected``, the regressors that its segment may use. ``excluded`` lists the segments that must not use a regressor."""
    segment_is = {x: F.upper(segment).isin([s.upper() for s in segments]) for x, segments in excluded.items() if segments}
    names = F.array(*[F.when(~F.coalesce(segment_is[x], F.lit(False)), F.lit(x)) if x in segment_is else F.lit(x) for x in xs])
    return df.groupBy(*keys).agg(F.first(segment, ignorenulls=True).alias(segment)).select(*keys, F.array_compact(names).alias("selected"))


def strongest_regressors(stats: DataFrame, keys: Sequence[str], xs: Sequence[str], most: int) -> DataFrame:
    """``selected``: at most ``most`` regressors of each row of ``covariance_stats`` by squared correlation with the target (ties by name); constants are never chosen."""
    k = len(xs) + 1
    place = lambda i, j: i * k - i * (i - 1) // 2 + j - i
    spread = F.col("cov")[place(k - 1, k - 1)]
    cells = []
    for i, x in enumerate(xs):
        variance = F.col("cov")[place(i, i)]
        real = (variance > F.pow(F.lit(1e-10) * F.abs(F.col("means")[i]), F.lit(2))) & (spread > 0)
        cells.append(F.struct((-F.round(F.when(real, F.pow(F.col("cov")[place(i, k - 1)], F.lit(2)) / (variance * spread)), 9)).alias("order"), F.lit(x).alias("name")))
    ranked = F.array_sort(F.filter(F.array(*cells), lambda c: c["order"].isNotNull()))
    return stats.select(*keys, F.transform(F.slice(ranked, 1, most), lambda c: c["name"]).alias("selected"))


def fit_selected(
    df: DataFrame, keys: Sequence[str], xs: Sequence[str], choices: Sequence[DataFrame], y: str = "BB", alpha: float = 1.0, split: str | None = "split", min_rows: int = 3, relative: bool = False,
) -> DataFrame:
    """A ridge per series on the regressors that every one of ``choices`` (keys, ``selected``) allows; ``features`` names them.

    The moments of all regressors are aggregated once and each series is solved on its own block, so a series costs the same whatever is chosen. A series that
    a choice does not know keeps all of its regressors; one without any left has its mean.
    """
    stats = covariance_stats(training_rows(df, xs, y, split), keys, xs, y)
    features = F.array(*[F.lit(x) for x in xs])
    for i, choice in enumerate(choices):
        stats = stats.join(choice.select(*keys, F.col("selected").alias(f"_c{i}")), list(keys), "left")
        features = F.array_intersect(features, F.coalesce(F.col(f"_c{i}"), F.array(*[F.lit(x) for x in xs])))
    marked = stats.withColumn("features", features).withColumn("_active", F.array(*[F.array_contains("features", x) for x in xs]))
    carried = marked.withColumn("_features", F.array_join("features", ","))
    fits = solve_ridge(carried, [*keys, "_features"], len(xs), alpha, min_rows, relative, active="_active")
    return fits.withColumn("features", F.when(F.col("_features") == "", F.array().cast("array<string>")).otherwise(F.split("_features", ","))).drop("_features")


def ridge_to_origin(
    df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str = "BB", quarter: str = "QUARTER", origin: str = "ORIGIN_QUARTER", alpha: float = 0.1, min_rows: int = 6,
) -> DataFrame:
    """One fit per series on all regressors, from its quarters up to the origin; ``means`` are those of the regressors and the target."""
    rows = df.filter(quarter_index(quarter) <= quarter_index(origin))
    stats = covariance_stats(training_rows(rows, xs, y, None), keys, xs, y)
    fits = solve_ridge(stats, keys, len(xs), alpha, min_rows, relative=True)
    return fits.join(stats.select(*keys, "means"), list(keys))


def ridge_forecasts(df: DataFrame, keys: Sequence[str], xs: Sequence[str], quarter: str = "QUARTER", origin: str = "ORIGIN_QUARTER", name: str = "RIDGE") -> DataFrame:
    """A column with the forecasts of a fit up to the origin, in whole cents; series whose fit failed keep their rows without one."""
    scored = score_models(df, ridge_to_origin(df, keys, xs, quarter=quarter, origin=origin), keys, xs)
    return scored.withColumn(name, F.round("BILLING_PREDICTED", 2)).drop("BILLING_PREDICTED")


def coefficient_rows(fits: DataFrame, keys: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """Fits in long form: a row per regressor with its coefficient and mean."""
    cells = F.array(*[F.struct(F.lit(x).alias("regressor"), F.col("coefficients")[i].alias("coefficient"), F.col("means")[i].alias("x_mean")) for i, x in enumerate(xs)])
    return fits.filter(F.col("coefficients").isNotNull()).select(*keys, "n", "intercept", F.explode(cells).alias("c")).select(*keys, "n", "intercept", "c.*")


def univariate_fits(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str = "BB", split: str | None = "split") -> DataFrame:
    """One straight line per group and regressor, long form; JVM-only."""
    rows = training_rows(df, xs, y, split)
    long = rows.select(*keys, F.col(y).alias("_y"), F.explode(regressor_pairs(xs)).alias("_r")).select(
        *keys, F.col("_r.name").alias("regressor"), F.col("_r.value").alias("_x"), "_y"
    )
    return long.groupBy(*keys, "regressor").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(varies("_x"), F.regr_slope("_y", "_x")).alias("coefficient"),
        F.when(varies("_x"), F.regr_intercept("_y", "_x")).alias("intercept"),
        F.avg("_x").alias("x_mean"),
    )


def regressor_pairs(xs: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(x).alias("name"), F.col(x).cast("double").alias("value")) for x in xs])


def linear_score(xs: Sequence[str], coefficients: str = "coefficients", intercept: str = "intercept") -> Column:
    """Dot product of regressor columns (missing = 0) with a coefficient array."""
    values = F.array(*[F.coalesce(F.col(x).cast("double"), F.lit(0.0)) for x in xs])
    products = F.zip_with(values, F.col(coefficients), lambda x, w: x * w)
    return F.col(intercept) + F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def score_models(df: DataFrame, fits: DataFrame, keys: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """Attach each series' coefficients and apply them; a series without a fit, or with a failed one, keeps its rows without a prediction."""
    payload = fits.select(*keys, "intercept", "coefficients")
    return (
        df.join(payload, list(keys), "left")
        .withColumn("BILLING_PREDICTED", clip_negative(linear_score(xs)))
        .drop("intercept", "coefficients")
    )


# --- model families ----------------------------------------------------------------------------------


def trend_seasonal_features(df: DataFrame, day: str = "QUARTER_PARSED", quarter: str = "QUARTER", period: float = 91.3125, order: int = 5) -> tuple[DataFrame, list[str]]:
    from panelcast.functions.stats import fourier_terms

    terms = fourier_terms(day, period, order)
    season = {f"q_{q}": (F.pmod(quarter_index(quarter), F.lit(4)) == q - 1).cast("double") for q in (2, 3, 4)}
    return df.withColumns({"t": quarter_index(quarter).cast("double")} | terms | season), ["t", *terms, *season]


def changepoint_features(df: DataFrame, keys: Sequence[str], y: str, split: str | None, n: int, share: float) -> tuple[DataFrame, list[str]]:
    """Hinges of ``t`` at ``n`` evenly spaced places of the first ``share`` of the training range of each series; the slope may change there."""
    series = W.partitionBy(*keys)
    trained = F.col(y).isNotNull() if split is None else F.col(y).isNotNull() & (F.col(split) == "train")
    known = F.when(trained, F.col("t"))
    first, last = F.min(known).over(series), F.max(known).over(series)
    rows = df.withColumns({"_first": first, "_span": last - first})
    hinges = {f"hinge_{j}": F.coalesce(F.greatest(F.col("t") - F.col("_first") - F.col("_span") * (share * j / n), F.lit(0.0)), F.lit(0.0)) for j in range(1, n + 1)}
    return rows.withColumns(hinges).drop("_first", "_span"), list(hinges)


def _share_of_cap(y: str, cap: str, floor: str) -> Column:
    share = (F.col(y) - F.col(floor)) / F.when(F.col(cap) > F.col(floor), F.col(cap) - F.col(floor))
    return F.when(share.isNotNull(), F.least(F.greatest(share, F.lit(0.01)), F.lit(0.99)))


def fit_trend_seasonal(
    df: DataFrame, keys: Sequence[str], regressors: Sequence[str], y: str = "BB", alpha: float = 1e-4, split: str | None = "split",
    changepoints: int = 3, changepoint_share: float = 0.8, changepoint_prior: float = 0.05, season: str = "additive", growth: str = "linear",
    cap: str = "cap", floor: str = "floor",
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Piecewise-linear trend, seasonality and regressors in one linear fit per series.

    Penalties are in units of each feature's variance; those of the slope changes are ``1 / changepoint_prior`` times as strong, so a small prior keeps the trend straight.
    A multiplicative season fits the logarithm of the target, saturating (``logistic``) growth the log-odds of its place between the columns ``floor`` and ``cap``, where a series needs
    cap > floor. Returns the fits, the rows with their features and the feature names; ``score_trend`` undoes the change of scale.
    """
    if season not in ("additive", "multiplicative") or growth not in ("linear", "logistic"):
        raise ValueError(f"unknown season {season} or growth {growth}")
    rows, features = trend_seasonal_features(df)
    rows, hinges = changepoint_features(rows, keys, y, split, changepoints, changepoint_share)
    target = F.col(y).cast("double")
    if growth == "logistic":
        share = _share_of_cap(y, cap, floor)
        target = F.ln(share / (1 - share))
    elif season == "multiplicative":
        target = F.when(F.col(y).isNotNull(), F.ln(F.greatest(F.col(y).cast("double"), F.lit(1.0))))
    xs = [*features, *hinges, *regressors]
    stats = covariance_stats(training_rows(rows.withColumn("_target", target), xs, "_target", split), keys, xs, "_target")
    penalties = [1 / changepoint_prior if x in hinges else 1.0 for x in xs]
    return solve_ridge(stats, keys, len(xs), alpha, relative=True, penalties=penalties), rows, xs


def score_trend(
    rows: DataFrame, fits: DataFrame, keys: Sequence[str], xs: Sequence[str], season: str = "additive", growth: str = "linear", cap: str = "cap", floor: str = "floor",
) -> DataFrame:
    """Forecasts of ``fit_trend_seasonal`` on the scale of the target, never below 0."""
    scored = rows.join(fits.select(*keys, "intercept", "coefficients"), list(keys), "left").withColumn("_linear", linear_score(xs))
    made = F.col("_linear")
    if growth == "logistic":
        made = F.col(floor) + (F.col(cap) - F.col(floor)) / (1 + F.exp(-F.col("_linear")))
    elif season == "multiplicative":
        made = F.exp(F.least(F.col("_linear"), F.lit(60.0)))
    return scored.withColumn("BILLING_PREDICTED", clip_negative(made)).drop("_linear", "intercept", "coefficients")


def autoreg_select(df: DataFrame, keys: Sequence[str], target: str = "BB", order_by: str = "QUARTER_PARSED", max_order: int = 4) -> DataFrame:
    """Autoregression of order 1..max_order per series, the order with the lowest AIC.

    One covariance matrix over all lags serves every order: each order is a corner of it.
    """
    series = W.partitionBy(*keys).orderBy(order_by)
    lags = [f"lag_{i}" for i in range(1, max_order + 1)]
    rows = df.withColumns({name: F.lag(target, i).over(series) for i, name in enumerate(lags, 1)})
    complete = rows.filter(F.col(target).isNotNull() & F.col(lags[-1]).isNotNull())
    stats = covariance_stats(complete, keys, lags, target)
    extra = [T.StructField("ar_order", T.IntegerType()), T.StructField("aic", T.DoubleType())]
    schema = T.StructType([stats.schema[c] for c in keys] + extra + FIT_FIELDS)
    k = max_order + 1

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            cov, means = _matrices(batch, k)
            n = batch["n"].to_numpy(dtype=float)
            yy = cov[:, -1, -1]
            for p in range(1, max_order + 1):
                xx, xy = cov[:, :p, :p], cov[:, :p, -1]
                beta = _solve(xx, xy)
                sse = np.maximum(n * (yy - np.einsum("ni,ni->n", beta, xy)), 1e-9)
                ok = n > p + 2
                out = batch[list(keys)].copy()
                out["ar_order"] = p
                out["aic"] = np.where(ok, n * np.log(sse / n) + 2 * (p + 1), np.nan)
                out["n"] = batch["n"]
                out["intercept"] = np.where(ok, means[:, -1] - np.einsum("ni,ni->n", beta, means[:, :p]), np.nan)
                out["coefficients"] = [row.tolist() if good else None for good, row in zip(ok, beta)]
                out["sse"] = np.where(ok, sse, np.nan)
                out["error"] = [None if good else f"Insufficient training data: {int(c)} rows" for good, c in zip(ok, n)]
                yield out

    fits = stats.mapInPandas(fit, schema)
    fits = fits.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("aic", "intercept", "sse")})
    rest = [c for c in fits.columns if c not in keys]
    rank = F.struct(F.col("aic").isNull(), "aic", "ar_order")
    best = fits.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    # a series without a single complete row stays, with an error
    every = df.groupBy(*keys).agg(F.count(target).alias("_known")).join(best, list(keys), "left")
    missing = F.when(F.col("_row").isNull(), F.lit("Insufficient training data: 0 rows")).otherwise(F.col("_row.error"))
    return every.select(*keys, *[(missing if c == "error" else F.col(f"_row.{c}")).alias(c) for c in rest])


def autoreg_forecast(df: DataFrame, fits: DataFrame, keys: Sequence[str], horizon: int = 6, target: str = "BB", order_by: str = "QUARTER_PARSED", max_order: int = 4) -> DataFrame:
    """Recursive forecasts ``step`` = 1..horizon from the last values of each series; a series without a usable fit has steps without a prediction."""
    known = df.filter(F.col(target).isNotNull())
    recent = known.withColumn(
        "_back", F.row_number().over(W.partitionBy(*keys).orderBy(F.col(order_by).desc()))
    ).filter(F.col("_back") <= max_order)
    tail = recent.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_back", target))), lambda s: s[target]).alias("_tail")
    )

    def advance(state: Column, _: Column) -> Column:
        used = F.slice(state, F.lit(1), F.size("coefficients"))
        terms = F.zip_with(used, F.col("coefficients"), lambda x, w: x * w)
        value = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v) + F.col("intercept")
        return F.concat(F.array(F.greatest(value, F.lit(0.0))), state)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("_tail"), advance)
    usable = fits.filter(F.col("error").isNull()).select(*keys, "coefficients", "intercept", "ar_order")
    fitted = F.col("coefficients").isNotNull() & (F.size("_tail") >= F.col("ar_order"))
    steps = F.when(fitted, F.reverse(F.slice(path, 1, horizon))).otherwise(F.array_repeat(F.lit(None).cast("double"), horizon))
    return (
        df.select(*keys)
        .distinct()
        .join(tail, list(keys), "left")
        .join(usable, list(keys), "left")
        .select(*keys, F.posexplode(steps).alias("step", "BILLING_PREDICTED"))
        .withColumn("step", F.col("step") + 1)
    )


def _huber_slopes(x: np.ndarray, y: np.ndarray, real: np.ndarray, epsilon: float = 1.35, rounds: int = 30) -> np.ndarray:
    """Robust slopes of many small regressions at once, by reweighting.

    Shapes are (series, rows, features); ``real`` marks rows that are not padding. Residuals beyond
    ``epsilon`` scales of their series count linearly.
    """
    design = np.concatenate([x, np.ones((*x.shape[:2], 1))], axis=2) * real[:, :, None]
    jitter = 1e-9 * np.eye(design.shape[2])
    weights = real.astype(float)
    for _ in range(rounds):
        gram = np.einsum("srp,sr,srq->spq", design, weights, design) + jitter
        beta = np.linalg.solve(gram, np.einsum("srp,sr,sr->sp", design, weights, y)[:, :, None])[:, :, 0]
        size = np.abs(y - np.einsum("srp,sp->sr", design, beta))
        scale = np.nanmedian(np.where(real, size, np.nan), axis=1) / 0.6745
        scale = np.where(scale > 0, scale, 1.0)
        weights = np.minimum(1.0, epsilon * scale[:, None] / np.maximum(size, 1e-12)) * real
    return np.abs(beta[:, :-1])


def select_features(df: DataFrame, keys: Sequence[str], xs: Sequence[str], n_features: Column, y: str = "BB", split: str = "split") -> DataFrame:
    """Backward elimination on standardised training rows: the weakest regressor goes until n remain.

    The robust fit reweights rows, so this is the one fit that sees rows: the training quarters of one
    series, at most one per calendar quarter. They travel as one array per series and a batch of series
    is eliminated together.
    """
    rows = training_rows(df, xs, y, split).withColumn("_keep", n_features)
    packed = rows.groupBy(*keys).agg(
        F.collect_list(F.array(*[F.col(x) for x in xs], F.col(y).cast("double"))).alias("_rows"), F.max("_keep").alias("_keep")
    )
    schema = T.StructType(
        [packed.schema[c] for c in keys]
        + [T.StructField("selected", T.ArrayType(T.StringType())), T.StructField("dropped", T.ArrayType(T.StringType()))]
    )
    names = list(xs)

    def standard(values: np.ndarray, real: np.ndarray) -> np.ndarray:
        n = real.sum(axis=1)[:, None]
        mask = real[:, :, None]
        mean = (values * mask).sum(axis=1) / n
        centred = (values - mean[:, None, :]) * mask
        spread = np.sqrt((centred**2).sum(axis=1) / n)
        return centred / np.where(spread > 0, spread, 1.0)[:, None, :]

    def eliminate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            tables = [np.array(r.tolist(), dtype=float).reshape(-1, len(names) + 1) for r in batch["_rows"]]
            longest = max(len(t) for t in tables)
            block = np.zeros((len(tables), longest, len(names) + 1))
            real = np.zeros((len(tables), longest), dtype=bool)
            for i, t in enumerate(tables):
                block[i, : len(t)] = t
                real[i, : len(t)] = True
            block = standard(block, real)
            active = np.ones((len(tables), len(names)), dtype=bool)
            keep = batch["_keep"].to_numpy(dtype=int)
            while (too_many := active.sum(axis=1) > keep).any():
                slopes = _huber_slopes(block[:, :, :-1] * active[:, None, :], block[:, :, -1], real)
                weakest = np.argmin(np.where(active, slopes, np.inf), axis=1)
                active[np.flatnonzero(too_many), weakest[too_many]] = False
            out = batch[list(keys)].copy()
            out["selected"] = [[n for n, a in zip(names, row) if a] for row in active]
            out["dropped"] = [[n for n, a in zip(names, row) if not a] for row in active]
            yield out

    return packed.mapInPandas(eliminate, schema)


def grid_alphas(values: Sequence[float]) -> Column:
    return F.explode(F.array(*[F.lit(float(v)) for v in values]))


def param_grid_search(
    df: DataFrame, keys: Sequence[str], xs: Sequence[str], alphas: Sequence[float], y: str = "BB", split: str = "split",
    n_iter: int = 0, seed: int = 42,
) -> DataFrame:
    """Every series with every penalty, scored by the mean validation error.

    The training moments are aggregated once; each penalty only costs one more small solve. A seeded
    sample of the grid is tried where ``n_iter`` is smaller than the grid.
    """
    from panelcast.functions.metrics import ape

    tried = list(alphas)
    if 0 < n_iter < len(tried):
        tried = sorted(np.random.default_rng(seed).choice(tried, size=n_iter, replace=False).tolist())
    stats = covariance_stats(training_rows(df, xs, y, split), keys, xs, y).withColumn("alpha", grid_alphas(tried))
    fits = solve_ridge(stats, [*keys, "alpha"], len(xs), F.col("alpha"))
    validation = df.filter((F.col(split) == "val") & F.col(y).isNotNull())
    scored = (
        validation.join(fits.select(*keys, "alpha", "intercept", "coefficients"), list(keys))
        .withColumn("_p", clip_negative(linear_score(xs)))
        .groupBy(*keys, "alpha")
        .agg(F.avg(ape(y, "_p")).alias("val_ape"), F.avg(F.abs(F.col(y) - F.col("_p"))).alias("val_mae"))
    )
    order = W.partitionBy(*keys).orderBy(F.round("val_ape", 9).asc_nulls_last(), F.col("alpha"))
    return scored.withColumn("rank", F.row_number().over(order))


def topk_params(grid: DataFrame, k: int = 10) -> DataFrame:
    return grid.filter(F.col("rank") <= k)


def val_scores(df: DataFrame, keys: Sequence[str], y: str = "BB", predicted: str = "BILLING_PREDICTED", split: str = "split") -> DataFrame:
    from panelcast.functions.metrics import ape

    rows = df.filter((F.col(split) == "val") & F.col(y).isNotNull() & F.col(predicted).isNotNull())
    return rows.groupBy(*keys).agg(
        F.avg(F.abs(F.col(y) - F.col(predicted))).alias("val_mae"),
        F.avg(ape(y, predicted)).alias("val_mape"),
        F.count(F.lit(1)).alias("n_val"),
    )


def univariate_result(df: DataFrame, keys: Sequence[str], y: str = "BB", predicted: str = "BILLING_PREDICTED") -> DataFrame:
    """Error of a univariate model: validation and test rows together, after row removal, clipped at 0."""
    from panelcast.functions.metrics import ape
    from panelcast.operators.clean import remove_unwanted_rows

    clipped = df.withColumn(predicted, clip_negative(predicted))
    kept = remove_unwanted_rows(clipped, keys)
    return kept.groupBy(*keys).agg(
        F.avg(ape(y, predicted)).alias("mape"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit("val+test").alias("mape_scope"),
    )


def train_dispatch(
    df: DataFrame, keys: Sequence[str], families: dict[str, Sequence[str]], y: str = "BB", alpha: float = 1.0, split: str = "split",
    allowed: DataFrame | None = None, segment: str = "MARKET_SEGMENT", min_rows: int = 6,
) -> DataFrame:
    """All series x all model families in one pass, one result row each.

    A family is a list of features. The training rows are read and shuffled once: one aggregation holds
    the moments of the union of all features, and every family is a block of that matrix. ``allowed``
    (segment, model) marks what is configured; the rest is SKIPPED. Short series give error rows.
    """
    union = list(dict.fromkeys(x for xs in families.values() for x in xs))
    groups = [*keys, segment]
    stats = covariance_stats(training_rows(df, union, y, split), groups, union, y)
    places = {m: [union.index(x) for x in xs] for m, xs in families.items()}
    extra = [T.StructField("MODEL_USED", T.StringType()), T.StructField("features", T.ArrayType(T.StringType()))]
    schema = T.StructType([stats.schema[c] for c in groups] + extra + FIT_FIELDS)
    k = len(union) + 1

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            cov, means = _matrices(batch, k)
            n = batch["n"].to_numpy(dtype=float)
            short = n < min_rows
            for model, cols in places.items():
                xx, xy = cov[:, cols][:, :, cols], cov[:, cols, -1]
                beta = _solve(xx + (alpha / n)[:, None, None] * np.eye(len(cols)), xy)
                explained = 2 * np.einsum("ni,ni->n", beta, xy) - np.einsum("ni,nij,nj->n", beta, xx, beta)
                out = batch[groups].copy()
                out["MODEL_USED"] = model
                out["features"] = [list(families[model])] * len(batch)
                out["n"] = batch["n"]
                out["intercept"] = np.where(short, np.nan, means[:, -1] - np.einsum("ni,ni->n", beta, means[:, cols]))
                out["coefficients"] = [None if s else row.tolist() for s, row in zip(short, beta)]
                out["sse"] = np.where(short, np.nan, np.maximum(n * (cov[:, -1, -1] - explained), 0.0))
                out["error"] = [f"Insufficient training data: {int(c)} rows" if s else None for s, c in zip(short, n)]
                yield out

    out = stats.mapInPandas(fit, schema)
    skipped = F.lit(False)
    if allowed is not None:
        marks = allowed.select(segment, F.upper("model").alias("MODEL_USED")).distinct().withColumn("_ok", F.lit(True))
        out = out.join(marks, [segment, "MODEL_USED"], "left")
        skipped = F.col("_ok").isNull()
    return out.withColumns(
        {
            "error": F.when(skipped, "SKIPPED").otherwise(F.col("error")),
            "coefficients": F.when(~skipped, F.col("coefficients")),
            "intercept": F.when(~skipped & ~F.isnan("intercept"), F.col("intercept")),
            "sse": F.when(~skipped & ~F.isnan("sse"), F.col("sse")),
        }
    ).drop("_ok")


# --- pooled models (MLlib) ---------------------------------------------------------------------------


def pooled_features(df: DataFrame, xs: Sequence[str], segment: str = "MARKET_SEGMENT", y: str = "BB") -> DataFrame:
    """Rows for a pooled model: regressors as doubles, target as ``label``, validation flag."""
    return df.filter(F.col(y).isNotNull()).select(
        "PARTITION_COLUMN", segment, "QUARTER", "split", F.col(y).cast("double").alias("label"),
        (F.col("split") == "val").alias("is_val"),
        *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in xs],
    )


def fit_pooled_trees(rows: DataFrame, xs: Sequence[str], kind: str = "gbt", segment: str = "MARKET_SEGMENT", max_iter: int = 40, max_depth: int = 4, seed: int = 42):
    """Boosted trees or a forest over all series at once, with the segment as a categorical feature."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    train = rows.filter(F.col("split").isin("train", "val") if kind == "gbt" else F.col("split") == "train")
    indexer = StringIndexer(inputCol=segment, outputCol="segment_index", handleInvalid="keep")
    assembler = VectorAssembler(inputCols=["segment_index", *xs], outputCol="features")
    if kind == "gbt":
        tree = GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=0.1, subsamplingRate=0.8, seed=seed, validationIndicatorCol="is_val")
    else:
        tree = RandomForestRegressor(numTrees=max_iter, maxDepth=max_depth + 2, minInstancesPerNode=2, seed=seed)
    return Pipeline(stages=[indexer, assembler, tree.setPredictionCol("BILLING_PREDICTED")]).fit(train)


def fit_pooled_sequence(df: DataFrame, keys: Sequence[str], target: str = "BB", order_by: str = "QUARTER_PARSED", lookback: int = 4):
    """One autoregression for all series; returns the model and the lagged rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    series = W.partitionBy(*keys).orderBy(order_by)
    lags = [f"lag_{i}" for i in range(1, lookback + 1)]
    rows = df.withColumns({n: F.lag(target, i).over(series) for i, n in enumerate(lags, 1)}).dropna(subset=lags)
    assembler = VectorAssembler(inputCols=lags, outputCol="features")
    regression = LinearRegression(labelCol=target, predictionCol="BILLING_PREDICTED", solver="normal", regParam=0.0)
    train = rows.filter((F.col("split") == "train") & F.col(target).isNotNull())
    return Pipeline(stages=[assembler, regression]).fit(train), rows
