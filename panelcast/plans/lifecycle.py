"""The stages of the forecast lifecycle as compositions of operators, from panel to monitoring.

Thresholds come from the configuration (``config.load_config``), by default the shipped one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.config import BRAND_KEY_COLUMNS, DEFAULTS, REGRESSOR_COLUMNS
from panelcast.functions.metrics import ape
from panelcast.operators import clean as C
from panelcast.operators import diagnose as D
from panelcast.operators import estimators as G
from panelcast.operators import horizon as H
from panelcast.operators import models as M
from panelcast.operators import monitor as MO
from panelcast.operators import quality as Q
from panelcast.operators import windows as X
from panelcast.operators.params import feature_count as feature_count_of
from panelcast.operators.params import segment_params
from panelcast.sources import sinks
from panelcast.sources.tables import derive_scenario, normalize_column_names, project_existing, scan_latest_version, with_partition


def load_panel(table: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = tuple(BRAND_KEY_COLUMNS), impute: bool = False) -> DataFrame:
    """Newest snapshot, scenario label, forward fill, wanted columns, optional rebuilt averages."""
    rows = scan_latest_version(normalize_column_names(table))
    rows = with_partition(derive_scenario(rows), [k for k in keys if k in rows.columns or k == "SCENARIO"])
    rows = C.ffill_target(rows, ["PARTITION_COLUMN"])
    if columns is not None:
        rows = project_existing(rows, columns, ["SCENARIO", "PARTITION_COLUMN", "BB_RAW", "is_actual"])
    return C.impute_history_ma(rows, ["PARTITION_COLUMN"]) if impute else rows


def gate(panel: DataFrame, config: dict = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Clean series and the report of what was removed."""
    report = Q.dq_report(Q.dq_profile(panel), minimum=config["DATA_QUALITY"]["MIN_TRAIN_PERIODS"])
    return C.dq_exclude(panel, report), report


def capped(scored: DataFrame, keys: Sequence[str], target: str = "BB", predicted: str = "BILLING_PREDICTED") -> DataFrame:
    """Predictions held between 0 and ten times the largest training value of their series."""
    top = F.max(F.when(F.col("split") == "train", F.col(target))).over(W.partitionBy(*keys)) * 10
    return scored.withColumn("_cap", top).withColumn(
        predicted, F.when(F.col(predicted) > F.col("_cap"), F.col("_cap")).otherwise(F.col(predicted))
    ).drop("_cap")


def training_record(fits: DataFrame, features: Sequence[str], model: str, params: dict[str, float]) -> DataFrame:
    """One training result per series: metrics and settings as JSON, errors kept as rows."""
    metrics = F.struct(
        F.col("n").alias("n_train"), F.round("sse", 4).alias("sse"), F.lit(len(features)).alias("n_regressors"),
        F.array(*[F.lit(f) for f in features]).alias("regressors"),
    )
    used = F.create_map(*[F.lit(x) for pair in params.items() for x in pair])
    return fits.withColumns(
        {"MODEL_USED": F.lit(model), "training_metrics": F.to_json(metrics), "used_params": F.to_json(used)}
    )


def train(panel: DataFrame, families: dict[str, Sequence[str]], allowed: DataFrame | None = None) -> DataFrame:
    """Split every series and fit all families in one pass."""
    return M.train_dispatch(X.split_train_val_test(panel, ["PARTITION_COLUMN"]), ["PARTITION_COLUMN"], families, allowed=allowed)


def evaluate(forecasts: DataFrame, n_windows: int = 3, stride: int = 1, config: dict = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Backtest metrics per window and the champion per series. ``forecasts`` carries ``k`` and the actuals."""
    rule = config["EVALUATION"]
    start, end = rule["horizon_range"]
    windows = X.backtest_windows(forecasts, n_windows, stride)
    metrics = H.evaluate_windows(forecasts, windows, ["MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"], start, end, max_horizon=end)
    scores = H.backtest_aggregate(metrics, ["MARKET_SEGMENT", "PARTITION_COLUMN", "MODEL_USED"], rule["BACKTEST"]["stability_penalty"])
    return metrics, H.select_champion(scores)


def implausible_champions(champions: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """Champions outside the error range of the quality gates, with the reason."""
    rule = config["QUALITY_GATES"]
    return H.quality_gate_flags(champions, low=rule["MIN_CHAMPION_MAPE"], high=rule["MAX_CHAMPION_MAPE"])


def run_inference(forecasts: DataFrame, champions: DataFrame, now: Column, data_table: str, data_version: str, max_horizon: int = 6) -> DataFrame:
    """The champions' predictions with error, indicators, distances and directions, stamped and ready to append. Series without a champion
    are left out here and reported by ``coverage_missing``, champions without a prediction by ``failed_champions``."""
    best = champions.select("PARTITION_COLUMN", "MODEL_USED")
    rows = forecasts.join(best, ["PARTITION_COLUMN", "MODEL_USED"]).withColumn("MODEL_VERSION", F.lit(data_version))
    rows = H.add_indicators(rows.withColumn("APE", ape("BILLING", "BILLING_PREDICTED")))
    rows = C.remove_unwanted_rows(rows, ["PARTITION_COLUMN"], max_horizon)
    return sinks.stamp_batch(rows, now, DATA_TABLE=data_table, DATA_VERSION=data_version)


def failed_champions(forecasts: DataFrame, champions: DataFrame) -> DataFrame:
    """Champions that predict nothing after the origin, as findings for the error log."""
    predicted = forecasts.filter((F.col("k") > 0) & F.col("BILLING_PREDICTED").isNotNull()).select("PARTITION_COLUMN", "MODEL_USED").distinct()
    return champions.join(predicted, ["PARTITION_COLUMN", "MODEL_USED"], "left_anti").select(
        F.lit("inference").alias("stage"), F.col("PARTITION_COLUMN").alias("partition"), F.col("MODEL_USED").alias("model_type"),
        F.lit("error").alias("severity"), F.lit("No prediction for the champion").alias("message"),
    )


def check_predictions(published: DataFrame, config: dict = DEFAULTS) -> DataFrame:
    """Implausible predictions, one row per partition and issue."""
    rule = config["PREDICTION_SANITY_CHECKS"]
    checks = Q.sanity_checks(
        published, extreme=rule["EXTREME_APE_THRESHOLD"], min_unique=rule["FLAT_MIN_UNIQUE_VALUES"],
        min_direction=rule["MIN_DIRECTIONAL_CORRECTNESS"], max_distance=rule["MAX_VALIDATION_DISTANCE"],
    )
    return Q.sanity_report(checks)


def monitor(predictions: DataFrame, actuals: DataFrame, champions: DataFrame, models: DataFrame, now: Column, data_version: str, config: dict = DEFAULTS) -> DataFrame:
    """All monitoring records of a refresh."""
    rule = config["MONITORING"]
    days = rule["STALENESS"]["MAX_MODEL_AGE_DAYS"]
    backtest = MO.backtest_against_estimates(predictions, actuals, champions, rule["BACKTEST_ACTUALS"]["MAPE_RATIO_ALERT_THRESHOLD"])
    return MO.monitoring_records(backtest, MO.model_staleness(models, now, days), data_version, days)


def diagnose(panel: DataFrame) -> DataFrame:
    """Verdict on a panel."""
    averages = D.ma_summary(D.ma_consistency(panel))
    lags = D.autocorrelation_summary(D.autocorrelation(panel))
    return D.diagnostic_verdict(averages, D.pearson_matrix(panel, left=["BB"]), lags)


def fitted_rivals(
    split_rows: DataFrame, keys: Sequence[str], config: dict = DEFAULTS, regressors: Sequence[str] = tuple(REGRESSOR_COLUMNS), segment: str = "MARKET_SEGMENT", y: str = "BB",
) -> DataFrame:
    """Forecasts of several fitted models for every row, in long form: the columns of ``split_rows``, MODEL_USED, ``features``, BILLING_PREDICTED and ``error``.

    RIDGE has all regressors, RIDGE_SELECTED those that backward elimination leaves of the ones its segment may use (``EXCLUDE_SELLIN_XGBOOST``), and the piecewise trend
    comes with an additive season, a multiplicative one, and saturating growth up to the segment's largest training value times 1.2 (``EXCLUDE_SELLIN_PROPHET`` holds
    for all three). All see training rows only. A failed fit keeps its rows, without a forecast and with its error.
    """
    xs = list(regressors)
    first = [x for x in xs if x.startswith("SELLIN")]
    usable = {name: M.usable_regressors(split_rows, keys, xs, segment, {x: config[f"EXCLUDE_SELLIN_{name}"] for x in first}) for name in ("XGBOOST", "PROPHET")}
    chosen = M.select_features(split_rows, keys, xs, feature_count_of(segment, config), y=y)
    plain = M.fit_ridge(split_rows, keys, xs, y, config["RIDGE_ALPHA"]).withColumn("features", F.array(*[F.lit(x) for x in xs]))
    selected = M.fit_selected(split_rows, keys, xs, [chosen, usable["XGBOOST"]], y, config["RIDGE_ALPHA"])
    columns = [*split_rows.columns, "MODEL_USED", "features", "BILLING_PREDICTED", "error"]
    out = []
    for name, fits in (("RIDGE", plain), ("RIDGE_SELECTED", selected)):
        scored = M.score_models(split_rows, fits, keys, xs).join(fits.select(*keys, "features", "error"), list(keys), "left")
        out.append(scored.withColumn("MODEL_USED", F.lit(name)).select(*columns))
    top = F.max(F.when(F.col("split") == "train", F.col(y))).over(W.partitionBy(*keys)) * 1.2
    bounded = split_rows.withColumns({"_cap": top, "_floor": F.lit(0.0)}).join(usable["PROPHET"].withColumnRenamed("selected", "_usable"), list(keys), "left")
    bounded = bounded.withColumns({x: F.when(F.array_contains("_usable", x), F.col(x)).otherwise(F.lit(0.0)) for x in first})
    own = split_rows.select(*keys, "QUARTER", *first) if first else None
    for name, season, growth in (("TREND_ADDITIVE", "additive", "linear"), ("TREND_MULTIPLICATIVE", "multiplicative", "linear"), ("TREND_SATURATING", "additive", "logistic")):
        fits, rows, features = M.fit_trend_seasonal(bounded, keys, xs, y, season=season, growth=growth, cap="_cap", floor="_floor")
        scored = capped(M.score_trend(rows, fits, keys, features, season, growth, "_cap", "_floor"), keys, y).join(fits.select(*keys, "error"), list(keys), "left")
        kept = F.array(*[F.lit(x) for x in xs if x not in first])
        used = F.array_union(F.array_intersect("_usable", F.array(*[F.lit(x) for x in first])), kept) if first else kept
        scored = scored.withColumns({"MODEL_USED": F.lit(name), "features": used})
        if own is not None:  # the excluded values were 0 for the fit alone
            scored = scored.drop(*first).join(own, [*keys, "QUARTER"])
        out.append(scored.select(*columns))
    rows = out[0]
    for part in out[1:]:
        rows = rows.unionByName(part)
    return rows


def rival_champions(rivals: DataFrame, keys: Sequence[str], y: str = "BB") -> DataFrame:
    """The fitted model with the smallest mean validation error of each series, of those with a finite error above 0."""
    return H.select_champion(M.val_scores(rivals, [*keys, "MODEL_USED"], y), tuple(keys), score="val_mape", fallbacks=(), metric="val_mape")


def configured_families(config: dict = DEFAULTS, regressors: Sequence[str] = tuple(REGRESSOR_COLUMNS), n_iter: int = 50) -> dict[str, G.Family]:
    """The estimator, grid and exclusions behind each model name: piecewise trends, three kinds of boosted trees, a ridge, and an autoregression without regressors."""
    xs = list(regressors)
    first = [x for x in xs if x.startswith("SELLIN")]
    barred = {name: {x: config[f"EXCLUDE_SELLIN_{name}"] for x in first} for name in ("PROPHET", "XGBOOST")}
    return {
        "PROPHET": G.Family("trend", xs, G.TREND_GRID, n_iter, "ape", barred["PROPHET"]),
        "XGBOOST": G.Family("boosted", xs, G.TREE_GRID, n_iter, excluded=barred["XGBOOST"]),
        "LIGHTGBM": G.Family("boosted", xs, G.LEAF_GRID, n_iter, excluded=barred["XGBOOST"]),
        "CATBOOST": G.Family("boosted", xs, G.CAT_GRID, n_iter, excluded=barred["XGBOOST"]),
        "RIDGE": G.Family("ridge", xs, {"alpha": [0.1, 1.0, 10.0, 1e3, 1e6, 1e9, 1e12]}, excluded=barred["XGBOOST"]),
        "AUTOARIMA": G.Family("autoregression"),
    }


def train_configured(split_rows: DataFrame, keys: Sequence[str], config: dict, params: DataFrame, segment: str = "MARKET_SEGMENT", n_iter: int = 50) -> DataFrame:
    """``train_families`` over ``configured_families``: the names a segment is configured for, and the two baselines RIDGE and AUTOARIMA for all."""
    settings = segment_params(split_rows.select(segment).distinct(), params.select(segment, "models"))
    names = F.concat(F.coalesce("models", F.array().cast("array<string>")), F.array(F.lit("ridge"), F.lit("autoarima")))
    return G.train_families(split_rows, keys, configured_families(config, n_iter=n_iter), settings.select(segment, F.explode(names).alias("model")), segment)


def legacy_forecast(split_rows: DataFrame, params: DataFrame, regressors: Sequence[str] = tuple(REGRESSOR_COLUMNS)) -> DataFrame:
    """One configured model per series and no competition.

    PROPHET means trend, seasonality and regressors; XGBOOST and LIGHTGBM a regression on the adjusted regressors. Both are fitted from the same rows with all
    regressors; the segment's setting picks the one that counts. Rows of a segment with another setting stay, without a prediction and with an ``error``.
    """
    key = ["PARTITION_COLUMN"]
    rows = C.zero_regressor_fill(C.adjust_regressors(split_rows, regressors), regressors)
    fits, featured, xs = M.fit_trend_seasonal(rows, key, list(regressors))
    trend = M.score_models(featured, fits, key, xs).withColumn("MODEL_USED", F.lit("PROPHET"))
    plain = M.score_models(rows, M.fit_ridge(rows, key, regressors), key, regressors).withColumn("MODEL_USED", F.lit("XGBOOST"))
    both = trend.select(*plain.columns).unionByName(plain)
    settings = segment_params(both, params.select("MARKET_SEGMENT", "preferred_model"))
    setting = F.upper("preferred_model")
    known = F.coalesce(setting.isin("PROPHET", "XGBOOST", "LIGHTGBM"), F.lit(False))
    fitted = F.when(setting == "PROPHET", "PROPHET").otherwise("XGBOOST")
    picked = settings.filter(F.col("MODEL_USED") == fitted).withColumns(
        {
            "MODEL_USED": F.coalesce(setting, F.lit("N/A")),
            "BILLING_PREDICTED": F.when(known, F.col("BILLING_PREDICTED")),
            "error": F.when(~known, F.concat(F.lit("Unknown model: "), F.coalesce("preferred_model", F.lit("none")))),
        }
    )
    chosen = capped(picked, key)
    out = chosen.withColumn("BILLING", F.col("BB_RAW")).withColumn("APE", ape("BB_RAW", "BILLING_PREDICTED"))
    return C.remove_unwanted_rows(out.drop("BB", "preferred_model"), key)


__all__ = [
    "capped", "check_predictions", "configured_families", "diagnose", "evaluate", "failed_champions", "fitted_rivals", "gate", "implausible_champions", "legacy_forecast", "load_panel", "monitor", "rival_champions", "run_inference", "train", "train_configured", "training_record",
]
