"""Queries for fits, scoring, evaluation and explanation of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.joins import REGRESSORS, UNIVARIATE_SQL
from panelcast.catalog.oracle import ape
from panelcast.catalog.projections import KEYS
from panelcast.catalog.registry import register
from panelcast.catalog.scans import QUERY_CONFIG
from panelcast.config import REGRESSOR_COLUMNS
from panelcast.operators import estimators as G
from panelcast.operators import explain as E
from panelcast.operators import horizon as H
from panelcast.operators import models as M
from panelcast.operators import params as P_
from panelcast.operators import windows as X
from panelcast.plans import lifecycle as L
from panelcast.session import staged

P = "PARTITION_COLUMN"
_VALUE = "CASE {r} " + " ".join(f"WHEN '{r}' THEN p.{r}" for r in REGRESSORS) + " END"
_VALUE_P, _VALUE_U, _VALUE_R = (_VALUE.replace("{r}", f"{t}.regressor") for t in "pur")
FAMILIES_FULL = {
    "PROPHET": REGRESSOR_COLUMNS,
    "XGBOOST": ["SELLIN_MINUS3_MONTH", "SR_MINUS3_MONTH", "MOF_PLUS_BUFFER_MINUS3_MONTH"],
    "LIGHTGBM": ["BILLING_MOVING_AVERAGE_2Q", "BILLING_MOVING_AVERAGE_4Q"],
}
# small enough for a closed form in SQL
FAMILIES = {
    "PROPHET": ["SELLIN_MINUS3_MONTH", "BILLING_MOVING_AVERAGE_2Q"],
    "XGBOOST": ["SELLIN_MINUS3_MONTH"],
    "LIGHTGBM": ["BILLING_MOVING_AVERAGE_4Q"],
}


def _dispatch(spark: SparkSession, d: str, families: dict[str, list[str]]) -> DataFrame:
    settings = P_.segment_params(S.panel(spark, d).select("MARKET_SEGMENT").distinct(), P_.params_table(spark, QUERY_CONFIG))
    allowed = settings.select("MARKET_SEGMENT", F.explode("models").alias("model"))
    return M.train_dispatch(S.split_panel(spark, d), [P], families, allowed=allowed)


def _family_sql(model: str, xs: list[str], skipped: str) -> str:
    """Ridge with penalty 1 on one or two regressors, from covariances."""
    x, z = xs[0], xs[-1]
    two = len(xs) == 2
    return f"""SELECT MARKET_SEGMENT, PARTITION_COLUMN, '{model}' AS MODEL_USED, n, CASE WHEN {skipped} THEN 'SKIPPED' WHEN n < 6 THEN 'Insufficient training data: ' || n || ' rows' END AS error,
        CASE WHEN NOT ({skipped}) AND n >= 6 THEN {'(xy * (zz + l) - zy * xz) / ((xx + l) * (zz + l) - xz * xz)' if two else 'xy / (xx + l)'} END AS first_coefficient,
        CASE WHEN NOT ({skipped}) AND n >= 6 THEN {'(zy * (xx + l) - xy * xz) / ((xx + l) * (zz + l) - xz * xz)' if two else 'xy / (xx + l)'} END AS last_coefficient
      FROM (SELECT MARKET_SEGMENT, PARTITION_COLUMN, count(*) AS n, 1.0::DOUBLE / count(*) AS l, var_pop({x}) AS xx, var_pop({z}) AS zz, covar_pop({x}, {z}) AS xz,
              covar_pop({x}, BB) AS xy, covar_pop({z}, BB) AS zy FROM split_panel WHERE split = 'train' AND BB IS NOT NULL GROUP BY ALL)"""


_SKIPPED = {"PROPHET": "MARKET_SEGMENT = 'MACHINERY'", "XGBOOST": "MARKET_SEGMENT = 'MACHINERY'", "LIGHTGBM": "MARKET_SEGMENT IN ('MACHINERY', 'BUILDING')"}
register(
    "train_dispatch",
    lambda s, d: _dispatch(s, d, FAMILIES).select(
        "MARKET_SEGMENT", P, "MODEL_USED", "n", "error",
        F.col("coefficients")[0].alias("first_coefficient"), F.element_at("coefficients", -1).alias("last_coefficient"),
    ),
    " UNION ALL ".join(_family_sql(m, xs, _SKIPPED[m]) for m, xs in FAMILIES.items()),
    {5: "first_coefficient last_coefficient"},
)
register("train_dispatch_full", lambda s, d: _dispatch(s, d, FAMILIES_FULL).select("MARKET_SEGMENT", P, "MODEL_USED", "n", "sse", "error"))

_SINGLE = ["SELLIN_MINUS3_MONTH"]
register(
    "fit_ridge",
    lambda s, d: M.fit_ridge(S.split_panel(s, d), [P], _SINGLE).select(
        P, "n", F.col("coefficients")[0].alias("slope"), "intercept", "error"
    ),
    """SELECT PARTITION_COLUMN, n, CASE WHEN n >= 3 THEN slope END AS slope, CASE WHEN n >= 3 THEN yb - slope * xb END AS intercept,
         CASE WHEN n < 3 THEN 'Insufficient training data: ' || n || ' rows' END AS error FROM (
       SELECT PARTITION_COLUMN, count(*) AS n, count(*) * covar_pop(BB, SELLIN_MINUS3_MONTH) / (count(*) * var_pop(SELLIN_MINUS3_MONTH) + 1.0) AS slope,
         avg(BB) AS yb, avg(SELLIN_MINUS3_MONTH) AS xb FROM split_panel WHERE split = 'train' AND BB IS NOT NULL GROUP BY PARTITION_COLUMN)""",
    {6: "slope", 2: "intercept"},
)
register(
    "fit_ridge_full",
    lambda s, d: M.fit_ridge(S.split_panel(s, d), [P], REGRESSOR_COLUMNS).select(P, "n", "intercept", "sse", "error"),
)


def _trend_seasonal(spark: SparkSession, d: str) -> DataFrame:
    fits, rows, xs = M.fit_trend_seasonal(S.split_panel(spark, d), [P], REGRESSOR_COLUMNS)
    return L.capped(M.score_models(rows, fits, [P], xs), [P]).select(*KEYS, "split", "BILLING_PREDICTED")


register("fit_trend_seasonal", _trend_seasonal)


def _trees(spark: SparkSession, d: str) -> DataFrame:
    rows = M.pooled_features(S.split_panel(spark, d), REGRESSOR_COLUMNS)
    parts = []
    for kind in ("gbt", "forest"):
        model = M.fit_pooled_trees(rows, REGRESSOR_COLUMNS, kind)
        scored = model.transform(rows.filter(F.col("split") != "train"))
        parts.append(scored.select(*KEYS, F.lit(kind.upper()).alias("MODEL_USED"), "label", "BILLING_PREDICTED"))
    return parts[0].unionByName(parts[1])


register("fit_pooled_trees", _trees)


def _sequence(spark: SparkSession, d: str) -> DataFrame:
    model, rows = M.fit_pooled_sequence(S.split_panel(spark, d), [P])
    return model.transform(rows).select(*KEYS, "split", "BB", "BILLING_PREDICTED")


register("fit_pooled_sequence", _sequence)


def _autoreg(spark: SparkSession, d: str) -> DataFrame:
    train = S.split_panel(spark, d).filter(F.col("split") == "train")
    best = M.autoreg_select(train, [P])
    steps = M.autoreg_forecast(train, best, [P])
    return steps.join(best.select(P, "ar_order", "aic"), P)


register("autoreg_select", _autoreg)


def _features(spark: SparkSession, d: str) -> DataFrame:
    chosen = M.select_features(
        S.split_panel(spark, d), [P, "MARKET_SEGMENT"], REGRESSOR_COLUMNS, P_.feature_count("MARKET_SEGMENT", QUERY_CONFIG)
    )
    return chosen.select("MARKET_SEGMENT", P, F.array_join("selected", ",").alias("selected"), F.array_join("dropped", ",").alias("dropped"))


register("select_features", _features)



def _pair_fits(spark: SparkSession, d: str) -> DataFrame:
    """The two regressors that go best with the target, less those the segment must not use, decide each series' ridge."""
    rows, xs, excluded = S.split_panel(spark, d), REGRESSORS, {"SELLIN_MINUS3_MONTH": QUERY_CONFIG["EXCLUDE_SELLIN_PROPHET"]}
    best = M.strongest_regressors(M.covariance_stats(M.training_rows(rows, xs, "BB"), [P], xs, "BB"), [P], xs, 2)
    fits = M.fit_selected(rows, [P], xs, [best, M.usable_regressors(rows, [P], xs, "MARKET_SEGMENT", excluded)])
    weight = F.aggregate(F.filter(F.col("coefficients"), lambda w: w != 0), F.lit(0.0), lambda acc, w: acc + w)
    return fits.select(P, "n", F.array_join(F.array_sort("features"), ",").alias("features"), weight.alias("sum_of_coefficients"), "intercept", "error")


_EXCLUDED_SQL = ", ".join(f"'{s}'" for s in QUERY_CONFIG["EXCLUDE_SELLIN_PROPHET"])
register(
    "fit_selected",
    _pair_fits,
    f"""WITH long AS (SELECT p.PARTITION_COLUMN, p.MARKET_SEGMENT, p.QUARTER, r.regressor, coalesce({_VALUE_R}, 0)::DOUBLE AS x, p.BB
          FROM split_panel p CROSS JOIN (VALUES {', '.join(f"('{r}')" for r in REGRESSORS)}) r(regressor) WHERE p.split = 'train' AND p.BB IS NOT NULL),
        st AS (SELECT PARTITION_COLUMN, regressor, max(MARKET_SEGMENT) AS seg, count(*) AS n, var_pop(x) AS xx, covar_pop(x, BB) AS xy, avg(x) AS xm, avg(BB) AS ym,
            CASE WHEN min(x) < max(x) AND min(BB) < max(BB) THEN round(covar_pop(x, BB) * covar_pop(x, BB) / (var_pop(x) * var_pop(BB)), 9) END AS strength FROM long GROUP BY ALL),
        pick AS (SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY strength DESC NULLS LAST, regressor) AS rk FROM st),
        used AS (SELECT * FROM pick WHERE rk <= 2 AND strength IS NOT NULL AND NOT (regressor = 'SELLIN_MINUS3_MONTH' AND seg IN ({_EXCLUDED_SQL}))),
        two AS (SELECT a.*, b.regressor AS r2, b.xx AS zz, b.xy AS zy, b.xm AS zm FROM used a LEFT JOIN used b ON a.PARTITION_COLUMN = b.PARTITION_COLUMN AND b.regressor <> a.regressor
          QUALIFY row_number() OVER (PARTITION BY a.PARTITION_COLUMN ORDER BY a.regressor) = 1),
        cross_ AS (SELECT t.PARTITION_COLUMN, covar_pop(a.x, b.x) AS xz FROM two t JOIN long a ON a.PARTITION_COLUMN = t.PARTITION_COLUMN AND a.regressor = t.regressor
          JOIN long b ON b.PARTITION_COLUMN = t.PARTITION_COLUMN AND b.regressor = t.r2 AND b.QUARTER = a.QUARTER GROUP BY ALL),
        solved AS (SELECT t.*, CASE WHEN r2 IS NULL THEN xy / (xx + 1.0 / n) ELSE (xy * (zz + 1.0 / n) - zy * xz) / ((xx + 1.0 / n) * (zz + 1.0 / n) - xz * xz) END AS b1,
            CASE WHEN r2 IS NULL THEN 0.0 ELSE (zy * (xx + 1.0 / n) - xy * xz) / ((xx + 1.0 / n) * (zz + 1.0 / n) - xz * xz) END AS b2 FROM two t LEFT JOIN cross_ USING (PARTITION_COLUMN))
        SELECT PARTITION_COLUMN, g.n, coalesce(concat_ws(',', s.regressor, s.r2), '') AS features, CASE WHEN g.n >= 3 THEN coalesce(b1 + b2, 0.0) END AS sum_of_coefficients,
          CASE WHEN g.n >= 3 THEN coalesce(ym - b1 * xm - b2 * coalesce(zm, 0), g.m) END AS intercept, CASE WHEN g.n < 3 THEN 'Insufficient training data: ' || g.n || ' rows' END AS error
        FROM (SELECT PARTITION_COLUMN, count(*) AS n, avg(BB) AS m FROM split_panel WHERE split = 'train' AND BB IS NOT NULL GROUP BY PARTITION_COLUMN) g LEFT JOIN solved s USING (PARTITION_COLUMN)""",
    {3: "sum_of_coefficients", 1: "intercept"},
)


def _rivals(spark: SparkSession, d: str) -> DataFrame:
    return L.fitted_rivals(S.split_panel(spark, d), [P], QUERY_CONFIG)


register("fitted_rivals", lambda s, d: _rivals(s, d).select(*KEYS, "MODEL_USED", "split", F.array_join("features", ",").alias("features"), "BILLING_PREDICTED", "error"))
register("rival_champions", lambda s, d: L.rival_champions(_rivals(s, d), [P]).select(P, "MODEL_USED", "val_mae", "val_mape", "n_val"))

ALPHAS = [0.0, 0.1, 1.0, 10.0, 1e3, 1e6, 1e9, 1e12]
register(
    "param_grid_search",
    lambda s, d: M.topk_params(M.param_grid_search(S.split_panel(s, d), [P], _SINGLE, [1e3, 1e12, 1e13, 1e14]), 10),
    f"""WITH st AS (SELECT PARTITION_COLUMN, count(*) AS n, covar_pop(BB, SELLIN_MINUS3_MONTH) AS xy, var_pop(SELLIN_MINUS3_MONTH) AS xx, avg(BB) AS yb,
            avg(SELLIN_MINUS3_MONTH) AS xb FROM split_panel WHERE split = 'train' AND BB IS NOT NULL GROUP BY PARTITION_COLUMN),
          fits AS (SELECT PARTITION_COLUMN, alpha, n, yb, xb, xy / (xx + alpha / n) AS b FROM st CROSS JOIN (VALUES (1e3), (1e12), (1e13), (1e14)) g(alpha)),
          sc AS (SELECT v.PARTITION_COLUMN, f.alpha, v.BB AS y, CASE WHEN f.n >= 3 THEN greatest(f.yb - f.b * f.xb + f.b * v.SELLIN_MINUS3_MONTH, 0.0) END AS p
            FROM split_panel v JOIN fits f USING (PARTITION_COLUMN) WHERE v.split = 'val' AND v.BB IS NOT NULL),
          a AS (SELECT PARTITION_COLUMN, alpha, avg({ape('y', 'p')}) AS val_ape, avg(abs(y - p)) AS val_mae FROM sc GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY round(val_ape, 9) NULLS LAST, alpha) AS rank FROM a""",
    {4: "val_mae", 6: "val_ape"},
)
register(
    "param_grid_search_full",
    lambda s, d: M.topk_params(M.param_grid_search(S.split_panel(s, d), [P], REGRESSOR_COLUMNS, ALPHAS), 10),
)


def _trained(spark: SparkSession, d: str) -> DataFrame:
    """All configured families of the newest snapshot, fitted once for the queries that read them."""
    settings = P_.params_table(spark, QUERY_CONFIG)
    return staged(spark, "families", d, lambda: L.train_configured(S.split_panel(spark, d), [P], QUERY_CONFIG, settings))


register("train_families", lambda s, d: _trained(s, d).drop("_quarters", "forecasts"))
register("family_forecasts", lambda s, d: G.family_forecasts(_trained(s, d), [P]))
register("family_champions", lambda s, d: G.family_champions(_trained(s, d), [P]))


def _leaderboard(family: G.Family):
    return lambda s, d: M.topk_params(G.grid_leaderboard(S.split_panel(s, d), [P], family), 10)


register("grid_trend", _leaderboard(L.configured_families(QUERY_CONFIG)["PROPHET"]))
register("grid_trees", _leaderboard(L.configured_families(QUERY_CONFIG)["XGBOOST"]))
register(
    "grid_ridge",
    lambda s, d: G.grid_leaderboard(S.split_panel(s, d), [P], G.Family("ridge", _SINGLE, {"alpha": [1e3, 1e12, 1e13, 1e14]}, metric="ape")).select(
        P, "n", F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), "val_ape", "val_mae", "rank", "combinations", "error"
    ),
    f"""WITH st AS (SELECT PARTITION_COLUMN, count(BB) FILTER (WHERE split = 'train') AS n, covar_pop(BB, coalesce(SELLIN_MINUS3_MONTH, 0)) FILTER (WHERE split = 'train' AND BB IS NOT NULL) AS xy,
            var_pop(coalesce(SELLIN_MINUS3_MONTH, 0)) FILTER (WHERE split = 'train' AND BB IS NOT NULL) AS xx, avg(BB) FILTER (WHERE split = 'train') AS yb,
            avg(coalesce(SELLIN_MINUS3_MONTH, 0)) FILTER (WHERE split = 'train' AND BB IS NOT NULL) AS xb FROM split_panel GROUP BY PARTITION_COLUMN),
          fits AS (SELECT PARTITION_COLUMN, alpha, n, yb, xb, xy / (xx + alpha / n) AS b FROM st CROSS JOIN (VALUES (1e3), (1e12), (1e13), (1e14)) g(alpha)),
          sc AS (SELECT f.PARTITION_COLUMN, f.alpha, f.n, v.BB AS y, CASE WHEN f.n >= 6 THEN greatest(f.yb - f.b * f.xb + f.b * coalesce(v.SELLIN_MINUS3_MONTH, 0), 0.0) END AS p
            FROM fits f LEFT JOIN split_panel v ON v.PARTITION_COLUMN = f.PARTITION_COLUMN AND v.split = 'val' AND v.BB IS NOT NULL),
          a AS (SELECT PARTITION_COLUMN, alpha, n, avg({ape('y', 'p')}) AS val_ape, avg(abs(y - p)) AS val_mae FROM sc GROUP BY ALL)
        SELECT PARTITION_COLUMN, n, alpha, val_ape, val_mae, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY round(val_ape, 9) NULLS LAST, alpha) AS rank, 4 AS combinations,
          CASE WHEN n < 6 THEN 'Insufficient training data: ' || n || ' rows' END AS error FROM a""",
    {4: "val_mae", 6: "val_ape"},
)
register("direct_sequence", lambda s, d: G.direct_sequence(S.split_panel(s, d), [P])[1])
register(
    "direct_sequence_one_lag",
    lambda s, d: G.direct_sequence(S.split_panel(s, d), [P], lookback=1, alpha=0.0)[1].select(P, "step", "BILLING_PREDICTED"),
    """WITH tr AS (SELECT PARTITION_COLUMN, BB::DOUBLE AS y, avg(BB::DOUBLE) OVER (PARTITION BY PARTITION_COLUMN) AS m, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY QUARTER) AS i,
            row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY QUARTER DESC) AS back FROM split_panel WHERE split = 'train'),
          z AS (SELECT *, CASE WHEN m > 0 THEN y / m END AS z FROM tr),
          fit AS (SELECT h.step, regr_slope(b.z, a.z) AS slope, regr_intercept(b.z, a.z) AS start FROM range(1, 7) h(step) JOIN z a ON a.z IS NOT NULL
            JOIN z b ON b.PARTITION_COLUMN = a.PARTITION_COLUMN AND b.i = a.i + h.step AND b.z IS NOT NULL GROUP BY h.step)
        SELECT PARTITION_COLUMN, step::INTEGER AS step, CASE WHEN z IS NOT NULL THEN greatest((start + slope * z) * m, 0.0) END AS BILLING_PREDICTED FROM z CROSS JOIN fit WHERE back = 1""",
    {2: "BILLING_PREDICTED"},
)


def _split_forecasts(spark: SparkSession, d: str) -> DataFrame:
    return X.split_train_val_test(S.forecasts(spark, d), [P, "MODEL_USED"])


register(
    "val_scores",
    lambda s, d: M.val_scores(_split_forecasts(s, d), [P, "MODEL_USED"], "BILLING"),
    f"""SELECT PARTITION_COLUMN, MODEL_USED, avg(abs(BILLING - BILLING_PREDICTED)) AS val_mae, avg({ape('BILLING', 'BILLING_PREDICTED')}) AS val_mape, count(*) AS n_val
        FROM (SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN, MODEL_USED ORDER BY qi DESC) AS back FROM fc)
        WHERE back IN (7, 8) AND BILLING IS NOT NULL AND BILLING_PREDICTED IS NOT NULL GROUP BY ALL""",
    {6: "val_mae val_mape"},
)


def _univariate(spark: SparkSession, d: str) -> DataFrame:
    rows = _split_forecasts(spark, d).filter(F.col("split") != "train")
    return M.univariate_result(rows, [P, "MODEL_USED"], "BILLING")


register(
    "univariate_result",
    _univariate,
    """SELECT PARTITION_COLUMN, MODEL_USED, avg(ape) AS mape, count(*) AS n_rows, 'val+test' AS mape_scope
       FROM (SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN, MODEL_USED ORDER BY qi DESC) AS back FROM fc)
       WHERE back <= 8 AND k NOT IN (0, 5, 6) GROUP BY ALL""",
    {6: "mape"},
)


def _metrics_row(spark: SparkSession, d: str) -> DataFrame:
    fits = M.fit_ridge(S.split_panel(spark, d), [P], REGRESSOR_COLUMNS)
    return L.training_record(fits, REGRESSOR_COLUMNS, "RIDGE", {"alpha": 1.0}).select(P, "MODEL_USED", "training_metrics", "used_params", "error")


register("train_metrics_row", _metrics_row)




def _score(spark: SparkSession, d: str) -> DataFrame:
    """One model for each regressor, in one pass: the regressor is part of the key."""
    rows = S.split_panel(spark, d)
    fits = M.univariate_fits(rows, [P], REGRESSORS).filter(F.col("coefficient").isNotNull())
    payload = fits.select(P, "regressor", "intercept", F.array("coefficient").alias("coefficients"))
    long = rows.select(*KEYS, "split", F.explode(M.regressor_pairs(REGRESSORS)).alias("r")).select(*KEYS, "split", F.col("r.name").alias("regressor"), F.col("r.value").alias("x"))
    return M.score_models(long, payload, [P, "regressor"], ["x"]).select(*KEYS, "regressor", "split", "BILLING_PREDICTED")


register(
    "score_models",
    _score,
    f"""SELECT p.PARTITION_COLUMN, p.QUARTER, p.split, p.regressor, CASE WHEN u.coefficient IS NOT NULL THEN greatest(u.intercept + u.coefficient * coalesce({_VALUE_P}, 0), 0.0) END AS BILLING_PREDICTED
        FROM (SELECT * FROM split_panel CROSS JOIN (VALUES {', '.join(f"('{r}')" for r in REGRESSORS)}) r(regressor)) p
        LEFT JOIN ({UNIVARIATE_SQL}) u ON u.PARTITION_COLUMN = p.PARTITION_COLUMN AND u.regressor = p.regressor AND u.coefficient IS NOT NULL""",
    {2: "BILLING_PREDICTED"},
)


def _inference(spark: SparkSession, d: str) -> DataFrame:
    published = L.run_inference(
        S.forecasts(spark, d), S.champions(spark, d), F.lit(S.NOW).cast("timestamp_ntz"), S.DATA_TABLE, S.LATEST
    )
    return published.select(*KEYS, "MODEL_USED", "MODEL_VERSION", "PREDICTIONS_VERSION", "BILLING", "BILLING_PREDICTED", "APE", "DATA_TABLE", "DATA_VERSION", *H.indicator_columns())


register(
    "run_inference",
    _inference,
    f"""SELECT f.PARTITION_COLUMN, f.QUARTER, f.MODEL_USED, 'V_3' AS MODEL_VERSION, 'V_20010725_120000' AS PREDICTIONS_VERSION, f.BILLING, f.BILLING_PREDICTED,
          f.ape AS APE, 'horizon_panel' AS DATA_TABLE, 'V_3' AS DATA_VERSION, {', '.join('f.' + c for c in H.indicator_columns())}
        FROM fc_ind f JOIN champ c ON c.PARTITION_COLUMN = f.PARTITION_COLUMN AND c.MODEL_USED = f.MODEL_USED WHERE f.k <> 0""",
    {6: "APE"},
)

_QS = [f"Q{h}_MAPE" for h in range(1, 7)]
register(
    "evaluate_windows",
    lambda s, d: S.build_window_metrics(s, d),
    f"""SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, BACKTEST_WINDOW, WINDOW_START_QUARTER, WINDOW_END_QUARTER, MAPE, prediction_count,
          {', '.join(_QS)}, HORIZON_MAPE FROM win_metrics""",
    {6: "MAPE HORIZON_MAPE " + " ".join(_QS)},
)

register("legacy_forecast", lambda s, d: L.legacy_forecast(S.split_panel(s, d), P_.params_table(s, QUERY_CONFIG)).select(*KEYS, "MODEL_USED", "BILLING", "BILLING_PREDICTED", "APE"))

register(
    "linear_contributions",
    lambda s, d: E.linear_contributions(S.split_panel(s, d), _fits(s, d), REGRESSORS),
    f"""SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY mean_abs DESC NULLS LAST, regressor) AS rank FROM (
          SELECT u.PARTITION_COLUMN, u.regressor, avg(abs(u.coefficient * (coalesce({_VALUE_U}, 0) - u.x_mean))) AS mean_abs
          FROM split_panel p JOIN ({UNIVARIATE_SQL}) u USING (PARTITION_COLUMN) GROUP BY ALL)""",
    {2: "mean_abs"},
)


def _fits(spark: SparkSession, d: str) -> DataFrame:
    return M.univariate_fits(S.split_panel(spark, d), [P], REGRESSORS)


def _permutation(spark: SparkSession, d: str) -> DataFrame:
    xs = list(REGRESSOR_COLUMNS)
    rows = M.pooled_features(S.split_panel(spark, d), xs)
    model = M.fit_pooled_trees(rows, xs, "forest")
    return E.permutation_importance(model.transform(E.permute_features(rows, xs, KEYS)))


register("permutation_importance", _permutation)

register(
    "component_summary",
    lambda s, d: E.component_summary(E.components(S.clean(s, d).filter(F.col("BB").isNotNull()), [P]), [P]),
    """WITH fit AS (SELECT *, regr_slope(BB, CAST(qi AS DOUBLE)) OVER (PARTITION BY PARTITION_COLUMN) AS b, regr_intercept(BB, CAST(qi AS DOUBLE)) OVER (PARTITION BY PARTITION_COLUMN) AS a
          FROM clean WHERE BB IS NOT NULL),
        tr AS (SELECT *, a + b * qi AS trend FROM fit), se AS (SELECT *, avg(BB - trend) OVER (PARTITION BY PARTITION_COLUMN, qi % 4) AS seasonal FROM tr)
       SELECT PARTITION_COLUMN, avg(trend) AS trend_mean, stddev_samp(trend) AS trend_std, min(trend) AS trend_min, max(trend) AS trend_max,
         avg(seasonal) AS seasonal_mean, max(seasonal) - min(seasonal) AS seasonal_amplitude FROM se GROUP BY PARTITION_COLUMN""",
    {1: "trend_mean trend_std trend_min trend_max seasonal_mean seasonal_amplitude"},
)


def _explain(spark: SparkSession, d: str) -> DataFrame:
    """The fitted rival of the lifecycle, explained on the quarters it was trained on."""
    rows = S.clean(spark, d)
    fits = M.coefficient_rows(M.ridge_to_origin(rows, [P], REGRESSOR_COLUMNS), [P], REGRESSOR_COLUMNS)
    seen = rows.filter(F.col("QUARTER") <= F.col("ORIGIN_QUARTER"))
    return E.explain_rows(E.linear_contributions(seen, fits, REGRESSOR_COLUMNS), fits, S.champions(spark, d), "RIDGE")


register("explain_rows", _explain)

