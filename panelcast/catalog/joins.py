"""Queries for joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.oracle import known, qlabel
from panelcast.catalog.projections import KEYS, K
from panelcast.catalog.registry import register
from panelcast.config import REGRESSOR_COLUMNS
from panelcast.operators import clean as C
from panelcast.operators import horizon as H
from panelcast.operators import joins as J
from panelcast.operators import models as M
from panelcast.operators import monitor as MO
from panelcast.operators import params as P
from panelcast.operators import windows as X


REGRESSORS = list(REGRESSOR_COLUMNS)


def _partitions(spark: SparkSession, d: str) -> DataFrame:
    return S.panel(spark, d).select("PARTITION_COLUMN").distinct()


register(
    "cross_partition_models",
    lambda s, d: P.cross_partition_models(_partitions(s, d), s.createDataFrame([("prophet",), ("ridge",), ("seasonalnaive",)], "model string")),
    """SELECT PARTITION_COLUMN, model FROM (SELECT DISTINCT PARTITION_COLUMN FROM panel)
       CROSS JOIN (VALUES ('prophet'), ('ridge'), ('seasonalnaive')) m(model)""",
)

register(
    "join_eval_keys",
    lambda s, d: J.join_eval_keys(
        S.panel(s, d).select(*KEYS, "BB"), S.champions(s, d).select("PARTITION_COLUMN", "MODEL_USED")
    ),
    "SELECT p.PARTITION_COLUMN, p.QUARTER, p.BB, c.MODEL_USED FROM panel p JOIN champ c USING (PARTITION_COLUMN)",
)


def _payload(spark: SparkSession, d: str) -> DataFrame:
    rows = S.split_panel(spark, d)
    fits = M.univariate_fits(rows, ["PARTITION_COLUMN"], REGRESSORS)
    long = rows.select(*KEYS, F.explode(F.array(*[F.lit(r) for r in REGRESSORS])).alias("regressor"))
    return J.join_model_payload(long, fits.select("PARTITION_COLUMN", "regressor", "coefficient", "n"), ["PARTITION_COLUMN", "regressor"])


# fixed values: straight lines per partition and regressor, used by several statements
UNIVARIATE_SQL = " UNION ALL ".join(
    f"""SELECT PARTITION_COLUMN, '{r}' AS regressor, count(*) AS n, {known(f'regr_slope(BB, coalesce({r}, 0))')} AS coefficient,
          {known(f'regr_intercept(BB, coalesce({r}, 0))')} AS intercept, avg(coalesce({r}, 0)) AS x_mean
        FROM split_panel WHERE split = 'train' AND BB IS NOT NULL GROUP BY PARTITION_COLUMN"""
    for r in REGRESSORS
)
register(
    "join_model_payload",
    _payload,
    f"""SELECT p.PARTITION_COLUMN, p.QUARTER, u.regressor, u.coefficient, u.n FROM panel p JOIN ({UNIVARIATE_SQL}) u USING (PARTITION_COLUMN)""",
    {6: "coefficient"},
)


def _future(spark: SparkSession, d: str) -> DataFrame:
    panel = S.panel(spark, d)
    calendar = X.calendar_future(panel, ["PARTITION_COLUMN"], 3)
    return J.join_future_regressors(calendar, panel, REGRESSORS, ["PARTITION_COLUMN"])


_FILL = ", ".join(
    f"""coalesce(last_value({r} IGNORE NULLS) OVER w, first_value({r} IGNORE NULLS) OVER w2, 0) AS {r}""" for r in REGRESSORS
)
register(
    "join_future_regressors",
    _future,
    f"""SELECT PARTITION_COLUMN, QUARTER, {_FILL} FROM (
          SELECT c.PARTITION_COLUMN, {qlabel('c.qi')} AS QUARTER, c.qi, {', '.join('p.' + r for r in REGRESSORS)}
          FROM (SELECT PARTITION_COLUMN, unnest(range(min(qi), max(qi) + 4)) AS qi FROM panel GROUP BY PARTITION_COLUMN) c
          LEFT JOIN panel p ON p.PARTITION_COLUMN = c.PARTITION_COLUMN AND p.qi = c.qi)
        WINDOW w AS (PARTITION BY PARTITION_COLUMN ORDER BY qi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               w2 AS (PARTITION BY PARTITION_COLUMN ORDER BY qi ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)


def _forecast_right(spark: SparkSession, d: str) -> DataFrame:
    known = C.valid_actuals(S.panel(spark, d)).select("PARTITION_COLUMN", "QUARTER_PARSED", "BB")
    later = S.forecasts(spark, d).filter(F.col("k") > 0).select(
        "PARTITION_COLUMN", (F.col("QUARTER_PARSED") + F.expr("INTERVAL 7 HOURS")).alias("QUARTER_PARSED"), "MODEL_USED", "BILLING_PREDICTED"
    )
    joined = J.join_forecast_right(known, later, ["PARTITION_COLUMN"])
    return joined.withColumn("QUARTER_PARSED", F.date_format("QUARTER_PARSED", "yyyy-MM-dd"))


register(
    "join_forecast_right",
    _forecast_right,
    """SELECT f.PARTITION_COLUMN, strftime(f.QUARTER_PARSED, '%Y-%m-%d') AS QUARTER_PARSED, p.BB, f.MODEL_USED, f.BILLING_PREDICTED
       FROM (SELECT * FROM panel WHERE BB <> 0) p RIGHT JOIN (SELECT * FROM fc WHERE k > 0) f
         ON p.PARTITION_COLUMN = f.PARTITION_COLUMN AND p.qi = f.qi""",
)


def _identity(spark: SparkSession, d: str) -> DataFrame:
    trend = S.forecasts(spark, d).filter((F.col("MODEL_USED") == "TREND") & (F.col("k") > 0))
    keys = ["PARTITION_COLUMN", "MARKET_SEGMENT", "QUARTER", "QUARTER_PARSED"]
    return J.join_forecast_identity(S.panel(spark, d).select(*keys, "BB"), trend, keys).drop("QUARTER_PARSED", "MARKET_SEGMENT")


register(
    "join_forecast_identity",
    _identity,
    """SELECT p.PARTITION_COLUMN, p.QUARTER, p.BB, f.BILLING_PREDICTED FROM panel p
       LEFT JOIN (SELECT * FROM fc WHERE MODEL_USED = 'TREND' AND k > 0) f ON f.PARTITION_COLUMN = p.PARTITION_COLUMN AND f.qi = p.qi""",
)

REALIZED_SQL = """SELECT p.VERSION, p.PREDICTIONS_VERSION, p.MARKET_SEGMENT, p.PARTITION_COLUMN, p.QUARTER, p.MODEL_USED, p.k, p.PREDICTION_HORIZON,
    p.BILLING_PREDICTED, a.BB AS BB_ACTUAL, abs(a.BB - p.BILLING_PREDICTED) / a.BB * 100 AS REALIZED_APE
  FROM pred_all p JOIN (SELECT * FROM panel WHERE BB <> 0) a ON a.PARTITION_COLUMN = p.PARTITION_COLUMN AND a.QUARTER = p.QUARTER
  WHERE p.BILLING IS NULL"""
register(
    "realized_actuals",
    lambda s, d: MO.realized(S.predictions_all(s, d), S.panel(s, d)).select(
        "PREDICTIONS_VERSION", *KEYS, "MODEL_USED", "BILLING_PREDICTED", "BB_ACTUAL", "REALIZED_APE"
    ),
    f"SELECT PREDICTIONS_VERSION, {K}, MODEL_USED, BILLING_PREDICTED, BB_ACTUAL, REALIZED_APE FROM ({REALIZED_SQL})",
    {6: "REALIZED_APE"},
)

ESTIMATE_SQL = "SELECT PARTITION_COLUMN, HORIZON_MAPE AS estimated_mape FROM champ"
RATIO_SQL = f"""SELECT r.*, e.estimated_mape, CASE WHEN e.estimated_mape > 0 THEN realized_mape / e.estimated_mape END AS mape_ratio,
    coalesce(CASE WHEN e.estimated_mape > 0 THEN realized_mape / e.estimated_mape END > 2.0, false) AS is_alert
  FROM (SELECT PARTITION_COLUMN, MODEL_USED, PREDICTIONS_VERSION, avg(REALIZED_APE) AS realized_mape, count(*) AS n_quarters_scored,
          avg(PREDICTION_HORIZON) AS avg_prediction_horizon FROM ({REALIZED_SQL}) GROUP BY ALL) r
  LEFT JOIN ({ESTIMATE_SQL}) e USING (PARTITION_COLUMN)"""
register(
    "estimated_vs_realized",
    lambda s, d: MO.backtest_against_estimates(S.predictions_all(s, d), S.panel(s, d), S.champions(s, d)),
    RATIO_SQL,
    {6: "realized_mape estimated_mape mape_ratio avg_prediction_horizon"},
)


def _backfill(spark: SparkSession, d: str) -> DataFrame:
    rows = H.horizon_rows(S.clean(spark, d)).withColumn("BILLING", F.col("BB_RAW"))
    return H.backfill_from_q2(
        rows, keys=["QUARTER", "MARKET_SEGMENT", "BRAND"], order=["MOF_VERSION"]
    ).select(*KEYS, "k", "BILLING")


register(
    "backfill_from_q2",
    _backfill,
    """SELECT p.PARTITION_COLUMN, p.QUARTER, p.k,
         CASE WHEN p.k IN (3, 4) AND (p.BB_RAW IS NULL OR p.BB_RAW = 0) THEN q.b ELSE p.BB_RAW END AS BILLING
       FROM clean p LEFT JOIN (SELECT QUARTER, MARKET_SEGMENT, BRAND, min_by(BB_RAW, MOF_VERSION) AS b FROM clean WHERE k = 2 GROUP BY ALL) q
         USING (QUARTER, MARKET_SEGMENT, BRAND) WHERE p.k BETWEEN 1 AND 6""",
)

register(
    "origin_quarter_lookup",
    lambda s, d: J.origin_quarter_lookup(S.panel(s, d)),
    f"""SELECT MOF_VERSION, max(QUARTER) AS last_quarter, {qlabel('max(qi) - 6')} AS origin_quarter FROM panel GROUP BY MOF_VERSION""",
)


def _failed(spark: SparkSession, d: str) -> DataFrame:
    return S.clean(spark, d).groupBy("PARTITION_COLUMN").agg(F.count_if(F.col("BB").isNull()).alias("n")).filter(F.col("n") > 0)


register(
    "dq_exclude_partitions",
    lambda s, d: C.dq_exclude(S.clean(s, d), _failed(s, d)).select(*KEYS, "BB"),
    f"""SELECT {K}, BB FROM clean WHERE PARTITION_COLUMN NOT IN (SELECT PARTITION_COLUMN FROM clean WHERE BB IS NULL)""",
)

register(
    "restrict_to_partitions",
    lambda s, d: C.restrict_to(S.panel(s, d), S.champions(s, d).filter(F.col("selection_score") < 40)).select(*KEYS, "BB"),
    f"SELECT {K}, BB FROM panel WHERE PARTITION_COLUMN IN (SELECT PARTITION_COLUMN FROM champ WHERE selection_score < 40)",
)


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel_all(spark, d)
    return J.coverage_missing(rows.filter(F.col("VERSION").isin("V_1", "V_2")), rows.filter(F.col("VERSION") == S.LATEST))


register(
    "coverage_missing",
    _coverage,
    """SELECT DISTINCT PARTITION_COLUMN FROM panel_all WHERE VERSION IN ('V_1', 'V_2')
       EXCEPT SELECT PARTITION_COLUMN FROM panel_all WHERE VERSION = 'V_3'""",
)


def _untrained(spark: SparkSession, d: str) -> DataFrame:
    """A fit fails where a series has too few observed quarters, or where its regressor never moves."""
    rows = S.split_panel(spark, d).filter(F.col("split") == "train")
    observed = F.count("BB_RAW")
    results = rows.groupBy("PARTITION_COLUMN").agg(
        F.when(observed < 15, F.format_string("Insufficient training data: %d rows", observed))
        .when(F.min("BB_RAW") * 40 < F.max("BB_RAW"), "target spread too wide").alias("error")
    )
    return J.untrained_partitions(S.panel(spark, d), results)


register(
    "untrained_partitions",
    _untrained,
    """SELECT PARTITION_COLUMN, CASE WHEN n < 15 THEN 'insufficient_data' ELSE 'failure' END AS reason FROM (
         SELECT PARTITION_COLUMN, count(BB_RAW) AS n, min(BB_RAW) AS lo, max(BB_RAW) AS hi FROM split_panel WHERE split = 'train' GROUP BY ALL)
       WHERE n < 15 OR lo * 40 < hi""",
)

register(
    "missing_champions",
    lambda s, d: J.missing_champions(S.panel_all(s, d).filter(F.col("VERSION").isin("V_2", "V_3")), S.champions(s, d)),
    """SELECT DISTINCT PARTITION_COLUMN FROM panel_all WHERE VERSION IN ('V_2', 'V_3') AND PARTITION_COLUMN NOT IN (SELECT PARTITION_COLUMN FROM champ)""",
)


def _mismatch(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel_all(spark, d)
    return J.key_mismatch_report(rows.filter(F.col("VERSION") == "V_2"), rows.filter(F.col("VERSION") == "V_3"))


register(
    "key_mismatch_report",
    _mismatch,
    """SELECT coalesce(a.p, b.p) AS PARTITION_COLUMN, CASE WHEN b.p IS NULL THEN 'only_in_models' ELSE 'only_in_data' END AS side
       FROM (SELECT DISTINCT PARTITION_COLUMN AS p FROM panel_all WHERE VERSION = 'V_2') a
       FULL JOIN (SELECT DISTINCT PARTITION_COLUMN AS p FROM panel_all WHERE VERSION = 'V_3') b ON a.p = b.p
       WHERE a.p IS NULL OR b.p IS NULL""",
)

register(
    "window_quarters_join",
    lambda s, d: X.window_quarters_join(S.panel(s, d).select(*KEYS, "BB"), X.backtest_windows(S.panel(s, d), 3)),
    """SELECT p.PARTITION_COLUMN, p.QUARTER, p.BB, w.BACKTEST_WINDOW, w.WINDOW_START_QUARTER, w.WINDOW_END_QUARTER
       FROM panel p JOIN bt_windows w ON p.QUARTER BETWEEN w.WINDOW_START_QUARTER AND w.WINDOW_END_QUARTER""",
)
