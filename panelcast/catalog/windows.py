"""Queries for window functions, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.aggregations import AUTOCORR_SQL, monitor_records, segment_summary
from panelcast.catalog.joins import REALIZED_SQL, REGRESSORS
from panelcast.catalog.oracle import cents, direction, distance, indicator, qlabel
from panelcast.catalog.projections import KEYS, K
from panelcast.catalog.registry import register
from panelcast.config import DEMAND_SIGNALS, MOVING_AVERAGE_WINDOWS
from panelcast.functions.quarters import origin_quarter
from panelcast.operators import clean as C
from panelcast.operators import diagnose as D
from panelcast.operators import horizon as H
from panelcast.operators import models as M
from panelcast.operators import monitor as MO
from panelcast.operators import windows as X

P = "PARTITION_COLUMN"
W = "PARTITION BY PARTITION_COLUMN ORDER BY qi"

register(
    "ffill_target",
    lambda s, d: S.clean_all(s, d).select("VERSION", *KEYS, "BB", "BB_RAW", "is_actual"),
    f"SELECT VERSION, {K}, BB, BB_RAW, is_actual FROM clean_all",
)


def _gappy(spark: SparkSession, d: str) -> DataFrame:
    """Regressors with a gap in every third quarter."""
    hole = F.pmod(F.year("QUARTER_PARSED") + F.quarter("QUARTER_PARSED"), F.lit(3)) == 0
    return S.panel(spark, d).withColumns({r: F.when(~hole, F.col(r)) for r in REGRESSORS})


_FILLS = ", ".join(
    f"""coalesce(last_value({r} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value({r} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {r}"""
    for r in REGRESSORS
)
_HOLES = ", ".join(f"CASE WHEN (qi // 4 + qi % 4 + 1) % 3 <> 0 THEN {r} END AS {r}" for r in REGRESSORS)
register(
    "fill_cascade",
    lambda s, d: C.fill_cascade(_gappy(s, d), REGRESSORS, [P]).select(*KEYS, *REGRESSORS),
    f"SELECT {K}, {_FILLS} FROM (SELECT PARTITION_COLUMN, QUARTER, qi, {_HOLES} FROM panel)",
)

_MA = ", ".join(
    f"CAST(sum({cents('BB')}) OVER ({W} ROWS {n - 1} PRECEDING) AS DOUBLE) / nullif(count(BB) OVER ({W} ROWS {n - 1} PRECEDING) * 100.0::DOUBLE, 0) AS MA_{n}Q"
    for n in MOVING_AVERAGE_WINDOWS
)
register(
    "moving_average",
    lambda s, d: C.moving_average(S.clean(s, d), [P], money=True).select(*KEYS, *[f"MA_{n}Q" for n in MOVING_AVERAGE_WINDOWS]),
    f"SELECT {K}, {_MA} FROM clean",
)

# fixed values: the hidden quarters solved one after the other, then plain rolling means over the longer series
_IMPUTE = """WITH first_ AS (SELECT PARTITION_COLUMN, BB AS b0, BILLING_MOVING_AVERAGE_2Q AS m2, BILLING_MOVING_AVERAGE_3Q AS m3,
      BILLING_MOVING_AVERAGE_4Q AS m4, BILLING_MOVING_AVERAGE_5Q AS m5, qi AS q0 FROM clean
      QUALIFY row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY qi) = 1),
    h1 AS (SELECT *, 2 * m2 - b0 AS b1 FROM first_ WHERE b0 IS NOT NULL AND m2 IS NOT NULL AND m3 IS NOT NULL AND m4 IS NOT NULL AND m5 IS NOT NULL),
    h2 AS (SELECT *, 3 * m3 - b1 - b0 AS b2 FROM h1), h3 AS (SELECT *, 4 * m4 - b2 - b1 - b0 AS b3 FROM h2),
    h4 AS (SELECT *, 5 * m5 - b3 - b2 - b1 - b0 AS b4 FROM h3),
    longer AS (SELECT PARTITION_COLUMN, qi, QUARTER, BB, true AS shown FROM clean
      UNION ALL SELECT PARTITION_COLUMN, q0 - 1, NULL, b1, false FROM h4 UNION ALL SELECT PARTITION_COLUMN, q0 - 2, NULL, b2, false FROM h4
      UNION ALL SELECT PARTITION_COLUMN, q0 - 3, NULL, b3, false FROM h4 UNION ALL SELECT PARTITION_COLUMN, q0 - 4, NULL, b4, false FROM h4),
    rolled AS (SELECT *, {avgs} FROM longer)
  SELECT c.PARTITION_COLUMN, c.QUARTER, {picks} FROM clean c JOIN rolled r ON r.PARTITION_COLUMN = c.PARTITION_COLUMN AND r.qi = c.qi AND r.shown
  LEFT JOIN h4 ON h4.PARTITION_COLUMN = c.PARTITION_COLUMN""".format(
    avgs=", ".join(f"avg(BB) OVER ({W} ROWS {n - 1} PRECEDING) AS a{n}" for n in MOVING_AVERAGE_WINDOWS),
    picks=", ".join(
        f"CASE WHEN h4.b4 IS NOT NULL THEN r.a{n} ELSE c.BILLING_MOVING_AVERAGE_{n}Q END AS BILLING_MOVING_AVERAGE_{n}Q" for n in MOVING_AVERAGE_WINDOWS
    ),
)
register(
    "impute_history_ma",
    lambda s, d: C.impute_history_ma(S.clean(s, d), [P]).select(*KEYS, *[f"BILLING_MOVING_AVERAGE_{n}Q" for n in MOVING_AVERAGE_WINDOWS]),
    _IMPUTE,
    {5: " ".join(f"BILLING_MOVING_AVERAGE_{n}Q" for n in MOVING_AVERAGE_WINDOWS)},
)

register(
    "autocorrelation",
    lambda s, d: D.autocorrelation_summary(D.autocorrelation(S.clean(s, d))),
    AUTOCORR_SQL,
    {6: "avg_autocorrelation pct_positive"},
)

register(
    "split_train_val_test",
    lambda s, d: S.split_panel(s, d).select(*KEYS, "split"),
    f"SELECT {K}, split FROM split_panel",
)


register(
    "min_rows_guard",
    lambda s, d: X.min_rows_guard(S.panel_all(s, d), ["VERSION", P]),
    """SELECT *, val_h + pred_h + 1 AS min_rows, CASE WHEN n_rows < val_h + pred_h + 1 THEN 'Insufficient training data: ' || n_rows || ' rows, need at least '
         || (val_h + pred_h + 1) || ' (val=' || val_h || ', pred=' || pred_h || ')' END AS error
       FROM (SELECT VERSION, PARTITION_COLUMN, count(*) AS n_rows, 2 AS val_h, 6 AS pred_h FROM panel_all GROUP BY ALL)""",
)


def _pseudo(spark: SparkSession, d: str) -> DataFrame:
    """Series whose validation quarters have no target yet."""
    rows = S.split_panel(spark, d)
    return rows.withColumn("BB", F.when((F.col("split") != "val") | (F.col("BRAND").cast("int") % 2 == 0), F.col("BB_RAW")))


register(
    "pseudo_validation",
    lambda s, d: X.pseudo_validation(_pseudo(s, d), [P]).select(*KEYS, "split"),
    f"""WITH raw_ AS (SELECT * REPLACE (CASE WHEN split <> 'val' OR CAST(BRAND AS INTEGER) % 2 = 0 THEN BB_RAW END AS BB) FROM split_panel),
          usable AS (SELECT *, count(*) FILTER (WHERE split = 'val') OVER (PARTITION BY PARTITION_COLUMN) AS n_val,
              count(*) FILTER (WHERE split = 'train') OVER (PARTITION BY PARTITION_COLUMN) AS n_train,
              max(qi) FILTER (WHERE split = 'train') OVER (PARTITION BY PARTITION_COLUMN) AS last_train
            FROM raw_ WHERE split = 'test' OR BB IS NOT NULL)
        SELECT {K}, CASE WHEN n_val = 0 AND n_train > 1 AND split = 'train' AND qi = last_train THEN 'val' ELSE split END AS split FROM usable""",
)

register(
    "dedupe_first",
    lambda s, d: C.dedupe_first(
        S.panel_all(s, d).select("MARKET_SEGMENT", "BRAND", "QUARTER", "VERSION", "SCENARIO", "BB"),
        ["MARKET_SEGMENT", "BRAND", "QUARTER"], ["VERSION", "SCENARIO"],
    ),
    """SELECT MARKET_SEGMENT, BRAND, QUARTER, VERSION, SCENARIO, BB FROM panel_all
       QUALIFY row_number() OVER (PARTITION BY MARKET_SEGMENT, BRAND, QUARTER ORDER BY VERSION, SCENARIO) = 1""",
)

register(
    "latest_champion",
    lambda s, d: H.latest_per_key(S.model_results(s, d).filter("is_champion"), [P], ["LOAD_TS", "MODEL_USED"]).select(P, "MODEL_USED", "run_id", "mape"),
    """SELECT PARTITION_COLUMN, MODEL_USED, run_id, mape FROM results_all WHERE is_champion
       QUALIFY row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY LOAD_TS DESC, MODEL_USED DESC) = 1""",
    {6: "mape"},
)

register(
    "select_champion",
    lambda s, d: S.champions(s, d).select("MARKET_SEGMENT", P, "MODEL_USED", "selection_score", "HORIZON_MAPE", "MAPE"),
    "SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, selection_score, HORIZON_MAPE, MAPE FROM champ",
    {6: "selection_score HORIZON_MAPE MAPE"},
)

register(
    "backtest_windows",
    lambda s, d: X.backtest_windows(S.panel(s, d), 20, stride=2),
    """SELECT BACKTEST_WINDOW, qs[len(qs) - BACKTEST_WINDOW * 2 - 5] AS WINDOW_START_QUARTER, qs[len(qs) - BACKTEST_WINDOW * 2] AS WINDOW_END_QUARTER
       FROM (SELECT list_sort(list(QUARTER)) AS qs FROM quarters) CROSS JOIN (SELECT CAST(range AS INTEGER) AS BACKTEST_WINDOW FROM range(0, 20))
       WHERE len(qs) - BACKTEST_WINDOW * 2 - 6 >= 6""",
)

_FLAGS = ", ".join(f'k = {h} AS "Q+{h}_INDICATOR"' for h in range(1, 7))
register(
    "quarter_indicators",
    lambda s, d: X.quarter_indicators(X.infer_origin_quarter(S.panel(s, d).select(*KEYS, "MOF_VERSION"))),
    f"SELECT {K}, MOF_VERSION, {_FLAGS} FROM panel WHERE k <> 0",
)


def _masked(spark: SparkSession, d: str) -> DataFrame:
    """Origin labels hidden behind a code, as in anonymised snapshots, for half of the scenarios."""
    code = F.concat(F.lit("VER_"), F.upper(F.substring(F.md5("MOF_VERSION"), 1, 4).cast("string")))
    code = F.translate(code, "0123456789", "GHIJKLMNOP")
    return S.panel(spark, d).withColumn("MOF_VERSION", F.when(F.col("MOF_VERSION") < "1999Q4M1", code).otherwise(F.col("MOF_VERSION")))


register(
    "infer_origin_quarter",
    lambda s, d: X.infer_origin_quarter(_masked(s, d)).select(*KEYS, "ORIGIN_QUARTER"),
    f"SELECT {K}, {qlabel('origin')} AS ORIGIN_QUARTER FROM panel",
)


def _prefix(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel(spark, d).select(*KEYS, "QUARTER_PARSED", "MOF_VERSION", "BB")
    flagged = rows.withColumns(
        {
            "Q+1_INDICATOR": F.col("QUARTER") == origin_quarter("MOF_VERSION"),
            "Q+2_INDICATOR": F.when(F.col("QUARTER") == "1999Q2", " Q+2 ").otherwise("no"),
            "Q+3_INDICATOR": F.lit(False),
        }
    )
    names = {f"Q+{i}": f"Q+{i}_INDICATOR" for i in (1, 2, 3)}
    exclusive = X.prefix_until_indicator(flagged, names)
    inclusive = X.prefix_until_indicator(flagged, {"Q+1": "Q+1_INDICATOR"}, include_cut_row=True)
    return exclusive.withColumn("cut", F.lit("exclusive")).unionByName(inclusive.withColumn("cut", F.lit("inclusive"))).select(
        *KEYS, "PARTITION_HORIZON", "cut"
    )


register(
    "prefix_until_indicator",
    _prefix,
    f"""SELECT {K}, PARTITION_COLUMN || '_Q+1' AS PARTITION_HORIZON, 'exclusive' AS cut FROM panel WHERE k < 0
        UNION ALL SELECT {K}, PARTITION_COLUMN || '_Q+2', 'exclusive' FROM panel WHERE QUARTER < '1999Q2'
        UNION ALL SELECT {K}, PARTITION_COLUMN || '_Q+3', 'exclusive' FROM panel
        UNION ALL SELECT {K}, PARTITION_COLUMN || '_Q+1', 'inclusive' FROM panel WHERE k <= 0""",
)

register(
    "seasonal_naive",
    lambda s, d: M.seasonal_naive(S.split_panel(s, d), [P]).select(*KEYS, "split", "BILLING_PREDICTED"),
    """WITH t AS (SELECT *, max(qi) FILTER (WHERE split = 'train') OVER (PARTITION BY PARTITION_COLUMN) AS lt FROM split_panel)
       SELECT a.PARTITION_COLUMN, a.QUARTER, a.split, CASE WHEN b.BB < 0 THEN 0.0 ELSE b.BB END AS BILLING_PREDICTED
       FROM t a LEFT JOIN t b ON b.PARTITION_COLUMN = a.PARTITION_COLUMN AND b.qi = a.lt - 3 + (a.qi - a.lt - 1) % 4 WHERE a.split <> 'train'""",
)

_MASKED_COLUMNS = H.indicator_columns()
# fixed values: training rows lie before the median distance, test rows at or after the origin + 1
_MASK_BASE = """SELECT f.*, 1 - f.k AS vh, h.v FROM fc f JOIN (SELECT PARTITION_COLUMN, trunc(median(CAST(1 - k AS DOUBLE))) AS v FROM panel GROUP BY PARTITION_COLUMN) h
  USING (PARTITION_COLUMN)"""
_MASKED = ", ".join(
    f"CASE WHEN vh <= v THEN {s} END AS m_{s}, CASE WHEN vh <= v AND vh > 0 THEN {indicator('BILLING', s)} END AS INDICATOR_{s}_REFERENCED,"
    f" CASE WHEN vh <= v THEN {indicator('BILLING_PREDICTED', s)} END AS INDICATOR_FORECASTED_{s}_REFERENCED"
    for s in DEMAND_SIGNALS
)
_MASKED_MARKS = ", ".join(
    f"{distance(f'INDICATOR_{s}_REFERENCED', f'INDICATOR_FORECASTED_{s}_REFERENCED')} AS VALIDATION_DISTANCE_{s}_REFERENCED, "
    f"{direction(f'INDICATOR_{s}_REFERENCED', f'INDICATOR_FORECASTED_{s}_REFERENCED')} AS DIRECTIONAL_CORRECTNESS_{s}_REFERENCED"
    for s in DEMAND_SIGNALS
)


def _mask(spark: SparkSession, d: str) -> DataFrame:
    from panelcast.sources.panel import countdown_horizon

    rows = countdown_horizon(S.forecasts(spark, d))
    return H.add_indicators(rows, keys=[P, "MODEL_USED"]).select(*KEYS, "MODEL_USED", *DEMAND_SIGNALS, *_MASKED_COLUMNS)


_MASK_OUT = ", ".join([f"m_{s} AS {s}" for s in DEMAND_SIGNALS] + _MASKED_COLUMNS)
register(
    "mask_by_horizon",
    _mask,
    f"SELECT {K}, MODEL_USED, {_MASK_OUT} FROM (SELECT *, {_MASKED_MARKS} FROM (SELECT *, {_MASKED} FROM ({_MASK_BASE})))",
)

# --- top-k -------------------------------------------------------------------------------------------

register(
    "topk_versions",
    lambda s, d: MO.topk_versions(S.predictions_all(s, d), 2).select("PREDICTIONS_VERSION"),
    "SELECT PREDICTIONS_VERSION FROM pred_all GROUP BY PREDICTIONS_VERSION ORDER BY max(LOAD_TS) DESC LIMIT 2",
)

register(
    "topk_params",
    lambda s, d: M.topk_params(_ranked_windows(s, d), 2).select(P, "MODEL_USED", "rank", "val_ape"),
    """SELECT PARTITION_COLUMN, MODEL_USED, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY round(HORIZON_MAPE, 9) NULLS LAST, MODEL_USED) AS rank, HORIZON_MAPE AS val_ape
       FROM bt_scores QUALIFY rank <= 2""",
    {6: "val_ape"},
)


def _ranked_windows(spark: SparkSession, d: str) -> DataFrame:
    """The tried settings here are the model families, ranked by their mean error."""
    from pyspark.sql import Window

    order = Window.partitionBy(P).orderBy(F.round("val_ape", 9).asc_nulls_last(), "MODEL_USED")
    return S.backtest_scores(spark, d).withColumnRenamed("HORIZON_MAPE", "val_ape").withColumn("rank", F.row_number().over(order))


register(
    "sample_per_segment",
    lambda s, d: X.sample_first(
        S.forecasts(s, d).select("MARKET_SEGMENT", *KEYS, "MODEL_USED", "BILLING"), ["MARKET_SEGMENT"], [P, "QUARTER", "MODEL_USED"], 100
    ),
    f"""SELECT MARKET_SEGMENT, {K}, MODEL_USED, BILLING FROM fc
        QUALIFY row_number() OVER (PARTITION BY MARKET_SEGMENT ORDER BY PARTITION_COLUMN, QUARTER, MODEL_USED) <= 100""",
)

register(
    "sample_series_rows",
    lambda s, d: X.sample_series_rows(S.panel(s, d).select(*KEYS, "BB"), [P], [P, "QUARTER"], 5),
    f"""SELECT {K}, BB FROM panel
        QUALIFY row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY md5(PARTITION_COLUMN || '|' || QUARTER || '|42'), PARTITION_COLUMN, QUARTER) <= 5""",
)


def _ranked_display(spark: SparkSession, d: str) -> DataFrame:
    table = segment_summary(S.model_results(spark, d).filter(F.col("VERSION") == S.LATEST))
    return table.select("MARKET_SEGMENT", "MODEL_USED", F.round("avg_mape", 2).alias("avg_mape"), "partition_count").orderBy("MARKET_SEGMENT", "MODEL_USED")


register(
    "ranked_display",
    _ranked_display,
    """SELECT MARKET_SEGMENT, MODEL_USED, round(avg(mape), 2) AS avg_mape, count(*) AS partition_count FROM results_all
       WHERE VERSION = 'V_3' AND error IS NULL GROUP BY ALL ORDER BY 1, 2""",
)

# --- set operations ----------------------------------------------------------------------------------


def _union(spark: SparkSession, d: str) -> DataFrame:
    rows = S.forecasts(spark, d).select(*KEYS, "MODEL_USED", "BILLING_PREDICTED")
    flat, season, line, fitted = (rows.filter(F.col("MODEL_USED") == m) for m in ("MEAN4", "SEASONAL_NAIVE", "TREND", "RIDGE"))
    return flat.select("BILLING_PREDICTED", "MODEL_USED", *KEYS).unionByName(season).unionByName(line).unionByName(fitted).select(*rows.columns)


register("union_predictions", _union, f"SELECT {K}, MODEL_USED, BILLING_PREDICTED FROM fc")

register(
    "distinct_partitions",
    lambda s, d: S.panel_all(s, d).groupBy("VERSION").agg(F.countDistinct(P).alias("partitions"), F.countDistinct("MARKET_SEGMENT").alias("segments")),
    "SELECT VERSION, count(DISTINCT PARTITION_COLUMN) AS partitions, count(DISTINCT MARKET_SEGMENT) AS segments FROM panel_all GROUP BY VERSION",
)


def _set_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel_all(spark, d)
    a, b = rows.filter(F.col("VERSION") == "V_1").select(P), rows.filter(F.col("VERSION") == "V_3").select(P)
    return a.subtract(b).withColumn("side", F.lit("only_old")).unionByName(b.subtract(a).withColumn("side", F.lit("only_new")))


register(
    "partition_set_diff",
    _set_diff,
    """WITH a AS (SELECT DISTINCT PARTITION_COLUMN FROM panel_all WHERE VERSION = 'V_1'), b AS (SELECT DISTINCT PARTITION_COLUMN FROM panel_all WHERE VERSION = 'V_3')
       SELECT *, 'only_old' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'only_new' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)

register(
    "all_versions_scored",
    lambda s, d: MO.all_versions_scored(S.predictions_all(s, d).select("PREDICTIONS_VERSION").distinct(), monitor_records(s, d), S.LATEST),
    f"""SELECT count(*) = 0 AS all_scored, count(*) AS versions_to_score FROM (SELECT DISTINCT PREDICTIONS_VERSION FROM pred_all
          EXCEPT SELECT PREDICTIONS_VERSION FROM ({REALIZED_SQL}))""",
)

register(
    "known_partitions",
    lambda s, d: MO.known_partitions(MO.realized(S.predictions_all(s, d), S.panel(s, d)), S.champions_all(s, d)),
    f"SELECT PARTITION_COLUMN FROM ({REALIZED_SQL}) UNION SELECT PARTITION_COLUMN FROM champ_all",
)

