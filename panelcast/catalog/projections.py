"""Queries for projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.registry import register
from panelcast.catalog.scans import QUERY_CONFIG
from panelcast.config import DEMAND_SIGNALS, REGRESSOR_COLUMNS
from panelcast.functions.metrics import clip_negative, zero_to_null
from panelcast.operators import clean as C
from panelcast.operators import horizon as H
from panelcast.operators import params as P
from panelcast.sources import tables

KEYS = ["PARTITION_COLUMN", "QUARTER"]
K = "PARTITION_COLUMN, QUARTER"
MA2 = "BILLING_MOVING_AVERAGE_2Q"

register(
    "partition_key",
    lambda s, d: tables.read_table(s, d, "customer").select(
        "c_custkey",
        F.concat_ws("_", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.col("c_nationkey").cast("string")).alias("PARTITION_COLUMN"),
    ),
    """SELECT c_custkey, concat_ws('_', CASE WHEN c_acctbal > 0 THEN c_mktsegment END, CAST(c_nationkey AS VARCHAR)) AS PARTITION_COLUMN
       FROM customer""",
)


def _scenario(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the panel have no ``_QUARTER_`` part, so they are rebuilt from the origin label."""
    rows = S.panel(spark, d).select(*KEYS, "MOF_VERSION", "SCENARIO")
    return tables.derive_scenario(rows)


register("derive_scenario", _scenario, f"SELECT {K}, MOF_VERSION, 'MOF_' || MOF_VERSION AS SCENARIO FROM panel")


def _segment_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = F.col("MARKET_SEGMENT") == "BUILDING"
    return S.panel(spark, d).agg(
        F.countDistinct("PARTITION_COLUMN").alias("partitions_before"),
        F.countDistinct(F.when(kept, F.col("PARTITION_COLUMN"))).alias("partitions_after"),
        F.count_if(kept).alias("rows_after"),
    )


register(
    "segment_filter",
    _segment_filter,
    """SELECT count(DISTINCT PARTITION_COLUMN) AS partitions_before,
         count(DISTINCT PARTITION_COLUMN) FILTER (WHERE MARKET_SEGMENT = 'BUILDING') AS partitions_after,
         count(*) FILTER (WHERE MARKET_SEGMENT = 'BUILDING') AS rows_after FROM panel""",
)

register(
    "zero_to_null",
    lambda s, d: S.panel(s, d).select(*KEYS, zero_to_null("BB").alias("BB")),
    f"SELECT {K}, nullif(BB, 0) AS BB FROM panel",
)

_ADJUSTED = ", ".join(
    f"CASE WHEN {r} < 0.1::DOUBLE * {MA2} AND NOT (MARKET_SEGMENT = 'BUILDING' AND {r} = 0) THEN {MA2} ELSE {r} END AS {r}" for r in REGRESSOR_COLUMNS
)


def _adjusted(df: DataFrame) -> DataFrame:
    return C.adjust_regressors(df, nonzero_only=QUERY_CONFIG["NONZERO_ONLY_SEGMENT"])


register(
    "adjust_regressors",
    lambda s, d: _adjusted(S.panel(s, d)).select(*KEYS, *REGRESSOR_COLUMNS),
    f"SELECT {K}, {_ADJUSTED} FROM panel",
)

register(
    "ensure_signals",
    lambda s, d: C.ensure_signals(S.panel(s, d).select(*KEYS, "MOF_0_MONTH", "SR_0_MONTH")),
    f"SELECT {K}, MOF_0_MONTH, SR_0_MONTH, 0.0::DOUBLE AS MOF_PLUS_BUFFER_0_MONTH, 0.0::DOUBLE AS SELLIN_0_MONTH FROM panel",
)

register(
    "standard_renames",
    lambda s, d: C.standard_renames(
        S.panel(s, d).select(*KEYS, "BB", "MOF_0_MONTH", "SELLIN_0_MONTH", F.col("BB_VERSION").alias("BB_VERSION_x"))
    ),
    f"SELECT {K}, BB AS BILLING, MOF_0_MONTH AS MOF, SELLIN_0_MONTH AS SELLIN, BB_VERSION FROM panel",
)

register(
    "prepare_for_scoring",
    lambda s, d: C.prepare_for_scoring(S.clean(s, d).drop("BB_RAW"), nonzero_only=QUERY_CONFIG["NONZERO_ONLY_SEGMENT"]).select(
        *KEYS, "BILLING", "MOF", "MOF_PLUS_BUFFER", "SELLIN", "SR", *REGRESSOR_COLUMNS
    ),
    f"""SELECT {K}, BB AS BILLING, MOF_0_MONTH AS MOF, MOF_PLUS_BUFFER_0_MONTH AS MOF_PLUS_BUFFER, SELLIN_0_MONTH AS SELLIN,
          SR_0_MONTH AS SR, {_ADJUSTED} FROM clean""",
)

register(
    "zero_regressor_fill",
    lambda s, d: C.zero_regressor_fill(S.split_panel(s, d).filter(F.col("split") == "train"), ["SELLIN_MINUS3_MONTH", "SR_MINUS3_MONTH"]).select(
        *KEYS, "SELLIN_MINUS3_MONTH", "SR_MINUS3_MONTH"
    ),
    f"""SELECT {K}, CASE WHEN SELLIN_MINUS3_MONTH = 0 THEN {MA2} ELSE SELLIN_MINUS3_MONTH END AS SELLIN_MINUS3_MONTH,
          CASE WHEN SR_MINUS3_MONTH = 0 THEN {MA2} ELSE SR_MINUS3_MONTH END AS SR_MINUS3_MONTH
        FROM split_panel WHERE split = 'train'""",
)


def _excluded(spark: SparkSession, d: str) -> DataFrame:
    segments = tables.read_table(spark, d, "customer").select(F.col("c_mktsegment").alias("MARKET_SEGMENT")).distinct()
    regressors = spark.createDataFrame([(r,) for r in REGRESSOR_COLUMNS], "regressor string")
    return C.segment_regressors(segments, regressors, P.excluded_regressors(spark, QUERY_CONFIG["EXCLUDE_SELLIN_PROPHET"]))


_REGRESSOR_VALUES = ", ".join(f"('{r}')" for r in REGRESSOR_COLUMNS)
register(
    "exclude_regressor_by_segment",
    _excluded,
    f"""SELECT MARKET_SEGMENT, regressor FROM (SELECT DISTINCT c_mktsegment AS MARKET_SEGMENT FROM customer)
        CROSS JOIN (VALUES {_REGRESSOR_VALUES}) r(regressor)
        WHERE NOT (MARKET_SEGMENT IN ('FURNITURE', 'HOUSEHOLD') AND regressor = 'SELLIN_MINUS3_MONTH')""",
)

register(
    "clip_negative",
    lambda s, d: tables.read_table(s, d, "customer").select("c_custkey", clip_negative("c_acctbal").alias("clipped")),
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS clipped FROM customer",
)

register(
    "cap_floor",
    lambda s, d: C.cap_floor(S.split_panel(s, d).filter(F.col("split") == "train"), ["PARTITION_COLUMN"]).select(*KEYS, "cap", "floor"),
    f"SELECT {K}, max(BB) OVER (PARTITION BY PARTITION_COLUMN) * 10 AS cap, 0.0::DOUBLE AS floor FROM split_panel WHERE split = 'train'",
)


def _output_format(spark: SparkSession, d: str) -> DataFrame:
    wanted = ["PARTITION_COLUMN", "QUARTER", "BILLING", "BILLING_PREDICTED", "NO_SUCH_COLUMN", "MODEL_USED"]
    return C.output_format(S.forecasts(spark, d), wanted)


register(
    "output_format",
    _output_format,
    """SELECT PARTITION_COLUMN AS PARTITION_COLUMN_OUTPUT, QUARTER AS QUARTER_OUTPUT, BILLING AS BILLING_OUTPUT,
         BILLING_PREDICTED AS BILLING_PREDICTED_OUTPUT, MODEL_USED AS MODEL_USED_OUTPUT FROM fc""",
)


def _complete_row(spark: SparkSession, d: str) -> DataFrame:
    rows = S.forecasts(spark, d).withColumn("APE", H.ape("BILLING", "BILLING_PREDICTED"))
    return C.complete_row_ape(rows.select(*KEYS, "MODEL_USED", "BILLING", "SELLIN", "SELLIN_MINUS3_MONTH", "APE"))


register(
    "complete_row_ape",
    _complete_row,
    f"""SELECT {K}, MODEL_USED, BILLING, SELLIN, SELLIN_MINUS3_MONTH,
          CASE WHEN BILLING IS NOT NULL AND SELLIN IS NOT NULL AND SELLIN_MINUS3_MONTH IS NOT NULL THEN ape END AS APE FROM fc""",
    {6: "APE"},
)

register(
    "valid_actuals",
    lambda s, d: C.valid_actuals(S.panel(s, d)).select(*KEYS, "BB"),
    f"SELECT {K}, BB FROM panel WHERE BB IS NOT NULL AND BB <> 0",
)

register(
    "valid_metrics",
    lambda s, d: C.valid_metrics(S.window_metrics(s, d)).select("PARTITION_COLUMN", "MODEL_USED", "BACKTEST_WINDOW", "MAPE"),
    "SELECT PARTITION_COLUMN, MODEL_USED, BACKTEST_WINDOW, MAPE FROM win_metrics WHERE MAPE IS NOT NULL AND MAPE > 0",
    {6: "MAPE"},
)

register(
    "unscored_predictions",
    lambda s, d: C.unscored_predictions(S.predictions_all(s, d)).select("PREDICTIONS_VERSION", *KEYS, "MODEL_USED", "BILLING_PREDICTED"),
    f"SELECT PREDICTIONS_VERSION, {K}, MODEL_USED, BILLING_PREDICTED FROM pred_all WHERE BILLING IS NULL OR BILLING = 0",
)


def _null_ape(spark: SparkSession, d: str) -> DataFrame:
    rows = H.add_indicators(S.forecasts(spark, d).withColumn("APE", H.ape("BILLING", "BILLING_PREDICTED")))
    plain = C.null_ape_missing_indicator(rows)
    strict = C.null_ape_missing_indicator(plain.withColumn("APE_STRICT", F.col("APE")), "APE_STRICT", [f"INDICATOR_{c}_REFERENCED" for c in DEMAND_SIGNALS])
    return strict.select(*KEYS, "MODEL_USED", "APE", "APE_STRICT")


register(
    "null_ape_missing_indicator",
    _null_ape,
    f"""SELECT {K}, MODEL_USED, ape AS APE, CASE WHEN {' AND '.join(f'INDICATOR_{c}_REFERENCED IS NOT NULL' for c in DEMAND_SIGNALS)} THEN ape END AS APE_STRICT FROM fc_ind""",
    {6: "APE APE_STRICT"},
)

register(
    "remove_unwanted_rows",
    lambda s, d: C.remove_unwanted_rows(S.panel(s, d)).select(*KEYS, "BB"),
    f"SELECT {K}, BB FROM panel WHERE k NOT IN (0, 5, 6)",
)

register(
    "quality_gate_flags",
    lambda s, d: H.quality_gate_flags(S.champions(s, d), low=12.0, high=60.0).select(
        "PARTITION_COLUMN", "MODEL_USED", "selection_score", "gate_reason"
    ),
    """SELECT PARTITION_COLUMN, MODEL_USED, selection_score,
         CASE WHEN selection_score > 60 THEN 'above_max' ELSE 'below_min' END AS gate_reason
       FROM champ WHERE selection_score > 60 OR selection_score < 12""",
    {6: "selection_score"},
)
