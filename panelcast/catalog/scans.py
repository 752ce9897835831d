"""Queries for sources, snapshots and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.catalog import stages as S
from panelcast.catalog.registry import register
from panelcast.config import SELECT_COLUMNS, load_config
from panelcast.operators import horizon as H
from panelcast.operators import params as P
from panelcast.plans.flagship import champion_by_partition
from panelcast.session import scratch_dir
from panelcast.sources import sinks, tables

KEYS = ["PARTITION_COLUMN", "QUARTER"]

# fixed value: settings the queries use for segments that occur in the given tables
QUERY_CONFIG = load_config(
    overrides={
        "segments": {
            "BUILDING": {"PREFERRED_MODEL": "XGBOOST", "models": ["prophet", "xgboost"], "grid_search": {"xgboost": True}},
            "MACHINERY": {"models": ["seasonalnaive"]},
        },
        "FEATURE_SELECTION": {"EXTENDED_SEGMENTS": ["FURNITURE", "MACHINERY"]},
        "EXCLUDE_SELLIN_PROPHET": ["FURNITURE", "HOUSEHOLD"],
        "NONZERO_ONLY_SEGMENT": "BUILDING",
    }
)
VERSION_NUMBER = r"TRY_CAST(regexp_extract(VERSION, 'V_(\d+)', 1) AS BIGINT)"


def customers_by_segment(spark: SparkSession, d: str) -> DataFrame:
    return (
        tables.read_table(spark, d, "customer")
        .groupBy(F.col("c_mktsegment").alias("MARKET_SEGMENT"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )


_FLAGSHIP = [f"Q{h}_MAPE" for h in H.HORIZONS]
register(
    "flagship_champion",
    champion_by_partition,
    f"""SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, HORIZON_MAPE, {', '.join(_FLAGSHIP)} FROM scores_all
        WHERE VERSION = 'V_3' AND HORIZON_MAPE > 0
        QUALIFY row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY round(HORIZON_MAPE, 9), MODEL_USED) = 1""",
    {6: "HORIZON_MAPE " + " ".join(_FLAGSHIP)},
)

_PANEL = [c for c in SELECT_COLUMNS if c != "QUARTER_PARSED"]
register(
    "horizon_panel",
    lambda s, d: S.build_panel_all(s, d).select("VERSION", "PARTITION_COLUMN", *_PANEL),
    f"SELECT VERSION, PARTITION_COLUMN, {', '.join(_PANEL)} FROM panel_all",
)

register(
    "scan_latest_version",
    lambda s, d: tables.scan_latest_version(S.panel_all(s, d)).select("VERSION", *KEYS, "BB", "MOF_0_MONTH", "SR_MINUS3_MONTH"),
    f"""SELECT VERSION, PARTITION_COLUMN, QUARTER, BB, MOF_0_MONTH, SR_MINUS3_MONTH FROM panel_all
        WHERE {VERSION_NUMBER} = (SELECT max({VERSION_NUMBER}) FROM panel_all)""",
)

register(
    "normalize_column_names",
    lambda s, d: tables.normalize_column_names(
        S.panel(s, d).select(*KEYS, F.col("SELLIN_MINUS3_MONTH").alias("SELLIN_-3_MONTH"), F.col("MOF_MINUS3_MONTH").alias("MOF_-3_MONTH"))
    ),
    "SELECT PARTITION_COLUMN, QUARTER, SELLIN_MINUS3_MONTH, MOF_MINUS3_MONTH FROM panel",
)

register(
    "project_existing",
    lambda s, d: tables.project_existing(S.panel(s, d), ["PARTITION_COLUMN", "QUARTER", "BB", "NO_SUCH_COLUMN", "SR_0_MONTH"]),
    "SELECT PARTITION_COLUMN, QUARTER, BB, SR_0_MONTH, SCENARIO FROM panel",
)


def _segment_params(spark: SparkSession, d: str) -> DataFrame:
    joined = P.segment_params(customers_by_segment(spark, d), P.params_table(spark, QUERY_CONFIG))
    return joined.select(
        "MARKET_SEGMENT", "n_customers", "preferred_model",
        F.array_join("models", ",").alias("models"),
        F.size("used_regressors").cast("bigint").alias("n_regressors"),
        F.coalesce(F.col("grid_search")["xgboost"], F.lit(False)).alias("grid_xgboost"),
    )


register(
    "segment_params",
    _segment_params,
    """SELECT c_mktsegment AS MARKET_SEGMENT, count(*) AS n_customers,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'XGBOOST' ELSE 'PROPHET' END AS preferred_model,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'prophet,xgboost' WHEN 'MACHINERY' THEN 'seasonalnaive'
           ELSE 'prophet,xgboost,lightgbm,catboost,seasonalnaive,nhits,rnn,autolstm' END AS models,
         CAST(7 AS BIGINT) AS n_regressors, c_mktsegment = 'BUILDING' AS grid_xgboost
       FROM customer GROUP BY c_mktsegment""",
)

register(
    "feature_count",
    lambda s, d: customers_by_segment(s, d).withColumn("n_features", P.feature_count("MARKET_SEGMENT", QUERY_CONFIG)),
    """SELECT c_mktsegment AS MARKET_SEGMENT, count(*) AS n_customers,
         CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 6 ELSE 5 END AS n_features
       FROM customer GROUP BY c_mktsegment""",
)

register(
    "next_version_label",
    lambda s, d: tables.next_version_label(S.panel_all(s, d), "VERSION"),
    f"SELECT 'V_' || CAST(coalesce(max({VERSION_NUMBER}), 0) + 1 AS VARCHAR) AS next_version FROM panel_all",
)


def _align(spark: SparkSession, d: str) -> DataFrame:
    batch = (
        S.panel(spark, d)
        .groupBy("PARTITION_COLUMN")
        .agg(F.count(F.lit(1)).cast("int").alias("n_rows"), F.max("QUARTER").alias("last_quarter"))
        .withColumn("note", F.lit(None))
    )
    target = T.StructType(
        [
            T.StructField("PARTITION_COLUMN", T.StringType()),
            T.StructField("n_rows", T.DoubleType()),
            T.StructField("retired", T.IntegerType()),
        ]
    )
    return sinks.align_to_schema(batch, target)


register(
    "align_to_schema",
    _align,
    """SELECT PARTITION_COLUMN, CAST(count(*) AS DOUBLE) AS n_rows, max(QUARTER) AS last_quarter, CAST(NULL AS VARCHAR) AS note,
         CAST(NULL AS INTEGER) AS retired FROM panel GROUP BY PARTITION_COLUMN""",
)


def _append(spark: SparkSession, d: str) -> DataFrame:
    rows = S.panel_all(spark, d).select("VERSION", *KEYS, "BB")
    older = rows.filter(F.col("VERSION").isin("V_1", "V_2"))
    return sinks.append_with_latest_flag(older, rows.filter(F.col("VERSION") == S.LATEST))


register(
    "append_with_latest_flag",
    _append,
    "SELECT VERSION, PARTITION_COLUMN, QUARTER, BB, VERSION = 'V_3' AS is_latest FROM panel_all WHERE VERSION IN ('V_1', 'V_2', 'V_3')",
)


def _stamp(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit(S.NOW).cast("timestamp_ntz")
    batch = S.panel(spark, d).select(*KEYS)
    stamped = sinks.stamp_batch(batch, now, DATA_TABLE=S.DATA_TABLE, DATA_VERSION=S.LATEST, MODEL_SOURCE="table")
    label = stamped.withColumnRenamed("PREDICTIONS_VERSION", "UTC_VERSION").drop("LOAD_TS")
    local = sinks.stamp_batch(label, now, zone="US/Central")
    return local.withColumnsRenamed({"PREDICTIONS_VERSION": "LOCAL_VERSION", "UTC_VERSION": "PREDICTIONS_VERSION"}).withColumn(
        "LOAD_TS", F.date_format("LOAD_TS", "yyyy-MM-dd HH:mm:ss")
    )


register(
    "stamp_batch_metadata",
    _stamp,
    """SELECT PARTITION_COLUMN, QUARTER, 'V_20010725_120000' AS PREDICTIONS_VERSION, '2001-07-25 12:00:00' AS LOAD_TS,
         'horizon_panel' AS DATA_TABLE, 'V_3' AS DATA_VERSION, 'table' AS MODEL_SOURCE, 'V_20010725_070000' AS LOCAL_VERSION
       FROM panel""",
)


def _flag_champions(spark: SparkSession, d: str) -> DataFrame:
    metrics = S.window_metrics(spark, d)
    best = H.select_champion(H.backtest_aggregate(metrics))
    return sinks.flag_champions(metrics, best, ["PARTITION_COLUMN", "MODEL_USED"]).select(
        "PARTITION_COLUMN", "MODEL_USED", "BACKTEST_WINDOW", "HORIZON_MAPE", "is_champion"
    )


register(
    "flag_champions",
    _flag_champions,
    """SELECT m.PARTITION_COLUMN, m.MODEL_USED, m.BACKTEST_WINDOW, m.HORIZON_MAPE, c.MODEL_USED IS NOT NULL AS is_champion
       FROM win_metrics m LEFT JOIN champ c ON c.PARTITION_COLUMN = m.PARTITION_COLUMN AND c.MODEL_USED = m.MODEL_USED""",
    {6: "HORIZON_MAPE"},
)


def _error_log(spark: SparkSession, d: str) -> DataFrame:
    """Texts stand in for messages: some are far longer than the error table keeps."""
    found = tables.read_table(spark, d, "documents").select(
        F.col("source").alias("stage"), F.col("lang").alias("partition"), F.col("text").alias("message"), "doc_id"
    )
    log = sinks.error_log(found, "02_training", None, F.lit(S.NOW).cast("timestamp_ntz"))
    return log.groupBy("notebook", "run_id", "stage", "partition", "model_type", "severity", F.length("message").alias("message_length")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.md5("message")).alias("first_digest")
    )


register(
    "error_log_append",
    _error_log,
    """SELECT '02_training' AS notebook, 'N/A' AS run_id, source AS stage, lang AS "partition", 'N/A' AS model_type, 'error' AS severity,
         length(m) AS message_length, count(*) AS n, min(md5(m)) AS first_digest
       FROM (SELECT *, substring(text, 1, 1000) AS m FROM documents) GROUP BY ALL""",
)


def _fixture(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(spark, "fixtures")
    events = tables.read_table(spark, d, "events").select("event_id", "event_type", "user_id")
    events.write.json(f"{folder}/events.jsonl")
    events.write.option("header", True).csv(f"{folder}/events.csv")
    parts = []
    for suffix in ("jsonl", "csv"):
        loaded = tables.load_fixture(spark, f"{folder}/events.{suffix}")
        parts.append(
            loaded.groupBy("event_type").agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum")
            ).withColumn("format", F.lit(suffix))
        )
    return parts[0].unionByName(parts[1])


register(
    "load_json_csv_fixture",
    _fixture,
    """SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, f AS format
       FROM events CROSS JOIN (VALUES ('jsonl'), ('csv')) t(f) GROUP BY event_type, f""",
)

register(
    "scan_passthrough",
    lambda s, d: tables.read_table(s, d, "orders"),
    "SELECT * FROM orders",
)

register(
    "latest_run_models",
    lambda s, d: tables.latest_run_models(S.model_results(s, d), S.DATA_TABLE).select(
        "run_id", "PARTITION_COLUMN", "MODEL_USED", "mape", "is_champion", "source_matches"
    ),
    """SELECT run_id, PARTITION_COLUMN, MODEL_USED, mape, is_champion, DATA_TABLE = 'horizon_panel' AS source_matches FROM results_all
       WHERE run_id = (SELECT max_by(run_id, LOAD_TS) FROM results_all)""",
    {6: "mape"},
)
