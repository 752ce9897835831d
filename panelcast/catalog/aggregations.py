"""Queries for aggregations: gates, horizon metrics, backtests, monitoring, diagnostics, explanations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.joins import RATIO_SQL, REALIZED_SQL, REGRESSORS, UNIVARIATE_SQL
from panelcast.catalog.oracle import corr
from panelcast.catalog.registry import register
from panelcast.config import DEMAND_SIGNALS, MOVING_AVERAGE_WINDOWS, REGRESSOR_COLUMNS
from panelcast.operators import diagnose as D
from panelcast.operators import explain as E
from panelcast.operators import horizon as H
from panelcast.operators import models as M
from panelcast.operators import monitor as MO
from panelcast.operators import quality as Q
from panelcast.operators import windows as X
from panelcast.sources import tables

NUM = D.NUMERIC_COLUMNS
P = "PARTITION_COLUMN"

# --- gates -------------------------------------------------------------------------------------------

register(
    "null_rate_check",
    lambda s, d: Q.null_rate_check(S.clean(s, d), ["BB", "BB_RAW", "MOF_0_MONTH", "SELLIN_MINUS3_MONTH"]),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate,
              avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.1 AS is_high FROM clean"""
        for c in ["BB", "BB_RAW", "MOF_0_MONTH", "SELLIN_MINUS3_MONTH"]
    ),
    {9: "null_rate"},
)


def _dq_input(spark: SparkSession, d: str) -> DataFrame:
    """The panel with the flaws real inputs have: unknown targets, a regressor gap, minus signs. No row is left out."""
    rows = S.clean(spark, d)
    brand = F.col("BRAND").cast("int")
    return (
        rows.withColumn("SR_MINUS3_MONTH", F.when((brand != 3) | (F.col("QUARTER") != "1998Q2"), F.col("SR_MINUS3_MONTH")))
        .withColumn("BB", F.when((brand == 5) & (F.col("QUARTER") < "1998Q1"), -F.col("BB")).otherwise(F.col("BB")))
    )


# fixed values: the same flaws in SQL
DQ_INPUT = """SELECT * REPLACE (
    CASE WHEN NOT (CAST(BRAND AS INTEGER) = 3 AND QUARTER = '1998Q2') THEN SR_MINUS3_MONTH END AS SR_MINUS3_MONTH,
    CASE WHEN CAST(BRAND AS INTEGER) = 5 AND QUARTER < '1998Q1' THEN -BB ELSE BB END AS BB)
  FROM clean"""
# gates that some origins of the panel do not reach, whose series are shorter
MIN_PERIODS, MIN_TRAIN_ROWS = 22, 14
_FIRST_BAD = "CASE " + " ".join(f"WHEN count(*) FILTER (WHERE {r} IS NULL) > 0 THEN '{r}'" for r in REGRESSOR_COLUMNS) + " END"
_BAD_NULLS = "CASE " + " ".join(
    f"WHEN count(*) FILTER (WHERE {r} IS NULL) > 0 THEN count(*) FILTER (WHERE {r} IS NULL)" for r in REGRESSOR_COLUMNS
) + " END"
DQ_PROFILE = f"""SELECT PARTITION_COLUMN, count(*) AS n_rows, count(*) FILTER (WHERE BB IS NULL) AS null_targets,
    count(*) FILTER (WHERE BB < 0) AS negative_targets, {_FIRST_BAD} AS bad_name, {_BAD_NULLS} AS bad_nulls,
    CAST(trunc(median(VERIFICATION_HORIZON)) AS INTEGER) AS val_h, CAST(trunc(median(PREDICTION_HORIZON)) AS INTEGER) AS pred_h
  FROM ({DQ_INPUT}) GROUP BY PARTITION_COLUMN"""


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return Q.dq_profile(_dq_input(spark, d))


register(
    "dq_null_target",
    lambda s, d: Q.dq_null_target(_profile(s, d)),
    f"SELECT PARTITION_COLUMN, null_targets FROM ({DQ_PROFILE}) WHERE null_targets > 0",
)
register(
    "dq_null_regressors",
    lambda s, d: Q.dq_null_regressors(_profile(s, d)),
    f"SELECT PARTITION_COLUMN, bad_name AS regressor, bad_nulls AS nulls FROM ({DQ_PROFILE}) WHERE bad_name IS NOT NULL",
)
register(
    "dq_negative_ratio",
    lambda s, d: Q.dq_negative_ratio(_profile(s, d)),
    f"""SELECT PARTITION_COLUMN, CAST(negative_targets AS DOUBLE) / n_rows AS negative_ratio FROM ({DQ_PROFILE})
        WHERE CAST(negative_targets AS DOUBLE) / n_rows > 0.2""",
    {9: "negative_ratio"},
)
register(
    "dq_min_periods",
    lambda s, d: Q.dq_min_periods(_profile(s, d), MIN_PERIODS),
    f"SELECT PARTITION_COLUMN, n_rows FROM ({DQ_PROFILE}) WHERE n_rows < {MIN_PERIODS}",
)
register(
    "dq_train_rows",
    lambda s, d: Q.dq_train_rows(_profile(s, d), MIN_TRAIN_ROWS),
    f"""SELECT PARTITION_COLUMN, n_rows - val_h - pred_h AS train_rows, val_h, pred_h FROM ({DQ_PROFILE}) WHERE n_rows - val_h - pred_h < {MIN_TRAIN_ROWS}""",
)
DQ_REASON = f"""SELECT PARTITION_COLUMN, CASE
    WHEN null_targets > 0 THEN 'Null values in BB (' || null_targets || ' nulls)'
    WHEN bad_name IS NOT NULL THEN 'Null values in regressor ' || bad_name || ' (' || bad_nulls || ' nulls)'
    WHEN n_rows < {MIN_TRAIN_ROWS} THEN 'Only ' || n_rows || ' periods (min: {MIN_TRAIN_ROWS})'
    WHEN n_rows - val_h - pred_h < {MIN_TRAIN_ROWS} THEN 'Only ' || (n_rows - val_h - pred_h) || ' training rows after split (val=' || val_h || ', pred=' || pred_h || ', min: {MIN_TRAIN_ROWS})'
    END AS reason FROM ({DQ_PROFILE})"""


def _dq_report(spark: SparkSession, d: str) -> DataFrame:
    profile = _profile(spark, d)
    report = Q.dq_report(profile, minimum=MIN_TRAIN_ROWS)
    return report.crossJoin(F.broadcast(Q.dq_summary(profile, report)))


register(
    "dq_report",
    _dq_report,
    f"""SELECT r.PARTITION_COLUMN, r.reason, t.total_groups, f.groups_removed, t.total_groups - f.groups_removed AS groups_remaining
        FROM ({DQ_REASON}) r, (SELECT count(*) AS total_groups FROM ({DQ_PROFILE})) t,
          (SELECT count(*) AS groups_removed FROM ({DQ_REASON}) WHERE reason IS NOT NULL) f WHERE r.reason IS NOT NULL""",
)

register(
    "extract_horizons",
    lambda s, d: X.extract_horizons(_countdown(s, d), [P]),
    """SELECT PARTITION_COLUMN, CAST(trunc(median(CAST(1 - k AS DOUBLE))) AS INTEGER) AS val_h,
         CAST(trunc(median(PREDICTION_HORIZON)) AS INTEGER) AS pred_h FROM panel GROUP BY PARTITION_COLUMN""",
)


def _countdown(spark: SparkSession, d: str) -> DataFrame:
    from panelcast.sources.panel import countdown_horizon

    return countdown_horizon(S.panel(spark, d))


# --- horizon metrics and backtests --------------------------------------------------------------------

register(
    "overall_mape",
    lambda s, d: S.build_window_metrics(s, d).select(P, "MODEL_USED", "BACKTEST_WINDOW", "MAPE", "prediction_count"),
    "SELECT PARTITION_COLUMN, MODEL_USED, BACKTEST_WINDOW, MAPE, prediction_count FROM win_metrics",
    {6: "MAPE"},
)


def _horizon_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = S.forecasts(spark, d).filter(F.col("k").between(1, 6))
    return H.horizon_metrics(H.add_indicators(rows), [P, "MODEL_USED"])


_HM = ", ".join(
    f"CASE WHEN count(BILLING) > 0 THEN avg({n}_{s}_REFERENCED) END AS {s}_{n}" for s in DEMAND_SIGNALS for n in ("VALIDATION_DISTANCE", "DIRECTIONAL_CORRECTNESS")
)
register(
    "horizon_metrics",
    _horizon_metrics,
    f"""SELECT PARTITION_COLUMN, MODEL_USED, k, avg(ape) AS MAPE, count(ape) AS n_scored, {_HM}
        FROM fc_ind WHERE k BETWEEN 1 AND 6 GROUP BY PARTITION_COLUMN, MODEL_USED, k""",
    {6: "MAPE " + " ".join(f"{s}_{n}" for s in DEMAND_SIGNALS for n in ("VALIDATION_DISTANCE", "DIRECTIONAL_CORRECTNESS"))},
)

_QS = [f"Q{h}_MAPE" for h in range(1, 7)]
register(
    "horizon_mape",
    lambda s, d: S.build_scores(s, d),
    f"SELECT VERSION, MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, {', '.join(_QS)}, HORIZON_MAPE FROM scores_all",
    {6: " ".join(_QS) + " HORIZON_MAPE"},
)

_BT = ["BT_MEAN_HORIZON_MAPE", "BT_STD_HORIZON_MAPE", "MAPE", "BT_STD_MAPE", "BT_CV", "BT_SELECTION_SCORE", "HORIZON_MAPE"]
register(
    "backtest_aggregate",
    lambda s, d: S.backtest_scores(s, d),
    f"""SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, BT_N_WINDOWS, prediction_count, {', '.join(_BT)}, {', '.join(_QS)} FROM bt_scores""",
    {6: " ".join([*_BT, *_QS])},
)

_AVG = ["selection_score", "BT_CV", "BT_STD_HORIZON_MAPE", *_QS]
register(
    "champion_averages",
    lambda s, d: H.champion_averages(S.champions(s, d)),
    f"SELECT count(*) AS champions, {', '.join(f'avg({c}) AS avg_{c}' for c in _AVG)} FROM champ",
    {6: " ".join(f"avg_{c}" for c in _AVG)},
)


def segment_summary(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNull()).groupBy("MARKET_SEGMENT", "MODEL_USED").agg(
        F.avg("mape").alias("avg_mape"), F.count(F.lit(1)).alias("partition_count")
    )


register(
    "segment_model_summary",
    lambda s, d: segment_summary(S.model_results(s, d).filter(F.col("VERSION") == S.LATEST)),
    """SELECT MARKET_SEGMENT, MODEL_USED, avg(mape) AS avg_mape, count(*) AS partition_count FROM results_all
       WHERE VERSION = 'V_3' AND error IS NULL GROUP BY ALL""",
    {4: "avg_mape"},
)

# --- monitoring --------------------------------------------------------------------------------------

register(
    "actuals_summary",
    lambda s, d: MO.actuals_summary(S.panel(s, d)),
    """SELECT PARTITION_COLUMN, count(*) AS row_count, min(QUARTER) AS earliest_quarter, max(QUARTER) AS latest_quarter
       FROM panel WHERE BB <> 0 GROUP BY PARTITION_COLUMN""",
)


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    return MO.version_inventory(S.predictions_all(spark, d), 2).drop("LOAD_TS")


register(
    "version_inventory",
    _inventory,
    """SELECT PREDICTIONS_VERSION, count(DISTINCT PARTITION_COLUMN) AS partition_count, count(*) AS row_count,
         row_number() OVER (ORDER BY PREDICTIONS_VERSION DESC) <= 2 AS selected FROM pred_all GROUP BY PREDICTIONS_VERSION""",
)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return MO.realized(S.predictions_all(spark, d), S.panel(spark, d))


register(
    "realized_mape",
    lambda s, d: MO.realized_mape(_scored(s, d)),
    f"""SELECT PARTITION_COLUMN, MODEL_USED, PREDICTIONS_VERSION, avg(REALIZED_APE) AS realized_mape, count(*) AS n_quarters_scored,
          avg(PREDICTION_HORIZON) AS avg_prediction_horizon FROM ({REALIZED_SQL}) GROUP BY ALL""",
    {6: "realized_mape avg_prediction_horizon"},
)
register(
    "realized_by_horizon",
    lambda s, d: MO.realized_by_horizon(_scored(s, d), "k"),
    f"SELECT PREDICTIONS_VERSION, k, avg(REALIZED_APE) AS realized_mape, count(*) AS n_quarters FROM ({REALIZED_SQL}) GROUP BY ALL",
    {6: "realized_mape"},
)


def _staleness(spark: SparkSession, d: str) -> DataFrame:
    return MO.model_staleness(S.model_results(spark, d), F.lit(S.NOW).cast("timestamp_ntz"))


STALE_SQL = f"""SELECT PARTITION_COLUMN, MODEL_USED, max(LOAD_TS) AS last_trained,
    CAST(floor(epoch(TIMESTAMP '{S.NOW}' - max(LOAD_TS)) / 86400) AS BIGINT) AS model_age_days,
    floor(epoch(TIMESTAMP '{S.NOW}' - max(LOAD_TS)) / 86400) > 30 AS is_stale
  FROM results_all WHERE is_champion GROUP BY ALL"""
register("model_staleness", lambda s, d: _staleness(s, d).drop("last_trained"), f"SELECT * EXCLUDE (last_trained) FROM ({STALE_SQL})")


def monitor_records(spark: SparkSession, d: str) -> DataFrame:
    backtest = MO.backtest_against_estimates(S.predictions_all(spark, d), S.panel(spark, d), S.champions(spark, d))
    return MO.monitoring_records(backtest, _staleness(spark, d), S.LATEST)


RECORDS_SQL = f"""
  SELECT PARTITION_COLUMN, 'backtest_actuals' AS check_type, PREDICTIONS_VERSION AS current_version, CAST(NULL AS VARCHAR) AS comparison_version,
    'realized_vs_estimated_mape' AS metric_name, realized_mape AS current_value, estimated_mape AS comparison_value,
    CASE WHEN estimated_mape <> 0 THEN realized_mape - estimated_mape END AS absolute_change, mape_ratio AS relative_change_pct, is_alert,
    CASE WHEN is_alert THEN 'realized MAPE ' || printf('%.1f', round(mape_ratio, 1)) || 'x estimated' END AS alert_reason,
    'V_3' AS data_version_scored_against FROM ({RATIO_SQL})
  UNION ALL
  SELECT PARTITION_COLUMN, 'model_staleness', NULL, NULL, 'model_age_days', CAST(model_age_days AS DOUBLE), 30.0,
    CAST(model_age_days AS DOUBLE) - 30, NULL, is_stale, CASE WHEN is_stale THEN 'model is ' || model_age_days || ' days old' END, NULL
  FROM ({STALE_SQL})"""
register("monitoring_records", monitor_records, RECORDS_SQL, {6: "current_value comparison_value absolute_change relative_change_pct"})

register(
    "health_matrix",
    lambda s, d: MO.health_matrix(monitor_records(s, d)),
    f"""SELECT PARTITION_COLUMN, max(CASE WHEN check_type = 'backtest_actuals' AND is_alert THEN 1 ELSE 0 END) AS backtest_actuals,
          max(CASE WHEN check_type = 'model_staleness' AND is_alert THEN 1 ELSE 0 END) AS model_staleness
        FROM ({RECORDS_SQL}) GROUP BY PARTITION_COLUMN""",
)


def _check_summary(spark: SparkSession, d: str) -> DataFrame:
    checks = spark.createDataFrame([("backtest_actuals",), ("model_staleness",), ("feature_drift",)], "check_type string")
    return MO.check_summary(monitor_records(spark, d), checks)


register(
    "check_summary",
    _check_summary,
    f"""WITH per AS (SELECT c.check_type, count(r.check_type) AS total, count(*) FILTER (WHERE r.is_alert) AS failed
          FROM (VALUES ('backtest_actuals'), ('model_staleness'), ('feature_drift')) c(check_type)
          LEFT JOIN ({RECORDS_SQL}) r ON r.check_type = c.check_type GROUP BY c.check_type)
        SELECT check_type, total, failed, total - failed AS passed,
          CASE WHEN total > 0 THEN printf('%.1f', round(failed * 100.0::DOUBLE / total, 1)) || '%' ELSE 'N/A' END AS alert_rate,
          CASE WHEN (SELECT sum(failed) FROM per) > 0 THEN 'NEEDS_ATTENTION' ELSE 'PASS' END AS status FROM per""",
)

# --- sanity ------------------------------------------------------------------------------------------

LIMITS = {"extreme": 150.0, "min_direction": 0.5, "max_distance": 1.5}


def _sanity(spark: SparkSession, d: str) -> DataFrame:
    rows = S.forecasts(spark, d).filter(F.col("k") > 0).withColumn("APE", H.ape("BILLING", "BILLING_PREDICTED"))
    return Q.sanity_checks(H.add_indicators(rows), extra_keys=["MODEL_USED"], **LIMITS)


_DSUM = " + ".join(f"coalesce(sum(DIRECTIONAL_CORRECTNESS_{s}_REFERENCED), 0)" for s in DEMAND_SIGNALS)
_DN = " + ".join(f"count(DIRECTIONAL_CORRECTNESS_{s}_REFERENCED)" for s in DEMAND_SIGNALS)
_VSUM = " + ".join(f"coalesce(sum(VALIDATION_DISTANCE_{s}_REFERENCED), 0)" for s in DEMAND_SIGNALS)
_VN = " + ".join(f"count(VALIDATION_DISTANCE_{s}_REFERENCED)" for s in DEMAND_SIGNALS)
SANITY_SQL = f"""SELECT *, negative_rows > 0 AS has_negative, coalesce(mean_ape > 150, false) AS is_extreme, n_rows >= 2 AND n_unique < 2 AS is_flat,
    coalesce(mean_direction < 0.5, false) AS low_direction, coalesce(mean_distance > 1.5, false) AS high_distance FROM (
  SELECT PARTITION_COLUMN, MODEL_USED, count(*) AS n_rows, count(*) FILTER (WHERE BILLING_PREDICTED < 0) AS negative_rows, avg(ape) AS mean_ape,
    count(DISTINCT BILLING_PREDICTED) AS n_unique, CAST({_DSUM} AS DOUBLE) / nullif({_DN}, 0) AS mean_direction,
    CAST({_VSUM} AS DOUBLE) / nullif({_VN}, 0) AS mean_distance FROM fc_ind WHERE k > 0 GROUP BY ALL)"""
register("sanity_checks", _sanity, SANITY_SQL, {6: "mean_ape mean_direction mean_distance"})


def _sanity_report(spark: SparkSession, d: str) -> DataFrame:
    return Q.sanity_report(_sanity(spark, d), extra_keys=["MODEL_USED"])


SANITY_REPORT_SQL = f"""WITH c AS ({SANITY_SQL})
  SELECT PARTITION_COLUMN, MODEL_USED, 'negative' AS issue, CAST(negative_rows AS DOUBLE) AS value FROM c WHERE has_negative
  UNION ALL SELECT PARTITION_COLUMN, MODEL_USED, 'extreme_ape', mean_ape FROM c WHERE is_extreme
  UNION ALL SELECT PARTITION_COLUMN, MODEL_USED, 'flat', CAST(n_unique AS DOUBLE) FROM c WHERE is_flat
  UNION ALL SELECT PARTITION_COLUMN, MODEL_USED, 'low_direction', mean_direction FROM c WHERE low_direction
  UNION ALL SELECT PARTITION_COLUMN, MODEL_USED, 'high_distance', mean_distance FROM c WHERE high_distance"""
register("sanity_report", _sanity_report, SANITY_REPORT_SQL, {6: "value"})
register(
    "sanity_totals",
    lambda s, d: Q.sanity_totals(_sanity(s, d)),
    f"""SELECT count(*) AS total_partitions, CAST(sum(negative_rows) AS BIGINT) AS total_negative_rows,
          count(*) FILTER (WHERE has_negative) AS partitions_with_negatives, count(*) FILTER (WHERE is_extreme) AS partitions_extreme_ape,
          count(*) FILTER (WHERE is_flat) AS partitions_flat, count(*) FILTER (WHERE low_direction) AS partitions_low_direction,
          count(*) FILTER (WHERE high_distance) AS partitions_high_distance FROM ({SANITY_SQL})""",
)


def _collect_errors(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the gate, the training, the sanity checks and the monitor in one log."""
    from panelcast.sources.sinks import collect_errors

    def note(df: DataFrame, stage: str, model, severity: str, message) -> DataFrame:
        return df.select(
            F.lit(stage).alias("stage"), F.col(P).alias("partition"), model.alias("model_type"), F.lit(severity).alias("severity"), message.alias("message")
        )

    gate = note(Q.dq_report(_profile(spark, d), minimum=MIN_TRAIN_ROWS), "data_quality", F.lit("N/A"), "error", F.col("reason"))
    results = S.model_results(spark, d).filter((F.col("VERSION") == S.LATEST) & F.col("error").isNotNull())
    training = note(results, "training", F.col("MODEL_USED"), "error", F.col("error"))
    sanity = note(_sanity_report(spark, d), "prediction_sanity_check", F.col("MODEL_USED"), "warning", F.col("issue"))
    alerts = monitor_records(spark, d).filter("is_alert")
    monitor = note(alerts, "monitoring", F.col("check_type"), "warning", F.col("alert_reason"))
    return collect_errors([gate, training, sanity, monitor])


register(
    "collect_errors",
    _collect_errors,
    f"""SELECT 'data_quality' AS stage, PARTITION_COLUMN AS "partition", 'N/A' AS model_type, 'error' AS severity, reason AS message
          FROM ({DQ_REASON}) WHERE reason IS NOT NULL
        UNION ALL SELECT 'training', PARTITION_COLUMN, MODEL_USED, 'error', error FROM results_all WHERE VERSION = 'V_3' AND error IS NOT NULL
        UNION ALL SELECT 'prediction_sanity_check', PARTITION_COLUMN, MODEL_USED, 'warning', issue FROM ({SANITY_REPORT_SQL})
        UNION ALL SELECT 'monitoring', PARTITION_COLUMN, check_type, 'warning', alert_reason FROM ({RECORDS_SQL}) WHERE is_alert""",
)

# --- diagnostics -------------------------------------------------------------------------------------


def _stat(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 1) AS null_pct,
      round(avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) * 100, 1) AS zero_pct, round(avg(CASE WHEN {c} < 0 THEN 1.0 ELSE 0.0 END) * 100, 1) AS negative_pct,
      round(min({c}), 2) AS min, round(max({c}), 2) AS max, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std,
      round(stddev_samp({c}) / nullif(avg({c}), 0), 3) AS cv FROM clean"""


STATS_SQL = " UNION ALL ".join(_stat(c) for c in NUM)
register("basic_stats", lambda s, d: D.basic_stats(S.clean(s, d)), STATS_SQL)
register(
    "column_flags",
    lambda s, d: D.column_flags(D.basic_stats(S.clean(s, d))),
    f"""WITH st AS ({STATS_SQL}), sc AS (SELECT coalesce(stddev_pop(mean) / nullif(avg(mean), 0), 0) AS scale_cv FROM st WHERE mean IS NOT NULL AND mean <> 0)
        SELECT "column", coalesce(std < 0.01, false) AS is_constant, zero_pct > 50 AS mostly_zero, negative_pct > 5 AS has_negatives,
          scale_cv, scale_cv < 0.3 AS similar_scale FROM st, sc""",
    {6: "scale_cv"},
)

_FULL = " AND ".join(f"{c} IS NOT NULL" for c in NUM)
PEARSON_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {corr(a, b)} AS corr FROM full_" for a, b in combinations(NUM, 2)
)
register(
    "pearson_matrix",
    lambda s, d: D.pearson_matrix(S.clean(s, d)),
    f"WITH full_ AS (SELECT * FROM clean WHERE {_FULL}) {PEARSON_SQL}",
    {6: "corr"},
)

SPEARMAN_COLUMNS = NUM
_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in SPEARMAN_COLUMNS
)
_SFULL = " AND ".join(f"{c} IS NOT NULL" for c in SPEARMAN_COLUMNS)
SPEARMAN_SQL = f"WITH full_ AS (SELECT {_RANKS} FROM clean WHERE {_SFULL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {corr(a, b)} AS corr FROM full_" for a, b in combinations(SPEARMAN_COLUMNS, 2)
)
register("spearman_matrix", lambda s, d: D.spearman_matrix(S.clean(s, d), SPEARMAN_COLUMNS), SPEARMAN_SQL, {6: "corr"})


def _signal_strength(spark: SparkSession, d: str) -> DataFrame:
    rows = S.clean(spark, d)
    return D.signal_strength(
        D.pearson_matrix(rows, SPEARMAN_COLUMNS, left=["BB"]), D.spearman_matrix(rows, SPEARMAN_COLUMNS, left=["BB"])
    )


_SIG = " UNION ALL ".join(
    f"SELECT '{b}' AS feature, (SELECT abs({corr('BB', b)}) FROM raw_) AS abs_pearson, (SELECT abs({corr('BB', b)}) FROM full_) AS abs_spearman"
    for b in SPEARMAN_COLUMNS[1:]
)
register(
    "signal_strength",
    _signal_strength,
    f"""WITH raw_ AS (SELECT * FROM clean WHERE {_SFULL}), full_ AS (SELECT {_RANKS} FROM clean WHERE {_SFULL}), x AS ({_SIG})
        SELECT *, CASE WHEN greatest(abs_pearson, abs_spearman) > 0.5 THEN 'SIGNAL' WHEN greatest(abs_pearson, abs_spearman) > 0.2 THEN 'WEAK' ELSE 'NOISE' END AS signal
        FROM x""",
    {6: "abs_pearson abs_spearman"},
)

_SIGNAL_CORR = " UNION ALL ".join(f"SELECT {corr(a, b)} AS corr FROM full_" for a, b in combinations(D.SIGNAL_PAIR_COLUMNS, 2))
register(
    "intersignal_strength",
    lambda s, d: D.intersignal_strength(D.pearson_matrix(S.clean(s, d))),
    f"""WITH full_ AS (SELECT * FROM clean WHERE {_FULL})
        SELECT avg(corr) AS avg_corr, count(corr) AS n_pairs,
          CASE WHEN avg(corr) > 0.7 THEN 'STRONG' WHEN avg(corr) > 0.3 THEN 'MODERATE' ELSE 'WEAK/ABSENT' END AS strength FROM ({_SIGNAL_CORR})""",
    {6: "avg_corr"},
)

RATIO_ROWS = " UNION ALL ".join(
    f"SELECT PARTITION_COLUMN, '{a}/{b}' AS ratio, {a} / nullif({b}, 0) AS r FROM clean WHERE {a} <> 0 AND {b} IS NOT NULL AND {b} <> 0" for a, b in D.RATIO_PAIRS
)
register(
    "ratio_stability",
    lambda s, d: D.ratio_stability(S.clean(s, d)),
    f"""WITH l AS ({RATIO_ROWS}), q AS (SELECT ratio, quantile_cont(r, 0.01) AS lo, quantile_cont(r, 0.99) AS hi, count(*) AS n FROM l GROUP BY ratio HAVING count(*) >= 5),
          t AS (SELECT ratio, count(*) AS n, avg(r) AS mean, stddev_samp(r) AS std FROM l JOIN q USING (ratio) WHERE r BETWEEN lo AND hi GROUP BY ratio)
        SELECT *, std / abs(nullif(mean, 0)) AS cv, CASE WHEN std / abs(mean) < 0.1 THEN 'CONSTANT' WHEN std / abs(mean) < 0.5 THEN 'LOW_VARIANCE'
          WHEN std / abs(mean) < 1.0 THEN 'MODERATE' ELSE 'HIGH_VARIANCE' END AS label FROM t""",
    {6: "mean std cv"},
)
CV_SQL = """SELECT PARTITION_COLUMN, count(*) AS n_rows, round(stddev_samp(r) / nullif(abs(avg(r)), 0), 4) AS ratio_cv
  FROM (SELECT PARTITION_COLUMN, BB / MOF_0_MONTH AS r FROM clean WHERE BB <> 0 AND MOF_0_MONTH <> 0) GROUP BY PARTITION_COLUMN HAVING count(*) >= 3"""


def _ratio_cv(spark: SparkSession, d: str) -> DataFrame:
    per = D.ratio_cv_by_series(S.clean(spark, d))
    return per.crossJoin(F.broadcast(D.ratio_cv_summary(per)))


register(
    "ratio_cv_by_series",
    _ratio_cv,
    f"""WITH per AS ({CV_SQL}), t AS (SELECT count(*) AS n_series, avg(ratio_cv) AS avg_cv,
          CASE WHEN avg(ratio_cv) < 0.2 THEN 'STABLE_WITHIN' ELSE 'VARIES_WITHIN' END AS label FROM per)
        SELECT * FROM per, t""",
    {6: "avg_cv"},
)


def _shape(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis, kurtosis_pop({c}) AS g2 FROM clean"""


register(
    "distribution_shape",
    lambda s, d: D.distribution_shape(S.clean(s, d)),
    f"""SELECT "column", n, skewness, kurtosis, n / 6.0::DOUBLE * (power(skewness * (n - 2) / sqrt(n * (n - 1.0::DOUBLE)), 2) + power(g2, 2) / 4) AS jarque_bera,
          CASE WHEN abs(skewness) < 0.5 AND abs(kurtosis) < 1 THEN 'SYMMETRIC' WHEN skewness > 1 THEN 'RIGHT-SKEWED' WHEN skewness < -1 THEN 'LEFT-SKEWED'
            WHEN abs(kurtosis) > 3 THEN 'HEAVY-TAILED' ELSE 'MODERATE' END AS shape
        FROM ({' UNION ALL '.join(_shape(c) for c in NUM)}) WHERE n >= 10""",
    {5: "skewness kurtosis", 2: "jarque_bera"},
)
register(
    "segment_distribution",
    lambda s, d: D.segment_distribution(S.clean(s, d)),
    """SELECT MARKET_SEGMENT, count(BB) AS n, avg(BB) AS mean, stddev_samp(BB) AS std, skewness(BB) AS skew, min(BB) AS min, max(BB) AS max
       FROM clean GROUP BY MARKET_SEGMENT HAVING count(BB) >= 3""",
    {2: "mean std", 5: "skew"},
)

_W = "PARTITION BY PARTITION_COLUMN ORDER BY qi ROWS"
_MA_ROWS = " UNION ALL ".join(
    f"""SELECT PARTITION_COLUMN, {n} AS "window", BILLING_MOVING_AVERAGE_{n}Q AS a,
          CAST(sum(CAST(floor(BB * 100 + 0.5) AS BIGINT)) OVER ({_W} {n - 1} PRECEDING) AS DOUBLE) / nullif(count(BB) OVER ({_W} {n - 1} PRECEDING) * 100.0::DOUBLE, 0) AS c
        FROM clean"""
    for n in MOVING_AVERAGE_WINDOWS
)
MA_SQL = f"""SELECT PARTITION_COLUMN, "window", count(*) AS n_compared, bool_and(abs(a - c) <= abs(c) * 1e-3 + 1e-3) AS exact_match,
    round({corr('a', 'c')}, 4) AS correlation, round(avg(abs((a - c) / nullif(a, 0))) * 100, 2) AS mean_abs_rel_error_pct
  FROM ({_MA_ROWS}) WHERE a IS NOT NULL AND c IS NOT NULL AND a <> 0 GROUP BY ALL HAVING count(*) >= 3"""
register("ma_consistency", lambda s, d: D.ma_consistency(S.clean(s, d)), MA_SQL)

_LAG_ROWS = " UNION ALL ".join(
    f"""SELECT PARTITION_COLUMN, '{a}' AS signal, lag({a}) OVER (PARTITION BY PARTITION_COLUMN ORDER BY qi) AS s, {b} AS l,
          count(*) OVER (PARTITION BY PARTITION_COLUMN) AS rows_ FROM panel"""
    for a, b in D.LAG_PAIRS
)
register(
    "lag_consistency",
    lambda s, d: D.lag_consistency(S.panel(s, d)),
    f"""SELECT signal, count(*) AS n_series, avg(CASE WHEN exact THEN 1.0 ELSE 0.0 END) * 100 AS exact_pct, avg(corr) AS avg_corr,
          CASE WHEN avg(CASE WHEN exact THEN 1.0 ELSE 0.0 END) * 100 > 80 THEN 'REAL' WHEN avg(corr) > 0.8 THEN 'APPROXIMATELY PRESERVED'
            WHEN avg(corr) > 0.3 THEN 'WEAKLY PRESERVED' ELSE 'DESTROYED' END AS label
        FROM (SELECT PARTITION_COLUMN, signal, bool_and(abs(s - l) <= abs(l) * 1e-3 + 1e-3) AS exact, CASE WHEN count(*) > 2 THEN {corr('s', 'l')} END AS corr
              FROM ({_LAG_ROWS}) WHERE rows_ >= 3 AND s IS NOT NULL AND l IS NOT NULL AND s <> 0 AND l <> 0 GROUP BY ALL HAVING count(*) >= 2)
        GROUP BY signal""",
    {6: "exact_pct avg_corr"},
)

_AC = " UNION ALL ".join(
    f"""SELECT PARTITION_COLUMN, {k} AS lag, round({corr('BB', 'l')}, 4) AS autocorrelation FROM (
          SELECT PARTITION_COLUMN, BB, lag(BB, {k}) OVER (PARTITION BY PARTITION_COLUMN ORDER BY qi) AS l, count(*) OVER (PARTITION BY PARTITION_COLUMN) AS n
          FROM clean WHERE BB IS NOT NULL) WHERE n >= 6 GROUP BY PARTITION_COLUMN"""
    for k in (1, 2, 3, 4)
)
AUTOCORR_SQL = f"""SELECT lag, count(*) AS n_series, avg(autocorrelation) AS avg_autocorrelation,
    avg(CASE WHEN autocorrelation > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_positive FROM ({_AC}) WHERE autocorrelation IS NOT NULL GROUP BY lag"""


def _verdict(spark: SparkSession, d: str) -> DataFrame:
    rows = S.clean(spark, d)
    ma = D.ma_summary(D.ma_consistency(rows))
    return D.diagnostic_verdict(ma, D.pearson_matrix(rows, left=["BB"]), D.autocorrelation_summary(D.autocorrelation(rows)))


_BB_CORR = " UNION ALL ".join(f"SELECT {corr('BB', b)} AS corr FROM full_" for b in NUM[1:])
register(
    "diagnostic_verdict",
    _verdict,
    f"""WITH full_ AS (SELECT * FROM clean WHERE {_FULL}), ma AS (SELECT avg(CASE WHEN exact_match THEN 1.0 ELSE 0.0 END) * 100 AS e, avg(correlation) AS c FROM ({MA_SQL})),
          x AS (SELECT CASE WHEN e > 90 THEN 'CONSISTENT' WHEN c > 0.9 THEN 'APPROX CONSISTENT' WHEN c > 0.5 THEN 'WEAKLY CONSISTENT' ELSE 'INCONSISTENT' END AS ma_status,
                  (SELECT avg(abs(corr)) FROM ({_BB_CORR})) AS avg_abs_corr, (SELECT avg_autocorrelation FROM ({AUTOCORR_SQL}) WHERE lag = 1) AS lag1 FROM ma),
          y AS (SELECT *, CASE WHEN avg_abs_corr > 0.6 THEN 'STRONG' WHEN avg_abs_corr > 0.3 THEN 'MODERATE' ELSE 'WEAK/ABSENT' END AS corr_status,
                  CASE WHEN lag1 > 0.5 THEN 'PRESERVED' WHEN lag1 > 0.2 THEN 'PARTIAL' WHEN lag1 IS NULL THEN 'UNKNOWN' ELSE 'DESTROYED' END AS temporal_status FROM x)
        SELECT *, CASE WHEN ma_status IN ('CONSISTENT', 'APPROX CONSISTENT') AND corr_status = 'STRONG' THEN 'consistently_masked'
          WHEN ma_status IN ('CONSISTENT', 'APPROX CONSISTENT') THEN 'signals_independent' WHEN ma_status = 'INCONSISTENT' THEN 'all_independent' ELSE 'mixed' END AS method
        FROM y""",
    {6: "avg_abs_corr lag1"},
)

# --- explanations ------------------------------------------------------------------------------------


def _fits(spark: SparkSession, d: str) -> DataFrame:
    return M.univariate_fits(S.split_panel(spark, d), [P], REGRESSORS)


def _importance(spark: SparkSession, d: str) -> DataFrame:
    """Importance of a regressor in a partition: size of its effect, as a map per partition."""
    maps = _fits(spark, d).filter(F.col("coefficient").isNotNull()).groupBy(P).agg(
        F.map_from_entries(F.collect_list(F.struct("regressor", F.abs(F.col("coefficient") * F.col("x_mean"))))).alias("importances")
    )
    return E.importance_average(maps)


register(
    "importance_average",
    _importance,
    f"""SELECT regressor AS feature, avg(abs(coefficient * x_mean)) AS avg_importance, count(*) AS n_models FROM ({UNIVARIATE_SQL})
        WHERE coefficient IS NOT NULL GROUP BY regressor""",
    {2: "avg_importance"},
)


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    matrix = E.coefficient_matrix(_fits(spark, d), REGRESSORS)
    top = E.top_partitions(matrix, 5).select(P, F.lit(True).alias("in_top"))
    return matrix.join(F.broadcast(top), P, "left").withColumn("in_top", F.coalesce("in_top", F.lit(False)))


register(
    "coefficient_matrix",
    _matrix,
    f"""WITH m AS (SELECT PARTITION_COLUMN, {', '.join(f"coalesce(max(coefficient) FILTER (WHERE regressor = '{r}'), 0) AS {r}" for r in REGRESSORS)}
            FROM ({UNIVARIATE_SQL}) GROUP BY PARTITION_COLUMN),
          t AS (SELECT *, greatest({', '.join(f'abs({r})' for r in REGRESSORS)}) AS max_abs FROM m)
        SELECT *, row_number() OVER (ORDER BY max_abs DESC, PARTITION_COLUMN) <= 5 AS in_top FROM t""",
    {6: " ".join(REGRESSORS) + " max_abs"},
)

register(
    "fare_by_zip",
    lambda s, d: tables.read_table(s, d, "orders").groupBy("o_custkey").agg(F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5)).alias("total_cents")),
    "SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total_cents FROM orders GROUP BY o_custkey",
)

