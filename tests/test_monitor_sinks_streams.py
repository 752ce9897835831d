"""Monitoring, sinks and streaming jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators import joins as J
from panelcast.operators import monitor as MO
from panelcast.session import scratch_dir
from panelcast.sources import sinks, tables
from panelcast.streaming import jobs

PRED = "PREDICTIONS_VERSION string, PARTITION_COLUMN string, QUARTER string, MODEL_USED string, BILLING double, BILLING_PREDICTED double, PREDICTION_HORIZON double"


def predictions(spark):
    return spark.createDataFrame(
        [
            ("V_1", "p", "2020Q1", "A", None, 90.0, 6.0), ("V_1", "p", "2020Q2", "A", 0.0, 150.0, 6.0), ("V_1", "p", "2019Q4", "A", 80.0, 81.0, 6.0),
            ("V_2", "p", "2020Q2", "A", None, 100.0, 6.0), ("V_2", "q", "2020Q2", "A", None, 10.0, 6.0),
        ],
        PRED,
    )


def actuals(spark):
    return spark.createDataFrame(
        [("p", "2020Q1", 100.0), ("p", "2020Q1", 100.0), ("p", "2020Q2", 100.0), ("q", "2020Q2", 0.0), ("q", "2020Q3", 5.0)],
        "PARTITION_COLUMN string, QUARTER string, BB double",
    )


def test_realized_rows_and_duplicates(spark):
    got = {(r["PREDICTIONS_VERSION"], r["QUARTER"]): r["REALIZED_APE"] for r in MO.realized(predictions(spark), actuals(spark)).collect()}
    assert got == {("V_1", "2020Q1"): 10.0, ("V_1", "2020Q2"): 50.0, ("V_2", "2020Q2"): 0.0}
    assert MO.realized(predictions(spark), actuals(spark)).count() == 3


@pytest.mark.parametrize("estimate, ratio, alert", [(15.0, 2.0, False), (14.0, 30 / 14, True), (0.0, None, False), (None, None, False)])
def test_ratio_threshold_is_strict(spark, estimate, ratio, alert):
    realized = spark.createDataFrame([("p", 30.0)], "PARTITION_COLUMN string, realized_mape double")
    est = spark.createDataFrame([("p", estimate)], "PARTITION_COLUMN string, estimated_mape double")
    row = J.estimated_vs_realized(realized, est).first()
    assert row["mape_ratio"] == ratio and row["is_alert"] == alert


def test_staleness_is_whole_days_and_strict(spark):
    now = dt.datetime(2024, 3, 1, 12)
    rows = [("edge", "A", now - dt.timedelta(days=30, hours=23), True), ("old", "A", now - dt.timedelta(days=31), True), ("loser", "A", now - dt.timedelta(days=99), False)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MODEL_USED string, LOAD_TS timestamp_ntz, is_champion boolean")
    out = {r["PARTITION_COLUMN"]: (r["model_age_days"], r["is_stale"]) for r in MO.model_staleness(df, F.lit(now).cast("timestamp_ntz")).collect()}
    assert out == {"edge": (30, False), "old": (31, True)}


def test_scored_versions_are_skipped(spark):
    records = spark.createDataFrame([("backtest_actuals", "V_1", "D_1"), ("backtest_actuals", "V_2", "D_0")], "check_type string, current_version string, data_version_scored_against string")
    candidates = predictions(spark).select("PREDICTIONS_VERSION").distinct()
    assert [r[0] for r in MO.unscored_versions(candidates, records, "D_1").collect()] == ["V_2"]
    assert tuple(MO.all_versions_scored(candidates, records, "D_1").first()) == (False, 1)


def test_check_summary_without_records(spark):
    records = spark.createDataFrame([("a", True), ("a", False)], "check_type string, is_alert boolean")
    checks = spark.createDataFrame([("a",), ("b",)], "check_type string")
    got = {r["check_type"]: (r["total"], r["failed"], r["passed"], r["alert_rate"], r["status"]) for r in MO.check_summary(records, checks).collect()}
    assert got == {"a": (2, 1, 1, "50.0%", "NEEDS_ATTENTION"), "b": (0, 0, 0, "N/A", "NEEDS_ATTENTION")}


def test_align_to_schema(spark):
    df = spark.createDataFrame([(1, "x")], "n int, extra string").withColumn("void", F.lit(None))
    target = T.StructType([T.StructField("n", T.DoubleType()), T.StructField("gone", T.DateType())])
    kept = sinks.align_to_schema(df, target)
    assert dict(kept.dtypes) == {"n": "double", "extra": "string", "void": "string", "gone": "date"}
    assert "gone" not in sinks.align_to_schema(df, target, keep_stale=False).columns


def test_latest_flag_appended_and_derived(spark):
    old = spark.createDataFrame([("V_1", 1)], "PREDICTIONS_VERSION string, LOAD_TS int")
    new = spark.createDataFrame([("V_2", 2)], "PREDICTIONS_VERSION string, LOAD_TS int")
    both = sinks.append_with_latest_flag(sinks.append_with_latest_flag(None, old), new)
    derived = sinks.derive_latest_flag(both.drop("is_latest"))
    want = {"V_1": False, "V_2": True}
    assert {r[0]: r["is_latest"] for r in both.collect()} == want == {r[0]: r["is_latest"] for r in derived.collect()}


def test_versioned_write_prunes(spark):
    path = scratch_dir(spark, "versioned")
    df = spark.createDataFrame([("V_1", 1), ("V_2", 2)], "PREDICTIONS_VERSION string, x int")
    sinks.write_versioned(df.filter("x = 1"), path, "PREDICTIONS_VERSION")
    sinks.write_versioned(df.filter("x = 2"), path, "PREDICTIONS_VERSION")
    back = spark.read.parquet(path).filter("PREDICTIONS_VERSION = 'V_2'")
    assert [r["x"] for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(PREDICTIONS_VERSION" in back._jdf.queryExecution().toString()


def test_error_log_defaults_and_limit(spark):
    df = spark.createDataFrame([(None, "m" * 1500)], "severity string, message string")
    row = sinks.error_log(df, "n", None, F.lit("2024-01-01").cast("timestamp")).first()
    assert (row["run_id"], row["stage"], row["partition"], row["severity"], len(row["message"])) == ("N/A", "unknown", "N/A", "error", 1000)


def test_fixture_loader(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    assert tables.load_fixture(spark, str(tmp_path / "a.json")).count() == 2
    assert tables.load_fixture(spark, str(tmp_path / "a.csv")).columns == ["x"]
    with pytest.raises(ValueError):
        tables.load_fixture(spark, "a.txt")


def test_untrained_partitions(spark):
    expected = spark.createDataFrame([("ok",), ("short",), ("broken",), ("absent",)], "PARTITION_COLUMN string")
    rows = [("ok", None), ("ok", "boom"), ("short", "Insufficient training data: 3 rows"), ("short", "boom"), ("broken", "boom")]
    out = J.untrained_partitions(expected, spark.createDataFrame(rows, "PARTITION_COLUMN string, error string"))
    assert {tuple(r) for r in out.collect()} == {("short", "insufficient_data"), ("broken", "failure"), ("absent", "failure")}


def test_refresh_is_idempotent_over_files_and_reruns(spark):
    folder = scratch_dir(spark, "arriving")
    first = actuals(spark).filter("QUARTER = '2020Q1'").coalesce(1)
    first.write.parquet(f"{folder}/in")
    schema = first.schema
    run = lambda: jobs.monitor_refresh(spark, jobs.stream_files(spark, f"{folder}/in", schema, files_per_batch=1), predictions(spark), f"{folder}/out", f"{folder}/ck")
    assert run().count() == 1
    assert run().count() == 1  # nothing new arrived
    actuals(spark).coalesce(1).write.mode("append").parquet(f"{folder}/in")  # repeats 2020Q1, brings 2020Q2
    assert run().count() == 3


def test_error_counts_drop_late_rows(spark):
    folder = scratch_dir(spark, "late")
    schema = "timestamp timestamp, check_type string, severity string"

    def arrive(*days):
        rows = [(dt.datetime(2024, 1, d, 5), "c", "error") for d in days]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.stream_files(spark, f"{folder}/in", T._parse_datatype_string(schema))
        jobs.run_available(jobs.error_counts(stream), f"{folder}/out", f"{folder}/ck")
        got = jobs.read_updates(spark, f"{folder}/out", ["day", "check_type", "severity"])
        return {r["day"]: r["n"] for r in got.collect()}

    assert arrive(1, 2, 10) == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-10": 1}
    assert arrive(2, 9, 10) == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-09": 1, "2024-01-10": 2}


def test_rollup_counts_each_order_once(spark):
    folder = scratch_dir(spark, "orders")
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp"
    rows = [(1, 7, 10.25, dt.datetime(2024, 1, 5)), (1, 7, 10.25, dt.datetime(2024, 1, 5)), (2, 7, 1.0, dt.datetime(2024, 3, 5)), (3, 8, 2.0, dt.datetime(2024, 4, 5))]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/in")
    customers = spark.createDataFrame([(7, "s"), (8, "s")], "c_custkey bigint, c_mktsegment string")
    stream = jobs.stream_files(spark, f"{folder}/in", T._parse_datatype_string(schema))
    jobs.run_available(jobs.quarter_rollup(stream, customers), f"{folder}/out", f"{folder}/ck")
    got = {r["qi"]: (int(r["cents"]), r["n_orders"]) for r in jobs.read_updates(spark, f"{folder}/out", ["MARKET_SEGMENT", "qi"]).collect()}
    assert got == {8096: (1125, 2), 8097: (200, 1)}
