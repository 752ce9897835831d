"""Nothing is lost to fixed calendars, prefixes, unknown settings, stale caches or machine-local folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast import session
from panelcast.catalog import stages as S
from panelcast.operators import horizon as H
from panelcast.plans import lifecycle as L
from panelcast.sources import panel, sinks, tables
from panelcast.streaming import jobs


def write_orders(spark, folder, dates, mode="error"):
    rows = [(i, 1, 10.0 * (i + 1), d) for i, d in enumerate(dates)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.mode(mode).parquet(f"{folder}/orders.parquet")
    lines = [(i, 5.0, 0.1, 0.02) for i in range(len(dates))]
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_discount double, l_tax double").write.mode(mode).parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "A", 3)], "c_custkey long, c_mktsegment string, c_nationkey long").write.mode(mode).parquet(f"{folder}/customer.parquet")


def test_calendar_follows_the_orders(spark, tmp_path):
    dates = [dt.datetime(1990, 2, 1), dt.datetime(1998, 5, 1), dt.datetime(2010, 8, 1), dt.datetime(2010, 11, 1)]
    write_orders(spark, str(tmp_path), dates)
    base = panel.base_quarters(spark, str(tmp_path))
    assert base.agg(F.sum("BB")).first()[0] == 100.0
    ends = base.agg(F.min("qi"), F.max("qi"), F.max("newest_qi")).first()
    assert ends[0] == 1990 * 4 and ends[2] == 2010 * 4 + 2 and ends[1] == ends[2] + 3
    rows = panel.horizon_panel(spark, str(tmp_path))
    assert rows.filter("VERSION = 'V_3'").agg(F.max("BB_VERSION")).first()[0] == "2010Q3M1"
    # each known amount after the first year is in the newest snapshot
    known = rows.filter("VERSION = 'V_3' and BB > 0").select("QUARTER").distinct().collect()
    assert {r[0] for r in known} == {"1998Q2", "2010Q3"}


def test_panel_is_reduced_to_series_where_orders_meet_lines(spark, tmp_path):
    """No aggregate or shuffle of sums by customer: orders know their series before they meet their lines."""
    day = dt.datetime(2001, 2, 1)
    orders = [(1, 1, 10.0, day), (2, 1, 4e16, day), (3, 2, 7e16, day), (4, 9, 5.0, day), (5, None, 5.0, day)]
    lines = [(1, 5.0, 0.1, 0.02), (1, 7.0, 0.0, 0.0), (3, 1.0, 0.5, 0.0), (4, 8.0, 0.0, 0.0), (77, 9.0, 0.0, 0.0)]
    customers = [(1, "A", 3), (2, "A", 3), (3, "B", 1)]  # order 4 has an unknown customer
    folder = str(tmp_path)
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string, c_nationkey long").write.parquet(f"{folder}/customer.parquet")
    base = panel.base_quarters(spark, folder)
    plan = base._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda words: [line.index(words[0]) for line in plan if all(w in line for w in words)]
    assert not depth(["Aggregate [", "o_custkey"]) and not depth(["Aggregate [", "l_orderkey"])
    series, lined, owned = depth(["Aggregate [", "MARKET_SEGMENT", "qi"]), depth(["Join Inner", "l_orderkey"]), depth(["Join Inner", "c_custkey"])
    assert lined[0] < max(owned) and any(s < lined[0] for s in series)
    got = {(r.MARKET_SEGMENT, r.BRAND): r for r in base.filter("qi = 2001 * 4").collect()}
    assert set(got) == {("A", "3")}
    row = got["A", "3"]
    assert row.BB == float(4 * 10**18 + 7 * 10**18 + 1000) / 100  # beyond 64 bits in cents
    assert (row.MOF, row.SELLIN, row.SR) == (13.0, 12.0, 12.09)


def test_rewritten_tables_are_read_anew(spark, tmp_path):
    folder = str(tmp_path)
    write_orders(spark, folder, [dt.datetime(2001, 2, 1), dt.datetime(2004, 2, 1)])
    before = S.panel_all(spark, folder).agg(F.max("QUARTER")).first()[0]
    write_orders(spark, folder, [dt.datetime(2001, 2, 1), dt.datetime(2009, 2, 1)], "overwrite")
    after = S.panel_all(spark, folder).agg(F.max("QUARTER")).first()[0]
    assert before < "2005" and after > "2008"
    spark.read.parquet(f"{folder}/orders.parquet").withColumn("extra", F.lit(1)).write.parquet(f"{folder}/more.parquet")
    assert "extra" in tables.read_table(spark, folder, "more").columns
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").parquet(f"{folder}/more.parquet")
    assert tables.read_table(spark, folder, "more").columns == ["a"]


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Cluster:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        session.scratch_dir(Cluster, "x")
    Context.master = "local[4]"
    assert session.scratch_dir(Cluster, "x")


def test_append_merges_new_columns(spark):
    spark.sql("DROP TABLE IF EXISTS merged_rows")
    sinks.append_table(spark, spark.createDataFrame([(1, "x")], "a int, b string"), "merged_rows")
    sinks.append_table(spark, spark.createDataFrame([("y", 2, 0.5)], "b string, a long, c double"), "merged_rows")
    sinks.append_table(spark, spark.createDataFrame([(3,)], "a int"), "merged_rows")
    assert sorted(map(tuple, spark.table("merged_rows").select("a", "b", "c").collect())) == [(1, "x", None), (2, "y", 0.5), (3, None, None)]
    spark.sql("DROP TABLE merged_rows")


def test_every_segment_keeps_its_rows_in_the_legacy_forecast(spark, sf_dir):
    rows = S.split_panel(spark, sf_dir)
    segments = [r[0] for r in rows.select("MARKET_SEGMENT").distinct().orderBy("MARKET_SEGMENT").collect()]
    choices = ["PROPHET", "XGBOOST", "LIGHTGBM", "NO_SUCH_MODEL", None]
    params = spark.createDataFrame(list(zip(segments, choices)), "MARKET_SEGMENT string, preferred_model string")
    out = L.legacy_forecast(rows, params)
    per = {r["MARKET_SEGMENT"]: r for r in out.groupBy("MARKET_SEGMENT").agg(F.count("BILLING_PREDICTED").alias("n"), F.count("error").alias("e"), F.count("*").alias("all")).collect()}
    assert set(per) == set(segments)
    for segment, choice in zip(segments, choices):
        known = choice in ("PROPHET", "XGBOOST", "LIGHTGBM")
        assert (per[segment]["n"] > 0) == known and per[segment]["e"] == (0 if known else per[segment]["all"])


def test_origin_quarter_never_counts_in_window_errors(spark):
    rows = [("p", "m", f"2020Q{q}", k, 100.0, 100.0 if k else 1.0) for q, k in ((1, -1), (2, 0), (3, 1), (4, 2))]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MODEL_USED string, QUARTER string, k int, BILLING double, BILLING_PREDICTED double")
    windows = spark.createDataFrame([(0, "2020Q1", "2020Q4")], "BACKTEST_WINDOW int, WINDOW_START_QUARTER string, WINDOW_END_QUARTER string")
    got = H.evaluate_windows(df, windows, ["PARTITION_COLUMN", "MODEL_USED"]).first()
    assert got["MAPE"] == 0.0 and got["prediction_count"] == 3.0


def test_late_orders_join_a_stored_rollup_once(spark):
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"
    customers = spark.createDataFrame([(1, "A")], "c_custkey long, c_mktsegment string")
    first = spark.createDataFrame([(1, 1, 10.0, dt.datetime(2001, 1, 5)), (2, 1, 5.0, dt.datetime(2001, 4, 5))], schema)
    late = spark.createDataFrame([(1, 1, 10.0, dt.datetime(2001, 1, 5)), (3, 1, 2.0, dt.datetime(1999, 1, 5)), (3, 1, 2.0, dt.datetime(1999, 1, 5)), (4, 1, 1.0, dt.datetime(2001, 1, 6))], schema)
    got = jobs.merge_late(jobs._rolled_up(first, customers), late, first, customers)
    assert sorted((r["qi"], int(r["cents"]), r["n_orders"]) for r in got.collect()) == [(7996, 200, 1), (8004, 1100, 2), (8005, 500, 1)]


def test_rollup_state_is_bounded_and_an_empty_stream_gives_an_empty_table(spark, tmp_path):
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"
    customers = spark.createDataFrame([(1, "A")], "c_custkey long, c_mktsegment string")
    src = str(tmp_path / "src")
    spark.createDataFrame([], schema).write.parquet(src)
    frame = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.run_available(jobs.quarter_rollup(frame, customers), str(tmp_path / "none"), str(tmp_path / "c0"))
    assert jobs.read_updates(spark, str(tmp_path / "none"), ["MARKET_SEGMENT", "qi"]).collect() == []
    for year in range(1995, 2005):
        rows = [(year * 100 + i, 1, 1.0, dt.datetime(year, 1 + i, 1)) for i in range(12)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    jobs.run_available(jobs.quarter_rollup(frame, customers), str(tmp_path / "out"), str(tmp_path / "c1"))
    rows = jobs.read_updates(spark, str(tmp_path / "out"), ["MARKET_SEGMENT", "qi"]).collect()
    assert sum(r["n_orders"] for r in rows) <= 120


def test_rollup_over_batches_and_runs_loses_no_late_order(spark, tmp_path):
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"
    customers = spark.createDataFrame([(1, "A")], "c_custkey long, c_mktsegment string")
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "checkpoint"))

    def arrive(*years):
        for year in years:
            rows = [(year * 100 + i, 1, 1.25, dt.datetime(year, 1 + i, 1)) for i in range(12)] + [(7, 1, 1.25, dt.datetime(2000, 1, 1)), (None, 1, 1.25, dt.datetime(2000, 1, 1))]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        frame = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
        return {r["qi"]: (int(r["cents"]), r["n_orders"]) for r in jobs.rollup_available(frame, customers, out, checkpoint).collect()}

    def whole(*years):
        # the orders with key 7 and without a key come in every file and count once
        return {4 * y + q: (375, 3) if (y, q) != (2000, 0) else (625, 5) for y in years for q in range(4)}

    assert arrive(2004, 2000, 1997) == whole(2004, 2000, 1997)
    assert arrive(1995, 2003) == whole(2004, 2000, 1997, 1995, 2003)
    assert arrive() == whole(2004, 2000, 1997, 1995, 2003)


def test_a_threshold_of_the_file_changes_the_result(spark, sf_dir, tmp_path):
    from panelcast.config import load_config

    path = tmp_path / "c.yaml"
    path.write_text(
        "QUALITY_GATES:\n  MAX_CHAMPION_MAPE: 12\nMONITORING:\n  STALENESS:\n    MAX_MODEL_AGE_DAYS: 3\nDATA_QUALITY:\n  MIN_TRAIN_PERIODS: 14\n"
        "PREDICTION_SANITY_CHECKS:\n  EXTREME_APE_THRESHOLD: 5\nEVALUATION:\n  BACKTEST:\n    stability_penalty: 5.0\n"
    )
    strict = load_config(str(path))
    forecasts, panel_rows = S.forecasts(spark, sf_dir), S.clean(spark, sf_dir)
    best = L.evaluate(forecasts)[1]
    other = L.evaluate(forecasts, config=strict)[1]
    assert best.agg(F.sum("selection_score")).first()[0] < other.agg(F.sum("selection_score")).first()[0]
    assert L.implausible_champions(best).filter("gate_reason = 'above_max'").count() < L.implausible_champions(best, strict).filter("gate_reason = 'above_max'").count()
    assert L.gate(panel_rows)[1].count() < L.gate(panel_rows, strict)[1].count()
    now = F.lit(S.NOW).cast("timestamp_ntz")
    published = L.run_inference(forecasts, best, now, "t", "V_3")
    assert L.check_predictions(published).count() < L.check_predictions(published, strict).count()
    args = (S.predictions_all(spark, sf_dir), S.panel(spark, sf_dir), best, S.model_results(spark, sf_dir), now, "V_3")
    stale = [L.monitor(*args, config=c).filter("check_type = 'model_staleness' and is_alert").count() for c in (load_config(), strict)]
    assert stale[0] < stale[1]
    assert {"INDICATOR_MOF_REFERENCED", "DIRECTIONAL_CORRECTNESS_SR_REFERENCED"} <= set(published.columns)


def test_champions_without_a_prediction_are_findings(spark):
    schema = "PARTITION_COLUMN string, MODEL_USED string, k int, BILLING_PREDICTED double"
    forecasts = spark.createDataFrame([("a", "RIDGE", 1, None), ("b", "RIDGE", 1, 2.0), ("c", "RIDGE", 0, 2.0)], schema)
    best = spark.createDataFrame([("a", "RIDGE"), ("b", "RIDGE"), ("c", "RIDGE")], "PARTITION_COLUMN string, MODEL_USED string")
    assert sorted(r["partition"] for r in L.failed_champions(forecasts, best).collect()) == ["a", "c"]
