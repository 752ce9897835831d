"""Every registered query against DuckDB on the smallest tables, and the lifecycle as a whole."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelcast.catalog import all_oracles, all_queries
from panelcast.catalog import stages as S
from panelcast.config import SELECT_COLUMNS, load_config, segment_settings
from panelcast.plans import lifecycle as L
from tools.check import compare

QUERIES, ORACLES = all_queries(), all_oracles()  # those of optional subpackages have tests of their own


@pytest.fixture(scope="session")
def con(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    line, good = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert good, line


def test_entry(spark):
    df = entry.entry(spark)
    assert df.groupBy("PARTITION_COLUMN").count().filter("count > 1").count() == 0
    assert {"PARTITION_COLUMN", "MODEL_USED", "HORIZON_MAPE"} <= set(df.columns)


def test_split_covers_all_rows(spark, sf_dir):
    rows = S.split_panel(spark, sf_dir)
    per = rows.groupBy("PARTITION_COLUMN").agg(F.count_if(F.col("split") == "test").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    assert per.filter("t <> 6 or v <> 2").count() == 0
    assert rows.count() == S.panel(spark, sf_dir).count()


def test_panel_grain_is_unique(spark, sf_dir):
    assert S.panel_all(spark, sf_dir).groupBy("VERSION", "PARTITION_COLUMN", "QUARTER").count().filter("count > 1").count() == 0


def test_lifecycle_end_to_end(spark, sf_dir):
    table = S.panel_all(spark, sf_dir).drop("PARTITION_COLUMN")
    panel = L.load_panel(table, [*SELECT_COLUMNS, "BRAND"], impute=True)
    clean, report = L.gate(panel)
    assert clean.select("PARTITION_COLUMN").distinct().count() + report.count() == panel.select("PARTITION_COLUMN").distinct().count()
    models = L.train(clean, {"RIDGE": ["SELLIN_MINUS3_MONTH", "SR_MINUS3_MONTH"]})
    assert models.filter("error is null and coefficients is null").count() == 0
    forecasts = S.forecasts(spark, sf_dir)
    metrics, best = L.evaluate(forecasts)
    assert best.groupBy("PARTITION_COLUMN").count().filter("count > 1").count() == 0
    published = L.run_inference(forecasts, best, F.lit(S.NOW).cast("timestamp_ntz"), "t", "V_3")
    assert published.select("PARTITION_COLUMN").distinct().count() == best.count()
    records = L.monitor(S.predictions_all(spark, sf_dir), S.panel(spark, sf_dir), best, S.model_results(spark, sf_dir), F.lit(S.NOW).cast("timestamp_ntz"), "V_3")
    assert records.filter("check_type = 'model_staleness'").count() > 0
    assert L.diagnose(panel.withColumn("BB", F.col("BB_RAW"))).count() == 1


def test_config_file_overlays_defaults(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("segments:\n  X:\n    models: [ridge]\nQUALITY_GATES:\n  MAX_CHAMPION_MAPE: 50\n")
    config = load_config(str(path))
    assert segment_settings(config, "X")["models"] == ["ridge"] and segment_settings(config, "X")["PREFERRED_MODEL"] == "PROPHET"
    assert config["QUALITY_GATES"] == {"MAX_CHAMPION_MAPE": 50, "MIN_CHAMPION_MAPE": 1.0}
    assert segment_settings(config, "Y")["models"][0] == "prophet"


def test_panel_sums_with_a_huge_order_and_a_huge_customer(spark, tmp_path):
    """One order holds a third of the lines, one customer a third of the orders."""
    import datetime as dt

    import numpy as np
    import pandas as pd

    from panelcast.sources.panel import base_quarters

    rng = np.random.default_rng(4)
    n_orders, n_lines = 3000, 12000
    orders = pd.DataFrame(
        {
            "o_orderkey": np.arange(n_orders),
            "o_custkey": np.where(rng.random(n_orders) < 0.34, 0, rng.integers(0, 50, n_orders)),
            "o_totalprice": rng.uniform(1, 500000, n_orders).round(2),
            "o_orderdate": [dt.datetime(1995, 1, 1) + dt.timedelta(days=int(x)) for x in rng.integers(0, 2400, n_orders)],
        }
    )
    lines = pd.DataFrame(
        {
            "l_orderkey": np.where(rng.random(n_lines) < 0.34, 7, rng.integers(0, n_orders, n_lines)),
            "l_extendedprice": rng.uniform(1, 100000, n_lines).round(2),
            "l_discount": rng.integers(0, 11, n_lines) / 100,
            "l_tax": rng.integers(0, 9, n_lines) / 100,
        }
    )
    customers = pd.DataFrame({"c_custkey": np.arange(50), "c_mktsegment": [f"S{i % 3}" for i in range(50)], "c_nationkey": np.arange(50) % 4})
    for name, frame in (("orders", orders), ("lineitem", lines), ("customer", customers)):
        spark.createDataFrame(frame).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = base_quarters(spark, str(tmp_path)).toPandas().set_index(["MARKET_SEGMENT", "BRAND", "qi"])

    lines["sr"] = lines.l_extendedprice * (1 - lines.l_discount) * (1 + lines.l_tax)
    per_order = lines.groupby("l_orderkey")["sr"].sum()
    orders["sr"] = orders.o_orderkey.map(per_order).fillna(0)
    orders["qi"] = orders.o_orderdate.dt.year * 4 + orders.o_orderdate.dt.quarter - 1
    joined = orders.merge(customers, left_on="o_custkey", right_on="c_custkey")
    joined["BRAND"] = joined.c_nationkey.astype(str)
    want = joined.groupby(["c_mktsegment", "BRAND", "qi"])[["o_totalprice", "sr"]].sum()
    for key, row in want.iterrows():
        assert abs(got.loc[key, "BB"] - row["o_totalprice"]) < 1e-3 and abs(got.loc[key, "SR"] - row["sr"]) < 1e-2
    assert abs(got["BB"].sum() - want["o_totalprice"].sum()) < 1e-2
