"""Fills, imputation, repair and row selection on small frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import clean as C
from panelcast.operators import windows as X
from panelcast.sources import tables


def series(spark, values, key="a", start=8000):
    from panelcast.functions.quarters import quarter_label, quarter_start

    rows = [(key, start + i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, qi int, BB double")
    return df.withColumns({"QUARTER": quarter_label("qi"), "QUARTER_PARSED": quarter_start("qi").cast("timestamp")})


def column(df, name, order="qi"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize(
    "values, filled",
    [
        ([0.0, 0.0, 5.0, 0.0, 7.0], [None, None, 5.0, 5.0, 7.0]),
        ([1.0, 2.0, 0.0, 0.0], [1.0, 2.0, 2.0, 2.0]),
        ([0.0, 0.0], [None, None]),
    ],
)
def test_forward_fill(spark, values, filled):
    out = C.ffill_target(series(spark, values), ["s"])
    assert column(out, "BB") == filled
    assert column(out, "BB_RAW") == [v or None for v in values]
    assert column(out, "is_actual") == [v != 0 for v in values]


def test_fill_needs_a_series_key(spark):
    with pytest.raises(ValueError):
        C.ffill_target(series(spark, [1.0]), [])


def test_fill_cascade(spark):
    out = C.fill_cascade(series(spark, [None, 2.0, None, 4.0, None]), ["BB"], ["s"])
    assert column(out, "BB") == [2.0, 2.0, 2.0, 4.0, 4.0]
    assert column(C.fill_cascade(series(spark, [None, None]), ["BB"], ["s"]), "BB") == [0.0, 0.0]


def test_imputation_inverts_moving_averages(spark):
    rng = np.random.default_rng(3)
    full = pd.Series(rng.uniform(50, 150, 16).round(2))
    shown = full.iloc[4:]
    df = series(spark, shown.tolist())
    averages = {n: full.rolling(n).mean().iloc[4:].tolist() for n in (2, 3, 4, 5)}
    # only the first row carries the true averages; the rest is noise to be replaced
    rows = [(8000 + i, *[averages[n][i] if i == 0 else -1.0 for n in (2, 3, 4, 5)]) for i in range(len(shown))]
    ma = spark.createDataFrame(rows, "qi int, " + ", ".join(f"BILLING_MOVING_AVERAGE_{n}Q double" for n in (2, 3, 4, 5)))
    out = C.impute_history_ma(df.join(ma, "qi"), ["s"])
    for n in (2, 3, 4, 5):
        assert np.allclose(column(out, f"BILLING_MOVING_AVERAGE_{n}Q"), averages[n], rtol=1e-12)


def test_imputation_skips_series_without_first_average_and_keeps_null_keys(spark):
    df = series(spark, [10.0, 20.0], None).withColumns(
        {f"BILLING_MOVING_AVERAGE_{n}Q": F.when(F.col("qi") > 8000, 1.0) for n in (2, 3, 4, 5)}
    )
    out = C.impute_history_ma(df, ["s"])
    assert out.count() == 2
    assert column(out, "BILLING_MOVING_AVERAGE_3Q") == [None, 1.0]


def test_adjust_regressors(spark):
    rows = [
        ("GAMING", 100.0, 5.0), ("GAMING", 100.0, 0.0), ("OTHER", 100.0, 0.0), ("OTHER", 100.0, 10.0),
        ("OTHER", 100.0, None), ("OTHER", None, 5.0), (None, 100.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "MARKET_SEGMENT string, m double, r double").coalesce(1)
    out = C.adjust_regressors(df, ["r"], "m")
    assert [x["r"] for x in out.collect()] == [100.0, 0.0, 100.0, 10.0, None, 5.0, 100.0]


def test_remove_unwanted_rows_decides_by_first_label(spark):
    rows = [("p", "2020Q1", "2020Q1M1"), ("p", "2020Q2", "2020Q1M1"), ("p", "2021Q2", "2020Q1M1"), ("p", "2021Q3", "2020Q1M1"), ("x", "2020Q1", "VER_X"), ("x", "2020Q2", "2020Q2M1")]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, QUARTER string, MOF_VERSION string")

    def left(h):
        return sorted((r[0], r[1]) for r in C.remove_unwanted_rows(df, max_horizon=h).collect())

    assert left(4) == [("p", "2020Q2"), ("x", "2020Q1"), ("x", "2020Q2")]
    assert left(5) == [("p", "2020Q2"), ("p", "2021Q2"), ("x", "2020Q1"), ("x", "2020Q2")]
    assert ("p", "2021Q3") in left(6) and ("p", "2020Q1") not in left(6)


def test_null_ape_only_when_asked(spark):
    df = spark.createDataFrame([(1.0, None)], "APE double, INDICATOR_MOF_REFERENCED string")
    assert C.null_ape_missing_indicator(df).first()["APE"] == 1.0
    assert C.null_ape_missing_indicator(df, columns=["INDICATOR_MOF_REFERENCED"]).first()["APE"] is None


def test_dedupe_first_with_a_hot_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).cast("int").alias("k"), (F.col("id") * 7 % 1000).alias("o"), F.col("id").alias("v"))
    out = C.dedupe_first(df, ["k"], ["o", "v"])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first()["v"] == 0


@pytest.mark.parametrize("n, v, p, expected", [(9, 2, 6, [1, 2, 6]), (8, 2, 6, [0, 2, 6]), (5, 1, 0, [4, 1, 0]), (4, 0, 0, [4, 0, 0])])
def test_split(spark, n, v, p, expected):
    df = series(spark, [1.0] * n).withColumns({"VERIFICATION_HORIZON": F.lit(float(v)), "PREDICTION_HORIZON": F.lit(float(p))})
    got = {r["split"]: r["count"] for r in X.split_train_val_test(df, ["s"]).groupBy("split").count().collect()}
    assert [got.get(s, 0) for s in ("train", "val", "test")] == expected
    error = X.min_rows_guard(df, ["s"]).first()["error"]
    assert (error is None) == (n >= v + p + 1)


def test_pseudo_validation_takes_last_train_row(spark):
    df = series(spark, [1.0, 2.0, 3.0, None, None]).withColumn("split", F.when(F.col("qi") < 8003, "train").otherwise("val"))
    assert column(X.pseudo_validation(df, ["s"]), "split") == ["train", "train", "val"]
    single = df.filter("qi = 8000 or qi > 8002")
    assert column(X.pseudo_validation(single, ["s"]), "split") == ["train"]


def test_prefix_until_indicator(spark):
    df = series(spark, [1.0, 2.0, 3.0]).withColumns(
        {"A": F.col("qi") == 8000, "B": F.when(F.col("qi") == 8001, " Q+2 "), "C": F.lit(False), "PARTITION_COLUMN": F.col("s")}
    )
    names = {"Q+1": "A", "Q+2": "B", "Q+3": "C", "Q+4": "MISSING"}
    got = X.prefix_until_indicator(df, names).groupBy("PARTITION_HORIZON").count().collect()
    assert {r[0]: r[1] for r in got} == {"a_Q+2": 1, "a_Q+3": 3, "a_Q+4": 3}
    got = X.prefix_until_indicator(df, names, include_cut_row=True).groupBy("PARTITION_HORIZON").count().collect()
    assert {r[0]: r[1] for r in got} == {"a_Q+1": 1, "a_Q+2": 2, "a_Q+3": 3, "a_Q+4": 3}


def test_backtest_windows(spark):
    df = series(spark, [1.0] * 23)
    got = X.backtest_windows(df, 20, stride=1).orderBy("BACKTEST_WINDOW").collect()
    quarters = column(df, "QUARTER")
    assert len(got) == 12
    assert (got[0][1], got[0][2]) == (quarters[17], quarters[22])
    assert (got[11][1], got[11][2]) == (quarters[6], quarters[11])


def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([("V_9", 1), ("V_10", 2), ("bad", 3), (None, 4)], "VERSION string, x int")
    assert [r["x"] for r in tables.scan_latest_version(df).collect()] == [2]
    assert tables.next_version_label(df, "VERSION").first()[0] == "V_11"
    assert tables.next_version_label(df.limit(0), "VERSION").first()[0] == "V_1"
    assert tables.next_version_label(df.limit(0), "VERSION", 0).first()[0] == "V_0"


def test_scenario_is_kept_only_if_usable(spark):
    good = [("2020Q1", "2020Q1M1", f"MOF_2020Q1M1_QUARTER_{i}") for i in range(5)]
    bad = [("2020Q1", "2020Q1M1", None)] * 30
    schema = "QUARTER string, MOF_VERSION string, SCENARIO string"
    built = tables.derive_scenario(spark.createDataFrame(bad + good, schema))  # a few usable labels do not speak for a large table
    assert built.filter("SCENARIO = 'MOF_2020Q1M1'").count() == 35
    kept = tables.derive_scenario(spark.createDataFrame(bad[:5] + good, schema))
    assert kept.filter("SCENARIO = 'MOF_2020Q1M1'").count() == 0
    assert tables.derive_scenario(spark.createDataFrame([], schema)).count() == 0


def test_moving_average_keeps_small_targets(spark):
    df = spark.createDataFrame([("p", 1, 0.001), ("p", 2, 0.003)], "PARTITION_COLUMN string, t int, BB double")
    got = C.moving_average(df, ["PARTITION_COLUMN"], "t").orderBy("t").collect()
    assert abs(got[1]["MA_2Q"] - 0.002) < 1e-12


def test_partition_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert tables.with_partition(df, ["x", "y", "z"]).first()["PARTITION_COLUMN"] == "a_c"


def test_infer_origin_for_masked_labels(spark):
    rows = [("VER_A", "2020Q3"), ("VER_A", "2021Q4"), ("2020Q1M1", "2021Q3"), (None, "2020Q1")]
    out = X.infer_origin_quarter(spark.createDataFrame(rows, "MOF_VERSION string, QUARTER string"))
    got = {(r["MOF_VERSION"], r["QUARTER"]): r["ORIGIN_QUARTER"] for r in out.collect()}
    assert got[("VER_A", "2020Q3")] == "2020Q2" and got[("2020Q1M1", "2021Q3")] == "2020Q1" and got[(None, "2020Q1")] == "2018Q3"
