"""Scalar functions on hand-made edges."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.functions import quarters as Q
from panelcast.functions import text as T
from panelcast.functions.stats import safe_corr, sample_kurtosis, sample_skewness


def values(df, name):
    return [r[name] for r in df.collect()]


def test_quarter_labels_in_all_shapes(spark):
    labels = ["2024Q1", "2024-q4", "2024 Q 2", "VER_X", None, "see 1999Q3M1"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, x string").orderBy("i")
    assert values(df.select(Q.add_quarters("x", 1).alias("y")), "y") == ["2024Q2", "2025Q1", "2024Q3", None, None, "1999Q4"]
    assert values(df.select(Q.add_quarters("x", -6).alias("y")), "y") == ["2022Q3", "2023Q2", "2022Q4", None, None, "1998Q1"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1900, 2100), st.integers(1, 4), st.integers(-40, 40)), min_size=1, max_size=30))
def test_adding_and_subtracting_quarters_returns(spark, rows):
    df = spark.createDataFrame([(f"{y}Q{q}", k) for y, q, k in rows], "x string, k int")
    back = df.select("x", Q.add_quarters(Q.add_quarters("x", F.col("k")), -F.col("k")).alias("y"), Q.quarter_diff(Q.add_quarters("x", F.col("k")), "x").alias("d"), "k")
    for r in back.collect():
        assert r["x"] == r["y"] and r["d"] == r["k"]


def test_origin_labels(spark):
    df = spark.createDataFrame([("2022Q4M1",), ("VER_XQ",), ("Q42022",), (None,)], "v string")
    assert values(df.select(Q.origin_quarter("v").alias("o")), "o")[:1] == ["2022Q4"]
    assert values(df.select(Q.origin_has_quarter("v").alias("o")), "o") == [True, False, False, False]
    assert values(df.select(Q.label_is_parseable("v").alias("o")), "o") == [True, False, False, False]


@pytest.mark.parametrize(
    "billing, signal, expected",
    [
        (80.0, 100.0, "LOW"), (79.9, 100.0, "VERY LOW"), (90.0, 100.0, "LOW"), (90.1, 100.0, "FLAT"), (109.9, 100.0, "FLAT"),
        (120.0, 100.0, "VERY HIGH"), (1.0, 0.0, None), (1.0, None, None), (None, 1.0, None), (float("nan"), 1.0, None), (1.0, float("nan"), None),
    ],
)
def test_indicator_limits(spark, billing, signal, expected):
    df = spark.createDataFrame([(billing, signal)], "b double, s double")
    assert df.select(M.indicator("b", "s").alias("i")).first()["i"] == expected


def test_distance_and_direction(spark):
    rows = [("VERY LOW", "LOW"), ("HIGH", "VERY LOW"), ("FLAT", "FLAT"), ("FLAT", "HIGH"), (None, "HIGH"), ("VERY HIGH", "HIGH")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    assert values(df.select(M.validation_distance("a", "b").alias("d")), "d") == [1.0, 3.0, 0.0, 1.0, None, 1.0]
    assert values(df.select(M.directional_correctness("a", "b").alias("d")), "d") == [1.0, 0.0, 1.0, 0.0, None, 1.0]


def test_errors_and_sign(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 1.0), (None, 1.0), (-50.0, -25.0), (10.0, None)], "a double, p double").coalesce(1)
    assert values(df.select(M.ape("a", "p").alias("e")), "e") == [10.0, None, None, 50.0, None]
    assert values(df.select(M.realized_ape("a", "p").alias("e")), "e") == [10.0, None, None, -50.0, None]
    assert values(df.select(M.clip_negative("a").alias("e")), "e") == [100.0, 0.0, None, 0.0, 10.0]


def test_valid_metric(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double").coalesce(1)
    assert values(df.select(M.is_valid_metric("x").alias("v")), "v") == [True, False, False]


def test_names_and_json(spark):
    df = spark.createDataFrame([("a/b c-d", '{"x": 1.5}'), ("x" * 45, ""), (None, None)], "s string, j string").coalesce(1)
    assert values(df.select(T.sanitize_name("s").alias("v")), "v")[0] == "A_B_C_D"
    assert values(df.select(T.clean_label("s").alias("v")), "v")[0] == "A_B_C_D"
    assert values(df.select(T.truncate_name("s").alias("v")), "v") == ["a/b c-d", "x" * 40 + "...", None]
    assert [r["v"] for r in df.select(T.parse_json_map("j").alias("v")).collect()][::2] == [{"x": 1.5}, {}]
    assert df.select(T.model_name("c", "s", "p", "s", F.lit("RIDGE")).alias("v")).first()["v"] == "c.s.p_A_B_C_D_ridge"


def test_correlation_of_constant_and_short_groups(spark):
    import pandas as pd

    rows = [("const", 1.0, float(i)) for i in range(4)] + [("one", 1.0, 2.0)] + [("gap", float(i), float(i * i)) for i in range(5)] + [("gap", 3.0, None)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    got = {r["g"]: r["c"] for r in df.groupBy("g").agg(safe_corr("a", "b").alias("c")).collect()}
    assert got["const"] is None and got["one"] is None
    assert math.isclose(got["gap"], pd.Series(range(5)).corr(pd.Series([i * i for i in range(5)])), rel_tol=1e-12)


def test_moments_are_bias_corrected(spark):
    import pandas as pd

    data = [1.0, 2.0, 2.5, 9.0, 4.0, 4.0, 30.0]
    row = spark.createDataFrame([(x,) for x in data], "x double").agg(sample_skewness("x").alias("s"), sample_kurtosis("x").alias("k")).first()
    assert math.isclose(row["s"], pd.Series(data).skew(), rel_tol=1e-12)
    assert math.isclose(row["k"], pd.Series(data).kurtosis(), rel_tol=1e-12)
