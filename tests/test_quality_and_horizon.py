"""Gates, horizon metrics, champions, ranks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelcast.operators import diagnose as D
from panelcast.operators import horizon as H
from panelcast.operators import quality as Q
from panelcast.operators.ranking import average_ranks, exact_quantiles


def test_dq_reasons_and_precedence(spark):
    def group(name, n, null_y=0, null_r=0, vh=2.0, ph=6.0, negative=0):
        out = []
        for i in range(n):
            y = None if i < null_y else (-1.0 if i < null_y + negative else 1.0)
            out.append((name, y, None if i < null_r else 1.0, 1.0, vh, ph))
        return out

    rows = group("clean", 20) + group("null_y", 20, null_y=2, null_r=1) + group("null_r", 20, null_r=3) + group("few", 5, ph=0.0, vh=0.0)
    rows += group("few_train", 13) + group("negative", 20, negative=5) + group("edge", 20, negative=4)
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, BB double, r double, r2 double, VERIFICATION_HORIZON double, PREDICTION_HORIZON double")
    profile = Q.dq_profile(df, regressors=["r2", "r"])
    report = {r[0]: r[1] for r in Q.dq_report(profile).collect()}
    assert report == {
        "null_y": "Null values in BB (2 nulls)",
        "null_r": "Null values in regressor r (3 nulls)",
        "few": "Only 5 periods (min: 6)",
        "few_train": "Only 5 training rows after split (val=2, pred=6, min: 6)",
    }
    assert [r[0] for r in Q.dq_negative_ratio(profile).collect()] == ["negative"]
    assert tuple(Q.dq_summary(profile, Q.dq_report(profile)).first()) == (7, 4, 3)


def test_sanity_edges(spark):
    rows = [("one", 5.0, 500.0, 1.0), ("flat", 5.0, 500.5, 0.0), ("flat", 5.0, 500.5, 0.0), ("neg", -1.0, None, None), ("neg", 2.0, None, None)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, BILLING_PREDICTED double, APE double, DIRECTIONAL_CORRECTNESS_MOF_REFERENCED double")
    got = {(r[0], r[1]) for r in Q.sanity_report(Q.sanity_checks(df)).select("PARTITION_COLUMN", "issue").collect()}
    assert got == {("flat", "flat"), ("flat", "extreme_ape"), ("flat", "low_direction"), ("neg", "negative")}


def test_direction_mean_is_pooled_over_signals(spark):
    rows = [("p", 1.0, 1.0, 0.0), ("p", 2.0, None, 0.0), ("p", 3.0, None, 0.0)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, BILLING_PREDICTED double, DIRECTIONAL_CORRECTNESS_A_REFERENCED double, DIRECTIONAL_CORRECTNESS_B_REFERENCED double")
    assert Q.sanity_checks(df.withColumn("APE", F.lit(1.0))).first()["mean_direction"] == 0.25


def test_champion_ties_and_empty_groups(spark):
    rows = [("p", "B", 2.0, 5.0), ("p", "A", 2.0 + 1e-13, 5.0), ("p", "Z", None, 5.0), ("q", "A", None, 5.0), ("r", "A", 1.0, 0.0), ("r", "B", 9.0, 1.0)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MODEL_USED string, BT_SELECTION_SCORE double, MAPE double")
    got = {r["PARTITION_COLUMN"]: r["MODEL_USED"] for r in H.select_champion(df).collect()}
    assert got == {"p": "A", "r": "B"}
    fallback = H.select_champion(df.withColumn("BT_SELECTION_SCORE", F.lit(None).cast("double")))
    assert {r["PARTITION_COLUMN"]: r["MODEL_USED"] for r in fallback.collect()} == {"p": "A", "q": "A", "r": "B"}


def test_backtest_aggregate_single_window_and_zero_mean(spark):
    cols = ["HORIZON_MAPE", "MAPE", "prediction_count", *[f"Q{h}_MAPE" for h in range(1, 7)]]
    rows = [("p", "A", 10.0), ("p", "A", 20.0), ("q", "A", 7.0), ("z", "A", 0.0), ("z", "A", 0.0)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MODEL_USED string, v double")
    df = df.select("PARTITION_COLUMN", "MODEL_USED", *[F.col("v").alias(c) for c in cols])
    got = {r["PARTITION_COLUMN"]: r for r in H.backtest_aggregate(df).collect()}
    cv = np.std([10, 20], ddof=1) / 15
    assert abs(got["p"]["BT_SELECTION_SCORE"] - 15 * (1 + 0.5 * cv)) < 1e-12
    assert got["q"]["BT_CV"] == 0.0 and got["q"]["BT_SELECTION_SCORE"] == 7.0
    assert got["z"]["BT_CV"] == 0.0


def test_backfill_only_where_unknown(spark):
    rows = [("a", "2020Q4", "V1", 2, 8.0), ("b", "2020Q4", "V0", 3, None), ("c", "2020Q4", "V0", 4, 0.0), ("d", "2020Q4", "V0", 3, 5.0), ("e", "2020Q4", "V0", 5, None), ("f", "2021Q1", "V0", 3, None)]
    df = spark.createDataFrame(rows, "id string, QUARTER string, MOF_VERSION string, k int, BILLING double").withColumn("MARKET_SEGMENT", F.lit("s"))
    got = {r["id"]: r["BILLING"] for r in H.backfill_from_q2(df).collect()}
    assert got == {"a": 8.0, "b": 8.0, "c": 8.0, "d": 5.0, "e": None, "f": None}


def test_horizon_mape_is_a_mean_of_means(spark):
    rows = [("p", 1, 100.0, 90.0), ("p", 1, 100.0, 70.0), ("p", 2, 100.0, 100.0), ("p", 3, None, 1.0)]
    df = spark.createDataFrame(rows, "p string, k int, BILLING double, BILLING_PREDICTED double")
    row = H.horizon_mape_wide(df, ["p"]).first()
    assert row["HORIZON_MAPE"] == 10.0 and row["Q3_MAPE"] is None


def test_quality_gate(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 1.0), ("c", 200.0), ("d", 200.1)], "p string, selection_score double")
    assert {(r[0], r[2]) for r in H.quality_gate_flags(df).collect()} == {("a", "below_min"), ("d", "above_max")}


def test_masking_skipped_without_horizon(spark):
    rows = [("p", float(v), 2.0 * 0 + ph, 100.0, 100.0, 50.0) for v, ph in [(3, 6.0), (1, 6.0), (-1, 6.0)]]
    schema = "PARTITION_COLUMN string, VERIFICATION_HORIZON double, PREDICTION_HORIZON double, BILLING double, BILLING_PREDICTED double, MOF double"
    df = spark.createDataFrame(rows, schema)
    out = {r["VERIFICATION_HORIZON"]: r for r in H.add_indicators(df, ["MOF"], ["PARTITION_COLUMN"]).collect()}
    assert out[3.0]["MOF"] is None and out[3.0]["INDICATOR_FORECASTED_MOF_REFERENCED"] is None
    assert out[-1.0]["INDICATOR_MOF_REFERENCED"] is None and out[-1.0]["INDICATOR_FORECASTED_MOF_REFERENCED"] == "VERY HIGH"
    assert out[1.0]["VALIDATION_DISTANCE_MOF_REFERENCED"] == 0.0
    unmasked = H.add_indicators(df.withColumn("PREDICTION_HORIZON", F.lit(0.0)), ["MOF"], ["PARTITION_COLUMN"])
    assert unmasked.filter("MOF is null").count() == 0


def test_ranks_and_quantiles_match_pandas_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(5000) < 0.34, 0.0, rng.lognormal(0, 3, 5000).round(2))
    pdf = pd.DataFrame({"g": np.where(np.arange(5000) % 5 == 0, "b", "a"), "x": x})
    df = spark.createDataFrame(pdf)
    ranks = {(r[0], r[1]): r[2] for r in average_ranks(df, "g", "x", 16).collect()}
    pdf["rank"] = pdf.groupby("g")["x"].rank()
    assert all(abs(ranks[(g, v)] - r) < 1e-9 for g, v, r in pdf.itertuples(index=False))
    probs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    for row in exact_quantiles(df, "g", "x", probs, 16).collect():
        want = pdf.loc[pdf["g"] == row["g"], "x"].quantile(probs).tolist()
        assert np.allclose([row[f"q_{i}"] for i in range(len(probs))], want, rtol=1e-12)


def test_spearman_and_pearson_match_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"PARTITION_COLUMN": "p", "QUARTER": [str(i) for i in range(400)], "a": rng.normal(size=400).round(1)})
    pdf["b"] = (np.exp(pdf["a"]) + rng.normal(size=400) * 0.2).round(2)
    pdf["c"] = 7.0
    df = spark.createDataFrame(pdf)
    s = {(r[0], r[1]): r[2] for r in D.spearman_matrix(df, ["a", "b", "c"]).collect()}
    p = {(r[0], r[1]): r[2] for r in D.pearson_matrix(df, ["a", "b", "c"]).collect()}
    assert abs(s[("a", "b")] - pdf["a"].rank().corr(pdf["b"].rank())) < 1e-9
    assert abs(p[("a", "b")] - pdf["a"].corr(pdf["b"])) < 1e-9
    assert s[("a", "c")] is None and p[("b", "c")] is None
