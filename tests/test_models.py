"""Fits against numpy on the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import explain as E
from panelcast.operators import models as M

XS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    rows = []
    for p in range(12):
        beta = rng.normal(size=3)
        for i in range(26):
            x = rng.normal(100, 20, 3)
            y = 500 + x @ beta + rng.normal(0, 1)
            rows.append((f"p{p}", i, *x, y, "train" if i < 18 else "val" if i < 20 else "test"))
    return pd.DataFrame(rows, columns=["PARTITION_COLUMN", "i", *XS, "BB", "split"])


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    b = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() - x.mean(0) @ b, b


def test_ridge_matches_normal_equations(spark, data):
    got = {r["PARTITION_COLUMN"]: r for r in M.fit_ridge(spark.createDataFrame(data), ["PARTITION_COLUMN"], XS, alpha=3.0).collect()}
    for p, g in data[data["split"] == "train"].groupby("PARTITION_COLUMN"):
        a, b = ridge(g[XS].to_numpy(), g["BB"].to_numpy(), 3.0)
        assert np.allclose(got[p]["coefficients"], b, rtol=1e-8) and abs(got[p]["intercept"] - a) < 1e-6
        residual = g["BB"] - a - g[XS].to_numpy() @ b
        assert abs(got[p]["sse"] - (residual**2).sum()) < 1e-6


def test_short_and_singular_series_do_not_raise(spark):
    rows = [("short", 1.0, 2.0, 1.0), ("short", 2.0, 4.0, 2.0)] + [("same", 1.0, 1.0, float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, x1 double, x2 double, BB double").withColumn("split", F.lit("train"))
    got = {r["PARTITION_COLUMN"]: r for r in M.fit_ridge(df, ["PARTITION_COLUMN"], ["x1", "x2"], alpha=0.0).collect()}
    assert got["short"]["coefficients"] is None and "Insufficient" in got["short"]["error"]
    assert got["same"]["coefficients"] == [0.0, 0.0] and got["same"]["intercept"] == 3.5


def test_scoring_is_the_dot_product(spark, data):
    df = spark.createDataFrame(data)
    fits = M.fit_ridge(df, ["PARTITION_COLUMN"], XS)
    payload = {r["PARTITION_COLUMN"]: (r["intercept"], r["coefficients"]) for r in fits.collect()}
    for r in M.score_models(df, fits, ["PARTITION_COLUMN"], XS).collect():
        a, b = payload[r["PARTITION_COLUMN"]]
        assert abs(r["BILLING_PREDICTED"] - max(0.0, a + sum(w * r[x] for w, x in zip(b, XS)))) < 1e-6


def test_dispatch_equals_single_fits_and_marks_skipped(spark, data):
    df = spark.createDataFrame(data).withColumn("MARKET_SEGMENT", F.when(F.col("PARTITION_COLUMN") < "p2", "A").otherwise("B"))
    allowed = spark.createDataFrame([("A", "full"), ("A", "one"), ("B", "full")], "MARKET_SEGMENT string, model string")
    out = M.train_dispatch(df, ["PARTITION_COLUMN"], {"FULL": XS, "ONE": ["x2"]}, allowed=allowed).collect()
    assert len(out) == 24
    full = {r["PARTITION_COLUMN"]: r["coefficients"] for r in M.fit_ridge(df, ["PARTITION_COLUMN"], XS).collect()}
    for r in out:
        if r["MODEL_USED"] == "FULL":
            assert np.allclose(r["coefficients"], full[r["PARTITION_COLUMN"]], rtol=1e-9)
        else:
            assert (r["error"] == "SKIPPED") == (r["MARKET_SEGMENT"] == "B")
            assert (r["coefficients"] is None) == (r["error"] == "SKIPPED")


def test_grid_search_picks_the_lowest_validation_error(spark, data):
    alphas = [0.0, 1.0, 100.0, 1e4, 1e6]
    got = M.param_grid_search(spark.createDataFrame(data), ["PARTITION_COLUMN"], XS, alphas).filter("rank = 1").collect()
    for r in got:
        g = data[data["PARTITION_COLUMN"] == r["PARTITION_COLUMN"]]
        t, v = g[g["split"] == "train"], g[g["split"] == "val"]
        scores = []
        for alpha in alphas:
            a, b = ridge(t[XS].to_numpy(), t["BB"].to_numpy(), alpha)
            pred = np.maximum(a + v[XS].to_numpy() @ b, 0)
            scores.append((np.abs((v["BB"] - pred) / v["BB"]) * 100).mean())
        assert r["alpha"] == alphas[int(np.argmin(scores))] and abs(r["val_ape"] - min(scores)) < 1e-6


def test_grid_sample_is_seeded(spark, data):
    df = spark.createDataFrame(data)
    alphas = [float(i) for i in range(10)]
    runs = [sorted({r["alpha"] for r in M.param_grid_search(df, ["PARTITION_COLUMN"], XS, alphas, n_iter=4).collect()}) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 4


def test_feature_elimination_drops_the_noise(spark):
    rng = np.random.default_rng(8)
    rows = []
    for p in range(4):
        for i in range(24):
            x = rng.normal(size=4)
            y = 5 * x[0] - 3 * x[2] + rng.normal(0, 0.05) + (40 if i == 3 else 0)
            rows.append((f"p{p}", *map(float, x), float(y)))
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, a double, b double, c double, d double, BB double").withColumn("split", F.lit("train"))
    for r in M.select_features(df, ["PARTITION_COLUMN"], ["a", "b", "c", "d"], F.lit(2)).collect():
        assert r["selected"] == ["a", "c"] and sorted(r["dropped"]) == ["b", "d"]


def test_autoregression_recovers_the_process(spark):
    rng = np.random.default_rng(9)
    y = [50.0, 60.0]
    for _ in range(80):
        y.append(20 + 1.2 * y[-1] - 0.5 * y[-2] + rng.normal(0, 0.01))
    df = spark.createDataFrame([("p", i, float(v)) for i, v in enumerate(y)] + [("tiny", 0, 1.0), ("tiny", 1, 2.0)], "PARTITION_COLUMN string, t int, BB double")
    fits = {r["PARTITION_COLUMN"]: r for r in M.autoreg_select(df, ["PARTITION_COLUMN"], order_by="t").collect()}
    assert fits["p"]["ar_order"] >= 2 and fits["tiny"]["error"].startswith("Insufficient") and fits["tiny"]["coefficients"] is None
    fit = fits["p"]
    state = y[::-1]
    want = []
    for _ in range(3):
        nxt = fit["intercept"] + sum(c * s for c, s in zip(fit["coefficients"], state))
        want.append(nxt)
        state = [nxt, *state]
    best = M.autoreg_select(df, ["PARTITION_COLUMN"], order_by="t")
    got = M.autoreg_forecast(df, best, ["PARTITION_COLUMN"], 3, order_by="t").orderBy("step").collect()
    tiny = [r for r in got if r["PARTITION_COLUMN"] == "tiny"]
    assert [(r["step"], r["BILLING_PREDICTED"]) for r in tiny] == [(1, None), (2, None), (3, None)]
    got = [r for r in got if r["PARTITION_COLUMN"] == "p"]
    assert [r["step"] for r in got] == [1, 2, 3] and np.allclose([r["BILLING_PREDICTED"] for r in got], want, rtol=1e-9)


def test_pooled_models_predict(spark, data):
    df = spark.createDataFrame(data).withColumns({"MARKET_SEGMENT": F.lit("A"), "QUARTER": F.col("i").cast("string"), "QUARTER_PARSED": F.col("i")})
    rows = M.pooled_features(df, XS)
    model = M.fit_pooled_trees(rows, XS, "gbt", max_iter=3)
    assert model.transform(rows).filter("BILLING_PREDICTED is null").count() == 0
    seq, lagged = M.fit_pooled_sequence(df, ["PARTITION_COLUMN"])
    assert seq.transform(lagged).count() == 12 * 22


def test_permutation_uses_every_value_once(spark, data):
    df = spark.createDataFrame(data)
    by_buckets = [E.permute_features(df, ["x1", "x2"], ["PARTITION_COLUMN", "i"], buckets=b) for b in (1, 4, 1600)]
    rows = [sorted(map(tuple, o.collect())) for o in by_buckets]
    assert rows[0] == rows[1] == rows[2]  # the ring does not depend on how it is dealt out
    out = by_buckets[1]
    assert out.count() == len(data) * 3
    moved = out.filter("permuted = 'x1'")
    assert sorted(r["x1"] for r in moved.collect()) == sorted(data["x1"])
    assert sorted(r["x2"] for r in moved.collect()) == sorted(data["x2"])
    back = moved.alias("m").join(df.alias("d"), ["PARTITION_COLUMN", "i"]).filter(F.col("m.x1") == F.col("d.x1")).count()
    assert back == 0


def test_contributions_are_exact_for_a_line(spark):
    df = spark.createDataFrame([("p", float(i), 3.0 * i + 1) for i in range(10)], "PARTITION_COLUMN string, x double, BB double").withColumn("split", F.lit("train"))
    fits = M.univariate_fits(df, ["PARTITION_COLUMN"], ["x"])
    row = E.linear_contributions(df, fits, ["x"]).first()
    assert abs(row["mean_abs"] - 3.0 * np.abs(np.arange(10) - 4.5).mean()) < 1e-9


def test_score_keeps_series_without_a_fit(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "PARTITION_COLUMN string, x double")
    fits = spark.createDataFrame([("a", 1.0, [2.0])], "PARTITION_COLUMN string, intercept double, coefficients array<double>")
    got = {r["PARTITION_COLUMN"]: r["BILLING_PREDICTED"] for r in M.score_models(rows, fits, ["PARTITION_COLUMN"], ["x"]).collect()}
    assert got == {"a": 3.0, "b": None}


def test_explanation_marks_only_its_own_model(spark):
    fits = spark.createDataFrame([("p", "x", 2.0), ("q", "x", 3.0)], "PARTITION_COLUMN string, regressor string, coefficient double")
    shares = fits.withColumnRenamed("coefficient", "mean_abs")
    best = spark.createDataFrame([("p", "LINEAR", 5.0), ("q", "TREND", 4.0)], "PARTITION_COLUMN string, MODEL_USED string, HORIZON_MAPE double")
    got = {r["PARTITION_COLUMN"]: (r["is_champion"], r["mape"]) for r in E.explain_rows(shares, fits, best, "LINEAR").collect()}
    assert got == {"p": (True, 5.0), "q": (False, None)}


def test_fitted_rival_learns_up_to_the_origin_only(spark):
    rng = np.random.default_rng(12)
    rows = []
    for p in range(3):
        for i in range(24):
            x = rng.normal(size=2) * [1.0, 1e6]
            # after the origin the law changes; the fit must not see it
            y = 10 + 2 * x[0] + 3e-6 * x[1] if i < 16 else 1000.0
            rows.append((f"p{p}", f"{2000 + i // 4}Q{i % 4 + 1}", "2003Q4", float(x[0]), float(x[1]), float(y)))
    rows += [("short", f"2003Q{q}", "2003Q4", 1.0, float(q), 5.0) for q in (1, 2, 3)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, QUARTER string, ORIGIN_QUARTER string, a double, b double, BB double")
    fits = {r["PARTITION_COLUMN"]: r for r in M.ridge_to_origin(df, ["PARTITION_COLUMN"], ["a", "b"], alpha=0.1).collect()}
    assert fits["short"]["error"].startswith("Insufficient") and fits["short"]["coefficients"] is None
    for p in range(3):
        own = np.array([r[3:] for r in rows if r[0] == f"p{p}" and r[1] <= "2003Q4"])
        x, y = own[:, :2], own[:, 2]
        z = (x - x.mean(0)) / x.std(0)
        beta = np.linalg.solve(z.T @ z / len(z) + 0.1 * np.eye(2), z.T @ (y - y.mean()) / len(z)) / x.std(0)
        assert np.allclose(fits[f"p{p}"]["coefficients"], beta, rtol=1e-9)
    out = M.ridge_forecasts(df, ["PARTITION_COLUMN"], ["a", "b"])
    assert out.count() == len(rows) and out.filter("PARTITION_COLUMN = 'short' and RIDGE is not null").count() == 0
    assert out.filter("PARTITION_COLUMN <> 'short' and RIDGE is null").count() == 0
    long = M.coefficient_rows(M.ridge_to_origin(df, ["PARTITION_COLUMN"], ["a", "b"]), ["PARTITION_COLUMN"], ["a", "b"])
    assert long.count() == 6 and long.filter("regressor = 'a' and abs(x_mean) > 2").count() == 0


# ---- subsets of regressors, trends with changepoints


def test_each_series_is_fitted_on_its_own_regressors(spark, data):
    df = spark.createDataFrame(data).withColumn("MARKET_SEGMENT", F.when(F.col("PARTITION_COLUMN") < "p4", "a").otherwise("B"))
    chosen = {f"p{p}": [["x1", "x3"], ["x2"], ["x1", "x2", "x3"], []][p % 4] for p in range(11)}  # p11 has no choice of its own
    choice = spark.createDataFrame(list(chosen.items()), "PARTITION_COLUMN string, selected array<string>")
    usable = M.usable_regressors(df, ["PARTITION_COLUMN"], XS, "MARKET_SEGMENT", {"x3": ["A"], "x1": []})
    got = {r["PARTITION_COLUMN"]: r for r in M.fit_selected(df, ["PARTITION_COLUMN"], XS, [choice, usable], alpha=2.0).collect()}
    for p, g in data[data["split"] == "train"].groupby("PARTITION_COLUMN"):
        xs = [x for x in chosen.get(p, XS) if not (x == "x3" and p < "p4")]
        assert got[p]["features"] == xs and got[p]["error"] is None
        if xs:
            a, b = ridge(g[xs].to_numpy(), g["BB"].to_numpy(), 2.0)
        else:
            a, b = g["BB"].mean(), []
        want = dict(zip(xs, b))
        assert np.allclose(got[p]["coefficients"], [want.get(x, 0.0) for x in XS], rtol=1e-8, atol=1e-12) and abs(got[p]["intercept"] - a) < 1e-6
        residual = g["BB"] - a - g[XS].to_numpy() @ [want.get(x, 0.0) for x in XS]
        assert abs(got[p]["sse"] - (residual**2).sum()) < 1e-5


def test_strongest_regressors_by_correlation(spark, data):
    rows = data.assign(x2=data["x2"].where(data["PARTITION_COLUMN"] != "p1", 7.0))
    stats = M.covariance_stats(M.training_rows(spark.createDataFrame(rows), XS, "BB"), ["PARTITION_COLUMN"], XS, "BB")
    got = {r["PARTITION_COLUMN"]: r["selected"] for r in M.strongest_regressors(stats, ["PARTITION_COLUMN"], XS, 2).collect()}
    for p, g in rows[rows["split"] == "train"].groupby("PARTITION_COLUMN"):
        strength = {x: abs(np.corrcoef(g[x], g["BB"])[0, 1]) for x in XS if g[x].min() < g[x].max()}
        assert got[p] == sorted(strength, key=lambda x: -strength[x])[:2]


def quarters(n, first=2010):
    return [(f"{first + i // 4}-Q{i % 4 + 1}", pd.Timestamp(f"{first + i // 4}-{3 * (i % 4) + 1:02d}-01").date()) for i in range(n)]


def planted(spark, make, n=40, test=6):
    rows = []
    for p, f in make.items():
        for i, (quarter, day) in enumerate(quarters(n)):
            rows.append((p, quarter, day, float(f(i)), "train" if i < n - test else "test"))
    return spark.createDataFrame(rows, "PARTITION_COLUMN string, QUARTER string, QUARTER_PARSED date, BB double, split string")


SEASON = [0.0, 30.0, -20.0, 10.0]


def error_of(scored, split="test"):
    rows = scored.filter(F.col("split") == split).groupBy("PARTITION_COLUMN").agg(F.avg(F.abs(F.col("BB") - F.col("BILLING_PREDICTED"))).alias("e"))
    return {r["PARTITION_COLUMN"]: r["e"] for r in rows.collect()}


def test_trend_finds_planted_changepoints(spark):
    bend = lambda i: 1000 + 20 * i - 45 * max(0, i - 11) + 40 * max(0, i - 22) + SEASON[i % 4]
    df = planted(spark, {"bent": bend, "straight": lambda i: 500 + 8 * i + SEASON[i % 4], "flat": lambda i: 70.0})
    key = ["PARTITION_COLUMN"]
    errors = {}
    for n in (0, 12):
        fits, rows, xs = M.fit_trend_seasonal(df, key, [], changepoints=n, changepoint_prior=5.0, alpha=1e-7)
        errors[n] = error_of(M.score_trend(rows, fits, key, xs))
    assert errors[12]["bent"] < 10 < 60 < errors[0]["bent"]
    assert errors[12]["straight"] < 3 and errors[0]["straight"] < 3 and errors[12]["flat"] < 1e-6
    mean4 = np.mean([abs(bend(i) - np.mean([bend(j) for j in range(30, 34)])) for i in range(34, 40)])
    assert errors[12]["bent"] < mean4
    # a small prior holds the trend straight
    fits, rows, xs = M.fit_trend_seasonal(df, key, [], changepoints=12, changepoint_prior=1e-12, alpha=1e-7)
    assert abs(error_of(M.score_trend(rows, fits, key, xs))["bent"] - errors[0]["bent"]) < 1


def test_multiplicative_season_and_saturating_growth(spark):
    key = ["PARTITION_COLUMN"]
    df = planted(spark, {"times": lambda i: 100 * 1.05**i * (1 + SEASON[i % 4] / 100), "grown": lambda i: 1000 / (1 + np.exp(-(i - 20) / 4))})
    df = df.withColumns({"cap": F.lit(1000.0), "floor": F.lit(0.0)})
    got = {}
    for season, growth in (("additive", "linear"), ("multiplicative", "linear"), ("additive", "logistic")):
        fits, rows, xs = M.fit_trend_seasonal(df, key, [], season=season, growth=growth, changepoints=2, alpha=1e-6)
        scored = M.score_trend(rows, fits, key, xs, season, growth)
        got[season, growth] = error_of(scored)
        if growth == "logistic":
            assert scored.agg(F.max("BILLING_PREDICTED")).first()[0] <= 1000
    assert got["multiplicative", "linear"]["times"] < 5 < got["additive", "linear"]["times"]
    assert got["additive", "logistic"]["grown"] < 10 < got["additive", "linear"]["grown"]
    with pytest.raises(ValueError):
        M.fit_trend_seasonal(df, key, [], season="none")


def test_no_cap_above_the_floor_is_an_error_row(spark):
    df = planted(spark, {"none": lambda i: float(i)}).withColumns({"cap": F.lit(0.0), "floor": F.lit(0.0)})
    fits, rows, xs = M.fit_trend_seasonal(df, ["PARTITION_COLUMN"], [], growth="logistic")
    scored = M.score_trend(rows, fits, ["PARTITION_COLUMN"], xs, growth="logistic")
    assert scored.count() == 40 and scored.filter("BILLING_PREDICTED is not null").count() == 0


def test_fitted_rivals_compete(spark, data):
    from panelcast.plans import lifecycle as L

    days = {i: q for i, q in enumerate(quarters(26))}
    rows = data.assign(QUARTER=[days[i][0] for i in data["i"]], QUARTER_PARSED=[days[i][1] for i in data["i"]], MARKET_SEGMENT="MOBILE", SELLIN=data["x1"], BB=data["BB"].abs())
    config = L.DEFAULTS | {"EXCLUDE_SELLIN_PROPHET": ["MOBILE"], "EXCLUDE_SELLIN_XGBOOST": []}
    rivals = L.fitted_rivals(spark.createDataFrame(rows), ["PARTITION_COLUMN"], config, ["SELLIN", "x2", "x3"])
    got = rivals.toPandas()
    assert got.groupby("MODEL_USED").size().to_dict() == dict.fromkeys(["RIDGE", "RIDGE_SELECTED", "TREND_ADDITIVE", "TREND_MULTIPLICATIVE", "TREND_SATURATING"], len(rows))
    assert got["error"].isna().all() and got["BILLING_PREDICTED"].notna().all()
    assert all("SELLIN" not in f for f in got[got["MODEL_USED"] == "TREND_ADDITIVE"]["features"]) and all("SELLIN" in f for f in got[got["MODEL_USED"] == "RIDGE"]["features"])
    val = got[got["split"] == "val"].assign(ape=lambda g: 100 * (g["BB"] - g["BILLING_PREDICTED"]).abs() / g["BB"]).groupby(["PARTITION_COLUMN", "MODEL_USED"])["ape"].mean().reset_index()
    best = {r["PARTITION_COLUMN"]: r for r in L.rival_champions(rivals, ["PARTITION_COLUMN"]).collect()}
    for p, g in val.groupby("PARTITION_COLUMN"):
        assert best[p]["MODEL_USED"] == g.sort_values("ape")["MODEL_USED"].iloc[0]


def test_ridge_of_nearly_equal_regressors_keeps_the_penalty():
    x = np.array([[12663.8275, 10131.062]] * 4 + [[98420.9075, 88867.788]])
    y = np.array([50655.31] * 4 + [393683.63])
    dx, dy = x - x.mean(0), y - y.mean()
    beta = M._solve((dx.T @ dx / 5 + np.eye(2) / 5)[None], (dx.T @ dy / 5)[None])[0]
    # by exact fractions
    assert beta == pytest.approx([2.17040374, 1.99272742], rel=1e-4)
    assert y.mean() - beta @ x.mean(0) == pytest.approx(2981.2464, abs=0.05)
