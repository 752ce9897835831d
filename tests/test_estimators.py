"""Families fitted from whole series, against plain versions that fit one series at a time."""

import itertools
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import estimators as S
from panelcast.operators import models as M

XS = ["x1", "x2", "x3"]
KEY = ["PARTITION_COLUMN"]


def label(i):
    return f"{1995 + i // 4}Q{i % 4 + 1}"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    rows = []
    for p in range(14):
        beta, level = rng.normal(size=3), 500.0
        for i in range(26 + p % 3):
            x = np.round(rng.normal(100, 20, 3), 0)
            level = 0.6 * level + 200 + rng.normal(0, 15)
            n = 18 + p % 3
            rows.append((f"p{p:02}", "A" if p < 4 else "B", label(i), *x, float(max(level + x @ beta, 1)), "train" if i < n else "val" if i < n + 2 else "test"))
    rows += [("short", "B", label(i), 1.0, 2.0, 3.0, 5.0, "train" if i < 3 else "val") for i in range(5)]
    return pd.DataFrame(rows, columns=["PARTITION_COLUMN", "MARKET_SEGMENT", "QUARTER", *XS, "BB", "split"])


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data)


def block_of(data):
    groups = [g for p, g in data.groupby("PARTITION_COLUMN") if p != "short"]
    role = {"train": S.TRAIN, "val": S.VAL, "test": S.OTHER}
    rows = [[[i, role[r.split], r.BB, r.x1, r.x2, r.x3] for i, r in enumerate(g.itertuples())] for g in groups]
    return groups, S._block(rows, 6)


def test_grid_is_sampled_without_being_built():
    small = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert S.sample_grid(small) == [dict(zip(small, v)) for v in itertools.product(*small.values())]
    assert S.Family("boosted", XS, S.TREE_GRID).combinations() == 192_000 and S.Family("trend", XS, S.TREND_GRID).combinations() == 160
    runs = [S.sample_grid(S.TREE_GRID, 50) for _ in range(2)]
    assert runs[0] == runs[1] != S.sample_grid(S.TREE_GRID, 50, seed=7)
    assert len({json.dumps(s) for s in runs[0]}) == 50 and all(s[k] in v for s in runs[0] for k, v in S.TREE_GRID.items())
    huge = {str(i): list(range(100)) for i in range(9)}
    assert len(S.sample_grid(huge, 3)) == 3
    with pytest.raises(ValueError):
        S.Family("ridge", XS, {"depth": [1]}).settings()


def test_ridge_leaderboard_equals_the_moment_solver(df):
    alphas = [0.0, 1.0, 100.0, 1e4]
    want = {(r["PARTITION_COLUMN"], r["alpha"]): r for r in M.param_grid_search(df, KEY, XS, alphas).collect()}
    got = S.grid_leaderboard(df, KEY, S.Family("ridge", XS, {"alpha": alphas}, metric="ape")).collect()
    for r in got:
        if r["PARTITION_COLUMN"] == "short":
            assert r["error"] == "Insufficient training data: 3 rows" and r["val_mae"] is None and r["failures"] == 4
            continue
        w = want[r["PARTITION_COLUMN"], json.loads(r["params"])["alpha"]]
        assert r["rank"] == w["rank"] and abs(r["val_ape"] - w["val_ape"]) < 1e-6 and abs(r["val_mae"] - w["val_mae"]) < 1e-6
    assert len(got) == 15 * 4


def plain_trees(x, y, use, check, n_estimators, learning_rate, max_depth, min_child_weight, reg_lambda, reg_alpha):
    """One series, recursion over nodes, every threshold tried."""
    shrink = lambda g: np.sign(g) * max(abs(g) - reg_alpha, 0)
    score = lambda g: shrink(g.sum()) ** 2 / max(len(g) + reg_lambda, 1e-12)

    def grow(rows, grad, depth, out):
        mine = rows[use[rows]]
        best = None
        if depth < max_depth:
            for f in range(x.shape[1]):
                values = np.unique(x[mine, f])
                for a, b in zip(values, values[1:]):
                    left = x[mine, f] <= a
                    if min(left.sum(), (~left).sum()) < min_child_weight:
                        continue
                    gain = round(score(grad[mine][left]) + score(grad[mine][~left]) - score(grad[mine]), 9)
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, f, (a + b) / 2)
        if best is None:
            out[rows] = shrink(grad[mine].sum()) / max(len(mine) + reg_lambda, 1e-12)
            return
        right = x[rows, best[1]] > best[2]
        grow(rows[~right], grad, depth + 1, out)
        grow(rows[right], grad, depth + 1, out)

    made = np.full(len(y), y[use].mean())
    kept, lowest, since, best = 0, np.abs(made - y)[check].sum(), 0, made.copy()
    for tree in range(1, n_estimators + 1):
        out = np.zeros(len(y))
        grow(np.arange(len(y)), y - made, 0, out)
        made = made + learning_rate * out
        now = np.abs(made - y)[check].sum()
        if now < lowest - 1e-9:
            kept, lowest, since, best = tree, now, 0, made.copy()
        else:
            since += 1
        if since >= 5:
            break
    return best, kept


@pytest.mark.parametrize("setting", [(8, 0.3, 2, 3, 0.0, 0.0), (12, 0.2, 4, 1, 1.0, 0.5), (5, 0.5, 8, 2, 5.0, 0.0)])
def test_trees_equal_recursive_trees(data, setting):
    names = ["n_estimators", "learning_rate", "max_depth", "min_child_weight", "reg_lambda", "reg_alpha"]
    groups, block = block_of(data)
    made, report = S.boosted(block, **dict(zip(names, setting)), subsample=1.0, colsample_bytree=1.0)
    for i, g in enumerate(groups):
        use, check = (g["split"] == "train").to_numpy(), (g["split"] == "val").to_numpy()
        want, kept = plain_trees(g[XS].to_numpy(), g["BB"].to_numpy(), use, check, *setting)
        assert report[i]["trees"] == kept and np.allclose(made[i, : len(g)], want, rtol=1e-8)


def test_samples_of_trees_do_not_depend_on_the_block(data):
    groups, block = block_of(data)
    whole, _ = S.boosted(block, subsample=0.6, colsample_bytree=0.5)
    alone, _ = S.boosted(S.Block(*(a[3:4, : len(groups[3])] for a in block)), subsample=0.6, colsample_bytree=0.5)
    assert np.allclose(whole[3, : len(groups[3])], alone[0], rtol=1e-9)


def plain_kpss(z):
    n, e = len(z), z - z.mean()
    q = int(4 * (n / 100) ** 0.25)
    spread = (e @ e + 2 * sum((1 - j / (q + 1)) * (e[j:] @ e[:-j]) for j in range(1, q + 1))) / n
    return (np.cumsum(e) ** 2).sum() / n**2 / spread


def plain_autoregression(y, n_ahead, lags=(1, 2, 3, 4)):
    d = int(plain_kpss(y) > S.KPSS_LIMIT)
    z = np.diff(y) if d else y
    best = None
    for size in range(len(lags) + 1):
        for subset in itertools.combinations(lags, size):
            rows = np.arange(max(lags), len(z))
            design = np.column_stack([np.ones(len(rows)), *(z[rows - j] for j in subset)])
            beta = np.linalg.lstsq(design, z[rows], rcond=None)[0]
            n, p = len(rows), size
            aic = n * np.log(((z[rows] - design @ beta) ** 2).sum() / n) + 2 * (p + 1) + 2 * (p + 1) * (p + 2) / (n - p - 2)
            if best is None or aic < best[0] - 1e-8:
                best = (aic, subset, beta)
    state, level, out = list(z), y[-1], []
    for _ in range(n_ahead):
        value = best[2][0] + sum(b * state[-j] for b, j in zip(best[2][1:], best[1]))
        state.append(value)
        level = level + value if d else value
        out.append(level)
    return d, list(best[1]), out


def test_autoregression_equals_a_search_of_all_subsets(spark):
    rng = np.random.default_rng(3)
    series = {"walk": 400 + np.cumsum(rng.normal(4, 3, 40)), "pull": np.empty(40), "year": np.empty(40), "grow": 300 + 9.0 * np.arange(40) + rng.normal(0, 2, 40)}
    series["pull"][:2], series["year"][:4] = 50, [300, 200, 100, 250]
    for i in range(2, 40):
        series["pull"][i] = 20 + 0.6 * series["pull"][i - 1] + rng.normal(0, 3)
    for i in range(4, 40):
        series["year"][i] = 20 + 0.9 * series["year"][i - 4] + rng.normal(0, 4)
    rows = [(p, "A", label(i), float(v), "train" if i < 32 else "val" if i < 34 else "test") for p, ys in series.items() for i, v in enumerate(ys)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MARKET_SEGMENT string, QUARTER string, BB double, split string")
    trained = S.train_families(df, KEY, {"AUTO": S.Family("autoregression")})
    got = {r["PARTITION_COLUMN"]: r for r in trained.collect()}
    for p, ys in series.items():
        d, lags, ahead = plain_autoregression(ys[:32], 8)
        fit = json.loads(got[p]["fit"])
        assert (fit["difference"], fit["lags"]) == (d, lags)
        assert np.allclose(got[p]["forecasts"][32:], np.maximum(ahead, 0), rtol=1e-7)
        assert abs(got[p]["val_mae"] - np.abs(np.array(got[p]["forecasts"][32:34]) - ys[32:34]).mean()) < 1e-9
    assert json.loads(got["walk"]["fit"])["difference"] == 1 and json.loads(got["pull"]["fit"])["difference"] == 0
    assert 4 in json.loads(got["year"]["fit"])["lags"]


def test_second_difference_is_undone():
    y = np.array([[5.0 + 2 * i + 3 * i * i for i in range(30)]])
    role = np.where(np.arange(30) < 24, S.TRAIN, S.OTHER)[None, :]
    made, report = S.autoregression(S.Block(np.zeros((1, 30, 0)), y, np.arange(30)[None, :], role), max_difference=2)
    assert report[0]["difference"] == 2 and np.allclose(made[0, 24:], y[0, 24:], rtol=1e-6)


def test_trend_grid_finds_the_planted_form(spark):
    season = [1.0, 1.3, 0.8, 1.1]
    times = lambda i: 100 * 1.04**i * season[i % 4]
    bent = lambda i: 1000 + 20 * i - 60 * max(0, i - 12) + 10 * season[i % 4]
    rows = [(p, "A", label(i), float(f(i)), "train" if i < 32 else "val" if i < 34 else "test") for p, f in (("times", times), ("bent", bent)) for i in range(40)]
    df = spark.createDataFrame(rows, "PARTITION_COLUMN string, MARKET_SEGMENT string, QUARTER string, BB double, split string")
    board = S.grid_leaderboard(df, KEY, S.Family("trend", [], S.TREND_GRID, metric="ape"))
    assert board.count() == 320 and board.filter("combinations <> 160 or failures <> 0").count() == 0
    best = {r["PARTITION_COLUMN"]: json.loads(r["params"]) for r in board.filter("rank = 1").collect()}
    assert best["times"]["seasonality_mode"] == "multiplicative" and best["bent"]["changepoint_prior_scale"] >= 0.1
    trained = S.train_families(df, KEY, {"TREND": S.Family("trend", [], S.TREND_GRID, 50, "ape")}).collect()
    for r in trained:
        f = times if r["PARTITION_COLUMN"] == "times" else bent
        want = [f(i) for i in range(34, 40)]
        naive = np.abs(np.array(want) - np.mean([f(i) for i in range(28, 32)])).mean()
        assert r["tried"] == 50 and np.abs(np.array(r["forecasts"][34:]) - want).mean() < naive / 3


def test_families_compete_and_report_what_they_cannot_fit(spark, df, data):
    families = {
        "RIDGE": S.Family("ridge", XS, {"alpha": [0.1, 10.0]}), "TREND": S.Family("trend", ["x1"], S.TREND_GRID, 6, "ape"),
        "TREES": S.Family("boosted", XS, S.TREE_GRID, 4), "AUTO": S.Family("autoregression"),
    }
    allowed = spark.createDataFrame([("A", m) for m in families] + [("B", "ridge"), ("B", "Auto")], "MARKET_SEGMENT string, model string")
    trained = S.train_families(df, KEY, families, allowed=allowed)
    got = trained.toPandas()
    assert len(got) == 15 * 4
    assert set(got[got["error"] == "SKIPPED"]["MODEL_USED"]) == {"TREND", "TREES"} and set(got[got["error"] == "SKIPPED"]["MARKET_SEGMENT"]) == {"B"}
    short = got[(got["PARTITION_COLUMN"] == "short") & got["MODEL_USED"].isin(["RIDGE", "AUTO"])]
    assert list(short["error"]) == ["Insufficient training data: 3 rows"] * 2
    fine = got[got["error"].isna()]
    assert len(fine) == 4 * 4 + 10 * 2 and set(fine["estimator"]) == set(S.KERNELS)
    best = {r["PARTITION_COLUMN"]: r for r in S.family_champions(trained, KEY).collect()}
    for p, g in fine.groupby("PARTITION_COLUMN"):
        assert best[p]["MODEL_USED"] == g.sort_values("val_ape")["MODEL_USED"].iloc[0] and best[p]["competitors"] == len(g)
    assert "short" not in best
    long = S.family_forecasts(trained, KEY)
    assert long.count() == 4 * len(data)
    joined = long.filter("error is null").join(df, [*KEY, "QUARTER"]).filter("split = 'val'")
    ape = joined.groupBy(*KEY, "MODEL_USED").agg(F.avg(100 * F.abs(F.col("BB") - F.col("BILLING_PREDICTED")) / F.col("BB")).alias("e")).toPandas()
    both = ape.merge(fine, on=[*KEY, "MODEL_USED"])
    assert len(both) == len(fine) and np.allclose(both["e"], both["val_ape"], rtol=1e-9)


def test_edge_frames(spark, df):
    families = {"RIDGE": S.Family("ridge", XS), "TREES": S.Family("boosted", XS), "TREND": S.Family("trend", XS), "AUTO": S.Family("autoregression")}
    assert S.train_families(df.limit(0), KEY, families).count() == 0
    nothing = df.filter("PARTITION_COLUMN = 'p00'").withColumns({"BB": F.lit(None).cast("double"), "x1": F.lit(None).cast("double")})
    assert {r["error"] for r in S.train_families(nothing, KEY, families).collect()} == {"Insufficient training data: 0 rows"}
    same = df.filter("PARTITION_COLUMN = 'p00'").withColumns({"BB": F.lit(7.0), "x1": F.lit(None).cast("double"), "x2": F.lit(2.0), "_rows": F.lit(1)})
    for r in S.train_families(same, KEY, families).collect():
        assert r["error"] is None and np.allclose(r["forecasts"], 7.0, atol=1e-6) or r["MODEL_USED"] == "AUTO" and np.allclose(r["forecasts"][18:], 7.0)
    unchecked = df.filter("PARTITION_COLUMN = 'p00' and split <> 'val'")
    for r in S.train_families(unchecked, KEY, families).collect():
        assert r["error"] is None and r["val_mae"] is None
    nulls = df.withColumn("PARTITION_COLUMN", F.when(F.col("PARTITION_COLUMN") != "p00", F.col("PARTITION_COLUMN")))
    assert S.train_families(nulls, KEY, families).filter("PARTITION_COLUMN is null").count() == 4


def test_direct_sequence_equals_one_regression_a_step(df, data):
    fits, forecasts = S.direct_sequence(df, KEY, alpha=0.0)
    got = {(r["PARTITION_COLUMN"], r["step"]): r["BILLING_PREDICTED"] for r in forecasts.collect()}
    train = {p: g["BB"].to_numpy() for p, g in data[data["split"] == "train"].groupby("PARTITION_COLUMN")}
    for h in range(1, 7):
        design, target = [], []
        for y in train.values():
            z = y / y.mean()
            for i in range(3, len(z) - h):
                design.append([1, *z[i - 3 : i + 1][::-1]])
                target.append(z[i + h])
        beta = np.linalg.lstsq(np.array(design), np.array(target), rcond=None)[0]
        for p, y in train.items():
            if p == "short":
                assert got[p, h] is None
                continue
            z = y / y.mean()
            assert abs(got[p, h] - max(y.mean() * (beta @ [1, *z[-4:][::-1]]), 0)) < 1e-6 * y.mean()
    assert fits.count() == 6 and fits.filter("error is not null").count() == 0
