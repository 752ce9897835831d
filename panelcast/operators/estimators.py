"""Model families that need the rows of a series: piecewise trends, boosted trees, autoregressions and ridges, searched over grids.

A series has at most one row per calendar quarter, so its rows are one small array. Spark groups and deals out the series by key;
within a task a block of series is fitted together, every step of a kernel being one numpy operation over the block.
"""

from __future__ import annotations

import inspect
import itertools
import json
import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.quarters import quarter_index
from panelcast.operators.models import _solve, covariance_stats, solve_ridge

PAD, TRAIN, VAL, OTHER = 0, 1, 2, 3
BLOCK = 256  # series fitted together
KPSS_LIMIT = 0.463  # fixed value: 5 % point of the level-stationarity statistic


class Block(NamedTuple):
    """Series side by side: ``x`` (series, rows, regressors), the others (series, rows). Rows are in order of time, padding comes last."""

    x: np.ndarray
    y: np.ndarray
    t: np.ndarray
    role: np.ndarray


# --- kernels: (block, settings) -> forecasts of every row, and what to report of each series ------------


def _linear(design: np.ndarray, y: np.ndarray, use: np.ndarray, alpha: float, penalties: np.ndarray, relative: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ridge of every series on its rows ``use``: forecasts of all rows, coefficients. Columns without variance get no weight."""
    w = use.astype(float)
    n = np.maximum(w.sum(axis=1), 1.0)
    known = np.where(use, y, 0.0)
    mean_x, mean_y = np.einsum("srp,sr->sp", design, w) / n[:, None], known.sum(axis=1) / n
    dx, dy = (design - mean_x[:, None, :]) * w[:, :, None], (known - mean_y[:, None]) * w
    xx, xy = np.einsum("srp,srq->spq", dx, dx) / n[:, None, None], np.einsum("srp,sr->sp", dx, dy) / n[:, None]
    flat = np.diagonal(xx, axis1=1, axis2=2) <= (1e-10 * np.abs(mean_x)) ** 2
    xx[flat[:, :, None] | flat[:, None, :]] = 0.0
    spread = np.diagonal(xx, axis1=1, axis2=2) if relative else 1.0 / n[:, None]
    beta = _solve(xx + np.eye(xx.shape[1]) * (alpha * penalties * spread)[:, None, :], np.where(flat, 0.0, xy))
    return mean_y[:, None] + np.einsum("srp,sp->sr", design - mean_x[:, None, :], beta), beta


def ridge(block: Block, alpha: float = 1.0):
    """All regressors, penalty ``alpha`` on the sum of squares."""
    use = (block.role == TRAIN) & np.isfinite(block.y)
    fitted, beta = _linear(block.x, block.y, use, alpha, np.ones(block.x.shape[2]), relative=False)
    return fitted, [{"coefficients": b.tolist()} for b in beta]


def trend(
    block: Block, changepoint_prior_scale: float = 0.05, seasonality_prior_scale: float = 10.0, seasonality_mode: str = "additive", n_changepoints: int = 3,
    growth: str = "linear", changepoint_share: float = 0.8, cap_factor: float = 1.2, alpha: float = 1e-4,
):
    """Straight line with slope changes in the first share of the training range, quarters of the year and regressors.

    A penalty is in units of its feature's variance and divided by the prior scale of changes or season. A multiplicative season fits logarithms, ``logistic`` growth
    the log-odds below ``cap_factor`` times the largest training value.
    """
    if seasonality_mode not in ("additive", "multiplicative") or growth not in ("linear", "logistic"):
        raise ValueError(f"unknown season {seasonality_mode} or growth {growth}")
    use = (block.role == TRAIN) & np.isfinite(block.y)
    top = cap_factor * np.max(np.where(use, block.y, 0.0), axis=1, keepdims=True)
    y = block.y
    if growth == "logistic":
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.clip(block.y / np.where(top > 0, top, np.nan), 0.01, 0.99)
            y = np.log(share / (1 - share))
        use = use & np.isfinite(y)
    elif seasonality_mode == "multiplicative":
        y = np.log(np.maximum(block.y, 1.0))
    first = np.min(np.where(use, block.t, np.inf), axis=1, keepdims=True)
    first = np.where(np.isfinite(first), first, 0.0)
    span = np.maximum(np.max(np.where(use, block.t - first, 0.0), axis=1, keepdims=True), 1.0)
    u = (block.t - first) / span
    columns = [u] + [np.maximum(u - changepoint_share * j / n_changepoints, 0.0) for j in range(1, n_changepoints + 1)]
    columns += [(block.t % 4 == q).astype(float) for q in (1, 2, 3)]
    design = np.concatenate([np.stack(columns, axis=2), block.x], axis=2)
    penalties = np.ones(design.shape[2])
    penalties[1 : 1 + n_changepoints] = 1 / changepoint_prior_scale
    penalties[1 + n_changepoints : 4 + n_changepoints] = 1 / seasonality_prior_scale
    fitted, beta = _linear(design, y, use, alpha, penalties, relative=True)
    if growth == "logistic":
        fitted = np.where(top > 0, top / (1 + np.exp(-np.clip(fitted, -60, 60))), np.nan)
    elif seasonality_mode == "multiplicative":
        fitted = np.exp(np.minimum(fitted, 60.0))
    return fitted, [{"slopes": b[: 1 + n_changepoints].tolist()} for b in beta]


def _split_level(x: np.ndarray, node: np.ndarray, rank: np.ndarray, grad: np.ndarray, weight: np.ndarray, columns: np.ndarray, smallest: float, score: Callable):
    """Move every row one level down: left of the best threshold of its node, which is nowhere but left where no split gains."""
    s, r = node.shape
    sub = rank[:, columns, :]
    order = np.argsort(node[:, None, :] * (r + 1) + sub, axis=2, kind="stable")
    pick = lambda a: np.take_along_axis(np.broadcast_to(a[:, None, :], order.shape), order, axis=2)
    nodes, g, w, ranks = pick(node), pick(grad * weight), pick(weight), np.take_along_axis(sub, order, axis=2)
    new = np.ones(order.shape, dtype=bool)
    new[:, :, 1:] = nodes[:, :, 1:] != nodes[:, :, :-1]
    start = np.maximum.accumulate(np.where(new, np.arange(r), 0), axis=2)
    cells = node.max() + 1
    slot = np.arange(s)[:, None] * cells + node
    total_g, total_w = (np.bincount(slot.ravel(), v.ravel(), minlength=s * cells) for v in (grad * weight, weight))
    slots = np.arange(s)[:, None, None] * cells + nodes
    before = lambda v: (c := np.cumsum(v, axis=2)) - np.take_along_axis(c - v, start, axis=2)
    left_g, left_w = before(g), before(w)
    all_g, all_w = total_g[slots], total_w[slots]
    last = np.ones(order.shape, dtype=bool)
    last[:, :, :-1] = new[:, :, 1:] | (ranks[:, :, 1:] == ranks[:, :, :-1])
    able = ~last & (left_w >= smallest) & (all_w - left_w >= smallest)
    gain = np.where(able, score(left_g, left_w) + score(all_g - left_g, all_w - left_w) - score(all_g, all_w), 0.0)
    s_i, f_i, r_i = np.nonzero(gain > 1e-9)
    best_of, limit = np.full(s * cells, -1), np.zeros(s * cells)
    if len(s_i):
        at = slots[s_i, f_i, r_i]
        ranked = np.lexsort((r_i, f_i, -np.round(gain[s_i, f_i, r_i], 9), at))
        chosen = ranked[np.unique(at[ranked], return_index=True)[1]]
        feature = columns[f_i[chosen]]
        here, following = (order[s_i[chosen], f_i[chosen], r_i[chosen] + k] for k in (0, 1))
        best_of[at[chosen]] = feature
        limit[at[chosen]] = (x[s_i[chosen], here, feature] + x[s_i[chosen], following, feature]) / 2
    mine = best_of[slot]
    value = np.take_along_axis(x, np.maximum(mine, 0)[:, :, None], axis=2)[:, :, 0]
    right = (mine >= 0) & (value > limit[slot])
    _, packed = np.unique(2 * node + right, return_inverse=True)
    return packed.reshape(node.shape), bool((best_of >= 0).any())


def boosted(
    block: Block, n_estimators: int = 40, learning_rate: float = 0.1, max_depth: int = 4, min_child_weight: float = 3, reg_lambda: float = 0.0, reg_alpha: float = 0.0,
    subsample: float = 0.8, colsample_bytree: float = 0.8, early_stopping_rounds: int = 5, random_state: int = 42,
):
    """Boosted regression trees of squared error, a model of its own for each series, exact thresholds.

    The trees so far with the smallest validation error count; a series stops after ``early_stopping_rounds`` trees without a smaller one. Row and column samples
    are drawn by place, so they do not depend on how series are dealt out.
    """
    use = (block.role == TRAIN) & np.isfinite(block.y)
    check = (block.role == VAL) & np.isfinite(block.y)
    # rows that do not train come last in every order, so that thresholds lie between training rows
    values = np.where(use[:, None, :], np.swapaxes(block.x, 1, 2), np.inf)
    ordered = np.sort(values, axis=2)
    rises = np.concatenate([np.zeros((*ordered.shape[:2], 1), dtype=int), np.cumsum(ordered[:, :, 1:] != ordered[:, :, :-1], axis=2)], axis=2)
    rank = np.empty(values.shape, dtype=int)
    np.put_along_axis(rank, np.argsort(values, axis=2, kind="stable"), rises, axis=2)
    y = np.where(use | check, block.y, 0.0)
    shrink = lambda g: np.sign(g) * np.maximum(np.abs(g) - reg_alpha, 0.0)
    score = lambda g, w: shrink(g) ** 2 / np.maximum(w + reg_lambda, 1e-12)
    made = np.repeat((np.where(use, y, 0.0).sum(axis=1) / np.maximum(use.sum(axis=1), 1))[:, None], y.shape[1], axis=1)
    best, kept, since = made.copy(), np.zeros(len(y), dtype=int), np.zeros(len(y), dtype=int)
    watch = check.any(axis=1)
    lowest = np.abs((made - y) * check).sum(axis=1)
    rng = np.random.default_rng(random_state)
    n_columns = block.x.shape[2]
    on = np.arange(len(y))  # series that still grow; the others leave the arrays
    x = block.x
    for tree in range(1, n_estimators + 1):
        rows = np.random.default_rng((random_state, tree)).random(y.shape[1]) < subsample
        columns = np.sort(rng.permutation(n_columns)[: max(1, math.ceil(colsample_bytree * n_columns))])
        weight = (use & rows[None, :]).astype(float)
        node, grad = np.zeros(y.shape, dtype=int), y - made
        sampled = np.where(weight[:, None, :] > 0, rank, y.shape[1])
        for _ in range(max_depth):
            node, split = _split_level(x, node, sampled, grad, weight, columns, min_child_weight, score)
            if not split:
                break
        slot = np.arange(len(y))[:, None] * (node.max() + 1) + node
        size = len(y) * (node.max() + 1)
        g, w = (np.bincount(slot.ravel(), v.ravel(), minlength=size) for v in (grad * weight, weight))
        leaf = np.where(w > 0, shrink(g) / np.maximum(w + reg_lambda, 1e-12), 0.0)
        made = made + learning_rate * leaf[slot]
        now = np.abs((made - y) * check).sum(axis=1)
        better = ~watch | (now < lowest - 1e-9)
        best[on[better]], kept[on[better]] = made[better], tree
        lowest, since = np.where(better, now, lowest), np.where(better, 0, since + 1)
        stay = since < early_stopping_rounds
        if not stay.any():
            break
        if not stay.all():
            on, x, y, use, check, rank, made, watch, lowest, since = (a[stay] for a in (on, x, y, use, check, rank, made, watch, lowest, since))
    return best, [{"trees": int(k)} for k in kept]


def unit_root_statistic(z: np.ndarray, use: np.ndarray) -> np.ndarray:
    """KPSS statistic of level stationarity with Bartlett weights; 0 for constant or very short series."""
    n = np.maximum(use.sum(axis=1), 1)
    e = np.where(use, z - (np.where(use, z, 0.0).sum(axis=1) / n)[:, None], 0.0)
    reach = (4 * (n / 100) ** 0.25).astype(int)
    spread = (e**2).sum(axis=1) / n
    for j in range(1, min(int(reach.max()), e.shape[1] - 1) + 1):
        spread = spread + 2 * np.maximum(1 - j / (reach + 1), 0.0) * (e[:, j:] * e[:, :-j]).sum(axis=1) / n
    sums = (np.where(use, np.cumsum(e, axis=1), 0.0) ** 2).sum(axis=1) / n**2
    level = 1e-12 * np.maximum(np.max(np.abs(np.where(use, z, 0.0)), axis=1), 1.0) ** 2
    return np.where(spread > level, sums / np.maximum(spread, level), 0.0)


def _lagged(z: np.ndarray, lag: int) -> np.ndarray:
    out = np.full(z.shape, np.nan)
    out[:, lag:] = z[:, : z.shape[1] - lag]
    return out


def autoregression(block: Block, max_lag: int = 3, season: int = 4, max_difference: int = 1):
    """Autoregression on the best subset of lags 1..max_lag and the season's, after as many differences as the unit-root statistic asks for.

    One covariance matrix over all lags serves every subset; the smallest corrected AIC wins, ties go to fewer and shorter lags. Training rows get one-step fits, later
    rows are forecast recursively. Rows must be consecutive quarters.
    """
    train = (block.role == TRAIN) & np.isfinite(block.y)
    y = np.where(train, block.y, np.nan)
    levels = [y]
    for _ in range(max_difference):
        levels.append(levels[-1] - _lagged(levels[-1], 1))
    d, open_ = np.zeros(len(y), dtype=int), np.ones(len(y), dtype=bool)
    for i in range(max_difference):
        open_ &= unit_root_statistic(levels[i], np.isfinite(levels[i])) > KPSS_LIMIT
        d += open_
    z = np.stack(levels)[d, np.arange(len(y))]
    lags = sorted({*range(1, max_lag + 1), season})
    # differences end where training does; complete rows alone are fitted, the same for every subset
    table = np.stack([*(_lagged(z, j) for j in lags), z], axis=2)
    use = np.isfinite(table).all(axis=2)
    n = use.sum(axis=1)
    safe = np.where(use[:, :, None], table, 0.0)
    means = safe.sum(axis=1) / np.maximum(n, 1)[:, None]
    centred = (safe - means[:, None, :]) * use[:, :, None]
    cov = np.einsum("srp,srq->spq", centred, centred) / np.maximum(n, 1)[:, None, None]
    flat = np.diagonal(cov, axis1=1, axis2=2) <= (1e-10 * np.abs(means)) ** 2
    cov[flat[:, :, None] | flat[:, None, :]] = 0.0
    best, beta, chosen = np.full(len(y), np.inf), np.zeros((len(y), len(lags))), np.zeros(len(y), dtype=int)
    subsets = [c for size in range(len(lags) + 1) for c in itertools.combinations(range(len(lags)), size)]
    for i, subset in enumerate(subsets):
        at, p = list(subset), len(subset)
        found = np.zeros_like(beta)
        if p:
            found[:, at] = _solve(cov[:, at][:, :, at], cov[:, at, -1])
        sse = np.maximum(n * (cov[:, -1, -1] - np.einsum("sp,sp->s", found, cov[:, :-1, -1])), 1e-9)
        room = n - p - 2
        with np.errstate(divide="ignore", invalid="ignore"):
            aic = np.where(room > 0, n * np.log(sse / n) + 2 * (p + 1) + 2 * (p + 1) * (p + 2) / room, np.inf)
        better = np.round(aic, 9) < best
        best, beta, chosen = np.where(better, np.round(aic, 9), best), np.where(better[:, None], found, beta), np.where(better, i, chosen)
    fit = np.isfinite(best)
    start = means[:, -1] - np.einsum("sp,sp->s", beta, means[:, :-1])
    state, level, out = z.copy(), y.copy(), np.full(y.shape, np.nan)
    for r in range(y.shape[1]):
        value = start.copy()
        for k, lag in enumerate(lags):
            term = state[:, r - lag] if r >= lag else np.full(len(y), np.nan)
            value = value + np.where(beta[:, k] != 0, beta[:, k] * term, 0.0)
        whole = value.copy()
        for order in range(1, max_difference + 1):
            parts = [(-1) ** (j + 1) * math.comb(order, j) * (level[:, r - j] if r >= j else np.nan) for j in range(1, order + 1)]
            whole = np.where(d == order, value + sum(parts), whole)
        out[:, r] = np.where(fit & (block.role[:, r] != PAD), whole, np.nan)
        ahead = ~train[:, r]
        state[:, r], level[:, r] = np.where(ahead, value, state[:, r]), np.where(ahead, whole, level[:, r])
    return out, [{"difference": int(d[i]), "lags": [lags[j] for j in subsets[c]], "coefficients": [float(beta[i, j]) for j in subsets[c]]} for i, c in enumerate(chosen)]


KERNELS: dict[str, Callable] = {"ridge": ridge, "trend": trend, "boosted": boosted, "autoregression": autoregression}


# --- families and their grids --------------------------------------------------------------------------


@dataclass(frozen=True)
class Family:
    """An estimator, its regressors, a grid of settings of which ``n_iter`` are tried (0: all), and the validation error (``mae`` or ``ape``) that decides.

    ``excluded`` lists the segments that must not use a regressor; for their series it is constant, which no estimator uses.
    """

    estimator: str
    xs: Sequence[str] = ()
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    n_iter: int = 0
    metric: str = "mae"
    excluded: Mapping[str, Sequence[str]] = field(default_factory=dict)
    seed: int = 42

    def settings(self) -> list[dict]:
        known = set(inspect.signature(KERNELS[self.estimator]).parameters) - {"block"}
        if unknown := set(self.grid) - known:
            raise ValueError(f"{self.estimator} has no settings {sorted(unknown)}")
        return sample_grid(self.grid, self.n_iter, self.seed)

    def combinations(self) -> int:
        return math.prod(len(v) for v in self.grid.values())


# fixed values: settings that are searched by default
TREND_GRID = {
    "changepoint_prior_scale": [0.001, 0.005, 0.01, 0.1, 0.5],
    "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0],
    "seasonality_mode": ["additive", "multiplicative"],
    "n_changepoints": [2, 3, 5, 10],
}
TREE_GRID = {
    "n_estimators": [5, 10, 20, 40, 60, 100],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "max_depth": [2, 3, 4, 6, 8],
    "min_child_weight": [1, 3, 5, 7, 10],
    "reg_lambda": [0, 0.1, 1, 5, 10],
    "reg_alpha": [0, 0.1, 0.5, 1.0],
    "subsample": [0.4, 0.5, 0.6, 0.8],
    "colsample_bytree": [0.5, 0.7, 0.8, 0.9],
}
LEAF_GRID = {
    "n_estimators": [10, 20, 40, 60, 100],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "max_depth": [3, 4, 6, 10],
    "min_child_weight": [3, 5, 10, 20, 30],
    "reg_alpha": [0, 0.1, 1.0],
    "reg_lambda": [0, 0.1, 1.0, 5.0],
}
CAT_GRID = {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.05, 0.1], "max_depth": [2, 3, 4, 6], "reg_lambda": [1, 3, 5, 10], "min_child_weight": [1, 3, 5]}


def sample_grid(grid: Mapping[str, Sequence], n_iter: int = 0, seed: int = 42) -> list[dict]:
    """``n_iter`` different settings of a product grid (all where it has no more), drawn by number; the product is never built."""
    names, sizes = list(grid), [len(grid[k]) for k in grid]
    total = math.prod(sizes)
    numbers = range(total) if not 0 < n_iter < total else sorted(random.Random(seed).sample(range(total), n_iter))
    out = []
    for number in numbers:
        setting = {}
        for name, size in zip(reversed(names), reversed(sizes)):
            number, place = divmod(number, size)
            setting[name] = grid[name][place]
        out.append({name: setting[name] for name in names})
    return out


def packed_series(df: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str = "BB", split: str = "split", quarter: str = "QUARTER") -> DataFrame:
    """One row per series: ``_quarters`` and ``_rows`` (quarter number, role, target, regressors), in order of time; missing regressors are 0.

    The arrays are small but have much work behind them: after grouping they are dealt out over twice as many partitions as there are cores (at most
    ``spark.sql.shuffle.partitions``), which adaptive execution does not merge. They are dealt by a hash of the keys, so a retried task gets the same series.
    """
    role = F.when(F.col(split) == "train", float(TRAIN)).when(F.col(split) == "val", float(VAL)).otherwise(float(OTHER))
    number = F.coalesce(F.col(y).cast("double"), F.lit(float("nan")))
    numbers = F.array(quarter_index(quarter).cast("double"), role, number, *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)) for x in xs])
    row = F.struct(quarter_index(quarter).alias("i"), F.col(quarter).alias("q"), numbers.alias("v"))
    session = df.sparkSession
    parts = min(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * session.sparkContext.defaultParallelism)
    dated = df.filter(quarter_index(quarter).isNotNull()).select(*keys, row.alias("_r"))
    grouped = dated.groupBy(*keys).agg(F.sort_array(F.collect_list("_r")).alias("_r")).repartition(parts, F.xxhash64(*keys))
    return grouped.select(*keys, F.col("_r.q").alias("_quarters"), F.col("_r.v").alias("_rows"))


def _block(rows: Sequence, width: int) -> Block:
    tables = [np.array([list(v) for v in r], dtype=float).reshape(-1, width) for r in rows]
    longest = max(len(t) for t in tables)
    full = np.zeros((len(tables), longest, width))
    for i, t in enumerate(tables):
        full[i, : len(t)] = t
    return Block(full[:, :, 3:], full[:, :, 2], full[:, :, 0], full[:, :, 1].astype(int))


def _tried(block: Block, family: Family, settings: Sequence[dict]) -> Iterator[tuple]:
    """For each setting: forecasts, reports, validation MAE and APE, and which series it failed for."""
    check = (block.role == VAL) & np.isfinite(block.y)
    for setting in settings:
        try:
            made, report = KERNELS[family.estimator](block, **setting)
        except np.linalg.LinAlgError as e:
            made, report = np.full(block.y.shape, np.nan), [{"error": str(e)}] * len(block.y)
        made = np.maximum(made, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            off = np.where(check, np.abs(block.y - made), 0.0)
            share = check & (block.y != 0)
            mae = off.sum(axis=1) / check.sum(axis=1)
            ape = 100 * np.where(share, off / np.abs(block.y), 0.0).sum(axis=1) / share.sum(axis=1)
        failed = ~np.isfinite(np.where(block.role > TRAIN, made, 0.0)).all(axis=1)
        yield made, report, np.where(failed, np.nan, mae), np.where(failed, np.nan, ape), failed


def _blocks(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, Block]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.iloc[at : at + BLOCK].reset_index(drop=True)
            yield part, _block(part["_rows"], width)


def _number(value: float) -> float | None:
    return float(value) if np.isfinite(value) else None


def grid_leaderboard(df: DataFrame, keys: Sequence[str], family: Family, y: str = "BB", split: str = "split", quarter: str = "QUARTER", min_rows: int = 6) -> DataFrame:
    """Every series with every setting tried: ``params`` (JSON), validation errors, ``rank`` by the family's metric (ties by place in the grid), ``error``.

    Settings without a finite forecast and series with fewer than ``min_rows`` training rows are rows with an error; ``failures`` counts them per series. Null targets are not fitted,
    rows without a readable quarter are left out, an empty table gives no rows.
    """
    settings, xs = family.settings(), list(family.xs)
    packed = packed_series(df, keys, xs, y, split, quarter)
    schema = T.StructType(
        [packed.schema[c] for c in keys]
        + [T.StructField(c, t) for c, t in (("setting", T.IntegerType()), ("params", T.StringType()), ("n", T.LongType()), ("val_mae", T.DoubleType()), ("val_ape", T.DoubleType()))]
        + [T.StructField("rank", T.IntegerType()), T.StructField("combinations", T.LongType()), T.StructField("failures", T.IntegerType()), T.StructField("error", T.StringType())]
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block in _blocks(batches, 3 + len(xs)):
            n = ((block.role == TRAIN) & np.isfinite(block.y)).sum(axis=1)
            short = n < min_rows
            results = list(_tried(block, family, settings))
            mae, ape, failed = (np.stack([r[i] for r in results]) for i in (2, 3, 4))
            failed |= short[None, :]
            deciding = np.where(failed, np.inf, np.round(ape if family.metric == "ape" else mae, 9))
            ranks = np.argsort(np.argsort(np.where(np.isnan(deciding), np.inf, deciding), axis=0, kind="stable"), axis=0, kind="stable") + 1
            for i, setting in enumerate(settings):
                out = part[list(keys)].copy()
                out["setting"], out["params"], out["n"] = i, json.dumps(setting), n
                out["val_mae"] = [None if f else _number(v) for v, f in zip(mae[i], failed[i])]
                out["val_ape"] = [None if f else _number(v) for v, f in zip(ape[i], failed[i])]
                out["rank"], out["combinations"], out["failures"] = ranks[i], family.combinations(), failed.sum(axis=0)
                out["error"] = [_error(c, s, f) for c, s, f in zip(n, short, failed[i])]
                yield out

    return packed.mapInPandas(search, schema)


def _error(n: int, short: bool, failed: bool) -> str | None:
    return f"Insufficient training data: {int(n)} rows" if short else "no finite forecast" if failed else None


def train_families(
    df: DataFrame, keys: Sequence[str], families: Mapping[str, Family], allowed: DataFrame | None = None, segment: str = "MARKET_SEGMENT",
    y: str = "BB", split: str = "split", quarter: str = "QUARTER", min_rows: int = 6,
) -> DataFrame:
    """All series x all families in one plan, the rows shuffled once and their arrays dealt out once, each family by its own estimator and over its own grid; one row each.

    The setting with the smallest validation error counts (ties by place in the grid; the first that works where there is nothing to validate on). ``tried`` and ``failures`` count settings,
    ``params`` and ``fit`` are JSON, ``_quarters`` and ``forecasts`` run in parallel over the rows of the series. ``allowed`` (segment, model) marks what is configured; the rest is SKIPPED and not
    fitted. A series that a family cannot fit has a row with an error.
    """
    union = list(dict.fromkeys(x for f in families.values() for x in f.xs))
    places = {m: [union.index(x) for x in f.xs] for m, f in families.items()}
    settings = {m: f.settings() for m, f in families.items()}
    groups = list(dict.fromkeys([*keys, segment]))
    packed = packed_series(df, groups, union, y, split, quarter)
    if allowed is None:
        packed = packed.withColumn("_models", F.array(*[F.lit(m) for m in families]))
    else:
        lists = allowed.groupBy(segment).agg(F.collect_set(F.upper("model")).alias("_models"))
        packed = packed.join(F.broadcast(lists), segment, "left")  # a row per configured segment.withColumn("_models", F.coalesce("_models", F.array().cast("array<string>")))
    text, real = T.StringType(), T.DoubleType()
    fields = [("MODEL_USED", text), ("estimator", text), ("n", T.LongType()), ("tried", T.IntegerType()), ("failures", T.IntegerType()), ("params", text), ("fit", text)]
    fields += [("val_mae", real), ("val_ape", real), ("error", text), ("_quarters", T.ArrayType(text)), ("forecasts", T.ArrayType(real))]
    schema = T.StructType([packed.schema[c] for c in groups] + [T.StructField(c, t) for c, t in fields])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block in _blocks(batches, 3 + len(union)):
            lengths = (block.role != PAD).sum(axis=1)
            n = ((block.role == TRAIN) & np.isfinite(block.y)).sum(axis=1)
            for model, family in families.items():
                out = part[groups].copy()
                out["MODEL_USED"], out["estimator"], out["n"] = model, family.estimator, n
                wanted = np.array([model.upper() in set(m) for m in part["_models"]])
                rows = np.flatnonzero(wanted & (n >= min_rows))
                x = block.x[rows][:, :, places[model]]
                for i, name in enumerate(family.xs):
                    barred = {v.upper() for v in family.excluded.get(name, ())}
                    x[[str(v).upper() in barred for v in part[segment].iloc[rows]], :, i] = 0.0
                found = _best(Block(x, block.y[rows], block.t[rows], block.role[rows]), family, settings[model]) if len(rows) else []
                results = dict(zip(rows.tolist(), found))
                nothing = (0, 0, None, None, None, None, None)
                cells = [results.get(i, nothing) for i in range(len(part))]
                for c, name in enumerate(["tried", "failures", "params", "fit", "val_mae", "val_ape"]):
                    out[name] = [cell[c] for cell in cells]
                made = [None if cell[6] is None else cell[6][:k] for cell, k in zip(cells, lengths)]
                out["error"] = [None if f is not None else _error(c, c < min_rows, True) if w else "SKIPPED" for f, c, w in zip(made, n, wanted)]
                out["_quarters"] = part["_quarters"]
                out["forecasts"] = [None if f is None else [_number(v) for v in f] for f in made]
                yield out

    return packed.mapInPandas(fit, schema)


def _best(block: Block, family: Family, settings: Sequence[dict]) -> list[tuple]:
    size = len(block.y)
    lowest, which, failures = np.full(size, np.inf), np.full(size, -1), np.zeros(size, dtype=int)
    kept: list[tuple] = [(len(settings), len(settings), None, None, None, None, None)] * size
    for i, (made, report, mae, ape, failed) in enumerate(_tried(block, family, settings)):
        failures += failed
        decides = np.round(ape if family.metric == "ape" else mae, 9)
        decides = np.where(np.isnan(decides), np.inf, decides)
        for s in np.flatnonzero(~failed & ((which < 0) | (decides < lowest))):
            which[s], lowest[s] = i, decides[s]
            kept[s] = (len(settings), 0, json.dumps(settings[i]), json.dumps(report[s]), _number(mae[s]), _number(ape[s]), made[s])
    return [(k[0], int(f), *k[2:]) for k, f in zip(kept, failures)]


def family_forecasts(trained: DataFrame, keys: Sequence[str], quarter: str = "QUARTER") -> DataFrame:
    """Forecasts of ``train_families`` in long form; a family without a fit keeps the quarters, without a forecast and with its error."""
    made = F.coalesce("forecasts", F.array_repeat(F.lit(None).cast("double"), F.size("_quarters")))
    pairs = trained.withColumn("_p", F.explode(F.arrays_zip(F.col("_quarters").alias("q"), made.alias("p"))))
    return pairs.select(*keys, "MODEL_USED", F.col("_p.q").alias(quarter), F.col("_p.p").alias("BILLING_PREDICTED"), "error")


def family_champions(trained: DataFrame, keys: Sequence[str], metric: str = "val_ape") -> DataFrame:
    """The family with the smallest validation error of each series, ties by name; a series without any fit has none."""
    able = trained.filter(F.col("error").isNull() & F.col(metric).isNotNull())
    row = F.struct("MODEL_USED", "estimator", "params", "fit", "val_mae", "val_ape")
    return able.groupBy(*keys).agg(F.min_by(row, F.struct(F.round(metric, 9), F.col("MODEL_USED"))).alias("_b"), F.count(F.lit(1)).alias("competitors")).select(*keys, "_b.*", "competitors")


# --- one direct multi-step model for all series ---------------------------------------------------------


def direct_sequence(
    df: DataFrame, keys: Sequence[str], horizon: int = 6, lookback: int = 4, alpha: float = 1e-6, y: str = "BB", split: str = "split", quarter: str = "QUARTER",
) -> tuple[DataFrame, DataFrame]:
    """A pooled regression for each step 1..horizon on the last ``lookback`` values, every series in units of its own training mean.

    Returns the fits (a row per ``step``) and the forecasts (keys, ``step``, ``scale``, BILLING_PREDICTED) from the end of training. Only moments are shuffled: one matrix per step. A series
    with fewer known values than ``lookback`` at the end of its training, or with a mean of 0 or less, has no forecast. Rows must be consecutive quarters.
    """
    lags, steps = [f"_lag{j}" for j in range(lookback)], range(1, horizon + 1)
    series = W.partitionBy(*keys)
    trained = df.filter(F.col(split) == "train").select(*keys, quarter_index(quarter).alias("_qi"), F.col(y).cast("double").alias("_y"))
    mean = F.avg("_y").over(series)
    rows = trained.withColumns({"scale": F.when(mean > 0, mean), "_last": F.max("_qi").over(series)})
    order = series.orderBy("_qi")
    rows = rows.withColumn("_z", F.col("_y") / F.col("scale"))
    rows = rows.withColumns({name: F.lag("_z", j).over(order) for j, name in enumerate(lags)} | {f"_to{h}": F.lead("_z", h).over(order) for h in steps})
    complete = rows.dropna(subset=lags)
    targets = F.explode(F.array(*[F.struct(F.lit(h).alias("step"), F.col(f"_to{h}").alias("_target")) for h in steps]))
    long = complete.select(*lags, targets.alias("_t")).select(*lags, "_t.*").filter(F.col("_target").isNotNull())
    fits = solve_ridge(covariance_stats(long, ["step"], lags, "_target"), ["step"], lookback, alpha, min_rows=lookback + 2)
    ends = rows.filter(F.col("_qi") == F.col("_last")).select(*keys, "scale", F.array(*lags).alias("_state"))
    usable = F.broadcast(fits.select("step", "intercept", "coefficients"))  # a row per step
    every = ends.withColumn("step", F.explode(F.array(*[F.lit(h) for h in steps]))).join(usable, "step", "left")
    value = F.aggregate(F.zip_with("_state", "coefficients", lambda a, b: a * b), F.col("intercept"), lambda acc, v: acc + v)
    return fits, every.select(*keys, "step", "scale", F.greatest(value * F.col("scale"), F.when(value.isNotNull(), F.lit(0.0))).alias("BILLING_PREDICTED"))
