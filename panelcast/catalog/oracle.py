"""DuckDB SQL for the stage frames, as named CTEs; ``oracle(sql)`` prepends those a query needs."""

from __future__ import annotations

import re

from panelcast.config import MOVING_AVERAGE_WINDOWS, REGRESSOR_COLUMNS


def qlabel(index: str) -> str:
    return f"(CAST(({index}) // 4 AS VARCHAR) || 'Q' || CAST(({index}) % 4 + 1 AS VARCHAR))"


def qindex(label: str) -> str:
    """Index of the first quarter in a label, NULL without one."""
    pattern = r"(\d{4})\s*[- ]?Q\s*([1-4])"
    return (
        f"(TRY_CAST(regexp_extract({label}, '{pattern}', 1, 'i') AS INTEGER) * 4"
        f" + TRY_CAST(regexp_extract({label}, '{pattern}', 2, 'i') AS INTEGER) - 1)"
    )


def cents(c: str) -> str:
    return f"CAST(floor({c} * 100 + 0.5) AS BIGINT)"


def ape(a: str, p: str) -> str:
    return f"(abs(({a} - {p}) / nullif({a}, 0)) * 100)"


def indicator(v: str, s: str) -> str:
    r = f"(({v} - {s}) / nullif({s}, 0))"
    return (
        f"CASE WHEN {r} IS NULL THEN NULL WHEN {r} < -0.2 THEN 'VERY LOW' WHEN {r} <= -0.1 THEN 'LOW'"
        f" WHEN {r} < 0.1 THEN 'FLAT' WHEN {r} < 0.2 THEN 'HIGH' ELSE 'VERY HIGH' END"
    )


def rank_of(label: str) -> str:
    return (
        f"CASE {label} WHEN 'VERY LOW' THEN 1 WHEN 'LOW' THEN 2 WHEN 'FLAT' THEN 3 WHEN 'HIGH' THEN 4"
        " WHEN 'VERY HIGH' THEN 5 END"
    )


def distance(a: str, b: str) -> str:
    return f"CAST(abs(({rank_of(a)}) - ({rank_of(b)})) AS DOUBLE)"


def direction(a: str, b: str) -> str:
    x, y = f"({rank_of(a)})", f"({rank_of(b)})"
    return (
        f"CASE WHEN {x} IS NULL OR {y} IS NULL THEN NULL"
        f" WHEN ({x} > 3 AND {y} > 3) OR ({x} <= 2 AND {y} <= 2) OR ({x} = 3 AND {y} = 3) THEN 1.0 ELSE 0.0 END"
    )


def corr(a: str, b: str) -> str:
    both = f"({a}) IS NOT NULL AND ({b}) IS NOT NULL"
    x, y = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return f"(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0))"


_MA = ", ".join(
    f"CAST(SUM({cents('BB')}) OVER (PARTITION BY MARKET_SEGMENT, BRAND ORDER BY qi ROWS {n - 1} PRECEDING) AS DOUBLE)"
    f" / (100.0 * {n}) AS MA_{n}"
    for n in MOVING_AVERAGE_WINDOWS
)
_OVER = "OVER (PARTITION BY MARKET_SEGMENT, BRAND ORDER BY qi)"
_LAGS = ", ".join(
    [f"lag({s}, {k}) {_OVER} AS {s}_LAG{k}" for s in ("MOF", "SELLIN", "SR") for k in (1, 4, 5)]
    + [f"lag(MA_{n}, {k}) {_OVER} AS MA_{n}_LAG{k}" for n in MOVING_AVERAGE_WINDOWS for k in (1, 2, 3)]
)


def _now(s: str) -> str:
    return f"CASE WHEN qi <= cutoff THEN {s} ELSE {s}_LAG4 END"


def _before(s: str) -> str:
    return f"CASE WHEN qi <= cutoff + 1 THEN {s}_LAG1 ELSE {s}_LAG5 END"


_AVERAGES = ", ".join(
    f"CASE WHEN qi <= cutoff THEN MA_{n} WHEN qi = cutoff + 1 THEN MA_{n}_LAG1 WHEN qi = cutoff + 2 THEN MA_{n}_LAG2"
    f" WHEN qi = cutoff + 3 THEN MA_{n}_LAG3 END AS BILLING_MOVING_AVERAGE_{n}Q"
    for n in MOVING_AVERAGE_WINDOWS
)

_TREND_SUMS = """
    count(y) OVER s AS n_, sum(x) OVER s AS sx, sum(x * x) OVER s AS sxx, sum(y) OVER s AS sy, sum(x * y) OVER s AS sxy"""

_SIGNALS = ["MOF", "MOF_PLUS_BUFFER", "SELLIN", "SR"]
_IND = ", ".join(
    f"{indicator('BILLING', s)} AS INDICATOR_{s}_REFERENCED, {indicator('BILLING_PREDICTED', s)} AS INDICATOR_FORECASTED_{s}_REFERENCED"
    for s in _SIGNALS
)
_MARKS = ", ".join(
    f"{distance(f'INDICATOR_{s}_REFERENCED', f'INDICATOR_FORECASTED_{s}_REFERENCED')} AS VALIDATION_DISTANCE_{s}_REFERENCED, "
    f"{direction(f'INDICATOR_{s}_REFERENCED', f'INDICATOR_FORECASTED_{s}_REFERENCED')} AS DIRECTIONAL_CORRECTNESS_{s}_REFERENCED"
    for s in _SIGNALS
)


def known(x: str) -> str:
    """NULL for what is not a number: DuckDB gives NaN for a fit on a constant regressor."""
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def mean_of(names: list[str]) -> str:
    total = " + ".join(f"coalesce({n}, 0)" for n in names)
    count = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in names)
    return f"(({total}) / nullif(({count}), 0))"


_XS = list(REGRESSOR_COLUMNS)
_N = len(_XS)
_ALPHA = 0.1


def _ridge_ctes() -> dict[str, str]:
    """Ridge on standardised regressors per series: moments, then Gauss-Jordan elimination, one step for each regressor."""
    pairs = [(i, j) for i in range(_N) for j in range(i + 1, _N)]
    moments = ", ".join(
        [f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}, covar_pop(x{i}, BB) AS y{i}" for i in range(_N)] + [f"covar_pop(x{i}, x{j}) AS c{i}_{j}" for i, j in pairs]
    )
    values = ", ".join(f"coalesce({x}, 0) AS x{i}" for i, x in enumerate(_XS))
    flat = ", ".join(f"v{i} <= (1e-10 * abs(m{i})) ** 2 AS z{i}" for i in range(_N))
    cells = [f"1.0::DOUBLE + CASE WHEN z{i} THEN 0 ELSE {_ALPHA} END AS a{i}_{i}, CASE WHEN z{i} THEN 0 ELSE y{i} / sqrt(v{i}) END AS b{i}" for i in range(_N)]
    for i, j in pairs:
        cells += [f"CASE WHEN z{i} OR z{j} THEN 0 ELSE c{i}_{j} / sqrt(v{i} * v{j}) END AS a{p}_{q}" for p, q in ((i, j), (j, i))]
    keep = "VERSION, PARTITION_COLUMN, n, my, " + ", ".join(f"m{i}, v{i}, z{i}" for i in range(_N))
    out = {
        "rg_moments": f"""
  SELECT VERSION, PARTITION_COLUMN, count(*) AS n, avg(BB) AS my, {moments}
  FROM (SELECT *, {values} FROM clean_all WHERE k <= 0 AND BB IS NOT NULL) GROUP BY ALL""",
        "rg_0": f"SELECT {keep}, {', '.join(cells)} FROM (SELECT *, {flat} FROM rg_moments)",
    }
    for s in range(_N):
        step = [f"b{i} - a{i}_{s} * b{s} / a{s}_{s} AS b{i}" if i != s else f"b{s}" for i in range(_N)]
        step += [f"a{i}_{j}" if i == s else f"0.0::DOUBLE AS a{i}_{j}" if j == s else f"a{i}_{j} - a{i}_{s} * a{s}_{j} / a{s}_{s} AS a{i}_{j}" for i in range(_N) for j in range(_N)]
        out[f"rg_{s + 1}"] = f"SELECT {keep}, {', '.join(step)} FROM rg_{s}"
    betas = ", ".join(f"CASE WHEN z{i} THEN 0 ELSE b{i} / a{i}_{i} / sqrt(v{i}) END AS beta{i}" for i in range(_N))
    level = " - ".join(["my", *(f"beta{i} * m{i}" for i in range(_N))])
    out["rg_fits"] = f"SELECT *, {level} AS intercept_ FROM (SELECT {keep}, {betas} FROM rg_{_N})"
    return out


_RIDGE = " + ".join(["r.intercept_", *(f"r.beta{i} * coalesce(w.{x}, 0)" for i, x in enumerate(_XS))])

_Q_MAPE = ", ".join(f"avg(CASE WHEN k = {h} THEN ape END) AS Q{h}_MAPE" for h in range(1, 7))
_HORIZON_MAPE = mean_of([f"Q{h}_MAPE" for h in range(1, 7)])

CTES: dict[str, str] = {
    "line_sums": f"""
  SELECT l_orderkey, sum({cents('l_extendedprice')}) AS mof,
         sum({cents('l_extendedprice')} * (100 - {cents('l_discount')})) AS sellin,
         sum({cents('l_extendedprice')} * (100 - {cents('l_discount')}) * (100 + {cents('l_tax')})) AS sr
  FROM lineitem GROUP BY l_orderkey""",
    "sums": f"""
  SELECT c_mktsegment AS MARKET_SEGMENT, CAST(c_nationkey AS VARCHAR) AS BRAND,
         year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS qi,
         sum({cents('o_totalprice')}) AS bb, sum(mof) AS mof, sum(sellin) AS sellin, sum(sr) AS sr
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN line_sums ON l_orderkey = o_orderkey
  GROUP BY ALL""",
    "cal": """
  SELECT min(year(o_orderdate) * 4 + quarter(o_orderdate) - 1) AS lo, max(year(o_orderdate) * 4 + quarter(o_orderdate) - 1) - 1 AS newest FROM orders""",
    "base": f"""
  SELECT s.MARKET_SEGMENT, s.BRAND, q.qi,
         coalesce(CAST(bb AS DOUBLE), 0) / 100.0 AS BB, coalesce(CAST(mof AS DOUBLE), 0) / 100.0 AS MOF,
         coalesce(CAST(sellin AS DOUBLE), 0) / 10000.0 AS SELLIN, coalesce(CAST(sr AS DOUBLE), 0) / 1000000.0 AS SR
  FROM (SELECT DISTINCT MARKET_SEGMENT, BRAND FROM sums) s
  CROSS JOIN (SELECT CAST(unnest(range(lo, newest + 4)) AS INTEGER) AS qi FROM cal) q
  LEFT JOIN sums ON sums.MARKET_SEGMENT = s.MARKET_SEGMENT AND sums.BRAND = s.BRAND AND sums.qi = q.qi""",
    "base_ma": f"SELECT *, {_MA} FROM base",
    "base_lags": f"SELECT *, {_LAGS} FROM base_ma",
    "scen": """
  SELECT VERSION, CAST(newest - back AS INTEGER) AS cutoff, CAST(newest - back - off AS INTEGER) AS origin
  FROM cal, (VALUES ('V_1', 4), ('V_2', 2), ('V_3', 0)) v(VERSION, back), (VALUES (8), (7), (6), (5), (3)) o(off)
  UNION ALL SELECT 'bad', CAST(newest AS INTEGER), CAST(lo AS INTEGER) FROM cal""",
    "panel_all": f"""
  SELECT *, concat_ws('_', MARKET_SEGMENT, BRAND, SCENARIO) AS PARTITION_COLUMN FROM (
  SELECT VERSION, qi, origin, cutoff, qi - origin AS k, {qlabel('qi')} AS QUARTER,
         CAST(make_date(qi // 4, (qi % 4) * 3 + 1, 1) AS TIMESTAMP) AS QUARTER_PARSED, MARKET_SEGMENT, BRAND,
         'MOF_' || {qlabel('origin')} || 'M1' AS SCENARIO, 2.0::DOUBLE AS VERIFICATION_HORIZON, 6.0::DOUBLE AS PREDICTION_HORIZON,
         CASE WHEN qi <= cutoff THEN BB ELSE 0 END AS BB, {_AVERAGES},
         {qlabel('cutoff')} || 'M1' AS BB_VERSION, {qlabel('origin')} || 'M1' AS MOF_VERSION,
         {qlabel('cutoff')} || 'M1' AS BB_VERSION_LATEST, {qlabel('cutoff')} || 'M1' AS MOF_VERSION_LATEST,
         {_now('MOF')} AS MOF_0_MONTH, ({_now('MOF')}) * 1.1::DOUBLE AS MOF_PLUS_BUFFER_0_MONTH,
         {_now('SELLIN')} AS SELLIN_0_MONTH, {_now('SR')} AS SR_0_MONTH,
         {_before('SELLIN')} AS SELLIN_MINUS3_MONTH, {_before('MOF')} AS MOF_MINUS3_MONTH, {_before('SR')} AS SR_MINUS3_MONTH,
         ({_before('MOF')}) * 1.1::DOUBLE AS MOF_PLUS_BUFFER_MINUS3_MONTH
  FROM base_lags JOIN scen ON qi <= origin + 6 WHERE qi >= (SELECT lo + 4 FROM cal))""",
    "panel": "SELECT * FROM panel_all WHERE VERSION = 'V_3'",
    "clean_all": """
  SELECT * EXCLUDE (BB), nullif(BB, 0) AS BB_RAW, nullif(BB, 0) IS NOT NULL AS is_actual,
         last_value(nullif(BB, 0) IGNORE NULLS) OVER (PARTITION BY VERSION, PARTITION_COLUMN ORDER BY qi
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BB
  FROM panel_all WHERE VERSION LIKE 'V_%'""",
    "clean": "SELECT * FROM clean_all WHERE VERSION = 'V_3'",
    "split_panel": """
  SELECT *, CASE WHEN back <= 6 THEN 'test' WHEN back <= 8 THEN 'val' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY qi DESC) AS back FROM clean)""",
    "fc_sums": f"""
  SELECT *, {_TREND_SUMS},
         CASE WHEN count(BB) OVER (PARTITION BY VERSION, PARTITION_COLUMN ORDER BY qi ROWS 3 PRECEDING) = 4
              THEN CAST(sum({cents('BB')}) OVER (PARTITION BY VERSION, PARTITION_COLUMN ORDER BY qi ROWS 3 PRECEDING) AS DOUBLE) / 400.0
         END AS m4
  FROM (SELECT *, qi - (SELECT lo + 4 FROM cal) + 1 AS t_,
               CASE WHEN k <= 0 AND BB IS NOT NULL THEN qi - (SELECT lo + 4 FROM cal) + 1 END AS x,
               CASE WHEN k <= 0 AND BB IS NOT NULL THEN {cents('BB')} END AS y FROM clean_all)
  WINDOW s AS (PARTITION BY VERSION, PARTITION_COLUMN)""",
    "fc_slope": """
  SELECT *, (CAST(n_ * sxy AS DOUBLE) - CAST(sx * sy AS DOUBLE)) / nullif(CAST(n_ * sxx AS DOUBLE) - CAST(sx * sx AS DOUBLE), 0) AS slope
  FROM fc_sums""",
    "fc_wide": """
  SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / nullif(CAST(n_ AS DOUBLE), 0) AS level_,
         max(CASE WHEN k = 0 THEN m4 END) OVER (PARTITION BY VERSION, PARTITION_COLUMN) AS last_m4,
         lag(m4, 1) OVER w AS prev_m4, lag(BB, 4) OVER w AS y4, lag(BB, 8) OVER w AS y8
  FROM fc_slope WINDOW w AS (PARTITION BY VERSION, PARTITION_COLUMN ORDER BY qi)""",
    **_ridge_ctes(),
    "fc_raw": f"""
  SELECT *, 'MEAN4' AS MODEL_USED, CASE WHEN k > 0 THEN last_m4 ELSE prev_m4 END AS f FROM fc_wide
  UNION ALL SELECT *, 'SEASONAL_NAIVE', CASE WHEN k > 4 THEN y8 ELSE y4 END FROM fc_wide
  UNION ALL SELECT *, 'TREND', (level_ + slope * CAST(t_ AS DOUBLE)) / 100.0 FROM fc_wide
  UNION ALL SELECT w.*, 'RIDGE', CASE WHEN r.n >= 6 THEN round(greatest({_RIDGE}, 0), 2) END
  FROM fc_wide w LEFT JOIN rg_fits r ON r.VERSION = w.VERSION AND r.PARTITION_COLUMN = w.PARTITION_COLUMN""",
    "fc_all": f"""
  SELECT *, {ape('BILLING', 'BILLING_PREDICTED')} AS ape FROM (
    SELECT * EXCLUDE (f), BB_RAW AS BILLING, CASE WHEN f < 0 THEN 0.0 ELSE f END AS BILLING_PREDICTED,
           MOF_0_MONTH AS MOF, MOF_PLUS_BUFFER_0_MONTH AS MOF_PLUS_BUFFER, SELLIN_0_MONTH AS SELLIN, SR_0_MONTH AS SR
    FROM fc_raw)""",
    "fc": "SELECT * FROM fc_all WHERE VERSION = 'V_3'",
    "fc_ind": f"SELECT *, {_MARKS} FROM (SELECT *, {_IND} FROM fc)",
    "scores_all": f"""
  SELECT *, {_HORIZON_MAPE} AS HORIZON_MAPE FROM (
    SELECT VERSION, MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, {_Q_MAPE}
    FROM fc_all GROUP BY ALL)""",
    "champ_all": """
  SELECT VERSION, MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, HORIZON_MAPE FROM scores_all
  WHERE HORIZON_MAPE IS NOT NULL AND HORIZON_MAPE > 0
  QUALIFY row_number() OVER (PARTITION BY VERSION, PARTITION_COLUMN ORDER BY round(HORIZON_MAPE, 9), MODEL_USED) = 1""",
    "pred_all": """
  SELECT f.*, strftime(load_ts, 'V_%Y%m%d_%H%M%S') AS PREDICTIONS_VERSION, load_ts AS LOAD_TS, f.ape AS APE_
  FROM fc_all f JOIN champ_all c USING (VERSION, PARTITION_COLUMN, MODEL_USED)
  JOIN loads USING (VERSION)""",
    "loads": """
  SELECT * FROM (VALUES ('V_1', TIMESTAMP '2000-07-01 00:00:00'), ('V_2', TIMESTAMP '2001-01-01 00:00:00'),
    ('V_3', TIMESTAMP '2001-07-01 00:00:00')) t(VERSION, load_ts)""",
    "quarters": "SELECT DISTINCT QUARTER FROM panel",
    "bt_windows": """
  SELECT w.BACKTEST_WINDOW, qs[len(qs) - w.BACKTEST_WINDOW - 5] AS WINDOW_START_QUARTER, qs[len(qs) - w.BACKTEST_WINDOW] AS WINDOW_END_QUARTER
  FROM (SELECT list_sort(list(QUARTER)) AS qs FROM quarters)
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS BACKTEST_WINDOW FROM range(0, 3)) w
  WHERE len(qs) - w.BACKTEST_WINDOW - 6 >= 6""",
    "win_metrics": f"""
  SELECT *, {_HORIZON_MAPE} AS HORIZON_MAPE FROM (
    SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, BACKTEST_WINDOW, WINDOW_START_QUARTER, WINDOW_END_QUARTER,
           avg(ape) AS MAPE, CAST(count(ape) AS DOUBLE) AS prediction_count, {_Q_MAPE}
    FROM fc JOIN bt_windows ON QUARTER BETWEEN WINDOW_START_QUARTER AND WINDOW_END_QUARTER WHERE k <> 0 AND k <= 6 GROUP BY ALL)""",
    "bt_scores": """
  SELECT *, BT_MEAN_HORIZON_MAPE AS HORIZON_MAPE, BT_MEAN_HORIZON_MAPE * (1 + BT_CV * 0.5) AS BT_SELECTION_SCORE FROM (
    SELECT *, coalesce(BT_STD_HORIZON_MAPE / nullif(BT_MEAN_HORIZON_MAPE, 0), 0) AS BT_CV FROM (
      SELECT MARKET_SEGMENT, PARTITION_COLUMN, MODEL_USED, avg(HORIZON_MAPE) AS BT_MEAN_HORIZON_MAPE,
             stddev_samp(HORIZON_MAPE) AS BT_STD_HORIZON_MAPE, count(HORIZON_MAPE) AS BT_N_WINDOWS, avg(MAPE) AS MAPE,
             stddev_samp(MAPE) AS BT_STD_MAPE, sum(prediction_count) AS prediction_count,
             avg(Q1_MAPE) AS Q1_MAPE, avg(Q2_MAPE) AS Q2_MAPE, avg(Q3_MAPE) AS Q3_MAPE, avg(Q4_MAPE) AS Q4_MAPE,
             avg(Q5_MAPE) AS Q5_MAPE, avg(Q6_MAPE) AS Q6_MAPE
      FROM win_metrics GROUP BY ALL))""",
    "champ": """
  SELECT *, BT_SELECTION_SCORE AS selection_score FROM bt_scores
  WHERE MAPE > 0 AND BT_SELECTION_SCORE IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY PARTITION_COLUMN ORDER BY round(BT_SELECTION_SCORE, 9), MODEL_USED) = 1""",
    "results_all": """
  SELECT s.VERSION, s.MARKET_SEGMENT, s.PARTITION_COLUMN, s.MODEL_USED, s.HORIZON_MAPE AS mape, load_ts AS LOAD_TS,
         'run_' || lower(s.VERSION) AS run_id, 'horizon_panel' AS DATA_TABLE, c.MODEL_USED IS NOT NULL AS is_champion,
         CASE WHEN s.HORIZON_MAPE IS NULL THEN 'Insufficient training data: no scored quarter' END AS error
  FROM scores_all s JOIN loads USING (VERSION)
  LEFT JOIN champ_all c ON c.VERSION = s.VERSION AND c.PARTITION_COLUMN = s.PARTITION_COLUMN AND c.MODEL_USED = s.MODEL_USED""",
}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", text))
    return [name for name in CTES if name in words]


def oracle(sql: str) -> str:
    """The statement with every stage it mentions, directly or through another stage."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for inner in _needs(CTES[name]):
            if inner != name and inner not in wanted:
                visit(inner)
        if name not in wanted:
            wanted.append(name)

    for name in _needs(sql):
        visit(name)
    if not wanted:
        return sql.strip()
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
