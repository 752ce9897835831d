"""Queries for scalar functions: quarters, errors, indicators, names and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.catalog import stages as S
from panelcast.catalog.oracle import ape, direction, distance, indicator, qindex, qlabel
from panelcast.catalog.projections import KEYS, K
from panelcast.catalog.registry import register
from panelcast.config import DEMAND_SIGNALS
from panelcast.functions import metrics as ME
from panelcast.functions import quarters as QF
from panelcast.functions import stats as ST
from panelcast.functions import text as TX
from panelcast.operators import horizon as H
from panelcast.sources import tables

# quarter labels in all the shapes the parser accepts, and some it must refuse, built from the order dates
_SHAPES = ["{y}Q{q}", "{y}-q{q}", "{y} Q {q}", "Q{q} {y}", "VER_{y}", "x{y}Q{q}M1"]


def _labels(spark: SparkSession, d: str) -> DataFrame:
    o = tables.read_table(spark, d, "orders")
    y, q = F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string")
    built = F.lit(None).cast("string")
    shape = F.pmod(F.col("o_orderkey"), F.lit(7))
    for i, text in enumerate(_SHAPES):
        parts = F.replace(F.replace(F.lit(text), F.lit("{y}"), y), F.lit("{q}"), q)
        built = F.when(shape == i, parts).otherwise(built)
    return o.select("o_orderkey", built.alias("label"), (F.pmod(F.col("o_custkey"), F.lit(13)) - 6).cast("int").alias("step"))


_CASES = " ".join(
    f"WHEN {i} THEN replace(replace('{t}', '{{y}}', CAST(year(o_orderdate) AS VARCHAR)), '{{q}}', CAST(quarter(o_orderdate) AS VARCHAR))"
    for i, t in enumerate(_SHAPES)
)
LABELS = f"SELECT o_orderkey, CASE o_orderkey % 7 {_CASES} END AS label, CAST(o_custkey % 13 - 6 AS INTEGER) AS step FROM orders"

register(
    "add_quarters",
    lambda s, d: _labels(s, d).select("o_orderkey", "label", "step", QF.add_quarters("label", F.col("step")).alias("moved")),
    f"SELECT o_orderkey, label, step, {qlabel(qindex('label') + ' + step')} AS moved FROM ({LABELS})",
)
register(
    "quarter_diff",
    lambda s, d: S.panel_all(s, d).select("VERSION", *KEYS, QF.quarter_diff("QUARTER", "MOF_VERSION").alias("k")),
    f"SELECT VERSION, {K}, k FROM panel_all",
)
register(
    "origin_quarter",
    lambda s, d: S.panel_all(s, d).select("VERSION", *KEYS, QF.origin_quarter("MOF_VERSION").alias("origin_quarter")),
    f"SELECT VERSION, {K}, split_part(MOF_VERSION, 'M', 1) AS origin_quarter FROM panel_all",
)
register(
    "quarter_parseable",
    lambda s, d: _labels(s, d).select(
        "o_orderkey", QF.origin_has_quarter("label").alias("has_quarter"), QF.label_is_parseable("label").alias("is_parseable")
    ),
    f"""SELECT o_orderkey, coalesce(regexp_matches(split_part(label, 'M', 1), '\\d{{4}}\\s*[- ]?Q\\s*[1-4]', 'i'), false) AS has_quarter,
          coalesce(contains(label, 'Q') AND regexp_matches(split_part(label, 'Q', 1), '\\d'), false) AS is_parseable FROM ({LABELS})""",
)
register(
    "ape",
    lambda s, d: S.forecasts(s, d).select(*KEYS, "MODEL_USED", ME.ape("BILLING", "BILLING_PREDICTED").alias("APE")),
    f"SELECT {K}, MODEL_USED, {ape('BILLING', 'BILLING_PREDICTED')} AS APE FROM fc",
    {6: "APE"},
)
register(
    "indicator",
    lambda s, d: S.forecasts(s, d).select(*KEYS, "MODEL_USED", *[ME.indicator("BILLING_PREDICTED", c).alias(f"I_{c}") for c in DEMAND_SIGNALS]),
    f"SELECT {K}, MODEL_USED, {', '.join(f'''{indicator('BILLING_PREDICTED', c)} AS I_{c}''' for c in DEMAND_SIGNALS)} FROM fc",
)
_MARKS = [c for c in H.indicator_columns() if c.startswith(("VALIDATION", "DIRECTIONAL"))]
register(
    "verification_columns",
    lambda s, d: H.add_indicators(S.forecasts(s, d)).select(*KEYS, "MODEL_USED", *_MARKS),
    f"SELECT {K}, MODEL_USED, {', '.join(_MARKS)} FROM fc_ind",
)

register(
    "evaluate_predictions",
    lambda s, d: H.evaluate_predictions(S.forecasts(s, d), [*KEYS[:1], "MODEL_USED"]).select(*KEYS, "MODEL_USED", "APE", *_MARKS),
    f"SELECT {K}, MODEL_USED, ape AS APE, {', '.join(_MARKS)} FROM fc_ind WHERE k NOT IN (0, 5, 6)",
    {6: "APE"},
)

register(
    "clean_label",
    lambda s, d: tables.read_table(s, d, "documents").select("doc_id", F.md5(TX.clean_label("text")).alias("label_digest"), F.length(TX.clean_label("text")).cast("bigint").alias("n")),
    "SELECT doc_id, md5(upper(regexp_replace(text, '[^a-zA-Z0-9]+', '_', 'g'))) AS label_digest, length(upper(regexp_replace(text, '[^a-zA-Z0-9]+', '_', 'g'))) AS n FROM documents",
)
register(
    "sanitize_name",
    lambda s, d: tables.read_table(s, d, "orders").select("o_orderkey", TX.sanitize_name("o_orderpriority").alias("name")),
    "SELECT o_orderkey, translate(upper(o_orderpriority), '/ -', '___') AS name FROM orders",
)
register(
    "truncate_name",
    lambda s, d: tables.read_table(s, d, "pages").select("page_id", TX.truncate_name("url", 30).alias("short"), TX.metric_key("url").alias("metric_key")),
    """SELECT page_id, CASE WHEN length(url) > 30 THEN substring(url, 1, 30) || '...' ELSE url END AS short,
         substring(lower(translate(url, '/ -', '___')), 1, 50) AS metric_key FROM pages""",
)


def _valid_metric(spark: SparkSession, d: str) -> DataFrame:
    """Signed logarithms: not a number below zero, missing at zero."""
    c = tables.read_table(spark, d, "customer")
    value = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).when(F.col("c_acctbal") > 100, F.col("c_acctbal"))
    return c.select("c_custkey", ME.is_valid_metric(value).alias("is_valid"))


register("valid_metric", _valid_metric, "SELECT c_custkey, NOT (c_acctbal < 0) AND c_acctbal > 100 AS is_valid FROM customer")

register(
    "parse_json_payload",
    lambda s, d: tables.read_table(s, d, "events").select(
        "event_id",
        TX.parse_json_map(F.when(F.col("event_type") != "view", F.col("props")))["k"].cast("bigint").alias("k"),
        F.size(TX.parse_json_map(F.when(F.col("event_type") != "view", F.col("props")))).alias("n_keys"),
    ),
    "SELECT event_id, CASE WHEN event_type <> 'view' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END AS n_keys FROM events",
)
register(
    "model_name",
    lambda s, d: S.panel(s, d).select("PARTITION_COLUMN").distinct().withColumn(
        "model_name", TX.model_name("main", "forecast", "panel", "PARTITION_COLUMN", F.lit("TREND"))
    ),
    "SELECT DISTINCT PARTITION_COLUMN, 'main.forecast.panel_' || translate(upper(PARTITION_COLUMN), '/ -', '___') || '_trend' AS model_name FROM panel",
)


def _fourier(spark: SparkSession, d: str) -> DataFrame:
    terms = ST.fourier_terms("o_orderdate", 91.3125, 5)
    return tables.read_table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in terms.items()])


_T = "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)"
register(
    "fourier_terms",
    _fourier,
    "SELECT o_orderkey, "
    + ", ".join(f"{f}({_T} * (2.0::DOUBLE * pi() * {j} / 91.3125::DOUBLE)) AS {f}_{j}" for j in range(1, 6) for f in ("sin", "cos"))
    + " FROM orders",
    {6: " ".join(f"{f}_{j}" for j in range(1, 6) for f in ("sin", "cos"))},
)
register(
    "date_normalize",
    lambda s, d: tables.read_table(s, d, "events").select("event_id", F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("day")),
    "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d 00:00:00') AS day FROM events",
)
