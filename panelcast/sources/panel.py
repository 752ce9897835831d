"""The quarterly panel derived from the order tables.

Scale notes: orders get their series from the customers while they are narrow. Line items meet them as
they are, since a reduction per order needs a table of nearly all orders in each scan task; what comes out
of that join is reduced map-side to one row per series and quarter. Both joins are inner and nothing is aggregated before
them, so adaptive execution splits a huge order and a huge customer. Money is summed as whole numbers (cents, or
cents scaled by the rates), hence the sums are exact and identical after any retry. A series can never be
longer than the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.config import MOVING_AVERAGE_WINDOWS
from panelcast.functions.quarters import date_quarter_index, quarter_diff, quarter_label, quarter_start
from panelcast.functions.stats import exact_cents
from panelcast.sources.tables import read_table

# how snapshots and origins lie in the calendar, which itself comes from the orders (``calendar``)
SNAPSHOTS = {"V_1": 4, "V_2": 2, "V_3": 0}  # last known quarter of each snapshot = newest complete quarter minus this
ORIGIN_OFFSETS = [8, 7, 6, 5, 3]  # forecast origin = last known quarter minus this
MAX_HORIZON = 6
HISTORY = 4  # first quarters of the calendar, which lagged signals need and the panel does not show
UNPARSEABLE = "bad"  # a snapshot whose VERSION has no number
SIGNALS = ["MOF", "SELLIN", "SR"]
GRAIN = ["MARKET_SEGMENT", "BRAND"]


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first quarter, newest complete quarter, and last quarter that any scenario reaches, as quarter indexes (year * 4 + quarter - 1).

    A quarter is complete once a later one has orders.
    """
    quarters = read_table(spark, sf_dir, "orders").select(date_quarter_index("o_orderdate").alias("qi"))
    ends = quarters.agg(F.min("qi").alias("first_qi"), (F.max("qi") - 1).alias("newest_qi"))
    reach = MAX_HORIZON - min(ORIGIN_OFFSETS)
    return ends.withColumn("last_qi", F.greatest(F.col("newest_qi") + 1, F.col("newest_qi") + reach))


def line_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line its order, list price in cents, and the percents that are charged of it after discount and with tax."""
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", exact_cents("l_extendedprice").alias("p"), (100 - exact_cents("l_discount")).alias("k"), (100 + exact_cents("l_tax")).alias("c")
    )


def series_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its series, quarter and amount. Orders and customers are narrow here, so this join is cheap and adaptive execution splits a huge customer."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", date_quarter_index("o_orderdate").alias("qi"), exact_cents("o_totalprice").alias("bb")
    )
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("MARKET_SEGMENT"), "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def base_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and signals per series and quarter, every quarter from the first order to the end of the calendar present."""
    key = ["MARKET_SEGMENT", "c_nationkey", "qi"]
    orders = series_orders(spark, sf_dir)
    # four numbers a line cross the shuffle; a hash table of a partition's orders needs no sort of the lines, and its split where an order is huge
    lines = orders.drop("bb").hint("shuffle_hash").join(line_factors(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"))
    signals = lines.selectExpr(*key, "p AS mof", "p * k AS sellin", "p * k * c AS sr")

    def halves(rows: DataFrame, *names: str) -> DataFrame:
        """Sums of 64-bit numbers as high and low part: they stay in generated code and do not overflow."""
        return rows.groupBy(*key).agg(*[F.sum(F.expr(e)).alias(f"{n}_{part}") for n in names for part, e in (("hi", f"{n} div 1000000"), ("lo", f"{n} % 1000000"))])

    whole = lambda n: F.expr(f"CAST(sum(CAST({n}_hi AS DECIMAL(20,0))) * 1000000 + sum({n}_lo) AS DECIMAL(28,0))").alias(n)
    sums = (
        halves(orders, "bb")
        .unionByName(halves(signals, "mof", "sellin", "sr"), allowMissingColumns=True)
        .groupBy("MARKET_SEGMENT", F.col("c_nationkey").cast("string").alias("BRAND"), "qi")
        .agg(*[whole(n) for n in ("bb", "mof", "sellin", "sr")])
    )
    # A calendar array per series, built where the sums already are: no second pass over the orders.
    wide = sums.groupBy(*GRAIN).agg(
        F.map_from_entries(F.collect_list(F.struct("qi", F.struct("bb", "mof", "sellin", "sr")))).alias("known")
    )
    number = lambda name, scale: F.coalesce(F.col("known")[F.col("qi")][name].cast("double"), F.lit(0.0)) / scale
    spread = wide.crossJoin(F.broadcast(calendar(spark, sf_dir)))  # one row
    return spread.select(*GRAIN, "known", "first_qi", "newest_qi", F.explode(F.sequence("first_qi", "last_qi")).alias("qi")).select(
        *GRAIN,
        "qi",
        "first_qi",
        "newest_qi",
        number("bb", 100.0).alias("BB"),
        number("mof", 100.0).alias("MOF"),
        number("sellin", 10000.0).alias("SELLIN"),
        number("sr", 1000000.0).alias("SR"),
    )


def scenarios(base: DataFrame) -> DataFrame:
    """Every row with each snapshot and forecast origin (a handful, from configuration) that reaches its quarter."""
    each = [F.struct(F.lit(v).alias("VERSION"), (F.col("newest_qi") - back).alias("cutoff"), (F.col("newest_qi") - back - off).alias("origin")) for v, back in SNAPSHOTS.items() for off in ORIGIN_OFFSETS]
    each.append(F.struct(F.lit(UNPARSEABLE).alias("VERSION"), F.col("newest_qi").alias("cutoff"), F.col("first_qi").alias("origin")))
    return base.withColumn("s", F.explode(F.array(*each))).select("*", "s.*").drop("s").filter(F.col("qi") <= F.col("origin") + MAX_HORIZON)


SERIES_ORDER = f"PARTITION BY {', '.join(GRAIN)} ORDER BY qi"


def _trailing(n: int) -> str:
    """Mean of the last ``n`` quarters over whole cents, so it is exact before the division."""
    cents = "CAST(floor(BB * 100 + 0.5) AS DECIMAL(20,0))"
    return f"CAST(sum({cents}) OVER ({SERIES_ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) / {100 * n}.0D"


def _signal_now(s: str) -> str:
    """Known signal, after the last known quarter the one a year earlier."""
    return f"IF(qi <= cutoff, {s}, {s}_LAG4)"


def _signal_before(s: str) -> str:
    """The same signal one quarter earlier."""
    return f"IF(qi <= cutoff + 1, {s}_LAG1, {s}_LAG5)"


def _average(n: int) -> str:
    """Moving average, after the last known quarter its last known value."""
    later = " ".join(f"WHEN qi = cutoff + {k} THEN MA_{n}_LAG{k}" for k in (1, 2, 3))
    return f"CASE WHEN qi <= cutoff THEN MA_{n} {later} END"


def horizon_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots of the panel, one row per version, series, origin and quarter."""
    lags = {f"{s}_LAG{k}": f"lag({s}, {k}) OVER ({SERIES_ORDER})" for s in SIGNALS for k in (1, 4, 5)}
    lags |= {f"MA_{n}_LAG{k}": f"lag(MA_{n}, {k}) OVER ({SERIES_ORDER})" for n in MOVING_AVERAGE_WINDOWS for k in (1, 2, 3)}
    base = (
        base_quarters(spark, sf_dir)
        .selectExpr("*", *[f"{_trailing(n)} AS MA_{n}" for n in MOVING_AVERAGE_WINDOWS])
        .selectExpr("*", *[f"{e} AS {name}" for name, e in lags.items()])
        .filter(F.col("qi") >= F.col("first_qi") + HISTORY)
    )
    rows = scenarios(base)
    mof_version = F.concat(quarter_label("origin"), F.lit("M1"))
    newest = F.concat(quarter_label("cutoff"), F.lit("M1"))
    labelled = rows.withColumns(
        {
            "QUARTER": quarter_label("qi"),
            "QUARTER_PARSED": quarter_start("qi").cast("timestamp"),
            "MOF_VERSION": mof_version,
            "BB_VERSION": newest,
        }
    )
    return labelled.selectExpr(
        "VERSION",
        "QUARTER",
        "QUARTER_PARSED",
        "MARKET_SEGMENT",
        "BRAND",
        "concat('MOF_', MOF_VERSION) AS SCENARIO",
        "2.0D AS VERIFICATION_HORIZON",
        f"{MAX_HORIZON}.0D AS PREDICTION_HORIZON",
        "IF(qi <= cutoff, BB, 0.0D) AS BB",
        *[f"{_average(n)} AS BILLING_MOVING_AVERAGE_{n}Q" for n in MOVING_AVERAGE_WINDOWS],
        "BB_VERSION",
        "MOF_VERSION",
        "BB_VERSION AS BB_VERSION_LATEST",
        "BB_VERSION AS MOF_VERSION_LATEST",
        f"{_signal_now('MOF')} AS MOF_0_MONTH",
        f"{_signal_now('MOF')} * 1.1D AS MOF_PLUS_BUFFER_0_MONTH",
        f"{_signal_now('SELLIN')} AS SELLIN_0_MONTH",
        f"{_signal_now('SR')} AS SR_0_MONTH",
        f"{_signal_before('SELLIN')} AS SELLIN_MINUS3_MONTH",
        f"{_signal_before('MOF')} AS MOF_MINUS3_MONTH",
        f"{_signal_before('SR')} AS SR_MINUS3_MONTH",
        f"{_signal_before('MOF')} * 1.1D AS MOF_PLUS_BUFFER_MINUS3_MONTH",
    )


def countdown_horizon(df: DataFrame, version: str = "MOF_VERSION") -> DataFrame:
    """The other shape of VERIFICATION_HORIZON: 1 at the origin, falling by one per quarter."""
    return df.withColumn("VERIFICATION_HORIZON", (1 - quarter_diff("QUARTER", version)).cast("double"))
