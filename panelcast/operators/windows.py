"""Splits, windows over quarters, horizons and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.functions.quarters import origin_has_quarter, origin_quarter, quarter_diff, quarter_index, quarter_label


def extract_horizons(df: DataFrame, keys: Sequence[str], val: str = "VERIFICATION_HORIZON", pred: str = "PREDICTION_HORIZON") -> DataFrame:
    """Whole-number medians of both horizon columns per series (a series is a few dozen rows)."""
    return df.groupBy(*keys).agg(
        F.percentile(val, F.lit(0.5)).cast("int").alias("val_h"), F.percentile(pred, F.lit(0.5)).cast("int").alias("pred_h")
    )


def _horizons_over(keys: Sequence[str], val: str, pred: str) -> dict[str, Column]:
    series = W.partitionBy(*keys)
    return {
        "_val_h": F.percentile(val, F.lit(0.5)).over(series).cast("int"),
        "_pred_h": F.percentile(pred, F.lit(0.5)).over(series).cast("int"),
    }


def split_train_val_test(
    df: DataFrame, keys: Sequence[str], order: str = "QUARTER_PARSED",
    val: str = "VERIFICATION_HORIZON", pred: str = "PREDICTION_HORIZON",
) -> DataFrame:
    """``split``: the last ``pred`` rows are test, the ``val`` rows before them validation."""
    back = W.partitionBy(*keys).orderBy(F.col(order).desc())
    place = F.col("_back")
    return (
        df.withColumns(_horizons_over(keys, val, pred) | {"_back": F.row_number().over(back)})
        .withColumn(
            "split",
            F.when(place <= F.col("_pred_h"), "test")
            .when(place <= F.col("_pred_h") + F.col("_val_h"), "val")
            .otherwise("train"),
        )
        .drop("_val_h", "_pred_h", "_back")
    )


def min_rows_guard(
    df: DataFrame, keys: Sequence[str], val: str = "VERIFICATION_HORIZON", pred: str = "PREDICTION_HORIZON"
) -> DataFrame:
    """Per series: rows, rows needed, and an error message where there are too few."""
    sized = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.percentile(val, F.lit(0.5)).cast("int").alias("val_h"),
        F.percentile(pred, F.lit(0.5)).cast("int").alias("pred_h"),
    )
    need = F.col("val_h") + F.col("pred_h") + 1
    return sized.withColumn("min_rows", need).withColumn(
        "error",
        F.when(
            F.col("n_rows") < need,
            F.format_string(
                "Insufficient training data: %d rows, need at least %d (val=%d, pred=%d)",
                F.col("n_rows"), need, F.col("val_h"), F.col("pred_h"),
            ),
        ),
    )


def pseudo_validation(df: DataFrame, keys: Sequence[str], order: str = "QUARTER_PARSED", target: str = "BB") -> DataFrame:
    """A series without validation rows lends its last training row, if it has more than one.

    Rows without a target never train or validate.
    """
    usable = df.filter((F.col("split") == "test") | F.col(target).isNotNull())
    series = W.partitionBy(*keys)
    n_val = F.count_if(F.col("split") == "val").over(series)
    n_train = F.count_if(F.col("split") == "train").over(series)
    last_train = F.max(F.when(F.col("split") == "train", F.col(order))).over(series)
    lend = (n_val == 0) & (n_train > 1) & (F.col("split") == "train") & (F.col(order) == last_train)
    return usable.withColumn("split", F.when(lend, "val").otherwise(F.col("split")))


def calendar_future(df: DataFrame, keys: Sequence[str], periods: int, quarter: str = "QUARTER") -> DataFrame:
    """Every quarter from the first of a series to ``periods`` after its last."""
    index = quarter_index(quarter)
    return (
        df.groupBy(*keys)
        .agg(F.min(index).alias("_a"), F.max(index).alias("_b"))
        .withColumn("qi", F.explode(F.sequence(F.col("_a"), F.col("_b") + periods)))
        .select(*keys, quarter_label("qi").alias(quarter))
    )


def backtest_windows(
    quarters: DataFrame, n_windows: int, stride: int = 1, min_train: int = 6, max_horizon: int = 6, quarter: str = "QUARTER"
) -> DataFrame:
    """Evaluation windows of ``max_horizon`` quarters stepping back through the distinct quarters.

    The distinct quarters are one small array, cut by position; steps that leave fewer than
    ``min_train`` quarters before them are not made.
    """
    calendar = quarters.select(quarter).filter(F.col(quarter).isNotNull()).distinct().agg(
        F.sort_array(F.collect_list(quarter)).alias("qs")
    )
    end = F.size("qs") - F.col("BACKTEST_WINDOW") * stride
    return (
        calendar.withColumn("BACKTEST_WINDOW", F.explode(F.sequence(F.lit(0), F.lit(n_windows - 1))))
        .filter(end - max_horizon >= min_train)
        .select(
            "BACKTEST_WINDOW",
            F.col("qs")[end - max_horizon].alias("WINDOW_START_QUARTER"),
            F.col("qs")[end - 1].alias("WINDOW_END_QUARTER"),
        )
    )


def window_quarters_join(df: DataFrame, windows: DataFrame, quarter: str = "QUARTER") -> DataFrame:
    """Rows of every window they fall into; the windows are a handful of rows."""
    return df.join(
        F.broadcast(windows),
        (F.col(quarter) >= F.col("WINDOW_START_QUARTER")) & (F.col(quarter) <= F.col("WINDOW_END_QUARTER")),
    )


SALTS = 32


def salted(df: DataFrame) -> DataFrame:
    """Rows with a place among ``SALTS``, whatever their key."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))


def salted_lookup(lookup: DataFrame) -> DataFrame:
    """A lookup of few rows, once for each place."""
    return lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def infer_origin_quarter(
    df: DataFrame, max_horizon: int = 6, keys: Sequence[str] = (), version: str = "MOF_VERSION", quarter: str = "QUARTER"
) -> DataFrame:
    """``ORIGIN_QUARTER`` from the label, or ``max_horizon`` before the last quarter of the version.

    The lookup has one row per version label and is joined, not windowed. A version may hold any share of all rows, so rows are dealt
    over ``SALTS`` copies of the lookup.
    """
    last = df.groupBy(*keys, version).agg(F.max(quarter).alias("_last"))
    inferred = last.withColumn("_inferred", quarter_label(quarter_index("_last") - max_horizon)).drop("_last")
    condition = F.col("a._salt") == F.col("b._salt")
    for c in (*keys, version):
        condition = condition & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return (
        salted(df)
        .alias("a")
        .join(salted_lookup(inferred).alias("b"), condition, "left")
        .select("a.*", F.col("b._inferred").alias("_inferred"))
        .drop("_salt")
        .withColumn(
            "ORIGIN_QUARTER",
            F.when(origin_has_quarter(version), origin_quarter(version)).otherwise(F.col("_inferred")),
        )
        .drop("_inferred")
    )


def quarter_indicators(
    df: DataFrame, max_horizon: int = 6, origin: str = "ORIGIN_QUARTER", quarter: str = "QUARTER"
) -> DataFrame:
    """Boolean ``Q+k_INDICATOR`` columns; rows of the origin quarter go away."""
    k = quarter_diff(quarter, origin)
    flags = {f"Q+{h}_INDICATOR": F.coalesce(k == h, F.lit(False)) for h in range(1, max_horizon + 1)}
    same = F.coalesce(F.col(quarter) == F.col(origin), F.lit(False))
    return df.filter(~same).withColumns(flags).drop(origin)


def prefix_until_indicator(
    df: DataFrame, indicators: Mapping[str, str], part: str = "PARTITION_COLUMN", order: str = "QUARTER_PARSED",
    new_part: str = "PARTITION_HORIZON", include_cut_row: bool = False,
) -> DataFrame:
    """Per partition and horizon, the rows before the first match of the horizon's indicator.

    An indicator may be boolean or hold the horizon's token as text. Without a match all rows stay.
    """
    window = W.partitionBy(part, "_token").orderBy(order)
    types = dict(df.dtypes)

    def hit(token: str, column: str) -> Column:
        if column not in types:
            return F.lit(False)
        c = F.col(f"`{column}`")
        matched = c if types[column] == "boolean" else F.trim(c.cast("string")) == token
        return F.coalesce(matched, F.lit(False))

    tokens = F.array(*[F.struct(F.lit(t).alias("token"), hit(t, c).alias("hit")) for t, c in indicators.items()])
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    seen_before = F.coalesce(F.max(F.col("_hit").cast("int")).over(earlier), F.lit(0))
    keep = (F.col("_seen") == 0) if include_cut_row else (F.col("_seen") == 0) & ~F.col("_hit")
    return (
        df.withColumn("_t", F.explode(tokens))
        .withColumns({"_token": F.col("_t.token"), "_hit": F.col("_t.hit")})
        .withColumn("_seen", seen_before)
        .filter(keep)
        .withColumn(new_part, F.concat_ws("_", F.col(part), F.col("_token")))
        .drop("_t", "_token", "_hit", "_seen")
    )


def sample_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows per key in a total order."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n).drop("_place")


def sample_series_rows(df: DataFrame, keys: Sequence[str], identity: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows per series, picked by a seeded hash of the row's identity."""
    draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in identity], F.lit(str(seed))))
    window = W.partitionBy(*keys).orderBy(draw, *identity)
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n).drop("_place")
