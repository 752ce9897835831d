"""Exact ranks and quantiles over a whole column without putting it into one task.

Equal values are counted first, so a value that fills a third of the table is one row. The distinct
values are spread over buckets whose limits are approximate quantiles (a few dozen numbers, fetched
once and then literal, so a retried task sees the same buckets). Only bucket totals cross buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def default_buckets(df: DataFrame) -> int:
    """As many buckets as the cluster shuffles into."""
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bucket_limits(df: DataFrame, group: str, value: str, buckets: int) -> DataFrame:
    """``buckets - 1`` cut points per group; groups are column names, so this stays tiny."""
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.groupBy(group).agg(F.percentile_approx(value, probs, 20 * buckets).alias("_cuts")).collect()
    schema = f"{group} string, _cuts array<double>"
    return df.sparkSession.createDataFrame([(r[group], sorted(set(r["_cuts"]))) for r in cuts], schema)


def cumulative_counts(df: DataFrame, group: str, value: str, buckets: int | None = None) -> DataFrame:
    """Per group and distinct value: ``cnt`` copies and ``below`` rows with a smaller value."""
    rows = df.filter(F.col(value).isNotNull())
    limits = bucket_limits(rows, group, value, buckets or default_buckets(df))
    counts = (
        rows.groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .join(F.broadcast(limits), group)
        .withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col(value))))
        .drop("_cuts")
    )
    totals = counts.groupBy(group, "_bucket").agg(F.sum("cnt").alias("_size"))
    earlier = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumns(
        {"_before": F.coalesce(F.sum("_size").over(earlier), F.lit(0)), "n": F.sum("_size").over(W.partitionBy(group))}
    ).drop("_size")
    inside = W.partitionBy(group, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        counts.withColumn("_inside", F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), [group, "_bucket"])
        .select(group, value, "cnt", (F.col("_before") + F.col("_inside")).alias("below"), "n")
    )


def average_ranks(df: DataFrame, group: str, value: str, buckets: int | None = None) -> DataFrame:
    """Rank of every distinct value, ties sharing their mean."""
    counts = cumulative_counts(df, group, value, buckets)
    return counts.select(group, value, (F.col("below") + (F.col("cnt") + 1) / 2).alias("avg_rank"))


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], buckets: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles ``q_0``, ``q_1``, ... per group, from the cumulative counts."""
    counts = cumulative_counts(df, group, value, buckets)
    picks = []
    for i, p in enumerate(probs):
        spot = (F.col("n") - 1) * F.lit(float(p))
        for name, place in ((f"_lo{i}", F.floor(spot)), (f"_hi{i}", F.ceil(spot))):
            here = (F.col("below") <= place) & (place < F.col("below") + F.col("cnt"))
            picks.append(F.max(F.when(here, F.col(value))).alias(name))
        picks.append(F.max(spot - F.floor(spot)).alias(f"_w{i}"))
    out = counts.groupBy(group).agg(*picks)
    return out.select(
        group,
        *[(F.col(f"_lo{i}") + F.col(f"_w{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q_{i}") for i in range(len(probs))],
    )
