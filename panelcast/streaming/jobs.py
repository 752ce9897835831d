"""Incremental jobs over arriving files.

Each job is a transformation of a streaming frame plus one way to run it: all files that are there now,
in micro-batches, into a folder per batch. A retried batch overwrites its own folder, so results are
written once, and a job that is started again continues from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.functions.quarters import date_quarter_index
from panelcast.functions.stats import exact_cents
from panelcast.operators.clean import dedupe_first
from panelcast.operators.monitor import realized


def stream_files(spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(
    stream: DataFrame, sink: str, checkpoint: str, mode: str = "update", transform: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Process everything that has arrived and stop. The sink has the result's schema even if nothing arrived."""
    spark = stream.sparkSession
    nothing = spark.createDataFrame([], stream.schema)
    (transform(nothing) if transform is not None else nothing).limit(0).write.mode("overwrite").parquet(f"{sink}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform is not None else batch
        out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_updates(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Latest value per key over all batches written so far."""
    rows = spark.read.option("basePath", sink).parquet(sink)
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id").cast("bigint")).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def error_counts(errors: DataFrame, time: str = "timestamp", keys: Sequence[str] = ("check_type", "severity"), delay: str = "2 days", width: str = "1 day") -> DataFrame:
    """Findings per check, severity and day; what arrives later than ``delay`` is dropped."""
    return (
        errors.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), *keys, "n")
    )


def quarter_rollup(orders: DataFrame, customers: DataFrame, delay: str = "120 days") -> DataFrame:
    """Target per segment and quarter from single orders, each order counted once.

    The state holds the keys of orders within ``delay`` of the newest one. Older orders that arrive in a later batch are not in
    the stream's result: where orders may come late, run ``rollup_available``, which has no limit.
    """
    return _rolled_up(orders.withWatermark("o_orderdate", delay).dropDuplicatesWithinWatermark(["o_orderkey"]), customers)


def rollup_available(orders: DataFrame, customers: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Roll up all orders that have arrived, each key once, whatever their dates and however they fall into batches and runs; the result so far.

    Each batch stores its new keys and what they add to the rollup, in folders of its own. New are the keys that no batch before has stored, so a
    retried batch writes the same again. There is no state in memory; the stored keys grow with the orders.
    """
    spark = orders.sparkSession
    nothing = spark.createDataFrame([], orders.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        once = dedupe_first(batch, ["o_orderkey"], ["o_orderdate"])
        if batch_id >= 0:
            stored = spark.read.option("basePath", f"{sink}/keys").parquet(f"{sink}/keys")
            before = stored.filter(F.col("batch_id") < batch_id).select(F.col("o_orderkey").alias("_known"))
            once = once.join(before, F.col("o_orderkey").eqNullSafe(F.col("_known")), "left_anti")
        once.select("o_orderkey").write.mode("overwrite").parquet(f"{sink}/keys/batch_id={batch_id}")
        _rolled_up(once, customers).write.mode("overwrite").parquet(f"{sink}/added/batch_id={batch_id}")

    write(nothing, -1)
    query = orders.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return _summed(spark.read.option("basePath", f"{sink}/added").parquet(f"{sink}/added"))


def merge_late(rollup: DataFrame, late: DataFrame, counted: DataFrame, customers: DataFrame) -> DataFrame:
    """A stored rollup with late orders added, in batch: those whose key is not among the ``counted`` orders, each once."""
    new = dedupe_first(late, ["o_orderkey"], ["o_orderdate"]).join(counted.select("o_orderkey").distinct(), "o_orderkey", "left_anti")
    both = rollup.unionByName(_rolled_up(new, customers).select(*rollup.columns))
    return _summed(both)


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("MARKET_SEGMENT", "qi").agg(F.sum("cents").alias("cents"), F.sum("n_orders").alias("n_orders"))


def _rolled_up(once: DataFrame, customers: DataFrame) -> DataFrame:
    segments = customers.select("c_custkey", F.col("c_mktsegment").alias("MARKET_SEGMENT"))
    return (
        once.select("o_custkey", date_quarter_index("o_orderdate").alias("qi"), exact_cents("o_totalprice").alias("cents"))
        .join(segments, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("MARKET_SEGMENT", "qi")
        .agg(F.sum(F.col("cents").cast("decimal(18,0)")).alias("cents"), F.count(F.lit(1)).alias("n_orders"))
    )


SCORED_KEYS = ["PREDICTIONS_VERSION", "PARTITION_COLUMN", "QUARTER", "MODEL_USED"]


def monitor_refresh(spark: SparkSession, actuals: DataFrame, predictions: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Every arriving file of actuals scores the predictions that were open for it.

    Scoring is per batch and keyed by prediction and quarter, so running it again adds nothing, and an
    actual that arrives twice counts once.
    """
    columns = [*SCORED_KEYS, "BILLING_PREDICTED", "BB_ACTUAL", "REALIZED_APE"]
    run_available(actuals, sink, checkpoint, "append", lambda batch: realized(predictions, batch).select(*columns))
    scored = spark.read.option("basePath", sink).parquet(sink)
    return dedupe_first(scored, SCORED_KEYS, ["batch_id"]).select(*columns)
