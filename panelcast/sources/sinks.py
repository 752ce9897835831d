"""Batches on their way into versioned tables: stamps, schema alignment, flags and appends.

There is no in-place update: a batch is appended and "latest" or "champion" is derived on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.tables import version_number

ERROR_COLUMNS = ["notebook", "run_id", "stage", "partition", "model_type", "severity", "message", "timestamp"]
MESSAGE_LIMIT = 1000  # fixed value: the error table keeps this many characters of a message


def align_to_schema(df: DataFrame, target: T.StructType, keep_stale: bool = True) -> DataFrame:
    """Cast to the target's types and turn untyped columns into text.

    Columns the batch does not have are kept as NULL (``keep_stale``) or left out, the latter being
    how a table loses columns that were dropped upstream.
    """
    wanted = {f.name: f.dataType for f in target.fields}

    def typed(field: T.StructField) -> Column:
        known = wanted.get(field.name)
        if known is not None and not isinstance(known, T.NullType):
            return F.col(field.name).cast(known).alias(field.name)
        if isinstance(field.dataType, T.NullType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    columns = [typed(f) for f in df.schema.fields]
    if keep_stale:
        columns += [F.lit(None).cast(t).alias(name) for name, t in wanted.items() if name not in df.columns]
    return df.select(*columns)


def stamp_batch(df: DataFrame, now: Column, zone: str | None = None, **constants: str) -> DataFrame:
    """Version label from the clock, load time and constant columns; ``zone`` gives local time."""
    clock = F.convert_timezone(F.lit("UTC"), F.lit(zone), now.cast("timestamp_ntz")) if zone else now
    stamps = {
        "PREDICTIONS_VERSION": F.concat(F.lit("V_"), F.date_format(clock, "yyyyMMdd_HHmmss")),
        "LOAD_TS": now,
    }
    return df.withColumns(stamps | {name: F.lit(value) for name, value in constants.items()})


def append_with_latest_flag(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Old rows lose the flag, the batch carries it."""
    fresh = batch.withColumn("is_latest", F.lit(True))
    if existing is None:
        return fresh
    return existing.withColumn("is_latest", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def derive_latest_flag(df: DataFrame, version_col: str = "PREDICTIONS_VERSION", load_col: str = "LOAD_TS") -> DataFrame:
    """The same flag derived on read: the version loaded last is the latest one."""
    newest = df.agg(F.max_by(version_col, F.struct(load_col, version_col)).alias("_newest"))
    return (
        df.crossJoin(F.broadcast(newest))
        .withColumn("is_latest", F.col(version_col) == F.col("_newest"))
        .drop("_newest")
    )


def flag_champions(rows: DataFrame, champions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``is_champion`` is true exactly for the (partition, model) pairs in ``champions``."""
    marks = champions.select(*keys).distinct().withColumn("_won", F.lit(True))
    return (
        rows.drop("is_champion")
        .join(marks, list(keys), "left")
        .withColumn("is_champion", F.col("_won").isNotNull())
        .drop("_won")
    )


def error_log(errors: DataFrame, notebook: str, run_id: str | None, now: Column) -> DataFrame:
    """Errors in the one shape of the error table, gaps filled with its defaults."""

    def given(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in errors.columns else F.lit(default)

    return errors.select(
        F.lit(notebook).alias("notebook"),
        F.lit(run_id or "N/A").alias("run_id"),
        given("stage", "unknown").alias("stage"),
        given("partition", "N/A").alias("partition"),
        given("model_type", "N/A").alias("model_type"),
        given("severity", "error").alias("severity"),
        F.substring(given("message", ""), 1, MESSAGE_LIMIT).alias("message"),
        now.alias("timestamp"),
    )


def collect_errors(parts: Sequence[DataFrame]) -> DataFrame:
    """All findings of a run in one frame (stage, partition, model_type, severity, message)."""
    columns = ["stage", "partition", "model_type", "severity", "message"]
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def write_versioned(df: DataFrame, path: str, version_col: str, max_records: int = 2_000_000) -> None:
    """Append, one folder per version, so that readers of a version prune the rest."""
    df.write.mode("append").partitionBy(version_col).option("maxRecordsPerFile", max_records).parquet(path)


def append_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append to a catalog table, creating it on the first run. Columns that only the batch has are added to the table."""
    if spark.catalog.tableExists(table):
        target = spark.table(table).schema
        aligned = align_to_schema(df, target)
        known = {name.lower() for name in target.names}
        new = [f for f in aligned.schema.fields if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        aligned.select(*target.names, *[f.name for f in new]).write.mode("append").saveAsTable(table)
    else:
        align_to_schema(df, T.StructType([])).write.saveAsTable(table)


__all__ = [
    "align_to_schema",
    "append_table",
    "append_with_latest_flag",
    "collect_errors",
    "derive_latest_flag",
    "error_log",
    "flag_champions",
    "stamp_batch",
    "version_number",
    "write_versioned",
]
