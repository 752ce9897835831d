"""Plain table access and the choice of a snapshot inside a versioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.functions.quarters import as_column
from panelcast.session import file_state


_KNOWN_SCHEMAS: dict[str, tuple[str, StructType]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table as it is; the scan is pruned by whatever follows.

    The footer is read for the schema once per state of the file, not once per use in a plan.
    """
    path = f"{sf_dir}/{name}.parquet"
    state = file_state(spark, path)
    known = _KNOWN_SCHEMAS.get(path)
    if known is None or known[0] != state:
        known = _KNOWN_SCHEMAS[path] = (state, spark.read.parquet(path).schema)
    return spark.read.schema(known[1]).parquet(path)


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array / JSON lines or a CSV file with header, chosen by suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "json":
        return spark.read.option("multiLine", True).json(path)
    if suffix in ("jsonl", "ndjson"):
        return spark.read.json(path)
    if suffix == "csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported fixture type: {path}")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """``-`` in column names becomes ``MINUS``."""
    return df.toDF(*[name.replace("-", "MINUS") for name in df.columns])


def project_existing(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ("SCENARIO",)) -> DataFrame:
    """The wanted columns that exist, plus derived columns that must survive the selection."""
    names = list(dict.fromkeys([*wanted, *keep]))
    return df.select(*[name for name in names if name in df.columns])


def version_number(label: Column | str) -> Column:
    """Number of ``V_<n>``; NULL for anything else."""
    return F.regexp_extract(as_column(label), r"V_(\d+)", 1).try_cast("bigint")


def scan_latest_version(df: DataFrame, version_col: str = "VERSION") -> DataFrame:
    """Rows of the highest numbered version.

    The highest number is a one-row aggregate joined by broadcast, so there is one lazy plan and no
    window over the whole table.
    """
    newest = df.agg(F.max(version_number(version_col)).alias("_newest"))
    return (
        df.withColumn("_number", version_number(version_col))
        .join(F.broadcast(newest), F.col("_number") == F.col("_newest"))
        .drop("_number", "_newest")
    )


def latest_version_label(df: DataFrame, version_col: str = "VERSION") -> DataFrame:
    return df.agg(F.concat(F.lit("V_"), F.max(version_number(version_col)).cast("string")).alias("data_version"))


def next_version_label(df: DataFrame, version_col: str, first: int = 1) -> DataFrame:
    """One row with the label after the highest one; ``V_<first>`` for an empty table."""
    highest = F.max(version_number(version_col))
    return df.agg(
        F.concat(F.lit("V_"), F.coalesce(highest + 1, F.lit(first)).cast("string")).alias("next_version")
    )


def next_table_version(spark: SparkSession, table: str, version_col: str, first: int = 1) -> str:
    """The next label of a stored table; the first label if the table does not exist yet."""
    if not spark.catalog.tableExists(table):
        return f"V_{first}"
    return next_version_label(spark.table(table), version_col, first).first()[0]


def derive_scenario(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Keep SCENARIO where at least a share ``min_share`` of the table's rows has a usable label, else build it.

    The whole column decides (a one-row aggregate), not an unordered sample of it.
    """
    if "MOF_VERSION" not in df.columns or "QUARTER" not in df.columns:
        return df
    built = F.concat(F.lit("MOF_"), F.col("MOF_VERSION"))
    if "SCENARIO" not in df.columns:
        return df.withColumn("SCENARIO", built)
    usable = (
        F.col("SCENARIO").contains("MOF_")
        & F.col("SCENARIO").contains("_QUARTER_")
        & ~F.col("SCENARIO").contains("XXXX-XX-XX")
    )
    verdict = df.agg((F.count_if(usable) >= F.greatest(F.count(F.lit(1)) * min_share, F.lit(1))).alias("_keep"))
    return (
        df.crossJoin(F.broadcast(verdict))
        .withColumn("SCENARIO", F.when(F.col("_keep"), F.col("SCENARIO")).otherwise(built))
        .drop("_keep")
    )


def partition_key(columns: Sequence[str]) -> Column:
    """Partition columns joined with ``_``; NULL parts are left out."""
    return F.concat_ws("_", *[F.col(c) for c in columns])


def with_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("PARTITION_COLUMN", partition_key(columns))


def latest_run_models(models: DataFrame, expected_table: str) -> DataFrame:
    """Rows of the newest run, with a note whether it was trained on the expected table."""
    newest = models.agg(F.max_by("run_id", F.struct("LOAD_TS", "run_id")).alias("run_id"))
    return models.join(F.broadcast(newest), "run_id").withColumn(
        "source_matches", F.coalesce(F.col("DATA_TABLE") == expected_table, F.lit(False))
    )


__all__ = [
    "derive_scenario",
    "latest_run_models",
    "latest_version_label",
    "load_fixture",
    "next_table_version",
    "next_version_label",
    "normalize_column_names",
    "partition_key",
    "project_existing",
    "read_table",
    "scan_latest_version",
    "version_number",
    "with_partition",
]
