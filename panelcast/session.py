"""Session settings the operators are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings that matter at scale; cluster sizing stays with whoever starts the job.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # plans here have hundreds of columns; recording a call site for each doubles the time to build them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "panelcast", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only a local session without ``spark.checkpoint.dir`` (a test) gets a local temporary folder; on a cluster, other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="panelcast-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def file_state(spark: SparkSession, path: str) -> str:
    """Place, size and time of change of a file, or of the files in a folder; another state means that it was written anew."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return f"{path}:none"
    status = store.getFileStatus(place)
    files = store.listStatus(place) if status.isDirectory() else [status]
    return ",".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files))


#: the source tables that stage tables are derived from
SOURCES = ("orders", "lineitem", "customer")
_STAGED: dict[tuple[str, str, str], tuple[str, StructType, tuple[str, ...]]] = {}


def staged(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
    """A stage table: written once per application and state of the source tables by the executors, then read.

    The lifecycle hands stored tables from step to step, so steps that share a stage do not derive it
    again from the source tables. The files lie in the shared folder and survive lost executors.
    """
    key = (spark.sparkContext.applicationId, source, name)
    state = tuple(file_state(spark, f"{source}/{t}.parquet") for t in SOURCES)
    if key not in _STAGED or _STAGED[key][2] != state:
        frame = build()
        path = scratch_dir(spark, name)
        writer = frame.write
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        fields = [f for f in frame.schema.fields if f.name != partition_by]
        fields += [f for f in frame.schema.fields if f.name == partition_by]
        _STAGED[key] = (path, StructType(fields), state)
    path, schema, _ = _STAGED[key]
    return spark.read.schema(schema).parquet(path)


def staged_location(spark: SparkSession, name: str, source: str) -> tuple[str, StructType]:
    """Folder and schema of a stage table that was already written, e.g. to stream its files."""
    return _STAGED[(spark.sparkContext.applicationId, source, name)][:2]
