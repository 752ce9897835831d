"""What several operators share: stored steps, range buckets, and vectorised work on the bytes of Arrow text columns.

The numpy helpers run inside ``mapInArrow`` tasks on the UTF-8 buffer of a whole record batch. They never build a Python
string per row, and they work on slices of at most ``SLICE`` bytes (or one document, if that is longer). Such a step is made by ``mapped``: its batches
are small, and it is wrapped in ``released``, because the Python workers of an executor are reused, and what one task leaves behind counts for all that follow.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.session import scratch_dir

SLICE = 1 << 20
#: most bytes of a batch on its way to a Python worker, or one row
BATCH = 2 << 20
NULL_KEY = -(1 << 63)
U64 = np.uint64


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder of the cluster and read it back: the lineage ends there and survives lost executors."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unused(names: list[str], prefix: str = "__") -> str:
    """A prefix that none of these names begins with, so that columns named with it clash with none (Spark ignores case)."""
    while any(n.lower().startswith(prefix) for n in names):
        prefix += "_"
    return prefix


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case."""
    gone = {n.lower() for n in names}
    return df.drop(*(c for c in df.columns if c.lower() in gone))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, read from files, with a number for each row: the place of its file in path order, then its own place in the file.

    Unlike ``monotonically_increasing_id`` it is the same in every scan of the same files, however they are cut and packed into partitions. A frame
    that is no plain read of files raises an error. One row per file is broadcast.
    """
    free = unused([*docs.columns, name])
    file, place, row = free + "file", free + "place", free + "row"
    paths = docs.select(F.col("_metadata.file_path").alias(file)).distinct()
    places = paths.select(file, F.row_number().over(Window.orderBy(file)).cast("long").alias(place))
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return rows.join(F.broadcast(places), file).select(*docs.columns, (F.shiftleft(place, 40) + F.col(row)).alias(name))


def range_bounds(df: DataFrame, key, parts: int) -> list[int]:
    """First keys of at most ``parts`` ranges of about as many rows each, all of them values of the column; the first is its minimum.

    The driver gets one number for each range and nothing that grows with the rows. An empty table gives an empty list.
    """
    shares = [i / parts for i in range(parts)]
    row = df.select(key.alias("k")).agg(F.percentile_approx("k", shares, 100 * parts).alias("q"), F.min("k").alias("m")).first()
    return [] if row["m"] is None else sorted({row["m"], *row["q"]})


# ---- memory of a Python worker


def trim() -> None:
    """Give freed memory back to the system, as far as Arrow's pool and the C library (glibc) can."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give_back(0)


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that trims the worker's memory when its task has ended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            trim()

    return run


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` by batches of at most ``BATCH`` bytes, wrapped in ``released``.

    By default a batch takes 10,000 rows, up to 64 MB of texts, which the worker holds once and the JVM several times outside its heap (buffers that
    double as they grow). The limit is a setting of the session and holds for what runs in it from now on.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return df.mapInArrow(released(work), schema)


# ---- bytes of an Arrow column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows in them; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most that many bytes, or one row."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


SPACES = byte_class(b" \t\n\v\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII digits and letters and every byte of a character beyond ASCII
ALNUM = byte_class(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every longest run of members within a row."""
    n = len(member)
    before = np.zeros(n + 1, bool)
    before[1:] = member
    before[offsets] = False
    after = np.zeros(n + 1, bool)
    after[:n] = member
    after[offsets] = False
    first = np.flatnonzero(member & ~before[:n])
    last = np.flatnonzero(member & ~after[1:]) + 1
    return first, last, np.searchsorted(offsets, first, side="right") - 1


MULTIPLIER = 0x9E6C63D0676A9A99
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1)
        base, inverse = U64(MULTIPLIER), U64(pow(MULTIPLIER, -1, 1 << 64))
        for name, by in (("up", base), ("down", inverse)):
            steps = np.full(size, by, U64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        if size > 4 * SLICE:  # one long document: not kept
            return _POWERS.pop("up"), _POWERS.pop("down")
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a finaliser with full avalanche)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def span_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of an integer array, from one running polynomial sum."""
    up, down = _powers(len(values) + 1)
    # one array of numbers, worked on in place
    total = np.zeros(len(values) + 1, U64)
    own = total[1:]
    own[:] = values
    own += U64(1)
    own *= up[: len(values)]
    np.cumsum(own, out=own)
    h = (total[last] - total[first]) * down[first]
    return mixed(h + (last - first).astype(U64) * U64(0xD6E8FEB86659FD93))


def code_points_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte position."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total[at]


def joined_rows(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of several groups laid end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first ``keys`` columns of whole numbers; a group in several batches comes in one piece."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        last = np.array([held[-1].column(k)[-1].as_py() for k in range(keys)]) if held else table[:, 0]
        if (table == last[:, None]).all():
            held.append(batch)
            continue
        begins = np.flatnonzero((table[:, 1:] != table[:, :-1]).any(0)) + 1
        at = int(begins[-1]) if len(begins) else 0
        if held or at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)]).combine_chunks()
        held = [batch.slice(at)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
