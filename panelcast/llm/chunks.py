"""Operator 1: substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is smaller than at the ``REACH`` places before and not larger than at those
behind. A cut depends on a few dozen bytes around it only, so an insertion moves no other cut, and chunks are about ``2 * REACH + 1`` bytes, more evenly than with a mask. Chunks with equal 64-bit
digests are copies; the first in table order stays. Runs of neighbouring copied chunks with ``least_words`` words or more are repeated passages, which come out with the
documents that had their chunks first. (A single equal digest is no proof, a run of several is: digests would have to collide in a row.)

The first holder of each digest is aggregated map-side before the shuffle and joined back, so a chunk that a third of all documents share is split by the
skew join; only copied chunks go on, and windows then see one document at a time.

Edge cases: null and empty texts have no chunks; repeated rows are copies of the first; a text without a cut (one character repeated) is one chunk; an empty table gives no rows; null
ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.shared import SPACES, U64, code_points_before, documents, joined_rows, mixed, numbered, slices, utf8

REACH = 16
WINDOW_BYTES = 32
#: longer chunks are looked through for minima that tie
LONG = 4 * REACH
GEAR = mixed(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_LAST = U64((1 << 64) - 1)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks, in bytes; the end of every row that is not empty is one."""
    n, rows = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, np.int64)
    # rows lie apart, so that neither hashes nor comparisons see another row
    place = np.arange(n) + WINDOW_BYTES * (1 + np.repeat(np.arange(rows), np.diff(offsets)))
    h = np.zeros(n + WINDOW_BYTES * (rows + 1), U64)
    h[place] = GEAR[data]
    step = 1
    while step < WINDOW_BYTES:
        h[step:] += h[:-step] << U64(step)
        step *= 2
    outside = np.ones(len(h), bool)
    outside[place] = False
    h[outside] = _LAST
    least, reach = h, 1
    while reach < REACH:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    here = h[place]
    before, behind = least[place - REACH], least[np.minimum(place + 1, len(least) - 1)]
    end = np.flatnonzero((here < before) & (here <= behind)) + 1
    end = np.unique(np.concatenate([end, _cuts_of_repeats(np.flatnonzero((here == before) & (here <= behind)) + 1, end, offsets)]))
    for _ in range(3):  # not within a character
        inside = (end < n) & ((data[np.minimum(end, n - 1)] & 0xC0) == 0x80)
        end = end + inside
    return np.unique(np.concatenate([end, offsets[1:][np.diff(offsets) > 0]]))


def _cuts_of_repeats(ties: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text that repeats itself has equal minima and no smallest one: there, every minimum far enough from the cut before it is a cut,
    so such text falls into equal chunks however long it is."""
    known = np.unique(np.concatenate([end, offsets]))
    at = np.searchsorted(known, ties, side="right") - 1
    gap = known[np.minimum(at + 1, len(known) - 1)] - known[at]
    out, last = [], -1
    for t, left in zip(ties[gap > LONG].tolist(), known[at][gap > LONG].tolist()):
        last = max(last, left)
        if t - last > 2 * REACH:
            out.append(t)
            last = t
    return np.array(out, np.int64)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """One row per chunk: uid (the row), doc_id, number, start, end (code points), words that begin in it, digest, and whether the row had it before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                end = cuts(part, own)
                if not len(end):
                    continue
                start = np.concatenate([[0], end[:-1]])
                row = np.searchsorted(own, start, side="right") - 1
                count = np.bincount(row, minlength=b - a)
                raw = part.tobytes()
                key = np.fromiter((digest(raw[i:j]) for i, j in zip(start.tolist(), end.tolist())), U64, len(end))
                order = np.lexsort((np.arange(len(key)), key, row))
                again = np.zeros(len(key), bool)
                again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
                space = SPACES[part]
                head = ~space
                head[1:] &= space[:-1]
                head[own[:-1][np.diff(own) > 0]] |= ~space[own[:-1][np.diff(own) > 0]]
                words = np.concatenate([[0], np.cumsum(head)])
                lead = code_points_before(part, np.arange(len(part) + 1))
                base = lead[own[row]]
                whose = pa.array(row + a)
                columns = [
                    batch.column(0).take(whose),
                    batch.column(1).take(whose),
                    pa.array(joined_rows(count).astype(np.int32)),
                    pa.array((lead[start] - base).astype(np.int32)),
                    pa.array((lead[end] - base).astype(np.int32)),
                    pa.array((words[end] - words[start]).astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(again),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "number", "start", "end", "words", "digest", "again"])

    known = numbered(docs.select("doc_id", "text"), "__uid").select(F.col("__uid").alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return known.mapInArrow(run, "uid long, doc_id long, number int, start int, end int, words int, digest long, again boolean")


def repeated_passages(spark: SparkSession, docs: DataFrame, *, least_words: int = 15) -> DataFrame:
    """One row per repeated passage: uid, doc_id, start, end, n_words, n_chunks, and the ids of the documents that had its chunks first.

    The run's own length decides, whoever had its chunks first: the halves of a passage may each stand in another document before. A document is named if it
    had ``least_words`` words of the passage first; if none had so many, all that had chunks of it are. A document that repeats itself names only itself and is not ``across``. ``docs`` is read from files: rows
    are known by their place in the files.
    """
    chunks = chunk_rows(docs)
    held = chunks.groupBy("digest").agg(F.min("uid").alias("first"), F.max("uid").alias("last"), F.min_by("doc_id", "uid").alias("first_id"))
    copied = chunks.join(held.filter("last > first").drop("last"), "digest", "left").filter("again or first < uid")
    copied = copied.withColumn("first_id", F.when(F.col("first") < F.col("uid"), F.col("first_id")).otherwise(F.col("doc_id")))
    order = Window.partitionBy("uid").orderBy("number")
    runs = copied.withColumn("run", F.col("number") - F.row_number().over(order)).groupBy("uid", "doc_id", "run", "first_id")
    pieces = runs.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count("*").alias("chunks"))
    # null ids are named too
    named = lambda rows: F.array_sort(F.transform(rows, lambda x: x["id"]))
    found = pieces.groupBy("uid", "doc_id", "run").agg(
        F.min("start").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        F.sum("words").alias("n_words"),
        F.sum("chunks").alias("n_chunks"),
        F.collect_list(F.struct(F.col("first_id").alias("id"), "words")).alias("holders"),
    )
    main = F.filter("holders", lambda x: x["words"] >= least_words)
    found = found.filter(F.col("n_words") >= least_words)
    return found.withColumn("first_doc_ids", F.when(F.size(main) > 0, named(main)).otherwise(named(F.col("holders")))).withColumn(
        "across", F.size(F.filter("first_doc_ids", lambda i: ~i.eqNullSafe(F.col("doc_id")))) > 0
    ).drop("run", "holders")


def without(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` without their repeated passages; read from the same files as for ``repeated_passages``."""
    spans = passages.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    joined = numbered(docs, "__uid").join(spans.withColumnRenamed("uid", "__uid"), "__uid", "left")
    count = F.size("__spans")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda x: x["end"]))
    ends = F.concat(F.transform("__spans", lambda x: x["start"]), F.array(F.length("text").cast("long")))
    kept = F.transform(F.sequence(F.lit(1), count + 1), lambda i: F.substring(F.col("text"), (F.element_at(starts, i) + 1).cast("int"), (F.element_at(ends, i) - F.element_at(starts, i)).cast("int")))
    return joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))).select(*docs.columns)


def op1_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, documents(spark, sf_dir)).drop("uid")
