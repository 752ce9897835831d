"""Operator 3: document fingerprints of closed syncmers.

A k-mer of bytes is a closed syncmer if the smallest hash among its inner s-mers is at its first or last place. That depends on the k-mer alone, so equal
passages have the same anchors at the same distances wherever they stand. ``anchors`` gives all of them with their positions; a
fingerprint is the ``size`` smallest different anchor hashes of a text, in the order of their first places, 8 hex digits each. Texts shorter than k
bytes are one anchor, empty ones have none. The likeness of two fingerprints is the share of anchors in common (Dice), estimated from the smallest
hashes of both together; it is 1 for two empty ones.

Texts meet their successors in range buckets of ``doc_id``, compressed before the shuffle; the first text of a bucket also goes to the end of the bucket
before it, and the very first to the end of the last. Equal ids are ordered by their content, null ids come first. Repeated rows are documents of their own; a
single document is its own successor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.shared import NULL_KEY, SLICE, U64, code_points_before, documents, range_bounds, slices, span_hashes, utf8

K, S = 16, 8
SIZE = 64


def syncmers(data: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte position, 32-bit hash and row of every anchor."""
    n = len(data)
    length = np.diff(offsets)
    short = np.flatnonzero((length < k) & (length > 0))
    at, hashes = offsets[short], span_hashes(data, offsets[short], offsets[short + 1])
    if n >= k:
        place = np.arange(n - s + 1)
        inner = span_hashes(data, place, place + s)
        width, least, reach = k - s + 1, inner, 1
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        found = np.flatnonzero((inner[: len(least)] == least) | (inner[width - 1 :] == least))
        row = np.searchsorted(offsets, found, side="right") - 1
        inside = found + k <= offsets[row + 1]
        found = found[inside]
        at = np.concatenate([at, found])
        hashes = np.concatenate([hashes, span_hashes(data, found, found + k)])
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
    return at, (hashes >> U64(32)).astype(np.uint32), np.searchsorted(offsets, at, side="right") - 1


def sketches(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """Per row, the smallest different anchor hashes in the order of their first places."""
    _, h, row = syncmers(data, offsets)
    cut = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for a, b in zip(cut.tolist(), cut[1:].tolist()):
        own = h[a:b]
        if b - a > 8 * size:  # a first guess at the range of the smallest ones
            few = np.unique(own[own < np.uint32((1 << 32) * (3 * size) // (b - a))])
            least = few[:size] if len(few) >= size else np.unique(own)[:size]
        else:
            least = np.unique(own)[:size]
        if len(least) == 0:
            out.append(least)
            continue
        at = np.flatnonzero(own <= least[-1])
        values, first = np.unique(own[at], return_index=True)
        out.append(values[np.argsort(first)])
    return out


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    if len(a) == 0 and len(b) == 0:
        return 1.0
    union = np.union1d(a, b)[:size]
    both = int((np.isin(union, a) & np.isin(union, b)).sum())
    return 2.0 * both / (len(union) + both)


def hexed(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def anchors(docs: DataFrame) -> DataFrame:
    """All anchors: doc_id, position in code points (of the character its first byte is in), hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                at, h, row = syncmers(part, own)
                place = code_points_before(part, at + 1) - 1 - code_points_before(part, own[row])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(row)), pa.array(place), pa.array(h.astype(np.int64))], names=["doc_id", "position", "hash"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, position long, hash long")


FINGERPRINTS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(spark: SparkSession, docs: DataFrame, *, parts: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, whose second half is the beginning of the next document."""
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = np.array(range_bounds(rows, F.coalesce("doc_id", F.lit(NULL_KEY)), parts), np.int64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            key = batch.column(0).fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(bounds, key, side="right") - 1
            data, offsets = utf8(batch.column(1))
            raw = [data[a:b].tobytes() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            packed, check = [compressor.compress(t) for t in raw], np.array([zlib.crc32(t) for t in raw], np.int64)
            tail = np.flatnonzero(key == bounds[bucket])
            take = np.concatenate([np.arange(len(key)), tail])
            to = np.concatenate([bucket, (bucket[tail] - 1) % len(bounds)])
            # 0 for a document at its own place, 1 for a copy at the end of a bucket
            late = np.concatenate([np.zeros(len(key), np.int8), np.ones(len(tail), np.int8)])
            columns = [pa.array(to), pa.array(late), pa.array(key[take]), pa.array(check[take]), batch.column(0).take(pa.array(take)), pa.array([packed[i] for i in take], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "late", "key", "check", "doc_id", "packed"])

    def pairs(chain: list[tuple[int | None, str]]) -> pa.RecordBatch:
        texts = [t for _, t in chain]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:])]
        own, new = (_sketched(x) for x in (texts, edited))
        columns = [
            pa.array([d for d, _ in chain[:-1]], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([hexed(x) for x in own[:-1]], pa.string()),
            pa.array([hexed(x) for x in new], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FINGERPRINTS.split(", ")])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        chain: list[tuple[int | None, str]] = []
        at, ended, size = None, False, 0
        for batch in batches:
            for bucket, late, doc_id, packed in zip(*(batch.column(k).to_pylist() for k in (0, 1, 4, 5))):
                if bucket != at:
                    chain, at, ended, size = [], bucket, False, 0
                if ended:
                    continue
                chain.append((doc_id, decompressor.decompress(packed).decode()))
                size += len(chain[-1][1])
                ended = late == 1
                if len(chain) > 1 and (ended or size > SLICE):
                    yield pairs(chain)
                    chain, size = chain[-1:], len(chain[-1][1])

    schema = "bucket long, late byte, key long, check long, doc_id long, packed binary"
    # a document and the copy of it that ends a bucket are never both last: late copies sort behind all documents of the bucket
    return rows.mapInArrow(dealt, schema).repartition(parts, "bucket").sortWithinPartitions("bucket", "late", "key", "check").mapInArrow(chained, FINGERPRINTS)


def _sketched(texts: list[str]) -> list[np.ndarray]:
    data, offsets = utf8(pa.array(texts, pa.string()))
    out: list[np.ndarray] = []
    for a, b in slices(offsets):
        out += sketches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
    return out


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark, documents(spark, sf_dir))
