"""Operator 8: SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint has 8 positional bytes. Two fingerprints that differ in at most 4 bits share at least 4 of them, so they share three bytes in
one of 20 triples of positions that between them lie in every set of 4 (``triples``). The index therefore has 20 postings for each different fingerprint, one
per triple and its bytes. In each posting list, pairs are tallied by the bytes they share; pairs reaching 4 are verified by their differing bits.

Copies collapse to one fingerprint first. Lists of up to ``pairwise`` members are compared pair by pair, all lists of a batch at once; longer ones
grow each component outwards, comparing a member only with those not yet reached, and give an edge for each member, not for each pair. A list of
more than ``most_members`` is dealt out by blocks: every two blocks meet in a list of their own, so no link is lost and no task gets a whole hot list.
Components come from ``components``; nothing but settings passes through the driver.

Edge cases: null, empty and white texts have fingerprint zero and are linked like any other; repeated rows are copies; a component of null ids only has a null
``component_id``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.components import components
from panelcast.llm.shared import LOWER, SPACES, U64, documents, joined_rows, mapped, numbered, runs, slices, stored, unused, utf8

WORDS = 4
BITS = 4
NIBBLES = np.array([sum(((v >> j) & 1) << (16 * j) for j in range(4)) for v in range(16)], U64)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as lower-cased words with one space behind each; start, end and row of every run of ``size`` words (or all words, if fewer)."""
    low = LOWER[data]
    word = ~SPACES[data]
    first, last, row = runs(word, offsets)
    length = last - first
    begin = np.cumsum(length + 1) - (length + 1)
    text = np.full(int(length.sum()) + len(length), 32, np.uint8)
    inside = np.ones(len(text), bool)
    inside[begin + length] = False
    text[inside] = low[word]
    count = np.bincount(row, minlength=len(offsets) - 1)
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    head = np.repeat(np.cumsum(count) - count, made) + joined_rows(made)
    own = np.repeat(np.arange(len(count)), made)
    tail = head + np.minimum(count[own], size) - 1
    return text.tobytes(), begin[head], begin[tail] + length[tail], own


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One fingerprint per row; zero without words."""
    from xxhash import xxh64_intdigest as digest

    text, first, last, row = shingles(data, offsets)
    out = np.zeros(len(offsets) - 1, U64)
    n = len(first)
    if not n:
        return out
    h = np.fromiter((digest(text[a:b], 42) for a, b in zip(first.tolist(), last.tolist())), U64, n)
    # sums of at most 2**15 shingles fit in 16 bits; a longer row is added up from several
    part = joined_rows(np.bincount(row, minlength=len(out)))
    begin = np.flatnonzero(part % (1 << 15) == 0)
    owner = row[begin]
    rows, group = np.unique(owner, return_inverse=True)
    total = np.bincount(row, minlength=len(out))[rows]
    for k in range(16):
        lanes = np.add.reduceat(NIBBLES[((h >> U64(4 * k)) & U64(15)).astype(np.intp)], begin)
        for j in range(4):
            ones = np.bincount(group, weights=((lanes >> U64(16 * j)) & U64(0xFFFF)).astype(np.float64))
            out[rows] |= (2 * ones > total).astype(U64) << U64(4 * k + j)
    return out


def with_fingerprints(docs: DataFrame, *, text: str = "text", name: str = "fp") -> DataFrame:
    """The columns of ``docs`` and the fingerprint as a signed long."""
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            fps = [fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            whole = np.concatenate([*fps, np.zeros(0, U64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(whole)], names=[str(k) for k in range(len(names) + 1)])

    schema = T.StructType([*(T.StructField(str(k), f.dataType, True) for k, f in enumerate(docs.schema.fields)), T.StructField(str(len(names)), T.LongType())])
    return mapped(docs.toDF(*[f"c{k}" for k in range(len(names))]), run, schema).toDF(*names, name)


def triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 positions such that any 4 positions contain one (a Turan system): positions fall into three groups; a triple lies in
    one group, or has two positions in one group and one in the next."""
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    return [t for t in combinations(range(8), 3) if len(g := {group[x] for x in t}) == 1 or (len(g) == 2 and _two_then_next([group[x] for x in t]))]


def _two_then_next(groups: list[int]) -> bool:
    double = max(groups, key=groups.count)
    return (double + 1) % 3 in groups


def linked(difference: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Count filter, then verification, on differences of fingerprints."""
    y = difference | (difference >> U64(4))
    y |= y >> U64(2)
    y |= y >> U64(1)
    shared = 8 - np.bitwise_count(y & U64(0x0101010101010101))
    good = shared >= 8 - bits
    good[good] = np.bitwise_count(difference[good]) <= bits
    return good


def grown(members: np.ndarray, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges (member, root of its component in this list)."""
    out, left = [], members
    while len(left):
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = linked(left ^ front.pop(), bits)
            if near.any():
                reached = left[near]
                left = left[~near]
                front.extend(reached)
                out.append((reached, np.full(len(reached), root, U64)))
    return out


def list_edges(key: np.ndarray, fp: np.ndarray, pairwise: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges within the posting lists of a sorted batch."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(cut)
    out = []
    for a, n in zip(cut[:-1][size > pairwise].tolist(), size[size > pairwise].tolist()):
        out += grown(np.unique(fp[a : a + n]), bits)
    small = np.repeat((size > 1) & (size <= pairwise), size)
    key, fp = key[small], fp[small]
    for lag in range(1, min(pairwise, len(key))):
        same = np.flatnonzero(key[lag:] == key[:-lag])
        if not len(same):
            break
        good = same[linked(fp[same + lag] ^ fp[same], bits)]
        out.append((fp[good + lag], fp[good]))
    return out


def links(spark: SparkSession, fps: DataFrame, *, bits: int = BITS, pairwise: int = 16, most_members: int = 20_000) -> DataFrame:
    """Edges (a, b) between different fingerprints (column ``fp``) that connect all that are within ``bits`` of each other."""
    if bits > BITS:
        raise ValueError("the index is complete up to 4 differing bits")
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(255) for i in range(8)]
    keys = [F.lit(k << 24) + byte[a] * (1 << 16) + byte[b] * (1 << 8) + byte[c] for k, (a, b, c) in enumerate(triples())]
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = stored(spark, postings.groupBy("key").count().filter(F.col("count") > most_members), "hot-lists")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    blocks = hot.select("key", F.ceil(F.col("count") / most_members).cast("long").alias("blocks"))
    joined = postings.join(blocks, "key", "left")
    cold = joined.filter("blocks is null").select("fp", F.struct("key", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y")).alias("list"))
    split = joined.filter("blocks is not null").select("fp", "key", block.alias("own"), other.alias("other"))
    split = split.select("fp", F.struct("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).alias("list"))
    # a list is named by one number, so that a task sees where it ends
    named = (cold if hot.isEmpty() else cold.unionByName(split)).select("fp", F.expr("list.key"), F.expr("list.x"), F.expr("list.y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((4, 0), np.int64)

        def edges(table: np.ndarray) -> pa.RecordBatch:
            name = np.concatenate([[0], np.cumsum((table[1:, 1:] != table[1:, :-1]).any(0))]) if table.shape[1] else np.zeros(0, np.int64)
            found = list_edges(name, table[0].view(U64), pairwise, bits)
            a, b = (np.concatenate([*(f[k] for f in found), np.zeros(0, U64)]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held = [rest]
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([c.to_numpy() for c in batch.columns])
            end = np.flatnonzero((table[1:] != table[1:, -1:]).any(0))
            at = int(end[-1]) + 1 if len(end) else 0
            before = held[-1] if held[-1].shape[1] else None
            if at == 0 and (before is None or (before[1:, -1] == table[1:, 0]).all()):
                held.append(table)  # the whole batch belongs to the list at hand
                continue
            yield edges(np.concatenate([*held, table[:, :at]], axis=1))
            held = [table[:, at:]]
        yield edges(np.concatenate(held, axis=1))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = named.repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y")
    return mapped(dealt, run, "a long, b long").distinct()


def near_duplicates(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """For stored rows with ``doc_id`` and ``fp``: every different fingerprint with ``root``, the fingerprint that names its component."""
    fps = stored(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    found = components(spark, links(spark, fps.select("fp")))
    return fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each component: the smallest ``doc_id`` (null before all), the first in the files among equal ids.

    ``docs`` is read from files: rows are numbered by their place in the files, fingerprints and numbers are stored, and only the second
    scan carries texts. It leaves out the numbers of the rows that go: where these are few enough to be broadcast, no text is shuffled. Rows meet
    their class as one first row for each fingerprint, so copies are no hot key. Other columns may have any names.
    """
    uid = unused(docs.columns) + "uid"
    known = numbered(docs, uid)
    rows = stored(spark, with_fingerprints(known.select("doc_id", "text", F.col(uid).alias("uid"))).drop("text"), "simhash")
    classes = near_duplicates(spark, rows).select("fp", "root")
    firsts = rows.groupBy("fp").agg(F.min(F.struct("doc_id", "uid")).alias("first")).join(classes, "fp")
    kept = stored(spark, firsts.groupBy("root").agg(F.min("first").alias("first")).select("first.uid"), "kept")
    gone = stored(spark, rows.select("uid").join(kept, "uid", "left_anti"), "gone")
    return known.join(gone.withColumnRenamed("uid", uid), uid, "left_anti").select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = stored(spark, with_fingerprints(docs).drop("text"), "simhash")
    classes = stored(spark, near_duplicates(spark, rows), "classes")
    named = classes.join(classes.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
