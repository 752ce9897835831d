"""Operator 9: benchmark decontamination with one FM-index per training shard.

A shard is a slice of one task's documents. Its words, as numbers of the benchmark's vocabulary, form the indexed text: suffixes are sorted by prefix
doubling, their Burrows-Wheeler transform lies in a wavelet matrix, and suffix positions are sampled. All windows of the benchmark are searched backwards
at once; occurrences are located by walking to a sampled position, and the words they cover are merged into removal spans.

Two things keep the index small and its depth bounded, without changing any result: a word that no window has cannot lie in an occurrence, so it
only ends a segment, and segments shorter than the shortest window are left out; a long segment is cut into blocks that overlap by one word
less than a window. Each segment ends in a separator of its own rank, so suffixes differ within one block.

Nothing is shuffled: a document is handled whole by the task that reads it. Benchmark items are fetched and sent to the tasks in blocks of at most
``block_chars`` characters (or one item); with several blocks the documents are scanned once for each, and their hits are merged per document.

Edge cases: null texts have no words; items without words have no window; null item ids are not listed, but their windows count as hits; repeated
items count once; repeated documents give a row each; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.shared import ALNUM, LOWER, U64, code_points_before, documents, joined_rows, mapped, numbered, runs, slices, span_hashes, unused, utf8, without

WINDOW = 13
SAMPLE_RATE = 8
BLOCK = 256
SHARD_BYTES = 1 << 20


class Windows:
    """The windows of some benchmark items, grouped by length; every different window once, with the items that have it."""

    def __init__(self, items: Sequence[tuple[int | None, str | None]], window: int = WINDOW) -> None:
        data, offsets = utf8(pa.array([t for _, t in items], pa.string()))
        data = LOWER[data]
        first, last, row = runs(ALNUM[data], offsets)
        h = span_hashes(data, first, last)
        self.vocabulary, number = np.unique(h, return_inverse=True)
        number = number + 1  # 0 is a word that no window has
        words = np.bincount(row, minlength=len(items))
        begin = np.cumsum(words) - words
        self.groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        ids = np.array([-1 if i is None else k for k, (i, _) in enumerate(items)], np.int64)
        self.names = ["" if i is None else str(i) for i, _ in items]
        for width in sorted({min(window, int(n)) for n in words if n}):
            own = np.flatnonzero(np.minimum(words, window) == width)
            counts = words[own] - width + 1
            starts = np.repeat(begin[own], counts) + joined_rows(counts)
            patterns, which = np.unique(number[starts[:, None] + np.arange(width)], axis=0, return_inverse=True)
            pair = np.unique(np.stack([which.ravel(), np.repeat(ids[own], counts)], axis=1), axis=0)
            self.groups.append((width, patterns, np.searchsorted(pair[:, 0], np.arange(len(patterns) + 1)), pair[:, 1]))
        self.shortest = min((g[0] for g in self.groups), default=0)
        self.longest = max((g[0] for g in self.groups), default=0)


class FMIndex:
    """Counts and locates patterns in segments of positive symbols; ``text`` has a 0 behind each segment."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text)
        order = self._sorted_suffixes(text)
        before = text[order - 1]
        self.sampled = (order % SAMPLE_RATE == 0) | (before == 0)
        self.sampled_before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.n = n
        # the wavelet matrix: for each bit, from the highest, the ones before each place, and how many zeros there are
        self.levels: list[tuple[int, np.ndarray, int]] = []
        now = before
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (now >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((shift, ones, n - int(ones[-1])))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    @staticmethod
    def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
        n = len(text)
        ends = text == 0
        rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())).astype(np.int64)
        width = 1
        while True:
            ahead = np.concatenate([rank[width:], np.zeros(min(width, n), np.int64)])[:n]
            key = (rank << 32) | ahead
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            if rank[order[-1]] == n - 1:
                return order
            width *= 2

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            up = ones[place]
            place = np.where((symbol >> shift) & 1, zeros + up, place - up)
        return place

    def step(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """First row of the symbol plus its occurrences in the transform before a place."""
        return self.less[symbol] + self._descend(symbol, place) - self.base[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The patterns that occur, and their ranges of rows."""
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low, high = self.step(symbol, low), self.step(symbol, high)
            on = high > low
            alive, low, high = alive[on], low[on], high[on]
        return alive, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions in the text of some rows."""
        place, steps, left = np.empty(len(row), np.int64), 0, np.arange(len(row))
        while len(left):
            here = self.sampled[row]
            place[left[here]] = self.samples[self.sampled_before[row[here]]] + steps
            left, row = left[~here], row[~here]
            symbol, at = np.zeros(len(row), np.int64), row
            for shift, ones, zeros in self.levels:
                up, bit = ones[at], ones[at + 1] - ones[at]
                symbol |= bit << shift
                at = np.where(bit, zeros + up, at - up)
            row = self.less[symbol] + at - self.base[symbol]
            steps += 1
        return place


def segments(number: np.ndarray, row: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """The text to index, and the word at each of its places (-1 at separators)."""
    known = np.flatnonzero(number)
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.flatnonzero((np.diff(known) > 1) | (np.diff(row[known]) > 0)) + 1
    first = known[np.concatenate([[0], breaks])]
    last = known[np.concatenate([breaks - 1, [len(known) - 1]])] + 1
    long = last - first >= windows.shortest
    first, last = first[long], last[long]
    blocks = np.maximum(1, -(-(last - first - windows.longest + 1) // BLOCK))
    begin = np.repeat(first, blocks) + BLOCK * joined_rows(blocks)
    size = np.minimum(np.repeat(last, blocks) - begin, BLOCK + windows.longest - 1) + 1
    word = np.repeat(begin, size) + joined_rows(size)
    word[np.cumsum(size) - 1] = -1
    return np.where(word < 0, 0, number[word]), word


def hits(data: np.ndarray, offsets: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """For one shard: words per row; hit flag, start, end (bytes) and row of each word; and different (row, item place) pairs."""
    low = LOWER[data]
    first, last, row = runs(ALNUM[low], offsets)
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    edge = np.zeros(len(first) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    if len(first) and windows.groups:
        h = span_hashes(low, first, last)
        place = np.minimum(np.searchsorted(windows.vocabulary, h), len(windows.vocabulary) - 1)
        number = np.where(windows.vocabulary[place] == h, place + 1, 0)
        text, word = segments(number, row, windows)
        if len(text):
            index = FMIndex(text, len(windows.vocabulary) + 1)
            for width, patterns, at, items in windows.groups:
                which, lo, hi = index.search(patterns)
                where = word[index.locate(np.repeat(lo, hi - lo) + joined_rows(hi - lo))]
                edge += np.bincount(where, minlength=len(edge)) - np.bincount(where + width, minlength=len(edge))
                found = np.unique(np.stack([row[where], np.repeat(which, hi - lo)], axis=1), axis=0)
                count = at[found[:, 1] + 1] - at[found[:, 1]]
                own = items[np.repeat(at[found[:, 1]], count) + joined_rows(count)]
                pairs.append(np.stack([np.repeat(found[:, 0], count), own], axis=1))
    pair = np.unique(np.concatenate(pairs), axis=0)
    return n_words, np.cumsum(edge[:-1]) > 0, first, last, row, pair[pair[:, 1] >= 0]


def removal_spans(data: np.ndarray, offsets: np.ndarray, hit: np.ndarray, first: np.ndarray, last: np.ndarray, row: np.ndarray) -> list[list[dict]]:
    """Per row, the merged spans of neighbouring hit words, in code points."""
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    place = np.flatnonzero(hit)
    if len(place):
        new = np.concatenate([[True], (np.diff(place) > 1) | (np.diff(row[place]) > 0)])
        begin, end = place[new], place[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(place) - 1]])]
        base = code_points_before(data, offsets[row[begin]])
        starts, ends = code_points_before(data, first[begin]) - base, code_points_before(data, last[end]) - base
        for r, s, e in zip(row[begin].tolist(), starts.tolist(), ends.tolist()):
            out[r].append({"start": s, "end": e})
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_windows(spark: SparkSession, docs: DataFrame, items: Sequence[tuple], *, text: str = "text", prefix: str = "", window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` and, with the prefix, n_words, n_hit, items (their ids as strings) and spans, for items that fit in a task.

    Input columns named like the made ones are replaced.
    """
    docs = without(docs, *(prefix + n for n in ("n_words", "n_hit", "items", "spans")))
    sent = spark.sparkContext.broadcast(list(items))
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(sent.value, window)
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for a, b in slices(offsets, SHARD_BYTES):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                n_words, hit, first, last, row, pair = hits(part, own, windows)
                cuts = np.searchsorted(pair[:, 0], np.arange(b - a + 1))
                found = [sorted({windows.names[k] for k in pair[i:j, 1].tolist()}) for i, j in zip(cuts, cuts[1:])]
                results = [
                    pa.array(n_words.astype(np.int64)),
                    pa.array(np.bincount(row[hit], minlength=b - a).astype(np.int64)),
                    pa.array(found, pa.list_(pa.string())),
                    pa.array(removal_spans(part, own, hit, first, last, row), _ARROW_SPANS),
                ]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *results], names=[str(k) for k in range(len(names) + 4)])

    made = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.StringType())), ("spans", SPANS)]
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    schema = T.StructType([*(T.StructField(str(k), f.dataType, True) for k, f in enumerate(docs.schema.fields)), *(T.StructField(str(len(names) + k), t) for k, (_, t) in enumerate(made))])
    return mapped(plain, run, schema).toDF(*names, *(prefix + n for n, _ in made))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, prefix: str = "", window: int = WINDOW, block_chars: int = 8 << 20) -> DataFrame:
    """The columns of ``docs`` plus n_words, n_hit, items, spans and ``contaminated``: at least a twentieth of the words lie in windows.

    Null texts have no words and are clean, as are all with an empty benchmark; repeated items count once, rows of ``docs`` each for itself; a very long text is one
    shard; hits of equal windows go to every item that has them; input columns named like the made ones are replaced, others may have any names.
    """
    docs = without(docs, *(prefix + n for n in ("n_words", "n_hit", "items", "spans", "contaminated")))
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).distinct()
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_chars))
    if blocks == 1:
        found = find_windows(spark, docs, [tuple(r) for r in items.collect()], prefix=prefix, window=window)
    else:
        # a document's hits of all blocks meet under the row's place in the files, which is the same in every scan
        names, free = docs.columns, unused([*docs.columns, prefix])
        number, every = free + "uid", free + "all"
        known = numbered(docs, number)
        slim = known.select(number, "text")
        parts = []
        for k in range(blocks):
            own = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
            parts.append(find_windows(spark, slim, own, window=window).select(number, "n_words", "items", "spans"))
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
        merged = union.groupBy(number).agg(
            F.max("n_words").alias(prefix + "n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(prefix + "items"), F.flatten(F.collect_list("spans")).alias(every)
        )
        whole = known.join(merged, number).drop(number)
        found = _counted(whole, prefix, every).select(*names, *(prefix + c for c in ("n_words", "n_hit", "items", "spans")))
    n_hit, n_words = F.col(prefix + "n_hit"), F.col(prefix + "n_words")
    return found.withColumn(prefix + "contaminated", (n_hit > 0) & (20 * n_hit >= n_words))


def _counted(df: DataFrame, prefix: str, every: str) -> DataFrame:
    """Merge the spans of several blocks and count the words in them; spans begin and end with words."""
    merged = F.expr(
        f"""aggregate(array_sort({every}), cast(array() as array<struct<start: bigint, end: bigint>>), (acc, s) ->
        case when size(acc) > 0 and element_at(acc, -1).end >= s.start
        then concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, s.end))))
        else concat(acc, array(s)) end)"""
    )
    words = F.expr(f"aggregate({prefix}spans, 0L, (n, s) -> n + regexp_count(substring(text, cast(s.start + 1 as int), cast(s.end - s.start as int)), '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+'))")
    return df.withColumn(prefix + "spans", merged).withColumn(prefix + "n_hit", words)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM d, ms, unnest(range(1, len(w) - m + 2)) t(i) WHERE len(w) >= m),
occ AS (SELECT rid, i, dw.m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM occ) GROUP BY rid),
it AS (SELECT rid, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
