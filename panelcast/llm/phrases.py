"""Operator 13: collocations from depth-truncated suffix trees, built independently by vertical partitioning (after ERA).

1. *Vertical partitioning.* One scan counts, for every word occurrence, the prefixes of 1 to ``most_words`` words of the suffix that begins there, in hashed cells
   (``2**bits[0]`` for one word, ``2**bits[1]`` for each greater length). Prefixes whose cell holds at most ``budget`` suffixes are packed into groups of about ``budget``; a fuller
   prefix is replaced by its extensions by one more word. Cells only overestimate: they decide where a suffix goes and which prefixes are too rare to go on.
2. *Subtrees.* A second scan sends each suffix, cut after ``most_words`` words, at the end of its piece, or before a prefix that is too rare, to its group: packed, with equal
   suffixes of a slice counted, as codes of a dictionary of words. Each group builds its subtree level by level, going on below
   nodes that occur ``least`` times only; the count of a node is the total of the leaves below it. Prefixes shorter than those a group was
   partitioned by are counted in parts, which Spark adds up.
3. *Scores.* Frequencies of both sides of every cut are joined by phrase; products are decimals of 38 digits, so nothing overflows or rounds. The best of each language are
   found in salted parts before they meet.

What passes through the driver is the cells, whose number depends on ``bits`` alone, and counts of rows. A cell should hold a small part of ``budget``: the default serves
some 10**10 words, and ten bits more serve a thousand times that. Tables of node frequencies and of languages are broadcast up to
``most_broadcast`` rows and joined by shuffle beyond.

Defined results: a null text is empty, a null language is ``und``; texts of any length are processed whole; repeated rows count each; ties are broken by the smallest cut, then by the
phrase; an empty table, or one without frequent phrases, gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.shared import LOWER, U64, byte_class, documents, mixed, runs, slices, span_hashes, stored, utf8

LEAST, MOST_WORDS, TOP = 100, 5, 2000
#: cells of prefixes of one word, and of each greater length, as powers of two
BITS = (17, 13)
STEP = U64(0x9FB21C651E98DF25)
BREAKS = byte_class(b".,;:!?\n\v\f\r")
#: bytes of text that are cut into suffixes at a time
TEXT = 1 << 21


@dataclass
class Suffixes:
    """All suffixes of the pieces of some texts: word hashes by depth (0 beyond the end), and where the words lie."""

    low: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, depth: int) -> Suffixes:
        low = LOWER[data]
        breaks = BREAKS[low]
        first, last, row = runs(~breaks & (low != 32) & (low != 9), offsets)
        n = len(first)
        before = np.cumsum(breaks, dtype=np.int64)[first] if n else np.zeros(0, np.int64)
        new = np.ones(n + 1, bool)
        new[1:n] = (before[1:] != before[:-1]) | (row[1:] != row[:-1])
        begins = np.flatnonzero(new)
        left = np.repeat(begins[1:], np.diff(begins)) - np.arange(n)  # words from here to the end of the piece
        own = span_hashes(low, first, last) | U64(1)
        words = np.zeros((depth, n), U64)
        for k in range(min(depth, n)):
            words[k, : n - k] = np.where(left[: n - k] > k, own[k:], U64(0))
        return cls(low, first, last, row, words)

    def prefixes(self, lang: np.ndarray) -> np.ndarray:
        """Hashes of the language and the first words, by depth."""
        out, h = np.empty_like(self.words), lang[self.row]
        for k in range(len(out)):
            h = out[k] = mixed(h * STEP + self.words[k])
        return out


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different languages of a batch, the place of each row's, and the hash of each row's."""
    coded = column.dictionary_encode()
    names = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy().astype(np.int64)
    known = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], U64)
    return names, code, known[code] if len(names) else np.zeros(0, U64)


def _texts(batches: Iterator[pa.RecordBatch], depth: int):
    """(suffixes, languages, place of each row's language, prefix hashes) for each slice of the texts."""
    for batch in batches:
        names, code, lang = _languages(batch.column(0))
        data, offsets = utf8(batch.column(1))
        for a, b in slices(offsets, TEXT):
            found = Suffixes.of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], depth)
            yield found, names, code[a:b], found.prefixes(lang[a:b])


# ---- vertical partitioning


def first_cells(depth: int, bits: tuple[int, int]) -> list[int]:
    """Where the cells of each depth begin, and where they end."""
    return [0, *((1 << bits[0]) + (k << bits[1]) for k in range(depth))]


def cells_of(prefix: np.ndarray, k: int, bits: tuple[int, int]) -> np.ndarray:
    return (prefix[k] >> U64(64 - bits[min(k, 1)])).astype(np.int64)


def cell_counts(docs: DataFrame, depth: int, bits: tuple[int, int]) -> DataFrame:
    """Suffixes by cell, and in rows with cell -1 the words of each language."""
    begin = first_cells(depth, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(begin[-1], np.int64)
        words: dict[str, int] = {}
        for found, names, code, prefix in _texts(batches, depth):
            for k in range(depth):
                total[begin[k] : begin[k + 1]] += np.bincount(cells_of(prefix, k, bits)[found.words[k] != 0], minlength=begin[k + 1] - begin[k])
            for name, n in zip(names, np.bincount(code[found.row], minlength=len(names)).tolist()):
                words[name] = words.get(name, 0) + n
        some = np.flatnonzero(total)
        cells = [*some.tolist(), *[-1] * len(words)]
        columns = [pa.array(cells, pa.int64()), pa.array([*[None] * len(some), *words], pa.string()), pa.array([*total[some].tolist(), *words.values()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "lang", "n"])

    return docs.mapInArrow(run, "cell long, lang string, n long").groupBy("cell", "lang").agg(F.sum("n").alias("n"))


def virtual_trees(count: list[np.ndarray], budget: int) -> tuple[list[np.ndarray], list[int]]:
    """The group of each cell (-1: fuller than ``budget``, take the next depth), and the depth that each group was partitioned by."""
    group, depths = [np.full(len(n), -1, np.int32) for n in count], []
    for k, n in enumerate(count):
        if k and (count[k - 1] <= budget).all():
            break  # no prefix of the depth before is too full
        fits = (n > 0) & ((n <= budget) | (k == len(count) - 1))
        filled = np.cumsum(np.where(fits, np.minimum(n, budget), 0))
        number = np.where(fits, (filled - 1) // budget, -1)
        used, place = np.unique(number[fits], return_inverse=True)
        group[k][fits] = len(depths) + place
        depths += [k + 1] * len(used)
    return group, depths


# ---- subtrees


def packed(weight: np.ndarray, lang: np.ndarray, code: np.ndarray, names: list[str], words: list[bytes]) -> bytes:
    """Suffixes as columns of little-endian numbers and a dictionary; 0 is no word."""
    import zstandard

    width = "<u2" if len(words) < 1 << 16 else "<u4"
    head = np.array([len(weight), len(code), int(width == "<u4"), len(names), len(words)], "<u4").tobytes()
    tail = b"\n".join([*(n.encode().hex().encode() for n in names), *words])
    return zstandard.ZstdCompressor(level=1).compress(head + weight.astype("<u4").tobytes() + lang.astype("<u2").tobytes() + code.astype(width).tobytes() + tail)


def unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], list[bytes]]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(body)
    m, depth, wide, n_names, n_words = np.frombuffer(raw, "<u4", 5).tolist()
    width = 4 if wide else 2
    weight = np.frombuffer(raw, "<u4", m, 20)
    lang = np.frombuffer(raw, "<u2", m, 20 + 4 * m)
    code = np.frombuffer(raw, f"<u{width}", m * depth, 20 + 6 * m).reshape(depth, m)
    tail = raw[20 + 6 * m + width * m * depth :].split(b"\n")
    return weight, lang, code, [bytes.fromhex(x.decode()).decode() for x in tail[:n_names]], tail[n_names:][:n_words]


class Outbox:
    """Suffixes of a task by tree, as numbers of the words met in it, until there are enough of them to be packed."""

    def __init__(self) -> None:
        self.hashes, self.numbers = np.zeros(0, U64), np.zeros(0, np.int32)
        self.text: list[bytes] = [b""]
        self.langs: dict[str, int] = {}
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, found: Suffixes, names: list[str], code: np.ndarray, tree: np.ndarray, own: np.ndarray, shown: np.ndarray, weight: np.ndarray) -> None:
        """``own`` are the places of suffixes, of whose words the first ``shown`` go out."""
        depth = np.arange(len(found.words))[:, None]
        member = np.where(depth < shown, found.words[:, own], U64(0))
        known, first, coded = np.unique(member, return_index=True, return_inverse=True)
        number = np.zeros(len(known), np.int32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, known), len(self.hashes) - 1)
            number = np.where(self.hashes[at] == known, self.numbers[at], 0).astype(np.int32)
        new = np.flatnonzero((number == 0) & (known != 0))
        source = (own + depth).ravel()[first[new]]  # the word at depth k of a suffix is the k-th after it
        number[new] = np.arange(len(self.text), len(self.text) + len(new))
        self.text += [found.low[s:e].tobytes() for s, e in zip(found.first[source].tolist(), found.last[source].tolist())]
        order = np.argsort(merged := np.concatenate([self.hashes, known[new]]), kind="stable")
        self.hashes, self.numbers = merged[order], np.concatenate([self.numbers, number[new]])[order]
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in names], np.int32)[code[found.row[own]]]
        self.held.append((tree.astype(np.int32), weight.astype(np.int64), lang, number[coded.reshape(member.shape)]))
        self.size += len(own)

    def flush(self) -> pa.RecordBatch:
        """One packed body for each tree; suffixes are sorted, so that equal beginnings pack well."""
        tree, weight, lang = (np.concatenate([h[k] for h in self.held]) for k in range(3))
        code = np.concatenate([h[3] for h in self.held], axis=1)
        self.held, self.size = [], 0
        order = np.lexsort((code[1] if len(code) > 1 else code[0], code[0], tree))
        tree, weight, lang, code = tree[order], weight[order], lang[order], code[:, order]
        some, begin = np.unique(tree, return_index=True)
        bodies, names = [], list(self.langs)
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(tree)]):
            words, local = np.unique(code[:, a:b], return_inverse=True)
            local = local.reshape(len(code), b - a) + int(words[0] != 0)
            langs, own = np.unique(lang[a:b], return_inverse=True)
            bodies.append(packed(weight[a:b], own, local, [names[k] for k in langs.tolist()], [self.text[k] for k in words.tolist() if k]))
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(bodies, pa.binary())], names=["tree", "body"])


def suffixes_by_group(spark: SparkSession, docs: DataFrame, count: list[np.ndarray], group: list[np.ndarray], least: int, bits: tuple[int, int], batch: int = 1_200_000) -> DataFrame:
    """(tree, body): packed suffixes of each group, about ``batch`` suffixes of a task at a time."""
    sent = spark.sparkContext.broadcast(([n >= least for n in count], group))
    depth = len(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, trees = sent.value
        box = Outbox()
        for found, names, code, prefix in _texts(batches, depth):
            words, tree, going = found.words, np.full(prefix.shape[1], -1, np.int32), np.ones(prefix.shape[1], bool)
            shown = np.zeros(prefix.shape[1], np.int32)
            for k in range(depth):
                cell = cells_of(prefix, k, bits)
                tree = np.where(tree < 0, trees[k][cell], tree)
                going &= (words[k] != 0) & often[k][cell]
                shown += going
            # equal suffixes of the slice become one: a suffix is named by the hash of the prefix that is shown
            use = np.flatnonzero(shown > 0)
            name = prefix[shown[use] - 1, use] ^ mixed(tree[use].astype(U64))
            _, at, weight = np.unique(name, return_index=True, return_counts=True)
            use = use[at]
            box.add(found, names, code, tree[use], use, shown[use], weight)
            if box.size >= batch:
                yield box.flush()
        if box.size:
            yield box.flush()

    return docs.mapInArrow(run, "tree int, body binary")


def subtree(bodies: list[bytes], least: int, whole_from: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, words, count) of every node that occurs ``least`` times; those shorter than ``whole_from`` words, which other groups share, at any count."""
    words: dict[bytes, int] = {}
    langs: dict[str, int] = {}
    parts = []
    for body in bodies:
        weight, lang, code, names, own = unpacked(body)
        table = np.array([0, *(words.setdefault(w, len(words) + 1) for w in own)], np.int32)
        lang_table = np.array([langs.setdefault(x, len(langs)) for x in names], np.int32)
        parts.append((weight, lang_table[lang], table[code]))
    text, names = [b"", *words], list(langs)
    weight, node = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64)
    code = np.concatenate([p[2] for p in parts], axis=1)
    paths = [(name, ()) for name in names]
    active = np.arange(len(weight))
    for k in range(len(code)):
        active = active[code[k][active] > 0]
        if not len(active):
            return
        child, leaf = np.unique(node[active] * len(text) + code[k][active], return_inverse=True)
        total = np.bincount(leaf, weights=weight[active]).astype(np.int64)
        keep = total >= least if k + 1 >= whole_from else np.ones(len(total), bool)
        number = np.cumsum(keep) - 1
        paths = [(paths[p][0], (*paths[p][1], w)) for p, w in zip((child[keep] // len(text)).tolist(), (child[keep] % len(text)).tolist())]
        for (name, path), n in zip(paths, total[keep].tolist()):
            yield name, [text[w] for w in path], n
        node[active] = number[leaf]
        active = active[keep[leaf]]


def phrase_counts(spark: SparkSession, docs: DataFrame, *, least: int, most_words: int, budget: int, bits: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(nodes, totals): lang, phrase, words and n of every phrase of up to ``most_words`` words that occurs ``least`` times; lang and words of each language."""
    cells = stored(spark, cell_counts(docs, most_words, bits), "cells")
    table = cells.filter("cell >= 0").select("cell", "n").toArrow()  # one row for each cell at most
    begin = first_cells(most_words, bits)
    flat = np.zeros(begin[-1], np.int64)
    flat[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    count = [flat[a:b] for a, b in zip(begin, begin[1:])]
    group, depths = virtual_trees(count, budget)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies: dict[int, list[bytes]] = {}
        for batch in batches:
            for tree, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bodies.setdefault(tree, []).append(body)
        for tree in sorted(bodies):
            nodes = list(subtree(bodies.pop(tree), least, depths[tree]))
            columns = [[x[0] for x in nodes], [b" ".join(x[1]).decode() for x in nodes], [len(x[1]) for x in nodes], [x[2] for x in nodes]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()))], names=["lang", "phrase", "words", "n"])

    sent = suffixes_by_group(spark, docs, count, group, least, bits)
    found = sent.repartitionById(max(len(depths), 1), "tree").mapInArrow(run, "lang string, phrase string, words int, n long")
    nodes = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return stored(spark, nodes, "phrases"), cells.filter("cell < 0").select("lang", F.col("n").alias("total"))


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    top: int = TOP,
    budget: int = 2_000_000,
    bits: tuple[int, int] = BITS,
    most_broadcast: int = 1_000_000,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    nodes, totals = phrase_counts(spark, plain, least=least, most_words=most_words, budget=budget, bits=bits)
    small = nodes.count() <= most_broadcast
    sent = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    totals = F.broadcast(totals) if totals.count() <= most_broadcast else totals
    phrases = nodes.filter("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))

    inner = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    longer = phrases.filter("words >= 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = phrases.join(longer, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * a").drop("longer")

    cuts = left.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("one"), F.expr("substring_index(phrase, ' ', k - words)").alias("two"))
    cuts = cuts.join(sent(nodes.select("lang", F.col("phrase").alias("one"), F.col("n").alias("l"))), ["lang", "one"])
    cuts = cuts.join(sent(nodes.select("lang", F.col("phrase").alias("two"), F.col("n").alias("r"))), ["lang", "two"]).join(totals, "lang")
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"({wide('1000 * a')} * {wide('total')}) div ({wide('l')} * {wide('r')})")
    lowest = cuts.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", F.expr("cut.l"), F.expr("cut.r"), F.col("total").alias("n"), F.expr("cut.score").cast("long").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return salted.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, documents(spark, sf_dir))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3, 4, 5]) AS m))),
nodes AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
cands AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM nodes WHERE m >= 2),
inner_phrases AS (
    SELECT lang, array_to_string(w[1 : m - 1], ' ') AS phrase, a FROM cands WHERE m >= 3
    UNION ALL SELECT lang, array_to_string(w[2 : m], ' '), a FROM cands WHERE m >= 3),
kept AS (SELECT c.* FROM cands c LEFT JOIN (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL) i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n::BIGINT AS n, ((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN nodes l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.k], ' ')
    JOIN nodes r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ') JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest QUALIFY rank <= 2000
"""
