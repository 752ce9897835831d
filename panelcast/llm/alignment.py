"""Operator 12: align the tokens of two tokenizers by lockstep vectorised merging.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model; both see a space and the text. One pair of pointers, to the next A and
the next B token, moves over every document of a slice at the same time: in each step, one NumPy comparison of the byte ends under the pointers advances the side that
ends earlier, or both where they end together, which emits a link and cuts the document into one more group. Finished documents are
compacted away. A long document is cut at ends that both sides share (first looked for every ``LANE`` bytes), so its stretches move in step
with each other and a slice needs about as many steps as a stretch has tokens.

Corpus counts of linked id pairs come from stored pair codes, summed within each task, then by Spark. Two tokens can end together only if the bytes of one are a
suffix of the bytes of the other, so there are at most ``most_pairs()`` different pairs (324,300 for these two vocabularies), whatever the corpus: that is the
bound of the table of counts that goes to the driver and to all tasks. No text and no token is shuffled.

Defined results: a null or empty text has no tokens; neither has one whose A or B token bytes, joined, differ from the space and the text (one with U+2581 in it,
say); special tokens spelled in a text are plain text; very long texts are processed whole; repeated rows and null ids are rows of their own; ties of counts are
all best; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.bpe import PieceEncoder
from panelcast.llm.shared import documents, joined_rows, slices, stored, utf8

LANE = 512
#: bytes of text that are aligned at a time
TEXT = 1 << 20


# ---- the two tokenizers


class _Sentences:
    """A sentencepiece model behind the one call that ``PieceEncoder`` makes. The texts begin with the space that the model would add."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.space = self.model.piece_to_id("▁")

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False) -> list[SimpleNamespace]:
        rest = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [SimpleNamespace(ids=ids if len(t) > 1 else [self.space]) for t, ids in zip(texts, rest)]


class WordEncoder(PieceEncoder):
    """Ids of whole texts by a sentencepiece BPE none of whose pieces goes on after a word with a space: words with the spaces before them
    are encoded on their own, each different one once."""

    def __init__(self, path: str, most_pieces: int) -> None:
        self.model, self.special, self.most = _Sentences(path), [], most_pieces
        sp = self.model.model
        if any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size())):
            raise ValueError("the model has pieces that span words")
        self.clear()

    def _starts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space = points == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[offsets[:-1][offsets[:-1] < len(points)]] = True
        return np.flatnonzero(start)


def _byte_of() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def bytes_of_a(path: str) -> list[bytes]:
    from tokenizers import Tokenizer

    model, byte = Tokenizer.from_file(path), _byte_of()
    return [bytes(byte[c] for c in model.id_to_token(i)) for i in range(model.get_vocab_size())]


def bytes_of_b(path: str) -> list[bytes]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together: one's bytes are a suffix of the other's."""
    ends_a, ends_b = Counter(x[k:] for x in a for k in range(len(x))), Counter(x[k:] for x in b for k in range(len(x)))
    whole_a, whole_b = Counter(a), Counter(b)
    return sum(ends_a[x] for x in b if x) + sum(ends_b[x] for x in a if x) - sum(n * whole_b[x] for x, n in whole_a.items() if x)


@dataclass
class Side:
    """One tokenizer in a Python worker: its encoder and the bytes of its tokens."""

    encoder: PieceEncoder
    pool: np.ndarray
    begin: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, encoder: PieceEncoder, tokens: list[bytes]) -> Side:
        length = np.array([len(t) for t in tokens], np.int64)
        return cls(encoder, np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, offsets of the rows in them, and which rows the token bytes give back."""
        ids, rows = self.encoder.encode(data, offsets)
        length = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        good = ends[rows[1:]] - ends[rows[:-1]] == np.diff(offsets)
        token = np.repeat(good, np.diff(rows))
        size = length[token]
        made = self.pool[np.repeat(self.begin[ids[token]], size) + joined_rows(size)]
        byte = np.repeat(good, np.diff(offsets))
        wrong = np.flatnonzero(made != data[byte])
        if len(wrong):
            good[np.searchsorted(offsets, np.flatnonzero(byte)[wrong], side="right") - 1] = False
        return ids, rows, good


_SIDES: dict[tuple[str, str], tuple[Side, Side]] = {}
#: pieces that each side remembers, some 30 MB of a worker
MOST_PIECES = 500_000


def sides(a: str, b: str) -> tuple[Side, Side]:
    """Both tokenizers of this Python worker; workers are reused from task to task."""
    if (a, b) not in _SIDES:
        _SIDES.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        byte_level = PieceEncoder(a, MOST_PIECES)
        byte_level.model.encode_special_tokens, byte_level.special = True, []
        _SIDES[a, b] = Side.of(byte_level, bytes_of_a(a)), Side.of(WordEncoder(b, MOST_PIECES), bytes_of_b(b))
    return _SIDES[a, b]


# ---- merging


def lanes(end_a: np.ndarray, end_b: np.ndarray, ends: np.ndarray, lane: int = LANE, tries: int = 8) -> np.ndarray:
    """Shared byte ends that cut the documents (which end at ``ends``) into stretches of about ``lane`` bytes, the ends of documents among them."""
    if not len(ends):
        return ends
    place = np.searchsorted(end_a, np.arange(lane, int(ends[-1]), lane))
    cuts = [ends]
    for k in range(tries):
        at = end_a[np.minimum(place + k, len(end_a) - 1)]
        shared = end_b[np.searchsorted(end_b, at)] == at
        cuts.append(at[shared])
        place = place[~shared]
    return np.unique(np.concatenate(cuts))


def lockstep(end_a: np.ndarray, end_b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B tokens that end together. All stretches between two cuts advance at the same time."""
    stop = np.searchsorted(end_a, cuts) + 1
    i = np.concatenate([[0], stop[:-1]])[: len(cuts)]
    j = np.concatenate([[0], np.searchsorted(end_b, cuts[:-1]) + 1])[: len(cuts)]
    found: list[tuple[np.ndarray, np.ndarray]] = [(i[:0], j[:0])]
    while len(i):
        x, y = end_a[i], end_b[j]
        together = x == y
        found.append((i[together], j[together]))
        i, j = i + (x <= y), j + (y <= x)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.argsort(a)
    return a[order], b[order]


_ARRAYS = ("a_ids", "b_ids", "a_groups", "b_groups", "cuts")


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, and five arrays as little-endian 32-bit integers: the ids of both sides, how many A and B tokens lie before the end of each group, and the byte
    offset in the spaced text where it ends. The last tokens of a group are a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return align(batches, a, b)

    return docs.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} binary" for c in _ARRAYS))


def align(batches: Iterator[pa.RecordBatch], a: str, b: str) -> Iterator[pa.RecordBatch]:
    """The work of ``aligned`` in a task, on batches of ids and texts."""
    one, two = sides(a, b)
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for x, y in slices(offsets, TEXT):
            own = offsets[x : y + 1] - offsets[x]
            full = np.diff(own) > 0
            spaced = np.insert(data[offsets[x] : offsets[y]], own[:-1][full], 32)
            rows = own + np.concatenate([[0], np.cumsum(full)])
            (ids_a, rows_a, good_a), (ids_b, rows_b, good_b) = one.encode(spaced, rows), two.encode(spaced, rows)
            good = good_a & good_b & full
            n_a, n_b = np.where(good, np.diff(rows_a), 0), np.where(good, np.diff(rows_b), 0)
            ids_a, ids_b = ids_a[np.repeat(good, np.diff(rows_a))], ids_b[np.repeat(good, np.diff(rows_b))]
            size = np.where(good, np.diff(rows), 0)
            end_a, end_b = np.cumsum(one.length[ids_a]), np.cumsum(two.length[ids_b])
            last_a, last_b = lockstep(end_a, end_b, lanes(end_a, end_b, np.cumsum(size)[good]))
            before = [np.cumsum(n) - n for n in (n_a, n_b, size)]
            row = np.searchsorted(np.cumsum(n_a), last_a, side="right")
            groups = np.bincount(row, minlength=y - x)
            flat = [ids_a, ids_b, last_a + 1 - before[0][row], last_b + 1 - before[1][row], end_a[last_a] - before[2][row]]
            counts = [n_a, n_b, groups, groups, groups]
            made = [_binary(v, n) for v, n in zip(flat, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), *made], names=["doc_id", *_ARRAYS])


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of 32-bit integers as binary values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(values.astype("<i4"))])


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The other way: all numbers, and the offsets of the rows in them."""
    data, offsets = utf8(column)
    return np.frombuffer(data.tobytes(), "<i4"), offsets // 4


# ---- digests and counts


def written(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text, ``a1,a2|b1;``, end to end, and where the text of each A and B token begins in order of writing (one more at the end)."""
    at_a = np.arange(len(ids_a)) + np.repeat(np.concatenate([[0], last_b[:-1] + 1])[: len(last_a)], np.diff(last_a, prepend=-1))
    at_b = np.arange(len(ids_b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
    ids = np.empty(len(ids_a) + len(ids_b), np.int32)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
    digits = np.ones(len(ids), np.int8)
    tens = [10**k for k in range(1, 10) if 10**k <= ids.max(initial=0)]
    for ten in tens:
        digits += ids >= ten
    begin = np.concatenate([[0], np.cumsum(digits + 1, dtype=np.int64)])
    text = np.empty(int(begin[-1]), np.uint8)
    text[begin[1:] - 1] = mark
    text[begin[1:] - 2] = 48 + ids % 10
    for k, ten in enumerate(tens, 1):
        some = np.flatnonzero(digits > k)
        text[begin[some + 1] - 2 - k] = 48 + ids[some] // ten % 10
    return text, begin


def digest(batches: Iterator[pa.RecordBatch], n_b_ids: int) -> Iterator[pa.RecordBatch]:
    """Counts and a hash of the groups, and the code a * n_b_ids + b of every link, from batches of aligned documents."""
    for batch in batches:
        ids_a, rows_a = _integers(batch.column(1))
        ids_b, rows_b = _integers(batch.column(2))
        (last_a, rows), (last_b, _) = (_integers(batch.column(k)) for k in (3, 4))
        groups = np.diff(rows)
        last_a = last_a + np.repeat(rows_a[:-1], groups) - 1
        last_b = last_b + np.repeat(rows_b[:-1], groups) - 1
        text, begin = written(ids_a, ids_b, last_a, last_b)
        ends = begin[rows_a + rows_b].tolist()
        whole = memoryview(text)
        sha = [hashlib.sha256(whole[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])]
        code = ids_a[last_a].astype(np.int64) * n_b_ids + ids_b[last_b]
        numbers = [pa.array(np.diff(r)) for r in (rows_a, rows_b, rows, rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(sha), _binary(code, groups)], names=_DIGEST)


def digests(docs: DataFrame, a: str, b: str, n_b_ids: int) -> DataFrame:
    """The digest of every aligned document. Both steps run in one Python worker, so no token goes through the JVM but those of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return digest(align(batches, a, b), n_b_ids)

    return docs.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary")


_DIGEST = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]


def pair_counts(found: DataFrame) -> DataFrame:
    """How many links hold each pair of ids: code, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            values, offsets = _integers(batch.column(0))
            for x, y in slices(offsets, 1 << 20):
                own, n = np.unique(values[offsets[x] : offsets[y]], return_counts=True)
                merged, place = np.unique(np.concatenate([codes, own]), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(merged)).astype(np.int64)
                codes = merged.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

    return found.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def scored(spark: SparkSession, found: DataFrame, n_b_ids: int) -> DataFrame:
    """``found`` without its links, with n_best and count_sum. The table of counts has at most ``most_pairs()`` rows."""
    table = pair_counts(found).toArrow()
    order = np.argsort(table.column("code").to_numpy())
    codes, counts = table.column("code").to_numpy()[order].astype(np.int64), table.column("n").to_numpy()[order].astype(np.int64)
    highest = np.zeros(n_b_ids, np.int64)
    np.maximum.at(highest, codes % n_b_ids, counts)
    sent = spark.sparkContext.broadcast((codes, counts, counts == highest[codes % n_b_ids]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = sent.value
        for batch in batches:
            values, offsets = _integers(batch.column(6))
            for x, y in slices(offsets, 1 << 20):
                place = np.searchsorted(codes, values[offsets[x] : offsets[y]])
                sums = [np.concatenate([[0], np.cumsum(v[place])]) for v in (best, counts)]
                at = offsets[x : y + 1] - offsets[x]
                made = [pa.array(np.diff(s[at]).astype(np.int64)) for s in sums]
                yield pa.RecordBatch.from_arrays([*(c.slice(x, y - x) for c in batch.columns[:6]), *made], names=[*_DIGEST[:6], "n_best", "count_sum"])

    return found.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    n_b_ids = SentencePieceProcessor(model_file=b).get_piece_size()
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return scored(spark, stored(spark, digests(docs, a, b, n_b_ids), "links"), n_b_ids)
