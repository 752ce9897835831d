"""Operator 10: pack tokenised documents into sequences of a fixed length, online and in bounded space.

Each scan partition keeps at most ``windows`` open windows. A document's whole multiples of the sequence length fill sequences of their
own; the rest goes to the open window it fits best (least room left), else to a new window while there are fewer than ``windows``. When
none fits, the fullest window is emitted; if more than ``most_padding`` tokens of it are free, the head of the document at hand tops it
up first. Windows still open at the end of a partition are merged by the same packer over groups of ``fan_in`` partitions, level by
level, until one group is left; there, what remains is poured together, so one sequence at most ends short.

No text and no token is shuffled except those of the windows left open, at most ``windows`` for each partition, and each task of a
merge reads at most ``fan_in * windows`` of them. Levels are stored in the shared folder.

Edge cases: a null or empty text is the end id alone; a null ``doc_id`` and repeated rows are packed as rows of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.bpe import encoded_rows
from panelcast.llm.shared import mapped, stored

LENGTH = 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, open boolean, ids binary"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part")), ("open", pa.bool_()), ("ids", pa.binary())]
)


class Packer:
    """The open windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, part: int, level: int, length: int, windows: int, most_padding: int, keep_ids: bool) -> None:
        self.part, self.length, self.windows, self.most_padding, self.keep_ids = part, length, windows, most_padding, keep_ids
        self.next_id = (level << 56) | (part << 28)
        self.open: list[tuple[int, int, list]] = []  # room, number, pieces; sorted by room
        self.number = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list, still_open: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids), doc_tokens, self.next_id, offset, self.part, still_open, ids.tobytes() if still_open or self.keep_ids else None))
            offset += len(ids)
        self.next_id += 1

    def add(self, pieces: list) -> None:
        """Place some pieces that belong together, a whole document or a window left open elsewhere."""
        size = sum(len(p[2]) for p in pieces)
        while size >= self.length:
            head, pieces = cut(pieces, self.length)
            self.emit(head)
            size -= self.length
        while size:
            k = bisect_left(self.open, (size,))
            if k < len(self.open):
                room, number, held = self.open.pop(k)
                held.extend(pieces)
                if room == size:
                    self.emit(held)
                else:
                    insort(self.open, (room - size, number, held))
                return
            if len(self.open) < self.windows:
                self.number += 1
                insort(self.open, (self.length - size, self.number, list(pieces)))
                return
            room, _, held = self.open.pop(0)
            if room > self.most_padding:
                head, pieces = cut(pieces, room)
                held.extend(head)
                size -= room
            self.emit(held)

    def leave(self) -> None:
        for _, _, held in self.open:
            self.emit(held, True)
        self.open = []

    def pour(self) -> None:
        """The very last windows: cut freely, so that at most one sequence ends short."""
        rest = [p for _, _, held in self.open for p in held]
        size = sum(len(p[2]) for p in rest)
        while rest:
            head, rest = cut(rest, min(size, self.length))
            size -= min(size, self.length)
            self.emit(head)
        self.open = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in _ARROW]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def cut(pieces: list, size: int) -> tuple[list, list]:
    """The first ``size`` tokens of some pieces, and the rest."""
    head, rest = [], []
    for doc_id, start, ids, doc_tokens in pieces:
        take = min(size, len(ids))
        if take:
            head.append((doc_id, start, ids[:take], doc_tokens))
        if take < len(ids):
            rest.append((doc_id, start + take, ids[take:], doc_tokens))
        size -= take
    return head, rest


def pack(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str,
    *,
    end_id: int = 1,
    length: int = LENGTH,
    windows: int = 32,
    most_padding: int = 16,
    fan_in: int = 64,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``ids`` holds the tokens as little-endian 32-bit integers if ``keep_ids``."""

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), 0, length, windows, most_padding, keep_ids)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, ids, rows in encoded_rows(batch.column(1), vocabulary, end_id):
                for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    packer.add([(doc_ids[first + k], 0, ids[a:b], b - a)])
                for _, _, held in packer.open:  # what stays open keeps its own tokens, not the whole slice
                    held[:] = [(d, s, i if i.base is None else i.copy(), n) for d, s, i, n in held]
                yield packer.batch()
        packer.leave()
        yield packer.batch()

    def merge(level: int, last: bool):
        import pandas as pd

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            packer = Packer(int(key[0]), level, length, windows, most_padding, keep_ids)
            rows = rows.sort_values(["sequence_id", "offset"], kind="stable")
            doc_ids = [None if d is None or d != d else int(d) for d in rows["doc_id"].astype(object)]
            window, at = [], None
            for doc_id, start, ids, total, sequence in zip(doc_ids, rows["start"], rows["ids"], rows["doc_tokens"], rows["sequence_id"]):
                if sequence != at and window:
                    packer.add(window)
                    window = []
                at = sequence
                window.append((doc_id, int(start), np.frombuffer(ids, "<u4"), int(total)))
            packer.add(window)
            packer.pour() if last else packer.leave()
            return packer.batch().to_pandas(types_mapper=lambda t: pd.Int64Dtype() if t == pa.int64() else None)

        return run

    at = stored(spark, mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), first_level, SCHEMA), "packing")
    result = at.filter("not open")
    parts, level = at.agg(F.max("part").alias("n")).first()["n"], 0
    while parts is not None:
        level += 1
        last = parts < fan_in
        groups = at.filter("open").withColumn("part", F.expr(f"part div {fan_in}")).groupBy("part")
        at = stored(spark, groups.applyInPandas(merge(level, last), SCHEMA), "packing")
        result = result.unionByName(at.filter("not open"))
        parts = None if last else parts // fan_in
    return result.drop("part", "open")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from panelcast.llm.shared import documents

    return pack(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")
