"""Operator 7: token ids in binary files of independent zstandard frames with a seek table.

A file holds one frame per document (ids as little-endian integers of ``width`` bytes, 2 where the vocabulary allows it, else 4), then two
skippable frames: a directory (document ids and whether they are null), and the seek table of the zstandard seekable format: for each frame its
size, its size when decompressed and the low 32 bits of XXH64 of its content, then a footer with the number of frames. Any zstandard tool decompresses such a file whole; a reader that wants some documents reads the tail, then
only their bytes, and decompresses only their frames (``read_documents``).

Documents are ordered by range buckets of ``doc_id`` (equal ids by their content), so file after file holds ascending ids. The ids are
compressed before the one shuffle. A task writes each bucket to files of at most ``file_bytes`` under a new name and returns a manifest row
for each; files of attempts that failed are in no manifest. File access goes through ``pyarrow.fs``, so the folder may be in any store it knows.

Edge cases: a null or empty text is the end id alone; null ids come first, repeated rows stay; an empty table writes no file; other columns
are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.bpe import encoded_rows
from panelcast.llm.shared import NULL_KEY, range_bounds, stored
from panelcast.session import scratch_dir

# fixed values of the zstandard seekable format
SKIPPABLE_DIRECTORY, SKIPPABLE_SEEK_TABLE, SEEKABLE_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
MANIFEST = "path string, bucket long, number long, docs long, tokens long, bytes long"


def _open_store(folder: str):
    """A file system and the folder in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class FrameFile:
    """One file being written."""

    def __init__(self, folder: str) -> None:
        self.store, place = _open_store(folder)
        self.store.create_dir(place, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.zst"
        self.out = self.store.open_output_stream(f"{place}/{self.path.rsplit('/', 1)[1]}", compression=None)
        self.sizes: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.tokens = self.size = 0

    def add(self, doc_id: int | None, frame: bytes, full: int, checksum: int, tokens: int) -> None:
        self.out.write(frame)
        self.sizes.append((len(frame), full, checksum))
        self.doc_ids.append(doc_id)
        self.size += len(frame)
        self.tokens += tokens

    def close(self) -> None:
        n = len(self.sizes)
        directory = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + np.array([d is None for d in self.doc_ids], np.uint8).tobytes()
        table = np.array(self.sizes, "<u4").tobytes() + FOOTER.pack(n, HAS_CHECKSUMS, SEEKABLE_MAGIC)
        for magic, payload in ((SKIPPABLE_DIRECTORY, directory), (SKIPPABLE_SEEK_TABLE, table)):
            self.out.write(struct.pack("<II", magic, len(payload)) + payload)
            self.size += 8 + len(payload)
        self.out.close()


class FrameReader:
    """Random access to a file: the tail is read once, then only the frames asked for."""

    def __init__(self, path: str) -> None:
        import zstandard

        store, place = _open_store(path)
        self.file = store.open_input_file(place)
        end = self.file.size()
        n, flags, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError(f"no seek table with checksums in {path}")
        table = end - FOOTER.size - 12 * n
        self.sizes = np.frombuffer(self._at(table, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes[:, 0])])
        ids = self._at(table - 8 - 9 * n, 9 * n)
        self.doc_ids = np.frombuffer(ids[: 8 * n], "<i8")
        self.null = np.frombuffer(ids[8 * n :], np.uint8).astype(bool)
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        import xxhash

        content = self.decompressor.decompress(self._at(int(self.starts[k]), int(self.sizes[k, 0])), max_output_size=int(self.sizes[k, 1]))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sizes[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return content


def write_token_files(
    spark: SparkSession, docs: DataFrame, vocabulary: str, folder: str, *, end_id: int = 0, width: int = 2, level: int = 3, parts: int | None = None, file_bytes: int = 64 << 20
) -> DataFrame:
    """Write the files and return the manifest in reading order: path, docs, tokens, bytes, and ``first_token``, the tokens before."""
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = np.array(range_bounds(rows, F.coalesce("doc_id", F.lit(NULL_KEY)), parts), np.int64)
    kind = f"<u{width}"

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        compressor = zstandard.ZstdCompressor(level=level, write_checksum=False)
        for batch in batches:
            doc_ids = batch.column(0)
            keys = doc_ids.fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            buckets = np.searchsorted(bounds, keys, side="right") - 1
            for first, ids, at in encoded_rows(batch.column(1), vocabulary, end_id):
                whole = ids.astype(kind)
                if (whole != ids).any():
                    raise ValueError(f"ids do not fit in {width} bytes")
                out = []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    content = whole[a:b].tobytes()
                    out.append((compressor.compress(content), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF, b - a))
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets[first : first + n]), pa.array(keys[first : first + n]), doc_ids.slice(first, n), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int64())))],
                    names=["bucket", "key", "doc_id", "frame", "full", "checksum", "tokens"],
                )

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at, number = None, None, 0
        done: list[tuple] = []

        def finish() -> None:
            if file is not None:
                file.close()
                done.append((file.path, at, number, len(file.doc_ids), file.tokens, file.size))

        for batch in batches:
            for bucket, _, doc_id, frame, full, checksum, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None or bucket != at or file.size + len(frame) > file_bytes:
                    finish()
                    number = number + 1 if bucket == at else 0
                    file, at = FrameFile(folder), bucket
                file.add(doc_id, frame, full, checksum, tokens)
        finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), *[pa.int64()] * 5))], names=["path", "bucket", "number", "docs", "tokens", "bytes"]
        )

    made = rows.mapInArrow(frames, "bucket long, key long, doc_id long, frame binary, full long, checksum long, tokens long")
    written = made.repartition(parts, "bucket").sortWithinPartitions("bucket", "key", "full", "checksum").mapInArrow(files, MANIFEST)
    manifest = stored(spark, written, "token-manifest")
    # one row for each file of the corpus, so this window has little to sum
    return manifest.withColumn("first_token", F.coalesce(F.sum("tokens").over(Window.orderBy("bucket", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_token_files(spark: SparkSession, manifest: DataFrame, *, width: int = 2) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32. Files are dealt out by their names."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = FrameReader(path)
                out = []
                for k in range(len(reader.sizes)):
                    ids = np.frombuffer(reader.frame(k), f"<u{width}").astype("<u4")
                    out.append((None if reader.null[k] else int(reader.doc_ids[k]), start, len(ids), zlib.crc32(ids)))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "first_token").repartition(parts, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(path: str, doc_ids: set[int], width: int = 2) -> dict[int, np.ndarray]:
    """The ids of some documents of a file; only their frames are read and decompressed."""
    reader = FrameReader(path)
    hits = [k for k in range(len(reader.sizes)) if not reader.null[k] and int(reader.doc_ids[k]) in doc_ids]
    return {int(reader.doc_ids[k]): np.frombuffer(reader.frame(k), f"<u{width}") for k in hits}


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from panelcast.llm.shared import documents

    manifest = write_token_files(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), scratch_dir(spark, "token-files"))
    return read_token_files(spark, manifest)
