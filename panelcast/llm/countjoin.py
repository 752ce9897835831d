"""Operator 11: n-gram Jaccard join by an R-tree over count vectors.

A document's set holds its distinct shingles of ``size`` words, each as a 64-bit hash. Equal sets collapse to one class (named by a 64-bit hash of the set).
Shingles fall into ``GROUPS`` groups, more for larger sets; the shingles of each group, counted, make a point. Two sets can share no more shingles than the sum
of the smaller of both counts over all groups, so a pair, or a whole tree node by the largest counts below it, is out if that sum cannot reach the overlap that the
similarity asks for.

1. *Sets.* One scan gives each document's class, set size and point.
2. *Lists.* Sets that are similar enough share one of their first n - ceil(s n) + 1 shingles in any common order. The order is the hash; shingles that are
   frequent in a bounded sample come last, which only saves work. Tasks deal packed postings to ``buckets``, and only lists with two classes go on.
3. *R-tree.* Each list becomes a packed tree; starting at one point after another, the tree hands out what the bound cannot tell apart from
   it and is not yet reached. So a list gives an edge per member at most, never all its pairs, and what the edges connect holds every link.
4. *Verification.* The sets of each connected block meet once, are compared exactly, and give the edges of its real components. A block of more than
   ``most_shingles`` is cut into parts, and every two parts meet in a task of their own; so are lists of more than ``most_members``.

Nothing but counts, the hot and frequent shingles of the sample (at most ``most_frequent``) and settings passes through the driver. A table of candidate classes is broadcast
only up to ``most_broadcast`` rows; beyond that the sets are joined by shuffle.

Defined results: a null, empty or white text has an empty set, linked with nothing; fewer than ``size`` words make one shingle; texts of any length are processed
whole; repeated rows and ties share a class and so a component; a component of null ids has a null ``component_id``; an empty table gives no rows; columns of
``docs`` other than the id and the text are not read. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.shared import U64, documents, joined_rows, mixed, slices, span_hashes, stored, utf8, whole_groups
from panelcast.llm.simhash import shingles

SIZE, PERCENT, GROUPS, FANOUT = 5, 80, 64, 16


# ---- sets and points


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of each row in ascending order, end to end, and the n + 1 offsets of the rows in them."""
    text, first, last, row = shingles(data, offsets, size)
    h = span_hashes(np.frombuffer(text, np.uint8), first, last)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(offsets) - 1))]).astype(np.int64)


def class_of(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(h ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    return mixed(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(U64))


def levels(n: np.ndarray) -> np.ndarray:
    """Sets of up to 512 * 2**k shingles have level k and GROUPS * 2**k groups: less than 8 shingles a group keep unlike sets apart."""
    return np.maximum(np.ceil(np.log2(np.maximum(n, 1) / 512)), 0).astype(np.int64)


def points(h: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The counts of each set by group, a byte each, rounded up at a power of two that the last byte names."""
    out = []
    level = levels(np.diff(at))
    for k, a, b in zip(level.tolist(), at[:-1].tolist(), at[1:].tolist()):
        groups = GROUPS << k
        count = np.bincount((h[a:b] >> U64(65 - groups.bit_length())).astype(np.int64), minlength=groups)
        shift = max(int(count.max()).bit_length() - 8, 0)
        shift += bool(-(-int(count.max()) >> shift) > 255)
        out.append((-(-count >> shift)).astype(np.uint8).tobytes() + bytes([shift]))
    return out


def unpacked(point: list[bytes], width: int) -> np.ndarray:
    """Points of one level as counts, with neighbouring groups added up to ``width`` groups."""
    packed = np.frombuffer(b"".join(point), np.uint8).reshape(len(point), -1)
    count = packed[:, :-1].astype(np.int32) << packed[:, -1:].astype(np.int32)
    return count.reshape(len(point), width, -1).sum(2, dtype=np.int32)


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def may_link(a: np.ndarray, n_a, b: np.ndarray, n_b, percent: int) -> np.ndarray:
    """Whether points, or upper corners over sets of at least ``n_b`` shingles, leave room for a link."""
    return np.minimum(a, b).sum(-1) * (100 + percent) >= percent * (n_a + n_b)


class Tree:
    """A packed R-tree over points of one width: upper corners and the least set size of each node, level by level. Pairs of two guests are left to another tree."""

    def __init__(self, point: np.ndarray, n: np.ndarray, guest: np.ndarray, percent: int) -> None:
        slab = max(FANOUT, int(np.ceil(len(n) ** 0.5)))
        by_size = np.argsort(n, kind="stable")
        tile = np.empty(len(n), np.int64)
        tile[by_size] = np.arange(len(n)) // slab
        self.order = np.lexsort((point[:, 1], point[:, 0] >> 2, tile))
        self.percent, self.guest = percent, guest[self.order]
        self.nodes = [(point[self.order], n[self.order])]
        while len(self.nodes[-1][1]) > FANOUT:
            corner, least = self.nodes[-1]
            cut = np.arange(0, len(least), FANOUT)
            self.nodes.append((np.maximum.reduceat(corner, cut), np.minimum.reduceat(least, cut)))

    def near(self, at: int, alive: np.ndarray) -> np.ndarray:
        """Places (in tree order) of living points that the bound cannot tell apart from a link."""
        point, n = self.nodes[0][0][at], int(self.nodes[0][1][at])
        some = np.arange(len(self.nodes[-1][1]))
        for depth in range(len(self.nodes) - 1, -1, -1):
            corner, least = self.nodes[depth]
            if depth == 0:
                some = some[alive[some] & ~(self.guest[some] & self.guest[at]) & (100 * least[some] >= self.percent * n)]
            some = some[self.percent * least[some] <= 100 * n]
            some = some[may_link(point, n, corner[some], least[some], self.percent)]
            if depth:
                some = (some[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                some = some[some < len(self.nodes[depth - 1][1])]
        return some

    def forest(self) -> Iterator[tuple[np.ndarray, int]]:
        """(reached members, member they were reached from) until everything is reached; members are places in the list."""
        alive = np.ones(len(self.order), bool)
        left = len(alive)
        for root in range(len(alive)):
            if not alive[root]:
                continue
            alive[root] = False
            left -= 1
            front = [root]
            while front and left:
                at = front.pop()
                reached = self.near(at, alive)
                if len(reached):
                    alive[reached] = False
                    left -= len(reached)
                    front.extend(reached.tolist())
                    yield self.order[reached], int(self.order[at])


class Points:
    """The points of some classes, by level; those a little larger than a level are its guests, folded to its width."""

    def __init__(self, n: np.ndarray, point: list[bytes], percent: int) -> None:
        self.n, self.percent, level = n, percent, levels(n)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in np.unique(level).tolist():
            host = np.flatnonzero(level == k)
            guest = np.flatnonzero((level == k + 1) & (percent * n <= 100 * (512 << k)))
            counts = [unpacked([point[i] for i in some.tolist()], GROUPS << k) for some in (host, guest) if len(some)]
            place = np.full(len(n), -1, np.int64)
            place[np.concatenate([host, guest])] = np.arange(len(host) + len(guest))
            self.tables[k] = (place, np.concatenate(counts), level > k)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs the bound lets pass, in batches of bounded size."""
        good = np.zeros(len(a), bool)
        for place, count, guest in self.tables.values():
            some = np.flatnonzero((place[a] >= 0) & (place[b] >= 0) & ~(guest[a] & guest[b]))
            step = max(1, (1 << 22) // count.shape[1])
            for x in (some[i : i + step] for i in range(0, len(some), step)):
                good[x] = may_link(count[place[a[x]]], self.n[a[x]], count[place[b[x]]], self.n[b[x]], self.percent)
        return good

    def forest(self, members: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        for place, count, guest in self.tables.values():
            own = members[place[members] >= 0]
            if len(own) > 1 and not guest[own].all():
                for reached, at in Tree(count[place[own]], self.n[own], guest[own], self.percent).forest():
                    yield own[reached], int(own[at])


def list_edges(key: np.ndarray, member: np.ndarray, known: Points, leaf: int = FANOUT) -> tuple[np.ndarray, np.ndarray]:
    """Edges of sorted lists of different members. A list that fits in a leaf is compared pair by pair, all such lists at once."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    length = np.diff(cut)
    found: list[tuple[np.ndarray, np.ndarray]] = [(member[:0], member[:0])]
    for a, m in zip(cut[:-1][length > leaf].tolist(), length[length > leaf].tolist()):
        found += [(reached, np.full(len(reached), at)) for reached, at in known.forest(member[a : a + m])]
    small = np.flatnonzero(np.repeat((length > 1) & (length <= leaf), length))
    key, member = key[small], member[small]
    pairs = [np.zeros(0, np.int64)]
    for lag in range(1, min(leaf, len(key))):
        same = np.flatnonzero(key[lag:] == key[:-lag])
        if not len(same):
            break
        a, b = member[same], member[same + lag]
        fits = known.percent * np.maximum(known.n[a], known.n[b]) <= 100 * np.minimum(known.n[a], known.n[b])
        pairs.append((np.maximum(a, b)[fits] << 32) + np.minimum(a, b)[fits])
    pair = np.unique(np.concatenate(pairs))
    a, b = pair >> 32, pair & 0xFFFFFFFF
    good = known.pairs(a, b)
    found.append((a[good], b[good]))
    return tuple(np.concatenate([f[k] for f in found]) for k in (0, 1))


def linked_sets(h: np.ndarray, at: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """Forest of the real links among some sets: (reached sets, set they were reached from), each compared exactly."""
    n = np.diff(at)
    _, token = np.unique(h, return_inverse=True)
    mark = np.zeros(int(token.max(initial=0)) + 1, bool)
    left, out = np.arange(len(n)), []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            x = front.pop()
            fits = left[(percent * n[left] <= 100 * n[x]) & (100 * n[left] >= percent * n[x])]
            if not len(fits):
                continue
            mark[token[at[x] : at[x + 1]]] = True
            rows = np.repeat(at[fits], n[fits]) + joined_rows(n[fits])
            shared = np.add.reduceat(mark[token[rows]].astype(np.int64), np.cumsum(n[fits]) - n[fits])
            mark[token[at[x] : at[x + 1]]] = False
            reached = fits[shared * (100 + percent) >= percent * (n[fits] + n[x])]
            if len(reached):
                out.append((reached, x))
                front.extend(reached.tolist())
                left = np.setdiff1d(left, reached, assume_unique=True)
    return out


# ---- Spark


def _scanned(docs: DataFrame, fields: list[tuple[str, pa.DataType]], made, schema: str, size: int) -> DataFrame:
    """``made(hashes, offsets, ids)`` for each slice of the texts; ``docs`` has an id and a text."""
    names = [name for name, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = made()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                h, at = sets_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                for columns in make(h, at, batch.column(0).slice(a, b - a)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=names)

    return docs.mapInArrow(run, schema)


def class_rows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, cls (null for an empty set), n and the point of each document."""

    def made():
        def make(h, at, ids):
            n = np.diff(at)
            cls = pa.array(class_of(h, at).view(np.int64), mask=n == 0)
            yield ids, cls, n, pa.array(points(h, at), pa.binary())

        return make

    kinds = [("doc_id", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("point", pa.binary())]
    return _scanned(docs, kinds, made, "doc_id long, cls long, n long, point binary", size)


def frequent_shingles(spark: SparkSession, docs: DataFrame, n_docs: int, size: int, sample_docs: int, most_frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of about ``sample_docs`` texts hold, with the share of the texts; only the order of a set's shingles depends on them."""

    def made():
        seen: set[int] = set()

        def make(h, at, ids):
            cls = class_of(h, at).tolist()
            new = [k for k, c in enumerate(cls) if not (c in seen or seen.add(c))]
            yield (np.concatenate([h[at[k] : at[k + 1]] for k in new] + [h[:0]]).view(np.int64),)

        return make

    step = max(1, -(-n_docs // sample_docs))
    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
    counts = _scanned(sample, [("h", pa.int64())], made, "h long", size).groupBy("h").count().filter("count >= 5")
    table = counts.orderBy(F.desc("count"), "h").limit(most_frequent).toArrow()  # bounded by most_frequent
    h = table.column("h").to_numpy().astype(np.int64).view(U64)
    order = np.argsort(h)
    return h[order], table.column("count").to_numpy()[order] * step


def postings(spark: SparkSession, docs: DataFrame, frequent: np.ndarray, hot: dict[int, int], buckets: int, size: int, percent: int) -> DataFrame:
    """Packed postings by bucket: 32 bits of each shingle's list and the class, of every set once per task."""
    sent = spark.sparkContext.broadcast((frequent, hot))

    def made():
        known, split = sent.value
        split_keys = np.sort(np.array(list(split), U64))
        seen: set[int] = set()

        def make(h, at, ids):
            n = np.diff(at)
            cls = class_of(h, at)
            new = np.array([c not in seen and not seen.add(c) for c in cls.tolist()], bool)
            row = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(h), bool)
            if len(known):
                late = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
            order = np.lexsort((h, late, row))
            keep = order[(joined_rows(n) < np.repeat(prefix_sizes(n, percent), n)) & np.repeat(new, n)]
            key, own = h[keep], cls[row[keep]]
            if len(split_keys):  # a hot list: its classes fall into blocks, and every two blocks meet
                is_hot = split_keys[np.minimum(np.searchsorted(split_keys, key), len(split_keys) - 1)] == key
                keys, owns = [key[~is_hot]], [own[~is_hot]]
                for k, c in zip(key[is_hot].tolist(), own[is_hot].tolist()):
                    mine, blocks = c % split[k], np.arange(split[k], dtype=U64)
                    low, high = np.minimum(blocks, U64(mine)), np.maximum(blocks, U64(mine))
                    keys.append(mixed(U64(k) ^ mixed(low * U64(1 << 32) + high + U64(1))))
                    owns.append(np.full(len(blocks), c, U64))
                key, own = np.concatenate(keys), np.concatenate(owns)
            bucket = ((key >> U64(33)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            key, own, bucket = (key & U64(0xFFFFFFFF)).astype("<u4")[order], own[order].astype("<u8"), bucket[order]
            some = np.unique(bucket)
            ends = np.searchsorted(bucket, some, side="right").tolist()
            bodies = [key[a:b].tobytes() + own[a:b].tobytes() for a, b in zip([0, *ends], ends)]
            yield some, bodies

        return make

    return _scanned(docs, [("bucket", pa.int64()), ("body", pa.binary())], made, "bucket long, body binary", size)


def shared_lists(packed: DataFrame, buckets: int) -> DataFrame:
    """Rows (list, cls) of all lists with two classes at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1):
            ends = np.flatnonzero(np.diff(table.column(0).to_numpy(), append=-1)) + 1
            bodies = table.column(1).to_pylist()
            for a, b in zip([0, *ends.tolist()], ends.tolist()):
                bucket = table.column(0)[a].as_py()
                key = np.concatenate([np.frombuffer(x, "<u4", len(x) // 12) for x in bodies[a:b]])
                cls = np.concatenate([np.frombuffer(x, "<u8", offset=len(x) // 12 * 4) for x in bodies[a:b]])
                order = np.lexsort((cls, key))
                key, cls = key[order], cls[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
                key, cls = key[new], cls[new]
                same = np.zeros(len(key) + 1, bool)
                same[1:-1] = key[1:] == key[:-1]
                several = same[1:] | same[:-1]
                yield pa.RecordBatch.from_arrays([pa.array((bucket << 32) + key[several].astype(np.int64)), pa.array(cls[several].view(np.int64))], names=["list", "cls"])

    return packed.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket").mapInArrow(run, "list long, cls long")


def bound_edges(lists: DataFrame, classes: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Edges between classes that the R-trees cannot tell apart; a bucket gets its lists, and the point of each class in them once."""
    bucket = F.shiftright("list", 32)
    wanted = lists.select(bucket.alias("bucket"), "cls").distinct().join(classes.select("cls", "n", "point"), "cls")
    rows = wanted.select("bucket", F.lit(-1).cast("long").alias("list"), "cls", "n", "point")
    rows = rows.unionByName(lists.select(bucket.alias("bucket"), "list", "cls", F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("point")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1):
            bucket, key, cls, n = (table.column(k).to_numpy() for k in range(4))
            for a, b in zip(*(lambda cut: (cut, cut[1:]))(np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist())):
                m = a + int(np.searchsorted(key[a:b], 0))  # points come first, sorted by class
                known = Points(n[a:m], table.column(4).slice(a, m - a).to_pylist(), percent)
                names = cls[a:m]
                x, y = list_edges(key[m:b], np.searchsorted(names, cls[m:b]), known)
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(names[x], names[y])), pa.array(np.minimum(names[x], names[y]))], names=["a", "b"])

    dealt = rows.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "list", "cls")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def verified_edges(spark: SparkSession, docs: DataFrame, blocks: DataFrame, parts: int, size: int, percent: int, most_shingles: int, most_broadcast: int) -> DataFrame:
    """Edges of the real components. ``blocks`` has cls, block and n of every candidate."""
    totals = blocks.groupBy("block").agg(F.ceil(F.sum("n") / most_shingles).cast("long").alias("cuts"))
    own = F.pmod(F.xxhash64("cls"), F.col("cuts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    dealt = blocks.join(totals, "block").select("cls", "block", own.alias("own"), other.alias("other"))
    dealt = stored(spark, dealt.select("cls", "block", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")), "dealt")

    def made():
        seen: set[int] = set()

        def make(h, at, ids):
            cls = class_of(h, at).view(np.int64).tolist()
            new = [k for k, c in enumerate(cls) if at[k + 1] > at[k] and not (c in seen or seen.add(c))]
            yield [cls[k] for k in new], [h[at[k] : at[k + 1]].astype("<u8").tobytes() for k in new]

        return make

    sets = _scanned(docs, [("cls", pa.int64()), ("hashes", pa.binary())], made, "cls long, hashes binary", size)
    if dealt.count() <= most_broadcast:
        dealt = F.broadcast(dealt)
    met = sets.join(dealt, "cls").select("block", "x", "y", "cls", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            keys = np.stack([table.column(k).to_numpy() for k in range(3)])
            cls = table.column(3).to_numpy().astype(np.int64)
            bodies = table.column(4).to_pylist()
            cut = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0), [True]])).tolist()
            out: list[tuple[np.ndarray, np.ndarray]] = [(cls[:0], cls[:0])]
            for a, b in zip(cut, cut[1:]):
                own, place = np.unique(cls[a:b], return_index=True)
                sets = [np.frombuffer(bodies[a + k], "<u8") for k in place.tolist()]
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
                out += [(own[reached], np.full(len(reached), own[x])) for reached, x in linked_sets(np.concatenate(sets), at, percent)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)], names=["a", "b"])

    return met.repartition(parts, "block", "x", "y").sortWithinPartitions("block", "x", "y").mapInArrow(run, "a long, b long").distinct()


def similar_sets(
    spark: SparkSession,
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    bucket_size: int = 2_000_000,
    sample_docs: int = 5_000,
    most_frequent: int = 200_000,
    most_members: int = 20_000,
    most_shingles: int = 2_000_000,
    most_broadcast: int = 2_000_000,
) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, cls and n of every document; cls, n, the number of documents, the smallest of their ids, and the class that names the
    component, for every class. Two classes share a component if links of at least ``percent`` percent Jaccard similarity connect them."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = stored(spark, class_rows(plain, size), "sets")
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.max("n").alias("n"), F.max("point").alias("point"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    classes = stored(spark, classes, "set-classes")
    longest = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    n_docs, n_postings = classes.agg(F.sum("copies"), F.sum(longest)).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent, seen_in = frequent_shingles(spark, plain, n_docs or 0, size, sample_docs, most_frequent)
    hot = {int(k): int(-(-c // most_members)) for k, c in zip(frequent[seen_in > most_members], seen_in[seen_in > most_members])}
    buckets = max(parts, int(n_postings or 0) // bucket_size + 1)
    lists = stored(spark, shared_lists(postings(spark, plain, frequent, hot, buckets, size, percent), buckets), "lists")
    near = stored(spark, bound_edges(lists, classes, buckets, percent), "bound-edges")
    blocks = components(spark, near).select(F.col("node").alias("cls"), F.col("root").alias("block")).join(classes.select("cls", "n"), "cls")
    links = verified_edges(spark, plain, stored(spark, blocks, "blocks"), parts, size, percent, most_shingles, most_broadcast)
    roots = components(spark, links).select(F.col("node").alias("cls"), "root")
    named = classes.select("cls", "n", "copies", "first_id").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    return rows.select("doc_id", "cls", "n"), stored(spark, named, "set-components")


def op11_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, classes = similar_sets(spark, documents(spark, sf_dir))
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(spark, classes.join(ids, "root").select("cls", "component_id", "copies"), "named-classes")
    # classes of over a thousandth of all rows, fewer than a thousand, are sent to the rows; so no task gets a hot class
    total = named.agg(F.sum("copies")).first()[0] or 0
    hot = named.filter(F.col("copies") > F.lit(max(total // 1000, 1000))).select("cls", F.col("component_id").alias("of_hot"), F.lit(True).alias("is_hot"))
    marked = rows.join(F.broadcast(hot), "cls", "left")
    cold = marked.filter("is_hot is null and cls is not null").select("doc_id", "cls", "n").join(named.select("cls", "component_id"), "cls")
    rest = marked.filter("is_hot or cls is null").select("doc_id", "n", F.when(F.col("is_hot"), F.col("of_hot")).otherwise(F.col("doc_id")).alias("component_id"))
    return cold.select("doc_id", "n", "component_id").unionByName(rest).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


OP11_SQL = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS uid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingled AS (
    SELECT uid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
    FROM words),
classes AS (
    SELECT s_key, any_value(s) AS s, min(doc_id) AS first_id, row_number() OVER (ORDER BY s_key) AS cls
    FROM (SELECT *, array_to_string(list_sort(s), chr(10)) AS s_key FROM shingled) WHERE len(s) > 0 GROUP BY s_key),
members AS (SELECT cls, len(s) AS n, unnest(s) AS shingle FROM classes),
pairs AS (
    SELECT a.cls AS a, b.cls AS b FROM members a JOIN members b ON a.shingle = b.shingle AND a.cls < b.cls AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT cls AS a, cls AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT r.a AS cls, min(c.first_id) AS component_id FROM reach r JOIN classes c ON c.cls = r.b GROUP BY r.a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE n.component_id END AS component_id
FROM shingled d LEFT JOIN classes c ON c.s_key = array_to_string(list_sort(d.s), chr(10)) AND len(d.s) > 0 LEFT JOIN named n ON n.cls = c.cls
"""
