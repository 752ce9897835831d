"""Operators 11 to 13 against plain versions of their definitions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from panelcast.llm import alignment, countjoin, phrases
from panelcast.llm.shared import U64, utf8

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- 11


def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset([" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else [])


def components_by_pairs(docs, percent=80):
    """All pairs of different sets, compared one by one."""
    by_set = defaultdict(list)
    for doc_id, text in docs:
        by_set[shingle_set(text)].append(doc_id)
    sets = [s for s in by_set if s]
    up = {s: s for s in sets}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    for k, a in enumerate(sets):
        for b in sets[:k]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                up[root(a)] = root(b)
    least = {}
    for s in sets:
        for d in by_set[s]:
            if d is not None:
                least[root(s)] = min(d, least.get(root(s), d))
    return [(d, len(shingle_set(t)), least.get(root(shingle_set(t))) if shingle_set(t) else d) for d, t in docs]


def near_copies(seed=4, groups=12):
    """Groups of texts with more and fewer changed words, a line that many share, and chains of copies of copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    line = " ".join(word() for _ in range(30))
    docs = []
    for g in range(groups):
        now = [word() for _ in range(rng.choice([6, 40, 300, 900]))]
        for _ in range(rng.choice([2, 5, 24])):
            docs.append(" ".join(now) + (" " + line if rng.random() < 0.5 else ""))
            now = [word() if rng.random() < rng.choice([0.0, 0.01, 0.03]) else w for w in now]
    docs += ["A b\tC  d e f", "a B c d E\nf", "a b c d e f g", "only two", "ONLY two", "", None, " \n"]
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("limits", [{}, {"bucket_size": 50, "most_members": 3, "most_shingles": 400, "most_broadcast": 0, "sample_docs": 40}])
def test_join_loses_no_link(spark, limits):
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cls", F.lit("own")).withColumn("n", F.lit(1))
    rows, classes = countjoin.similar_sets(spark, frame, **limits)
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rows.join(classes.select("cls", "root"), "cls", "left").join(ids, "root", "left")
    got = [(r.doc_id, r.n, r.component_id if r.cls is not None else r.doc_id) for r in found.collect()]
    assert sorted(got) == sorted(components_by_pairs(docs))
    assert len({c for _, _, c in got}) < len(docs) - 60


def test_join_of_awkward_rows(spark, edge_dir, edge):
    got = [tuple(r) for r in countjoin.op11_count_rtree(spark, edge_dir).select("doc_id", "n_shingles", "component_id").collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(components_by_pairs(edge), key=key)


def test_points_bound_the_overlap():
    texts = [t or "" for _, t in near_copies(7)]
    data, offsets = utf8(__import__("pyarrow").array(texts))
    h, at = countjoin.sets_of(data, offsets)
    sets = [set(h[a:b].tolist()) for a, b in zip(at, at[1:])]
    known = countjoin.Points(np.diff(at), countjoin.points(h, at), 80)
    a, b = np.triu_indices(len(sets), 1)
    passed = known.pairs(a, b)
    linked = np.array([bool(sets[x]) and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]) for x, y in zip(a, b)])
    assert not (linked & ~passed).any()
    assert passed.sum() < 3 * linked.sum()  # and little else passes


def test_counts_above_a_byte_are_rounded_up():
    h = np.arange(60_000, dtype=np.uint64) << U64(40)  # all in the first group
    point = countjoin.points(h, np.array([0, 60_000]))
    assert countjoin.unpacked(point, 64)[0, 0] >= 60_000


# ---- 12


def plain_alignment(docs):
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    bytes_a, bytes_b = alignment.bytes_of_a(A), alignment.bytes_of_b(B)
    rows, count = [], Counter()
    for doc_id, text in docs:
        whole = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if not text or b"".join(bytes_a[i] for i in x) != whole or b"".join(bytes_b[i] for i in y) != whole:
            rows.append((doc_id, [], [], [], []))
            continue
        ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((bytes_a, x), (bytes_b, y))]
        links = [(i, j) for i, e in enumerate(ends[0]) for j in [ends[1].index(e) if e in ends[1] else -1] if j >= 0]
        rows.append((doc_id, x, y, links, [(x[i], y[j]) for i, j in links]))
        count.update(rows[-1][4])
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for doc_id, x, y, links, pairs in rows:
        groups, i, j = [], 0, 0
        for p, q in links:
            groups.append(",".join(map(str, x[i : p + 1])) + "|" + ",".join(map(str, y[j : q + 1])))
            i, j = p + 1, q + 1
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""
        out.append((doc_id, len(x), len(y), len(links), len(links), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), sha))
    return out


def test_alignment_of_awkward_rows(spark, edge_dir, edge, tmp_path):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc \t\n  <>é中😀0123'.,s  ") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["<|endoftext|> x <s> <0x41>", "a▁b", "abc  ", " ", "   ", "\x00 a", "x" * 3000, "ab " * 2000]
    docs = [*edge, *((10_000 + i, t) for i, t in enumerate(texts))]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [tuple(r) for r in alignment.op12_alignment(spark, str(tmp_path)).select(columns).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(plain_alignment(docs), key=key)


def test_arrays_of_the_operator_give_the_tokens_back(spark):
    docs = [(1, "Some words, aligned  twice."), (2, None), (3, "été 中文")]
    rows = {r.doc_id: r for r in alignment.aligned(spark.createDataFrame(docs, "doc_id long, text string"), A, B).collect()}
    bytes_a, bytes_b = alignment.bytes_of_a(A), alignment.bytes_of_b(B)
    for doc_id, text in docs:
        x, y, i, j, cuts = (np.frombuffer(rows[doc_id][c], "<i4") for c in alignment._ARRAYS)
        whole = (" " + text).encode() if text else b""
        assert b"".join(bytes_a[k] for k in x) == b"".join(bytes_b[k] for k in y) == whole
        for p, q, e in zip(i, j, cuts):
            assert b"".join(bytes_a[k] for k in x[:p]) == b"".join(bytes_b[k] for k in y[:q]) == whole[:e]


def test_lockstep_with_any_lanes():
    rng = np.random.default_rng(2)
    end_a = np.unique(np.append(rng.integers(1, 20_000, 6_000), 20_000))
    end_b = np.unique(np.append(rng.integers(1, 20_000, 5_000), 20_000))
    want = np.intersect1d(end_a, end_b)
    for lane in (1, 16, 512, 1 << 20):
        a, b = alignment.lockstep(end_a, end_b, alignment.lanes(end_a, end_b, np.array([20_000]), lane))
        assert (end_a[a] == want).all() and (end_b[b] == want).all()


def test_pairs_stay_within_their_bound():
    a, b = [b"x", b"yx", b"ab"], [b"x", b"zyx", b"b", b""]
    ends = lambda p, q: bool(p and q) and (p.endswith(q) or q.endswith(p))
    assert alignment.most_pairs(a, b) == sum(ends(p, q) for p in a for q in b)


# ---- 13


def plain_collocations(docs, least, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, 6):
                count[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in count.items():
        rows = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            longer = [q for q, n in f.items() if n >= least and len(q) > len(p) and 100 * n >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, total[lang], s) for i, (s, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"budget": 40, "bits": (6, 5)}, {"budget": 1, "bits": (10, 10), "most_broadcast": 0}])
def test_collocations_by_definition(spark, limits):
    rng = random.Random(6)
    words = ["the", "Of", "new", "york", "city", "x", "y", "zeta", "é", "a-b"]
    texts = []
    for _ in range(90):
        text = " ".join("new York city" if rng.random() < 0.15 else rng.choice(words) for _ in range(rng.randint(0, 30)))
        texts.append(re.sub(" ", lambda m: rng.choice([" ", " ", "\t", ", ", ".\n", "  "]), text))
    texts += ["x x x x x x x x x"] * 6 + [None, "", " ,. \n"]
    docs = [(rng.choice(["en", "de", None, "und"]), t) for t in texts]
    frame = spark.createDataFrame(docs, "lang string, text string").withColumn("phrase", F.lit("own")).withColumn("rank", F.lit(0)).repartition(3)
    got = phrases.collocations(spark, frame, least=4, top=25, **limits)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, 4, 25)


def test_products_of_more_than_64_bits(spark, monkeypatch):
    big = 3 * 10**12
    nodes = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 7)], "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10**14 + 3)], "lang string, total long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a, **k: (nodes, totals))
    row = phrases.collocations(spark, spark.createDataFrame([], "lang string, text string")).first()
    assert row.score == 1000 * (big - 7) * (10**14 + 3) // (big * (big + 1))


def test_full_prefixes_are_split():
    group, depths = phrases.virtual_trees([np.array([5, 900, 0, 7]), np.array([450, 451, 9])], 500)
    assert group[0][1] == -1 and group[0][2] == -1 and group[0][0] == group[0][3] >= 0
    assert (group[1] >= 0).all() and group[1][0] != group[1][1]
    assert depths == [1, 2, 2]
