"""Operator 4: toxic passages as maximum-scoring segments of token log-odds, and a calibrated score per document.

1. One scan counts tokens: in all documents (the background) and in the labelled training documents, toxic and clean, in two folds. Tokens are the
   words and their prefixes of a few lengths, known by a 64-bit hash, so no two share a count whatever the vocabulary. Tasks send their counts whenever
   ``HELD`` tokens have come together; Spark adds them up.
2. Weights: the log-odds of a token between toxic and clean text, each with a Dirichlet prior whose pseudo-counts follow the background
   (a share ``prior`` of each class's tokens), shrunk towards zero by their own standard error: a token less than ``LEAST_Z`` errors from zero has no weight
   and is left out of the model, as is every token that no labelled document has. A word has the weight of its most significant token, less ``drift``.
3. A linear scan per document finds all maximal scoring segments (each positive, no better inside or around it). Runs of words of one sign
   are joined first with numpy, so the loop sees only those with a positive word. Segments count as passages if extreme-value theory
   (Karlin-Altschul: chance segments of n words reach x with probability 1 - exp(-K n exp(-lambda x))) makes them rare; lambda solves the
   moment equation over the clean counts, K makes the agreed share of clean training documents significant by chance.
4. A logistic curve turns a document's evidence into a probability. It is fitted on scores of documents by weights of the other fold, over at most
   ``train_rows`` labelled documents (those with the smallest hash of ``doc_id``; a bound of what is sent to every task). Counts and scores cover all documents.
   The driver gets the tokens that have a weight, which only labelled documents of that bound can give, and four features for each of these.

Neither labels, lang, source nor doc_id enter a score. Edge cases: null and empty texts have no tokens and get the score of a document without any
evidence; null or repeated labels: a document is toxic if one row says so; null ``doc_id`` is never labelled; without labels of both kinds, as with empty tables, every
score is the share of toxic labels, kept between 1e-4 and 1 - 1e-4; repeated documents give a row each, and a repeated ``doc_id`` one training row (the first by words
and scores); very long texts are scanned alone, by one task each; of tokens equally significant the longest counts; an input column named like a made one is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.shared import ALNUM, LOWER, U64, code_points_before, documents, mapped, runs, slices, span_hashes, stored, utf8, without

#: 0: the whole word; else its first bytes, if it is longer
PREFIXES = (0, 10, 8, 6)
ALL, CLEAN_A, CLEAN_B, TOXIC_A, TOXIC_B = range(5)
#: a task sends its counts when it holds so many tokens
HELD = 1 << 18
#: errors from zero below which a token has no weight
LEAST_Z = 2.5
NONE = U64(0)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word's tokens (one row for each kind; ``NONE`` where a word is too short), then start, end and row of the words."""
    low = LOWER[data]
    first, last, row = runs(ALNUM[low], offsets)
    out = np.empty((len(PREFIXES), len(first)), U64)
    for k, size in enumerate(PREFIXES):
        end = np.minimum(last, first + size) if size else last
        out[k] = np.maximum(span_hashes(low, first, end) ^ U64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1), U64(1))
        if size:
            out[k][last - first <= size] = NONE
    return out, first, last, row


def counts_by_token(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in order, and for each how often it comes up in all documents and in those of each group."""
    order = np.argsort(hashes)
    hashes, group = hashes[order], group[order]
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    count = np.zeros((5, len(begin)), np.int64)
    count[ALL] = np.diff(np.append(begin, len(hashes)))
    labelled = np.flatnonzero(group != ALL)
    owner = np.searchsorted(begin, labelled, side="right") - 1
    np.add.at(count, (group[labelled], owner), 1)
    return hashes[begin], count


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several such counts as one."""
    hashes = np.concatenate([h for h, _ in parts])
    merged, owner = np.unique(hashes, return_inverse=True)
    count = np.empty((5, len(merged)), np.int64)
    for k in range(5):  # one kind of count at a time
        count[k] = np.bincount(owner, weights=np.concatenate([c[k] for _, c in parts]), minlength=len(merged))
    return merged, count


def weights(count: np.ndarray, sums: np.ndarray, clean: list[int], toxic: list[int], prior: float = 1.0, least_z: float = LEAST_Z) -> tuple[np.ndarray, np.ndarray]:
    """Shrunk log-odds and significance of some tokens, by their counts and the sums over all tokens; zeros where a class has no tokens."""
    n, n_toxic, n_clean = float(sums[ALL]), float(sums[toxic].sum()), float(sums[clean].sum())
    if not n_toxic or not n_clean:
        return np.zeros(count.shape[1]), np.zeros(count.shape[1])
    return _weights(count, clean, toxic, [n, n_toxic, n_clean], prior, least_z)


def _weights(count: np.ndarray, clean: list[int], toxic: list[int], sums: list[float], prior: float, least_z: float) -> tuple[np.ndarray, np.ndarray]:
    """``weights`` where both classes have tokens."""
    background = count[ALL].astype(np.float64) / max(sums[0], 1)
    a, b = count[toxic].sum(0).astype(np.float64), count[clean].sum(0).astype(np.float64)
    pseudo_a, pseudo_b = prior * sums[1] * background, prior * sums[2] * background
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.log((a + pseudo_a) / np.maximum(sums[1] * (1 + prior) - a - pseudo_a, 1e-9)) - np.log((b + pseudo_b) / np.maximum(sums[2] * (1 + prior) - b - pseudo_b, 1e-9))
        z = odds / np.sqrt(1 / (a + pseudo_a) + 1 / (b + pseudo_b))
    odds, z = np.nan_to_num(odds, nan=0, posinf=0, neginf=0), np.nan_to_num(z)
    keep = np.maximum(0, 1 - (least_z / np.maximum(np.abs(z), 1e-9)) ** 2)
    return odds * keep, np.abs(z)


def word_scores(own: np.ndarray, model: "Model") -> np.ndarray:
    """The weight of each word's most significant token, less the drift."""
    best = np.zeros(own.shape[1])
    score = np.zeros(own.shape[1])
    for hashes in own:
        # most tokens have no weight: a table by their first bits tells so at once
        maybe = np.flatnonzero(model.some[(hashes >> U64(64 - SIFT)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.token, hashes[maybe]), max(len(model.token) - 1, 0))
        hit = model.token[at] == hashes[maybe] if len(model.token) else np.zeros(len(maybe), bool)
        maybe, at = maybe[hit], at[hit]
        better = model.z[at] > best[maybe]
        score[maybe[better]] = model.weight[at[better]]
        best[maybe] = np.maximum(best[maybe], model.z[at])
    return score - model.drift


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, score), in linear time: candidates are kept on a stack with the running sums left of and at their ends."""
    stack: list[tuple[int, int, float, float]] = []
    total = 0.0
    for i, s in enumerate(scores):
        left, total = total, total + s
        if s <= 0:
            continue
        first, right = i, total
        while True:
            j = len(stack) - 1
            passed = []
            while j >= 0 and stack[j][2] >= left:
                passed.append(stack[j])
                j -= 1
            if j < 0 or stack[j][3] >= right:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, i, left, right))
    return [(a, b, right - left) for a, b, left, right in stack]


def segments(scores: np.ndarray, row: np.ndarray, n: int) -> list[list[tuple[int, int, float]]]:
    """Per row, the maximal segments as (first word, last word, score); words are numbered over all rows."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(n)]
    if not len(scores):
        return out
    up = scores > 0
    new = np.concatenate([[True], (up[1:] != up[:-1]) | (row[1:] != row[:-1])])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(scores)) - 1
    sums = np.add.reduceat(scores.astype(np.float64), begin)
    owner = row[begin]
    some = np.unique(owner[sums > 0])
    for r, a, b in zip(some.tolist(), np.searchsorted(owner, some).tolist(), np.searchsorted(owner, some, side="right").tolist()):
        out[r] = [(int(begin[a + i]), int(end[a + j]), s) for i, j, s in maximal_segments(sums[a:b].tolist())]
    return out


FEATURES = 4
SIFT = 20


@dataclass
class Model:
    """What scoring needs: the tokens that have a weight, in order of their hashes."""

    token: np.ndarray
    weight: np.ndarray
    z: np.ndarray
    drift: float
    rate: float  # lambda
    scale: float  # K
    curve: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    significance: float = 0.01

    @cached_property
    def some(self) -> np.ndarray:
        """Whether any token of the model begins with these bits."""
        out = np.zeros(1 << SIFT, bool)
        out[(self.token >> U64(64 - SIFT)).astype(np.int64)] = True
        return out

    def evidence(self, segs: list[tuple[int, int, float]], words: int) -> tuple[list[float], list[tuple[int, int, float]]]:
        """Features of a document, and its significant passages with their chance of coming up in as long a text."""
        passages = []
        for a, b, s in segs:
            chance = -np.expm1(-self.scale * words * np.exp(-self.rate * s))
            if chance <= self.significance:
                passages.append((a, b, float(chance)))
        best = max((s for _, _, s in segs), default=0.0)
        bits = np.log(max(self.scale * words, 1e-9)) - self.rate * best if segs else 0.0
        total = sum(s for _, _, s in segs) * self.rate
        return [min(max(-bits, 0.0), 40.0), np.log1p(total), np.log1p(len(passages)), np.log1p(total / np.sqrt(max(words, 1)))], passages

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[1:] + self.curve[0], -30, 30)))


def moment_rate(weight: np.ndarray, count: np.ndarray) -> float:
    """The positive lambda with mean exp(lambda * score) = 1 under some counts (1 if there is none)."""
    share = count / max(count.sum(), 1)
    mean = lambda x: float((share * np.exp(np.clip(x * weight, -50, 50))).sum())
    if not (weight[count > 0] > 0).any() or (share * weight).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return (low + high) / 2


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta = beta - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ beta)
    return beta


def base_model(token: np.ndarray, weight: np.ndarray, z: np.ndarray, count: np.ndarray, n_clean: int, drift: float) -> Model:
    """A model of tokens with their weights and clean counts; all other tokens of clean documents have the weight zero."""
    used = z >= LEAST_Z
    rest = max(n_clean - int(count[used].sum()), 0)
    rate = moment_rate(np.append(weight[used], 0.0) - drift, np.append(count[used], rest).astype(np.float64))
    return Model(token[used], weight[used], z[used], drift, rate, 1.0)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


#: clean and toxic groups of the whole model and of those of each fold
SPLITS = (([CLEAN_A, CLEAN_B], [TOXIC_A, TOXIC_B]), ([CLEAN_A], [TOXIC_A]), ([CLEAN_B], [TOXIC_B]))


def training_features(rows: DataFrame, rates: list[float], significance: float) -> tuple[float, np.ndarray, np.ndarray]:
    """K, the features of training documents and whether they are toxic, from stored rows doc_id, toxic, fold, words, scores.

    A ``doc_id`` is one row, so the driver gets ``FEATURES`` numbers for each labelled document of the sample, however often its id repeats.
    """
    one = rows.groupBy("doc_id").agg(F.min(F.struct("words", "scores", "toxic", "fold")).alias("r")).select("doc_id", "r.*")
    rate = F.when(F.col("fold") == 0, F.lit(rates[1])).otherwise(F.lit(rates[0]))
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    one = one.withColumn("rate", rate).withColumn("best", best)
    rare = one.filter(~F.col("toxic") & (F.col("words") > 0)).agg(F.percentile(F.col("words") * F.exp(-F.col("rate") * F.col("best")), F.lit(significance)).alias("low")).first()["low"]
    # K: a share of ``significance`` of the clean documents has a segment as rare as that
    scale = float(-np.log1p(-significance) / max(1.0 if rare is None else rare, 1e-30))
    chance = lambda s: -F.expm1(-F.lit(scale) * F.col("words") * F.exp(-F.col("rate") * s))
    total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + s) * F.col("rate")
    surprise = F.when(F.size("scores") > 0, F.log(F.greatest(scale * F.col("words"), F.lit(1e-9))) - F.col("rate") * F.col("best")).otherwise(0.0)
    features = [
        F.least(F.greatest(-surprise, F.lit(0.0)), F.lit(40.0)),
        F.log1p(total),
        F.log1p(F.size(F.filter("scores", lambda s: chance(s) <= significance)).cast("double")),
        F.log1p(total / F.sqrt(F.greatest(F.col("words"), F.lit(1)).cast("double"))),
    ]
    got = one.select("doc_id", "toxic", *(f.alias(f"f{k}") for k, f in enumerate(features))).toArrow().sort_by("doc_id")
    x = np.column_stack([got.column(f"f{k}").to_numpy() for k in range(FEATURES)])
    return scale, x, got.column("toxic").to_numpy().astype(float)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, train_rows: int = 200_000, drift: float = 0.8) -> Model:
    """Learn from the labels that are not held out."""
    own = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the bounded sample: at most train_rows pairs of a long and a byte reach the driver and the tasks
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("doc_id", F.col("toxic").cast("int")).toArrow()
    ids = sample.column("doc_id").to_numpy().astype(np.int64)
    toxic = sample.column("toxic").to_numpy().astype(np.int64) > 0
    order = np.argsort(ids)
    ids, toxic = ids[order], toxic[order]
    fold = (span_hashes(ids, np.arange(len(ids)), np.arange(1, len(ids) + 1)) & U64(1)).astype(np.int64)
    share = float(toxic.mean()) if len(toxic) else 0.0
    bounded = min(max(share, 1e-4), 1 - 1e-4)
    final = Model(np.zeros(0, U64), np.zeros(0), np.zeros(0), drift, 1.0, 1.0)
    final.curve[0] = np.log(bounded / (1 - bounded))
    if share in (0.0, 1.0):
        return final
    sent = spark.sparkContext.broadcast((ids, np.where(toxic, TOXIC_A, CLEAN_A) + fold))

    def group_of(column: pa.Array) -> np.ndarray:
        known, group = sent.value
        key = column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return np.where((known[place] == key) & column.is_valid().to_numpy(zero_copy_only=False), group[place], ALL)

    columns = [f"c{k}" for k in range(5)]

    def batch_of(token: pa.Array, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([token, *map(pa.array, count)], names=["token", *columns])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of tokens, and a row without a token that sums up this task's."""
        sums, held = np.zeros((5, 1), np.int64), []
        for batch in batches:
            group = group_of(batch.column(0))
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                own, _, _, row = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                there = own != NONE
                held.append(counts_by_token(own[there], np.broadcast_to(group[a:b][row], own.shape)[there]))
                sums += held[-1][1].sum(1, keepdims=True)
                if sum(len(h) for h, _ in held) > 2 * HELD:
                    held = [added(held)]
                    if len(held[0][0]) > HELD:
                        yield batch_of(pa.array(held[0][0].view(np.int64)), held[0][1])
                        held = []
        if held:
            h, count = added(held)
            yield batch_of(pa.array(h.view(np.int64)), count)
        yield batch_of(pa.nulls(1, pa.int64()), sums)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = mapped(text, counted, "token long, " + ", ".join(f"{c} long" for c in columns)).groupBy("token").agg(*(F.sum(c).alias(c) for c in columns))
    counts = stored(spark, table.filter("token is null or c1 + c2 + c3 + c4 > 0"), "token-counts")
    sums = np.array([0 if v is None else v for v in counts.filter("token is null").agg(*(F.sum(c) for c in columns)).first()], np.int64)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens that have a weight in any of the three models."""
        for batch in batches:
            count = np.stack([batch.column(1 + k).to_numpy() for k in range(5)])
            made = [(*weights(count, sums, clean, toxic), count[clean].sum(0)) for clean, toxic in SPLITS]
            use = np.flatnonzero(np.any([z >= LEAST_Z for _, z, _ in made], axis=0))
            arrays = [batch.column(0).take(pa.array(use)), *(pa.array(v[use]) for m in made for v in m)]
            yield pa.RecordBatch.from_arrays(arrays, names=["token", *(f"{c}{k}" for k in range(3) for c in "wzn")])

    schema = "token long, " + ", ".join(f"w{k} double, z{k} double, n{k} long" for k in range(3))
    got = mapped(counts.filter("token is not null"), weighed, schema).toArrow()
    token = got.column("token").to_numpy().view(U64)
    order = np.argsort(token)
    column = lambda c: got.column(c).to_numpy()[order]
    models = [base_model(token[order], column(f"w{k}"), column(f"z{k}"), column(f"n{k}"), int(sums[SPLITS[k][0]].sum()), drift) for k in range(3)]
    models[0].curve = final.curve
    final, halves = models[0], models[1:]
    sent_halves = spark.sparkContext.broadcast(halves)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segment scores of training documents, by the weights of the fold that they are not in."""
        for batch in batches:
            group = group_of(batch.column(0))
            use = np.flatnonzero(group != ALL)
            if not len(use):
                continue
            group, keys, texts = group[use], batch.column(0).take(pa.array(use)), batch.column(1).take(pa.array(use))
            data, offsets = utf8(texts)
            for a, b in slices(offsets):
                own, _, _, row = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                words = np.bincount(row, minlength=b - a)
                both = [segments(word_scores(own, m), row, b - a) for m in sent_halves.value]
                fold = (group[a:b] - 1) % 2
                listed = [[s for _, _, s in both[1 - f][k]] for k, f in enumerate(fold.tolist())]
                made = [pa.array(group[a:b] >= TOXIC_A), pa.array(fold.astype(np.int32)), pa.array(words.astype(np.int64)), pa.array(listed, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), *made], names=["doc_id", "toxic", "fold", "words", "scores"])

    rows = stored(spark, mapped(text, scored, "doc_id long, toxic boolean, fold int, words long, scores array<double>"), "training-scores")
    sent_halves.destroy()
    sent.destroy()
    scale, x, y = training_features(rows, [half.rate for half in halves], final.significance)
    final.scale = scale
    if len(x):
        final.curve = fit_curve(x, y)
    return final


PASSAGES = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("chance", T.DoubleType())]))
_ARROW_PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))


def score(spark: SparkSession, docs: DataFrame, model: Model, *, text: str = "text", prefix: str = "", threshold: float = 0.3) -> DataFrame:
    """The columns of ``docs`` plus score, predicted, and the significant passages as code point spans with their chance."""
    made = [("score", T.DoubleType()), ("predicted", T.IntegerType()), ("passages", PASSAGES)]
    docs = without(docs, *(prefix + n for n, _ in made))
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for a, b in slices(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                hashes, first, last, row = tokens(part, own)
                words = np.bincount(row, minlength=b - a).tolist()
                found = [m.evidence(s, w) for s, w in zip(segments(word_scores(hashes, m), row, b - a), words)]
                p = m.probability(np.array([f for f, _ in found]).reshape(-1, FEATURES))
                lead = code_points_before(part, np.arange(len(part) + 1))
                spans = [[{"start": int(lead[first[i]] - lead[o]), "end": int(lead[last[j]] - lead[o]), "chance": c} for i, j, c in s] for (_, s), o in zip(found, own.tolist())]
                results = [pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(spans, _ARROW_PASSAGES)]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *results], names=[str(k) for k in range(len(names) + 3)])

    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    schema = T.StructType([*(T.StructField(str(k), f.dataType, True) for k, f in enumerate(docs.schema.fields)), *(T.StructField(str(len(names) + k), t) for k, (_, t) in enumerate(made))])
    return mapped(plain, run, schema).toDF(*names, *(prefix + n for n, _ in made))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(spark, docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))
