"""Operator 5: licences by TF-IDF cosine to templates, inherited from the nearest directory above.

1. One scan counts, for every word (hashed to ``2**BITS`` places, so of fixed size), the lines of the corpus that have it: the inverse document frequencies.
2. A second scan compares each line with each template. Only lines with a heavy word of a template can reach the least cosine, by prefix filtering: a template's
   words are ordered by weight, and those behind the point where the rest is lighter than ``least`` of its norm are not looked for. The cosine of a candidate line uses
   all its words. The best match of a document is its own licence (ties: the first template, then the first line).
3. A document mostly made of matching lines (``file_share`` of its words) is a licence file and speaks for its directory; of several, the best match, then the
   smallest path does. Each different directory looks up all its ancestors by a join on their paths, the deepest wins, and documents without
   a licence of their own take their directory's. Directories are reduced to different ones before they are joined.

Edge cases: null and empty texts have no lines; a null path has no directory and inherits nothing; repeated rows give a row each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.shared import ALNUM, LOWER, U64, code_points_before, documents, runs, slices, span_hashes, utf8

BITS = 20
#: notices of licences as they stand in headers and licence files
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def line_words(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, ...]:
    """Lines (start, end, row) and, of each word, its hashed place and its line."""
    first, last, row = runs(data != 10, offsets)
    low = LOWER[data]
    begin, end, _ = runs(ALNUM[low], offsets)
    place = (span_hashes(low, begin, end) >> U64(64 - bits)).astype(np.int64)
    return first, last, row, place, np.searchsorted(first, begin, side="right") - 1


class Templates:
    """Weights of the templates' words, and which words a line needs for a cosine of ``least``."""

    def __init__(self, templates: list[tuple[str, str]], idf: np.ndarray, least: float) -> None:
        data, offsets = utf8(pa.array([t.replace("\n", " ") for _, t in templates]))
        _, _, row, place, line = line_words(data, offsets)
        self.words, word = np.unique(place, return_inverse=True)
        weight = np.zeros((len(templates), len(self.words)))
        np.add.at(weight, (row[line], word), 1.0)
        weight = np.where(weight > 0, 1 + np.log(np.maximum(weight, 1)), 0) * idf[self.words]
        self.weight = weight / np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-12)
        needed = np.zeros(len(self.words), bool)
        for w in self.weight:
            order = np.argsort(-w, kind="stable")
            rest = np.sqrt(np.maximum(0, 1 - np.concatenate([[0], np.cumsum(w[order] ** 2)])))
            needed[order[: int(np.argmax(rest < least))]] = True
        self.needed = self.words[needed]


def best_lines(data: np.ndarray, offsets: np.ndarray, templates: Templates, idf: np.ndarray, least: float) -> list[tuple[int, int, int, int, int, float, int]]:
    """(row, start, end in bytes, words, template, cosine, words of the row) of every line that matches."""
    first, last, row, place, line = line_words(data, offsets)
    if not len(place):
        return []
    hit = np.isin(place, templates.needed)
    wanted = np.unique(line[hit])
    cut_a, cut_b = np.searchsorted(line, wanted), np.searchsorted(line, wanted, side="right")
    total = np.bincount(row[line], minlength=len(offsets) - 1)
    out = []
    for k, a, b in zip(wanted.tolist(), cut_a.tolist(), cut_b.tolist()):
        own, n = np.unique(place[a:b], return_counts=True)
        w = (1 + np.log(n)) * idf[own]
        at = np.minimum(np.searchsorted(templates.words, own), len(templates.words) - 1)
        known = templates.words[at] == own
        cosine = templates.weight[:, at[known]] @ w[known] / max(float(np.linalg.norm(w)), 1e-12)
        t = int(np.argmax(np.round(cosine, 9)))
        if cosine[t] >= least:
            out.append((int(row[k]), int(first[k]), int(last[k]), b - a, t, float(cosine[t]), int(total[row[k]])))
    return out


def line_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each place, the lines of the corpus with a word there, and all lines. The driver gets at most ``2**BITS`` sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, lines = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets):
                first, _, _, place, line = line_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                count += np.bincount(np.unique((line << BITS) | place) & ((1 << BITS) - 1), minlength=1 << BITS)
                lines += len(first)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(count[some], lines))], names=["place", "n"])

    table = docs.select(F.col("text").cast("string")).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    place, n = table.column("place").to_numpy(), table.column("n").to_numpy()
    count = np.zeros(1 << BITS, np.int64)
    count[place[place >= 0]] = n[place >= 0]
    return count, int(n[place < 0].sum())


FOUND = "doc_id long, path string, license string, cosine double, start long, end long, share double"


def own_licenses(spark: SparkSession, docs: DataFrame, path: Column, *, templates: list[tuple[str, str]] | None = None, least: float = 0.6) -> DataFrame:
    """One row per document: its path, best licence line (null without one) and the share of its words in matching lines."""
    templates = templates or TEMPLATES
    count, lines = line_frequencies(docs)
    idf = np.log((1 + lines) / (1 + count)) + 1e-3
    sent = spark.sparkContext.broadcast(idf.astype(np.float32))
    names = [n for n, _ in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value.astype(np.float64)
        known = Templates(templates, weights, least)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                best: dict[int, tuple] = {}
                covered: dict[int, int] = {}
                for r, start, end, words, t, cosine, total in best_lines(part, own, known, weights, least):
                    covered[r] = covered.get(r, 0) + words
                    if r not in best or round(cosine, 9) > round(best[r][3], 9):
                        best[r] = (start, end, t, cosine, total)
                out = []
                for r in range(b - a):
                    if r in best:
                        start, end, t, cosine, total = best[r]
                        s, e = code_points_before(part[own[r] : own[r + 1]], np.array([start, end]) - own[r]).tolist()
                        out.append((names[t], cosine, s, e, covered[r] / total))
                    else:
                        out.append((None, None, None, None, 0.0))
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.float64())
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.cast("string").alias("path"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def directory(path: Column) -> Column:
    """What stands before the last slash; '' for a path without one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(found: DataFrame, *, file_share: float = 0.3) -> DataFrame:
    """Add the licence that holds for each document, whether it is its own, and the directory that it comes from otherwise."""
    found = found.withColumn("dir", directory(F.col("path")))
    best = F.struct((-F.round("cosine", 9)).alias("c"), "path", "license")
    files = found.filter(F.col("license").isNotNull() & (F.col("share") >= file_share) & F.col("path").isNotNull())
    speaking = files.groupBy("dir").agg(F.min(best).alias("best")).select(F.col("dir").alias("above"), F.col("best.license").alias("dir_license"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = found.select("dir").filter("dir is not null").distinct().select("dir", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), above))).alias("above"))
    nearest = ancestors.join(speaking, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "dir_license")).alias("best"))
    joined = found.join(nearest.select("dir", F.col("best.above").alias("above"), F.col("best.dir_license").alias("dir_license")), "dir", "left")
    own = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("license", "dir_license").alias("license"), F.when(own, "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(~own, F.col("above")).alias("from_dir"), "cosine", "start", "end", "share",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` have no paths: source, language and thousand make the directories."""
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return inherited(own_licenses(spark, documents(spark, sf_dir), path))
