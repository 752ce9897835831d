"""Pattern matches with their positions, in DataFrame functions only.

Spark's regular expressions return the matches of a text but not where they are. Splitting the text by the same pattern gives the gaps between them, so the end
of match k is the sum of the first k gaps and matches. Those sums are taken by a window over a document's matches, which is linear however many there are.
Lengths are code points, as Spark counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.shared import stored


def scanned(spark: SparkSession, docs: DataFrame, patterns: dict[str, str], *, text: str = "text", number: str = "__uid", context: tuple[int, int] = (0, 0)) -> DataFrame:
    """All columns of ``docs`` but the text, a number for each row, and ``found``: per kind (by place) its matches with the gap before each.

    With ``context``, a match also has that many characters before and behind it (from the gaps between matches of its kind). The step is stored: texts
    are scanned once, and what follows works on matches. The number holds for the stored step only, unless ``docs`` brings a column of that name.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    known = docs if number in docs.columns else docs.withColumn(number, F.monotonically_increasing_id())
    rows = known.withColumn("__text", body)
    rows = rows.withColumns({f"__m{k}": F.regexp_extract_all("__text", F.lit(p), F.lit(0)) for k, p in enumerate(patterns.values())})
    parts = []
    for k, p in enumerate(patterns.values()):
        some = F.size(f"__m{k}") > 0
        pieces = F.split("__text", p, -1)
        around = [F.transform(pieces, F.length), F.transform(pieces, lambda x: F.right(x, F.lit(context[0]))), F.slice(F.transform(pieces, lambda x: F.left(x, F.lit(context[1]))), 2, F.size(f"__m{k}"))]
        zipped = F.arrays_zip(*(F.slice(a, 1, F.size(f"__m{k}")).alias(c) for a, c in zip(around, "gba")), F.col(f"__m{k}").alias("m"))
        pairs = F.transform(zipped, lambda x: F.struct(F.lit(k).alias("kind"), x["g"].alias("gap"), x["m"].alias("match"), x["b"].alias("before"), x["a"].alias("after")))
        parts.append(F.when(some, pairs).otherwise(F.array().cast("array<struct<kind: int, gap: int, match: string, before: string, after: string>>")))
    kept = [c for c in docs.columns if c not in (text, number)]
    return stored(spark, rows.select(*kept, number, F.concat(*parts).alias("found")), "spans")


def placed(rows: DataFrame, *kept: str, number: str = "__uid") -> DataFrame:
    """One row per match: number, kept columns, kind, match, before, after, start, end."""
    each = rows.select(number, *kept, F.posexplode("found").alias("i", "f")).select(number, *kept, "i", *(F.col(f"f.{c}").alias(c) for c in ("kind", "gap", "match", "before", "after")))
    size = F.length("match")
    before = Window.partitionBy(number, "kind").orderBy("i")
    return each.withColumn("end", F.sum(F.col("gap") + size).over(before)).withColumn("start", F.col("end") - size).drop("i", "gap")


def listed(spans: Column, names: list[str]) -> Column:
    """'kind:start:end,...' of an array of structs (start, kind, end)."""
    kinds = F.array(*(F.lit(n) for n in names))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def sql_matches(kinds: dict[str, str]) -> str:
    """DuckDB: the table ``m`` (rid, kind, i, v, s, e) of all matches by RE2, from a table ``d`` with rid and t."""
    parts = " UNION ALL ".join(f"SELECT rid, {k} AS kind, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gs FROM d" for k, p in enumerate(kinds.values()))
    return f"""f AS ({parts}),
u AS (SELECT rid, kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS v, unnest(gs[1:len(ms)]) AS g FROM f),
m AS (SELECT rid, kind, i, v, sum(length(g) + length(v)) OVER w - length(v) AS s, sum(length(g) + length(v)) OVER w AS e
      FROM u WINDOW w AS (PARTITION BY rid, kind ORDER BY i))"""
