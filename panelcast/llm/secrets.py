"""Operator 2: secrets, weighed by how many repositories and owners have them. DataFrame functions only.

Candidates are the matches of the base patterns and, as the method's own kind, long mixed tokens. Their values are hashed, and the hashes counted over the
whole corpus by distinct repositories and owners, in levels: rows per (hash, repository, owner) first, so a widely copied value shrinks in the map side
before any shuffle. A value of ``shared_owners`` owners or more is an example that people copy; a value of fewer that looks live is a leak.
Base matches are spans whatever their value; a long token becomes a span only if its value is live and no base span touches it.

Edge cases: null texts are empty; null owners and repositories count as one of their own; repeated rows give a row each, their matches count by owner, not by row; an
empty table gives no rows; other columns are ignored by the query and kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.shared import documents, numbered, unused
from panelcast.llm.spans import listed, placed, scanned, sql_matches

_KEYWORDS = "password|passwd|secret|token|api_?key"
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _KEYWORDS)
ASSIGN = f"({_ANY_CASE})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: hex and access runs are matched at their required length, which drops the same matches as a filter behind would
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
    "token": "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
}
KINDS = list(PATTERNS)
ASSIGN_LENGTH = 12


def _assigned() -> Column:
    return F.regexp_extract("match", ASSIGN, 2)


def _looks_live(value: Column) -> Column:
    """Letters and digits, and ten different characters or more."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def candidates(rows: DataFrame, owner: list[str]) -> DataFrame:
    """Placed matches that pass, with the secret's value."""
    each = placed(rows, *owner).withColumn("value", F.when(F.col("kind") == 0, _assigned()).otherwise(F.col("match")))
    return each.filter((F.col("kind") != 0) | (F.length("value") >= ASSIGN_LENGTH)).filter((F.col("kind") != 3) | _looks_live(F.col("value"))).drop("match", "before", "after")


def ownership(found: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """Per value: how many repositories and owners have it."""
    held = found.groupBy(F.xxhash64("value").alias("hash"), "value", owner, *repository).agg(F.count("*").alias("n"))
    by_owner = held.groupBy("hash", "value", owner).agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash", "value").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_matches"))


def secret_spans(spark: SparkSession, docs: DataFrame, *, owner: str = "source", repository: tuple[str, ...] = ("lang",), shared_owners: int = 3) -> tuple[DataFrame, DataFrame]:
    """Scanned rows, and their spans: __uid, kind (place in ``KINDS``), start, end, value, n_owners, n_repositories, shared, live.

    A repository is an owner with the repository columns. Rows of ``docs`` that have a ``__uid`` keep it.
    """
    slim = docs.select(*dict.fromkeys(["doc_id", owner, *repository, "text", *(c for c in docs.columns if c == "__uid")]))
    rows = scanned(spark, slim, PATTERNS)
    found = candidates(rows, [owner, *repository])
    counts = ownership(found, owner, list(repository)).select("value", "n_owners", "n_repositories")
    shared = F.col("n_owners") >= shared_owners
    known = found.join(counts, "value").withColumn("shared", shared).withColumn("live", ~shared & _looks_live(F.col("value")))
    base = F.col("kind") < 3
    order = Window.partitionBy("__uid").orderBy("start", "kind")
    ends = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(ends <= F.col("start"), F.lit(True)) & F.coalesce(starts >= F.col("end"), F.lit(True))
    return rows, known.withColumn("__free", free).filter(base | (F.col("live") & F.col("__free"))).drop("__free", owner, *repository)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = secret_spans(spark, documents(spark, sf_dir))
    one = F.struct("start", "kind", "end")
    per = spans.groupBy("__uid").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS)),
        F.count_if("shared").alias("n_shared"),
        F.count_if("live").alias("n_live"),
        F.collect_list(F.when(F.col("kind") < 3, one)).alias("base"),
        F.collect_list(one).alias("every"),
    )
    joined = rows.select("doc_id", "__uid").join(per, "__uid", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*(f"n_{n}" for n in KINDS), "n_shared", "n_live")]
    text = lambda c: F.coalesce(listed(F.col(c), KINDS), F.lit(""))
    return joined.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("every").alias("spans"))


def redacted(spark: SparkSession, docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every span replaced by a mark, one for copied examples and one for all others; ``n_chars`` follows where there is such a column.

    Matching again by value would miss positions, so the texts are joined with their spans by the place of the row in the files that ``docs`` is read from. Overlapping spans are merged.
    Null texts stay null, texts without spans as they are; other columns may have any names.
    """
    free = unused(docs.columns)
    uid, own = free + "uid", free + "pieces"
    known = numbered(docs, uid)
    read = dict.fromkeys(["doc_id", "text", settings.get("owner", "source"), *settings.get("repository", ("lang",))])
    _, spans = secret_spans(spark, known.select(*read, F.col(uid).alias("__uid")), **settings)
    # merge overlapping spans: a new group starts where no earlier span reaches
    order = Window.partitionBy("__uid").orderBy("start", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.coalesce(reach > F.col("start"), F.lit(False)), 0).otherwise(1)).over(order)
    merged = spans.withColumn("g", group).groupBy("__uid", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("shared").alias("shared"))
    # each piece carries the plain text from the end of the piece before it
    last = F.coalesce(F.lag("end").over(Window.partitionBy("__uid").orderBy("start")), F.lit(0))
    pieces = merged.withColumn("from", last).groupBy("__uid").agg(F.array_sort(F.collect_list(F.struct("start", "from", "end", "shared"))).alias(own)).withColumnRenamed("__uid", uid)
    mark = lambda x: F.when(x["shared"], F.lit("[EXAMPLE_KEY]")).otherwise(F.lit("[SECRET]"))
    cut = lambda a, n: F.substring(F.col("text"), (a + 1).cast("int"), n.cast("int"))
    body = F.transform(own, lambda x: F.concat(cut(x["from"], x["start"] - x["from"]), mark(x)))
    tail = F.substring(F.col("text"), (F.element_at(own, -1)["end"] + 1).cast("int"), F.length("text"))
    joined = known.join(pieces, uid, "left")
    clean = joined.withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(F.concat(F.array_join(body, ""), tail)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


_SQL_KINDS = {
    "assign": ASSIGN.replace("'", "''"),
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "token": "[A-Za-z0-9+/_=-]+",
}


def _sql_live(v: str) -> str:
    return f"regexp_matches({v}, '[0-9]') AND regexp_matches({v}, '[A-Za-z]') AND len(list_distinct(string_split({v}, ''))) >= 10"


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, coalesce(text, '') AS t FROM documents),
{sql_matches(_SQL_KINDS)},
c AS (SELECT m.rid, kind, s, e, CASE WHEN kind = 0 THEN regexp_extract(v, '{_SQL_KINDS["assign"]}', 2) ELSE v END AS v, source, lang FROM m JOIN d USING (rid)),
p AS (SELECT * FROM c WHERE (kind = 0 AND length(v) >= 12) OR (kind = 1 AND length(v) >= 18) OR (kind = 2 AND length(v) >= 16)
      OR (kind = 3 AND length(v) >= 20 AND {_sql_live("v")})),
o AS (SELECT v, count(DISTINCT coalesce(source, '<null>')) AS n_owners FROM p GROUP BY v),
k AS (SELECT p.*, n_owners >= 3 AS shared, n_owners < 3 AND {_sql_live("p.v")} AS live FROM p JOIN o USING (v)),
q AS (SELECT * FROM k WHERE kind < 3 OR (live AND NOT EXISTS (SELECT 1 FROM k b WHERE b.rid = k.rid AND b.kind < 3 AND b.s < k.e AND k.s < b.e))),
r AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS h, count(*) FILTER (kind = 3) AS tk,
        count(*) FILTER (shared) AS sh, count(*) FILTER (live) AS li,
        string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, kind) AS every
      FROM (SELECT *, (['assign', 'access', 'hex', 'token'])[kind + 1] AS n FROM q) GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(h, 0) AS n_hex, coalesce(tk, 0) AS n_token,
       coalesce(sh, 0) AS n_shared, coalesce(li, 0) AS n_live, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN r USING (rid)
"""
