"""Operator 6: personal data by weak supervision. DataFrame functions only.

Candidates are the matches of the four base patterns that pass their checks, and of three more patterns that are less certain. Five labelers vote on each: its
shape, its inner structure (octets, issuer, area), gazetteers (top-level domains, calling codes, countries), words before it, and what touches
it. Votes are counted by kind and pattern over the whole corpus; expectation-maximisation over these counts (at most kinds x 3^5 rows, whatever the input)
estimates how often each labeler is right when it votes, and the share of true spans of each kind. A logistic span classifier with kind, votes and length as
features is then fitted to the estimated labels, again on counts, and its weights become a column expression. Base matches are spans whatever it
says; the other kinds are spans where it gives ``accept`` or more and no base span touches them.

Edge cases: null texts are empty; repeated rows give a row each; an empty table gives no rows (and a classifier without weights); other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.shared import documents
from panelcast.llm.spans import listed, placed, scanned

#: the base patterns, written so that Java needs no backtracking and no recursion on long runs; they match what the plain ones match
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){13,18}+(?![\\x20-]?[0-9])",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "tel": "(?<![0-9+(.-])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9-])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": "(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Z0-9])",
}
KINDS = list(PATTERNS)
BASE = 4
EMAIL, IP, CARD, PHONE, TEL, SSN, IBAN = range(7)
LABELERS = ("shape", "structure", "gazetteer", "context", "edges")
CONTEXT = (24, 1)
# gazetteers
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|ch|at|us|ca|au|jp|cn|br|mx|in"
CALLING_CODES = "1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
COUNTRIES = "AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE"
FOR_WORDS = "(?i)(mail|phone|tel|call|fax|card|visa|iban|account|konto|ssn|social|host|addr|contact|kontakt)"
AGAINST_WORDS = "(?i)(version|isbn|issn|order|invoice|ref|serial|build)[^A-Za-z]*$"


def luhn(digits: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""

    def term(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + term(i)) % 10 == 0


def candidates(rows: DataFrame) -> DataFrame:
    """Placed matches that pass the checks of their kind."""
    each = placed(rows).withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    kind, size = F.col("kind"), F.length("digits")
    octet = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
    passes = (
        F.when(kind == IP, F.col("match").rlike(f"^{octet}(\\.{octet}){{3}}$"))
        .when(kind == CARD, luhn(F.when(kind == CARD, F.col("digits")).otherwise("0")))
        .when(kind == PHONE, size.between(10, 15))
        .otherwise(True)
    )
    return each.filter(passes)


def voted(found: DataFrame) -> DataFrame:
    """A vote of 1, -1 or 0 by each labeler, and the length class."""
    kind, match, digits = F.col("kind"), F.col("match"), F.col("digits")
    choose = lambda yes, no=None: F.when(yes, 1).otherwise(-1) if no is None else F.when(yes, 1).when(no, -1).otherwise(0)
    votes = {
        "shape": F.when(kind < BASE, 1).otherwise(0),
        "structure": F.when(kind == EMAIL, choose(match.rlike("^[A-Za-z0-9][^@]*@.*\\.[A-Za-z]{2,}$")))
        .when(kind == IP, choose(match.rlike("^(?!0|255)[1-9][0-9]*(\\.(0|[1-9][0-9]*)){3}$")))
        .when(kind == CARD, choose(digits.rlike("^[3-6]")))
        .when(kind == PHONE, choose(F.length(digits) >= 11))
        .when(kind == TEL, choose(digits.rlike("^[2-9][0-9]{2}[2-9]")))
        .when(kind == SSN, choose(~digits.rlike("^(000|666|9)|^...00|0000$")))
        .otherwise(choose(F.length(match).between(15, 34))),
        "gazetteer": F.when(kind == EMAIL, choose(match.rlike(f"\\.(?:{DOMAINS})$")))
        .when(kind == PHONE, choose(match.rlike(f"^\\+(?:{CALLING_CODES})")))
        .when(kind == IBAN, choose(match.rlike(f"^(?:{COUNTRIES})")))
        .otherwise(0),
        "context": choose(F.col("before").rlike(FOR_WORDS), F.col("before").rlike(AGAINST_WORDS)),
        "edges": F.when(F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]"), -1).otherwise(1),
    }
    return found.withColumns({**{n: v.cast("int") for n, v in votes.items()}, "long": F.when(F.length("match") >= 16, 1).otherwise(0)})


def reliabilities(counts: list[tuple], rounds: int = 50) -> tuple[dict[int, float], list[float], list[float]]:
    """Expectation-maximisation over (kind, votes, n): the share of true spans per kind, how often each labeler that votes is right, and the
    probability of each row of counts to be true."""
    share = {k: 0.7 for k, _, _ in counts}
    right = [0.8] * len(LABELERS)
    posterior = [0.5] * len(counts)
    for _ in range(rounds):
        for r, (kind, votes, _) in enumerate(counts):
            logit = math.log(share[kind] / (1 - share[kind])) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, right))
            posterior[r] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
        for k in share:
            own = [(p, n) for (kind, _, n), p in zip(counts, posterior) if kind == k]
            share[k] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        for j in range(len(right)):
            cast = [(p if votes[j] > 0 else 1 - p, n) for (_, votes, n), p in zip(counts, posterior) if votes[j]]
            # a prior of some right votes keeps labelers from turning around
            right[j] = min(0.99, (8 + sum(p * n for p, n in cast)) / (10 + sum(n for _, n in cast)))
    return share, right, posterior


def features(kind: int, votes: tuple[int, ...], long: int) -> list[float]:
    return [1.0 if kind == k else 0.0 for k in range(len(KINDS))] + [float(v) for v in votes] + [float(long)]


def fit(rows: list[tuple[list[float], float, int]], rounds: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> list[float]:
    """Logistic regression on weighted rows (features, share of true, weight) by gradient steps."""
    size = len(rows[0][0]) if rows else len(KINDS) + len(LABELERS) + 1
    beta, total = [0.0] * size, sum(n for _, _, n in rows)
    for _ in range(rounds if rows else 0):
        step = [ridge * b for b in beta]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, beta))))))
            for j, a in enumerate(x):
                step[j] += (p - y) * a * n / total
        beta = [b - rate * s for b, s in zip(beta, step)]
    return beta


def classifier(votes: DataFrame) -> Column:
    """Probability of a span, by a model trained on the votes of the whole corpus; the driver sees counts per pattern of votes."""
    counted = votes.groupBy("kind", *LABELERS, "long").count().orderBy("kind", *LABELERS, "long").collect()
    counts = [(r["kind"], tuple(r[n] for n in LABELERS), r["count"]) for r in counted]
    _, _, posterior = reliabilities(counts)
    beta = fit([(features(r["kind"], tuple(r[n] for n in LABELERS), r["long"]), p, r["count"]) for r, p in zip(counted, posterior)])
    logit = F.element_at(F.array(*(F.lit(b) for b in beta[: len(KINDS)])), F.col("kind") + 1)
    for name, b in zip((*LABELERS, "long"), beta[len(KINDS) :]):
        logit = logit + F.col(name) * F.lit(b)
    return 1 / (1 + F.exp(-logit))


def personal_spans(spark: SparkSession, docs: DataFrame, *, accept: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Scanned rows, and their spans: __uid, kind (place in ``KINDS``), match, start, end, probability."""
    rows = scanned(spark, docs.select("doc_id", "text"), PATTERNS, context=CONTEXT)
    votes = voted(candidates(rows))
    scored = votes.withColumn("probability", classifier(votes))
    base = F.col("kind") < BASE
    order = Window.partitionBy("__uid").orderBy("start", "kind")
    ends = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(ends <= F.col("start"), F.lit(True)) & F.coalesce(starts >= F.col("end"), F.lit(True))
    kept = scored.withColumn("free", free).filter(base | (F.col("free") & (F.col("probability") >= accept)))
    return rows, kept.select("__uid", "kind", "match", "start", "end", "probability")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = personal_spans(spark, documents(spark, sf_dir))
    one = F.struct("start", "kind", "end")
    per = spans.groupBy("__uid").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS)), F.collect_list(F.when(F.col("kind") < BASE, one)).alias("base"), F.collect_list(one).alias("every")
    )
    joined = rows.select("doc_id", "__uid").join(per, "__uid", "left")
    counts = [F.coalesce(F.col(f"n_{n}"), F.lit(0)).cast("long").alias(f"n_{n}") for n in KINDS]
    text = lambda c: F.coalesce(listed(F.col(c), KINDS), F.lit(""))
    return joined.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("every").alias("spans"))
