"""A training corpus from raw documents: five stages, each stored as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, documents contaminated by the benchmark go, secrets are masked,
and what is left is tokenised and packed. All stages but the last return the columns of ``documents``. Rows are told apart by their place in the stored
files, not by ``doc_id``, so repeated rows and null ids are safe.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import fmindex, packing, secrets, simhash, toxicity
from panelcast.llm.shared import documents, stored, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose score stays below 0.3, by a model of this stage's own input."""
    free = unused(docs.columns)
    model = toxicity.train(spark, docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(spark, docs, model, prefix=free).filter(F.col(free + "predicted") == 0).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near-duplicates (the first in the files among equal ids)."""
    return simhash.deduplicated(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents at least a twentieth of whose words lie in benchmark windows; others stay as they are."""
    free = unused(docs.columns)
    found = fmindex.decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), prefix=free)
    return found.filter(~F.col(free + "contaminated")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every secret; all documents stay."""
    return secrets.redacted(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence."""
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [("toxicity", drop_toxic), ("near_dedup", one_of_each), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("packing", pack)]

#: scores, fingerprints and token ids cannot be had from SQL; the stages are tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
