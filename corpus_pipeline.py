"""The corpus pipeline: five stages over ``documents``, each calling one
operator of ``lakemarts.llm``.

``run`` writes every stage's result to the shared folder and reads it back as
the next stage's documents.  All stages but the last return the columns of
``documents``, extra ones included.  Null and empty texts, very long texts,
ties, repeated rows and empty tables give in every stage what the docstring of
its operator says.  The last one has the documents' tokens and digests; SQL cannot
express the stages, so ``ORACLE_SQL`` is None and the tests hold the pipeline
against a version without Spark.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.llm import bpe
from lakemarts.llm.common import stored, table
from lakemarts.llm.decontaminate import drop_contaminated
from lakemarts.llm.pii import replace_pii
from lakemarts.llm.simhash import keep_first
from lakemarts.llm.toxicity import reject_toxic

VOCABULARY = "byte_bpe_50k.tiktoken"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (score 0.5 or more) go.
    Null and empty texts have the score of the model's intercept; without
    labels nothing goes."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest
    doc_id; of rows that repeat an id one stays.  Null and empty texts are one
    group, as they share a fingerprint."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold
    none, and an empty benchmark leaves all."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; n_chars follows the text
    (of null texts it stays).  No row goes."""
    out = replace_pii(docs).drop("pii_spans")
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; a
    null text is encoded as an empty one."""
    ranks = bpe.vocabulary(spark, public_tokenizers.path(VOCABULARY))
    decoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
