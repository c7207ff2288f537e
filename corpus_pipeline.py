"""A training-corpus pipeline: five stages over the table ``documents``, each of them an operator of ``ptloom.llm``.

A stage takes (spark, docs, sf_dir) and returns what its successor works on;
all but the last return the columns of ``documents``.  ``run`` writes each
stage's result as Parquet to the session's shared checkpoint folder and
reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ptloom.llm import bpe_codec, chunk_dedup, decontaminate, jaccard_join, perplexity
from ptloom.llm.queries import prepare
from ptloom.llm.rows import stored

#: stage 5 and the perplexity bands have no SQL form; the tests hold each stage against a plain version
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the perplexity band of their language."""
    prepare(spark)
    return perplexity.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the least id."""
    prepare(spark)
    return jaccard_join.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; ``n_chars`` follows the text."""
    prepare(spark)
    out = chunk_dedup.shorten(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    prepare(spark)
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, hashed, and the hash of what they decode to, beside the document's id."""
    prepare(spark)
    return bpe_codec.digests(docs, ["doc_id"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
