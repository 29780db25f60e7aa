"""From raw documents to token ids: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from wearline.llm import bpe, decontaminate, language, pii, simhash
from wearline.llm.queries import ready, remainder
from wearline.session import settle

RANKS = "byte_bpe_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told; those without a letter or far from all are rejected."""
    ready(spark)
    model = language.fit(docs.where(remainder("doc_id", 3) != 1))
    verdict = language.predict_column(spark, model, F.col("text"))
    return docs.withColumn("_verdict", verdict).where(~F.col("_verdict.rejected")).drop("_verdict")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group."""
    ready(spark)
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that share no window of words with a benchmark item."""
    ready(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; n_chars follows where it was known."""
    ready(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long")))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their digest, and that of the text they decode to."""
    ready(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("bpe_tokens", to_tokens),
]

#: SQL can express neither the trained models nor byte-pair merges; tests compare each stage with
#: a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
