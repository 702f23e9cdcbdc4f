"""The corpus pipeline: documents to token files, each stage written as Parquet and read again.

Stages take (spark, docs, sf_dir) and return a DataFrame: language ID, near-dedup, decontamination and
mixing return the columns of their input, the last the digests of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm import decontam, langid, minhash, mixing, tokens
from touchcredit.llm.common import cut, fold, ship, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; learned from the labelled ones of op2's training rows."""
    ship(spark)
    model = langid.fit(docs.where(fold(F.col("doc_id"), langid.PARTS) != langid.HELD))
    return langid.keep_known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return minhash.dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold."""
    ship(spark)
    return tokens.encode_documents(spark, docs)


STAGES = [
    ("language ID", language),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token output", token_output),
]

#: Language ID, sketches and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
