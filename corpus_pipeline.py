"""The corpus pipeline: five stages over the documents, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, quality, simhash, tokens
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import tokenizer_file


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id."""
    return simhash.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows do not contaminate."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and what they hold per document."""
    return tokens.token_output(docs, tokenizer_file())


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mix),
    ("token output", token_ids),
]

ORACLE_SQL = None  # SQL trains no model and encodes no tokens; the tests run a plain version instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
