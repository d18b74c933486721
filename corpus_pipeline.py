"""The corpus pipeline: stages over `documents`, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.llm import bpe, fair_mix, quality, simhash, surrogates
from faremill.llm.common import written
from faremill.llm.queries import SURROGATE_KEY, table, tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is ordinary for their language."""
    return quality.judged(docs, table(spark, sf_dir, "labels")).filter("NOT rejected").select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, words=3, radius=2)


def surrogate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates."""
    return surrogates.with_surrogates(docs, SURROGATE_KEY)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice comes as two rows."""
    return fair_mix.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("simhash near-dedup", one_of_near_copies),
    ("pii", surrogate_texts),
    ("mixing", mixed_sources),
    ("bpe", token_ids),
]

# Several stages (hash automata, merges of tokens) have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
