"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import (bpe, fair_mix, filter_audit, grid_join, langid, line_store, posting_lists, prefix_trie, quality, simhash,
                          surrogates, token_files, warc)
from faremill.llm.common import written
from faremill.session import scratch_path

SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "a key of the deployment")


def tokenizer(name: str) -> str:
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op2_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op3_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return posting_lists.nearest(vectors, queries, top=5)


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_files.token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"))


def op6_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = written(fair_mix.sized(table(spark, sf_dir, "documents")), "sizes")
    plan = written(fair_mix.mix_plan(sizes), "plan")
    return fair_mix.with_copies(sizes, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages_of(table(spark, sf_dir, "documents"))


def op8_bpe_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.select("doc_id", "lang", F.exp("log_perplexity").alias("perplexity"), "low", "threshold",
                       (~F.col("rejected")).alias("kept"))


def op10_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_line_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = line_store.load(docs, scratch_path(spark, "lines"))
    return line_store.deduped(docs, store).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.documents_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_grid_order_join": op2_grid_order_join,
    "op3_posting_lists": op3_posting_lists,
    "op4_simple8b": op4_simple8b,
    "op5_warc": op5_warc,
    "op6_fair_mix": op6_fair_mix,
    "op7_cross_parsing": op7_cross_parsing,
    "op8_bpe_prefixes": op8_bpe_prefixes,
    "op9_kneser_ney": op9_kneser_ney,
    "op10_simhash_bk": op10_simhash_bk,
    "op11_line_store": op11_line_store,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
}
