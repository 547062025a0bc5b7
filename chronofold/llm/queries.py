"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronofold.llm import best_position, fingerprint, language, mixing, near_dup, packing, pii, prefix_trie, threshold, token_store, toxicity, url_filter, vptree
from chronofold.llm.oracles import ORACLES
from chronofold.llm.storage import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_documents(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op11_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.top_products(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Query]:
    every = (op1_token_ids, op2_language, op3_toxicity, op4_pii, op5_fingerprint, op6_nearest, op7_near_dup, op8_packing, op9_url_filter, op10_mixing,
             op11_threshold, op12_prefix_trie, op13_ranked)
    return {f.__name__: f for f in every}


def llm_oracles() -> dict[str, str]:
    """Those that SQL can express over whole tables; see `oracles`."""
    return dict(ORACLES)
