"""From raw documents to packed training sequences, in five stages.

Each stage takes the table that the one before left and returns the next; `run` writes and rereads it between them in
the session's shared folder. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import language, mixing, near_dup, packing, pii
from chronofold.llm.storage import saved, table

#: Words of a shingle and least similarity in percent of near copies.
WIDTH, SIMILAR = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in no language go: null and empty ones, and those without a letter."""
    return language.in_a_known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    return near_dup.without_near_copies(docs, WIDTH, SIMILAR)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return _counted(pii.redacted(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and parts of them, as often as the sources' weights ask for."""
    return _counted(mixing.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence."""
    return packing.packed_documents(docs)


STAGES = [
    ("language", keep_languages),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Suffix automata, pseudorandom permutations and a tokenizer's merges have no SQL form; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
