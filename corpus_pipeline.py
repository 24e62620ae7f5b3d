"""Documents to training sequences: quality rules, exact and near duplicates, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import exact, mixing, ngram_join, packing, quality, queries
from rowtide.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the rules learned from ``labels`` reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels, most_labels=20_000)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z in either case; null as empty): the one of the largest doc_id."""
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, of the smallest doc_id; documents without words all stay."""
    return ngram_join.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix; a null source belongs to the stream of all others."""
    return mixing.mixed(docs, queries.WEIGHTS, block_rows=32, seed=11)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; a null text is its end token alone."""
    return packing.pack(docs, queries.TOKENIZER, end_id=2, room=4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Learned rules and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
