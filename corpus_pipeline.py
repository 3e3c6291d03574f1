"""A corpus pipeline: quality rules, language ID, near-duplicates, source mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; its result is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``documents``.

An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import language_id, mixing, near_duplicates, quality, sentencepiece_codec
from tillgrid.llm.common import read_table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality.keep_clean(docs)


def identified_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from the documents of the stage."""
    return language_id.keep_identified(docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_duplicates.keep_one_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.taken_copies(docs, mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the SentencePiece ids of every row."""
    encoded = sentencepiece_codec.encode(docs)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("identified_language", identified_language),
    ("near_duplicate_groups", near_duplicate_groups),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")


#: Language models, sums of subsets and piece lattices have no SQL form; tests/llm compares with plain Python.
ORACLE_SQL = None
