"""Corpus pipeline over ``documents``: each stage applies one training-data operator to what the
stage before it kept.

1. ``quality_rules``: documents that the base rules or the adaptive fences reject go.
2. ``line_dedup``: repeated lines stay in the smallest document id only; texts may become empty.
3. ``near_dedup``: one document of each group of near-duplicates stays (five words, 0.8 or more).
4. ``decontaminate``: documents with a twentieth or more of their words in benchmark windows go.
5. ``packing``: what is left, as pieces of packed sequences.

All stages but the last return the columns of ``documents``. SQL cannot express the tokenizer of the
last stage, so the pipeline has no oracle; the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, written
from tessera.llm.decontaminate import decontaminate
from tessera.llm.lines import drop_repeated_lines
from tessera.llm.minhash import drop_near_duplicates
from tessera.llm.packing import pack
from tessera.llm.quality import keep_good
from tessera.llm.tokens import tokenizer_path

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
