"""From raw documents to packed training sequences: five of the operators in a row.

Every stage takes what the one before it kept, written as Parquet and read
again, so a lost executor costs no earlier stage. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumitrace.llm import decontamination, frames, language, line_templates, near_duplicates, packing
from lumitrace.llm.queries import WORD_TOKENIZER
from lumitrace.workspace import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which a language is found."""
    return language.in_known_language(docs)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that recur across documents."""
    return line_templates.without_recurring_lines(docs)


def one_of_each_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    return decontamination.uncontaminated(docs, frames.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, each with its sequence and place."""
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("language id", known_language),
    ("line dedup", without_recurring_lines),
    ("near duplicates", one_of_each_copy),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Learned predictions and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None

#: Stages write whole texts. Small row groups without a dictionary keep what the writers of an executor hold small.
WRITER = {"parquet_block_size": str(16 << 20), "parquet_enable_dictionary": "false"}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = frames.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), **WRITER)
    return docs
