"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

Quality first, so that later stages see less; then one document of each near-duplicate group (five-word shingles, similarity
0.8) stays; then documents that hold a benchmark item go; what is left is tokenised and packed into sequences of 4096 tokens.

All stages: a null text counts as empty, and empty ones pass every stage that filters; rows without doc_id and repeated rows
are rows like others (near duplicates keeps one of equal rows that have words); texts of any length are read whole; of ties the
smallest doc_id stays; an empty table gives an empty one; further columns are kept by all stages but the last, whatever their
names, and tables without labels or benchmark items leave all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.llm import decontaminate, near_dup, packing, quality
from quarryline.llm.common import read, temporary_tables, written
from quarryline.llm.queries import word_vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; trained on the labelled ones among docs."""
    return quality.classify(docs, read(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return near_dup.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(packing.tokenise(docs, word_vocabulary()))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: No SQL: the stages are trained models, signature search and an order-dependent packing; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary_tables(spark):  # what a stage writes on its way goes as soon as its result is written
            docs = written(stage(spark, docs, sf_dir), name, keep=True)
    return docs
