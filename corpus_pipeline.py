"""A training corpus from raw documents: quality, repeated lines, near copies, benchmark passages, packed sequences.

Every stage takes what the one before kept and returns the columns of documents, the last one packed pieces. Rejected documents go in
the first stage, and failing lines of the others; frequent lines go in the second; of near copies the one with the smallest id
stays; documents that share a window with the benchmark go. n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from desklake.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from desklake.llm.common import stored, table
from desklake.llm.queries import vocabulary_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_frequent_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, *vocabulary_files())


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark), ("best-fit packing", packed)]
ORACLE_SQL = None  # token ids are not for SQL to make


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
