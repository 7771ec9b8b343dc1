"""From raw ``documents`` to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the ``docs`` of the next. All but the last return the columns of
``documents``; the last returns the pieces of packed sequences.

A document that a stage leaves without a single word goes; one that came without words
is the quality rules' matter. A row of nulls, an empty table and extra columns pass
through as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.lineage import stored
from tabwright.llm import lines, ngrams, quality, substrings
from tabwright.llm.queries import packed_documents
from tabwright.llm.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and the learned decision list."""
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that nearly repeat an earlier line."""
    return lines.without_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngrams.one_of_each_class(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 20 words that start earlier."""
    return substrings.without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, packed into sequences."""
    return packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the learned rules nor the packing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
