"""A corpus pipeline: documents are filtered, deduplicated and packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import exact_dedup, langid, ngram_join, packing, quality
from adlens.llm.common import cut, read_documents, read_labels


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, read_labels(spark, sf_dir))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.keep_identified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return ngram_join.keep_one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that is left, packed into sequences."""
    return packing.pack(docs)


STAGES = [("quality", good), ("language", identified), ("exact_dedup", distinct), ("ngram_join", dissimilar), ("packing", packed)]

#: SQL can't express the classifiers and encodings; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
