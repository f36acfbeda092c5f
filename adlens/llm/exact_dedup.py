"""Exact duplicates (native: DataFrame and SQL functions only).

Texts are equal when identical after lower-casing A-Z. The digests are split
by a Misra-Gries pass: a frequent-items sketch of bounded size (Spark's
``approx_top_k``, a weighted Misra-Gries summary) per block of input
partitions, the blocks' sketches merged, names every digest that may hold a
large share of the rows. Those few are verified (counted exactly with their
largest id, map-side) and the verified winners, at most ``HEAVY`` rows, are
broadcast: their copies are settled where they lie. No digest that is left
can be frequent, so the rest shuffles evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, read_documents, unused_name

#: Digests that are named as frequent, at most: the bound of the broadcast.
HEAVY = 128
#: Counters of a sketch. A digest with more than rows / TRACKED copies or so
#: is in the merged sketch for certain (the Misra-Gries guarantee).
TRACKED = 4096
#: Sketches are merged in this many blocks first, then once more.
BLOCKS = 64


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row; null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       digest_of(F.col(text_col)).alias("digest"))


def frequent_digests(prints: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``heavy`` digests with their sketched counts, the most frequent
    first in the sketch's opinion; singletons are dropped."""
    sketches = (prints.groupBy((F.spark_partition_id() % BLOCKS).alias("block"))
                .agg(F.expr(f"approx_top_k_accumulate(hex(digest), {tracked})").alias("s")))
    # grouped by a constant: an empty table has no sketch to merge
    top = sketches.groupBy(F.lit("all").alias("every")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {heavy})").alias("top"))
    return (top.select(F.explode("top").alias("t"))
            .select(F.unhex("t.item").alias("digest"), F.col("t.count").alias("estimate"))
            .filter("estimate > 1"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id (largest id of its equal texts),
    group_size, kept, text_sha256.

    Null ids lose to any other id (in a group of nulls alone keep_id is null
    and all stay). Rows that repeat an id with an equal text count each in
    group_size and are kept or dropped together. An empty table gives none."""
    prints = cut(fingerprints(docs, id_col, text_col))
    named = frequent_digests(prints).select("digest")
    verified = (prints.join(F.broadcast(named), "digest")
                .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    winners = F.broadcast(cut(verified))
    # frequent digests: settled in place against the verified winners
    placed = prints.join(winners, "digest", "left")
    heavy = placed.filter(F.col("group_size").isNotNull())
    rest = placed.filter(F.col("group_size").isNull()).select("digest", "doc_id")
    # the others: two or more rows of a digest meet by an ordinary shuffle
    light = (rest.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    out = heavy.select("doc_id", "keep_id", "group_size", "digest").unionByName(
        rest.join(light, "digest").select("doc_id", "keep_id", "group_size", "digest"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts
    those with the largest id. Other texts under the same id stay."""
    gone = duplicate_groups(docs, id_col, text_col).filter(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_digest")).distinct()
    key = unused_name(docs, "key")
    own = F.struct(F.col(id_col).cast("long").alias("gone_id"), digest_of(F.col(text_col)).alias("gone_digest"))
    return docs.withColumn(key, own).join(gone.select(F.struct("gone_id", "gone_digest").alias(key)), key, "left_anti").drop(key)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(read_documents(spark, sf_dir))


ORACLE = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
