"""Exact histogram of encoded lengths, and what follows from it for every
context limit.

Documents are reduced to their number of ids and counted by it, so all that
is left has one row per distinct length. Suffix sums over those rows are made
in two levels (within blocks of lengths, and over the blocks), no window spans
them all. For a limit L, with the documents of at least L ids counted in
``docs_ge``: tokens kept = tokens below L + L * docs_ge.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encoder, read_vocabulary
from .bpe_codec import default_vocabulary
from .common import cut, read_documents, text_blocks

#: Lengths of one block of the suffix sums.
SPAN = 1024


def token_lengths(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text") -> DataFrame:
    """n_tokens of every row (null text: 0)."""
    vocab = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        for batch in batches:
            for _, texts in text_blocks(batch):
                yield pa.RecordBatch.from_arrays([pa.array(enc.encode(texts)[1])], names=["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every distinct length, taken as a context limit: n_docs of just
    that length; docs_ge, tokens_ge of that length or more; docs_total,
    tokens_total; share_below (share of the documents that are shorter, so the
    q-quantile of the lengths is the largest length with share_below <= q);
    tokens_kept, tokens_cut when every document is truncated to the limit."""
    hist = histogram.select("n_tokens", "n_docs", F.expr(f"n_tokens div {SPAN}").alias("block"))
    w = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("n_docs") * F.col("n_tokens")
    inside = hist.select("*", F.sum("n_docs").over(w).alias("docs_in"), F.sum(size).over(w).alias("tokens_in"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(size).alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
                           F.sum("d").over(every).alias("docs_total"), F.sum("t").over(every).alias("tokens_total"))
    out = inside.join(blocks, "block").select(
        "n_tokens", "n_docs", (F.col("docs_in") + F.col("docs_after")).alias("docs_ge"),
        (F.col("tokens_in") + F.col("tokens_after")).alias("tokens_ge"), "docs_total", "tokens_total")
    kept = F.col("tokens_total") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")
    return out.withColumns({"share_below": 1 - F.col("docs_ge") / F.col("docs_total"), "tokens_kept": kept,
                            "tokens_cut": F.col("tokens_total") - kept})


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_over, tokens_kept, tokens_cut for any limits (from the rows
    of ``suffix_sums``, in one aggregate with two sums per limit). Without
    documents all are 0."""
    n, d = F.col("n_tokens"), F.col("n_docs")
    sums = [F.coalesce(F.max("tokens_total"), F.lit(0)).alias("total")]
    for k, x in enumerate(limits):
        sums += [F.coalesce(F.sum(F.when(n > x, d)), F.lit(0)).alias(f"d{k}"),
                 F.coalesce(F.sum(F.when(n > x, (n - x) * d)), F.lit(0)).alias(f"c{k}")]
    rows = [F.struct(F.lit(int(x)).cast("long").alias("limit"), F.col(f"d{k}").alias("docs_over"),
                     (F.col("total") - F.col(f"c{k}")).alias("tokens_kept"), F.col(f"c{k}").alias("tokens_cut"))
            for k, x in enumerate(limits)]
    return table.agg(*sums).select(F.inline(F.array(*rows)))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(cut(length_histogram(token_lengths(read_documents(spark, sf_dir)))))
