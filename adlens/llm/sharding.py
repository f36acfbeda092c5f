"""Contiguous shards of nearly equal bytes.

Rows are put in id order by a range shuffle of (id, size, checksum) alone.
Every partition reports its bytes and rows; prefix sums of those totals (one
pair per partition) give each partition its offset, so one pass over the
sorted rows knows the global byte position of every document. The byte line
is cut at equal targets: a document belongs to the shard in whose stretch its
first byte falls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_documents

SHARDS = 16


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard
    (0 to shards - 1, contiguous in id order), slot (place in the shard, from
    0), grown_shard (null: only the `key` law has one).

    Null text has no bytes (size 1, checksum 0). Null ids come first, rows of
    one id in the order of their checksums and sizes. Fewer rows than shards
    leave shards empty; an empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    rows = cut(sized.repartitionByRange(*order).sortWithinPartitions(*order))
    # totals: one row per partition
    totals = {r[0]: (r[1], r[2]) for r in rows.groupBy(F.spark_partition_id().alias("p"))
              .agg(F.sum("size"), F.count(F.lit(1))).collect()}
    before, at = {}, [0, 0]
    for p in sorted(totals):
        before[p] = tuple(at)
        at = [at[0] + totals[p][0], at[1] + totals[p][1]]
    total = max(1, at[0])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte, row = before.get(TaskContext.get().partitionId(), (0, 0))
        for b in batches:
            size = np.asarray(b.column("size"))
            starts = byte + np.cumsum(size) - size
            # starts * shards may pass 2^63 beyond half an exabyte: divide the target instead
            target = np.array([-(-total * k // shards) for k in range(1, shards)], np.int64)
            shard = np.searchsorted(target, starts, side="right").astype(np.int32)
            place_ = row + np.arange(len(size))
            byte, row = byte + int(size.sum()), row + len(size)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(place_)],
                                             names=["doc_id", "size", "text_crc32", "shard", "place"])

    placed = rows.mapInArrow(place, "doc_id long, size long, text_crc32 long, shard int, place long")
    # first place of each shard: at most `shards` rows
    first = F.broadcast(placed.groupBy("shard").agg(F.min("place").alias("first")))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows to ``path/shard=N/``, each shard in id order within its
    files. Ids must be distinct and not null."""
    where = assign_shards(docs, shards, id_col, text_col).select(F.col("doc_id").alias("_id"), "shard")
    out = docs.join(where, F.col(id_col).cast("long") == F.col("_id")).drop("_id")
    out.repartitionByRange("shard", id_col).sortWithinPartitions("shard", id_col).write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_documents(spark, sf_dir))
