"""M1: dense surrogate ids (1, 2, 3, ...) in the order of a natural key.

``row_number()`` over a window without ``PARTITION BY`` sends every row to
one task. Instead the rows are range-partitioned and sorted on the key, the
layout is cut from its lineage with a reliable ``checkpoint()`` (so the
per-partition counts and the ids see the very same partitions even after a
lost executor forces a recompute), and each row gets
``offset(partition) + position in partition``. The offsets table has one row
per partition, a bound fixed by the partition count, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# monotonically_increasing_id() keeps the record number within the partition
# in its lower 33 bits (documented layout).
_POS_MASK = (1 << 33) - 1


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_dense_id(df: DataFrame, order_by: Sequence[str | Column], id_col: str,
                  start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = ``start`` + rank of the row in ``order_by`` order.

    ``order_by`` must be a total order over ``df`` (add the natural key) for
    the ids to be reproducible. Rows are numbered by range partitions and
    per-partition offsets, whatever their number.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or _num_partitions(df)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    tagged = ranged.select("*", F.spark_partition_id().alias("_pid"),
                           (F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))).alias("_pos"))
    # one row per partition, added up on the driver
    offsets, at = [], 0
    for r in sorted(tagged.groupBy("_pid").count().collect()):
        offsets.append((r[0], at))
        at += r[1]
    out = tagged.join(F.broadcast(spark.createDataFrame(offsets, "_pid int, _off bigint")), "_pid")
    return out.select((F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint").alias(id_col), *df.columns)
