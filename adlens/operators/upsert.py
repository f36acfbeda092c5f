"""Insert-or-replace by primary key, last write wins.

``upsert`` keeps, per key, the row with the greatest ``order`` value; it is
one ``groupBy(key).agg(max_by(struct(rest), struct(order)))``, which Spark
aggregates partially on the map side (no window sort, and a hot key costs a
single partial row per task). ``merge_upsert`` applies a new batch to an
existing table; ``write_merged`` persists the result to a *new* path, never
overwriting the path being read, ``merge_partitions`` into a stored table of
which it replaces only the partitions touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .materialize import path_exists


def upsert(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` (all remaining
    columns when ``order`` is empty)."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    latest = F.max_by(F.struct(*rest), F.struct(*(order or rest)))
    return df.groupBy(*key).agg(latest.alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in rest])


def merge_upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str],
                 order: Sequence[str], batch_col: str = "_batch") -> DataFrame:
    """Rows of ``updates`` replace rows of ``existing`` with the same key;
    inside one batch ``order`` decides."""
    both = (existing.withColumn(batch_col, F.lit(0))
            .unionByName(updates.withColumn(batch_col, F.lit(1))))
    return upsert(both, key, [batch_col, *order]).drop(batch_col)


def write_merged(spark: SparkSession, existing_path: str, updates: DataFrame, key: Sequence[str],
                 order: Sequence[str], out_path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Persisted merge: read the current table (if any), merge, write a new
    version to ``out_path`` (never over the path being read). With
    ``partition_by`` (a prefix of ``key``), only touched partitions are merged."""
    if existing_path and path_exists(spark, existing_path):
        current = spark.read.parquet(existing_path)
        if partition_by:
            # only partitions the batch touches are merged; the rest are copied
            # as they are (no shuffle, no aggregate) into the new version
            touched = updates.select(*partition_by).distinct()
            keep = current.join(touched, list(partition_by), "left_anti")
            hit = current.join(touched, list(partition_by), "left_semi")
            merged = keep.unionByName(merge_upsert(hit, updates, key, order))
        else:
            merged = merge_upsert(current, updates, key, order)
    else:
        merged = upsert(updates, key, order)
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out_path)
    return spark.read.parquet(out_path)


def merge_partitions(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str],
                     order: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Persisted merge into the table at ``path``: only partitions that the
    batch touches are read, merged and replaced; no other file changes.

    ``partition_by`` must be part of ``key``. The merged rows go to a reliable
    checkpoint first, so the files that are replaced are no longer read then.
    The same batch merged again (after a lost job) gives the same table."""
    by = list(partition_by)
    if not set(by) <= set(key):
        raise ValueError(f"partition columns {by} must be part of the key {list(key)}")
    if path_exists(spark, path):             # replacing partitions leaves no _SUCCESS
        current = spark.read.schema(updates.schema).parquet(path)
        touched = updates.select(*by).distinct()
        merged = merge_upsert(current.join(touched, by, "left_semi"), updates, key, order)
    else:
        merged = upsert(updates, key, order)
    checkpoint_dir(spark)
    (merged.checkpoint(eager=True).hint("rebalance", *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return spark.read.schema(updates.schema).parquet(path)
