"""Sampling (P1-P4).

The source reads a CSV in chunks and stops early once every month has its
quota. Here the quota sample is exact and deterministic: rows are ranked
inside their stratum by a seeded hash of their key, bucket by bucket of that
hash, and the first ``quota`` kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def head_sample(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order`` (file order needs an explicit key;
    planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def month_of(ts: str | Column) -> Column:
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM")


def distinct_months(df: DataFrame, ts: str) -> DataFrame:
    """The sorted set of calendar months present (reads one column)."""
    return df.select(month_of(ts).alias("month")).where(F.col("month").isNotNull()).distinct().orderBy("month")


def seeded_order(key: str, seed: int) -> Column:
    """Pseudo-random but reproducible order of rows: md5 of key and seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified_quota(df: DataFrame, stratum: str | Column, quota: int, key: str,
                     seed: int = 42, stratum_name: str = "stratum") -> DataFrame:
    """At most ``quota`` rows per stratum, the first by a seeded hash of ``key``.

    Ranked in two stages, so no window holds a stratum: the hash's first two
    digits put a stratum's rows in 256 buckets that follow one another in hash
    order. Counts per bucket, added up, give the rank at which each bucket
    starts; rows of the buckets that start below the quota are ranked within
    their bucket.
    """
    s = df.withColumn(stratum_name, stratum if isinstance(stratum, Column) else F.col(stratum))
    s = s.withColumn("_h", seeded_order(key, seed)).withColumn("_b", F.substring("_h", 1, 2))
    before = Window.partitionBy(stratum_name).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (s.groupBy(stratum_name, "_b").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .where(F.col("_start") < quota)
              .select(F.col(stratum_name).alias("_s"), F.col("_b").alias("_sb"), "_start"))
    near = s.join(starts, F.col(stratum_name).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    rank = F.row_number().over(Window.partitionBy(stratum_name, "_b").orderBy("_h", key))
    return near.withColumn("_rn", rank).where(F.col("_start") + F.col("_rn") <= quota).select(
        *[c for c in s.columns if c not in ("_h", "_b")])


def stratified_fraction(df: DataFrame, stratum: str | Column, quota: int, seed: int = 42,
                        stratum_name: str = "stratum") -> DataFrame:
    """P3, approximate: each row of a stratum is kept with probability
    ``quota / n`` (Bernoulli, seeded), so a stratum yields about ``quota``
    rows — one pass plus the per-stratum counts, no ranking at all."""
    s = df.withColumn(stratum_name, stratum if isinstance(stratum, Column) else F.col(stratum))
    sizes = s.groupBy(stratum_name).agg(F.count(F.lit(1)).alias("_n"))
    return (s.join(sizes, stratum_name)
            .where(F.rand(seed) < F.least(F.lit(1.0), F.lit(float(quota)) / F.col("_n")))
            .drop("_n"))


def stratum_distribution(sample: DataFrame, stratum: str) -> DataFrame:
    """Rows per stratum after sampling (the total is their sum)."""
    return sample.groupBy(stratum).agg(F.count(F.lit(1)).alias("n_rows"))
