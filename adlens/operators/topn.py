"""Top-N per key and keyed reads (the clustering-order + LIMIT access path).

``row_number() <= n`` over a partitioned window is planned as a
``WindowGroupLimit``: every task keeps at most ``n`` rows per key before the
shuffle, so even a hot key ships only ``n`` rows per map task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_RE = re.compile(r"^\d{4}-\d{2}$")
MAX_LIMIT = 1000
#: Keys (rows of a keys frame) that a read names in its filter, at most.
POINT_KEYS = 64


def check_limit(limit: int) -> int:
    """Limits are 1..1000."""
    if not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be in 1..{MAX_LIMIT}, got {limit!r}")
    return limit


def check_period(period: str) -> str:
    """Periods are ``YYYY-MM``."""
    if not isinstance(period, str) or not PERIOD_RE.match(period):
        raise ValueError(f"period must look like YYYY-MM, got {period!r}")
    return period


def top_n_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
              rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def short_keys(keys: DataFrame, on: Sequence[str]) -> list | None:
    """The rows of a keys frame with no NULL, if it is short (its first rows
    tell), else None."""
    some = keys.select(*on).limit(POINT_KEYS + 1).collect()
    return None if len(some) > POINT_KEYS else sorted({tuple(r) for r in some if None not in tuple(r)})


def named_in_scan(table: DataFrame, on: Sequence[str], named: list) -> DataFrame:
    """The rows of a few keys, named one by one in a filter, so that the scan
    can skip the row groups whose statistics, dictionary or bloom filter know
    none of them."""
    # equalities, not IN: a long IN reaches the scan as a mere range
    one = [reduce(Column.__and__, [F.col(c) == v for c, v in zip(on, key, strict=True)]) for key in named]
    return table.where(reduce(Column.__or__, one, F.lit(False)))


def keyed_read(table: DataFrame, keys: DataFrame, on: Sequence[str], order: Sequence[Column],
               limit: int | None = None) -> DataFrame:
    """Batch form of ``WHERE key = ? ORDER BY clustering LIMIT n`` for every
    key in ``keys`` (unknown keys give no rows); without a limit all rows of
    the keys. A few keys are named in the scan's own filter.

    The per-key limit comes first: ``WindowGroupLimit`` keeps at most ``limit``
    rows per key in every map task, so even a key holding a third of the table
    ships only ``limit x tasks`` rows, and the semi join sees the reduced rows.
    """
    named = short_keys(keys, on)
    if named is not None:
        found = named_in_scan(table, on, named)
        return found if limit is None else top_n_per(found, on, order, check_limit(limit))
    k = keys.select(*on).distinct()
    if limit is None:
        return table.join(k, list(on), "left_semi")
    return top_n_per(table, on, order, check_limit(limit)).join(k, list(on), "left_semi")
