"""M7: star-schema integrity as a violation report.

The source declares the rules as DDL (primary keys, foreign keys, NOT NULL,
UNIQUE) and aborts on the first violation. Here each rule is a count of
violating rows — duplicates by ``groupBy().count() > 1``, missing parents by
``left_anti`` joins, NULLs by ``count_if`` — and all rules come back as one
``(rule, violations)`` frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .star import Star

PRIMARY_KEYS = {
    "dim_advertiser": ["advertiser_id"], "dim_campaign": ["campaign_id"], "dim_user": ["user_id"],
    "dim_ad_slot": ["ad_slot_id"], "dim_targeting": ["targeting_id"], "fact_event": ["event_id"],
}
UNIQUE = {"dim_advertiser": ["name"], "dim_ad_slot": ["size"]}
NOT_NULL = {
    "dim_advertiser": ["name"], "dim_campaign": ["advertiser_id", "name"], "dim_targeting": ["campaign_id"],
    "fact_event": ["campaign_id", "targeting_id", "ad_slot_id", "user_id", "timestamp"],
}
FOREIGN_KEYS = [
    ("dim_campaign", "advertiser_id", "dim_advertiser"),
    ("dim_targeting", "campaign_id", "dim_campaign"),
    ("fact_event", "campaign_id", "dim_campaign"),
    ("fact_event", "targeting_id", "dim_targeting"),
    ("fact_event", "ad_slot_id", "dim_ad_slot"),
    ("fact_event", "user_id", "dim_user"),
]


def _unpivot(agg: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One-row aggregate -> ``(rule, violations)`` rows."""
    arr = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(col).cast("bigint").alias("violations"))
                    for rule, col in rules.items()])
    return agg.select(F.inline(arr))


def _duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows beyond the first per non-NULL key (one grouped pass)."""
    dup = (df.where(F.expr(" and ".join(f"`{c}` is not null" for c in cols)))
           .groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1))
    return dup.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("v"))


def star_integrity(star: Star) -> DataFrame:
    """All rules as ``(rule, violations)``. Per table: one grouped pass per
    key rule, and one pass for its NOT NULL and foreign-key rules together
    (the table left-joined to each parent's distinct keys)."""
    t = star.tables()
    parts = []
    for table, cols in PRIMARY_KEYS.items():
        parts.append(_unpivot(_duplicates(t[table], cols), {f"pk:{table}": "v"}))
    for table, cols in UNIQUE.items():
        parts.append(_unpivot(_duplicates(t[table], cols), {f"unique:{table}.{cols[0]}": "v"}))
    children = sorted(set(NOT_NULL) | {c for c, _, _ in FOREIGN_KEYS})
    for table in children:
        rows = t[table]
        aggs, rules = [], {}
        for c in NOT_NULL.get(table, []):
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"nn_{c}"))
            rules[f"not_null:{table}.{c}"] = f"nn_{c}"
        for child, col, parent in FOREIGN_KEYS:
            if child != table:
                continue
            pk = PRIMARY_KEYS[parent][0]
            mark = f"_in_{parent}"
            keys = t[parent].select(F.col(pk).alias(col)).distinct().withColumn(mark, F.lit(True))
            rows = rows.join(keys, col, "left")
            aggs.append(F.count_if(F.col(col).isNotNull() & F.col(mark).isNull()).alias(f"fk_{col}"))
            rules[f"fk:{table}.{col}"] = f"fk_{col}"
        parts.append(_unpivot(rows.agg(*aggs), rules))
    return reduce(DataFrame.unionByName, parts)
