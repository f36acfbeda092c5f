"""Day-grained campaign aggregates, kept up to date batch by batch.

One aggregate per (campaign, day) holds what the campaign reports and the
period tables add up: it is far smaller than the fact and additive, so a new
batch of events costs its own counts and the days it touches, and a report over
any window of days is the difference of two running sums per campaign. Nothing
here reads an event twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import clean
from ..operators.materialize import path_exists
from ..operators.star import Star
from ..session import checkpoint_dir

SUMS = ("impressions", "clicks", "cost", "click_cost", "revenue")


def campaign_days(fact: DataFrame) -> DataFrame:
    """(campaign_id, day) -> impressions, clicks, cost, cost of clicked events,
    revenue."""
    return fact.groupBy("campaign_id", F.to_date("timestamp").alias("day")).agg(
        F.count("event_id").alias("impressions"), F.count_if("was_clicked").alias("clicks"), F.sum("ad_cost").alias("cost"),
        F.sum(F.when(F.col("was_clicked"), F.col("ad_cost"))).alias("click_cost"), F.sum("ad_revenue").alias("revenue"))


def added(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregates rolled up to coarser ``keys``; a sum of nothing stays NULL."""
    types = dict(days.dtypes)
    return days.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in SUMS])


def merge_days(spark: SparkSession, path: str, delta: DataFrame, batch: int) -> DataFrame:
    """Add a batch's counts to the aggregate stored at ``path`` (a folder a
    day): only the days the batch touches are read and replaced.

    Every row remembers the last batch that it holds. A batch that is merged
    again, because its first try was lost halfway, adds nothing to the days
    that it had reached. Batches are numbered upwards."""
    new = delta.withColumn("batch", F.lit(batch).cast("bigint"))
    if path_exists(spark, path):             # replacing partitions leaves no _SUCCESS
        # a row of this batch or a later one is settled: its day was replaced whole
        stored = spark.read.schema(new.schema).parquet(path)
        hit = stored.join(delta.select("day").distinct(), "day", "left_semi")
        settled = hit.where(F.col("batch") >= batch).select("day").distinct()
        fresh = new.join(settled, "day", "left_anti")
        open_days = hit.join(settled, "day", "left_anti")
        types = dict(new.dtypes)
        # the batch's mark goes on every row of a day that is replaced
        new = open_days.unionByName(fresh).groupBy("campaign_id", "day").agg(
            *[F.sum(c).cast(types[c]).alias(c) for c in SUMS]).withColumn("batch", F.lit(batch).cast("bigint"))
    checkpoint_dir(spark)
    # through a reliable checkpoint: the files that are replaced are no longer read
    rows = new.checkpoint(eager=True)
    (rows.hint("rebalance", "day").sortWithinPartitions("day", "campaign_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
    return spark.read.schema(rows.schema).parquet(path)


def running(days: DataFrame) -> DataFrame:
    """The aggregate with sums up to and with each day (``upto``): a campaign
    has a row per day, however many events it has."""
    order = Window.partitionBy("campaign_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("campaign_id", "day", F.struct(*[F.sum(c).over(order).alias(c) for c in SUMS]).alias("upto"))


def window(run: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Per campaign with events from ``first_day`` to ``last_day``, its sums in
    that window: the last running row of the window less the last one before."""
    day, first = F.col("day"), F.to_date(F.lit(first_day))
    ends = (run.where(day <= F.to_date(F.lit(last_day))).groupBy("campaign_id").agg(
        F.max_by("upto", "day").alias("b"), F.max_by("upto", F.when(day < first, day)).alias("a"), F.max("day").alias("last")))
    return ends.where(F.col("last") >= first).select(
        "campaign_id", *[(F.col(f"b.{c}") - F.coalesce(F.col(f"a.{c}"), F.lit(0))).alias(c) for c in SUMS])


# ---- period tables from the aggregate -----------------------------------------


def advertisers_by_month(days: DataFrame, star: Star) -> DataFrame:
    """Spend of clicked events per (month, advertiser)."""
    per = added(days.withColumn("mnth", clean.month_key(F.col("day").cast("timestamp_ntz"))), ["campaign_id", "mnth"])
    j = (per.where("clicks > 0").join(star.dim_campaign.select("campaign_id", "advertiser_id"), "campaign_id")
         .join(star.dim_advertiser.withColumnRenamed("name", "advertiser_name"), "advertiser_id"))
    return j.groupBy("mnth", "advertiser_name").agg(F.sum("click_cost").cast("double").alias("total_spend")).where(
        "mnth IS NOT NULL AND total_spend IS NOT NULL")


def refresh_periods(spark: SparkSession, path: str, days: DataFrame, touched: DataFrame, star: Star,
                    build: Callable[[DataFrame, Star], DataFrame] = advertisers_by_month) -> DataFrame:
    """Bring a period table (``mnth`` folders) up to date: the months of the
    ``touched`` days are built anew from the aggregate and replace what was
    stored, so a key whose clustering value changed is not left behind."""
    month = F.trunc("day", "month")
    months = touched.select(month.alias("month")).distinct()
    table = build(days.withColumn("month", month).join(months, "month", "left_semi").drop("month"), star)
    (table.hint("rebalance", "mnth").sortWithinPartitions("mnth", F.col("total_spend").desc(), "advertiser_name").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("mnth").parquet(path))
    return spark.read.schema(table.schema).parquet(path)
