"""Query-first serving tables and their reads (W1-W10), keyed lookups (L1-L3).

Serving tables are derived from the star with set operations (the source
inserts them row by row) and laid out by their access path: the partition
key of the wide-column table becomes a parquet partition column for
low-cardinality keys (month), the clustering order a sort within files.
Reads are batch forms: a keys frame is semi-joined and a per-key limit taken.
"""

from __future__ import annotations

from inspect import signature

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.materialize import BUILD_LOCK
from ..operators.star import Star
from ..operators.topn import check_period, keyed_read
from ..operators.upsert import upsert
from . import periods
from .periods import added, campaign_days, running


def _added(star: Star, keys: list[str], days: DataFrame | None) -> DataFrame:
    """Sums per ``keys`` (``campaign_id``, ``mnth``) from the (campaign, day)
    aggregate, which is made here unless ``days`` has it stored."""
    days = campaign_days(star.fact_event) if days is None else days
    return added(days.withColumn("mnth", clean.month_key(F.col("day").cast("timestamp_ntz"))), keys)


def campaign_performance(star: Star, days: DataFrame | None = None) -> DataFrame:
    """Impressions, clicks and CTR (0 when no events) per campaign name, all time."""
    j = star.dim_campaign.select("campaign_id", "name").join(_added(star, ["campaign_id"], days), "campaign_id", "left")
    g = j.groupBy(F.col("name").alias("campaign_name")).agg(
        F.coalesce(F.sum("impressions"), F.lit(0)).alias("total_impressions"),
        F.coalesce(F.sum("clicks"), F.lit(0)).cast("bigint").alias("total_clicks"))
    return (g.where(F.col("campaign_name").isNotNull())
            .withColumn("ctr", clean.safe_ratio("total_clicks", "total_impressions", zero_if_null=True)))


def campaign_performance_daily(star: Star, days: DataFrame | None = None) -> DataFrame:
    """W1 as its title says: per campaign name and event day."""
    days = campaign_days(star.fact_event) if days is None else days
    j = days.join(star.dim_campaign.select("campaign_id", "name"), "campaign_id")
    g = j.groupBy(F.col("name").alias("campaign_name"), F.col("day").alias("event_date")).agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").cast("bigint").alias("total_clicks"))
    return g.withColumn("ctr", clean.safe_ratio("total_clicks", "total_impressions", zero_if_null=True))


def advertisers_by_month(star: Star, days: DataFrame | None = None) -> DataFrame:
    """Spend of clicked events per (month, advertiser)."""
    return periods.advertisers_by_month(campaign_days(star.fact_event) if days is None else days, star)


def user_history_rows(star: Star) -> DataFrame:
    """W3 raw rows: (user uuid, day, ad uuid, clicked) per event, before the
    primary key collapses them."""
    f = star.fact_event.where(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull()
                              & F.col("ad_slot_id").isNotNull())
    return f.select(
        clean.uuid5_key("user", F.col("user_id").try_cast("bigint")).alias("user_id"),
        F.to_date("timestamp").alias("date_event"),
        clean.uuid5_key("ad", "ad_slot_id").alias("ad_id"),
        F.col("was_clicked"),
        F.col("event_id"))


def user_history(star: Star, layout_partitions: int | None = None) -> DataFrame:
    """W3 table: PK (user, day); several events a day collapse to the last
    write, taken as the greatest event id (the source writes in key order).

    The upsert collapses map-side first, so a busy user's day is a row per
    task; with ``layout_partitions`` its result is then range-partitioned in
    the clustering order of the stored table."""
    rows = upsert(user_history_rows(star), ["user_id", "date_event"], ["event_id"]).drop("event_id")
    if layout_partitions is None:
        return rows
    order = [F.col("user_id").asc(), F.col("date_event").desc()]
    return rows.repartitionByRange(layout_partitions, *order).sortWithinPartitions(*order)


def most_active_users(star: Star) -> DataFrame:
    """Clicked events per (month, user uuid)."""
    f = star.fact_event.where(F.col("was_clicked"))
    g = (f.groupBy(clean.month_key("timestamp").alias("mnth"), "user_id")
         .agg(F.count("event_id").alias("total_clicks")))
    return g.where(F.col("mnth").isNotNull() & F.col("user_id").isNotNull()).select(
        "mnth", clean.uuid5_key("user", F.col("user_id").try_cast("bigint")).alias("user_id"),
        "total_clicks")


def advertisers_by_region(star: Star, trim_keys: bool = False, days: DataFrame | None = None) -> DataFrame:
    """Spend per (month, advertiser, targeting country), all events.

    Targeting joins on campaign only (the source's fan-out): the per
    (campaign, month) cost is multiplied by the number of targeting rows of
    that campaign in each country instead of repeating raw events.
    """
    agg = _added(star, ["campaign_id", "mnth"], days)
    country = clean.trim_dim("country") if trim_keys else F.col("country")
    tcount = (star.dim_targeting.groupBy("campaign_id", country.alias("country"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    j = (agg.join(tcount, "campaign_id")
         .join(star.dim_campaign.select("campaign_id", "advertiser_id"), "campaign_id")
         .join(star.dim_advertiser.select("advertiser_id", F.col("name").alias("advertiser_name")),
               "advertiser_id"))
    g = j.groupBy("mnth", "advertiser_name", "country").agg(
        F.sum(F.col("cost") * F.col("n_rows")).cast("double").alias("total_spend"))
    return g.where(F.col("mnth").isNotNull() & F.col("country").isNotNull()
                   & F.col("total_spend").isNotNull())


# ---- reads ------------------------------------------------------------------

def read_campaign_ctr(perf: DataFrame) -> DataFrame:
    """Full scan, CTR shown to 4 digits."""
    return perf.select("campaign_name", "total_impressions", "total_clicks",
                       clean.round_to("ctr", 4).alias("ctr"))


def read_top_advertisers(adv: DataFrame, month: str, n: int = 5) -> DataFrame:
    """One month partition, spend desc, limit n."""
    check_period(month)
    return (adv.where(F.col("mnth") == month)
            .orderBy(F.col("total_spend").desc(), F.col("advertiser_name").asc()).limit(n))


def read_user_last_ads(history: DataFrame, users: DataFrame, first_day: str, last_day: str,
                       n: int = 10) -> DataFrame:
    """Per user, the last ``n`` history rows inside a day range."""
    h = history.where(F.col("date_event").between(F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))))
    return keyed_read(h, users, ["user_id"], [F.col("date_event").desc()], n)


def read_top_users(active: DataFrame, month: str, n: int = 10) -> DataFrame:
    """One month, clicks desc, limit n."""
    check_period(month)
    return (active.where(F.col("mnth") == month)
            .orderBy(F.col("total_clicks").desc(), F.col("user_id").asc()).limit(n))


def read_top_advertisers_country(by_region: DataFrame, month: str, country: str,
                                 n: int = 5) -> DataFrame:
    """One (month, country) partition, spend desc, limit n."""
    check_period(month)
    return (by_region.where((F.col("mnth") == month) & (F.col("country") == country))
            .orderBy(F.col("total_spend").desc(), F.col("advertiser_name").asc()).limit(n))


# ---- keyed lookups (L1-L3) ----------------------------------------------------

def campaign_stats(star: Star, days: DataFrame | None = None) -> DataFrame:
    """Per-campaign impressions, clicks and cost (the lookup table of L1)."""
    return _added(star, ["campaign_id"], days).select("campaign_id", "impressions", "clicks", "cost")


def advertiser_spend(star: Star, days: DataFrame | None = None) -> DataFrame:
    """Per-advertiser cost over its campaigns (the lookup table of L2)."""
    return (star.dim_campaign.select("campaign_id", "advertiser_id").join(_added(star, ["campaign_id"], days), "campaign_id", "left")
            .groupBy("advertiser_id").agg(F.sum("cost").alias("cost")))


def user_clicked_slots(star: Star) -> DataFrame:
    """Per-user sorted distinct clicked ad slots (the lookup table of L3);
    the list is bounded by the number of slots."""
    return (star.fact_event.where(F.col("was_clicked")).select("user_id", "ad_slot_id").distinct()
            .groupBy("user_id").agg(F.array_sort(F.collect_list("ad_slot_id")).alias("ads")))


def campaign_lookup(star: Star, keys: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """L1: clicks, impressions, ctr, spend (2 digits) per requested campaign
    id; unknown ids give zeros. Reads ``stats`` (``campaign_stats``, e.g. the
    materialised table) when given, else aggregates the fact per campaign."""
    agg = stats if stats is not None else campaign_stats(star)
    j = keys.select("campaign_id").join(agg, "campaign_id", "left")
    return j.select(
        "campaign_id",
        F.coalesce(F.col("clicks"), F.lit(0)).cast("bigint").alias("clicks"),
        F.coalesce(F.col("impressions"), F.lit(0)).cast("bigint").alias("impressions"),
        clean.safe_ratio("clicks", "impressions", zero_if_null=True).alias("ctr"),
        F.round(F.coalesce(F.col("cost"), F.lit(0)), 2).cast("double").alias("ad_spend"))


def advertiser_lookup(star: Star, keys: DataFrame, spend: DataFrame | None = None) -> DataFrame:
    """L2: total spend (2 digits) per requested advertiser id; 0.0 if unknown."""
    per_adv = spend if spend is not None else advertiser_spend(star)
    j = keys.select("advertiser_id").join(per_adv, "advertiser_id", "left")
    return j.select("advertiser_id",
                    F.round(F.coalesce(F.col("cost"), F.lit(0)), 2).cast("double").alias("total_spend"))


def user_engagement_lookup(star: Star, keys: DataFrame, slots: DataFrame | None = None) -> DataFrame:
    """L3: sorted distinct ad slots each requested user clicked, and their count."""
    per_user = slots if slots is not None else user_clicked_slots(star)
    j = keys.select("user_id").join(per_user, "user_id", "left")
    ads = F.coalesce(F.col("ads"), F.array().cast("array<bigint>"))
    return j.select("user_id", ads.alias("ads_engaged"), F.size(ads).cast("bigint").alias("count"))


# ---- materialised serving tables ----------------------------------------------

def _by_region_trimmed(star: Star, days: DataFrame | None = None) -> DataFrame:
    return advertisers_by_region(star, True, days)


def _days(star: Star) -> DataFrame:
    return campaign_days(star.fact_event)


def _running_days(star: Star, days: DataFrame | None = None) -> DataFrame:
    return running(_days(star) if days is None else days)


# name -> (builder, clustering order, partition columns). Partition columns are
# the low-cardinality partition keys of the source tables (month, country).
AD_TABLES = {
    "campaign_performance": (campaign_performance, [("campaign_name", False)], []),
    "advertisers": (advertisers_by_month, [("total_spend", True), ("advertiser_name", False)], ["mnth"]),
    "user_history": (user_history, [("user_id", False), ("date_event", True)], []),
    "most_active_users": (most_active_users, [("total_clicks", True), ("user_id", False)], ["mnth"]),
    "advertisers_by_regions": (advertisers_by_region, [("total_spend", True), ("advertiser_name", False)],
                               ["mnth", "country"]),
    "advertisers_by_regions_trimmed": (_by_region_trimmed, [("total_spend", True), ("advertiser_name", False)],
                                       ["mnth", "country"]),
    # keyed lookup tables (the source's per-request queries behind a cache)
    "campaign_stats": (campaign_stats, [("campaign_id", False)], []),
    "campaign_days": (_days, [("campaign_id", False), ("day", False)], []),
    "campaign_running": (_running_days, [("campaign_id", False), ("day", False)], []),
    "advertiser_spend": (advertiser_spend, [("advertiser_id", False)], []),
    "user_clicked_slots": (user_clicked_slots, [("user_id", False)], []),
}
_AD_CACHE: dict = {}


def _load_ad_serving_table(spark, sf_dir: str, name: str, rebuild: bool = False) -> DataFrame:
    """One advertising serving table for the test tables, written once per
    input; reads then scan it instead of re-aggregating the fact. Partitioned
    tables are rebalanced by their partition columns (few files each, a hot
    one split) and sorted by their clustering order inside each file; the
    user history is range-partitioned on its primary key."""
    import uuid

    from ..operators.materialize import table_root, write_once
    from ..operators.star import load_star, star_fingerprint

    fp = star_fingerprint(spark, sf_dir)
    ck = (spark.sparkContext.applicationId, fp, name)
    if rebuild or ck not in _AD_CACHE:
        star = load_star(spark, sf_dir)
        build, order, parts = AD_TABLES[name]
        if name == "user_history":
            table = build(star, layout_partitions=int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
            laid = table
        else:
            # all that adds up campaign days starts from the stored aggregate
            stored = "days" in signature(build).parameters
            table = build(star, days=_load_ad_serving_table(spark, sf_dir, "campaign_days")) if stored else build(star)
            dealt = table.hint("rebalance", *[F.col(c) for c in parts]) if parts else table
            laid = dealt.sortWithinPartitions(*parts, *[F.col(c).desc() if d else F.col(c).asc()
                                                        for c, d in order])
        path = table_root(spark, "ad_tables", fp, name) + (f"-{uuid.uuid4().hex[:8]}" if rebuild else "")
        _AD_CACHE[ck] = write_once(spark, path, lambda: laid, partition_by=parts, blooms=[] if parts else [order[0][0]],
                                   schema=table.schema).select(*table.columns)
    return _AD_CACHE[ck]



def load_ad_serving_table(spark, sf_dir: str, name: str, rebuild: bool = False) -> DataFrame:
    """See ``_load_ad_serving_table``; one build at a time per process."""
    with BUILD_LOCK:
        return _load_ad_serving_table(spark, sf_dir, name, rebuild)