"""KPI reports over the star schema.

The source writes each report as ``dim LEFT JOIN fact GROUP BY dim-attr``.
Here the fact is aggregated per join key first (map-side partial
aggregation, one row per key leaves each task), then joined to the
dimension and re-aggregated on the report key. Counts and decimal sums are
additive, so the results are identical, but the large side never shuffles
raw rows and a hot campaign or user costs one partial row per task.

Money is summed as ``decimal`` (exact, order-free) and exposed as ``double``
only after the last aggregation; ratios divide doubles and round half-up.
Every top-k carries a full tie-break on the natural key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.star import Star
from .periods import window


def _clicks() -> Column:
    return F.count_if(F.col("was_clicked"))


def fact_by(fact: DataFrame, keys: list[str], window: tuple[str, str] | None = None,
            only_clicked: bool = False) -> DataFrame:
    """Per-key partial aggregate of the fact: impressions, clicks, cost, revenue."""
    f = fact
    if window is not None:
        f = f.where(clean.between_days("timestamp", *window))
    if only_clicked:
        f = f.where(F.col("was_clicked"))
    return f.groupBy(*keys).agg(
        F.count("event_id").alias("impressions"),
        _clicks().alias("clicks"),
        F.sum("ad_cost").alias("cost"),
        F.sum("ad_revenue").alias("revenue"),
    )


def _ctr(clicks: Column, impressions: Column, digits: int) -> Column:
    return clean.round_to(clean.safe_ratio(clicks, impressions), digits)


def top_campaigns_ctr(star: Star, first_day: str, last_day: str, n: int = 5, days: DataFrame | None = None) -> DataFrame:
    """Per campaign name, impressions/clicks/CTR inside the day window; from
    the running day aggregate (``periods.running``), if given, without the fact."""
    agg = fact_by(star.fact_event, ["campaign_id"], (first_day, last_day)) if days is None else window(days, first_day, last_day)
    j = star.dim_campaign.select("campaign_id", "name").join(agg, "campaign_id", "left")
    g = j.groupBy("name").agg(F.coalesce(F.sum("impressions"), F.lit(0)).alias("total_impressions"),
                              F.sum("clicks").alias("clicks"))
    return (g.select("name", "total_impressions",
                     F.coalesce(F.col("clicks"), F.lit(0)).cast("bigint").alias("total_clicks"),
                     _ctr(F.col("clicks"), F.col("total_impressions"), 5).alias("ctr"))
            .orderBy(F.col("ctr").desc_nulls_last(), F.col("name").asc_nulls_first()).limit(n))


def top_advertisers_spend(star: Star, first_day: str, last_day: str, n: int = 10, days: DataFrame | None = None) -> DataFrame:
    """R2: per advertiser, engagement and spend inside the day window; ``days``
    as in ``top_campaigns_ctr``."""
    agg = fact_by(star.fact_event, ["campaign_id"], (first_day, last_day)) if days is None else window(days, first_day, last_day)
    j = (star.dim_campaign.select("campaign_id", "advertiser_id").join(agg, "campaign_id", "left")
         .join(star.dim_advertiser, "advertiser_id", "left"))
    g = j.groupBy("name").agg(F.coalesce(F.sum("impressions"), F.lit(0)).alias("total_impressions"),
                              F.sum("clicks").alias("clicks"), F.sum("cost").alias("cost"))
    return (g.select("name", "total_impressions",
                     F.coalesce(F.col("clicks"), F.lit(0)).cast("bigint").alias("total_clicks"),
                     _ctr(F.col("clicks"), F.col("total_impressions"), 5).alias("ctr"),
                     F.coalesce(F.col("cost"), F.lit(0)).cast("double").alias("total_spending"))
            .orderBy(F.col("total_spending").desc_nulls_last(), F.col("name").asc_nulls_first()).limit(n))


def cpc_cpm(star: Star) -> DataFrame:
    """Per campaign, cost per click and cost per thousand impressions."""
    agg = fact_by(star.fact_event, ["campaign_id"])
    j = agg.join(star.dim_campaign.select("campaign_id", "name"), "campaign_id", "left")
    g = j.groupBy("name").agg(F.sum("impressions").alias("total_impressions"),
                              F.sum("clicks").alias("total_clicks"), F.sum("cost").alias("cost"))
    cost = F.col("cost").cast("double")
    return g.select(
        "name", "total_impressions", F.col("total_clicks").cast("bigint").alias("total_clicks"),
        clean.round_to(clean.safe_ratio(cost, F.col("total_clicks")), 2).alias("cpc"),
        clean.round_to(clean.safe_ratio(cost, F.col("total_impressions")) * 1000, 2).alias("cpm"))


def revenue_by_country(star: Star, exact: bool = False) -> DataFrame:
    """Revenue per targeting country.

    As in the source, targeting joins the fact on the campaign only, so an
    event counts once per targeting row of its campaign. That fan-out is
    applied to per-campaign sums (one row per targeting row), never to raw
    events. ``exact=True`` joins on ``targeting_id`` (each event once).
    """
    t = star.dim_targeting
    if exact:
        agg = fact_by(star.fact_event, ["targeting_id"])
        j = t.select("targeting_id", "country").join(agg, "targeting_id", "left")
    else:
        agg = fact_by(star.fact_event, ["campaign_id"])
        j = t.select("campaign_id", "country").join(agg, "campaign_id", "left")
    return (j.groupBy("country").agg(F.sum("revenue").cast("double").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("country").asc_nulls_first()))


def user_revenue_top(star: Star, n: int = 20) -> DataFrame:
    """Users (with location, device) ranked by revenue; users without
    events count 0."""
    agg = fact_by(star.fact_event, ["user_id"])
    j = star.dim_user.join(agg, "user_id", "left")
    g = j.groupBy("user_id", "location", "device").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("total_revenue"))
    return g.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("user_id").asc_nulls_first()).limit(n)


def budget_over(star: Star, threshold: float = 0.8, n: int = 10) -> DataFrame:
    """Campaigns that spent at least ``threshold`` of their budget."""
    agg = fact_by(star.fact_event, ["campaign_id"]).select(
        "campaign_id", F.coalesce(F.col("cost"), F.lit(0)).alias("total_cost"))
    j = star.dim_campaign.join(agg, "campaign_id", "left")
    ratio = clean.safe_ratio(F.col("total_cost"), F.col("budget"))
    return (j.where(ratio >= threshold)
            .select("name", F.col("budget").cast("double").alias("budget"),
                    F.col("total_cost").cast("double").alias("total_cost"),
                    clean.round_to(ratio * 100, 1).alias("pct_spent"), "campaign_id")
            .orderBy(F.col("pct_spent").desc_nulls_last(), F.col("name").asc_nulls_first(),
                     F.col("campaign_id"))
            .limit(n).drop("campaign_id"))


def ctr_by_device(star: Star) -> DataFrame:
    """CTR per user device; users with no events add 0 impressions."""
    agg = fact_by(star.fact_event, ["user_id"])
    j = star.dim_user.join(agg, "user_id", "left")
    g = j.groupBy("device").agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impr"))
    return (g.select("device", _ctr(F.col("clicks"), F.col("impr"), 4).alias("ctr"))
            .orderBy(F.col("ctr").desc_nulls_last(), F.col("device").asc_nulls_first()))


def most_clicking_users(star: Star, n: int = 10) -> DataFrame:
    """Users with the most clicked events."""
    g = (star.fact_event.where(F.col("was_clicked")).groupBy("user_id")
         .agg(F.count(F.lit(1)).alias("total_clicks")))
    return g.orderBy(F.col("total_clicks").desc(), F.col("user_id").asc()).limit(n)


def click_revenue_by_location(star: Star, n: int | None = None) -> DataFrame:
    """Revenue of clicked events per user location."""
    agg = fact_by(star.fact_event, ["user_id"], only_clicked=True)
    j = agg.join(star.dim_user.select("user_id", "location"), "user_id", "left")
    out = (j.groupBy("location").agg(F.sum("revenue").cast("double").alias("click_revenue"))
           .orderBy(F.col("click_revenue").desc_nulls_last(), F.col("location").asc_nulls_first()))
    return out.limit(n) if n else out
