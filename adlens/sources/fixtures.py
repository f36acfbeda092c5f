"""Stand-in inputs built from the driver's test tables.

``ad_staging``, ``campaigns`` and ``users`` stand in for the three CSVs of the
advertising data, ``reviews`` for the product-reviews CSV and ``tweets`` for the
raw rows of the review message stream. The mapping rules are those of
FIXTURES.md §B, and these, so that each side of a join has rows without a
partner: the campaigns are all parts (half of which no event names), those from
LATE_PARTS on in each PART_CYCLE belong to an advertiser without events, the
events of one user in LOST_USERS name a campaign that no file has, and one
customer in NO_PROFILE is missing from the users. Each is one set of joins that
Spark plans like any other query (the small region/nation side is broadcast by
size, the rest shuffles on its keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dense_id import with_dense_id
from .tables import read_table

# Fixed values of the stand-in mapping (FIXTURES.md §B1-§B3).
CAMPAIGN_START = "2024-01-01"
CAMPAIGN_END = "2024-02-29"
SLOT_SIZES = ("300x250", "728x90", "160x600", "320x50")   # by event_id % 4
DEVICES = ("Mobile", "Desktop", "Tablet")                  # by event_id % 3
PART_CYCLE, LATE_PARTS, LATE_ADVERTISER = 200, 190, "House Ads"
LOST_USERS, LOST_CAMPAIGN = 10, "Campaign_lost"
NO_PROFILE = 13
CLICK_TEXT = {"click": "TRUE", "purchase": "1", "view": "false"}  # else '0'


def _pick(index: F.Column, values: tuple[str, ...]) -> F.Column:
    expr = None
    for i, v in enumerate(values[:-1]):
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr.otherwise(values[-1])


def campaign_key(events: DataFrame) -> F.Column:
    """The campaign (part) key carried in the event's JSON ``props``."""
    return F.get_json_object(events["props"], "$.k").try_cast("int")


def ad_staging(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """B1: one wide staging row per event (stands in for stg_ad_events).
    ``events`` replaces the events table (e.g. a replicated copy for scaling runs)."""
    e = read_table(spark, sf_dir, "events") if events is None else events
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # customer -> nation -> region first: a customer-sized side, then one join
    # with the events on the user key (AQE splits a hot user's partition).
    geo = (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_mktsegment", "n_name", "r_name"))
    ev = e.select("event_id", "ts", "user_id", "event_type", "value",
                  campaign_key(e).alias("k"))
    j = (ev.join(p, ev.k == p.p_partkey)
           .join(geo, ev.user_id == geo.c_custkey))

    budget = _budget()
    clicked = F.col("event_type").isin("click", "purchase")
    was_clicked = (F.when(F.col("event_type") == "click", CLICK_TEXT["click"])
                   .when(F.col("event_type") == "purchase", CLICK_TEXT["purchase"])
                   .when(F.col("event_type") == "view", CLICK_TEXT["view"])
                   .otherwise("0"))
    return j.select(
        F.concat(F.lit("ev_"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("p_brand").alias("advertiser_name"),
        F.when(F.col("user_id") % LOST_USERS == LOST_USERS - 1, LOST_CAMPAIGN)
         .otherwise(F.concat(F.lit("Campaign_"), F.col("p_partkey").cast("string"))).alias("campaign_name"),
        F.lit(CAMPAIGN_START).cast("date").alias("campaign_start_date"),
        F.lit(CAMPAIGN_END).cast("date").alias("campaign_end_date"),
        budget.alias("budget"),
        budget.alias("remaining_budget"),
        F.col("p_type").alias("criteria"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("interest"),
        F.concat(F.lit(" "), F.col("r_name")).alias("country"),
        _pick((F.col("event_id") % 4).cast("int"), SLOT_SIZES).alias("ad_slot_size"),
        F.col("user_id").cast("string").alias("user_id"),
        _pick((F.col("event_id") % 3).cast("int"), DEVICES).alias("device"),
        F.col("n_name").alias("location"),
        F.col("ts").alias("event_ts"),
        (F.col("value") / 20).cast("decimal(10,4)").alias("bid_amount"),
        (F.col("value") / 10).cast("decimal(10,4)").alias("ad_cost"),
        was_clicked.alias("was_clicked"),
        F.when(clicked, F.date_format(F.col("ts") + F.expr("interval 1 minute"), "yyyy-MM-dd HH:mm:ss"))
         .otherwise("0000-00-00 00:00:00").alias("click_timestamp"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0))
         .cast("decimal(10,4)").alias("ad_revenue"),
    )


def _budget() -> F.Column:
    return (F.col("p_retailprice") * (F.col("p_partkey") % 9 + 1) / 5).cast("decimal(12,2)")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per campaign (stands in for the campaigns CSV), named by events
    or not."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    return p.select(
        F.col("p_partkey").cast("string").alias("campaign_id"),
        F.when(F.col("p_partkey") % PART_CYCLE >= LATE_PARTS, LATE_ADVERTISER).otherwise(F.col("p_brand")).alias("advertiser_name"),
        F.concat(F.lit("Campaign_"), F.col("p_partkey").cast("string")).alias("campaign_name"),
        F.lit(CAMPAIGN_START).cast("date").alias("campaign_start_date"),
        F.lit(CAMPAIGN_END).cast("date").alias("campaign_end_date"),
        F.col("p_type").alias("criteria"),
        _pick((F.col("p_partkey") % 4).cast("int"), SLOT_SIZES).alias("ad_slot_size"),
        _budget().alias("budget"), _budget().alias("remaining_budget"))


def respelt(events: DataFrame, campaigns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two inputs with names spelt in several ways that differ in case or
    accents alone."""
    n = F.expr("CAST(substring(event_id, 4) AS BIGINT)")
    odd = events.withColumns({
        "campaign_name": F.when(n % 3 == 0, F.upper("campaign_name")).when(n % 3 == 1, F.translate("campaign_name", "a", "\u00e1"))
                          .otherwise(F.col("campaign_name")),
        "interest": F.when(n % 2 == 0, F.lower("interest")).otherwise(F.col("interest")),
        "country": F.when(n % 5 == 0, F.translate("country", "E", "\u00c9")).otherwise(F.col("country")),
        "ad_slot_size": F.when(n % 2 == 1, F.upper("ad_slot_size")).otherwise(F.col("ad_slot_size"))})
    return odd, campaigns.withColumn("campaign_name", F.when(F.col("campaign_id").cast("int") % 4 == 0, F.lower("campaign_name"))
                                     .otherwise(F.col("campaign_name")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user (stands in for the users CSV), with events or not."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (c.where(key % NO_PROFILE != 0).join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.cast("string").alias("user_id"),
        F.when(key % 11 != 0, 18 + key % 60).cast("int").alias("age"),
        F.when(key % 3 == 0, "F").when(key % 3 == 1, "M").alias("gender"),
        F.col("n_name").alias("location"),
        F.when(key % 7 != 0, F.concat_ws(",", "c_mktsegment", F.concat(F.lit(" "), "n_name"))).alias("interests"),
        F.date_add(F.lit(CAMPAIGN_START).cast("date"), (-(key % 365)).cast("int")).alias("signup_date")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one raw review row per line item (stands in for the reviews CSV)."""
    l = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("review_id"),
        F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.when(F.col("l_partkey") % 53 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("l_quantity").cast("int") % 5 + 1).cast("int")).alias("star_rating"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("verified_purchase"),
        F.col("l_returnflag").alias("review_headline"),
        F.concat(F.lit("body of "), F.col("l_orderkey").cast("string")).alias("review_body"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("n/a"))
         .otherwise(F.date_format(F.col("l_shipdate"), "yyyy-MM-dd")).alias("review_date"),
    )


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review-stream rows before JSON encoding, one per event; texts
    are dealt out in turn."""
    e = read_table(spark, sf_dir, "events")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    turns = with_dense_id(d.select("doc_id"), ["doc_id"], "turn")        # ids may have gaps
    # the events take up their document's id before they meet its text, so that
    # the texts are shuffled once at every size: rows of a document come out
    # side by side, neither side is broadcast for what its file weighs
    told = e.join(turns.hint("merge"), e.event_id % F.lit(max(1, turns.count())) + 1 == turns.turn)
    j = told.join(d.hint("merge"), "doc_id")
    return j.select(
        F.col("event_id").cast("string").alias("message_key"),
        F.col("user_id"),
        F.col("text").alias("review_body"),
        F.concat(F.lit("P"), F.lpad(F.get_json_object(F.col("props"), "$.k"), 9, "0")).alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("rating"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
    )
