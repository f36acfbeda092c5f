"""Per-user session documents and the queries over them (N1-N8), kept flat.

The source joins targeting on the campaign only, so a user's document repeats
every event once per targeting row of its campaign (about 24 times). Stored
here is what that repetition is made from: one row per event
(``interactions``), and one row per campaign with its targeting rows and their
number (``cards``). Sums over a document's interactions are sums over events
times that number: they are grouped per campaign first, then weighted, and
nothing is repeated. Nested documents are assembled on request, for the users
or sessions asked for; a session (one user's day on one device) is the largest
row that a whole collection is written as.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.materialize import BUILD_LOCK, table_root, write_once
from ..operators.star import Star
from ..operators.topn import top_n_per

SESSION = ["user_id", "session_date", "device"]
EVENT = ["event_id", "timestamp", "ad_slot_id", "campaign_id", "bid_amount", "ad_cost", "ad_revenue", "was_clicked", "click_timestamp"]
CARD = ["campaign_id", "campaign_name", "advertiser_name", "start_date", "end_date", "budget", "remaining_budget"]


@dataclass
class Engagement:
    """``interactions``: one row per event of a known user and device (user_id,
    location, session_date, device and the event's own fields). ``cards``: one
    row per campaign (``CARD``), ``targets`` (its targeting rows, sorted; one
    of NULLs if it has none) and ``n_targets``. ``users``: profiles, or None."""
    interactions: DataFrame
    cards: DataFrame
    users: DataFrame | None = None


def interactions_of(star: Star) -> DataFrame:
    f, u = star.fact_event, star.dim_user.select("user_id", "device", "location")
    rows = f.where(F.col("user_id").isNotNull()).join(u, "user_id").where(F.col("device").isNotNull())
    return rows.select(
        "user_id", "location", F.to_date("timestamp").alias("session_date"), "device", "event_id", "timestamp", "ad_slot_id",
        "campaign_id", *[F.col(c).cast("double").alias(c) for c in ("bid_amount", "ad_cost", "ad_revenue")],
        clean.clicked_from_ts("click_timestamp").alias("was_clicked"), "click_timestamp")


def cards_of(star: Star) -> DataFrame:
    """One row per campaign; its targeting rows are those of a dimension, not
    of its events."""
    target = F.struct("criteria", "interest", "country")
    none = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("criteria", "interest", "country")]))
    targets = star.dim_targeting.groupBy("campaign_id").agg(F.array_sort(F.collect_list(target)).alias("targets"))
    c = (star.dim_campaign.withColumnRenamed("name", "campaign_name")
         .join(star.dim_advertiser.withColumnRenamed("name", "advertiser_name"), "advertiser_id", "left")
         .join(targets, "campaign_id", "left").withColumn("targets", F.coalesce("targets", none)))
    return c.select("campaign_id", "campaign_name", "advertiser_name",
                    *[F.col(x).cast("timestamp_ntz").alias(x) for x in ("start_date", "end_date")],
                    *[F.col(x).cast("double").alias(x) for x in ("budget", "remaining_budget")],
                    "targets", F.size("targets").cast("bigint").alias("n_targets"))


def engagement(star: Star) -> Engagement:
    return Engagement(interactions_of(star), cards_of(star), star.users)


def from_documents(docs: DataFrame) -> Engagement:
    """The flat form of nested documents (a collection read back)."""
    s = docs.select("user_id", "location", F.explode("sessions").alias("s"))
    i = s.select("user_id", "location", "s.device", F.explode("s.ad_interactions").alias("i"))
    flat = i.select("user_id", "location", "device", "i.*").select("*", "campaign.*").drop("campaign")
    events = flat.drop("targeting", *CARD[1:]).dropDuplicates(["event_id", "campaign_id"]).withColumn("session_date", F.to_date("timestamp"))
    # every event of a campaign carries all its targeting rows
    of_event = flat.groupBy(*CARD, "event_id").agg(F.array_sort(F.collect_list("targeting")).alias("targets"))
    cards = of_event.groupBy(*CARD).agg(F.min("targets").alias("targets")).withColumn("n_targets", F.size("targets").cast("bigint"))
    return Engagement(events, cards, docs.select("user_id", "age", "gender", F.array_join("interests", ",").alias("interests")))


def load_engagement(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Engagement:
    """The flat tables of the test tables, materialised once per input. One
    range shuffle on (user, event) lays them out, so that reads by user skip
    row groups and a hot user spreads over several files."""
    import uuid

    from ..operators.star import load_star, star_fingerprint
    with BUILD_LOCK:
        star = load_star(spark, sf_dir)
        root = table_root(spark, "engagement", star_fingerprint(spark, sf_dir)) + (f"-{uuid.uuid4().hex[:8]}" if rebuild else "")
        e = engagement(star)
        by = ["user_id", "event_id"]
        rows = write_once(spark, f"{root}/interactions", lambda: e.interactions.repartitionByRange(*by).sortWithinPartitions(*by))
        return Engagement(rows, write_once(spark, f"{root}/cards", lambda: e.cards), e.users)


def session_id() -> Column:
    return F.concat_ws("_", "user_id", "device", F.date_format("session_date", "yyyy-MM-dd")).alias("session_id")


def sessionize(e: Engagement) -> DataFrame:
    """One row per (user, day, device) with its start, interactions and
    clicks: events are counted per campaign, then weighted."""
    per = e.interactions.groupBy(*SESSION, "campaign_id").agg(
        F.min("timestamp").alias("start_time"), F.count(F.lit(1)).alias("n"), F.count_if("was_clicked").alias("clicked"))
    return (per.join(e.cards.select("campaign_id", "n_targets"), "campaign_id").groupBy(*SESSION).agg(
        F.min("start_time").alias("start_time"), F.sum(F.col("n") * F.col("n_targets")).alias("n_interactions"),
        F.sum(F.col("clicked") * F.col("n_targets")).alias("clicks")).withColumn("session_id", session_id()))


def user_summaries(e: Engagement) -> DataFrame:
    """Sessions, interactions and first session start of every user's document."""
    return sessionize(e).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("n_interactions").alias("n_interactions"),
                                                F.min("start_time").alias("first_start"))


def profiled(rows: DataFrame, users: DataFrame | None) -> DataFrame:
    """N1 profile fields (age, gender, interests) of each row's ``user_id``;
    the source's defaults (NULL, '', ['']) for users without a profile."""
    if users is None:
        known = rows.withColumns({c: F.lit(None).cast(t) for c, t in (("age", "int"), ("gender", "string"), ("interests", "string"))})
    else:
        known = rows.join(users.select("user_id", F.col("age").cast("int").alias("age"), "gender", "interests"), "user_id", "left")
    return known.withColumns({"gender": F.coalesce("gender", F.lit("")),
                              "interests": clean.split_list(F.coalesce("interests", F.lit("")))})


def interactions_nested(e: Column) -> Column:
    """The array of an event's interactions, one per targeting row of its
    campaign, with the source's nesting."""
    return F.transform(e["targets"], lambda t: F.struct(
        e["event_id"].alias("event_id"), e["timestamp"].alias("timestamp"), e["ad_slot_id"].alias("ad_slot_id"),
        F.struct(*[e[c].alias(c) for c in CARD], t.alias("targeting")).alias("campaign"),
        *[e[c].alias(c) for c in ("bid_amount", "ad_cost", "ad_revenue", "was_clicked", "click_timestamp")]))


def session_documents(e: Engagement, sessions: DataFrame | None = None) -> DataFrame:
    """One row per session, with all its interactions in the order of their
    event ids; only ``sessions`` (user_id, session_date, device), if given.
    Events are grouped unrepeated; repetition is the last projection."""
    rows = e.interactions if sessions is None else e.interactions.join(sessions.select(*SESSION).distinct(), SESSION, "left_semi")
    event = F.struct(*EVENT, *CARD[1:], "targets")
    grouped = rows.join(e.cards, "campaign_id").groupBy(*SESSION, "location").agg(
        F.min("timestamp").alias("start_time"), F.array_sort(F.collect_list(event)).alias("events"))
    return grouped.select("user_id", "location", "session_date", session_id(), "device", "start_time",
                          F.flatten(F.transform("events", interactions_nested)).alias("ad_interactions"))


def user_documents(e: Engagement, keys: DataFrame) -> DataFrame:
    """Whole documents of the requested users (``user_id``): profile,
    location, sessions by day and device, each with its interactions. A
    document is one row by definition, so ask for users, not for all."""
    wanted = keys.select("user_id").distinct()
    some = Engagement(e.interactions.join(wanted, "user_id", "left_semi"), e.cards, e.users)
    session = F.struct("session_date", "device", "session_id", "start_time", "ad_interactions")
    docs = session_documents(some).groupBy("user_id", "location").agg(F.array_sort(F.collect_list(session)).alias("s"))
    sessions = F.transform("s", lambda x: F.struct(*[x[c].alias(c) for c in ("session_id", "device", "start_time", "ad_interactions")]))
    return profiled(docs, e.users).select("user_id", "age", "gender", F.coalesce("location", F.lit("")).alias("location"),
                                          "interests", sessions.alias("sessions"))


def last_sessions(e: Engagement, n: int = 5) -> DataFrame:
    """Per user the ``n`` latest sessions with their click counts, one row
    per session. The per-user limit is a ``WindowGroupLimit``."""
    return top_n_per(sessionize(e), ["user_id"], [F.col("start_time").desc(), F.col("session_id")], n).select(
        "user_id", "session_id", "session_date", "device", "start_time", "clicks", "n_interactions")


def last_sessions_whole(e: Engagement, n: int = 5) -> DataFrame:
    """N4 as the source returns it: the ``n`` latest sessions of every user,
    whole, with ``clicks`` added."""
    latest = last_sessions(e, n)
    return session_documents(e, latest).join(latest.select(*SESSION, "clicks"), SESSION).select(
        "user_id", "session_id", "device", "start_time", "ad_interactions", "clicks")


def unwound(e: Engagement) -> DataFrame:
    """N8 ``$unwind`` twice: one row per interaction. The repetition is the
    result here; it is made after the join, in the last projection."""
    return e.interactions.join(e.cards, "campaign_id").select("user_id", "location", "session_date", *EVENT, *CARD[1:], "device",
                                                              F.inline("targets"))


def clicks_per_hour(e: Engagement, advertiser: str, hour: int | None = 0) -> DataFrame:
    """Clicked interactions of one advertiser (name trimmed) per (hour,
    campaign); ``hour=None`` keeps all 24 hours."""
    h = clean.hour_of("click_timestamp")
    clicked = e.interactions.where(F.col("was_clicked") if hour is None else F.col("was_clicked") & (h == hour))
    per = clicked.groupBy(h.alias("hour"), "campaign_id").agg(F.count(F.lit(1)).alias("n"))
    mine = e.cards.where(F.col("advertiser_name") == advertiser.strip()).select("campaign_id", F.col("campaign_name").alias("campaign"), "n_targets")
    return (per.join(mine, "campaign_id").groupBy("hour", "campaign").agg(F.sum(F.col("n") * F.col("n_targets")).alias("clicks"))
            .orderBy("hour", "campaign"))


def ad_fatigue(e: Engagement, min_views: int = 4) -> DataFrame:
    """Per user, the ad slots shown at least ``min_views`` times without a click."""
    per = e.interactions.where(~F.col("was_clicked")).groupBy("user_id", "ad_slot_id", "campaign_id").agg(F.count(F.lit(1)).alias("n"))
    tired = (per.join(e.cards.select("campaign_id", "n_targets"), "campaign_id").groupBy("user_id", "ad_slot_id")
             .agg(F.sum(F.col("n") * F.col("n_targets")).alias("views")).where(F.col("views") >= min_views))
    return tired.groupBy("user_id").agg(F.array_sort(F.collect_list("ad_slot_id")).alias("ad_fatigue_ads"))


def top_categories(e: Engagement, n: int = 3, keys: DataFrame | None = None) -> DataFrame:
    """Per user (all, or those of ``keys``) the ``n`` targeting interests
    with the most clicks (trimmed; ties by name): clicks per campaign times the
    campaign's targeting rows of an interest."""
    clicked = e.interactions.where("was_clicked")
    if keys is not None:
        clicked = clicked.join(keys.select("user_id").distinct(), "user_id", "left_semi")
    per = clicked.groupBy("user_id", "campaign_id").agg(F.count(F.lit(1)).alias("n"))
    # of the campaigns' own rows: one per targeting row of the dimension
    interests = (e.cards.select("campaign_id", F.inline("targets")).groupBy("campaign_id", clean.trim_dim("interest").alias("category"))
                 .agg(F.count(F.lit(1)).alias("times")))
    g = per.join(interests, "campaign_id").groupBy("user_id", "category").agg(F.sum(F.col("n") * F.col("times")).alias("clicks"))
    return top_n_per(g, ["user_id"], [F.col("clicks").desc(), F.col("category").asc()], n)


def leaves(docs: DataFrame) -> DataFrame:
    """Every leaf of nested documents, one row per interaction."""
    s = docs.select("user_id", "age", "gender", "location", F.array_join("interests", ",").alias("interests"), F.explode("sessions").alias("s"))
    i = s.select("user_id", "age", "gender", "location", "interests", "s.session_id", "s.device", "s.start_time",
                 F.explode("s.ad_interactions").alias("i"))
    return i.select(*[c for c in i.columns if c != "i"], *[f"i.{c}" for c in EVENT if c != "campaign_id"],
                    *[f"i.campaign.{c}" for c in CARD], "i.campaign.targeting.*")


def targeted_interests(star: Star) -> DataFrame:
    """user_id, interests: the trimmed interests a user's events targeted, as
    sorted comma text (the shape of the users CSV)."""
    seen = star.fact_event.select("user_id", "targeting_id").distinct().join(star.dim_targeting.select("targeting_id", "interest"), "targeting_id")
    g = seen.groupBy("user_id").agg(F.array_sort(F.collect_set(clean.trim_dim("interest"))).alias("i"))
    return g.select("user_id", F.array_join("i", ",").alias("interests"))
