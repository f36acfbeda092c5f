"""The source's closed golden set for user 309169: the stored document
(query 1) is the input, the last-sessions (query 2) and top-categories
(query 5) outputs are checked. Values typed in from those outputs."""

import datetime as dt

from pyspark.sql import functions as F

from adlens.plans import documents as docs

DOC_SCHEMA = (
    "user_id string, age int, gender string, location string, interests array<string>, "
    "sessions array<struct<session_id string, device string, start_time timestamp_ntz, "
    "ad_interactions array<struct<event_id string, timestamp timestamp_ntz, ad_slot_id bigint, "
    "campaign struct<campaign_id bigint, campaign_name string, advertiser_name string, "
    "start_date timestamp_ntz, end_date timestamp_ntz, budget double, remaining_budget double, "
    "targeting struct<criteria string, interest string, country string>>, bid_amount double, "
    "ad_cost double, ad_revenue double, was_clicked boolean, click_timestamp timestamp_ntz>>>>")


def _ia(eid, ts, cid, cname, adv, start, end, budget, crit, interest, country, bid, cost, rev, click):
    return (eid, ts, 3, (cid, cname, adv, start, end, budget, budget, (crit, interest, country)),
            bid, cost, rev, True, click)


def golden_doc(spark):
    d = dt.datetime
    s1 = ("309169_Tablet_2024-12-03", "Tablet", d(2024, 12, 3, 8, 59, 14), [_ia(
        "29454569-e7ae-4352-81da-9abc8b58ff58", d(2024, 12, 3, 8, 59, 14), 150, "Campaign_150", "Advertiser_16",
        d(2024, 10, 9), d(2024, 12, 4), 455423.07, "Age 29-47", " Finance", " Australia", 3.4, 3.15, 8.17,
        d(2024, 12, 3, 9, 0, 1))])
    s2 = ("309169_Tablet_2024-12-05", "Tablet", d(2024, 12, 5, 19, 14, 20), [_ia(
        "6de8eee2-f9a3-4604-b297-9f887c0245c6", d(2024, 12, 5, 19, 14, 20), 172, "Campaign_172", "Advertiser_18",
        d(2024, 10, 24), d(2024, 12, 15), 448330.01, "Age 27-40", " Health", " USA", 0.56, 0.43, 2.36,
        d(2024, 12, 5, 19, 19))])
    return spark.createDataFrame([("309169", None, "", "UK", [""], [s1, s2])], DOC_SCHEMA)


def golden(spark):
    return docs.from_documents(golden_doc(spark))


def test_last_sessions_golden(spark):
    want = [("309169_Tablet_2024-12-05", 1), ("309169_Tablet_2024-12-03", 1)]
    got = docs.last_sessions(golden(spark), 5)
    assert [tuple(r) for r in got.orderBy(F.desc("start_time")).select("session_id", "clicks").collect()] == want
    whole = docs.last_sessions_whole(golden(spark), 5).orderBy(F.desc("start_time")).collect()
    assert [(r.session_id, r.clicks) for r in whole] == want
    assert whole[0].ad_interactions == golden_doc(spark).first().sessions[1].ad_interactions
    assert [r.session_id for r in docs.last_sessions_whole(golden(spark), 1).collect()] == ["309169_Tablet_2024-12-05"]


def test_document_golden(spark):
    keys = spark.createDataFrame([("309169",), ("309169",), ("nobody",)], "user_id string")
    assert docs.user_documents(golden(spark), keys).collect() == golden_doc(spark).collect()


def test_top_categories_golden(spark):
    got = {(r.category, r.clicks) for r in docs.top_categories(golden(spark), 3).collect()}
    assert got == {("Health", 1), ("Finance", 1)}


def test_clicks_per_hour_and_fatigue_shapes(spark):
    e = golden(spark)
    assert docs.clicks_per_hour(e, " Advertiser_18 ", None).collect()[0].asDict() == {
        "hour": 19, "campaign": "Campaign_172", "clicks": 1}
    assert docs.clicks_per_hour(e, "Advertiser_18", 0).count() == 0
    assert docs.ad_fatigue(e, 1).count() == 0  # every interaction was clicked


def test_flat_and_nested_hold_the_same(spark):
    """Nested documents of all users, flattened again, give every answer of the
    flat tables that they were assembled from."""
    e = docs.load_engagement(spark, "/root/testdata/sf0.001")
    nested = docs.user_documents(e, e.interactions.select("user_id")).cache()
    back = docs.from_documents(nested)

    def same(query):
        a, b = (sorted(map(tuple, query(x).collect()), key=repr) for x in (e, back))
        assert a and a == b

    for query in (docs.user_summaries, docs.last_sessions, docs.ad_fatigue, docs.top_categories,
                  lambda x: docs.clicks_per_hour(x, "Brand#13", None), lambda x: docs.unwound(x).select(*sorted(docs.unwound(e).columns))):
        same(query)
    s = nested.select(F.explode("sessions").alias("s")).select(F.col("s.ad_interactions.event_id").alias("ids")).collect()
    assert all(r.ids == sorted(r.ids) for r in s)
    assert nested.count() == e.interactions.select("user_id").distinct().count()
    # profiles come from the users input, with the source's defaults where there is none
    known = {r.user_id: r for r in e.users.collect()}
    for r in nested.select("user_id", "age", "gender", "interests").collect():
        u = known.get(r.user_id)
        assert (r.age, r.gender) == ((u.age, u.gender or "") if u else (None, ""))
        assert r.interests == ((u.interests if u and u.interests else "").split(","))
    nested.unpersist()


def test_report_shapes_match_golden_headers(spark):
    """Column names and order of the source's golden report CSVs."""
    from adlens.operators.star import load_star
    from adlens.plans import reports
    star = load_star(spark, "/root/testdata/sf0.001")
    golden = {
        "task1": (reports.top_campaigns_ctr(star, "2024-01-05", "2024-01-20"),
                  ["name", "total_impressions", "total_clicks", "ctr"]),
        "task2": (reports.top_advertisers_spend(star, "2024-01-05", "2024-01-20"),
                  ["name", "total_impressions", "total_clicks", "ctr", "total_spending"]),
        "task4": (reports.revenue_by_country(star), ["country", "total_revenue"]),
        "task5": (reports.user_revenue_top(star), ["user_id", "location", "device", "total_revenue"]),
        "task6": (reports.budget_over(star), ["name", "budget", "total_cost", "pct_spent"]),
        "task7": (reports.ctr_by_device(star), ["device", "ctr"]),
    }
    for name, (df, cols) in golden.items():
        assert df.columns == cols, name
    assert reports.top_campaigns_ctr(star, "2024-01-05", "2024-01-20").count() == 5
    assert reports.top_advertisers_spend(star, "2024-01-05", "2024-01-20").count() == 10
