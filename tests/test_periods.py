"""Day aggregates merged batch by batch, and period tables refreshed from them."""

import datetime as dt
import os

from pyspark.sql import functions as F

from adlens.operators.star import load_star
from adlens.plans import periods, serving

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def several_months(spark):
    """The star with its events spread over four months."""
    star = load_star(spark, SF)
    n = F.expr("CAST(substring(event_id, 4) AS INT)")
    star = type(star)(**{**star.__dict__, "fact_event": star.fact_event.withColumn(
        "timestamp", F.expr("timestamp + make_interval(0, CAST(substring(event_id, 4) AS INT) % 4)"))})
    return star, n


def test_batches_equal_one_build(spark, tmp_dir):
    star, n = several_months(spark)
    cols = ["campaign_id", "day", *periods.SUMS]
    for batch in range(3):
        delta = periods.campaign_days(star.fact_event.where(n % 3 == batch))
        for _ in range(2):                                   # every batch comes twice
            days = periods.merge_days(spark, f"{tmp_dir}/days", delta, batch)
    assert rows(days, *cols) == rows(periods.campaign_days(star.fact_event), *cols)


def test_half_merged_batch_is_finished(spark, tmp_dir):
    """A batch whose first try replaced some days only adds to the others."""
    schema = "campaign_id long, day date, impressions long, clicks long, cost decimal(20,4), click_cost decimal(20,4), revenue decimal(20,4)"

    def delta(*found):
        return spark.createDataFrame([(c, dt.date(2024, 1, d), k, 0, None, None, None) for c, d, k in found], schema)

    periods.merge_days(spark, tmp_dir + "/t", delta((1, 1, 10), (1, 2, 10), (2, 2, 5)), 0)
    periods.merge_days(spark, tmp_dir + "/t", delta((1, 1, 1)), 1)               # the lost try reached one day
    before = sorted(os.listdir(f"{tmp_dir}/t/day=2024-01-01"))
    got = periods.merge_days(spark, tmp_dir + "/t", delta((1, 1, 1), (1, 2, 1), (3, 3, 1)), 1)
    assert rows(got, "campaign_id", F.dayofmonth("day"), "impressions") == [(1, 1, 11), (1, 2, 11), (2, 2, 5), (3, 3, 1)]
    assert sorted(os.listdir(f"{tmp_dir}/t/day=2024-01-01")) == before


def test_refreshed_months_replace_what_changed(spark, tmp_dir):
    star, n = several_months(spark)
    fact = star.fact_event
    first = fact.where((n % 2 == 0) & (F.month("timestamp") < 4))
    second = fact.join(first.select("event_id"), "event_id", "left_anti").where(F.month("timestamp") >= 2)
    for batch, part in enumerate((first, second)):
        delta = periods.campaign_days(part)
        days = periods.merge_days(spark, f"{tmp_dir}/days", delta, batch)
        if batch:
            january = sorted(os.listdir(f"{tmp_dir}/adv/mnth=2024-01"))
        table = periods.refresh_periods(spark, f"{tmp_dir}/adv", days, delta, star)
    whole = type(star)(**{**star.__dict__, "fact_event": first.unionByName(second)})
    cols = ["mnth", "advertiser_name", "total_spend"]
    assert rows(table, *cols) == rows(serving.advertisers_by_month(whole), *cols)
    assert table.select("mnth").distinct().count() >= 4
    assert sorted(os.listdir(f"{tmp_dir}/adv/mnth=2024-01")) == january         # not touched, not written


def test_month_tables_over_several_months(spark):
    star, _ = several_months(spark)
    adv = serving.advertisers_by_month(star).cache()
    for month in ("2024-02", "2024-03"):
        want = sorted((r for r in adv.collect() if r.mnth == month), key=lambda r: (-r.total_spend, r.advertiser_name))[:5]
        assert serving.read_top_advertisers(adv, month, 5).collect() == want and len(want) == 5
    active = serving.most_active_users(star)
    assert {r.mnth for r in serving.read_top_users(active, "2024-03", 3).collect()} == {"2024-03"}
    adv.unpersist()
