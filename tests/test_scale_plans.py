"""Plan shapes that keep the jobs safe at scale."""

import re

from pyspark.sql import functions as F

from adlens.operators.star import fact_event, load_star
from adlens.operators.topn import keyed_read
from adlens.plans import documents, reports

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_many_keys_read_limits_before_any_shuffle(spark):
    table = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    keys = spark.range(0, 7).select(F.col("id").alias("k")).repartition(3)
    p = plan(keyed_read(table, keys, ["k"], [F.col("v").desc()], 3), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the first exchange on the table side
    lines = p.splitlines()
    partial = max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exch = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line]
    assert any(i < partial for i in exch)


def test_reports_aggregate_the_fact_before_joining(spark):
    star = load_star(spark, SF)
    p = plan(reports.revenue_by_country(star), "simple")
    # the fact scan feeds a partial aggregate, never a join directly
    fact_scan = [i for i, line in enumerate(p.splitlines()) if "FileScan" in line and "ad_revenue" in line]
    lines = p.splitlines()
    assert fact_scan
    for i in fact_scan:
        above = "\n".join(lines[max(0, i - 4):i])
        assert "HashAggregate" in above and "partial_sum" in above


def test_small_dimensions_are_broadcast_into_the_fact(spark):
    star = load_star(spark, SF)
    p = plan(fact_event(star.staging, star.dim_campaign, star.dim_targeting, star.dim_ad_slot), "simple")
    assert p.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in p


def test_documents_are_counted_without_repeating_events(spark):
    """Sums over documents group events per campaign and weight them; no event
    row is exploded, and events are grouped before any join."""
    e = documents.load_engagement(spark, SF)
    for df in (documents.clicks_per_hour(e, "Brand#13", None), documents.ad_fatigue(e), documents.user_summaries(e)):
        p = plan(df, "simple")
        assert "Generate" not in p and ("partial_count" in p or "partial_sum" in p)
        # the events meet the campaigns after a count
        lines = p.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and ("was_clicked" in line or "session_date" in line))
        assert any("HashAggregate" in line and "partial_" in line for line in lines[max(0, scan - 4):scan])
    # the one array taken apart is a campaign's targeting, read with the cards
    p = plan(documents.top_categories(e))
    taken = [part for part in re.split(r"\n\n(?=\(\d+\) )", p) if part.split("\n", 1)[0].endswith(") Generate")]
    assert len(taken) == 1 and "targets" in taken[0]


def test_window_report_reads_no_fact(spark):
    from adlens.plans.catalog import REGISTRY
    p = plan(REGISTRY["rpt_top5_campaigns_ctr_window"](spark, SF))
    assert "fact_event" not in p and "campaign_running" in p and "LessThanOrEqual(day,2024-01-20)" in p
