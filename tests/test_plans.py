"""Physical-plan checks: top-k operators, pushdown, no Python in any plan."""

import pytest

from __spark_entry__ import queries


def plan(df):
    """The text ``df.explain("formatted")`` prints."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return {k: f for k, f in queries().items() if f.__module__.startswith("adlens.plans")}


def test_top_k_is_take_ordered(spark, qs):
    p = plan(qs["rpt_top5_campaigns_ctr_30d"](spark, "/root/testdata/sf0.001"))
    assert "TakeOrderedAndProject" in p


def test_window_group_limit(spark, qs):
    df = qs["read_top_items"](spark, "/root/testdata/sf0.001")
    assert "WindowGroupLimit" in plan(df)


def test_date_window_pushed_to_scan(spark, qs):
    df = qs["rpt_top5_campaigns_ctr_30d"](spark, "/root/testdata/sf0.001")
    p = plan(df)
    assert "GreaterThanOrEqual(timestamp,2024-01-05T00:00), LessThan(timestamp,2024-01-21T00:00)" in p


def test_no_python_udf_anywhere(spark, qs):
    for name, fn in qs.items():
        if name in ("report_bundle",):
            continue
        p = plan(fn(spark, "/root/testdata/sf0.001"))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in p, (name, marker)


def test_fact_scan_prunes_columns(spark, qs):
    p = plan(qs["rpt_top10_clicking_users"](spark, "/root/testdata/sf0.001"))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert schemas == ["ReadSchema: struct<user_id:string,was_clicked:boolean>"]
