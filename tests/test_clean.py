"""Edge rules of the cleaning functions (FIXTURES.md §B4)."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from adlens.functions import clean


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_parse_clicked(spark):
    vals = ["1", "TRUE", "true", "True", "0", "yes", None]
    assert col_values(spark, vals, clean.parse_clicked("v")) == [True, True, True, False, False, False, False]
    assert col_values(spark, vals, clean.parse_clicked("v", case_insensitive=True)) == [
        True, True, True, True, False, False, False]


def test_zero_date_and_bad_dates(spark):
    vals = ["0000-00-00 00:00:00", "2024-02-30 00:00:00", None, "2024-01-05 10:11:12"]
    got = col_values(spark, vals, clean.null_if_zero_date("v"))
    assert got == [None, None, None, dt.datetime(2024, 1, 5, 10, 11, 12)]


def test_parse_date_or_null(spark):
    got = col_values(spark, ["2024-01-05", "n/a", None, "garbage"], clean.parse_date_or_null("v"))
    assert got == [dt.date(2024, 1, 5), None, None, None]


def test_split_list(spark):
    assert col_values(spark, ["a,b", "", None], clean.split_list("v")) == [["a", "b"], [""], []]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (None, 5), (3, 4)], "a int, b int")
    assert [r[0] for r in df.select(clean.safe_ratio("a", "b")).collect()] == [None, None, None, 0.75]
    assert [r[0] for r in df.select(clean.safe_ratio("a", "b", zero_if_null=True)).collect()] == [0.0, 0.0, 0.0, 0.75]


def test_uuid5_matches_python(spark):
    names = ["user_0", "user_465518", "ad_3", "msg_12", "ünïcode"]
    got = col_values(spark, names, clean.uuid5_from_name("v"))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_minute_key_keeps_own_offset(spark):
    vals = ["2025-08-12T11:41:00.660081+00:00", "2025-08-12T11:41:59+05:30", "2025-08-12T23:59:59Z",
            "garbage", ""]
    got = col_values(spark, vals, clean.minute_key("v"))
    assert got == ["12_08_2025_11_41", "12_08_2025_11_41", "12_08_2025_23_59", None, None]


def test_truncate_text_counts_code_points(spark):
    s = "é" * 100 + "😀" * 200
    got = col_values(spark, [s, None], clean.truncate_text("v", 240))
    assert got == [s[:240], ""]


def test_int_or_zero(spark):
    assert col_values(spark, ["", None, "12", "x"], clean.int_or_zero("v")) == [0, 0, 12, None]


def test_one_line_strips_like_python(spark):
    vals = ["  a\nb  ", " x　", None, "\n\n", "\tq\x1c"]
    assert col_values(spark, vals, clean.one_line("v")) == [v.replace("\n", " ").strip() if v else "" for v in vals]



def test_between_days_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 20, 23, 59, 59),), (dt.datetime(2024, 1, 21, 0, 0),),
                                (dt.datetime(2024, 1, 5, 0, 0),), (dt.datetime(2024, 1, 4, 23, 59),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(clean.between_days("ts", "2024-01-05", "2024-01-20")).collect()]
    assert got == [True, False, True, False]


def test_ci_key_join(spark):
    a = spark.createDataFrame([("CAMPAIGN_1",), ("campaign_2",)], "x string")
    b = spark.createDataFrame([("Campaign_1",), ("Campaign_2",)], "y string")
    n = a.join(b, clean.ci_key(F.col("x")) == clean.ci_key(F.col("y"))).count()
    assert n == 2


def test_coerce_day_and_now(spark):
    df = spark.createDataFrame([("2024-01-05 10:11:12",), ("garbage",)], "v string")
    got = df.select(clean.coerce_ts("v").isNull().alias("bad"), clean.day_of(clean.coerce_ts("v")).alias("d")).collect()
    assert [r.bad for r in got] == [False, True] and got[0].d == dt.date(2024, 1, 5)
    stamp = spark.range(1).select(clean.now_iso().alias("t")).first().t
    assert len(stamp) == 32 and stamp.endswith("+00:00") and stamp[10] == "T"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = spark.range(1).select(clean.now_iso().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(dt.datetime.fromisoformat(stamp) - dt.datetime.now(dt.timezone.utc)) < dt.timedelta(minutes=5)


def test_period_keys_and_jdbc_arguments(spark):
    import pytest
    from adlens.plans.reviews import period_keys
    from adlens.sources.tables import read_jdbc
    assert [r.period_ym for r in period_keys(spark, "2005-09", "2024-01").collect()] == ["2005-09", "2024-01"]
    with pytest.raises(ValueError):
        period_keys(spark, "2005-9")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", table="t", query="select 1")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x")
