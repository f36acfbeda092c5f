"""Upsert (U1), per-key top-N, dense ids, parameter rules."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.operators.dense_id import with_dense_id
from adlens.operators.topn import check_limit, check_period, keyed_read, top_n_per
from adlens.operators.upsert import merge_upsert, upsert, write_merged


def test_upsert_same_key_in_one_batch(spark):
    df = spark.createDataFrame([("u", "d1", "a", 1), ("u", "d1", "b", 2), ("v", "d1", "c", 1)],
                               "user string, day string, ad string, seq int")
    got = sorted(tuple(r) for r in upsert(df, ["user", "day"], ["seq"]).collect())
    assert got == [("u", "d1", "b", 2), ("v", "d1", "c", 1)]


def test_merge_second_batch_wins(spark):
    old = spark.createDataFrame([("u", "d1", "a", 9), ("w", "d1", "x", 1)], "user string, day string, ad string, seq int")
    new = spark.createDataFrame([("u", "d1", "b", 1)], "user string, day string, ad string, seq int")
    got = sorted(tuple(r) for r in merge_upsert(old, new, ["user", "day"], ["seq"]).collect())
    assert got == [("u", "d1", "b", 1), ("w", "d1", "x", 1)]


def test_count_in_key_leaves_stale_rows(spark, tmp_dir):
    # PK (period, count, product): a rerun with a new count adds a row beside the old one
    run1 = spark.createDataFrame([("2024-01", 3, "P1")], "period_ym string, review_count int, product_id string")
    run2 = spark.createDataFrame([("2024-01", 4, "P1")], "period_ym string, review_count int, product_id string")
    key = ["period_ym", "review_count", "product_id"]
    p1 = write_merged(spark, "", run1, key, [], f"{tmp_dir}/v1")
    p2 = write_merged(spark, f"{tmp_dir}/v1", run2, key, [], f"{tmp_dir}/v2")
    assert p1.count() == 1 and p2.count() == 2


def test_top_n_ties_and_keyed_read(spark):
    df = spark.createDataFrame([("p", 3, "a"), ("p", 3, "b"), ("p", 2, "c"), ("q", 1, "d")],
                               "period_ym string, n int, k string")
    got = sorted(tuple(r) for r in top_n_per(df, ["period_ym"], [F.col("n").desc(), F.col("k")], 1).collect())
    assert got == [("p", 3, "a"), ("q", 1, "d")]
    keys = spark.createDataFrame([("p",), ("absent",)], "period_ym string")
    got = keyed_read(df, keys, ["period_ym"], [F.col("n").desc(), F.col("k")], 2).collect()
    assert sorted(r.k for r in got) == ["a", "b"]


def test_parameter_rules():
    assert check_period("2005-09") == "2005-09"
    for bad in ("2005-9", "200509", "2005-09-01", None):
        with pytest.raises(ValueError):
            check_period(bad)
    assert check_limit(1) == 1 and check_limit(1000) == 1000
    for bad in (0, 1001, -1):
        with pytest.raises(ValueError):
            check_limit(bad)


def test_dense_ids_equal_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("name")).distinct()
    ids = with_dense_id(df, ["name"], "id", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("name")))
    got = ids.join(ref, "name")
    assert got.count() == df.count()
    assert got.where(F.col("id") != F.col("rn")).count() == 0


def test_dense_ids_of_few_rows_take_the_same_way(spark):
    df = spark.range(0, 300).select((F.col("id") * 31 % 301).cast("string").alias("name"))
    ids = with_dense_id(df, ["name"], "id")
    rows = ids.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 301)) and [r.name for r in rows] == sorted(r.name for r in rows)
    assert "SinglePartition" not in ids._sc._jvm.PythonSQLUtils.explainString(ids._jdf.queryExecution(), "simple")
    assert with_dense_id(df.limit(0), ["name"], "id").count() == 0


def test_keyed_read_without_limit_gives_whole_keys(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    keys = spark.createDataFrame([(1,), (9,)], "k bigint")
    assert keyed_read(df, keys, ["k"], [F.col("v").desc()]).count() == 2500
    assert keyed_read(df, keys, ["k"], [F.col("v").desc()], 10).count() == 10


def test_quota_sample_exact(spark):
    from adlens.operators import sampling
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("g"))
    brute = top_n_per(df.withColumn("stratum", F.col("g")).withColumn("_h", sampling.seeded_order("k", 7)),
                      ["stratum"], [F.col("_h"), F.col("k")], 300).drop("_h")
    want = set(map(tuple, brute.collect()))
    got = sampling.stratified_quota(df, "g", 300, "k", 7, "stratum").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_partitioned_merge_only_touches_batch_partitions(spark, tmp_dir):
    old = spark.createDataFrame([("2024-01", "u", 1, "a"), ("2024-02", "u", 1, "b"), ("2024-02", "v", 1, "c")],
                                "mnth string, user string, seq int, val string")
    write_merged(spark, "", old, ["mnth", "user"], ["seq"], f"{tmp_dir}/v1", partition_by=["mnth"])
    new = spark.createDataFrame([("2024-02", "u", 2, "B"), ("2024-03", "w", 1, "d")],
                                "mnth string, user string, seq int, val string")
    out = write_merged(spark, f"{tmp_dir}/v1", new, ["mnth", "user"], ["seq"], f"{tmp_dir}/v2", partition_by=["mnth"])
    got = sorted((r.mnth, r.user, r.val) for r in out.collect())
    assert got == [("2024-01", "u", "a"), ("2024-02", "u", "B"), ("2024-02", "v", "c"), ("2024-03", "w", "d")]


def test_approximate_quota_sample(spark):
    from adlens.operators import sampling
    df = spark.range(0, 50000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("g"))
    got = {r.stratum: r.n_rows for r in sampling.stratum_distribution(
        sampling.stratified_fraction(df, "g", 2000, 3), "stratum").collect()}
    assert set(got) == {0, 1} and all(1700 < v < 2300 for v in got.values())


def test_case_insensitive_star_keeps_the_fact_count(spark):
    from adlens.operators.star import build_star
    from adlens.sources.fixtures import ad_staging
    exact = ad_staging(spark, "/root/testdata/sf0.001")
    odd = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    mixed = exact.withColumns({c: F.when(odd, F.upper(c)).otherwise(F.translate(c, "ae", "áè")) for c in ("advertiser_name", "campaign_name", "interest")})
    one, two = build_star(exact), build_star(mixed, collation="UNICODE_CI_AI")
    assert two.fact_event.count() == one.fact_event.count()
    assert two.dim_campaign.count() == one.dim_campaign.count() and two.dim_advertiser.count() == one.dim_advertiser.count()


def test_fingerprint_sees_a_changed_file_in_a_folder(spark, tmp_dir):
    import os
    from adlens.operators.materialize import input_fingerprint
    os.makedirs(f"{tmp_dir}/t/part=1")
    path = f"{tmp_dir}/t/part=1/f.csv"
    with open(path, "w") as f:
        f.write("a")
    times = os.stat(f"{tmp_dir}/t")
    before = input_fingerprint(spark, [f"{tmp_dir}/t"])
    with open(path, "w") as f:
        f.write("bb")
    os.utime(f"{tmp_dir}/t", (times.st_atime, times.st_mtime))
    assert input_fingerprint(spark, [f"{tmp_dir}/t"]) != before


def test_merge_partitions_replaces_only_touched(spark, tmp_dir):
    import os

    from adlens.operators.upsert import merge_partitions
    schema = "day string, k int, v string, seq int"
    path = f"{tmp_dir}/table"

    def load(rows):
        return merge_partitions(spark, path, spark.createDataFrame(rows, schema), ["day", "k"], ["seq"], ["day"])

    def files(day):
        return sorted(f for f in os.listdir(f"{path}/day={day}") if f.endswith(".parquet"))

    load([("2024-01", 1, "a", 1), ("2024-01", 1, "b", 2), ("2024-02", 1, "c", 1), ("2024-02", 9, "stays", 1)])
    before = files("2024-01")
    batch = [("2024-02", 1, "d", 0), ("2024-02", 2, "e", 0), ("2024-03", 1, "f", 0)]
    want = sorted([("2024-01", 1, "b", 2), ("2024-02", 9, "stays", 1), *batch])
    for _ in range(2):      # the same batch again changes nothing
        got = load(batch).select("day", "k", "v", "seq")
        assert sorted(map(tuple, got.collect())) == want
        assert files("2024-01") == before
    assert len(files("2024-02")) == 1


def _rows_scanned(df):
    """Rows that the file scan handed on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_unknown_keys_skip_row_groups(spark, tmp_dir):
    from adlens.operators.materialize import write_once
    from adlens.operators.topn import keyed_read, named_in_scan, short_keys
    # keys in no order: a row group's least and greatest key say nothing
    table = spark.range(0, 400_000, 2, 1).selectExpr("sha1(CAST(id AS STRING)) AS k", "id AS v").repartition(2, "v")
    with_bloom = write_once(spark, f"{tmp_dir}/a", lambda: table, blooms=["k"])
    without = write_once(spark, f"{tmp_dir}/b", lambda: table)
    unknown = spark.range(1, 20, 2).selectExpr("sha1(CAST(id AS STRING)) AS k")
    assert _rows_scanned(named_in_scan(with_bloom, ["k"], short_keys(unknown, ["k"]))) == 0
    assert _rows_scanned(named_in_scan(without, ["k"], short_keys(unknown, ["k"]))) == 200_000
    some = unknown.unionByName(spark.range(0, 6, 2).selectExpr("sha1(CAST(id AS STRING)) AS k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    for t in (with_bloom, without):
        got = keyed_read(t, some, ["k"], [F.col("v")], 5)
        assert sorted(r.v for r in got.collect()) == [0, 2, 4]
    many = spark.range(0, 1000).selectExpr("sha1(CAST(id AS STRING)) AS k")
    assert keyed_read(with_bloom, many, ["k"], [F.col("v")], 5).count() == 500
    assert keyed_read(with_bloom, many.limit(0), ["k"], [F.col("v")]).count() == 0
    two = spark.createDataFrame([(some.first().k, 1), (table.where("v = 4").first().k, 4)], "k string, v long")
    assert [r.v for r in keyed_read(with_bloom, two, ["k", "v"], [F.col("v")], 5).collect()] == [4]


def test_limits_bite_per_key(spark):
    from adlens.operators.topn import keyed_read
    table = spark.range(0, 1000).selectExpr("id % 3 AS k", "id AS v")
    keys = spark.createDataFrame([(0,), (2,), (9,)], "k long")
    got = keyed_read(table, keys, ["k"], [F.col("v").desc()], 4).collect()
    assert sorted((r.k, r.v) for r in got) == [(0, v) for v in (990, 993, 996, 999)] + [(2, v) for v in (989, 992, 995, 998)]
