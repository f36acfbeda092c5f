"""Sources and sinks: CSV round trip keeps blanks, report bundle, minute compaction."""

import os

import pytest
from pyspark.sql import functions as F

from adlens.sources import io
from adlens.streaming import messages as msg


def test_csv_round_trip_keeps_leading_blanks_and_nulls(spark, tmp_dir):
    df = spark.createDataFrame([(" Germany", None, "a,b"), ("", "x", 'q"uote')], "a string, b string, c string")
    io.write_csv(df, f"{tmp_dir}/t")
    back = io.read_csv(spark, f"{tmp_dir}/t", "a string, b string, c string")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_csv_is_split_and_quoted_line_breaks_are_an_option(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/big")
    with open(f"{tmp_dir}/big/a.csv", "w") as f:
        f.write("a,b\n" + "".join(f"{i},{'x' * 50}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = io.read_csv(spark, f"{tmp_dir}/big", "a int, b string")
        assert df.rdd.getNumPartitions() > 4 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write('a,b\n1,"two\nlines"\n')
    got = io.read_csv(spark, f"{tmp_dir}/t.csv", "a int, b string", multiLine="true").collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines")]


def test_reviews_csv_has_fifteen_columns_and_its_header_is_checked(spark, tmp_dir):
    names = [c.split()[0] for c in io.REVIEWS_SCHEMA_FULL.split(", ")]
    with open(f"{tmp_dir}/r.csv", "w") as f:
        f.write(",".join(names) + "\nUS,7,R1,P1,3,Title,Books,5,1,2,0,1,Head,Body,2015-01-02\n")
    r = io.read_reviews_csv(spark, f"{tmp_dir}/r.csv").first()
    assert (r.customer_id, r.review_id, r.star_rating, r.review_date) == (7, "R1", 5, "2015-01-02")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_reviews_csv(spark, f"{tmp_dir}/r.csv", schema=io.REVIEWS_SCHEMA).collect()


def test_report_bundle_records_errors_and_empties(spark, tmp_dir):
    ok = spark.createDataFrame([(1, "x")], "n int, s string")
    empty = spark.createDataFrame([], "n int")
    bad = spark.createDataFrame([("x",)], "s string").select(F.col("s").cast("int").alias("n"))  # fails under ANSI
    status = io.write_report_bundle({"Task 1: ok!": ok, "task2": empty, "task3": bad}, tmp_dir)
    assert status["Task 1: ok!"] == "written" and status["task2"] == "empty"
    assert status["task3"].startswith("error")
    assert os.path.isdir(os.path.join(tmp_dir, "task_1_ok_"))
    assert not os.path.exists(os.path.join(tmp_dir, "task2"))
    rows = spark.read.json(os.path.join(tmp_dir, "full_report")).collect()
    assert [(r.report, r.row_json) for r in rows] == [("Task 1: ok!", '{"n":1,"s":"x"}')]


def test_replace_load_counts(spark, tmp_dir):
    a = spark.range(5).select(F.col("id").cast("string").alias("x"))
    b = spark.range(3).select(F.col("id").cast("string").alias("y"))
    got = {r.table_name: r.n_rows for r in io.replace_load(spark, {"a": a, "b": b},
                                                            tmp_dir).collect()}
    assert got == {"a": 5, "b": 3}
    got = {r.table_name: r.n_rows for r in io.replace_load(spark, {"a": b.withColumnRenamed("y", "x")},
                                                            tmp_dir).collect()}
    assert got == {"a": 3}  # replaced, not appended
    assert io.read_csv(spark, f"{tmp_dir}/a", "x string").count() == 3


AWKWARD = ["two\nlines", "a\r\nb\r", "back\\slash \\n \\s", 'q"uo"te', ' , "x', "\0nul\0", "", " ", "\n", "\\", "ends in \\", None, "plain", "é\u2028\x85"]


def test_texts_survive_one_record_a_line(spark, tmp_dir):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(AWKWARD)], "id int, a string, b string").repartition(3)
    io.write_csv(df, f"{tmp_dir}/t")
    back = io.read_csv(spark, f"{tmp_dir}/t", "id int, a string, b string", escaped=True)
    assert [r.a for r in back.orderBy("id").collect()] == AWKWARD and [r.b for r in back.orderBy("id").collect()] == AWKWARD
    lines = sum(open(os.path.join(tmp_dir, "t", f), newline="").read().count("\n") for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".csv"))
    assert lines == len(AWKWARD) + 3 and io.replace_load(spark, {"x": df}, tmp_dir).first().n_rows == len(AWKWARD)


def test_rejects_are_whole_and_nothing_is_lost(spark, tmp_dir):
    raw = spark.createDataFrame([(str(i), "7" if i % 3 else "n/a", t) for i, t in enumerate(AWKWARD)], "id string, n string, t string")
    io.write_csv(raw, f"{tmp_dir}/t")
    rows, rejects = io.read_with_rejects(spark, f"{tmp_dir}/t", "id int, n int, t string", escaped=True)
    assert {r.id: (r.n, r.t) for r in rows.collect()} == {i: (7, t) for i, t in enumerate(AWKWARD) if i % 3}
    assert {r.id: (r.n, r.t) for r in rejects.collect()} == {str(i): ("n/a", t) for i, t in enumerate(AWKWARD) if not i % 3}
    assert rows.count() + rejects.count() == len(AWKWARD)       # whatever columns are read
    with open(f"{tmp_dir}/short.csv", "w") as f:
        f.write("id,n,t\n1,2\n3,4,x,y\n5,6,z\n")
    rows, rejects = io.read_with_rejects(spark, f"{tmp_dir}/short.csv", "id int, n int, t string")
    assert [tuple(r) for r in rows.collect()] == [(5, 6, "z")]
    assert sorted(r._record for r in rejects.collect()) == ["1,2", "3,4,x,y"]


def test_documents_written_are_counted(spark, tmp_dir):
    docs = spark.range(7).select("id", F.array(F.lit("x")).alias("a"))
    assert io.write_documents(docs, f"{tmp_dir}/c") == 7
    assert io.write_documents(docs.limit(2), f"{tmp_dir}/c", mode="append") == 2
    assert io.write_documents(docs.limit(0), f"{tmp_dir}/none") == 0
    assert io.read_documents(spark, f"{tmp_dir}/c", docs.schema).count() == 9


def test_one_of_two_builders_wins(spark, tmp_dir):
    from adlens.operators.materialize import _commit, write_once
    path = f"{tmp_dir}/shared/t"
    one = write_once(spark, path, lambda: spark.range(3))
    spark.range(5).write.parquet(f"{path}.late")
    _commit(spark, f"{path}.late", path)                     # another application comes second
    assert one.count() == 3 and write_once(spark, path, lambda: spark.range(9)).count() == 3
    assert os.listdir(f"{tmp_dir}/shared") == ["t"]
    os.remove(f"{path}/_SUCCESS")                            # a lost job's half copy
    assert write_once(spark, path, lambda: spark.range(4)).count() == 4


def test_compact_minutes_one_file_per_minute(spark, tmp_dir):
    rows = spark.createDataFrame([("1", "2024-01-01T10:00:01+00:00", "a"), ("2", "2024-01-01T10:00:02+00:00", "b"),
                                  ("3", "2024-01-01T10:01:02+00:00", "c")], "author_id string, created_at string, text string")
    b = msg.minute_buckets(rows)
    for i in range(3):  # three micro-batches worth of small files
        b.repartition(2).write.mode("append").partitionBy("minute").option("header", True).csv(f"{tmp_dir}/in")
    msg.compact_minutes(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    for m in ("minute=01_01_2024_10_00", "minute=01_01_2024_10_01"):
        files = [f for f in os.listdir(f"{tmp_dir}/out/{m}") if f.endswith(".csv")]
        assert len(files) == 1
    assert spark.read.option("header", True).csv(f"{tmp_dir}/out").count() == 9


def test_compact_splits_a_busy_minute(spark, tmp_dir):
    rows = spark.range(0, 1000).select(F.col("id").cast("string").alias("author_id"),
                                       F.lit("2024-01-01T10:00:01+00:00").alias("created_at"),
                                       F.col("id").cast("string").alias("text"))
    msg.minute_buckets(rows).write.partitionBy("minute").option("header", True).csv(f"{tmp_dir}/in")
    msg.compact_minutes(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", rows_per_file=300)
    files = [f for f in os.listdir(f"{tmp_dir}/out/minute=01_01_2024_10_00") if f.endswith(".csv")]
    assert 2 <= len(files) <= 4   # 4 salts, hashed over the shuffle partitions
    assert spark.read.option("header", True).csv(f"{tmp_dir}/out").count() == 1000


def test_written_documents_are_packed(spark, tmp_dir):
    docs = spark.createDataFrame([(i, [("text " * 20 + str(i), 1.5)] * 200) for i in range(5)],
                                 "id int, parts array<struct<t: string, x: double>>").coalesce(1)
    assert io.write_documents(docs, f"{tmp_dir}/d", "json", "append") == 5
    assert io.write_documents(docs, f"{tmp_dir}/d", "json", "append") == 5
    files = [f for f in os.listdir(f"{tmp_dir}/d") if f.startswith("part-")]
    assert len(files) == 2 and all(f.endswith(".json.gz") for f in files)
    assert sum(os.path.getsize(f"{tmp_dir}/d/{f}") for f in files) < 20_000       # 1.1 MB as text
    back = io.read_documents(spark, f"{tmp_dir}/d", docs.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.union(docs).collect()))


def test_texts_without_line_breaks_are_left_as_they_are(spark):
    from adlens.functions import clean
    texts = ["plain", "", None, "\\", "a\nb", "a\rb", "a\0b", "\\n", "\\\\s", "\n\r\0\\"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select(clean.one_record("t").alias("one"), clean.whole_text(clean.one_record("t")).alias("whole"))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "Contains" in plan                             # looked at before they are rewritten
    rows = both.collect()
    assert [r.whole for r in rows] == texts
    assert not [r.one for r in rows if r.one and set(r.one) & set("\n\r\0")]
