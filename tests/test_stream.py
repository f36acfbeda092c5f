"""Message stream: bad payloads, minute files, late rows, restart."""

import json
import os

from pyspark.sql import functions as F

from adlens.streaming import messages as msg


BAD = ["", "not json", "{}", "[1]", "0", "null", "5",
       json.dumps({"user_id": False, "created_at": "2024-01-01T00:00:00+00:00", "text": "x"}),
       json.dumps({"user_id": 0.0, "created_at": "2024-01-01T00:00:00+00:00", "text": "x"}),
       json.dumps({"user_id": [], "created_at": "2024-01-01T00:00:00+00:00", "text": "x"}),
       json.dumps({"user_id": 3, "created_at": 1700000000, "text": "x"}),
       json.dumps({"user_id": 3, "created_at": "2024-01-01T00:00:00+00:00", "text": 42}),
       json.dumps({"user_id": 0, "created_at": "2024-01-01T00:00:00+00:00", "text": "x"}),
       json.dumps({"user_id": 5, "text": "no time"}),
       json.dumps({"user_id": 5, "created_at": "2024-01-01T00:00:00+00:00", "text": " \n  "})]
GOOD = [json.dumps({"user_id": 7, "created_at": "2024-01-01T10:00:01+05:30", "text": "a\nb "}),
        json.dumps({"user_id": "8", "created_at": "2024-01-01T10:00:02Z", "text": "c"}),
        json.dumps({"user_id": 9, "created_at": "garbage", "text": "d"}),
        json.dumps({"user_id": "0", "created_at": "2024-01-01T10:00:03+00:00", "text": "e"}),
        json.dumps({"user_id": True, "created_at": "2024-01-01T10:00:04+00:00", "text": "f"})]


def test_clean_messages_drops_bad_payloads(spark):
    df = spark.createDataFrame([(v,) for v in BAD + GOOD], "value string")
    got = sorted(tuple(r) for r in msg.clean_messages(df).collect())
    assert got == [("0", "2024-01-01T10:00:03+00:00", "e"), ("7", "2024-01-01T10:00:01+05:30", "a b"),
                   ("8", "2024-01-01T10:00:02Z", "c"), ("9", "garbage", "d"),
                   ("True", "2024-01-01T10:00:04+00:00", "f")]
    good, rejects = msg.split_rejects(msg.minute_buckets(msg.clean_messages(df)))
    assert sorted(r.minute for r in good.collect()) == ["01_01_2024_10_00"] * 4
    assert [r.created_at for r in rejects.collect()] == ["garbage"]


def test_repeated_key_keeps_the_last_value(spark):
    t = '"created_at": "2024-01-01T10:00:0%d+00:00", "text": "%s"}'
    rows = ['{"user_id": 1, "user_id": 2, ' + t % (1, "a"),
            ' {"text": "x", "user_id": 0, "user_id": "3", ' + t % (2, "b"),
            '{"user_id": 5, "user_id": 0, ' + t % (3, "last is falsy"),
            '{"user_id": 6, "user_id": 7, ' + t % (4, "tail") + " tail",
            '{"user_id": 6, "user_id": 7, ' + t % (5, "two") + ', {"user_id": 1}',
            '{"user_id": 6, "user_id": 7, "created_at": "2024',
            '[{"user_id": 6, "user_id": 7, ' + t % (6, "list") + "]"]
    df = spark.createDataFrame([(v,) for v in rows], "value string")
    assert sorted(tuple(r) for r in msg.clean_messages(df).collect()) == [
        ("2", "2024-01-01T10:00:01+00:00", "a"), ("3", "2024-01-01T10:00:02+00:00", "b")]


def _write_topic_file(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for off, v in rows:
            f.write(json.dumps({"offset": off, "key": str(off), "value": v}) + "\n")


def _m(uid, ts, text):
    return json.dumps({"user_id": uid, "created_at": ts, "text": text})


def test_minute_files_restart_and_late_rows(spark, tmp_dir):
    topic, out, ckpt, rej = (os.path.join(tmp_dir, d) for d in ("topic", "out", "ckpt", "rejects"))
    _write_topic_file(topic, "b1.json", [
        (0, _m(1, "2024-01-01T10:00:01+00:00", "one")),
        (1, _m(2, "2024-01-01T10:01:05+00:00", "two")),
        (2, _m(3, "bad time", "three"))])

    def run():
        stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic)))
        for q in msg.write_minute_files(stream, out, ckpt, rejects_dir=rej):
            q.awaitTermination()

    run()
    run()  # restart with nothing new: nothing is written twice
    first = spark.read.option("header", True).csv(out)
    assert first.count() == 2
    # a late row for the closed 10:00 minute, plus a new minute
    _write_topic_file(topic, "b2.json", [
        (3, _m(4, "2024-01-01T10:00:59+00:00", "late")),
        (4, _m(5, "2024-01-01T10:02:00+00:00", "new"))])
    run()
    files = spark.read.option("header", True).csv(out)
    per_minute = {r.minute: r.n for r in files.groupBy("minute").agg(F.count("*").alias("n")).collect()}
    assert per_minute == {"01_01_2024_10_00": 2, "01_01_2024_10_01": 1, "01_01_2024_10_02": 1}
    assert spark.read.json(rej).count() == 1
    # the stream output equals its batch twin over the same topic
    batch = msg.split_rejects(msg.minute_buckets(msg.clean_messages(msg.read_topic(spark, topic))))[0]
    cols = ["author_id", "created_at", "text", "minute"]
    assert sorted(map(tuple, files.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_messages_round_trip(spark):
    rows = spark.createDataFrame(
        [("1", 0, "x" * 300, "P1", 3, "2024-01-01T00:00:00.000000+00:00"),
         ("2", 7, None, "P2", None, "2024-01-01T00:00:01.000000+00:00")],
        "message_key string, user_id bigint, review_body string, product_id string, rating int, created_at string")
    parsed = {r.user_id: r for r in msg.parse_messages(msg.to_messages(rows)).collect()}
    cut = msg.parse_messages(msg.to_messages(rows, text_limit=240)).where("user_id = 0").first()
    assert cut.text == "x" * 240 and parsed[0].text == "x" * 300 and parsed[7].text == "" and parsed[7].rating == 0
    again = {r.user_id: r.id for r in msg.parse_messages(msg.to_messages(rows)).collect()}
    assert again == {k: v.id for k, v in parsed.items()}  # replayable ids


def test_minute_counts_stream_matches_batch(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "topic")
    _write_topic_file(topic, "b1.json", [
        (i, _m(i + 1, f"2024-01-01T10:{i % 3:02d}:00+00:00", f"t{i}")) for i in range(9)])
    stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic)))
    q = (msg.minute_counts_stream(stream).writeStream.outputMode("update").format("memory")
         .queryName("minute_counts_t").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.minute: r.n_rows for r in spark.sql("select * from minute_counts_t").collect()}
    batch = msg.minute_counts(msg.minute_buckets(msg.clean_messages(msg.read_topic(spark, topic))))
    assert got == {r.minute: r.n_rows for r in batch.collect()}


def test_late_rows_and_bad_times_in_the_count_stream(spark, tmp_dir):
    topic, ckpt, out = (os.path.join(tmp_dir, d) for d in ("topic", "ckpt", "out"))

    def run():
        stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic)))
        counts = msg.minute_counts_stream(stream)
        q = (counts.writeStream.outputMode("complete").option("checkpointLocation", ckpt).trigger(availableNow=True)
             .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start())
        q.awaitTermination()
        return {r.minute: r.n_rows for r in spark.read.parquet(out).collect()}

    _write_topic_file(topic, "b1.json", [(0, _m(1, "2024-01-01T10:00:01+00:00", "one")), (1, _m(2, "2024-01-01T11:30:00+00:00", "two")),
                                         (2, _m(3, "garbage", "three"))])
    assert run() == {"01_01_2024_10_00": 1, "01_01_2024_11_30": 1}
    _write_topic_file(topic, "b2.json", [(3, _m(4, "2024-01-01T10:00:59+00:00", "late"))])
    assert run() == {"01_01_2024_10_00": 2, "01_01_2024_11_30": 1}


def test_compacting_one_minute_keeps_the_others(spark, tmp_dir):
    rows = [(str(i), "t", f"x{i}", f"m{i % 3}") for i in range(9)]
    spark.createDataFrame(rows, "author_id string, created_at string, text string, minute string").write.partitionBy(
        "minute").option("header", True).csv(f"{tmp_dir}/in")
    for m in ("m0", "m1", "m0"):
        msg.compact_minutes(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", [m])
    out = spark.read.option("header", True).csv(f"{tmp_dir}/out")
    assert {r.minute: r["count"] for r in out.groupBy("minute").count().collect()} == {"m0": 3, "m1": 3}


def test_rows_with_bad_numbers_are_told(spark):
    rows = spark.createDataFrame([("1", "7", "a", "3"), ("2", "abc", "b", "4"), ("3", "", "c", "4.5"), ("4", None, "d", None)],
                                 "message_key string, user_id string, review_body string, rating string")
    assert sorted(r.message_key for r in msg.bad_numbers(rows).collect()) == ["2", "3"]


def test_bounded_micro_batches_give_the_same_files(spark, tmp_dir):
    topic, out, ckpt = (os.path.join(tmp_dir, d) for d in ("topic", "out", "ckpt"))
    for i in range(4):
        _write_topic_file(topic, f"b{i}.json", [(i, _m(i + 1, f"2024-01-01T10:0{i}:00+00:00", f"t{i}"))])
    stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic, max_per_trigger=1)))
    for q in msg.write_minute_files(stream, out, ckpt):
        q.awaitTermination()
        assert len(q.recentProgress) >= 4      # one file per micro-batch
    assert spark.read.option("header", True).csv(out).count() == 4


def test_line_breaks_survive_minute_files(spark, tmp_dir):
    topic, out = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "out")
    texts = ["a\rb", 'quo"te,', "back\\r\\n", "x\r\ny"]
    _write_topic_file(topic, "b.json", [(i, _m(i + 1, "2024-01-01T10:00:01+00:00", t)) for i, t in enumerate(texts)])
    stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic)))
    for q in msg.write_minute_files(stream, out, os.path.join(tmp_dir, "ckpt")):
        q.awaitTermination()
    want = ["a\rb", 'quo"te,', "back\\r\\n", "x\r y"]          # the consumer makes a line feed a blank
    assert [r.text for r in msg.read_minute_files(spark, out).orderBy("author_id").collect()] == want
    msg.compact_minutes(spark, out, out + "-compact")
    assert [r.text for r in msg.read_minute_files(spark, out + "-compact").orderBy("author_id").collect()] == want


def test_counted_batches_restart_and_repeat(spark, tmp_dir):
    topic, counts, ckpt = (os.path.join(tmp_dir, d) for d in ("topic", "counts", "ckpt"))

    def run():
        rows = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, topic, max_per_trigger=1)))
        msg.write_minute_counts(rows, counts, ckpt, fold_every=2).awaitTermination()
        return {r.minute: r.n_rows for r in msg.read_minute_counts(spark, counts).collect()}

    for k in range(5):
        _write_topic_file(topic, f"b{k}.json", [(k, _m(1, f"2024-01-01T10:0{k % 2}:01+00:00", "x")), (9, _m(1, "bad", "x"))])
        if k == 2:
            assert run() == {"01_01_2024_10_00": 2, "01_01_2024_10_01": 1}
    want = {"01_01_2024_10_00": 3, "01_01_2024_10_01": 2}
    assert run() == want and run() == want                   # late rows count; a restart adds nothing
    # a batch that is tried again, before and after it was folded
    again = spark.createDataFrame([("2024-01-01T10:00:01+00:00", "01_01_2024_10_00")], "created_at string, minute string")
    for batch in (4, 4):
        msg.merge_minute_counts(again, batch, counts, fold_every=5)
        assert {r.minute: r.n_rows for r in msg.read_minute_counts(spark, counts).collect()} == want
    assert msg.read_minute_counts(spark, os.path.join(tmp_dir, "none")).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_message_is_parsed_once(spark):
    cleaned = msg.clean_messages(spark.createDataFrame([(v,) for v in GOOD], "value string"))
    assert _plan(cleaned).count("parseJson") == 1
    assert "regexp" not in _plan(cleaned)


def test_topic_files_are_packed_and_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(msg, "FILE_MESSAGES", 2)
    rows = [(str(i), _m(i + 1, "2024-01-01T10:00:01+00:00", "line\nbreak \\ é")) for i in range(5)]
    msg.write_messages(spark.createDataFrame(rows, "key string, value string").coalesce(1), f"{tmp_dir}/topic")
    files = [f for f in os.listdir(f"{tmp_dir}/topic") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    topic = msg.read_topic(spark, f"{tmp_dir}/topic")
    assert sorted(map(tuple, topic.collect())) == [(int(k), k, v) for k, v in rows]
    assert msg.topic_count(topic).first().n_messages == 5
    stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, f"{tmp_dir}/topic", max_per_trigger=1)))
    for q in msg.write_minute_files(stream, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", rejects_dir=f"{tmp_dir}/rejects"):
        q.awaitTermination()
    found = [f for _, _, names in os.walk(f"{tmp_dir}/out") for f in names if f.startswith("part-")]
    assert found and all(f.endswith(".csv.gz") for f in found)
    assert msg.read_minute_files(spark, f"{tmp_dir}/out").count() == 5


def test_peek_does_not_sort_the_topic(spark):
    rows = [(i, str(i), _m(i, "2024-01-01T10:00:01+00:00", f"t{i}")) for i in (5, 3, 9, 1, 7)]
    first = msg.topic_peek(spark.createDataFrame(rows, "offset bigint, key string, value string"), 3)
    fields = first.select("offset", F.from_json("value", msg.MESSAGE_SCHEMA).alias("m")).select("offset", "m.*")
    assert "TakeOrderedAndProject" in _plan(fields) and "rangepartitioning" not in _plan(fields)
    assert [(r.offset, r.text) for r in fields.collect()] == [(1, "t1"), (3, "t3"), (5, "t5")]


def test_texts_meet_events_by_one_shuffle_at_every_size(spark, tmp_dir):
    from adlens.sources import fixtures
    docs = [(4, "a"), (9, "b"), (9, "c"), (12, None)]          # gaps, a repeated id, no text
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    events = spark.range(8).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 10:00:00' as ts", "id as user_id", "'{\"k\": 7}' as props")
    events.write.parquet(f"{tmp_dir}/events.parquet")
    tweets = fixtures.tweets(spark, tmp_dir)
    assert "SortMergeJoin" in _plan(tweets) and "BuildLeft" not in _plan(tweets)
    got = sorted((int(r.message_key), r.review_body or "") for r in tweets.collect())
    turns = [["a"], ["b", "c"], ["b", "c"], [""]]              # both rows of a repeated id, at each of its turns
    assert got == sorted((i, t) for i in range(8) for t in turns[i % 4])


def _tables(spark, folder, docs, n_events):
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    (spark.range(n_events).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 10:00:00' + make_interval(0, 0, 0, int(id % 3)) as ts",
                                      "id + 1 as user_id", "'{\"k\": 7}' as props").write.parquet(f"{folder}/events.parquet"))


def test_long_repeated_texts_are_stored_once(spark, tmp_dir):
    import random

    from adlens.plans import catalog
    draw = random.Random(4)
    texts = ["".join(draw.choices("abcdefghijklmnop", k=60_000)) for _ in range(2)]    # 30 KB each, however packed
    _tables(spark, tmp_dir, list(enumerate(texts)), 60)
    rows = catalog.REGISTRY["stream_minute_files_run"](spark, tmp_dir)
    got = sorted((int(r.author_id) - 1, r.text, r.minute) for r in rows.collect())
    assert got == [(i, texts[i % 2], f"0{i % 3 + 1}_01_2024_10_00") for i in range(60)]
    root = catalog._io_root(spark, tmp_dir, "events", "documents")
    sizes = {d: sum(os.path.getsize(f"{p}/{f}") for p, _, names in os.walk(f"{root.removeprefix('file:')}/{d}") for f in names)
             for d in os.listdir(root.removeprefix("file:"))}
    topic, minutes = sizes["topic_tweets"], next(n for d, n in sizes.items() if d.startswith("minutes-"))
    assert topic < 200_000 and minutes < 400_000          # gzip: over 1.8 MB each
    conf = spark.conf.get("parquet.compression.codec.zstd.level", None)
    assert conf is None                                   # the session's own writes keep their level


def test_wide_packed_files_are_read_beside_gzip(spark, tmp_dir):
    from adlens.sources.io import PACKED_WIDE
    rows = [(str(i), _m(i + 1, "2024-01-01T10:00:01+00:00", "line\nbreak \\ é")) for i in range(4)]
    df = spark.createDataFrame(rows, "key string, value string").coalesce(1)
    msg.write_messages(df.where("key < 2"), f"{tmp_dir}/topic")
    msg.write_messages(df.where("key >= 2"), f"{tmp_dir}/topic", packed=PACKED_WIDE)
    kinds = {f.rpartition(".")[2] for f in os.listdir(f"{tmp_dir}/topic") if f.startswith("part-")}
    assert kinds == {"gz", "zstd"}
    assert sorted(map(tuple, msg.read_topic(spark, f"{tmp_dir}/topic").collect())) == [(int(k), k, v) for k, v in rows]
    for packed in (None, PACKED_WIDE):
        stream = msg.minute_buckets(msg.clean_messages(msg.read_stream(spark, f"{tmp_dir}/topic")))
        kw = {"packed": packed} if packed else {}
        for q in msg.write_minute_files(stream, f"{tmp_dir}/out{len(kw)}", f"{tmp_dir}/ckpt{len(kw)}", **kw):
            q.awaitTermination()
        back = msg.read_minute_files(spark, f"{tmp_dir}/out{len(kw)}")
        assert sorted((r.author_id, r.text) for r in back.collect()) == [(str(i + 1), "line break \\ é") for i in range(4)]
    msg.compact_minutes(spark, f"{tmp_dir}/out1", f"{tmp_dir}/compact")
    assert msg.read_minute_files(spark, f"{tmp_dir}/compact").count() == 4


def test_texts_move_once(spark, tmp_dir, capsys):
    import re

    from adlens.sources import fixtures
    _tables(spark, tmp_dir, [(4, "a"), (9, "b")], 4)
    fixtures.tweets(spark, tmp_dir).explain("formatted")
    moved = re.findall(r"\) \w*Exchange\nInput \[\d+\]: \[([^\]]*)\]", capsys.readouterr().out)
    assert moved and sum("text#" in columns for columns in moved) == 1


def test_a_released_build_leaves_no_shuffle_files(spark, tmp_dir):
    import time

    from adlens.operators.materialize import write_once
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffles():
        return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before = shuffles()
    write_once(spark, f"{tmp_dir}/t", lambda: spark.range(100).repartition(4, "id"), release=True)
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
