"""Mixing against a plain queue, and its SQL."""

import hashlib
import re
from math import inf

import duckdb
import pytest
from pyspark.sql import functions as F

from adlens.llm import mixing
from adlens.llm.common import join_small

SF = "/root/testdata/sf0.001"


def plain_mix(docs):
    """(rows, order) of [(doc_id, text, source)] by one pass over one queue."""
    rows = [(d, s, len(re.findall("[^\x20\x09-\x0d]+", t or ""))) for d, t, s in docs]
    names = sorted({r[1] for r in rows if r[1] is not None}, key=lambda x: x.encode()) + [None] * any(r[1] is None for r in rows)
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, target, left = 1.5 * sum(size.values()), dict.fromkeys(names, 0.0), set(names)
    while left:
        rest = budget - sum(target[s] for s in names if s not in left)
        for s in left:
            target[s] = rest * weight[s] / sum(weight[x] for x in left)
        over = {s for s in left if target[s] >= 2 * size[s]}
        for s in over:
            target[s] = 2.0 * size[s]
        if not over:
            break
        left -= over

    def key(d):
        return int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16), -inf if d is None else d

    entries = []
    for s in names:
        sent = 0
        for p in (0, 1):
            for d, _, n in sorted((r for r in rows if r[1] == s and r[2]), key=lambda r: (*key(r[0]), r[2])):
                sent += n
                entries.append((sent * 10 // weight[s], names.index(s), p, d, n))
    upto, taken, order = 0, {}, []
    for finish, s, p, d, n in sorted(entries, key=lambda e: e[:2]):
        upto += n
        if upto > budget:
            break
        taken[d, s, n] = taken.get((d, s, n), 0) + n
        order.append((d, p, finish))
    return sorted([(d, s, n, size[s], pytest.approx(target[s]), taken.get((d, names.index(s), n), 0)) for d, s, n in rows],
                  key=lambda r: repr(r[:3])), order


def result(df):
    return sorted(map(tuple, df.select("doc_id", "source", "size", "source_size", "target", "taken").collect()), key=lambda r: repr(r[:3]))


def test_word_count(spark):
    texts = ["", " ", "a", " a ", "a b", "\ta\x0b\x0cb\r\nc d ", "  no-break ", "x" * 70_000, "a " * 70_000, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for t in texts]


def test_against_plain_queue(spark, sf_docs, monkeypatch):
    docs = [tuple(r) for r in sf_docs.select("doc_id", "text", "source").collect()]
    want, order = plain_mix(docs)
    assert result(mixing.mix(sf_docs)) == want
    assert [tuple(r) for r in mixing.sequence(sf_docs).select("doc_id", "pass", "finish").collect()] == order
    # many buckets, the cut searched in several rounds, joins by shuffling
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    monkeypatch.setattr(mixing, "LAST_ROWS", 4)
    monkeypatch.setattr("adlens.llm.common.SMALL_ROWS", 2)
    assert result(mixing.mix(sf_docs.repartition(7))) == want


def test_shares_are_near(spark, sf_docs):
    per = mixing.mix(sf_docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"),
                                                    F.max(F.expr("taken / nullif(size, 0)")).alias("passes")).collect()
    assert all(abs(r.taken - r.target) <= 2 * r.most and r.passes <= 2 for r in per)
    total = sf_docs.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert 0 <= 1.5 * total - sum(r.taken for r in per) < max(r.most for r in per)
    assert sum(r.target for r in per) == pytest.approx(1.5 * total)


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = result(mixing.op11_mixing(spark, SF))
    want = con.execute(f"select doc_id, source, size, source_size, target, taken from ({mixing.ORACLE})").fetchall()
    assert got == sorted([(*r[:4], pytest.approx(r[4]), r[5]) for r in want], key=lambda r: repr(r[:3]))


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("source_no", F.lit("clash")).withColumn("finish", F.lit("clash"))
    got = result(mixing.mix(docs))
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text", "source").collect()]
    want, _ = plain_mix(rows)
    # rows alike in id and size share what they take
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert sum(r[5] for r in got) <= 1.5 * sum(r[2] for r in got) and all(r[5] in (0, r[2], 2 * r[2]) for r in got)
    assert {r[5] for r in got if r[2] == 0} == {0} and any(r[1] is None and r[5] for r in got)
    assert mixing.mix(no_docs).count() == 0 and mixing.sequence(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert result(mixing.mix(blank)) == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]
    one = spark.createDataFrame([(1, "a b c", "only")] * 4, "doc_id long, text string, source string")
    assert sum(r[5] for r in result(mixing.mix(one))) == 18


def test_native(spark, sf_docs):
    plan = mixing.mix(sf_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_join_small_nulls(spark, monkeypatch):
    a = spark.createDataFrame([(1, "x"), (2, None)], "n int, k string")
    b = spark.createDataFrame([("x", 10), (None, 20)], "k string, m int")
    for bound in (100, 0):
        monkeypatch.setattr("adlens.llm.common.SMALL_ROWS", bound)
        assert sorted(map(tuple, join_small(a, b, "k").select("n", "k", "m").collect())) == [(1, "x", 10), (2, None, 20)]
