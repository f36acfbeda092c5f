import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlens.llm import ctph, langid, quality


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out = []
    for k, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 4
        e = t[:len(t) - n] + nxt[:n]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), ctph.fingerprint(t), ctph.fingerprint(e)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["edge_docs", "sf_docs", "no_docs"])
def test_rows(which, request):
    docs = request.getfixturevalue(which)
    got = ctph.fingerprints(docs).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    if which == "sf_docs":
        near = sorted(r.near_edited for r in got)
        assert near[len(near) // 10] > 0.4 and sum(r.near_next > 0.5 for r in got) < 0.1 * len(got)


def test_texts_shorter_than_the_rolling_window():
    for n in range(12):
        prints = {ctph.fingerprint("abcdefghijkl"[:n]), ctph.fingerprint("abcdefghijkl"[:n])}
        assert len(prints) == 1 and prints.pop().startswith("3:")


def test_single_row(spark):
    r, = ctph.fingerprints(spark.createDataFrame([(5, "abcdefgh " * 30)], "doc_id long, text string")).collect()
    assert r.near_next == 1.0 and r.n_chars == 270


def test_fingerprint_of_edits(spark):
    text = " ".join(f"word{k * 7919 % 1009}" for k in range(600))
    rows = [("same", text, text), ("edit", text, text[:2000] + "XX" + text[2003:]), ("other", text, " ".join(f"t{k}" for k in range(900))),
            ("empty", "", ""), ("void", text, "")]
    frame = spark.createDataFrame([(n, ctph.fingerprint(a), ctph.fingerprint(b)) for n, a, b in rows], "n string, a string, b string")
    got = {r.n: r.x for r in frame.selectExpr("*").withColumn("x", ctph.likeness(frame.a, frame.b)).collect()}
    assert got["same"] == got["empty"] == 1.0 and got["edit"] > 0.8 and got["other"] < 0.3 and got["void"] == 0.0
    assert max(map(len, ctph.fingerprint(text).split(":")[1:])) <= ctph.LETTERS


def plainly_kept(spark, name, rows, sf, labels):
    """Ids that a stage keeps of (doc_id, text) rows, without its joins: the
    rules in plain Python, the classifiers by their operators' scores."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    if name == "exact_dedup":
        return set({t.translate(lower): d for d, t in sorted((d, t or "") for d, t in rows)}.values())
    if name == "ngram_join":
        sets, root = {}, {d: d for d, _ in rows}
        for d, t in rows:
            w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower))
            sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

        def top(d):
            while root[d] != d:
                d = root[d]
            return d

        for a, b in itertools.combinations(sorted(sets), 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                u, v = sorted((top(a), top(b)))
                root[v] = u
        return {d for d in root if top(d) == d}
    frame = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id").isin([d for d, _ in rows]))
    if name == "quality":
        return {r.doc_id for r in quality.score(frame, labels).where("predicted = 1").collect()}
    return {r.doc_id for r in langid.keep_identified(frame).collect()}


def test_pipeline_stages(spark, sf_docs):
    sf, docs = "/root/testdata/sf0.001", sf_docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "exact_dedup", "ngram_join", "packing"]
    before = docs.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == sf_docs.columns
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = out.cache()
        assert {r.doc_id for r in docs.select("doc_id").collect()} == plainly_kept(spark, name, rows, sf, labels), name
        after = docs.count()
        assert 0 < after <= before and docs.select("doc_id").distinct().count() == after, name
        before = after
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    run = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in run.select("doc_id").distinct().collect()} == kept
    texts = [r.text for r in docs.collect()]
    assert len({t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in texts}) == len(texts)


def test_pipeline_of_awkward_documents(spark, edge_docs, no_docs):
    sf = "/root/testdata/sf0.001"
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() >= 0
