"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm import spelling


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, tried one by one."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_counts(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def plain_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), max_size=40))
def test_composition(words):
    acceptor = spelling.Acceptor()
    start = acceptor.add(sorted(words))
    got = [pair for letters in range(7) for pair in acceptor.pairs(start, letters)]
    assert len(got) == len(set(map(frozenset, got)))
    assert set(map(frozenset, got)) == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor()
    # the right languages are {mast, fast, lost}, {ast}, {ost}, {st}, {t}, {''}
    acceptor.add(["fast", "lost", "mast"])
    assert len(acceptor.edges) == 6
    acceptor.add(["best", "rest"])                      # shares est and what follows
    assert len(acceptor.edges) == 8


def test_variants(spark):
    words = {"house": 40, "houses": 9, "hose": 7, "mouse": 20, "mousse": 3, "hause": 20, "hauße": 5, "zzzzz": 4, "zzzzy": 2, "zzzz": 9,
             "aaaaaaaaaa": 5, "aaaaaaaaa": 5, "aaaaaaaa": 10, "aaaabaaaa": 10, "abcdefghij": 3, "abcdefghijk": 6, "xabcdefghijk": 12, "yabcdefghijk": 12}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = plain_variants(words)
    for most in (2048, 2, 1):
        assert result(spelling.variants(frame, most)) == want
    assert dict((r[0], r[2]) for r in want)["abcdefghij"] == "xabcdefghijk"


def test_hot_halves(spark):
    """Hundreds of words share a half, so their stretches are halved again."""
    words = {f"shared{a}{b}{c}": 3 + (ord(a) * ord(b) + ord(c)) % 7 for a in "abcdefgh" for b in "abcdefg" for c in "abcdé"}
    words |= {f"{a}{b}shared": 4 for a in "abcdefgh" for b in "abcdefgh"}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(frame, 16)) == plain_variants(words)
    assert spelling.partitions(frame, 16).groupBy("key").count().agg({"count": "max"}).first()[0] <= 16


def test_documents(spark, sf_docs):
    docs = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    counts = plain_counts(docs)
    got = result(spelling.group_spellings(sf_docs))
    assert {r[0]: r[3] for r in got} == counts
    some = sorted(counts)[::4]
    frame = spark.createDataFrame([(w, counts[w]) for w in some], "word string, n long")
    assert result(spelling.variants(frame)) == plain_variants({w: counts[w] for w in some})


def test_edges(spark, edge_docs, no_docs, monkeypatch):
    docs = edge_docs.withColumnRenamed("score", "word").withColumnRenamed("shard", "key")
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    want = plain_variants(plain_counts(rows))
    assert want and result(spelling.group_spellings(docs)) == want
    monkeypatch.setattr(spelling, "TASK_WORDS", 3)
    assert result(spelling.group_spellings(docs)) == want
    assert spelling.group_spellings(no_docs).count() == 0
    long = "ÄbcÀÿ×÷" * 4000
    texts = spark.createDataFrame([(k, long) for k in range(4)] + [(None, "Teſt ÉCOLE école É" * 5)], "doc_id long, text string")
    assert result(spelling.group_spellings(texts)) == plain_variants(plain_counts([tuple(r) for r in texts.collect()]))
