import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import ngram_join as nj
from adlens.llm.common import kept

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    w = WORD.findall((text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets, parent = {}, {}
    for d, t in rows:
        if d is not None:
            sets[d] = brute_set(t)
            parent[d] = d

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets, key=lambda d: len(sets[d]))
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if 80 * len(sets[b]) > 100 * len(sets[a]):
                break
            if sets[a]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return sorted(((d, len(brute_set(t)), None if d is None else root(d)) for d, t in rows), key=repr)


def got(docs):
    out = nj.similar_components(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("which", ["edge_docs", "sf_docs", "no_docs"])
def test_against_brute_force(which, request):
    docs = request.getfixturevalue(which)
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def variants(rng, n_bases=12, per=9):
    """Chains and clouds of edited texts of many sizes, with a passage that
    many of them share."""
    passage = [f"p{k}" for k in range(52)]
    out, d = [], 0
    for b in range(n_bases):
        base = [f"b{b}x{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 5, 6, 8, 9, 12, 20, 40, 90, 300]))]
        if b % 2:
            base[len(base) // 2:len(base) // 2] = passage
        now = list(base)
        for _ in range(per):
            d += rng.randint(1, 5)
            if rng.random() < 0.5:
                now = list(base)
            for _ in range(max(1, int(len(now) * rng.choice([0.0, 0.005, 0.01, 0.02, 0.04])))):
                kind, at = rng.randint(0, 2), rng.randrange(len(now))
                if kind == 0:
                    now[at] = f"e{rng.randint(0, 10**6)}"
                elif kind == 1 and len(now) > 2:
                    del now[at]
                else:
                    now.insert(at, f"i{rng.randint(0, 10**6)}")
            out.append((d, " ".join(now)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_texts(spark, seed, monkeypatch):
    monkeypatch.setattr(nj, "GROUP_BLOCK", 4)      # groups meet block by block
    rows = variants(random.Random(seed))
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 17, 18, 19, 27, 28, 40, 41, 63, 95, 142, 213, 400, 719, 1500]:
        for _ in range(12):
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            drop, add = sorted(rng.integers(0, size // 4 + 1, 2))
            b = np.concatenate([a[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)])
            common = size - drop
            if not len(b) or 100 * common < 80 * (size + len(b) - common):
                continue
            h = np.concatenate([np.sort(a), np.sort(b)])
            sig, own = nj.signatures(h, np.array([len(a), len(b)]))
            assert set(sig[own == 0].tolist()) & set(sig[own == 1].tolist()), (size, drop, add)


def test_exhausted_sets_share_a_signature():
    h = np.arange(1, 9, dtype=np.uint64)      # all in part 0
    sig, own = nj.signatures(np.concatenate([h, h[1:]]), np.array([8, 7]))
    assert set(sig[own == 0].tolist()) & set(sig[own == 1].tolist())


def test_shared_groups_across_batches(spark):
    rows = [(s, k) for s, n in ((1, 1), (2, 40), (3, 2), (4, 1), (5, 7)) for k in range(10 * s, 10 * s + n) for _ in range(1 + k % 2)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = nj.shared_signatures(spark.createDataFrame(rows, "sig long, k1 long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(s, k, 10 * s) for s, k in rows if s in (2, 3, 5)}
    assert len(out) == len(want) and {tuple(r) for r in out} == want


def test_one_of_each_stays(sf_docs):
    out = nj.keep_one_of_each(sf_docs)
    assert out.columns == sf_docs.columns
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in sf_docs.collect()]) if d == c}
    assert {r.doc_id for r in out.select("doc_id").collect()} == want


def test_only_copies_go(spark):
    """Texts of their own stay, though an id repeats, is missing, or a column
    bears a name that the join uses."""
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(3, a), (5, a + " tail"), (5, "a text of its own under a repeated id"), (5, b), (None, b + " more"), (None, "alone and unnamed"),
            (None, None), (5, ""), (7, "x y"), (7, "X Y"), (7, "x y"), (2 ** 63 - 1, "last one")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, key int")
    docs = docs.withColumns({"own_id": F.lit("c"), "digest": F.lit("c")})
    out = nj.keep_one_of_each(docs)
    gone = {1, 4, 9} if min(map(sha, ("x y", "X Y"))) == sha("x y") else {1, 4, 8, 10}
    assert out.columns == docs.columns
    assert {r.key for r in out.collect()} == set(range(len(rows))) - gone
    assert nj.keep_one_of_each(docs.limit(0)).count() == 0


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_filter_passes_all_wanted(spark):
    ids = spark.range(0, 5000, 7).selectExpr("id AS rep")
    texts = spark.range(0, 5000).selectExpr("id AS doc_id", "concat('a b c d e f ', id) AS text")
    got = {r.rep for r in nj.sets_of(texts, ids).select("rep").collect()}
    assert got >= set(range(0, 5000, 7)) and len(got) < 800


def test_sketches_fold():
    rng = np.random.default_rng(5)
    h, n = rng.integers(0, 2**64, 900, dtype=np.uint64), np.array([600, 0, 300])
    flat, words = nj.parity_sketch(h, n)
    assert words.tolist() == [32, 4, 16]
    rows = nj.folded([flat], words)
    for k, own in enumerate((h[:600], h[:0], h[600:])):
        want = np.zeros(256, np.uint8)
        for x in own.tolist():
            want[x & 255] ^= 1
        assert (np.unpackbits(rows[k].view(np.uint8), bitorder="little") == want).all()


class Steps:
    """Stands in for a table: notes the function given to ``mapInArrow``."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def own_memory():
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(kb) for kb in re.findall(r"\nAnonymous:\s+(\d+)", f.read())) << 10


@pytest.mark.parametrize("step", [nj.summarise, nj.sign])
def test_workers_hold_nothing_between_tasks(step):
    texts = Steps()
    step(texts)
    row = " ".join(f"word{k % 977}" for k in range(2_000))

    def batches(n):
        for k in range(n):
            yield pa.RecordBatch.from_arrays([pa.array(range(2_000)), pa.array([f"{k} {d} {row}" for d in range(2_000)])], names=["doc_id", "text"])

    # a worker that has run the step before, and that another stage left with its tables
    assert sum(b.num_rows for b in texts.run(batches(1))) >= 2_000
    kept("an earlier stage's", lambda: np.ones(6 << 20))
    start = own_memory()
    assert sum(b.num_rows for b in texts.run(batches(3))) >= 6_000
    # the tables (48 MB) are gone, and no room of a finished step is held
    assert own_memory() < start - (24 << 20)
    assert kept("an earlier stage's", lambda: "made anew") == "made anew"
