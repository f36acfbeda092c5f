"""Vector codes against plain arithmetic, and their SQL."""

import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from adlens.llm import vector_codes as vc

SF = "/root/testdata/sf0.001"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """{(vec_id, code, error)} and the digest, of [(vec_id, vector)] in Python's integers."""
    kept = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = max(1, -(-max(len(v) for _, v in kept) // parts))
    kept = [(i, v + [0] * (parts * width - len(v))) for i, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            at = [near(p, c[p])[1] for c in cut]
            new.append([[sum(col) // len(col) for col in zip(*mine, strict=True)] if (mine := [c[p] for c, a in zip(cut, at, strict=True) if a == k]) else e
                        for k, e in enumerate(books[p])])
        books = new
    out = []
    for (i, _), c in zip(kept, cut, strict=True):
        found = [near(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(out, key=repr), digest


@pytest.mark.parametrize("m", [1, 2, 4, 8, 16])
def test_transform(m):
    t = vc.walsh(np.eye(m, dtype=np.int64))
    assert (t @ t.T == m * np.eye(m)).all()
    # columns of the identity's transform are the Walsh functions: sign changes rise one by one
    assert [(np.diff(t[:, k]) != 0).sum() for k in range(m)] == list(range(m))


@pytest.mark.parametrize("width", [1, 3, 4, 7])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest(width, kind):
    rng = np.random.default_rng(width)
    rows, book = rng.integers(-40, 40, (500, width)).astype(kind), rng.integers(-40, 40, (30, width)).astype(kind)
    book[7] = book[3]
    if kind is object:
        rows, book = rows * 10 ** 30, book * 10 ** 30
    at, d = vc.nearest(rows, book)
    for i in range(len(rows)):
        want = min((sum((a - b) ** 2 for a, b in zip(rows[i].tolist(), e, strict=True)), k) for k, e in enumerate(book.tolist()))
        assert (d[i], at[i]) == want


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string").repartition(3)


def check(spark, rows):
    got = vc.compress(frame(spark, rows)).collect()
    want, digest = plain_codes([(r[0], r[1]) for r in rows])
    assert sorted([(r.vec_id, r.code, r.error) for r in got], key=repr) == [(i, c, e if e < 1 << 63 else None) for i, c, e in want]
    assert {r.codebooks_sha256 for r in got} <= {digest}
    for r in got:
        of = [x.error for x in got if x.label == r.label]
        total = None if None in of else sum(of)
        assert r.label_error == (total if total is not None and total < 1 << 63 else None)
    return got


def test_small_and_awkward(spark):
    rnd = random.Random(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rnd.gauss(0, 1) for _ in range(40)], i % 3 or None, "x") for i in range(150)]
    rows += [(200, None, 1, None), (201, [1.0, None], 1, None), (202, [nan] * 40, 1, None), (203, [inf] * 40, 1, None), (204, [], 2, None),
             (205, [0.5] * 7, 2, None), (5, [0.1] * 40, 1, None), (5, [0.1] * 40, 1, None), (None, [0.2] * 40, None, None), (206, [-0.0] * 40, 9, None)]
    got = check(spark, rows)
    assert len(got) == 156


def test_beyond_64_bits(spark):
    check(spark, [(i, [(-1) ** i * 10.0 ** (i % 38) * (k + 1) for k in range(16)], i % 2, None) for i in range(90)])
    check(spark, [(i, [1e300 * (i % 5), -1e300 + i], 1, None) for i in range(70)])


def test_few_or_none(spark):
    check(spark, [(3, [0.25] * 16, 1, None), (1, [0.5] * 16, 1, None)])
    check(spark, [(1, [], None, None), (2, [], None, None)])
    assert vc.compress(frame(spark, [])).count() == 0
    assert vc.compress(frame(spark, [(1, None, 1, None)])).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    cols = "vec_id, label, code, error, label_error, codebooks_sha256"
    got = vc.op13_vector_codes(spark, SF).select(*cols.split(", ")).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"select {cols} from ({vc.ORACLE})").fetchall())
