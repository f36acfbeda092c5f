import hashlib
import zlib
from collections import defaultdict

from adlens.llm import exact_dedup, sharding

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_groups(rows):
    by = defaultdict(list)
    for d, t in rows:
        by[hashlib.sha256((t or "").translate(UP).encode()).hexdigest()].append(d)
    out = []
    for h, ids in by.items():
        known = [d for d in ids if d is not None]
        keep = max(known) if known else None
        out += [(d, keep, len(ids), d == keep, h) for d in ids]
    return sorted(out, key=repr)


def test_groups(edge_docs, sf_docs):
    for docs in (edge_docs, sf_docs):
        got = sorted(map(tuple, exact_dedup.duplicate_groups(docs).collect()), key=repr)
        assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_when_few_digests_can_be_named(edge_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAVY", 1)
    prints = exact_dedup.fingerprints(edge_docs)
    assert exact_dedup.frequent_digests(prints, heavy=1, tracked=64).count() == 1


def test_hot_digest_is_named(spark):
    docs = spark.range(0, 3000, 1, 7).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'Hot' ELSE concat('t', id) END AS text")
    named = exact_dedup.frequent_digests(exact_dedup.fingerprints(docs), heavy=4, tracked=64).collect()
    assert hashlib.sha256(b"hot").digest() in [bytes(r.digest) for r in named]
    got = {(r.keep_id, r.group_size) for r in exact_dedup.duplicate_groups(docs).collect() if r.group_size > 1}
    assert got == {(2997, 1000)}


def test_drop_duplicates_keeps_columns(edge_docs):
    out = exact_dedup.drop_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert 9 in ids and 1 not in ids and 2 not in ids and 6 in ids


def test_empty(no_docs):
    assert exact_dedup.duplicate_groups(no_docs).count() == 0
    assert sharding.assign_shards(no_docs).count() == 0


def test_only_copies_go(spark):
    rows = [(1, "a"), (1, "unique text"), (2, "A"), (2, "a"), (None, "a"), (None, "b"), (None, "b"), (None, None), (4, ""), (1, "Unique text")]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, key int")
    docs = docs.withColumnRenamed("key", "gone_id")
    out = exact_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.gone_id for r in out.collect()) == [1, 2, 3, 5, 6, 8, 9]
    assert exact_dedup.drop_duplicates(docs.limit(0)).count() == 0


def brute_shards(rows, shards):
    order = sorted(((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t in rows))
    total, at, out, count = sum(x[3] for x in order), 0, [], defaultdict(int)
    for known, d, crc, size in order:
        shard = next(k for k in range(shards, -1, -1) if at >= -(-total * k // shards))
        out.append((d if known else None, size, crc, "bytes", shard, count[shard], None))
        count[shard] += 1
        at += size
    return sorted(out, key=repr)


def test_shards(edge_docs, sf_docs):
    for docs, n in ((edge_docs, 3), (sf_docs, 16)):
        got = sorted(map(tuple, sharding.assign_shards(docs, n).collect()), key=repr)
        assert got == brute_shards([(r.doc_id, r.text) for r in docs.collect()], n)


def test_shards_are_balanced(sf_docs):
    rows = sharding.assign_shards(sf_docs).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    assert len(size) == 16 and max(size.values()) - min(size.values()) <= 2 * max(r.size for r in rows)


def test_written_shards(spark, sf_docs, tmp_dir):
    sharding.write_shards(sf_docs, f"{tmp_dir}/s", 4)
    back = spark.read.parquet(f"{tmp_dir}/s")
    assert back.count() == sf_docs.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
