import base64
import gc
import hashlib
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from adlens.llm import bpe, bpe_codec, packing, token_counts
from adlens.llm.common import STEP_BYTES, kept

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["'s", "'t", "'re", "'ll", " ", "  ", "\n", "\t", "a", "B", "é", "1", "२", "!", "'", "''", "漢字", "😀", "ing", "  \n ", "\r\n",
         "x" * 70, "　", "'d", "l", "r", "v", " '", "-", "\x1c", "<|endoftext|>", "ǅ", "½", "​", "\x85"]


def library():
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hf():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def fuzz(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)] + ["", "'", "aaaa" * 3000, "é" * 500]


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n:e].tolist() for e, n in zip(ends, counts, strict=True)]


def test_encoder_equals_the_libraries():
    texts = fuzz(4000, 5)
    enc = bpe.Encoder(bpe.read_vocabulary(MULTI))
    ids, counts, data, starts = enc.encode_slices(texts)
    assert split(ids, counts) == library().encode_ordinary_batch(texts)
    assert enc.decode(ids).tobytes() == "".join(texts).encode() == data.tobytes()
    assert (np.diff(starts) == enc.token_len[ids[:-1]]).all()
    one = bpe.Encoder(bpe.read_vocabulary(P.path("byte_bpe_50k.json")))
    assert split(*one.encode(texts)) == [x.ids for x in hf().encode_batch(texts, add_special_tokens=False)]


def test_slices_forgotten_midway(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SLICES", 10)
    enc, lib = bpe.Encoder(bpe.read_vocabulary(MULTI)), library()
    for seed in range(3):
        texts = fuzz(200, seed)
        assert split(*enc.encode(texts)) == lib.encode_ordinary_batch(texts)


def test_op7_rows(edge_docs, sf_docs, no_docs):
    lib = library()
    for docs in (edge_docs, sf_docs, no_docs):
        got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe_codec.encode(docs, decoded=True).collect())
        want = Counter()
        for r in docs.collect():
            ids = lib.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (r.text or "").encode()] += 1
        assert got == want


def test_round_trip_and_offsets(edge_docs):
    coded = bpe_codec.encode(edge_docs, offsets=True)
    texts = Counter((r.doc_id, r.text or "") for r in edge_docs.collect())
    assert Counter(map(tuple, bpe_codec.decode(coded).collect())) == texts
    for r in coded.collect():
        at = np.frombuffer(r.offsets, "<u4")
        assert len(at) == r.n_tokens and (not len(at) or at[0] == 0) and (np.diff(at.astype(int)) > 0).all()


def test_op7_digests(spark):
    r = bpe_codec.op7_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first().text
    ids = np.array(library().encode_ordinary(text), "<u4").tobytes()
    assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


# ---- packing -----------------------------------------------------------------


def check_pieces(docs, rows, context, most_padding):
    lib = hf()
    pieces, sequences, used = defaultdict(list), defaultdict(list), Counter()
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for d in docs.collect():
        used[d.doc_id] += 1
        if used[d.doc_id] > 1 or d.doc_id is None:
            continue
        ids = [*lib.encode(d.text or "", add_special_tokens=False).ids, 1]
        at = 0
        own = sorted(pieces[d.doc_id], key=lambda r: r.start)
        own = own[:len({r.start for r in own})] if len({r.start for r in own}) == len(own) else list({r.start: r for r in own}.values())
        for r in own:
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    total = padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= context
        total, padding = total + context, padding + context - at
    assert padding <= most_padding * total


def test_pieces(sf_docs):
    check_pieces(sf_docs, packing.pack(sf_docs.coalesce(1)).collect(), 2048, 0.2)     # eight short partitions
    docs = sf_docs.repartitionByRange(1, "doc_id")
    check_pieces(docs, packing.pack(docs, context=512).collect(), 512, 0.08)


def test_awkward_pieces(edge_docs, no_docs, monkeypatch):
    distinct = edge_docs.dropDuplicates(["doc_id"])
    check_pieces(distinct, packing.pack(distinct).collect(), 2048, 0.9)
    assert sum(r.length for r in packing.pack(edge_docs).collect()) == sum(
        len(hf().encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge_docs.collect())
    assert packing.pack(no_docs).count() == 0
    monkeypatch.setattr(packing, "STRETCH_IDS", 3000)
    enc = bpe.Encoder(bpe.read_vocabulary(P.path("byte_bpe_50k.json")))
    rows = distinct.collect()
    p = packing.Packer(enc, 512, 1, 0)
    out = [b for r in rows for b in p.add([r.doc_id], [r.text or ""])] + [p.solve(True)]
    import pyarrow as pa
    got = pa.Table.from_batches(out).to_pylist()
    check_pieces(distinct, [type("R", (), x) for x in got], 512, 0.1)


def test_added_tokens_are_one_id(spark):
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)      # as it comes
    enc = bpe.Encoder(bpe.read_vocabulary(path), bpe.added_tokens(path))
    texts = fuzz(2000, 8) + ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x<|endoftext|", "it<|endoftext|>'s é<|endoftext|>"]
    want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    ids, counts, data, starts = enc.encode_slices(texts)
    assert split(ids, counts) == want and want[-4] == [64, 220, 50256, 275]
    assert enc.decode(ids).tobytes() == "".join(texts).encode() == data.tobytes()
    assert (np.diff(starts) == enc.token_len[ids[:-1]]).all()
    docs = spark.createDataFrame(list(enumerate(texts[-6:])), "doc_id long, text string")
    lengths = {r.doc_id: r for r in packing.pack(docs, context=1 << 15).collect()}
    for k, own in enumerate(want[-6:]):
        r = lengths[k]
        assert (r.start, r.length, r.doc_tokens) == (0, len(own) + 1, len(own) + 1)
        assert r.ids_crc32 == zlib.crc32(np.array([*own, 1], "<u4").tobytes())
    few = bpe.Encoder(bpe.read_vocabulary(path), {"ab": 50256, "abc": 50257})      # the longest at a place
    assert few.encode(["xabcab"])[0].tolist()[1:] == [50257, 50256]


def test_packer_encodes_in_small_steps():
    """One block of text is not encoded at once: its arrays take many times the text."""
    class Watched(bpe.Encoder):
        def encode(self, texts):
            steps.append(sum(map(len, texts)))
            return super().encode(texts)

    steps, path = [], P.path("byte_bpe_50k.json")
    texts = ["", *(f"Document {k} has its words. " * 4000 for k in range(20)), "long " * 200_000, "", "end"]
    enc = Watched(bpe.read_vocabulary(path))
    packer = packing.Packer(enc, packing.CONTEXT, packing.END_ID, 0)
    rows = [r for b in [*packer.add(list(range(len(texts))), texts), packer.solve(True)] for r in b.to_pylist()]
    assert sorted(steps)[-2] <= STEP_BYTES < len(texts[-3]) == max(steps) and sum(steps) == sum(map(len, texts))
    ids, counts = enc.encode(texts)
    lengths = Counter()
    for r in rows:
        own = split(ids, counts)[r["doc_id"]] + [packing.END_ID] if r["doc_id"] in (0, 1, 21, 23) else None
        if own:
            piece = np.array(own[r["start"]:r["start"] + r["length"]], "<u4")
            assert (len(piece), zlib.crc32(piece), len(own)) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        lengths[r["doc_id"]] += r["length"]
    assert [lengths[k] for k in range(len(texts))] == (counts + 1).tolist()


def test_worker_lets_go_of_a_finished_stages_tables():
    first = bpe.encoder(bpe.read_vocabulary(MULTI))
    assert bpe.encoder(bpe.read_vocabulary(MULTI)) is first
    gone = weakref.ref(first)
    del first
    assert kept("the next stage's", lambda: 5) == kept("the next stage's", lambda: 6) == 5
    gc.collect()
    assert gone() is None


def test_cuts_are_optimal():
    rng = random.Random(7)

    def cost(cuts, places, pens, context):
        at, out = 0, 0
        for k in cuts:
            if places[k] - at > context:
                return None
            out, at = out + context - (places[k] - at) + pens[k], places[k]
        return out

    for _ in range(200):
        context, n = rng.randint(4, 12), rng.randint(1, 9)
        places, at = [], 0
        for _ in range(n):
            at += rng.randint(1, context)
            places.append(at)
        pens = [rng.choice([0, 2, 5]) for _ in range(n)]
        least = min(c for m in range(1 << (n - 1)) if (c := cost(
            [k for k in range(n) if m >> k & 1 or k == n - 1], places, pens, context)) is not None)
        assert cost(packing.best_cuts(places, pens, context), places, pens, context) == least


# ---- token counts ------------------------------------------------------------


@pytest.mark.parametrize("which", ["edge_docs", "sf_docs"])
def test_token_counts(which, request):
    docs, lib = request.getfixturevalue(which), library()
    lengths = [len(lib.encode_ordinary(r.text or "")) for r in docs.collect()]
    table = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(docs)))
    rows = {r.n_tokens: r for r in table.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for n, r in rows.items():
        assert r.n_docs == lengths.count(n) and r.docs_ge == sum(x >= n for x in lengths)
        assert r.tokens_ge == sum(x for x in lengths if x >= n) and r.tokens_total == sum(lengths)
        assert r.tokens_kept == sum(min(x, n) for x in lengths) and r.tokens_cut == sum(lengths) - r.tokens_kept
        assert r.docs_total == len(lengths) and abs(r.share_below - sum(x < n for x in lengths) / len(lengths)) < 1e-12
    for r in token_counts.at_limits(table, [1, 100, 10**6]).collect():
        assert r.tokens_kept == sum(min(x, r.limit) for x in lengths) and r.docs_over == sum(x > r.limit for x in lengths)


def test_no_token_counts(no_docs):
    table = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(no_docs)))
    assert table.count() == 0
    assert [tuple(r) for r in token_counts.at_limits(table, [8]).collect()] == [(8, 0, 0, 0)]
