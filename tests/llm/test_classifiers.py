import functools
import time
import zlib
from decimal import Decimal

import numpy as np
import pytest

from adlens.llm import bpe, langid, quality, toxicity
from adlens.llm.bpe_codec import default_vocabulary
from adlens.llm.common import distinct

CHECK = "/root/testdata/sf0.01"


def is_held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 4 == 2


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{CHECK}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{CHECK}/labels.parquet")


# ---- quality -------------------------------------------------------------------


def test_quality_on_held_out_labels(documents, labels):
    got = {r.doc_id: r for r in quality.score(documents, labels).collect()}
    assert len(got) == documents.count() and all(r.held_out == is_held_out(d) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    own = [(got[r.doc_id], r.quality) for r in labels.collect() if is_held_out(r.doc_id)]
    assert sum(r.predicted == q for r, q in own) >= 0.95 * len(own)


def test_quality_rows_and_constant_models(spark, edge_docs, no_docs, labels):
    for rows, share in (([], 1.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (8, None), (None, 1)], 0.5)):
        own = spark.createDataFrame(rows, "doc_id long, quality int")
        got = quality.score(edge_docs, own).collect()
        assert len(got) == edge_docs.count() and {round(r.score, 6) for r in got} == {share}
    assert quality.score(no_docs, labels).count() == 0
    kept = quality.keep_good(edge_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([rng.integers(0, 30, 8), [30 + i % 2]])) for i in range(80)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(80)])
    w, b = quality.dual_coordinate_descent(rows, np.ones(32), y, cost=1.0, epochs=50)
    assert all(np.sign(w[f].sum() + b) == t for f, t in zip(rows, y, strict=True))


def test_features_see_repeats():
    a, b = quality.features(["Was Was Was Was Was", "was he the one, was he?"])
    assert a.sum() and b.sum() and not (a & b).all()
    assert not quality.features([""])[0].any()
    # the same text gives the same features wherever it stands
    both = quality.features(["first text", "Was Was Was Was Was"])
    assert (both[1] == a).all()


def test_texts_of_one_shape_are_told_by_their_words(spark):
    good, bad = ["river", "stone", "cloud", "green", "apple"], ["pills", "cheap", "order", "click", "bonus"]
    rng = np.random.default_rng(3)
    rows = [(d, " ".join(rng.choice([good, bad][d % 2], 12)), 1 - d % 2) for d in range(240)]
    one, two = quality.features(["the river stone", "the pills cheap"])
    assert (one != two).any()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    want = {d: q for d, _, q in rows if is_held_out(d)}
    got = {r.doc_id: r.score for r in quality.score(docs, labels).collect() if r.held_out}
    assert len(want) > 20 and all((got[d] >= 0.5) == (q == 1) for d, q in want.items())


def test_grams_do_not_depend_on_neighbours():
    texts = ["Ärger über", "", "漢字 x", "a b c d", "Ärger über", "İx"]
    all_ = quality.features(texts)
    assert all((quality.features([t])[0] == r).all() for t, r in zip(texts, all_, strict=True))


def test_grams_of_many_short_texts():
    texts = [f"{k % 977} a{k % 13}!" for k in range(20_000)]      # more than 32 bits number with all features
    doc, feature = quality.active(texts)
    for k in (0, 1, 976, 977, 16_384, 19_999):
        assert feature[doc == k].tolist() == quality.active([texts[k]])[1].tolist()


def test_distinct_values_are_told_fast():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 50, 999).astype(np.uint32), rng.integers(-9, 1 << 40, 1000), np.zeros(0, np.int64)):
        assert distinct(values.copy()).tolist() == np.unique(values).tolist()
    texts = [" ".join(f"w{x:x}" for x in rng.integers(0, 1 << 24, 300)) for _ in range(240)]

    def seconds(work):
        t = time.process_time()
        work()
        return time.process_time() - t

    grams = min(seconds(lambda: [*quality.shape_grams(texts), *quality.letter_grams(texts)]) for _ in range(5))
    assert min(seconds(lambda: quality.active(texts)) for _ in range(5)) < 3 * grams


def test_quality_fit_against_a_dense_one(spark, sf_docs):
    """Ratios, hinge solution and interpolation from dense matrices: counts by
    adding rows, the dual problem by projected gradient steps."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    own = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and not is_held_out(r.doc_id)}
    rows = sorted((r.doc_id, r.text) for r in sf_docs.collect() if r.doc_id in own)
    x, y = quality.features([t or "" for _, t in rows]), np.array([own[d] for d, _ in rows])
    pos, neg = 1.0 + x[y == 1].sum(0), 1.0 + x[y == 0].sum(0)
    ratio = np.where(x.any(0), np.log(pos / pos.sum()) - np.log(neg / neg.sum()), 0.0)
    z, sign = x[:, x.any(0)] * ratio[x.any(0)], 2.0 * y - 1
    q = (z @ z.T + 1.0) * sign[:, None] * sign[None, :]
    alpha, step = np.zeros(len(y)), 1.0 / np.linalg.eigvalsh(q)[-1]
    for _ in range(20_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1.0), 0.0, quality.COST)
    dense = np.zeros(x.shape[1])
    dense[x.any(0)] = (alpha * sign) @ z
    want = (quality.INTERPOLATION * dense + (1 - quality.INTERPOLATION) * np.abs(dense).mean()) * ratio
    w, bias, slope, offset = quality.fit(sf_docs, labels)
    assert np.abs(w - want).max() <= 0.02 * np.abs(want).max() and bias == pytest.approx((alpha * sign).sum(), abs=0.02)
    margin = x @ want + bias
    assert slope > 0 and np.corrcoef(slope * margin + offset, y)[0, 1] > 0.8
    assert (np.sign(want[ratio != 0]) == np.sign(ratio[ratio != 0])).mean() > 0.9     # the ratios' own direction


# ---- language -------------------------------------------------------------------


def all_segmentations(word, book, prob):
    """Logarithm of a word's probability, by recursion over its segmentations
    into pieces of any length, in decimals that don't underflow."""
    def index(place, piece):
        from adlens.llm.common import slice_hashes
        data = np.frombuffer(piece, np.uint8)
        return int(book.index[place].find(slice_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64))[0])

    @functools.lru_cache(None)
    def rest(at):
        if at == len(word):
            return Decimal(1)
        total = Decimal(0)
        for to in range(at + 1, len(word) + 1):
            k = index(0 if at == 0 else 1, word[at:to])
            if k >= 0:
                total += Decimal(float(prob[k])) * rest(to)
        return total

    return float(rest(0).ln())


LONG_WORDS = ("internationalisierungsbemühungen", "understandingunderstandings", "неопределённостями", "котораякоторыекоторых", "ä" * 40,
              "donaudampfschifffahrtsgesellschaft" * 3)


def test_forward_sums_all_segmentations():
    rank_file = bpe.read_vocabulary(default_vocabulary())
    book = langid.pieces(rank_file)
    assert book.lengths[-1] > 24
    rng = np.random.default_rng(2)
    prob = rng.random((book.n, 2)) / book.n
    scorer = langid.Scorer(rank_file, prob)
    for text in ("reading", "für", "straße", "añadir", "zzxqy", "understanding", *LONG_WORDS):
        got, words = scorer.texts([text])
        assert words[0] == 1
        for k in range(2):
            assert got[0, k] == pytest.approx(all_segmentations(text.encode(), book, prob[:, k]), rel=1e-5)
    together, _ = scorer.texts([" ".join(LONG_WORDS), "reading"])
    assert together[0].tolist() == pytest.approx(sum(scorer.texts([w])[0][0] for w in LONG_WORDS).tolist(), rel=1e-5)
    endless, _ = langid.Scorer(rank_file, prob).texts(["x" * 20_000])
    assert np.isfinite(endless).all()


def test_expected_counts_add_up():
    book = langid.pieces(bpe.read_vocabulary(default_vocabulary()))
    words = [w.encode() for w in ("reading", "the", *LONG_WORDS)]
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(5)
    prob = rng.random(book.n) / book.n
    lengths = np.zeros(book.n)
    for length, _, piece in book.ending(data, starts, sizes):
        lengths[piece] = length
    total = langid.expected_counts(book, data, starts, sizes, prob, np.ones(len(words)))
    assert (total @ lengths) == pytest.approx(sizes.sum())      # every byte is used once
    # one word by brute force: the derivative of its total by each piece
    data, sizes = np.frombuffer(b"theist", np.uint8), np.array([6])
    total = langid.expected_counts(book, data, np.array([0]), sizes, prob, np.array([2.0]))
    for piece in np.flatnonzero(total).tolist():
        more = prob.copy()
        more[piece] *= 1 + 1e-6
        slope = (all_segmentations(b"theist", book, more) - all_segmentations(b"theist", book, prob)) / 1e-6
        assert total[piece] == pytest.approx(2 * slope, rel=1e-3, abs=1e-6)


def test_language_on_held_out_documents(documents):
    got = {r.doc_id: r for r in langid.identify(documents).collect()}
    own = [(got[r.doc_id].lang_pred, r.lang) for r in documents.collect() if is_held_out(r.doc_id)]
    assert sum(p == q for p, q in own) >= 0.95 * len(own) and len(got) == documents.count()


def test_language_of_awkward_rows(spark, edge_docs, no_docs):
    rows = langid.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    texts = {r.doc_id: r.text for r in edge_docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            has_letter = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not has_letter) and (r.score == 0) == (not has_letter)
            assert 0 <= r.score <= 1
    assert langid.identify(no_docs).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()] == [("und", 0.0)]
    kept = langid.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and 3 not in {r.doc_id for r in kept.collect()}


# ---- toxicity -------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_lookup_finds_all_terms_within_one_edit():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcä"), rng.integers(3, 8))) for _ in range(400)]
    terms = {w: 1.0 + k for k, w in enumerate(sorted(set(words[:40])))}
    lex = toxicity.Lexicon(terms, set())
    for w in words[40:]:
        near = [v for t, v in terms.items() if len(t) >= toxicity.FUZZY_FROM and distance(w, t) <= 1]
        want = (terms[w], True) if w in terms else (max(near, default=0.0) if len(w) >= 3 else 0.0, False)
        assert lex.match(w) == want
        data = np.frombuffer(w.encode(), np.uint8)
        if near:
            assert lex.may_hit(data, np.array([0]), np.array([len(data)]))[0]


def swap_distance(a, b):
    """As ``distance``, two swapped neighbours being one edit."""
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_edits_grow_with_the_term():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcä"), rng.integers(3, 11))) for _ in range(700)]
    terms = {w: 1.0 + k for k, w in enumerate(sorted(set(words[:60])))}
    lex = toxicity.Lexicon(terms, set(), growing=True)
    tried = set()
    for w in words[60:]:
        near = [v for t, v in terms.items() if len(t) >= 4 and swap_distance(w, t) <= (2 if len(t) >= 7 else 1)]
        tried |= {len(t) for t in terms if swap_distance(w, t) == 2 and len(t) >= 7}
        want = (terms[w], True) if w in terms else (max(near, default=0.0) if len(w) >= 3 else 0.0, False)
        assert lex.match(w) == want
        data = np.frombuffer(w.encode(), np.uint8)
        if near or w in terms:
            assert lex.may_hit(data, np.array([0]), np.array([len(data)]))[0]
    assert len(tried) > 2


def test_common_misspellings_are_hits():
    terms = dict.fromkeys(["idiot", "stupid", "moron", "worthless", "disgusting", "fag"], 2.0)
    m = toxicity.Matcher(toxicity.Lexicon(terms, set(), growing=True))
    bad = ["idoit", "stupdi", "m0r0n", "w0rthles", "disgsuting", "1d10t", "fag"]
    h = m.hits([*bad, "studio", "minor", "worth", "discuss it", "fog"])
    assert sorted(h.doc) == list(range(len(bad))) and [bool(x) for x in h.sort_values("doc").exact] == [False] * 6 + [True]


def test_windows_tell_quotation_from_abuse():
    m = toxicity.Matcher(toxicity.Lexicon({"scumbag": 2.0, "moron": 2.0}, {"morons"}))
    texts = ["You are a SCUMBAG, really, and a moron too.", 'They were called "scumbag" in the hall that day by all.',
             "He said scumbag once.", "You scumbaq!", "All morons here", "", "nothing at all"]
    h = m.hits(texts)
    rows = {(r.doc, texts[r.doc][int(r.start):int(r.end)].lower(), bool(r.exact), bool(r.told), bool(r.close)) for r in h.itertuples()}
    assert rows == {(0, "scumbag", True, False, True), (0, "moron", True, False, True), (1, "scumbag", True, True, False),
                    (2, "scumbag", True, True, False), (3, "scumbaq", False, False, False)}
    s = m.sums(texts)
    assert s[0, 0] > 0 and s[1, 0] == 0 < s[1, 2] and s[3, 1] > 0 and not s[4:].any()


def test_terms_among_typographic_signs_are_hits():
    m = toxicity.Matcher(toxicity.Lexicon(dict.fromkeys(["idiot", "moron", "stupid", "scumbag", "дурак"], 2.0), set(), growing=True))
    plain = ["“idiot", "You idiot!”", "idiot—you", "idiot/moron", "you\u00a0idiot\u00a0there", "Ты—дурак!", "scum-bag", "st*pid",
             "You’re an idiot, aren’t you"]
    told = ["“idiot”", "«idiot»", "‘idiot’", "„idiot“", "He got “You idiot!” for it", "« idiot »"]
    h = m.hits([*plain, *told, "—“”—", "...", "re-read"])
    assert set(h.doc) == set(range(len(plain) + len(told))) and len(h) == len(plain) + len(told) + 1
    assert set(h.doc[h.told]) == set(range(len(plain), len(plain) + len(told)))
    assert set(h.doc[h.close]) == {3} and set(h.doc[~h.exact.astype(bool)]) == {6, 7}
    r = h[h.doc == 5].iloc[0]
    assert "Ты—дурак!".lower().encode()[int(r.start):int(r.end)].decode() == "дурак"


def test_toxicity_on_held_out_labels(documents, labels):
    got = {r.doc_id: r for r in toxicity.score(documents, labels).collect()}
    assert len(got) == documents.count()
    own = [(got[r.doc_id], r.toxic) for r in labels.collect() if is_held_out(r.doc_id)]
    assert sum(r.predicted == t for r, t in own) >= 0.93 * len(own)
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == is_held_out(d) for d, r in got.items())


def test_toxicity_of_awkward_rows(spark, edge_docs, no_docs, labels):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(edge_docs, none).collect()
    assert len(rows) == edge_docs.count() and all(r.predicted == 0 and r.score < 0.01 for r in rows)
    some = spark.createDataFrame([(1, 1), (2, 0), (8, 1), (7, 0), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.score(edge_docs, some).count() == edge_docs.count()
    assert toxicity.score(no_docs, labels).count() == 0
