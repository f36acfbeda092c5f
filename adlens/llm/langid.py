"""Language identification by unigrams over all segmentations.

The pieces are the letter tokens of a fixed public vocabulary. Per language
every piece has a probability, learnt by one pass of piece counts and one of
expected counts (forward-backward). A word's probability in a language is the
sum over all its segmentations into pieces, by the forward algorithm over the
whole word, however long: it keeps the last positions that a piece can reach
back to, scaled so that nothing underflows. Segments don't cross word borders,
so a text's log-probability is the sum of its words', and a word's is worked
out once per worker (new words of a block together, position by position).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LETTER, HashIndex, _class_table, parse_ranks, read_vocabulary
from .bpe_codec import default_vocabulary
from .common import STEP_BYTES, cut, held_out, kept, lean, may_learn, read_documents, slice_hashes, text_blocks

#: Documents of each language that are learnt from, about, at most.
SAMPLE = 2_000
#: Words of like size that are scored together, at most, and positions after
#: which their probabilities are scaled.
TOGETHER, RESCALE = 4096, 8
#: Added to every piece's count, as a share of an even distribution.
SMOOTHING = 0.5
#: Words kept by a worker.
CACHE_WORDS = 1_000_000
UNKNOWN = "und"
#: Below this score a document's language counts as not told.
LEAST_SCORE = 0.5


class Pieces:
    """Letter pieces of the vocabulary: those that start a word (in the
    vocabulary with a blank before) and those inside one, told apart."""

    def __init__(self, rank_file: bytes):
        first, inner = set(), set()
        for t in parse_ranks(rank_file):
            own = t[1:] if t[:1] == b" " else t
            if own and all(97 <= b <= 122 or b >= 128 for b in own):
                (first if t[:1] == b" " else inner).add(own)
        single = {bytes([b]) for b in range(256)}
        entries = [(0, t) for t in sorted(first | single)] + [(1, t) for t in sorted(inner | single)]
        data = np.frombuffer(b"".join(t for _, t in entries), np.uint8)
        size = np.array([len(t) for _, t in entries])
        ends = np.cumsum(size)
        self.n = len(entries)
        self.lengths = np.unique(size)              # of pieces, in bytes
        keys = slice_hashes(data, ends - size, ends).view(np.int64)
        place = np.array([k for k, _ in entries])
        self.index = [HashIndex(self.n), HashIndex(self.n)]
        for k in (0, 1):
            self.index[k].put(keys[place == k], np.flatnonzero(place == k).astype(np.int32))

    def ending(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        """For every end position from 1 on: (length, word, piece) of all pieces
        that end there, word by word."""
        for end in range(1, int(sizes.max()) + 1):
            words = np.flatnonzero(sizes >= end)
            reach = self.lengths[:np.searchsorted(self.lengths, end, side="right")]
            b = np.repeat(starts[words] + end, len(reach))
            length = np.tile(reach, len(words))
            keys = slice_keys(data, b - length, b)
            opens = length == end
            piece = self.index[1].find(keys)
            piece[opens] = self.index[0].find(keys[opens])
            hit = np.flatnonzero(piece >= 0)
            yield length[hit], words[hit // len(reach)], piece[hit]


class _Prefix:
    """Hashes of many slices of the same bytes: prefix sums made once."""
    data = None


def slice_keys(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    from . import common
    if _Prefix.data is not data:
        up, _ = common._power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(common._TABLE[data] * up[:len(data)], out=sums[1:])
        _Prefix.data, _Prefix.sums = data, sums
    _, down = common._power_tables(len(data) + 1)
    h = (_Prefix.sums[b] - _Prefix.sums[a]) * down[a]
    h = common.mix64(h + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return (h - (h == np.uint64(2**64 - 1))).view(np.int64)


def like_sizes(sizes: np.ndarray, together: int = TOGETHER) -> Iterator[np.ndarray]:
    """Indices of words in groups of like size."""
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        # sizes up to a quarter more, and at most so many words
        hi = int(np.searchsorted(sizes[order], sizes[order[lo]] * 5 // 4 + 2, side="right"))
        hi = min(hi, lo + together)
        yield order[lo:hi]
        lo = hi


def log_totals(book: Pieces, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations, by word and language.

    Only the positions within reach of a piece are kept, in a ring, each word
    and language scaled by its own factor every RESCALE positions."""
    n_lang, ring = prob.shape[1], int(book.lengths[-1]) + 1
    alpha = np.zeros((ring, len(sizes), n_lang))
    alpha[0] = 1.0
    scale = np.zeros((len(sizes), n_lang))
    out = np.zeros((len(sizes), n_lang))
    for end, (length, word, piece) in enumerate(book.ending(data, starts, sizes), 1):
        now = alpha[end % ring]
        now[:] = 0.0
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        now[word[heads]] = np.add.reduceat(alpha[(end - length) % ring, word] * prob[piece], heads)
        done = np.flatnonzero(sizes == end)
        out[done] = np.log(now[done]) + scale[done]
        if end % RESCALE == 0:
            top = alpha.max(0)
            top[top == 0] = 1.0
            alpha /= top
            scale += np.log(top)
    return out


def expected_counts(book: Pieces, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, prob: np.ndarray,
                    weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words that occur ``weight`` times, in
    one language (``prob`` by piece)."""
    rows = list(book.ending(data, starts, sizes))
    words = np.arange(len(sizes))
    with np.errstate(divide="ignore"):
        lp = np.log(prob)
    alpha = np.full((len(rows) + 1, len(sizes)), -np.inf)
    alpha[0] = 0.0
    for end, (length, word, piece) in enumerate(rows, 1):
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        alpha[end, word[heads]] = np.logaddexp.reduceat(alpha[end - length, word] + lp[piece], heads)
    beta = np.full_like(alpha, -np.inf)
    beta[sizes, words] = 0.0
    total = alpha[sizes, words]
    out = np.zeros(book.n)
    for end in range(len(rows), 0, -1):
        length, word, piece = rows[end - 1]
        use = lp[piece] + beta[end, word]
        np.logaddexp.at(beta, (end - length, word), use)
        out += np.bincount(piece, np.exp(alpha[end - length, word] + use - total[word]) * weight[word], book.n)
    return out


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text index) of the runs of letters, lower-cased."""
    joined = "\n".join(t.lower() for t in texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    data = np.frombuffer(joined.encode(), np.uint8)
    letter = np.concatenate([[False], _class_table()[cps] == LETTER])
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    doc = np.searchsorted(ends, edge[0::2], side="right")
    if len(data) != len(cps):
        edge = np.flatnonzero((data & 0xC0) != 0x80)[edge]
    return data, edge[0::2], edge[1::2], doc


@functools.lru_cache(2)
def pieces(rank_file: bytes) -> Pieces:
    return Pieces(rank_file)


class Scorer:
    """Log-probabilities of words by language, kept as they are met."""

    def __init__(self, rank_file: bytes, prob: np.ndarray):
        self.pieces, self.prob = pieces(rank_file), prob
        self._forget()

    def _forget(self) -> None:
        self.seen = HashIndex(1 << 16)
        self.value = np.zeros((1 << 16, self.prob.shape[1]), np.float32)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        value = np.zeros((len(keys), self.prob.shape[1]))
        for own in like_sizes(ends - starts):
            value[own] = log_totals(self.pieces, data, starts[own], (ends - starts)[own], self.prob)
        first = self.seen.size
        while first + len(keys) > len(self.value):
            self.value = np.concatenate([self.value, np.zeros_like(self.value)])
        self.value[first:first + len(keys)] = value
        self.seen.put(keys, np.arange(first, first + len(keys), dtype=np.int32))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probability by text and language, number of words)."""
        data, starts, ends, doc = words_of(texts)
        out = np.zeros((len(texts), self.prob.shape[1]))
        if len(starts):
            keys = slice_keys(data, starts, ends)
            if self.seen.size > CACHE_WORDS:
                self._forget()
            entry = self.seen.find(keys)
            missing = np.flatnonzero(entry < 0)
            if len(missing):
                new, where = np.unique(keys[missing], return_index=True)
                where = missing[where]
                self._learn(new, data, starts[where], ends[where])
                entry[missing] = self.seen.find(keys[missing])
            for k in range(out.shape[1]):
                out[:, k] = np.bincount(doc, self.value[entry, k], len(texts))
        return out, np.bincount(doc, minlength=len(texts))


def fit(docs: DataFrame, vocabulary: str, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probability by piece and language), learnt from the rows
    with a language that may be learnt from, ``sample`` or so of each."""
    spark = docs.sparkSession
    rank_file = read_vocabulary(vocabulary)
    ids = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & may_learn(F.col("_id")))
    sizes = {r[0]: r[1] for r in ids.groupBy("lang").count().collect()}      # one row per language
    langs = sorted(sizes)
    n = pieces(rank_file).n
    if not langs:
        return [], np.zeros((n, 0))
    pick = F.lit(False)
    for lang in langs:
        share = min(1.0, sample / sizes[lang])
        pick = pick | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))))
    vocab = spark.sparkContext.broadcast(rank_file)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, limit=STEP_BYTES):
                data, a, b, doc = words_of(texts)
                raw = data.tobytes()
                frame = pd.DataFrame({"lang": np.array(part.column("lang").to_pylist(), object)[doc],
                                      "word": [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]})
                c = frame.groupby(["lang", "word"], sort=False).size()
                yield pa.RecordBatch.from_arrays([pa.array(c.index.get_level_values(0), pa.string()),
                                                  pa.array(c.index.get_level_values(1), pa.binary()),
                                                  pa.array(c.to_numpy(), pa.int64())], names=["lang", "word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = cut(rows.filter(F.col("lang").isNotNull() & may_learn(F.col("_id")) & pick).select("lang", "text")
                  .mapInArrow(lean(words), "lang string, word binary, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")))

    def uses(prob: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            book = pieces(vocab.value)
            total = np.zeros((n, len(langs)))
            for batch in batches:
                if not batch.num_rows:
                    continue
                lang = np.searchsorted(langs, np.array(batch.column("lang").to_pylist(), object))
                own = [bytes(w) for w in batch.column("word").to_pylist()]
                size = np.array([len(w) for w in own])
                ends = np.cumsum(size)
                data = np.frombuffer(b"".join(own), np.uint8)
                weight = batch.column("n").to_numpy().astype(float)
                for k in range(len(langs)):
                    mine = np.flatnonzero(lang == k)
                    for own in like_sizes(size[mine]):
                        take = mine[own]
                        a, length = (ends - size)[take], size[take]
                        if prob is None:
                            for _, w, piece in book.ending(data, a, length):
                                total[:, k] += np.bincount(piece, weight[take[w]], n)
                        else:
                            total[:, k] += expected_counts(book, data, a, length, prob[:, k], weight[take])
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[piece, k])],
                                             names=["piece", "k", "uses"])
        return run

    prob = None
    for _ in range(2):
        # at most pieces x languages rows
        got = counted.mapInArrow(lean(uses(prob)), "piece int, k int, uses double").groupBy("piece", "k").agg(
            F.sum("uses").alias("uses")).toPandas()
        total = np.zeros((n, len(langs)))
        total[got.piece, got.k] = got.uses
        total = np.round(total, 6) + SMOOTHING
        prob = total / total.sum(0)
    return langs, prob


def _identifier(docs: DataFrame, vocabulary: str | None, sample: int, id_col: str, text_col: str, lang_col: str):
    """Function from texts to (languages, scores), learnt from ``docs``."""
    vocabulary = vocabulary or default_vocabulary()
    langs, prob = fit(docs, vocabulary, sample, id_col, text_col, lang_col)
    model = docs.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary), prob.tobytes(), prob.shape))

    def predict(texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rank_file, raw, shape = model.value
        scorer = kept(hash(raw), lambda: Scorer(rank_file, np.frombuffer(raw).reshape(shape)))
        value, words = scorer.texts(texts)
        post = 1 / np.exp(value - value.max(1, keepdims=True)).sum(1)
        post[words == 0] = 0.0
        return [langs[b] if w else UNKNOWN for b, w in zip(value.argmax(1), words, strict=True)], post

    return predict


def identify(docs: DataFrame, vocabulary: str | None = None, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the predicted language
    under equal priors). Null text, text without a letter, and any text when no
    language could be learnt: `und`, score 0. Ties: the first by name."""
    predict = _identifier(docs, vocabulary, sample, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, limit=STEP_BYTES):
                pred, post = predict(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(post)],
                                                 names=["doc_id", "lang_pred", "score"])

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lean(run, tables=True), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, vocabulary: str | None = None, sample: int = SAMPLE, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of at least
    ``least``, all columns."""
    predict = _identifier(docs, vocabulary, sample, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, text_col, STEP_BYTES):
                pred, post = predict(texts)
                yield part.filter(pa.array([p != UNKNOWN and x >= least for p, x in zip(pred, post, strict=True)], pa.bool_()))

    return docs.mapInArrow(lean(run, tables=True), docs.schema)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_documents(spark, sf_dir))
