"""Quality classifier: a naive Bayes support vector machine.

A document is the set of its n-grams over four alphabets: character four-grams
and one- and two-grams of words (runs of letters and digits) of the lower-cased
text; four-grams of byte classes (letters by case, digits, bytes above 127;
punctuation and blanks as themselves); and one- to three-grams of word shapes
(case, length, how the word ends, whether it repeats one of the two words
before). Indicators are scaled by the classes' log-count ratios and one linear
hinge-loss model is fit to the whole sample by dual coordinate descent; a
logistic curve on the margins gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LETTER, NUMBER, _class_table
from .common import (STEP_BYTES, bounded_sample, cut, distinct, held_out, join_texts, lean, lower_bytes, may_learn, mix64, of_text,
                     read_documents, read_labels, slice_hashes, text_blocks, word_slices)

#: n-grams are hashed to this many features.
FEATURES = 1 << 18
#: Labelled rows that are learnt from, about, at most (see ``bounded_sample``).
SAMPLE = 12_000
#: Weight of the log-count ratios' own direction left in the model, and the
#: cost of a margin error.
INTERPOLATION, COST, EPOCHS = 0.25, 0.1, 12
THRESHOLD = 0.7


def _byte_classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    for a, b, c in ((48, 57, 48), (65, 90, 65), (97, 122, 97), (128, 255, 128)):
        table[a:b + 1] = c
    return table


_CLASSES = _byte_classes()


def features(texts: list[str]) -> np.ndarray:
    """Indicator matrix (texts x FEATURES, bool), for a few texts."""
    out = np.zeros((len(texts), FEATURES), bool)
    out[active(texts)] = True
    return out


def active(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, feature) of all n-grams, distinct and in order."""
    found = [*shape_grams(texts), *letter_grams(texts)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = np.uint32 if len(texts) * FEATURES <= 1 << 32 else np.int64
    both = distinct(np.concatenate([(doc * FEATURES + (mix64(code) >> np.uint64(46)).astype(np.int64)).astype(kind)
                                    for doc, code in found])).astype(np.int64)
    return both // FEATURES, both % FEATURES


def letter_grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, code) of the character four-grams and of the one- and two-grams
    of words, of the lower-cased texts."""
    lowered = [t.lower() for t in texts]
    data, starts = join_texts(lowered)
    cps = np.frombuffer("".join(f"{t} " for t in lowered).encode("utf-32-le"), np.uint32)
    byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(byte, starts)      # of each text, in code points
    if len(cps) >= 4:
        c = cps.astype(np.uint64)
        code = mix64(c[:-3] | c[1:-2] << np.uint64(21) | c[2:-1] << np.uint64(42)) + c[3:]
        doc = of_text(np.arange(len(code)), first)
        inside = np.arange(len(code)) + 3 < first[doc + 1] - 1
        yield doc[inside], code[inside] ^ np.uint64(1 << 62)
    cls = _class_table()[cps]
    edge = np.flatnonzero(np.diff((cls == LETTER) | (cls == NUMBER), prepend=False))      # the last one is a blank
    a, b = byte[edge[0::2]], byte[edge[1::2]]
    if len(a):
        doc = of_text(a, starts)
        h = slice_hashes(data, a, b)
        yield doc, mix64(h + np.uint64(1 << 50))
        whole = doc[1:] == doc[:-1]
        yield doc[1:][whole], (mix64(h[:-1] + np.uint64(1 << 51)) ^ h[1:])[whole]


def shape_grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, code) of the n-grams of byte classes and of word shapes."""
    data, starts = join_texts(texts)
    cls = _CLASSES[data]
    if len(data) >= 4:
        code = cls[:-3] | cls[1:-2] << np.uint64(8) | cls[2:-1] << np.uint64(16) | cls[3:] << np.uint64(24)
        change = np.ones(len(code), bool)      # equal neighbours say nothing new
        change[1:] = code[1:] != code[:-1]
        at = np.flatnonzero(change)
        doc = of_text(at, starts)
        inside = at + 3 < starts[doc + 1]
        yield doc[inside], code[at[inside]]
    a, b = word_slices(data)
    if not len(a):
        return
    doc = of_text(a, starts)
    low = slice_hashes(lower_bytes(data), a, b)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    small = np.concatenate([[0], np.cumsum(((data >= 97) & (data <= 122)) | (data >= 128))])
    n_up, n_low = upper[b] - upper[a], small[b] - small[a]
    size = b - a
    case = np.where(n_up + n_low == 0, 0, np.where(n_up == 0, 1, np.where(n_low == 0, 2, np.where(n_up == 1, 3, 4))))
    last = cls[b - 1]
    twice = (size >= 2) & (data[b - 1] == data[np.maximum(b - 2, 0)])
    again = np.zeros(len(a), np.int64)
    for k in (2, 1):
        same = np.zeros(len(a), bool)
        same[k:] = (low[k:] == low[:-k]) & (doc[k:] == doc[:-k])
        again[same] = k
    shape = (case.astype(np.uint64) | last << np.uint64(3) | twice.astype(np.uint64) << np.uint64(11)
             | again.astype(np.uint64) << np.uint64(12)
             | np.digitize(size, (3, 7, 13, 21)).astype(np.uint64) << np.uint64(14)) + np.uint64(1)
    gram = np.zeros(len(a), np.uint64)
    for n in (1, 2, 3):
        gram = mix64(gram[:len(a) - n + 1] + np.uint64(n)) ^ shape[n - 1:]
        whole = doc[:len(a) - n + 1] == doc[n - 1:]
        yield doc[:len(a) - n + 1][whole], gram[whole] + np.uint64(n << 40)


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights (over scaled indicators) and bias of the hinge-loss model;
    ``rows``: active features of each document, ``labels``: -1 or 1."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    diag = np.array([float(scale[f] @ scale[f]) + 1.0 for f in rows])
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f = rows[i]
            x = scale[f]
            y = labels[i]
            g = y * (float(w[f] @ x) + bias) - 1.0
            new = min(cost, max(0.0, alpha[i] - g / diag[i]))
            step = (new - alpha[i]) * y
            if step:
                alpha[i] = new
                w[f] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score's curve (Newton steps with a little
    ridge; labels 0 or 1)."""
    n1 = label.sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (len(label) - n1 + 2))
    t = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * t
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        t -= step
        if abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> tuple[np.ndarray, float, float, float]:
    """(weights over indicators, bias, slope, offset) learnt from the labels
    whose documents may be learnt from. Null labels are no labels. Without both
    classes the model is the constant (ones + 1) / (labels + 1)."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & may_learn(F.col("_id")))
    chosen = F.broadcast(bounded_sample(marked, F.col("_id"), sample))      # bounded by `sample`
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in text_blocks(batch, limit=STEP_BYTES):
                doc, feature = active(own)
                upto = np.searchsorted(doc, np.arange(len(own) + 1))
                found = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("label"), found], names=["_id", "label", "found"])

    rows = cut(texts.mapInArrow(lean(grams), "_id long, label int, found array<int>"))
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, n):
        share = (ones + 1) / (n + 1)
        return np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / max(1 - share, 1e-9)))

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, n = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        for frame in frames:
            for label, found in zip(frame.label, frame.found, strict=True):
                n[found] += 1
                p[found] += label
        f = np.flatnonzero(n)
        yield pd.DataFrame({"f": f, "p": p[f], "n": n[f]})

    # one row per feature, at most FEATURES
    counts = rows.mapInPandas(lean(tally), "f int, p long, n long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).toPandas()
    pos, neg = np.ones(FEATURES), np.ones(FEATURES)
    pos[counts.f] += counts.p
    neg[counts.f] += counts.n - counts.p
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    known = np.zeros(FEATURES, bool)
    known[counts.f] = True
    ratio[~known] = 0.0

    scale = spark.sparkContext.broadcast(ratio)

    def fit_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, own, found = [], [], []
        for frame in frames:
            ids += frame["_id"].tolist()
            own += frame.label.tolist()
            found += [np.array(x, np.int32) for x in frame.found]
        order = np.argsort(np.array(ids, np.int64), kind="stable").tolist()
        w, bias = dual_coordinate_descent([found[k] for k in order], scale.value, np.array([1.0 if own[k] == 1 else -1.0 for k in order]))
        w = INTERPOLATION * w + (1 - INTERPOLATION) * np.abs(w).mean()      # an even weight: the ratios' own direction
        yield pd.DataFrame({"w": [w * scale.value], "bias": [bias]})

    # one task: the descent goes through the sample row by row
    model = rows.coalesce(1).mapInPandas(lean(fit_all), "w array<double>, bias double").first()
    w, bias = np.array(model.w), model.bias
    weights = spark.sparkContext.broadcast(w)

    def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"label": f.label, "m": [float(weights.value[x].sum()) + bias for x in f.found]})

    seen = rows.mapInPandas(lean(margins), "label int, m double").toPandas()      # two numbers a sampled row
    slope, offset = logistic_curve(seen.m.to_numpy(float), seen.label.to_numpy(float))
    return w, bias, slope, offset


def _scorer(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str):
    """Function from texts to scores, fit to the labels."""
    w, bias, slope, offset = fit(docs, labels, sample, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(w.astype(np.float32))      # FEATURES numbers

    def scores(texts: list[str]) -> np.ndarray:
        doc, feature = active(texts)
        m = np.bincount(doc, model.value[feature], len(texts)) + bias
        return 1 / (1 + np.exp(-np.clip(slope * m + offset, -50, 50)))

    return scores


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Null text is empty; an
    empty text is scored by the bias alone."""
    scores = _scorer(docs, labels, sample, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, limit=STEP_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores(texts))], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lean(run), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least THRESHOLD, all columns."""
    scores = _scorer(docs, labels, sample, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, text_col, STEP_BYTES):
                yield part.filter(pa.array(scores(texts) >= THRESHOLD))

    return docs.mapInArrow(lean(run), docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_documents(spark, sf_dir), read_labels(spark, sf_dir))
