"""Toxicity: abuse terms, also misspelled ones, and the words around them.

The lexicon is learnt: words that labelled toxic documents use in far more
different contexts than clean ones do (contexts, not documents: copies of one
text count once). A trie holds its terms; a word of a text is looked up by
walking the trie together with the word's Levenshtein automaton, which finds
all terms within one edit, or two of long terms; two swapped letters are one
edit, and a digit that looks like the term's letter is none. Variants that
clean text itself uses are no hits.
Every hit is weighed by a window of words around it: quoted or reported terms
count apart from plain abuse, hits close to other hits count more. A logistic
model over these sums gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LETTER, NUMBER, SPACE, HashIndex, _class_table
from .common import (bounded_sample, cut, held_out, join_texts, may_learn, mix64, of_text, read_documents, read_labels,
                     slice_hashes, text_blocks, word_slices)

#: Labelled rows that are learnt from, about, at most.
SAMPLE = 40_000
#: A term is used in this many contexts of toxic documents at least, and this
#: many times as often there as in clean ones. The sample bounds the lexicon.
LEAST_CONTEXTS, LEAST_RATIO = 6, 8.0
#: Terms of this many letters or more are found within one edit, and, in a
#: lexicon with a growing bound, of this many or more within two.
FUZZY_FROM, TWO_FROM = 4, 7
#: Digits and the letters that they stand for
ALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
#: Words before and after a hit that are looked at.
WINDOW = 6
THRESHOLD = 0.3
CACHE_WORDS = 1_000_000
#: Words that introduce what others have said
REPORTING = ["said", "says", "say", "wrote", "called", "calls", "quoted", "quote", "term", "word", "reported", "dit", "disait", "mot",
             "sagte", "wort", "nannte", "dijo", "palabra"]
#: Marks that open or close a quotation
QUOTES = ['"', "“", "”", "„", "«", "»", "‘", "’"]


class Automaton:
    """Levenshtein automaton of a word: states are the word's positions with
    the edits left, reached by reading a candidate term. With ``loose``, two
    swapped neighbours are one edit (a third entry is set between them) and a
    digit is also any letter it looks like."""

    def __init__(self, word: str, edits: int = 1, loose: bool = False):
        self.word, self.edits, self.loose = word, edits, loose

    def _close(self, states: set[tuple[int, int, bool]]) -> frozenset[tuple[int, int, bool]]:
        """With the word's letters that the term leaves out."""
        out = set(states)
        for i, left, swapped in states:
            while left and i < len(self.word) and not swapped:
                i, left = i + 1, left - 1
                out.add((i, left, False))
        return frozenset(out)

    def _same(self, i: int, letter: str) -> bool:
        own = self.word[i]
        return own == letter or (self.loose and letter in ALIKE.get(own, ""))

    def start(self) -> frozenset[tuple[int, int, bool]]:
        return self._close({(0, self.edits, False)})

    def step(self, states: frozenset[tuple[int, int, bool]], letter: str) -> frozenset[tuple[int, int, bool]]:
        out = set()
        for i, left, swapped in states:
            if swapped:      # the word's letter after this one has been read
                if self._same(i, letter):
                    out.add((i + 2, left, False))
                continue
            if i < len(self.word) and self._same(i, letter):
                out.add((i + 1, left, False))
            if left:
                out.add((i, left - 1, False))          # a letter that the word lacks
                if i < len(self.word):
                    out.add((i + 1, left - 1, False))  # another letter
                if self.loose and i + 1 < len(self.word) and self._same(i + 1, letter):
                    out.add((i, left - 1, True))
        return self._close(out) if out else frozenset()

    def used(self, states: frozenset[tuple[int, int, bool]]) -> int:
        """Edits between the word and the term read; more than the bound if
        there are none as few."""
        return min((self.edits - left for i, left, swapped in states if i == len(self.word) and not swapped), default=self.edits + 1)


def _folds() -> np.ndarray:
    """Code points below 128, those that may stand for each other as one."""
    table = np.arange(128, dtype=np.uint64)
    for digit, letters in ALIKE.items():
        table[[ord(digit), *map(ord, letters)]] = ord(letters[0])
    return table


_FOLDS = _folds()
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Variants of words that are hashed in one step, about.
VARIANTS = 1 << 18


def deletions(letters: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Hashes of words of one length (words x letters) without 0, 1, ... up to
    ``most`` (two) of their letters: words x ways to leave that many out."""
    m, n = letters.shape
    t = mix64(letters + np.uint64(1))
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    # sums before each letter, where d letters before it are left out
    sums = []
    for d in range(most + 1):
        p = np.zeros((m, n + 1), np.uint64)
        np.cumsum(t * powers[:n], axis=1, out=p[:, 1:])
        for _ in range(d):
            p *= inverse
        sums.append(p)

    def done(h: np.ndarray, size: int) -> np.ndarray:
        h = mix64(h + np.uint64((size + 1) * 0xD6E8FEB86659FD93 % 2**64))
        return (h - (h == np.uint64(2**64 - 1))).view(np.int64)

    yield done(sums[0][:, n:], n)
    if most >= 1 and n >= 1:
        i = np.arange(n)
        yield done(sums[0][:, i] + sums[1][:, n:] - sums[1][:, i + 1], n - 1)
    if most >= 2 and n >= 2:
        i, j = np.triu_indices(n, 1)
        yield done(sums[0][:, i] + sums[1][:, j] - sums[1][:, i + 1] + sums[2][:, n:] - sums[2][:, j + 1], n - 2)


class Lexicon:
    """Terms with weights in a trie; exceptions are words that are never a
    near hit. ``growing``: long terms are found within two edits, and swaps
    and look-alikes count as ``Automaton`` says; else all within one plain edit."""

    def __init__(self, terms: dict[str, float], exceptions: set[str], growing: bool = False):
        self.terms, self.exceptions, self.growing = terms, exceptions, growing
        self.trie: dict = {}
        for t in terms:
            node = self.trie
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t
        # A word within k edits (swaps too) of a term becomes equal to it if
        # at most k letters of either are left out.
        found: list[set[int]] = [set(), set(), set()]
        self.lengths: list[set[int]] = [set(), set(), set()]
        by_size: dict[int, list[str]] = {}
        for t in terms:
            by_size.setdefault(len(t), []).append(t)
        for n, own in by_size.items():
            k = self.bound(n)
            self.lengths[k].add(n)
            step = max(1, VARIANTS // (n * n + 1))
            for at in range(0, len(own), step):
                for h in deletions(self._letters("".join(own[at:at + step])).reshape(-1, n), k):
                    found[k].update(h.ravel().tolist())
        self.variants = []
        for keys in found:
            index = HashIndex(len(keys))
            index.put(np.array(sorted(keys), np.int64), np.zeros(len(keys), np.int32))
            self.variants.append(index)

    def bound(self, letters: int) -> int:
        """Edits allowed of a term with so many letters."""
        return 0 if letters < FUZZY_FROM else 2 if self.growing and letters >= TWO_FROM else 1

    @staticmethod
    def _letters(text: str) -> np.ndarray:
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        return np.where(cps < 128, _FOLDS[np.minimum(cps, np.uint64(127)).astype(np.intp)], cps)

    def may_hit(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), bool)
        if not len(starts):
            return out
        letters = self._letters(data.tobytes().decode("utf-8", "replace"))
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        first = at[starts]
        size = at[ends] - first
        for n in np.unique(size).tolist():
            reach = [k for k in range(3) if any(abs(n - m) <= k for m in self.lengths[k])]
            if not reach:
                continue
            rows = np.flatnonzero(size == n)
            step = max(1, VARIANTS // (n * n + 1))
            for lo in range(0, len(rows), step):
                own = rows[lo:lo + step]
                for d, h in enumerate(deletions(letters[first[own][:, None] + np.arange(n)], reach[-1])):
                    for k in reach:
                        if d <= k:
                            out[own] |= (self.variants[k].find(h.ravel()) >= 0).reshape(h.shape).any(1)
        return out

    def match(self, word: str) -> tuple[float, bool]:
        """(weight of the best term that the word is or misspells or 0, exact)."""
        if word in self.terms:
            return self.terms[word], True
        if len(word) < FUZZY_FROM - 1 or word in self.exceptions:
            return 0.0, False
        automaton, best = Automaton(word, 2 if self.growing else 1, self.growing), 0.0
        stack = [(self.trie, automaton.start())]
        while stack:
            node, states = stack.pop()
            term = node.get("")
            if term is not None and len(term) >= FUZZY_FROM and automaton.used(states) <= self.bound(len(term)):
                best = max(best, self.terms[term])
            for c, child in node.items():
                if c and (to := automaton.step(states, c)):
                    stack.append((child, to))
        return best, False


class Words:
    """The words of a block of texts, lower-cased: runs of letters and digits
    of any script, and, where signs stand inside a run without white space, also
    the whole run from its first letter to its last (``joined``)."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        self.data, self.at = join_texts(lowered)
        self.cps = np.frombuffer("".join(f"{t} " for t in lowered).encode("utf-32-le"), np.uint32)
        cls = _class_table()[self.cps]
        self.wordy = (cls == LETTER) | (cls == NUMBER)
        # ends of words and of runs without white space; the last code point is a blank
        edge = np.flatnonzero(np.diff(self.wordy, prepend=False))
        self.first, self.last = edge[0::2], edge[1::2]      # in code points
        run = np.cumsum(cls == SPACE)[self.first] if len(edge) else edge[0::2]
        opens = np.flatnonzero(np.diff(run, prepend=-1))
        closes = np.append(opens[1:], len(run))[:len(opens)]
        several = closes - opens > 1
        self.opens, self.closes = opens[several], closes[several]      # words of each joined run: from, to
        byte = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        self.starts, self.ends = byte[self.first], byte[self.last]
        self.joined = self.starts[self.opens], self.ends[self.closes - 1]

    def quotes_upto(self) -> np.ndarray:
        """Quotation marks before each code point; ' set as ‘ or ’ inside a word isn't one."""
        mark = np.isin(self.cps, _QUOTE_POINTS)
        inside = np.isin(self.cps, _APOSTROPHES)
        inside[1:] &= self.wordy[:-1]
        inside[:-1] &= self.wordy[1:]
        return np.concatenate([[0], np.cumsum(mark & ~inside)])


_QUOTE_POINTS = [ord(q) for q in QUOTES]
_APOSTROPHES = [ord("‘"), ord("’")]
SUMS = ["plain", "near", "told", "close", "share"]


class Matcher:
    """Hits of texts, words kept as they are met."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self._forget()
        data = "".join(f"{w} " for w in REPORTING).encode()
        raw = np.frombuffer(data, np.uint8)
        a, b = word_slices(raw)
        self.reporting = np.sort(slice_hashes(raw, a, b).view(np.int64))

    def _forget(self) -> None:
        self.seen = HashIndex(1 << 16)      # 0: no hit, else 1 + index in found
        self.found: list[tuple[float, bool]] = []

    def _learn(self, keys: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        value = np.zeros(len(keys), np.int32)
        for k in np.flatnonzero(self.lexicon.may_hit(data, a, b)).tolist():
            weight, exact = self.lexicon.match(data[a[k]:b[k]].tobytes().decode("utf-8", "replace"))
            if weight > 0:
                self.found.append((weight, exact))
                value[k] = len(self.found)
        self.seen.put(keys, value)

    def hits(self, texts: list[str]) -> pd.DataFrame:
        """doc (index of the text), start, end (in the lower-cased text's
        bytes), weight, exact, told (quoted or reported), close (another hit
        in the window)."""
        words = Words(texts)
        data, at = words.data, words.at
        n = len(words.starts)
        a, b = (np.concatenate(x) for x in zip((words.starts, words.ends), words.joined, strict=True))
        empty = pd.DataFrame({"doc": np.zeros(0, np.int64), "start": [], "end": [], "weight": [], "exact": [], "told": [], "close": []})
        if not len(a):
            return empty
        keys = slice_hashes(data, a, b).view(np.int64)
        if self.seen.size > CACHE_WORDS:
            self._forget()
        entry = self.seen.find(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            self._learn(new, data, a[where], b[where])
            entry[missing] = self.seen.find(keys[missing])
        # a joined run counts if none of its words is a hit
        upto = np.concatenate([[0], np.cumsum(entry[:n] > 0)])
        entry[n:][upto[words.closes] > upto[words.opens]] = 0
        hit = np.flatnonzero(entry > 0)
        if not len(hit):
            return empty
        hit = hit[np.argsort(a[hit], kind="stable")]
        run = hit >= n
        first = np.where(run, np.append(words.opens, 0)[np.where(run, hit - n, -1)], hit)      # words that the hit spans
        last = np.where(run, np.append(words.closes, 0)[np.where(run, hit - n, -1)] - 1, hit)
        found = [self.found[k - 1] for k in entry[hit].tolist()]
        own = of_text(a[hit], at)
        told = self._told(words, keys[:n], first, last, own)
        gap = np.full(len(hit), 1 << 30)
        near = np.where(own[1:] == own[:-1], first[1:] - last[:-1], 1 << 30)
        gap[1:] = np.minimum(gap[1:], near)
        gap[:-1] = np.minimum(gap[:-1], near)
        return pd.DataFrame({"doc": own, "start": a[hit] - at[own], "end": b[hit] - at[own], "weight": [w for w, _ in found],
                             "exact": [x for _, x in found], "told": told, "close": gap <= WINDOW})

    def _told(self, words: Words, keys: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Quotation marks enclose the hit within its window, or a reporting
        word stands in the window before it."""
        of_doc = np.searchsorted(words.starts, words.at)      # words before each text
        lo = np.maximum(first - WINDOW, of_doc[doc])
        hi = np.minimum(last + WINDOW, of_doc[doc + 1] - 1)
        report = np.concatenate([[0], np.cumsum(np.isin(keys, self.reporting))])
        reported = report[first] > report[np.maximum(lo, first - 3)]
        # signs between a text's border or the word beyond the window and the hit
        marks = words.quotes_upto()
        text_at = np.searchsorted(np.flatnonzero((words.data & 0xC0) != 0x80), words.at)
        left = np.where(lo > of_doc[doc], words.last[np.maximum(lo - 1, 0)], text_at[doc])
        right = np.where(hi < of_doc[doc + 1] - 1, words.first[np.minimum(hi + 1, len(keys) - 1)], text_at[doc + 1])
        quoted = (marks[words.first[first]] > marks[left]) & (marks[right] > marks[words.last[last]])
        return reported | quoted

    def sums(self, texts: list[str]) -> np.ndarray:
        """Per text: weight of plain exact hits, of plain near hits, of told
        hits, of plain hits close to another, and plain weight per 100 words;
        on a log scale."""
        h = self.hits(texts)
        out = np.zeros((len(texts), len(SUMS)))
        if len(h):
            doc, w = h.doc.to_numpy(np.int64), h.weight.to_numpy(float)
            told, exact, close = (h[c].to_numpy(bool) for c in ("told", "exact", "close"))
            for k, on in enumerate((~told & exact, ~told & ~exact, told, ~told & close)):
                out[:, k] = np.bincount(doc, w * on, len(texts))
            size = np.array([len(t) for t in texts]) / 600 + 1
            out[:, 4] = (out[:, 0] + out[:, 1]) / size
        return np.log1p(out)


def word_contexts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, context hash, label) of the chosen documents, distinct."""
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in text_blocks(batch):
                found = Words(own)
                data, at = found.data, found.at
                a, b = found.starts, found.ends
                a, b = a[b - a >= 3], b[b - a >= 3]
                h = slice_hashes(data, a, b)
                # neighbours of words and of joined runs
                x, y = (np.concatenate(z) for z in zip((a, b), found.joined, strict=True))
                long = y - x >= 3
                x, y = x[long], y[long]
                if not len(x):
                    continue
                round_h = np.concatenate([h[-1:], h, h[:1]]) if len(h) else np.zeros(2, np.uint64)
                before, after = np.searchsorted(a, x), np.searchsorted(a, y)
                context = mix64(round_h[before] * np.uint64(3) + round_h[np.minimum(after + 1, len(round_h) - 1)])
                h, a, b = slice_hashes(data, x, y), x, y
                label = np.asarray(part.column("label"))[of_text(a, at)]
                _, first = np.unique(mix64(context ^ h) ^ label.astype(np.uint64), return_index=True)
                raw = data.tobytes()
                words = [raw[x:y].decode("utf-8", "replace") for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(context[first].view(np.int64)),
                                                  pa.array(label[first], pa.int32())], names=["word", "context", "label"])

    return texts.mapInArrow(run, "word string, context long, label int").distinct()


def learn_lexicon(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Terms and exceptions from labelled documents (_id, label)."""
    seen = cut(word_contexts(docs, chosen, id_col, text_col).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).filter("toxic > 0 OR clean > 1"))
    total = seen.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not total[0] or not total[1]:
        return Lexicon({}, set(), growing=True)
    ratio = ((F.col("toxic") + 0.5) / total[0]) / ((F.col("clean") + 0.5) / total[1])
    rated = seen.withColumn("ratio", ratio)
    top = (rated.filter((F.col("toxic") >= LEAST_CONTEXTS) & (F.col("ratio") >= LEAST_RATIO))
           .orderBy(F.col("toxic").desc(), "word").toPandas())      # terms of the bounded sample
    terms = dict(zip(top.word, np.log(top.ratio), strict=True))
    lexicon = Lexicon(terms, set(), growing=True)
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def clean_variants(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Lexicon(shared.value, set(), growing=True)
        for f in frames:
            if len(f):
                raw = [w.encode() for w in f.word]
                ends = np.cumsum([len(r) for r in raw])
                starts = np.concatenate([[0], ends[:-1]])
                f = f[own.may_hit(np.frombuffer(b"".join(raw), np.uint8), starts, ends)]
                f = f[np.array([own.match(w)[0] > 0 and w not in own.terms for w in f.word], bool)]
            yield f[["word"]]

    # words near a term that clean documents of the bounded sample use as readily
    common = rated.filter((F.col("clean") > 0) & (F.col("ratio") < LEAST_RATIO)).select("word")
    lexicon.exceptions |= set(common.mapInPandas(clean_variants, "word string").toPandas().word)
    return lexicon


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, the bias; hits can't speak for a clean text."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    t = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-2)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * t)
        t = t - step
        t[:-1] = np.maximum(t[:-1], 0.0)
        if abs(step).max() < 1e-7:
            break
    return t


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Null text is empty, and
    an empty text has the score of a text without hits. Without labels of both
    classes there is no lexicon: every score is ones / (labels + 1)."""
    marked = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & may_learn(F.col("_id")))
    chosen = F.broadcast(cut(bounded_sample(marked, F.col("_id"), sample)))      # bounded by `sample`
    spark = docs.sparkSession
    lexicon = learn_lexicon(docs, chosen, id_col, text_col)
    shared = spark.sparkContext.broadcast((lexicon.terms, lexicon.exceptions))

    def summed(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        matcher = Matcher(Lexicon(*shared.value, growing=True))
        for batch in batches:
            for part, texts in text_blocks(batch):
                yield part, matcher.sums(texts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in summed(batches, ["label"]):
            yield pa.RecordBatch.from_arrays([part.column("label"), *map(pa.array, x.T)], names=["label", *SUMS])

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id")
    seen = texts.mapInArrow(rows, "label int, " + ", ".join(f"{c} double" for c in SUMS)).toPandas()      # the sample's sums
    y = seen.label.to_numpy(float)
    if lexicon.terms:
        t = fit_logistic(seen[SUMS].to_numpy(float), y)
    else:
        share = y.sum() / (len(y) + 1)
        t = np.append(np.zeros(len(SUMS)), np.log(max(share, 1e-9) / (1 - share)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in summed(batches, []):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x @ t[:-1] + t[-1], -50, 50))))],
                                             names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_documents(spark, sf_dir), read_labels(spark, sf_dir))
