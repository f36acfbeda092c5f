"""Spelling variants: near words of a vocabulary by finite-state composition.

The vocabulary's minimised acceptor is composed with a transducer of exactly
one edit and with the acceptor again; the accepted pairs are the near words.
The composition is cut into partitions by its initial state: the pairs of a
partition have read the same first letters without an edit, make their edit
in a stretch of places, and end in the same letters. A pair of words with c
and c or c + 1 letters differs first at one place, the stretch that holds it
belongs to one partition of ``c``, so every pair is found once. Stretches are
the halves of c; one shared by many words is halved again until few share it
or it is one place, where the alphabet bounds the words. So each task builds
acceptors of few words whatever the size of the vocabulary, and the rest is
Spark's grouping and joins.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_documents, text_blocks

#: Fixed values of the task: the divisor that picks runs, least letters and
#: occurrences of a word, how much more frequent a word's form is.
PICK, LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 97, 5, 3, 2
#: UTF-8 of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased before.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Words that a task counts before it sends its counts on.
TASK_WORDS = 200_000
#: Words of a partition of the composition above which its stretch is halved.
GROUP_WORDS = 2048


# ---- words and their counts ---------------------------------------------------


def without_letter(run: bytes, place: int) -> bytes:
    letters = run.decode()
    return (letters[:place] + letters[place + 1:]).encode()


def letters_of(run: bytes) -> int:
    return len(run) - run.count(b"\xc3")


def words_of(doc_id: int | None, text: str) -> Counter:
    """The runs of a text, some with a letter deleted (see ``word_counts``)."""
    out = Counter()
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower())).items():
        h = zlib.crc32(run, salt)
        if h % PICK == 0:
            run = without_letter(run, h % letters_of(run))
        if len(run) >= LEAST_LETTERS:
            out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n (occurrences) of all words with at least LEAST_LETTERS letters
    and LEAST_COUNT occurrences. A run of letters whose crc32 with its document's
    id (null: empty) is a multiple of PICK loses one letter, a misspelling."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()

        def told() -> pa.RecordBatch:
            words = [w for w in counts if letters_of(w) >= LEAST_LETTERS]
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()),
                                              pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part, texts in text_blocks(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    counts.update(words_of(doc_id, text))
                    if len(counts) > TASK_WORDS:
                        yield told()
        yield told()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# ---- acceptor and composition --------------------------------------------------


class Acceptor:
    """Minimised acyclic acceptors of sets of words, states shared among all.
    State 0 accepts nothing but the empty word's end; a state is (edges, final)."""

    def __init__(self) -> None:
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], tuple[str, ...]] = {}

    def _state(self, edges: dict[str, int], final: bool) -> int:
        """The one state with these edges: equal right languages are one state."""
        key = (final, *edges.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.edges)
            self.edges.append(edges)
            self.final.append(final)
        return found

    def add(self, words: Iterable[str]) -> int:
        """Initial state of the acceptor of the sorted, distinct ``words``: what
        the last word doesn't share with the next is final and minimised."""
        path: list[tuple[str, dict[str, int]]] = [("", {})]
        ends, last = [False], ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                letter, edges = path.pop()
                path[-1][1][letter] = self._state(edges, ends.pop())

        for word in words:
            shared = 0
            while shared < len(last) and shared < len(word) and last[shared] == word[shared]:
                shared += 1
            close(shared)
            for letter in word[shared:]:
                path.append((letter, {}))
                ends.append(False)
            ends[-1] = True
            last = word
        close(0)
        return self._state(path[0][1], ends[0])

    def common(self, a: int, b: int) -> tuple[str, ...]:
        """Words accepted from both states: the composition after the edit."""
        key = (a, b) if a < b else (b, a)
        found = self._common.get(key)
        if found is None:
            out = [""] if self.final[a] and self.final[b] else []
            for letter, to in self.edges[a].items():
                other = self.edges[b].get(letter)
                if other is not None:
                    out += [letter + rest for rest in self.common(to, other)]
            found = self._common[key] = tuple(out)
        return found

    def pairs(self, start: int, letters: int, at_end: bool = True) -> Iterator[tuple[str, str]]:
        """Pairs (u, v) accepted from ``start`` that are one edit apart: u has
        ``letters`` letters, v as many or one more. The edit is at the first
        place where they differ, so a pair comes once; with ``at_end``, also
        right behind u."""
        open_ = [(start, "")]
        while open_:
            state, read = open_.pop()
            edges = list(self.edges[state].items())
            for k, (letter, to) in enumerate(edges):
                # v has a further letter here, and u goes on otherwise
                for rest in self.common(state, to) if at_end or len(read) < letters else ():
                    if len(read) + len(rest) == letters and not rest.startswith(letter):
                        yield read + rest, read + letter + rest
                # u has another letter here
                for other, there in edges[k + 1:]:
                    for rest in self.common(to, there):
                        if len(read) + 1 + len(rest) == letters:
                            yield read + letter + rest, read + other + rest
                open_.append((to, read + letter))


def near_in(group: list[tuple[str, int]], letters: int, start: int, stop: int) -> list[tuple[str, int, str, int]]:
    """(u, n_u, v, n_v) of the near words of a partition: ``letters`` (those of
    the shorter word), and the stretch of places where they differ first."""
    counts = dict(group)
    found: dict[tuple[str, str], list[str]] = defaultdict(list)
    for word in counts:
        end = len(word) - (letters - stop)
        found[word[:start], word[end:]].append(word[start:end])
    acceptor, out = Acceptor(), []
    for (head, tail), middles in found.items():
        if len(middles) > 1:
            for u, v in acceptor.pairs(acceptor.add(sorted(middles)), stop - start, stop == letters):
                u, v = head + u + tail, head + v + tail
                out.append((u, counts[u], v, counts[v]))
    return out


# ---- Spark steps ---------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, letters, start, stop) with the key of their partition."""
    return rows.withColumn("key", F.expr("xxhash64(letters, start, stop, left(word, start),"
                                         " substring(word, length(word) - (letters - stop) + 1))"))


def partitions(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n, letters, start, stop, key: every word in all the partitions of
    the composition that hold another one."""
    # a word is the shorter, or as long as the other, and perhaps the longer by one
    halves = words.selectExpr("word", "n", "explode(array(length(word), length(word) - 1)) AS letters").selectExpr(
        "word", "n", "letters", "inline(array(struct(0 AS start, letters DIV 2 AS stop), struct(letters DIV 2 AS start, letters AS stop)))")
    rows, done = cut(_keyed(halves)), None
    while True:
        # a pair's shorter word has ``letters`` letters
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.expr("length(word) = letters")).alias("short")).filter(
            "size > 1 AND short > 0").drop("short")
        rows = cut(rows.join(sizes, "key"))
        many = f"size > {group_words} AND stop - start > 1"
        fine = rows.filter(f"NOT ({many})").drop("size")
        done = fine if done is None else done.unionByName(fine)
        large = rows.filter(many).drop("size")
        if large.isEmpty():
            return done
        rows = cut(_keyed(large.selectExpr(
            "word", "n", "letters", "inline(array(struct(start, (start + stop) DIV 2 AS stop), struct((start + stop) DIV 2 AS start, stop)))")))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n, near, near_n: every two of the distinct ``words`` (word, n)
    that differ by exactly one letter, in both directions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, shape = None, [], None

        def close() -> pa.RecordBatch:
            found = near_in(group, *shape)
            both = [*found, *[(v, m, u, n) for u, n, v, m in found]]
            return pa.RecordBatch.from_arrays([pa.array([p[c] for p in both], t) for c, t in enumerate(
                (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["word", "n", "near", "near_n"])

        for batch in batches:
            for k, word, n, *of in zip(*[batch.column(c).to_pylist() for c in ("key", "word", "n", "letters", "start", "stop")], strict=True):
                if (k, of) != (key, shape):
                    if len(group) > 1:
                        yield close()
                    key, group, shape = k, [], of
                group.append((word, n))
        if len(group) > 1:
            yield close()

    order = ["key", "letters", "start"]
    return (partitions(words, group_words).repartition(*order).sortWithinPartitions(*order)
            .select("key", "word", "n", "letters", "start", "stop").mapInArrow(run, "word string, n long, near string, near_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of ``forms`` (word, form): the last word that forms lead to.
    Every round follows as many steps as all rounds before; forms at least
    double in count, so chains are short."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = cut(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                        F.col("further").isNotNull().alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct ``words`` (word, n):
    how many near words, the near word of largest n (ties: the smallest in
    code-point order) if it has at least FORM_RATIO times the word's n, and
    where forms lead to. An empty vocabulary gives no rows."""
    words = cut(words)
    best = near_words(words, group_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    formed = cut(words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"-best.col1 >= {FORM_RATIO} * n AS has", "best.near AS near", "-best.col1 AS near_n")
        .selectExpr("word", "n", "n_near", "IF(has, near, NULL) AS form", "IF(has, near_n, NULL) AS form_n"))
    ends = roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the vocabulary of whole texts. Null and empty texts have
    no words; rows that repeat count each; an empty table gives no rows."""
    return variants(word_counts(docs, id_col, text_col))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(read_documents(spark, sf_dir))
