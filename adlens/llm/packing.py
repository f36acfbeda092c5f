"""Packing into fixed windows by dynamic programming.

Documents follow one another in id order; a window is a stretch of that line
of at most ``CONTEXT`` ids. Windows may end at document ends, sentence ends,
and, where a text goes on for long without either, at any of a row of places
inside it. With p the places and pen the penalty of cutting there,

    f(j) = min over i with p[j] - p[i] <= CONTEXT of
           f(i) + (CONTEXT - (p[j] - p[i])) + pen[j]

is the least padding plus truncation penalty up to place j. Apart from terms
of j alone this is the minimum of f(i) + p[i] over a sliding window, which a
monotone queue gives in constant time per place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder, added_tokens, encoder, read_vocabulary
from .common import lean, read_documents, text_blocks, text_steps

CONTEXT = 2048
#: Id that ends every document.
END_ID = 1
#: Cost, in padding ids, of ending a window inside a document.
SENTENCE_PENALTY, INNER_PENALTY = 4, 32
#: A stretch without a sentence end of more than this many ids gets places to cut.
LONG_STRETCH, INNER_STEP = 128, 64
#: The line is solved in stretches of this many ids; the last window of one
#: is open and goes on in the next. Bounds a task's memory.
STRETCH_IDS = 1 << 20
SENTENCE_ENDS = (b".", b"!", b"?", b"\n", "。".encode(), "！".encode(), "？".encode())


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def best_cuts(places: list[int], penalties: list[int], context: int) -> list[int]:
    """Indices of the chosen places, the last one included. ``places`` rise
    from above 0 with gaps of at most ``context``."""
    p = [0, *places]
    pen = [0, *penalties]
    n = len(p)
    value, origin = [0] * n, [0] * n      # value: f + p
    queue, head = [0], 0
    for j in range(1, n):
        least = p[j] - context
        while p[queue[head]] < least:
            head += 1
        i = queue[head]
        origin[j] = i
        v = value[i] + context + pen[j]
        value[j] = v
        while len(queue) > head and value[queue[-1]] >= v:      # ties: the later place, the fuller window
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(j - 1)
        j = origin[j]
    return out[::-1]


class Packer:
    """Packs one stretch of the line after the other."""

    def __init__(self, enc: Encoder, context: int, end_id: int, first_sequence: int):
        self.enc, self.context, self.end_id, self.sequence = enc, context, end_id, first_sequence
        ends = np.array([t.endswith(SENTENCE_ENDS) for t in enc.tokens])
        self.sentence = np.append(ends, False) if end_id >= len(ends) else ends
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []      # doc_id, its ids in all, first id here, ids here
        self.size = 0

    def add(self, doc_ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        coded = [self.enc.encode(own) for own in text_steps(texts)]
        ids, counts = (np.concatenate(x) for x in zip(*coded, strict=True))
        ends = np.cumsum(counts + 1) - 1
        line = np.full(len(ids) + len(texts), self.end_id, np.int32)
        inner = np.ones(len(line), bool)
        inner[ends] = False
        line[inner] = ids
        self.ids.append(line)
        self.docs += [(d, n, 0, n) for d, n in zip(doc_ids, (counts + 1).tolist(), strict=True)]
        self.size += len(line)
        if self.size >= STRETCH_IDS:
            yield self.solve(False)

    def solve(self, last: bool) -> pa.RecordBatch:
        line = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        here = np.array([d[3] for d in self.docs], np.int64)
        ends = np.cumsum(here)
        windows = self._windows(line, ends)
        if not last:      # the last window stays open
            windows = windows[:-1]
        done = int(windows[-1]) if len(windows) else 0
        marks = np.unique(np.concatenate([windows, ends[ends < done]])) if done else np.zeros(0, np.int64)
        starts = np.concatenate([[0], marks[:-1]]).astype(np.int64) if done else marks
        doc = np.searchsorted(ends, starts, side="right")
        window = np.searchsorted(windows, starts, side="right")
        opens = np.concatenate([[0], windows])[window] if done else marks
        first = np.array([d[2] for d in self.docs], np.int64) - (ends - here)
        raw = line.astype("<u4")
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), marks.tolist(), strict=True)]
        out = pa.RecordBatch.from_arrays(
            [pa.array([self.docs[k][0] for k in doc.tolist()], pa.int64()), pa.array((starts + first[doc]) if len(doc) else starts),
             pa.array(marks - starts), pa.array(crc, pa.int64()),
             pa.array([self.docs[k][1] for k in doc.tolist()], pa.int64()), pa.array(self.sequence + window),
             pa.array(starts - opens)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(windows)
        k = int(np.searchsorted(ends, done, side="right"))
        rest = self.docs[k:]
        if rest:
            d, n, a, m = rest[0]
            used = done - int(ends[k] - here[k])
            rest[0] = (d, n, a + used, m - used)
        self.docs, self.ids, self.size = rest, [line[done:]], len(line) - done
        return out

    def _windows(self, line: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ends of the windows of the whole stretch."""
        if not len(line):
            return np.zeros(0, np.int64)
        kind = np.zeros(len(line) + 1, np.int8)
        kind[1:][self.sentence[line]] = 2
        kind[len(line)] = 1
        kind[ends] = 1
        at = np.flatnonzero(kind)
        gaps = np.diff(np.concatenate([[0], at]))
        for k in np.flatnonzero(gaps > LONG_STRETCH).tolist():
            kind[at[k] - gaps[k] + INNER_STEP:at[k]:INNER_STEP] = 3
        at = np.flatnonzero(kind)
        cost = np.array([0, 0, SENTENCE_PENALTY, INNER_PENALTY])[kind[at]]
        return at[best_cuts(at.tolist(), cost.tolist(), self.context)]


def pack(docs: DataFrame, context: int = CONTEXT, end_id: int = END_ID, vocabulary: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens, sequence_id, offset (in its sequence).

    Null text is empty: the document is its end id alone. The vocabulary's added
    tokens are one id wherever their strings stand. Documents follow in
    id order (null ids first, rows of one id in text order); each range
    partition packs its own stretch of that order, numbering sequences from
    partition << 33. An empty table gives no rows."""
    path = vocabulary or default_vocabulary()
    vocab = docs.sparkSession.sparkContext.broadcast((read_vocabulary(path), added_tokens(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(encoder(*vocab.value), context, end_id, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for part, texts in text_blocks(batch):
                yield from packer.add(part.column("doc_id").to_pylist(), texts)
        if packer.docs:
            yield packer.solve(True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        lean(run, tables=True), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir))
