"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes cuts a text where its value is -1 modulo the
block size, so an edit moves only the cuts around it. Every piece gives one
letter (six bits of its hash); the letters at a block size and at twice that
size make the fingerprint ``block:letters:letters``. Block sizes are 3 * 2^k;
the smallest that needs at most 64 letters is taken, halved while it gives
fewer than 32. The 64th letter covers all that is left, so the whole text
counts. Fingerprints are compared by edit distance at equal block sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_documents, slice_hashes

ROLL = 7
LETTERS = 64
SMALLEST = 3
#: Letters that two fingerprints must share in a row to be alike at all.
RUN = 7
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last ROLL bytes (fewer at the start) at every byte."""
    out = np.zeros(len(data), np.uint32)
    factor = np.uint32(1)
    wide = data.astype(np.uint32) + np.uint32(1)
    for k in range(ROLL):
        out[k:] += wide[:max(0, len(wide) - k)] * factor
        factor = np.uint32(int(factor) * 0x01000193 % (1 << 32))
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return out ^ out >> np.uint32(13)


def _letters(data: np.ndarray, cuts: np.ndarray) -> str:
    """One letter per piece; the cuts are the pieces' last bytes."""
    ends = cuts[:LETTERS - 1] + 1
    if not len(ends) or ends[-1] < len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1]])
    return ALPHABET[(slice_hashes(data, starts, ends) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block:letters:letters`` of a text; the empty text's is ``3::``."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{SMALLEST}::"
    roll = rolling(data)
    block = SMALLEST
    while block * LETTERS < len(data):
        block *= 2
    at = {b: np.flatnonzero(roll % np.uint32(b) == b - 1) for b in (block, 2 * block)}
    while block > SMALLEST and len(at[block]) < LETTERS // 2:
        block //= 2
        at[block] = np.flatnonzero(roll % np.uint32(block) == block - 1)
    return f"{block}:{_letters(data, at[block])}:{_letters(data, at[2 * block])}"


def _alike(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, 0 if both have RUN letters or more
    and share no run of RUN."""
    longer = F.greatest(F.length(a), F.length(b))
    plain = F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longer)

    def runs(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(x) - (RUN - 1)), lambda k: F.substring(x, k, F.lit(RUN)))

    enough = (F.length(a) >= RUN) & (F.length(b) >= RUN)
    return F.when(~enough, plain).when(F.arrays_overlap(runs(a), runs(b)), plain).otherwise(F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two fingerprints: 1 if equal, 0 if their block
    sizes are neither equal nor one twice the other."""
    pa_, pb = F.split(a, ":"), F.split(b, ":")
    ba, bb = pa_[0].cast("bigint"), pb[0].cast("bigint")
    score = (F.when(a == b, F.lit(1.0))
             .when(ba == bb, F.greatest(_alike(pa_[1], pb[1]), _alike(pa_[2], pb[2])))
             .when(ba == 2 * bb, _alike(pa_[1], pb[2])).when(bb == 2 * ba, _alike(pa_[2], pb[1])))
    return F.coalesce(score, F.lit(0.0))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or
    all) of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_FIELDS = ("kind string, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "next_fingerprint string, text string, part int")


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    next_fingerprint: every text, its edit by the next row's in id order, and
    the next row's fingerprint (after the last row: the first).

    Rows are range-partitioned by id; a partition settles all its rows but
    the last, which meets the next partition's first one afterwards (two rows
    a partition)."""
    import hashlib

    def done(doc_id, text, own, following, its) -> tuple:
        e = edited(text, following)
        return (doc_id, len(text), hashlib.sha256(e.encode()).hexdigest(), own, own if e == text else fingerprint(e), its)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
        names = [f.split()[0] for f in _FIELDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                own = batch.slice(at, 256)
                rows = []
                for d, t in zip(own.column("doc_id").to_pylist(), own.column("text").to_pylist(), strict=True):
                    t = t or ""
                    p = fingerprint(t)
                    if held is None:
                        rows.append(("first", d, None, None, p, None, None, t, part))
                    else:
                        rows.append(("done", *done(*held, t, p), None, None))
                    held = (d, t, p)
                yield batch_of(rows)
        if held is not None:
            yield batch_of([("last", held[0], None, None, held[2], None, None, held[1], part)])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = held = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                own = (r["doc_id"], r["text"], r["fingerprint"])
                if r["kind"] == "last":
                    held = own
                elif held is None:
                    first = own
                else:
                    rows.append(("done", *done(*held, own[1], own[2]), None, None))
            yield batch_of(rows)
        if held is not None:
            yield batch_of([("done", *done(*held, first[1], first[2]), None, None)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = cut(rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(inside, _FIELDS))
    ends = found.filter("kind != 'done'").repartition(1).sortWithinPartitions("part", "kind").mapInArrow(across, _FIELDS)
    return found.filter("kind = 'done'").unionByName(ends).drop("kind", "text", "part")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. Null text is
    empty. Null ids come first in id order, rows of one id in text order. A
    single row is its own next; an empty table gives no rows."""
    f = with_neighbours(docs, id_col, text_col)
    return f.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_documents(spark, sf_dir))
