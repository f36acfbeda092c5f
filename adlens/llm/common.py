"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of text that one vectorised step works on; bounds a task's memory
#: whatever the size of the Arrow batch (a longer document is one step).
BLOCK_BYTES = 1 << 21
#: The same for steps whose arrays take many times the text. A worker keeps the
#: room of its largest step for all stages of a job.
STEP_BYTES = 1 << 19

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)


def few(df: DataFrame) -> DataFrame:
    """A sixteenth of the shuffle partitions, for tables far smaller than the
    texts (links, components): fewer and larger shuffle files."""
    return df.coalesce(few_partitions(df))


def tidy(spark: SparkSession) -> None:
    """Let go of what finished steps left behind. Spark removes shuffle files,
    broadcasts and checkpoints, and the driver its plans and compiled classes,
    only once the driver's garbage is collected, which a job of many small
    rounds may not bring about by itself."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows up to which ``join_small`` broadcasts its smaller side.
SMALL_ROWS = 1 << 16


def join_small(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join (nulls meet) with a table of one row a key, cut before: by
    broadcast if its rows are counted to be few, else by shuffling, where
    Spark splits the partition of a hot key."""
    small = small.withColumnRenamed(key, "_small_key")
    if small.count() <= SMALL_ROWS:
        small = F.broadcast(small)
    return rows.join(small, F.col(key).eqNullSafe(F.col("_small_key"))).drop("_small_key")


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not (whatever the case of its letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that for text of ASCII bytes
    alone and is much faster than ``translate``."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """True for rows kept from training: crc32(doc_id as text) mod 4 is 2.
    A null id has no remainder; it is never learnt from and not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def bounded_sample(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` of the rows (all, if there are fewer), chosen by a hash
    of ``key``: the same rows at every run and layout. The expected number is
    ``bound``; more than ``bound + 6 sqrt(bound)`` is practically impossible."""
    n = rows.count()
    if n <= bound:
        return rows
    share = bound / n
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))


def text_blocks(batch: pa.RecordBatch, column: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batch with at most ``limit`` bytes of text (or one row),
    each with its texts; null reads as empty."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    start, base = 0, 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = batch.slice(start, stop - start)
        yield part, ["" if t is None else t for t in part.column(column).to_pylist()]
        start, base = stop, int(ends[stop - 1])


_kept: dict = {}


def kept(key, make):
    """What ``make`` returns, made once in a worker for all tasks with this
    key. A reused worker holds one such thing at a time: that of a finished
    stage goes when the next stage's is made."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


@functools.cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):        # not glibc
        return lambda pad: 0


def give_back() -> None:
    """Return what this process has freed to the system; Arrow's pool and
    glibc's heap hold on to the room of their largest step."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def let_go() -> None:
    """Drop what ``kept`` holds."""
    if _kept:
        _kept.clear()
        give_back()


def lean(run: Callable[[Iterator], Iterator], tables: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` (for mapInArrow or mapInPandas) for workers that stay for later
    stages: an idle one holds no more than an empty process, beside the JVM
    whose stages run then. ``tables``: ``run`` uses ``kept``, so what that
    holds stays; else it goes first."""
    def task(batches: Iterator) -> Iterator:
        if not tables:
            let_go()
        yield from run(batches)
        give_back()
    return task


def text_steps(texts: list[str], limit: int = STEP_BYTES) -> Iterator[list[str]]:
    """The texts in stretches of at most ``limit`` code points (or one text)."""
    ends = np.cumsum([len(t) for t in texts])
    start = 0
    while start < len(texts):
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield texts[start:stop]
        start = stop


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values of an array of integers, in order. Sorts in place
    (``np.unique`` of whole numbers goes by a hash table, many times slower
    where most values are distinct)."""
    values.sort()
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def ragged_arange(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for every n in ``lengths``, one after the other."""
    total = int(lengths.sum())
    out = np.arange(total, dtype=np.int64)
    return out - np.repeat(np.cumsum(lengths) - lengths, lengths)


# ---- hashes of all byte slices of a block -----------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n``."""
    if not _powers or len(_powers[0]) < n:
        size = max(n + (n >> 2), 1 << 16)       # as long as the longest block yet
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x, np.uint64)]), dtype=np.uint64)
                      for x in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64)))]
    return _powers[0], _powers[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[starts[i]:ends[i]]`` for all i in one pass."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h - (h == np.uint64(2**64 - 1))      # all ones is kept free


# ---- words of a block ---------------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def join_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, one blank after each, and where each starts
    (one more entry for the end)."""
    parts = [t.encode() for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join([*parts, b""]), np.uint8), starts


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else as it is."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_slices(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without blanks (0x20, 0x09-0x0D) in bytes
    that end with a blank."""
    blank = np.concatenate([[True], _BLANK[data]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[0::2], edge[1::2]


def of_text(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text in which each position lies."""
    return np.searchsorted(starts, positions, side="right") - 1
