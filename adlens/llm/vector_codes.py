"""Vector code compression: product codes found by an integer Walsh-Hadamard transform.

Components become whole numbers, vectors are cut into equal parts, and every
part is named by the nearest entry of its position's codebook. To find it,
parts and entries, padded with zeros to a power of two, are transformed; by
Parseval's identity the squared differences of the transforms add up to the
squared distance times their length. They are added in sequency order, the
smooth directions first, which hold most of the difference; an entry whose
sum has passed the distance of the best guess is out and costs no more. All
of it is whole-number arithmetic: 64 bits where the components allow it,
Python's unbounded integers else.

Codebooks are bounded by parameters (positions x entries x part width), so
they live on the driver; tasks send sums per entry, which Spark adds up.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_small

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows that are compared with a codebook at a time.
BLOCK_ROWS = 4096
#: Sums travel in limbs of so many bits, so that no sum overflows a long.
LIMB_BITS = 40


def sequency_order(m: int) -> np.ndarray:
    """Places of the fast transform's outputs by rising number of sign changes:
    the bit-reversed Gray code (``m`` a power of two)."""
    bits = m.bit_length() - 1
    gray = np.arange(m) ^ (np.arange(m) >> 1)
    out = np.zeros(m, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def walsh(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row in sequency order, zero-padded to
    a power of two; whole numbers in, whole numbers out."""
    n, width = rows.shape
    m = 1 << max(0, (width - 1).bit_length())
    out = np.zeros((n, m), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < m:
        pairs = out.reshape(n, m // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, m)
        half *= 2
    return out[:, sequency_order(m)]


def fits_long(width: int, most: int) -> bool:
    """Whether scaled distances of parts with components up to ``most`` in
    size stay within 64 bits."""
    m = 1 << max(0, (width - 1).bit_length())
    return m * width * 4 * (most + 1) ** 2 < 1 << 62


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every part's nearest entry; of entries as
    near, the first. Both arrays of one dtype, int64 or object."""
    x, y = walsh(parts), walsh(book)
    m = x.shape[1]
    at = np.zeros(len(x), np.int64)
    out = np.zeros(len(x), x.dtype)
    for lo in range(0, len(x), BLOCK_ROWS):
        t = x[lo:lo + BLOCK_ROWS]
        partial = (t[:, :1] - y[None, :, 0]) ** 2
        guess = partial.argmin(1)
        bound = ((t - y[guess]) ** 2).sum(1)
        row, entry = np.nonzero(partial <= bound[:, None])
        partial = partial[row, entry]
        for c in range(1, m):
            partial = partial + (t[row, c] - y[entry, c]) ** 2
            stays = np.asarray(partial <= bound[row], bool)
            row, entry, partial = row[stays], entry[stays], partial[stays]
        # every row has its guess left, at least
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        least = np.minimum.reduceat(partial, heads)
        best = np.flatnonzero(partial == least[row])
        best = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])]
        at[lo:lo + BLOCK_ROWS] = entry[best]
        out[lo:lo + BLOCK_ROWS] = least // m
    return at, out


def kept_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, vector (doubles) of the rows whose vector is there and
    has only finite components."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("vector")).filter(
        F.col("vector").isNotNull() & fine)


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    """floor(256 * x) of every double: int64 if all fit, else object."""
    most = np.abs(flat).max(initial=0)
    if most < 2.0 ** 40:
        return np.floor(flat * SCALE).astype(np.int64)
    return np.array([math.floor(x * SCALE) if abs(x) < 2.0 ** 53 else int(x) * SCALE for x in flat.tolist()], object)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as a matrix of whole numbers, short ones padded with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = whole_numbers(column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _assigned(rows: np.ndarray, books: list) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, parts, index, squared distance) by position."""
    width = rows.shape[1] // len(books)
    most = max([0, *(abs(c) for book in books for e in book for c in e)])
    if len(rows):
        most = max(most, int(np.abs(rows).max()))
    kind = np.int64 if fits_long(width, most) else object
    for p, book in enumerate(books):
        parts = rows[:, p * width:(p + 1) * width].astype(kind)
        yield p, parts, *nearest(parts, np.array(book, dtype=kind).reshape(len(book), width))


def refined(vectors: DataFrame, books: list) -> list:
    """The codebooks after one round: every entry the floor of the mean of the
    parts that it is nearest to; unused entries stay."""
    width = len(books[0][0])
    shape = (len(books), len(books[0]), width + 1)          # the last place counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, object)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                rows = _matrix(batch.column("vector").slice(lo, BLOCK_ROWS), width * len(books))
                for p, parts, at, _ in _assigned(rows, books):
                    sums = np.zeros(shape[1:], parts.dtype)
                    np.add.at(sums, at, np.concatenate([parts, np.ones((len(parts), 1), parts.dtype)], 1))
                    total[p] += sums.astype(object)
        place, limb, value = [], [], []
        for i, s in enumerate(total.ravel().tolist()):
            sign, s, k = (-1 if s < 0 else 1), abs(s), 0
            while s:
                place.append(i)
                limb.append(k)
                value.append(sign * (s & ((1 << LIMB_BITS) - 1)))
                s, k = s >> LIMB_BITS, k + 1
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
                                         names=["place", "limb", "value"])

    sums = np.zeros(math.prod(shape), object)
    # at most positions x entries x (width + 1) rows a limb
    for r in vectors.select("vector").mapInArrow(run, "place int, limb int, value long").groupBy("place", "limb").agg(
            F.sum("value").alias("value")).collect():
        sums[r.place] += r.value << (LIMB_BITS * r.limb)
    sums = sums.reshape(shape).tolist()
    return [[[c // e[-1] for c in e[:-1]] if e[-1] else old for e, old in zip(of, book, strict=True)]
            for of, book in zip(sums, books, strict=True)]


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list:
    """Codebooks [position][entry][component] of ``kept_vectors``; empty if
    there are none."""
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return []
    width = max(1, -(-longest // parts))
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    rows = _matrix(pa.array([r.vector for r in first], pa.list_(pa.float64())), parts * width).tolist()
    books = [[r[p * width:(p + 1) * width] for r in rows] for p in range(parts)]
    for _ in range(rounds):
        books = refined(vectors, books)
    return books


def books_digest(books: list) -> str:
    """SHA-256 of all components, by position, entry, place in the part."""
    return hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()


def encode(vectors: DataFrame, books: list) -> DataFrame:
    """vec_id, label, code (two hex digits a position), error (summed squared
    distance; null beyond a long) by the given codebooks."""
    width = len(books[0][0]) if books else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                rows = _matrix(part.column("vector"), width * len(books))
                codes, error = np.zeros((len(rows), len(books)), np.uint8), 0
                for p, _, at, distance in _assigned(rows, books):
                    codes[:, p] = at
                    error = error + distance.astype(object)
                text = codes.tobytes().hex()
                step = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                     pa.array([e if e < 1 << 63 else None for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def _sum_or_null(error: Column) -> Column:
    """Sum of longs as a long, null if one is null or the sum is beyond it."""
    total = F.sum(error.cast("decimal(38,0)"))
    return F.when(F.count(error) == F.count(F.lit(1)), total).try_cast("long")


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error (summed over equal labels, nulls
    together), codebooks_sha256 of every row whose vector is kept.

    Null vectors and those with null or non-finite components are dropped. The
    longest vector sets the width of a part (rounded up); shorter ones end in
    zeros, an empty one is all zeros. Of rows that share an id the smaller
    vector comes first, null ids come last: that matters for the first
    codebooks alone. Fewer rows than entries make fewer entries. Errors and
    their sums that no long holds are null. An empty table gives no rows."""
    vectors = kept_vectors(rows, id_col, vector_col, label_col)
    books = fit(vectors)
    codes = cut(encode(vectors, books))
    per = cut(codes.groupBy("label").agg(_sum_or_null(F.col("error")).alias("label_error")))
    return join_small(codes, per, "label").select("vec_id", "label", "code", "error", "label_error",
                                                  F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    def nearest_of(book: str) -> str:
        return f"""(
  SELECT part.vec_id, part.p, min([d, e])[2] AS e, min(d) AS d
  FROM (SELECT part.vec_id, part.p, {book}.e,
               list_sum(list_transform(list_zip(part.x, {book}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM part JOIN {book} USING (p)) AS part GROUP BY ALL)"""

    def moved(book: str, at: str) -> str:
        return f"""(
  SELECT p, e, coalesce(m.x, b.x) AS x FROM {book} AS b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x
    FROM (SELECT p, e, i, sum(part.x[i])::BIGINT AS s, count(*) AS n
          FROM {at} JOIN part USING (vec_id, p), range(1, len(part.x) + 1) AS r(i) GROUP BY ALL) GROUP BY p, e) AS m USING (p, e))"""

    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT vec_id, place, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS x FROM kept, range({PARTS}) AS r(p)),
b0 AS MATERIALIZED (SELECT p, place AS e, x FROM part WHERE place < {ENTRIES}),
a0 AS MATERIALIZED {nearest_of("b0")},
b1 AS MATERIALIZED {moved("b0", "a0")},
a1 AS MATERIALIZED {nearest_of("b1")},
b2 AS MATERIALIZED {moved("b1", "a1")},
a2 AS MATERIALIZED {nearest_of("b2")},
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a2 JOIN kept USING (vec_id) GROUP BY vec_id, label)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, book
"""


ORACLE = _oracle()
