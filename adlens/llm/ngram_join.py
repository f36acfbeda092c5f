"""Jaccard join of documents on five-word shingles, by PartEnum signatures.

Sets of like size (a band, and the next one for sets near its end) see the
same partition of the shingle domain. Two sets with similarity of at least
80/100 differ in at most a quarter of either's shingles, so of any
``size // 4 + 1`` non-empty parts of a set one at least is untouched by the
differences. A set therefore enumerates its first ``size // 4 + 1`` non-empty
parts, each giving one signature (band, part and all shingles in it): similar
sets share one. Sets with too few non-empty parts share one of their own.

Equal sets are one class with one representative. Within a signature's group
the closest lower member is checked first and components are made of the links
found; groups that still hold several components compare all members across
them in blocks, inside a task, by an exact bound (a parity sketch of the sets
can't differ in more bits than the sets differ in shingles). What passes is
checked on the shingle sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dense_id import with_dense_id
from .common import (cut, few, few_partitions, join_texts, lean, lower_bytes, mix64, of_text, ragged_arange, read_documents, slice_hashes, text_blocks,
                     tidy, unused_name, word_slices)
from .components import components, extended

SHINGLE = 5
#: Bands of sizes grow by this factor (over 100/80, so that partners lie in
#: the same band or the next).
BAND_GROWTH = 1.5
#: Sets of up to this many shingles get a part per shingle, nearly.
SMALL_SET, SMALL_PARTS = 32, 4096
#: Bits of the smallest parity sketch, and of the filter of wanted ids.
SKETCH_BITS, FILTER_BITS = 256, 1 << 24
#: Rounds of nearest members go on while they link this share of what they try.
WORTHWHILE = 0.1
#: Members of a signature's group that meet in one task at a time.
GROUP_BLOCK = 4096
#: Places of the table in which a task remembers the sets it has signed, so
#: that most copies are signed once.
REMEMBERED = 1 << 18
#: Bytes of text whose shingles are made at a time.
SHINGLE_BYTES = 1 << 19


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all texts end to end, each text's sorted;
    number of each text's)."""
    data, starts = join_texts(texts)
    data = lower_bytes(data)
    a, b = word_slices(data)
    counts = np.zeros(len(texts), np.int64)
    if not len(a):
        return np.zeros(0, np.uint64), counts
    words = slice_hashes(data, a, b)
    doc = of_text(a, starts)
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    n = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(np.int64))
    at = np.repeat(first, n) + ragged_arange(n)
    size = np.repeat(np.minimum(n_words, SHINGLE), n)
    h = size.astype(np.uint64)
    for k in range(SHINGLE):
        on = size > k
        h[on] = mix64(h[on] * np.uint64(0x9E3779B97F4A7C15) + words[at[on] + k])
    ends = np.cumsum(n)
    for i in np.flatnonzero(n > 1).tolist():
        h[ends[i] - n[i]:ends[i]].sort()
    own = np.repeat(np.arange(len(texts)), n)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], np.bincount(own[new], minlength=len(texts))


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums (modulo 2^64) of each text's values."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def set_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    return tuple(mix64(_per_text(mix64(hashes ^ np.uint64(s)), counts) + counts.astype(np.uint64)).view(np.int64)
                 for s in (0x243F6A8885A308D3, 0x13198A2E03707344))


def parity_sketch(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sketches end to end as int64, words of each): per bit the parity of
    the shingles that fall on it. A sketch has two to four bits a shingle; its
    halves xor-ed are the sketch of half the length."""
    bits = np.maximum(SKETCH_BITS, 4 << np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) - 1)
    at = np.cumsum(bits) - bits
    own = np.repeat(np.arange(len(counts)), counts)
    bit = (hashes & (bits - 1).astype(np.uint64)[own]).astype(np.int64)
    odd = np.bincount(at[own] + bit, minlength=int(bits.sum())).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64), bits // 64


def band_edges(top: int) -> np.ndarray:
    edges = [1]
    while edges[-1] <= top:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
    return np.array([*edges, int(edges[-1] * BAND_GROWTH) + 1], np.int64)


def parts_of_band(upper: np.ndarray) -> np.ndarray:
    """Number of parts of the domain for a band of sizes below ``upper``:
    about a third of the size, with room so that the non-empty ones suffice."""
    wide = np.ceil(0.27 * upper + 1.2 * np.sqrt(upper) + 4).astype(np.int64)
    return np.where(upper <= SMALL_SET, SMALL_PARTS, wide)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, index of the set of each)."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = band_edges(int(counts.max()))
    home = np.searchsorted(edges, counts, side="right") - 1
    out = []
    spread = mix64(hashes ^ np.uint64(0xA4093822299F31D0))
    for up in (0, 1):
        # also the next band, if a partner may lie there: partners have up to 5/4 of the size
        sets = np.flatnonzero((counts > 0) & ((up == 0) | (5 * counts >= 4 * edges[home + 1])))
        if not len(sets):
            continue
        band = home[sets] + up
        n_parts = parts_of_band(edges[band + 1])
        c = counts[sets]
        at = np.repeat((np.cumsum(counts) - counts)[sets], c) + ragged_arange(c)
        own = np.repeat(np.arange(len(sets)), c)
        part = ((hashes[at] >> np.uint64(32)) * np.repeat(n_parts, c).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        # a set's hashes are sorted, so its parts come in order
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1])
        heads = np.flatnonzero(new)
        content = _per_text(spread[at], np.diff(np.append(heads, len(at))))
        holder = own[heads]
        filled = np.bincount(holder, minlength=len(sets))
        rank = ragged_arange(filled)
        need = c // 4 + 1
        keep = rank < need[holder]
        tag = band[holder].astype(np.uint64) << np.uint64(40) | part[heads].astype(np.uint64)
        out.append((mix64(content[keep] ^ mix64(tag[keep] + np.uint64(1))), sets[holder[keep]]))
        few = np.flatnonzero(filled < need)
        out.append((mix64(band[few].astype(np.uint64) ^ np.uint64(0x082EFA98EC4E6C89)), sets[few]))
    return np.concatenate([s for s, _ in out]).view(np.int64), np.concatenate([k for _, k in out])


# ---- Spark steps ---------------------------------------------------------------


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def summarise(texts: DataFrame) -> DataFrame:
    """doc_id, n, k1, k2 (hashes of the set), sketch of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in text_blocks(batch, limit=SHINGLE_BYTES):
                h, n = shingle_sets(own)
                k1, k2 = set_keys(h, n)
                sketch, words = parity_sketch(h, n)
                ends = np.concatenate([[0], np.cumsum(words)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(k1), pa.array(k2),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(sketch))],
                    names=["doc_id", "n", "k1", "k2", "sketch"])

    return texts.mapInArrow(lean(run), "doc_id long, n long, k1 long, k2 long, sketch array<long>")


def sign(texts: DataFrame) -> DataFrame:
    """sig, k1: the signatures of every set; copies within a task once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(REMEMBERED, np.int64)
        for batch in batches:
            for _, own in text_blocks(batch, limit=SHINGLE_BYTES):
                h, n = shingle_sets(own)
                k1 = set_keys(h, n)[0]
                place = k1 & (REMEMBERED - 1)
                fresh = np.zeros(len(n), bool)
                fresh[np.unique(k1, return_index=True)[1]] = True
                fresh &= done[place] != k1
                done[place] = k1
                sig, own_set = signatures(h[np.repeat(fresh, n)], n[fresh])
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(k1[fresh][own_set])], names=["sig", "k1"])

    return texts.mapInArrow(lean(run), "sig long, k1 long")


def shared_signatures(signed: DataFrame) -> DataFrame:
    """sig, k1, pivot: members of the groups of two sets or more, with the
    group's least member. Rows stream through in order; a group of any size
    needs no room."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig = last_k = pivot = None
        told = False                    # the pivot's own row has gone out
        for batch in batches:
            sig, k = batch.column("sig").to_numpy(), batch.column("k1").to_numpy()
            if not len(sig):
                continue
            carried = last_sig is not None
            if carried:
                sig, k = np.append(last_sig, sig), np.append(last_k, k)
            new_sig = np.ones(len(sig), bool)
            new_sig[1:] = sig[1:] != sig[:-1]
            distinct = new_sig.copy()
            distinct[1:] |= k[1:] != k[:-1]
            if carried:
                distinct[0] = False
            group = np.cumsum(new_sig) - 1
            heads = np.flatnonzero(new_sig)
            pivots = k[heads].copy()
            if carried:
                pivots[0] = pivot
            rest = distinct & ~new_sig                  # further members
            has_rest = np.zeros(len(heads), bool)
            has_rest[group[rest]] = True
            opens = has_rest.copy()                     # groups whose pivot row goes out now
            if carried and told:
                opens[0] = False
            out = [(sig[rest], k[rest], pivots[group[rest]]), (sig[heads[opens]], pivots[opens], pivots[opens])]
            told = bool(has_rest[-1]) or (carried and told and len(heads) == 1)
            last_sig, last_k, pivot = sig[-1], k[-1], pivots[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)],
                                             names=["sig", "k1", "pivot"])

    return signed.repartition("sig").sortWithinPartitions("sig", "k1").mapInArrow(lean(run), "sig long, k1 long, pivot long")


#: Bits in which the sketches sketch_a and sketch_b differ, the longer one folded once.
_DIFFER = """aggregate(sequence(0, least(size(sketch_a), size(sketch_b)) - 1), 0, (s, i) -> s + bit_count(
    sketch_a[i] ^ sketch_b[i]
    ^ if(size(sketch_a) > size(sketch_b), sketch_a[i + size(sketch_b)], 0)
    ^ if(size(sketch_b) > size(sketch_a), sketch_b[i + size(sketch_a)], 0)))"""


def may_be_similar(pairs: DataFrame) -> DataFrame:
    """Pairs (n_a, n_b, sketch_a, sketch_b) whose sizes and sketches don't rule
    out 100 * common >= 80 * union, with ``differ``. Sizes that pass have
    sketches of equal length, or one of twice the other's."""
    like = pairs.withColumn("differ", F.when(100 * F.least("n_a", "n_b") >= 80 * F.greatest("n_a", "n_b"), F.expr(_DIFFER)))
    return like.filter(9 * F.col("differ") <= F.col("n_a") + F.col("n_b"))


def _place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def wanted_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits (a fixed size) in which every id's bit is
    set; it may pass other ids, never lose one."""
    bit = ids.select((_place(F.col(ids.columns[0])) + 1).alias("bit"))      # buckets count from 1
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in parts:
        out[r.part - 1, :len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.ravel()


def sets_of(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, shingles of the documents named in ``reps`` (rep), and of a few
    others that the filter lets pass: so texts need no shuffle."""
    mask = texts.sparkSession.sparkContext.broadcast(wanted_filter(reps))
    placed = texts.select("doc_id", "text", _place(F.col("doc_id")).alias("bit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy().astype(np.int64)
            batch = batch.filter(pa.array((mask.value[bit >> 3] >> (bit & 7)) & 1 == 1))
            for part, own in text_blocks(batch, limit=SHINGLE_BYTES):
                h, n = shingle_sets(own)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))],
                    names=["rep", "shingles"])

    return placed.mapInArrow(lean(run), "rep long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar, checked on the sets."""
    left = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(left, "u").join(right, "v").select(
        "u", "v", F.size(F.array_intersect("a", "b")).alias("common"), (F.size("a") + F.size("b")).alias("sizes"))
    found = both.filter("100L * common >= 80L * (sizes - common)").select("u", "v")
    # links are few: shuffled, not coalesced, so that the sets are still compared in all partitions
    return found.repartition(few_partitions(found))


def folded(parts: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Sketches (``words`` long each) as a matrix, folded to the shortest."""
    flat, least = np.concatenate(parts).view(np.uint64), int(words.min())
    at = np.cumsum(words) - words
    out = np.zeros((len(words), least), np.uint64)
    for n in np.unique(words).tolist():
        own = np.flatnonzero(words == n)
        rows = flat[at[own][:, None] + np.arange(n)[None, :]]
        while rows.shape[1] > least:
            half = rows.shape[1] // 2
            rows = rows[:, :half] ^ rows[:, half:]
        out[own] = rows
    return out


def _compare(group: dict, nearest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, differ): pairs of a group's two blocks, across components, that
    sizes and sketches allow to be similar; of each member only the nearest
    that it has not tried, or all pairs."""
    rep, n, comp, side = (np.concatenate(group[c]) for c in ("rep", "n", "comp", "block"))
    tried = [t for part in group["tried"] for t in part] if nearest else []
    sketch = folded(group["sketch"], np.concatenate(group["words"]))
    left, right = np.flatnonzero(side == group["lo"]), np.flatnonzero(side == group["hi"])
    same = group["lo"] == group["hi"]
    best, partner = np.full(len(rep), 1 << 40), np.full(len(rep), -1)
    us, vs, ds = [], [], []
    for at in range(0, len(left), 32):
        a = left[at:at + 32]
        ok = comp[a][:, None] != comp[right][None, :]
        ok &= (100 * np.minimum(n[a][:, None], n[right][None, :]) >= 80 * np.maximum(n[a][:, None], n[right][None, :]))
        if same and not nearest:
            ok &= rep[a][:, None] < rep[right][None, :]
        i, j = np.nonzero(ok)
        step = max(1, (1 << 20) // sketch.shape[1])
        for k in range(0, len(i), step):
            x, y = a[i[k:k + step]], right[j[k:k + step]]
            differ = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
            may = 9 * differ <= n[x] + n[y]
            x, y, differ = x[may], y[may], differ[may]
            if not nearest:
                us.append(rep[x])
                vs.append(rep[y])
                ds.append(differ)
                continue
            for p, q in ((x, y),) if same else ((x, y), (y, x)):
                known = [t for t in np.unique(p).tolist() if tried[t]]
                keep = np.ones(len(p), bool)
                for t in known:
                    keep &= ~((p == t) & np.isin(rep[q], tried[t]))
                p, q, d = p[keep], q[keep], differ[keep]
                order = np.lexsort((rep[q], d, p))
                first = order[np.concatenate([[True], p[order][1:] != p[order][:-1]])] if len(order) else order
                first = first[d[first] < best[p[first]]]
                best[p[first]], partner[p[first]] = d[first], q[first]
    if nearest:
        own = np.flatnonzero(partner >= 0)
        return rep[own], rep[partner[own]], best[own]
    if not us:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return np.concatenate(us), np.concatenate(vs), np.concatenate(ds)


def cross_pairs(members: DataFrame, nearest: bool) -> DataFrame:
    """u, v, differ: see ``_compare``; ``members``: sig, size (of its group),
    rep, n, comp, sketch, tried (members that it need not meet again)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "n", "comp", "block", "words", "sketch", "tried"]
        key, group = None, None

        def close():
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _compare(group, nearest)], names=["u", "v", "differ"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("sig", "lo", "hi")], 1)
            heads = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
            cols = {c: batch.column(c) for c in names}
            for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                if tuple(keys[a].tolist()) != key:
                    if group is not None:
                        yield close()
                    key = tuple(keys[a].tolist())
                    group = {"lo": key[1], "hi": key[2], **{c: [] for c in names}}
                for c in names:
                    part = cols[c].slice(a, b - a)
                    group[c].append(part.flatten().to_numpy() if c == "sketch" else
                                    (part.to_pylist() if nearest else None) if c == "tried" else part.to_numpy())
        if group is not None:
            yield close()

    # a group of more than GROUP_BLOCK members, about, meets block by block
    placed = members.withColumn("blocks", F.expr(f"CAST((size - 1) DIV {GROUP_BLOCK} AS INT)")).withColumn(
        "block", F.expr("CAST(pmod(xxhash64(rep), blocks + 1) AS INT)"))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks)"))).select(
        "sig", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "n", "comp", F.size("sketch").cast("long").alias("words"), "sketch", "tried")
    order = ["sig", "lo", "hi"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(lean(run), "u long, v long, differ long")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links) of
    every row.

    Null or blank text has an empty set and is linked with nothing. Rows
    without an id can't be named by a component: theirs is null and they link
    nothing. Rows that share an id count as one document. An empty table gives
    no rows."""
    texts = _texts(docs, id_col, text_col)
    rows = cut(summarise(texts))
    named = rows.filter("doc_id IS NOT NULL AND n > 0")
    classes = cut(named.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")))

    shared = cut(shared_signatures(sign(texts.filter(F.col("doc_id").isNotNull()))))
    # first the closest lower member of any shared group
    stars = shared.filter("k1 != pivot").select("k1", "pivot").distinct()
    of_a = classes.select("k1", F.col("rep").alias("u"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    of_b = classes.select(F.col("k1").alias("pivot"), F.col("rep").alias("v"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    close = may_be_similar(stars.join(of_a, "k1").join(of_b, "pivot").filter("u != v")).groupBy("u").agg(
        F.min_by("v", F.struct("differ", "v")).alias("v"))
    first = cut(few(close))
    comps = components(verified(first, _sets_for(texts, first)))

    tidy(docs.sparkSession)

    # then, in the groups that hold several components, every member tries the
    # nearest of another component, as long as that links many
    tried, live = first, None
    while True:
        members = _open_members(shared, classes, comps, tried, live)
        chosen = (cross_pairs(members, nearest=True).groupBy("u").agg(F.min_by("v", F.struct("differ", "v")).alias("v")))
        chosen = cut(few(chosen))
        del members
        tidy(docs.sparkSession)
        live = chosen.select(F.col("u").alias("rep"))      # who found nobody never will: links and trials only grow
        tests = cut(few(chosen.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()))
        n_tests = tests.count()
        if not n_tests:
            break
        new = cut(verified(tests, _sets_for(texts, tests)))
        tried = few(tried.unionByName(chosen))
        comps = extended(comps, new)
        n_new = new.count()
        del chosen, tests, new
        tidy(docs.sparkSession)
        if n_new < WORTHWHILE * n_tests:
            break
    # what is left: all pairs across components
    if n_tests:
        rest = cross_pairs(_open_members(shared, classes, comps, tried, live), nearest=False).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        done = tried.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        rest = cut(few(rest.join(done, ["u", "v"], "left_anti")))
        tidy(docs.sparkSession)
        comps = extended(comps, verified(rest, _sets_for(texts, rest)))
        tidy(docs.sparkSession)

    reps = (classes.select("k1", "k2", "n", "rep").join(comps, F.col("rep") == F.col("node"), "left")
            .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id")))
    linked = named.select("doc_id", "k1", "k2", "n").join(reps, ["k1", "k2", "n"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("doc_id IS NULL OR n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _open_members(shared: DataFrame, classes: DataFrame, comps: DataFrame, tried: DataFrame, live: DataFrame | None) -> DataFrame:
    """sig, size, rep, n, comp, sketch, tried of the groups' members (``live`` ones,
    if given), of groups that hold several components; groups of the very same
    members once."""
    if live is not None:
        classes = classes.join(live, "rep", "left_semi")
    member = (classes.join(comps, F.col("rep") == F.col("node"), "left")
              .select("k1", "rep", F.coalesce("component", "rep").alias("comp")))
    rows = shared.select("sig", "k1").join(member, "k1").select("sig", "rep", "comp")
    # what a group is, added up before anything is shuffled
    groups = rows.groupBy("sig").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("size"),
        F.expr("bit_xor(xxhash64(rep))").alias("mark"), F.expr("bit_xor(xxhash64(rep, 'again'))").alias("mark2")).filter("least < most")
    once = groups.groupBy("size", "mark", "mark2").agg(F.min("sig").alias("sig")).select("sig", "size")
    # a member tries one other a round, so its list is short
    seen = tried.groupBy(F.col("u").alias("rep")).agg(F.collect_set("v").alias("tried"))
    about = classes.select("rep", "n", "sketch").join(seen, "rep", "left").withColumn(
        "tried", F.coalesce("tried", F.array().cast("array<bigint>")))
    return rows.join(once, "sig").join(about, "rep")


def _sets_for(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    reps = pairs.select(F.col("u").alias("rep")).unionByName(pairs.select(F.col("v").alias("rep"))).distinct()
    return cut(sets_of(texts, reps))


def _own_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """own_id, doc_id, text, digest of every row: an id for each text. It is the
    document's, or a new one where several texts share an id or have none."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"))
    per = rows.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("doc_id IS NULL OR a < b").select("doc_id")
    per = cut(per)
    if per.isEmpty():
        return rows.withColumn("own_id", F.col("doc_id"))
    several = rows.select("doc_id", "digest").join(per.withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    numbered = with_dense_id(several.distinct(), ["doc_id", "digest"], "place")
    first = 0 if hi is None else hi if hi < 1 << 62 else lo - (1 << 62)
    new = numbered.select(F.struct("doc_id", "digest").alias("key"), (F.col("place") + first).alias("new_id"))
    return cut(rows.withColumn("key", F.struct("doc_id", "digest")).join(new, "key", "left").select(
        F.coalesce("new_id", "doc_id").alias("own_id"), "doc_id", "text", "digest"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each group of linked
    texts the one with the least id (null ids last; ties: the least SHA-256),
    with its repetitions. Texts are told apart even where they share an id or
    have none; texts without words stay."""
    tidy(docs.sparkSession)
    own = _own_ids(docs, id_col, text_col)
    found = similar_components(own, "own_id").select(F.col("doc_id").alias("own_id"), "component_id")
    linked = cut(own.select("own_id", "doc_id", "digest").distinct().join(found.distinct(), "own_id"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    best = linked.groupBy("component_id").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    gone = linked.join(best, "component_id").filter(rank != F.col("best")).select("doc_id", "digest")
    key = unused_name(docs, "key")
    mine = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"))
    return docs.withColumn(key, mine).join(gone.select(F.struct("doc_id", "digest").alias(key)), key, "left_anti").drop(key)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM t, range(1, greatest(len(w) - 3, 2)) AS r(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT u, v FROM (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS r FROM t
  UNION
  SELECT doc_id, v AS r FROM reach JOIN link ON u = r)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""
