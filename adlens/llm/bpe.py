"""Byte-level BPE over whole documents, a block of texts at a time.

Pre-tokens are located without a regular expression: every code point gets a
class (with what little look-ahead the pattern needs), a class is a transition
function over eight scanner states, and since composing such functions is
associative the state before every code point comes from a prefix scan of
table look-ups. The resulting slices are hashed, and the merges of a slice are
worked out once (for many new slices together, as matrices of ids) and kept.
Byte offsets of all tokens stay known, so decoding is one gather.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np

from .common import kept, ragged_arange, slice_hashes

# ---- pre-tokens --------------------------------------------------------------

# classes of a code point. An apostrophe that a contraction's letters follow
# has a class of its own; white space is told by what follows it.
LETTER, NUMBER, OTHER, SHORT1, SHORT2, JOIN, LAST, SPACE = range(8)
# scanner states: what the code point before this one belongs to
FRESH, IN_L, IN_N, IN_O, JOINED, IN_S, NEED1, NEED2 = range(8)

#: White space of the pattern's \s (Unicode White_Space)
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The pattern's contractions
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]


def _step(state: int, cls: int) -> tuple[int, bool]:
    """Next state, and whether a pre-token starts here."""
    if cls == LETTER:
        if state in (NEED1, NEED2):
            return (FRESH if state == NEED1 else NEED1), False
        return IN_L, state not in (IN_L, JOINED)
    if cls == NUMBER:
        return IN_N, state not in (IN_N, JOINED)
    if cls in (OTHER, SHORT1, SHORT2):
        if state in (IN_O, JOINED):
            return IN_O, False
        return {OTHER: IN_O, SHORT1: NEED1, SHORT2: NEED2}[cls], True
    if cls == JOIN:      # the blank before a word: it starts the word
        return JOINED, True
    if cls == LAST:      # other white space before a word: alone
        return FRESH, True
    return IN_S, state != IN_S


@functools.cache
def _automaton():
    """Class 0-7: within a text; 8-15: the same at a text's first code point.
    Returns (function id of each class, composition table, function id and
    state -> state, state and class -> starts a pre-token)."""
    funcs: dict[tuple[int, ...], int] = {}

    def ident(f):
        return funcs.setdefault(tuple(f), len(funcs))

    start = np.zeros((8, 16), bool)
    of_class = []
    for c in range(16):
        f = []
        for s in range(8):
            to, new = _step(FRESH if c >= 8 else s, c % 8)
            f.append(to)
            start[s, c] = new or c >= 8
        of_class.append(ident(f))
    known = 0
    while known < len(funcs):      # close under composition
        known = len(funcs)
        for f in list(funcs):
            for g in list(funcs):
                ident([g[s] for s in f])
    n = len(funcs)
    assert n <= 256
    apply = np.array(list(funcs), np.uint8)
    comp = np.zeros((n, n), np.uint8)
    for f, i in funcs.items():
        for g, j in funcs.items():
            comp[i, j] = funcs[tuple(g[s] for s in f)]
    return np.array(of_class, np.uint8), comp.ravel(), apply.ravel(), start.ravel(), n


@functools.cache
def _class_table() -> np.ndarray:
    """Class of every code point, without look-ahead (white space: SPACE)."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8,
                        0x110000)
    table[WHITE] = SPACE
    return table


def _scan(f: np.ndarray, comp: np.ndarray, n: int) -> np.ndarray:
    """Inclusive prefix composition of function ids, in rows of code points
    that advance together; the row totals are scanned the same way."""
    if len(f) <= 64:
        out = f.copy()
        for k in range(1, len(out)):
            out[k] = comp[int(out[k - 1]) * n + int(out[k])]
        return out
    cols = 64 if len(f) < 1 << 16 else 256
    rows = -(-len(f) // cols)
    grid = np.zeros(rows * cols, np.uint8)
    grid[:len(f)] = f
    grid = np.ascontiguousarray(grid.reshape(rows, cols).T)     # padding at the end is never read
    for k in range(1, cols):
        grid[k] = comp[grid[k - 1].astype(np.intp) * n + grid[k]]
    carry = _scan(grid[-1], comp, n)
    grid[:, 1:] = comp[carry[:-1].astype(np.intp)[None, :] * n + grid[:, 1:]]
    return grid.T.ravel()[:len(f)]


def pretoken_starts(cps: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Positions in ``cps`` (code points of texts laid end to end) where a
    pre-token starts; ``firsts``: positions where a text starts."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    cls = _class_table()[cps]
    white = cls == SPACE
    after = np.empty(n, bool)      # a code point of the same text follows and isn't white space
    after[:-1] = ~white[1:]
    after[-1] = False
    last = firsts[firsts > 0] - 1
    after[last] = False
    joins = white & after
    cls[joins] = np.where(cps[joins] == 32, JOIN, LAST)
    marks = np.flatnonzero(cps == 39)
    if len(marks):
        end = np.append(firsts[firsts > 0], n)
        left = end[np.searchsorted(end, marks, side="right")] - marks - 1
        a = np.where(left >= 1, cps[np.minimum(marks + 1, n - 1)], 0)
        b = np.where(left >= 2, cps[np.minimum(marks + 2, n - 1)], 0)
        one, two = np.zeros(len(marks), bool), np.zeros(len(marks), bool)
        for w in CONTRACTIONS:
            if len(w) == 2:
                one |= a == ord(w[1])
            else:
                two |= (a == ord(w[1])) & (b == ord(w[2]))
        cls[marks[one]] = SHORT1
        cls[marks[two]] = SHORT2
    cls[firsts] += 8
    of_class, comp, apply, start, size = _automaton()
    prefix = _scan(of_class[cls], comp, size)
    before = np.zeros(n, np.uint8)     # a text starts FRESH; what came before is forgotten by its first class
    before[1:] = apply[prefix[:-1].astype(np.intp) * 8]
    return np.flatnonzero(start[before.astype(np.intp) * 16 + cls])


# ---- vocabulary and merges ---------------------------------------------------

#: New slices are merged together up to this many bytes; longer ones singly.
MATRIX_WIDTH = 48
#: Slices kept by a worker; beyond it the store starts anew.
CACHE_SLICES = 1_000_000
_NONE = np.int32(2**31 - 1)


class HashIndex:
    """Open-addressing map from int64 keys (not -1) to int32, a whole array of
    keys at a time."""

    def __init__(self, expected: int):
        self._room(max(16, expected))

    def _room(self, expected: int) -> None:
        bits = (3 * expected).bit_length()
        self.shift, self.mask, self.size = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, key: np.ndarray, missing: int = -1) -> np.ndarray:
        slot = self._slot(key)
        at = self.keys[slot]
        hit = at == key
        out = np.where(hit, self.values[slot], np.int32(missing))
        left = np.flatnonzero(~hit & (at != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            at = self.keys[slot[left]]
            hit = at == key[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (at != -1)]
        return out

    def put(self, key: np.ndarray, value: np.ndarray) -> None:
        """Add keys that are distinct and not yet present."""
        if 2 * (self.size + len(key)) > len(self.keys):
            old = self.keys != -1
            k, v = self.keys[old], self.values[old]
            self._room(2 * (self.size + len(key)))
            self.put(k, v)
        self.size += len(key)
        slot = self._slot(key)
        while len(key):
            first = np.zeros(len(key), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            now = (self.keys[slot] == -1) & first
            self.keys[slot[now]], self.values[slot[now]] = key[now], value[now]
            key, value, slot = key[~now], value[~now], (slot[~now] + 1) & self.mask


def parse_ranks(data: bytes) -> list[bytes]:
    """Token bytes by rank, of a file with lines of base64 bytes and rank."""
    pairs = [line.split() for line in data.splitlines() if line]
    out: list[bytes] = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def read_vocabulary(path: str) -> bytes:
    """Rank lines (base64 bytes, rank) of a vocabulary file: a ``.tiktoken``
    file has them, a byte-level BPE ``.json`` file is rewritten without its
    special tokens (see ``added_tokens``)."""
    with open(path, "rb") as f:
        data = f.read()
    if not path.endswith(".json"):
        return data
    spec = json.loads(data)
    special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
    # byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    # rest follow in order from code point 256
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return b"".join(base64.b64encode(bytes(byte[c] for c in token)) + b" %d\n" % rank
                    for token, rank in sorted(spec["model"]["vocab"].items(), key=lambda x: x[1])
                    if token not in special)


def added_tokens(path: str) -> dict[str, int]:
    """Strings that a ``.json`` vocabulary cuts out of a text before all else,
    with their ids; none of a ``.tiktoken`` file."""
    if not path.endswith(".json"):
        return {}
    with open(path, "rb") as f:
        added = json.load(f).get("added_tokens", ())
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that look at their neighbours aren't supported")
    return {t["content"]: t["id"] for t in added}


class Encoder:
    """Encodes blocks of texts with one vocabulary; keeps merged slices.
    ``added``: strings that are one token wherever they stand, the leftmost
    first and the longest of those; without it they are ordinary text."""

    def __init__(self, rank_file: bytes, added: dict[str, int] | None = None):
        self.tokens = parse_ranks(rank_file)
        ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.added = added or {}
        for t, i in self.added.items():
            self.tokens += [b""] * (i + 1 - len(self.tokens))
            self.tokens[i] = t.encode()
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for t, i in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(i)
        self.pairs = dict(zip(keys, values, strict=True))
        self.merges = HashIndex(len(keys))
        self.merges.put(np.array(keys, np.int64), np.array(values, np.int32))
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_len = lengths
        self.token_at = np.cumsum(lengths) - lengths
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._forget()

    def _forget(self):
        self.seen = HashIndex(1 << 16)      # hash of a slice -> its entry
        self.store = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.at = np.zeros(1 << 12, np.int64)
        self.n = np.zeros(1 << 12, np.int32)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of ids a and b; _NONE where there is none."""
        return self.merges.find(a.astype(np.int64) << 32 | b, _NONE)

    def _merge_matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices (lengths 1 to MATRIX_WIDTH): flat, and how many each."""
        rows, width = len(starts), int(lengths.max())
        live = np.arange(width)[None, :] < lengths[:, None]
        ids = np.zeros((rows, width), np.int32)
        ids[live] = self.byte_id[data[np.repeat(starts, lengths) + ragged_arange(lengths)]]
        count = lengths.astype(np.int64).copy()
        rank = np.full((rows, max(1, width - 1)), _NONE, np.int32)
        pair = live[:, 1:]
        rank[:, :width - 1][pair] = self._rank(ids[:, :-1][pair], ids[:, 1:][pair])
        active = np.arange(rows)
        out_ids, out_n = np.zeros_like(ids), np.zeros(rows, np.int64)
        while True:
            best = rank.argmin(axis=1)
            value = rank[np.arange(len(active)), best]
            go = value < _NONE
            done = ~go
            out_ids[active[done], :ids.shape[1]] = ids[done]
            out_n[active[done]] = count[done]
            if not go.any():
                break
            if done.any():
                active, ids, rank, count, best, value = active[go], ids[go], rank[go], count[go], best[go], value[go]
                w = int(count.max())
                ids, rank = ids[:, :w], rank[:, :max(1, w - 1)]
            r = np.arange(len(active))
            col = np.arange(ids.shape[1])
            shift = col[None, :-1] > best[:, None]
            ids[r, best] = value
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            count -= 1
            if rank.shape[1] > 1:
                shift = shift[:, :rank.shape[1] - 1] | (col[None, :rank.shape[1] - 1] >= best[:, None])
                rank[:, :-1] = np.where(shift, rank[:, 1:], rank[:, :-1])
            rank[r, np.minimum(count - 1, rank.shape[1] - 1)] = _NONE     # the last pair is gone
            right = best + 1 < count
            rr, bb = r[right], best[right]
            rank[rr, bb] = self._rank(ids[rr, bb], ids[rr, bb + 1])
            left = best > 0
            rr, bb = r[left], best[left] - 1
            rank[rr, bb] = self._rank(ids[rr, bb], ids[rr, bb + 1])
        keep = np.arange(out_ids.shape[1])[None, :] < out_n[:, None]
        return out_ids[keep], out_n

    def _merge_long(self, piece: np.ndarray) -> np.ndarray:
        """Ids of one long slice: a heap of pairs over a linked list."""
        ids = self.byte_id[piece].tolist()
        n = len(ids)
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        pairs = self.pairs
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = nxt[i] if live[i] else n
            if j >= n or pairs.get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], live[j] = r, False
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (s := pairs.get(r << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (s, i))
            p = prv[i]
            if p >= 0 and (s := pairs.get(ids[p] << 32 | r)) is not None:
                heapq.heappush(heap, (s, p))
        return np.array([x for x, on in zip(ids, live, strict=True) if on], np.int32)

    def _keep(self, keys: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> None:
        first, total = self.seen.size, self.used + len(flat)
        while total > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while first + len(keys) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.n = np.concatenate([self.n, np.zeros_like(self.n)])
        self.store[self.used:total] = flat
        self.at[first:first + len(keys)] = self.used + np.cumsum(counts) - counts
        self.n[first:first + len(keys)] = counts
        self.used = total
        self.seen.put(keys, np.arange(first, first + len(keys), dtype=np.int32))

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Work out and keep the ids of new slices."""
        order = np.argsort(lengths, kind="stable")
        keys, starts, lengths = keys[order], starts[order], lengths[order]
        at = 0
        for width in (2, 4, 6, 8, 10, 12, 16, 24, MATRIX_WIDTH):
            while at < len(keys) and lengths[at] <= width:
                to = min(int(np.searchsorted(lengths, width, side="right")), at + 200_000)
                flat, counts = self._merge_matrix(data, starts[at:to], lengths[at:to])
                self._keep(keys[at:to], flat, counts)
                at = to
        for i in range(at, len(keys)):
            flat = self._merge_long(data[starts[i]:starts[i] + lengths[i]])
            self._keep(keys[i:i + 1], flat, np.array([len(flat)]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text)."""
        ids, counts, _, _ = self.encode_slices(texts)
        return ids, counts

    def encode_slices(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, with the texts' UTF-8 bytes end to end and the byte
        offset at which each id starts."""
        if not any(a in t for t in texts for a in self.added):
            return self._encode_ordinary(texts)
        stretches, owner, follows = [], [], []      # follows: id of the added token after a stretch, or -1
        for k, t in enumerate(texts):
            cuts = self.marks.split(t)
            stretches += cuts[0::2]
            owner += [k] * len(cuts[0::2])
            follows += [*(self.added[c] for c in cuts[1::2]), -1]
        follow = np.array(follows, np.int32)
        own, counts, _, _ = self._encode_ordinary(stretches)
        counts = counts + (follow >= 0)
        marked = (np.cumsum(counts) - 1)[follow >= 0]
        ids = np.zeros(int(counts.sum()), np.int32)
        inner = np.ones(len(ids), bool)
        inner[marked] = False
        ids[marked], ids[inner] = follow[follow >= 0], own
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, owner, counts)
        lengths = self.token_len[ids]
        return ids, total, np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum(lengths) - lengths

    def _encode_ordinary(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        joined = "".join(texts)
        chars = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(chars) - chars
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
        data = np.frombuffer(joined.encode(), np.uint8)
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = pretoken_starts(cps, np.unique(first[chars > 0]))
        text_end_slice = np.searchsorted(starts, first + chars)      # slices before each text's end
        text_first_slice = np.searchsorted(starts, first)
        if len(data) != len(cps):
            byte_at = np.flatnonzero((data & 0xC0) != 0x80)
            starts = byte_at[starts]
        ends = np.append(starts[1:], len(data))
        keys = slice_hashes(data, starts, ends).view(np.int64)
        if self.seen.size > CACHE_SLICES:
            self._forget()
        entry = self.seen.find(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            self._learn(new, data, starts[where], ends[where] - starts[where])
            entry[missing] = self.seen.find(keys[missing])
        count = self.n[entry].astype(np.int64)
        ids = self.store[np.repeat(self.at[entry], count) + ragged_arange(count)]
        upto = np.concatenate([[0], np.cumsum(count)])
        lengths = self.token_len[ids]
        return ids, upto[text_end_slice] - upto[text_first_slice], data, np.cumsum(lengths) - lengths

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, end to end."""
        lengths = self.token_len[ids]
        return self.blob[np.repeat(self.token_at[ids], lengths) + ragged_arange(lengths)]


def encoder(rank_file: bytes, added: dict[str, int] | None = None) -> Encoder:
    """The worker's encoder for this vocabulary (its kept slices live on from
    task to task in a reused Python worker)."""
    key = hashlib.sha256(rank_file + json.dumps(added or {}, sort_keys=True).encode()).digest()
    return kept(key, lambda: Encoder(rank_file, added))
