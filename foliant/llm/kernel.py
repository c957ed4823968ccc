"""Vectorised text kernels shared by the operators (numpy over Arrow buffers).

Each kernel works on one *slice* of an Arrow batch: whole texts, concatenated as
UTF-8 bytes, with ``offs`` holding the n+1 document offsets.  Slices are cut by
bytes (``SLICE_BYTES``), so memory follows the slice and the longest single
text, never the partition.

Two kinds of hashes: ``Rolling`` is a polynomial modulo 2**64, cheap for every
subrange but easily made to collide; it only chooses places and candidates,
which equal contents always share.  What decides that contents are equal is
``word_hashes`` and ``chained`` (a bijective mixer over eight bytes at a time),
``digests`` (XXH3 of 128 bits) or the bytes themselves (``distinct``).
"""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim(0)
except (OSError, AttributeError):  # another C library: nothing to trim
    _LIBC = None

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _constants(seed: int):
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
    base = int(rng.integers(1, 2**62)) * 8 + 5
    return values, base


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int):
        if len(self.up) < n:
            m = max(n, 2 * len(self.up), 1 << 16)
            one = np.ones(1, U64)
            self.up = np.concatenate([one, np.multiply.accumulate(np.full(m - 1, self.base))])
            self.down = np.concatenate([one, np.multiply.accumulate(np.full(m - 1, self.inverse))])
        return self.up, self.down


_VALUES, _BASE = _constants(20240501)
POWERS = Powers(_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Rolling:
    """Hashes of any subrange of a symbol sequence from one prefix sum; they choose places, they prove nothing equal."""

    def __init__(self, symbols: np.ndarray, powers: Powers = POWERS):
        n = len(symbols)
        up, self.down = powers.to(n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(symbols * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))


def trimmed() -> None:
    """Gives freed memory back: idle workers are kept for later stages, and what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets) of consecutive slices; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    raw = column.buffers()
    offs = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1))
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b
    trimmed()


def word_spans(buf: np.ndarray, offs: np.ndarray):
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and word offsets per document."""
    inside = ~_SPACE[buf]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cut = offs[:-1][offs[:-1] < len(buf)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cut = offs[1:][offs[1:] > 0] - 1
    after[cut] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def byte_symbols(buf: np.ndarray) -> np.ndarray:
    return _VALUES[buf]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _loads(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``buf`` on, zeros behind its end."""
    return np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: its length, then eight bytes at a time, through ``mix``."""
    size, loads = ends - starts, _loads(buf)
    h = mix(mix(size.astype(U64) + ODD) * ODD ^ (loads[starts] & _MASKS[np.minimum(size, 8)]))
    at, rows = 8, np.flatnonzero(size > 8)
    while len(rows) and at < LONG_WORD:
        h[rows] = mix(h[rows] * ODD ^ (loads[starts[rows] + at] & _MASKS[np.minimum(size[rows] - at, 8)]))
        at += 8
        rows = rows[size[rows] > at]
    for r in rows.tolist():
        h[r] = xxhash.xxh3_64_intdigest(buf[starts[r] : ends[r]].tobytes())
    return h


def chained(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` hashes in a row, in their order."""
    h = np.full(len(at), U64(size))
    for k in range(size):
        h = mix(h * ODD ^ hashes[at + k])
    return h


def same_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each span holds the same bytes as the span numbered ``other``."""
    size, loads = ends - starts, _loads(buf)
    same = size == size[other]
    mask = _MASKS[np.minimum(size, 8)]
    same &= loads[starts] & mask == loads[starts[other]] & mask
    at, rows = 8, np.flatnonzero(same & (size > 8))
    while len(rows) and at < LONG_WORD:
        mask = _MASKS[np.minimum(size[rows] - at, 8)]
        same[rows] = loads[starts[rows] + at] & mask == loads[starts[other[rows]] + at] & mask
        at += 8
        rows = rows[same[rows] & (size[rows] > at)]
    for r in rows.tolist():
        o = other[r]
        same[r] = r == o or bool((buf[starts[r] : ends[r]] == buf[starts[o] : ends[o]]).all())
    return same


def distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(codes, first): the number of each span's content and the first span of each, by its bytes."""
    codes, kinds = pd.factorize(word_hashes(buf, starts, ends))
    n = len(kinds)
    if len(codes) and not same_bytes(buf, starts, ends, _first(codes, n)[codes]).all():  # hashes met
        raw, seen = buf.tobytes(), {}
        codes = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
        n = len(seen)
    return codes, _first(codes, n)


def _first(codes: np.ndarray, n: int) -> np.ndarray:
    first = np.zeros(n, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first


def digests(raw: bytes, starts: np.ndarray, ends: np.ndarray):
    """XXH3 of 128 bits of each span's bytes, as two arrays of longs."""
    d = xxhash.xxh3_128_digest
    out = np.frombuffer(b"".join([d(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), np.int64)
    return out[0::2], out[1::2]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, … of every run, one run after another."""
    total = int(counts.sum())
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return first + np.arange(total)


def join_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The words joined by one space each; (bytes, starts there, ends there)."""
    size = ends - starts
    to = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    out[ragged(to, size)] = buf[ragged(starts, size)]
    return out, to, to + size


def doc_of(offs: np.ndarray, n: int) -> np.ndarray:
    """The document index of each of n items, given item offsets per document."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the position of the leftmost smallest of values[i : i+width].

    Block-wise prefix and suffix minima, two passes whatever the width.  The
    low bits of each value are replaced by its position, so ties go left.
    """
    n = len(values)
    bits = U64(max(1, int(n).bit_length()))
    keys = ((values >> bits) << bits) | np.arange(n, dtype=U64)
    pad = -n % width + width
    full = np.concatenate([keys, np.full(pad, ~U64(0))])
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1 : n + width - 1])
    return (least & ((U64(1) << bits) - U64(1))).astype(np.int64)


def anchors(symbols: np.ndarray, offs: np.ndarray, window: int, gram: int, levels: tuple[int, ...] = ()):
    """Content-chosen anchors of all ``window``-symbol windows of the documents.

    Every window has one anchor, its leftmost smallest ``gram``-symbol hash, so
    equal windows share the anchor's content and its place inside the window.
    Returns per anchor run: document index, first and last window start ``lo``,
    ``hi`` and the anchor's place ``at`` (in flat symbols), ``key`` (the gram's
    hash), and for each of ``levels`` the hashes of that many symbols from the
    anchor on and up to the anchor's end, 31 bits each; -1: they leave the document.
    """
    n = len(symbols)
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty, empty, empty.astype(U64), [empty.astype(np.int32)] * 2 * len(levels)
    rolling = Rolling(symbols)
    at = np.arange(n - gram + 1)
    grams = rolling.of(at, at + gram)
    pick = sliding_argmin(grams, window - gram + 1)[: n - window + 1]
    docs = doc_of(offs, n)
    valid = docs[: n - window + 1] == docs[window - 1 :]
    start = np.flatnonzero(valid)
    anchor = pick[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (docs[start[1:]] != docs[start[:-1]])
    first = np.flatnonzero(new)
    lo = start[first]
    hi = start[np.append(first[1:], len(start)) - 1] if len(start) else empty
    own, at = docs[lo], anchor[first]
    wider = []
    for size in levels:
        for begin, end in ((at, at + size), (at + gram - size, at + gram)):
            inside = (begin >= offs[own]) & (end <= offs[own + 1])
            h = rolling.of(np.where(inside, begin, 0), np.where(inside, end, 0)) >> U64(33)
            wider.append(np.where(inside, h.astype(np.int64), -1).astype(np.int32))
    return own, lo, hi, at, grams[at], wider


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U64).view(np.int64)


def simhash(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit majority fingerprint of each document's hashes; none: zero.

    Counts run in sixteen-bit lanes, four bits of the hash to a word, over
    blocks of at most 65,535 hashes, so any length is counted exactly.
    """
    n = len(offs) - 1
    counts = np.zeros((n, 64), np.int64)
    size = np.diff(offs)
    full = np.flatnonzero(size)
    blocks = -(-size[full] // 65535)
    begin = np.repeat(offs[full], blocks) + 65535 * (np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    owner = np.repeat(full, blocks)
    if len(begin):
        lanes = U64(0x0001000100010001)
        for bit in range(16):
            sums = np.add.reduceat((hashes >> U64(bit)) & lanes, begin)
            for lane in range(4):
                np.add.at(counts[:, bit + 16 * lane], owner, ((sums >> U64(16 * lane)) & U64(0xFFFF)).astype(np.int64))
    ones = 2 * counts > size[:, None]
    return (ones.astype(U64) << np.arange(64, dtype=U64)).sum(axis=1, dtype=U64)
