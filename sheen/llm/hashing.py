"""Numpy kernels over Arrow text batches: words, sequence hashes, window anchors.

Texts of a batch lie one after another in one buffer; everything here works on the whole
buffer, in pieces of whole documents of about ``PIECE`` units.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Units (bytes or words) that are worked on at a time; a longer document is a piece of its own.
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1
_power = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit bijection that spreads every input bit (splitmix64's last step)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int):
    """Powers of the base and of its inverse modulo 2**64, kept and grown as needed."""
    global _power, _inverse
    if len(_power) < n:
        n = max(n, 2 * len(_power))
        for name, base in (("_power", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base & _M64, np.uint64)
            step[0] = 1
            globals()[name] = np.multiply.accumulate(step)
    return _power, _inverse


class Sequence:
    """Hashes of ranges of a sequence of 64-bit units, from one running sum."""

    def __init__(self, units: np.ndarray):
        power, self.inverse = _powers(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * power[:len(units)], out=self.sums[1:])

    def ranges(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, q: int) -> np.ndarray:
        """Of the q units from every place on."""
        n = len(self.sums) - q
        return mix((self.sums[q:] - self.sums[:-q]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string or binary array, and the offsets of its values (no copy)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(at):
        at = np.zeros(1, np.int64)
    return buf[at[0]:at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int | None = None):
    """Ranges (i, j) of documents that together hold at most ``limit`` units, or one each."""
    limit, i = limit or PIECE, 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(buf: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
    """Starts, ends and document numbers of the words of a buffer; ``between``: the bytes that
    are in no word."""
    inside = ~between[buf]
    if not inside.any():
        z = np.zeros(0, np.int64)
        return z, z, z
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(buf)]
    before[first] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    after[last] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(buf: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
    """Hash of every word, and the offsets of the documents in words."""
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in pieces(offsets):
        a, b = offsets[i], offsets[j]
        start, end, doc = words(buf[a:b], offsets[i:j + 1] - a, between)
        if len(start):
            hashes.append(Sequence(BYTE_VALUE[buf[a:b]]).ranges(start, end))
            counts[i:j] = np.bincount(doc, minlength=j - i)
    at = np.zeros(len(offsets), np.int64)
    np.cumsum(counts, out=at[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), at


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:-(width - k)], x[width - k:]) if k < width else x


def anchors(units: np.ndarray, offsets: np.ndarray, window: int, q: int):
    """The anchor of every window: the q-gram with the smallest hash in it, the first of equals.

    Equal windows have their anchors at the same place. Returns arrays, one entry per anchor:
    doc, place of the anchor, first and last start of the windows that it stands for (all
    relative to the document), hash of its q-gram, hash of its region (first start to the
    end of the last window, and the anchor's place in it).
    """
    n = len(units)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    seq = Sequence(units)
    gram = seq.grams(q)
    order = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    chosen = (_sliding_min(order, window - q + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)
    long = np.diff(offsets) >= window
    inside[offsets[:-1][long]] += 1
    np.subtract.at(inside, offsets[1:][long] - window + 1, 1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(starts):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    picked = chosen[starts]
    cut = np.flatnonzero(np.diff(picked)) + 1
    low = starts[np.concatenate(([0], cut))]
    high = starts[np.concatenate((cut - 1, [len(starts) - 1]))]
    place = chosen[low]
    doc = np.searchsorted(offsets, low, "right") - 1
    region = mix(seq.ranges(low, high + window) + (place - low).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
                 + (high - low).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    base = offsets[doc]
    return doc, place - base, low - base, high - base, gram[place], region
