"""Periodic runs of words: maximal repetitions from suffix trees and Lyndon roots.

A run's Lyndon root is the longest Lyndon word from its start under one of two opposite
word orders, so a text of n words has at most 2n candidates. Each is extended in both
directions by one longest-common-extension query to the right and one to the left: the
lowest common ancestor of two leaves in the suffix tree of the text and of its reversal.

Words that no run can hold are told apart first. A run of 12 words or more repeats each of its
6-grams one period on, so it lies within a stretch of words that are all covered by
6-grams which occur more than once in that stretch; only such stretches get trees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.hashing import mix, text_buffer

#: Words that a run has at least; it has two periods at least, too.
LEAST = 12
#: Times that a stretch is split into smaller ones by its own repeated grams. More would only
#: save work: a stretch may be larger than its runs.
SPLITS = 8


def suffix_tree(s: list[int]):
    """Ukkonen's tree of ``s``, whose last symbol is 0 and found nowhere else.

    Returns (edges, depth, suffix): a dict from parent * symbols + first symbol to child; the
    string depth of each inner node; the start of each leaf's suffix, -1 for inner nodes.
    """
    n, symbols = len(s), max(s) + 1
    start, stop, link, depth, suffix = [0], [0], [0], [0], [-1]
    go: dict[int, int] = {}
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        last = 0
        while rest:
            if not length:
                edge = i
            key = node * symbols + s[edge]
            child = go.get(key)
            if child is None:
                go[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                depth.append(0)
                suffix.append(i - rest + 1)
                if last:
                    link[last] = node
                    last = 0
            else:
                at = start[child]
                span = stop[child] - at
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[at + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                inner = len(start)
                go[key] = inner
                go[inner * symbols + c] = inner + 1
                go[inner * symbols + s[at + length]] = child
                start += (at, i)
                stop += (at + length, n)
                link += (0, 0)
                depth += (rest - 1, 0)
                suffix += (-1, i - rest + 1)
                start[child] = at + length
                if last:
                    link[last] = inner
                last = inner
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return go, depth, suffix


class Extensions:
    """Longest common extensions of the suffixes of a word list, each in constant time.

    An Euler tour of the suffix tree, children by first symbol, meets the leaves in the order
    of their suffixes; the shallowest node between two leaves is their lowest common ancestor
    and its string depth the length of their common prefix. A sparse table over the depths
    between neighbouring leaves finds it.
    """

    def __init__(self, s: list[int]):
        go, depth, suffix = suffix_tree(s)
        symbols = max(s) + 1
        keys = np.fromiter(go.keys(), np.int64, len(go))
        order = np.argsort(keys)
        child = np.fromiter(go.values(), np.int64, len(go))[order]
        del go
        parent = keys[order] // symbols
        first = np.searchsorted(parent, np.arange(len(suffix) + 1))
        met = np.zeros(len(suffix), np.int64)  # depth of the last node that the tour met before a child's first leaf
        met[child] = np.array(depth, np.int64)[parent]
        kids, first, met = child.tolist(), first.tolist(), met.tolist()
        leaves, low, stack = [], [], [0]
        while stack:
            v = stack.pop()
            a, b = first[v], first[v + 1]
            if a == b:
                leaves.append(suffix[v])
                low.append(met[v])
            else:
                met[kids[a]] = met[v]
                stack += kids[a:b][::-1]
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.table = [np.array(low, np.int32)]
        width = 1
        while 2 * width < len(low):
            t = self.table[-1]
            self.table.append(np.minimum(t[:-width], t[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the suffixes from i and from j on, i != j."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            t = self.table[k]
            out[at] = np.minimum(t[a[at]], t[b[at] - (1 << int(k))])
        return out


def _next(rank: list[int], n: int, smaller: bool) -> np.ndarray:
    """The next place whose suffix is smaller (or greater), n where there is none."""
    out, stack = [n] * n, []
    for i in range(n):
        r = rank[i] if smaller else -rank[i]
        while stack and stack[-1][0] > r:
            out[stack.pop()[1]] = i
        stack.append((r, i))
    return np.array(out, np.int64)


def runs_of(words: list, least: int = LEAST) -> np.ndarray:
    """All runs of a list of words as rows (start, length, period), by start, then period.

    A run is a stretch with smallest period q and at least ``max(least, 2 * q)`` words that no
    neighbouring word extends keeping the period.
    """
    n = len(words)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    number: dict = {}
    s = [number.setdefault(w, len(number) + 1) for w in words]
    right, left = Extensions([*s, 0]), Extensions([*s[::-1], 0])
    rank = right.rank[:n].tolist()
    i = np.tile(np.arange(n), 2)
    j = np.concatenate((_next(rank, n, True), _next(rank, n, False)))  # Lyndon words i..j of both orders
    some = (j < n) | (np.arange(2 * n) < n)  # the text's end is the least suffix, never a greater one
    i, j = i[some], j[some]
    period, end, begin = j - i, j + right.common(i, j), i - left.common(n - i, n - j)
    keep = (end - begin >= 2 * period) & (end - begin >= least)
    return np.unique(np.column_stack((begin, end - begin, period))[keep], axis=0)


def stretches(hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Ranges of words outside which no run of ``least`` words or more can lie.

    A run of length L and period q has L - q >= least / 2, so each of its words is in a gram of
    least / 2 words that also starts one period before or after, inside the run.
    """
    q = max(1, least // 2)
    if len(hashes) < least:
        return []
    grams = np.zeros(len(hashes) - q + 1, np.uint64)
    for k in range(q):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - q + 1 + k]
    grams = mix(grams)
    found, todo = [], [(0, len(hashes), 0)]
    while todo:
        a, b, depth = todo.pop()
        g = grams[a:b - q + 1]
        order = np.argsort(g, kind="stable")
        equal = g[order[1:]] == g[order[:-1]]
        if not equal.any():
            continue
        again = np.zeros(len(g), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        cover = np.zeros(b - a + 1, np.int64)
        at = np.flatnonzero(again)
        cover[at] += 1
        cover[at + q] -= 1
        inside = np.concatenate(([False], np.cumsum(cover[:-1]) > 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + a
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if y - x >= least:
                if (x, y) == (a, b) or depth == SPLITS:
                    found.append((x, y))
                else:
                    todo.append((x, y, depth + 1))
    return sorted(found)


def document_runs(words: list, least: int = LEAST) -> np.ndarray:
    """``runs_of`` the whole list, its repeating stretches one by one."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    parts = []
    for a, b in stretches(mix(hashes), least):
        r = runs_of(words[a:b], least)
        r[:, 0] += a
        parts.append(r)
    return np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per input row: ``key``, n_words long, runs (array of start, length, period in
    words, by start, then period) and collapsed, the text without what its runs repeat.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of consecutive words
    with smallest period q and at least max(``least``, 2q) words that no neighbouring word
    extends keeping the period. A word is dropped if a run contains it after the run's first q
    words; the rest, joined by one space, is ``collapsed``.

    Null and empty texts, or only white space: no words, no runs, an empty text. Null and
    repeated keys and repeated rows: one output row each. Any key type. Other columns are not
    read, whatever their names. Empty table: empty result. Rows are worked on where they are
    read, without a shuffle. Very long texts are taken whole; a task holds the words of one
    text and two trees of its longest repeating stretch, some 0.5 KB a word of that stretch.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), 512):  # so that texts of one slice are held twice only
                yield found(batch.slice(k, 512))

    def found(batch):
        buf, off = text_buffer(batch.column(1))
        data = memoryview(buf)
        counts, per, table, out = [], [0], [], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            words = bytes(data[a:b]).split()  # bytes split at exactly \x20 and \x09-\x0D
            runs = document_runs(words, least)
            counts.append(len(words))
            per.append(per[-1] + len(runs))
            table.append(runs)
            out.append(b" ".join(collapsed(words, runs)))
        flat = np.concatenate(table) if table else np.zeros((0, 3), np.int64)
        struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
        return pa.RecordBatch.from_pydict({
            "id": batch.column(0), "n_words": pa.array(counts, pa.int64()),
            "runs": pa.ListArray.from_arrays(pa.array(per, pa.int32()), struct),
            "collapsed": pa.array(out, pa.binary()).cast(pa.string())})

    done = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_words long, runs {RUNS}, collapsed string")
    return done.withColumnRenamed("id", key)


def with_planted_periods(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text`` of all rows, a tenth of them made periodic from some word on.

    With h the CRC-32 of the key in decimal and g = h // 10: where h % 10 = 0 and the text has n > 0
    words, word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    Rows with a null key or text stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col(key), F.col(text), h.alias("__h__"))
    due = rows.withColumn("__w__", F.when(F.col("__h__") % 10 == 0, words))
    g, n = F.floor(F.col("__h__") / 10), F.size("__w__")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - F.col("__a__")) / (F.lit(3) + g % 8))).cast("int")
    at = lambda i: F.when(i < F.col("__a__"), i).otherwise(F.col("__a__") + (i - F.col("__a__")) % F.col("__p__"))
    made = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("__w__", at(i))))
    planted = n > 0
    due = due.withColumn("__a__", F.when(planted, a)).withColumn("__p__", F.when(planted, p))
    return due.select(F.col(key), F.when(planted, made).otherwise(F.col(text)).alias(text))


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``periodic_runs``' rows as counts, each document's longest run, and digests."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    top = found.withColumn("top", longest)
    length, period = F.col("top.length"), -F.col("top.p")
    return top.select(
        key, F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
