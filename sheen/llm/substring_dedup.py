"""Removal of passages that occur elsewhere, by suffix automata of reference shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import RID, with_row_id
from sheen.llm.hashing import text_buffer
from sheen.llm.repeats import covered, repeated_windows, run_lists, spans_of

#: Words of a window.
WORDS = 35
#: Words of an anchor.
GRAM = 8
#: Words of a reference shard; a q-gram with more is cut by a longer one.
SHARD = 200_000


class Automaton:
    """Suffix automaton of several sequences; ``count`` is how often a state's strings occur."""

    def __init__(self, sequences, weights):
        self.next, self.link, self.length, self.count = [{}], [-1], [0], [0]
        for s, w in zip(sequences, weights):
            last = 0
            for c in s:
                last = self._extend(last, c)
                self.count[last] += w
        link, count = self.link, self.count
        for v in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            count[link[v]] += count[v]

    def _clone(self, p, q, c):
        nxt, link, length = self.next, self.link, self.length
        r = len(nxt)
        nxt.append(nxt[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        self.count.append(0)
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = r
            p = link[p]
        link[q] = r
        return r

    def _extend(self, last, c):
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.count.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def repeated_ends(self, sequence, width: int):
        """Ends (exclusive) of the stretches of ``width`` units of ``sequence`` that occur at
        least twice in the reference: the stream of matching statistics, cut at ``width``."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        v = matched = 0
        for i, c in enumerate(sequence):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            if matched >= width:
                while length[link[v]] >= width:
                    v = link[v]
                matched = min(matched, length[v])
                if count[v] >= 2:
                    yield i + 1


def _elsewhere(width: int):
    """Of contexts sorted by g, the windows that occur at least twice: each q-gram's contexts
    are a reference shard, and the contexts that no equal region has settled stream through it."""
    def find(g, rid, lo, hi, n, data):
        cut = np.flatnonzero(np.diff(g)) + 1
        rids, at = [], []
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(g)]):
            seqs = [np.frombuffer(d, np.int64).tolist() for d in data[a:b]]
            auto = Automaton(seqs, n[a:b].tolist())
            for k in range(a, b):
                if n[k] == 1:
                    ends = list(auto.repeated_ends(seqs[k - a], width))
                    rids += [rid[k]] * len(ends)
                    at += [lo[k] + e - width for e in ends]
        p = np.array(at, np.int64)
        return np.array(rids, np.int64), p, p
    return find


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS,
                    gram: int = GRAM) -> DataFrame:
    """One row per input row: RID, ``key``, n_words, n_removed, kept (the remaining words,
    joined by one space).

    A word is removed if a window of ``width`` words that covers it also starts anywhere
    else, in the same row or another; windows are judged on the input. The reference is the
    corpus itself, in shards: a window is sent to the shard of its anchor (see
    ``repeats``), where a suffix automaton of the shard's distinct regions gives matching
    statistics. So no shard goes to all documents, and a shard is bounded.

    Null text: no words. Texts of fewer words keep all. Repeated rows repeat each other's
    windows. Null keys are rows like others. Empty table: empty result. Extra columns are
    not read. Very long texts are read whole, each in one task, which also holds the text's
    words, anchors and removed runs.
    """
    docs = with_row_id(docs, key, text).select(RID, F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    runs = repeated_windows(docs, "words", width, gram, True, _elsewhere(width), SHARD)
    both = docs.join(spans_of(runs).withColumnRenamed("rid", RID), RID, "left")

    def cut(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            data = buf.tobytes()
            kept, total, removed = [], [], []
            for i, r in enumerate(run_lists(batch.column(3))):
                words = data[off[i]:off[i + 1]].split()
                total.append(len(words))
                if r is not None:
                    start, end = covered(r, width)
                    for a, b in zip(start[::-1].tolist(), end[::-1].tolist()):
                        del words[a:b]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_pydict({
                RID: batch.column(0), "id": batch.column(1), "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    kind = dict(docs.dtypes)["id"]
    return (both.select(RID, "id", "t", F.coalesce("runs", F.array().cast("array<struct<lo:int,hi:int>>")).alias("runs"))
            .mapInArrow(cut, f"{RID} long, id {kind}, n_words long, n_removed long, kept string")
            .withColumnRenamed("id", key))
