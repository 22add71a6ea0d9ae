"""Removal of repeated 100-byte strings by suffix sorting with bucket refinement."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import RID, with_row_id
from sheen.llm.hashing import text_buffer
from sheen.llm.repeats import covered, repeated_windows, run_lists, spans_of

#: Length of a string, in bytes.
LENGTH = 100
#: Length of an anchor's q-gram, in bytes.
GRAM = 24
#: Bytes that one task refines together; a q-gram with more is cut by a longer one.
SHARD = 2_000_000


def refine(buf: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket of the ``length`` bytes from each of ``starts``; equal buckets, equal strings.

    ``ends``: for every place of ``buf``, the end of the text that it lies in. Bucket-pointer
    refinement: places fall into buckets by their first 8 bytes; a bucket is then refined by
    the buckets at a later offset of its places, which themselves were refined in the round
    before, so that every round doubles the depth, and the last one reaches ``length``.
    Places whose bucket holds nothing else keep it and leave the sorting.
    """
    n, depth = len(buf), 8
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    fits = np.arange(n) + depth <= ends
    bucket = np.full(n, -1, np.int64)
    bucket[fits] = np.unique(key[fits], return_inverse=True)[1]
    while depth < length:
        step = min(depth, length - depth)
        at = np.flatnonzero((bucket >= 0) & (np.arange(n) + depth + step <= ends))
        if depth + step == length:
            at = starts
        m = int(bucket.max()) + 1 if len(bucket) else 1
        pair = bucket[at] * m + bucket[at + step]
        shared = np.bincount(bucket[at], minlength=m)[bucket[at]] > 1
        fresh = np.full(n, -1, np.int64)
        fresh[at[~shared]] = np.arange(int((~shared).sum()))
        base = int((~shared).sum())
        fresh[at[shared]] = base + np.unique(pair[shared], return_inverse=True)[1]
        bucket, depth = fresh, depth + step
    return bucket[starts]


def _later(length: int):
    """Of contexts in (g, rid, lo) order, the windows whose string starts earlier, too."""
    def find(g, rid, lo, hi, n, data):
        size = np.array([len(d) for d in data])
        buf = np.frombuffer(b"".join(data), np.uint8)
        off = np.concatenate(([0], np.cumsum(size)))
        count = hi - lo + 1
        row = np.repeat(np.arange(len(g)), count)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        bucket = refine(buf, np.repeat(off[1:], size), off[row] + inside, length)
        _, first = np.unique(bucket, return_index=True)
        again = np.ones(len(bucket), bool)
        again[first] = False
        p = lo[row[again]] + inside[again]
        return rid[row[again]], p, p
    return find


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                 gram: int = GRAM) -> DataFrame:
    """One row per input row: RID, ``key``, n_bytes, kept (binary: the remaining bytes),
    n_removed, n_spans.

    Every byte covered by a string of ``length`` bytes that also starts earlier (smaller row
    id, which is the order of ``key``; or same row, earlier start) is removed; strings are
    judged on the input. Null text: empty. Shorter texts keep all bytes. Repeated keys are
    ordered by their rows. Null keys sort first. Empty table: empty result. Extra columns are
    not read. Very long texts are read whole, each in one task, which also holds the text's
    anchors and removed runs.
    """
    docs = with_row_id(docs, key, text).select(RID, F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    runs = repeated_windows(docs, "bytes", length, gram, False, _later(length), SHARD)
    both = docs.join(spans_of(runs).withColumnRenamed("rid", RID), RID, "left")

    def cut(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            kept, removed, spans = [], [], []
            for i, r in enumerate(run_lists(batch.column(3))):
                t = buf[off[i]:off[i + 1]]
                if r is None:
                    kept.append(t.tobytes())
                    removed.append(0)
                    spans.append(0)
                    continue
                start, end = covered(r, length)
                edge = np.zeros(len(t) + 1, np.int8)
                edge[start] += 1
                edge[end] -= 1
                kept.append(t[np.cumsum(edge[:-1]) == 0].tobytes())
                removed.append(int((end - start).sum()))
                spans.append(len(start))
            yield pa.RecordBatch.from_pydict({
                RID: batch.column(0), "id": batch.column(1), "n_bytes": pa.array(np.diff(off)),
                "kept": pa.array(kept, pa.binary()), "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64())})

    kind = dict(docs.dtypes)["id"]
    return (both.select(RID, "id", "t", F.coalesce("runs", F.array().cast("array<struct<lo:int,hi:int>>")).alias("runs"))
            .mapInArrow(cut, f"{RID} long, id {kind}, n_bytes long, kept binary, n_removed long, n_spans long")
            .withColumnRenamed("id", key))
