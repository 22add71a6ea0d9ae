"""Windows that occur more than once, found across all documents.

Used by both passage operators. A window is a fixed number of units (bytes or words) of one
document. Every window has an anchor, the q-gram of least hash in it, so equal windows meet
at equal anchors; about ``2 / (window - q + 2)`` of the places are anchors, and only they
are shuffled:

1. ``anchor_rows``: documents to anchors. Equal regions (the text that all windows of an
   anchor cover) of one batch are merged at once, so a passage that many documents share
   leaves a batch once.
2. ``settle``: anchors meet by q-gram, sorted, and are read as a stream: an equal region
   seen before settles its windows; q-grams whose regions differ go on as open anchors.
3. ``contexts``: the open anchors' regions are cut out of the documents and meet by q-gram
   again, where the operator compares their windows by its own method.

The contexts of one q-gram are a shard, compared in one task. A shard of too many units is cut
into smaller ones by a longer q-gram (twice as long each time, up to the whole window): its
windows get new anchors and pass 2 and 3 again. At the whole window a shard is one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import RID, frozen
from sheen.llm.hashing import BYTE_VALUE, PIECE, anchors, mix, pieces, text_buffer, word_hashes

ROWS = "g long, e long, rid long, pos int, lo int, hi int, n int"
COLS = ("g", "e", "rid", "pos", "lo", "hi", "n")
OPEN = "open boolean, " + ROWS
#: Contexts that a task compares at a time.
CONTEXTS = 20_000


def _batch(cols: dict) -> pa.RecordBatch:
    kinds = {"rid": np.int64, "pos": np.int32, "lo": np.int32, "hi": np.int32, "n": np.int32}
    return pa.RecordBatch.from_pydict({k: pa.array(
        v.view(np.int64) if v.dtype == np.uint64 else v.astype(kinds.get(k, v.dtype), copy=False))
        for k, v in cols.items()})


def units_of(kind: str, buf: np.ndarray, offsets: np.ndarray):
    """Units of the texts of a buffer, and the documents' offsets in units."""
    if kind == "words":
        return word_hashes(buf, offsets)
    return None, offsets


def _spans(rid, lo, hi):
    """Settled windows as rows: runs of a document's window starts, merged where they touch."""
    order = np.lexsort((lo, rid))
    rid, lo, hi = rid[order], lo[order], hi[order]
    if not len(rid):
        return rid, lo, hi
    new = np.ones(len(rid), bool)
    new[1:] = rid[1:] != rid[:-1]
    far = np.cumsum(new) << 32  # keeps the running maximum inside a document
    new[1:] |= lo[1:] + far[1:] > np.maximum.accumulate(hi + far)[:-1] + 1
    at = np.flatnonzero(new)
    return rid[at], lo[at], np.maximum.reduceat(hi, at)


def anchor_rows(docs: DataFrame, kind: str, window: int, q: int, both: bool) -> DataFrame:
    """Anchors of all documents; rows with n = 0 are windows that their batch has settled.

    ``both``: every occurrence of a repeated window is wanted, not only the later ones.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            buf, off = text_buffer(batch.column(1))
            units, uoff = units_of(kind, buf, off)
            got = []
            for i, j in pieces(uoff, PIECE):
                a, b = uoff[i], uoff[j]
                u = units[a:b] if units is not None else BYTE_VALUE[buf[a:b]]
                doc, pos, lo, hi, g, e = anchors(u, uoff[i:j + 1] - a, window, q)
                got.append((g, e, rids[i + doc], pos, lo, hi))
            if not got:
                continue
            g, e, rid, pos, lo, hi = (np.concatenate(x) for x in zip(*got))
            order = np.lexsort((pos, rid, e, g))
            g, e, rid, pos, lo, hi = (x[order] for x in (g, e, rid, pos, lo, hi))
            if not len(g):
                continue
            first = np.ones(len(g), bool)
            first[1:] = (g[1:] != g[:-1]) | (e[1:] != e[:-1])
            at = np.flatnonzero(first)
            n = np.diff(np.append(at, len(g)))
            known = ~first
            if both:
                known |= np.repeat(n > 1, n)
            srid, slo, shi = _spans(rid[known], lo[known], hi[known])
            yield _batch(dict(zip(COLS, (g[at], e[at], rid[at], pos[at], lo[at], hi[at], n))))
            if len(srid):
                z = np.zeros(len(srid), np.int64)
                away = mix(srid.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + slo.astype(np.uint64))
                yield _batch(dict(zip(COLS, (away, z, srid, z, slo, shi, z))))

    return docs.select(F.col(RID).alias("rid"), "t").mapInArrow(run, ROWS)


def settle(rows: DataFrame, both: bool, partitions: int) -> DataFrame:
    """Settled windows (open false; rid, lo, hi) and open anchors, one per distinct region."""
    def run(batches: Iterator[pa.RecordBatch]):
        held, several = None, None  # the last q-gram's waiting rows; the q-gram known to have several regions

        def split(x, end):
            nonlocal held, several
            done = x["n"] == 0
            out = [{k: v[done] for k, v in x.items()}]
            x = {k: v[~done] for k, v in x.items()}
            if held is not None:
                x = {k: np.concatenate((held[k], x[k])) for k in COLS}
            held = None
            g, e, n = x["g"], x["e"], x["n"].astype(np.int64)
            opened = None
            if len(g):
                first = np.ones(len(g), bool)
                first[1:] = (g[1:] != g[:-1]) | (e[1:] != e[:-1])
                at = np.flatnonzero(first)
                total = np.add.reduceat(n, at)
                known = ~first
                if both:  # rows that stand for several were settled by their batch
                    known = np.repeat(total > 1, np.diff(np.append(at, len(g)))) & (n == 1)
                out.append({k: v[known] for k, v in x.items()})
                rep = {k: v[at] for k, v in x.items()}
                rep["n"] = total
                rg = rep["g"]
                many = np.zeros(len(rg), bool)
                many[1:] |= rg[1:] == rg[:-1]
                many[:-1] |= rg[1:] == rg[:-1]
                if several is not None:
                    many |= rg == several
                if not end:  # the last region may go on in the next batch
                    held = {k: v[-1:] for k, v in rep.items()}
                    several = rg[-1] if many[-1] else None
                    many[-1] = False
                opened = {k: v[many] for k, v in rep.items()}
            return out, opened

        def emit(out, opened):
            rid, lo, hi = (np.concatenate([o[k] for o in out]) for k in ("rid", "lo", "hi"))
            rid, lo, hi = _spans(rid, lo, hi)
            z = np.zeros(len(rid), np.int64)
            if len(rid):
                yield _batch({"open": z.astype(bool), "g": z, "e": z, "rid": rid, "pos": z, "lo": lo, "hi": hi, "n": z})
            if opened is not None and len(opened["g"]):
                yield _batch({"open": np.ones(len(opened["g"]), bool), **opened})

        for batch in batches:
            x = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(COLS)}
            yield from emit(*split(x, False))
        yield from emit(*split({k: np.zeros(0, np.int64) for k in COLS}, True))

    rows = rows.repartition(partitions, "g").sortWithinPartitions("g", "e", "rid", "pos", "lo")
    return rows.mapInArrow(run, OPEN)


def contexts(docs: DataFrame, opened: DataFrame, kind: str, window: int) -> DataFrame:
    """Open anchors with the text of their region: (g, rid, lo, hi, n, data)."""
    asked = opened.groupBy("rid").agg(F.collect_list(F.struct("g", "lo", "hi", "n")).alias("asked"))
    texts = docs.select(F.col(RID).alias("rid"), "t").join(asked, "rid")

    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            units, uoff = units_of(kind, buf, off)
            raw = buf if units is None else units.view(np.uint8)
            size = 1 if units is None else 8
            data = raw.tobytes()
            wanted = batch.column(2)
            per = np.diff(np.frombuffer(wanted.buffers()[1], np.int32)[wanted.offset:wanted.offset + len(wanted) + 1])
            flat = wanted.flatten()
            g, lo, hi, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("g", "lo", "hi", "n"))
            rid = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), per)
            base = np.repeat(uoff[:-1], per)
            a, b = (base + lo) * size, (base + hi + window) * size
            for k in range(0, len(g), CONTEXTS):
                s = slice(k, k + CONTEXTS)
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array(g[s]), "rid": pa.array(rid[s]), "lo": pa.array(lo[s]), "hi": pa.array(hi[s]),
                    "n": pa.array(n[s]), "data": pa.array([data[x:y] for x, y in zip(a[s].tolist(), b[s].tolist())], pa.binary())})

    return texts.mapInArrow(run, "g long, rid long, lo int, hi int, n int, data binary")


def compare(ctx: DataFrame, repeated: Callable, partitions: int) -> DataFrame:
    """(rid, lo, hi): windows of the contexts that ``repeated`` names, q-gram by q-gram.

    ``repeated(g, rid, lo, hi, n, data)`` gets whole q-gram groups in the order (g, rid, lo)
    and returns (rid, lo, hi) runs of window starts.
    """
    def run(batches):
        held = None
        names = ("g", "rid", "lo", "hi", "n")

        def work(x, data):
            if len(x[0]):
                rid, lo, hi = _spans(*repeated(*x, data))
                if len(rid):
                    yield _batch({"rid": rid, "lo": lo, "hi": hi})

        for batch in batches:
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            data = batch.column(5).to_pylist()
            if held is not None:
                x, data = [np.concatenate((h, v)) for h, v in zip(held[0], x)], held[1] + data
            last = int(np.searchsorted(x[0], x[0][-1], "left")) if len(x[0]) else 0
            if last < CONTEXTS:
                held = (x, data)
                if last == 0 or len(x[0]) < CONTEXTS:
                    continue
            yield from work([v[:last] for v in x], data[:last])
            held = ([v[last:] for v in x], data[last:])
        if held is not None:
            yield from work(*held)

    return (ctx.repartition(partitions, "g").sortWithinPartitions("g", "rid", "lo")
            .mapInArrow(run, "rid long, lo int, hi int"))


def longer_anchors(ctx: DataFrame, kind: str, window: int, q: int) -> DataFrame:
    """Anchors of the contexts' windows by q-grams of another length; ``pos`` is the context's ``lo``."""
    def run(batches):
        for batch in batches:
            rid, start, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            raw, off = text_buffer(batch.column(3))
            if kind == "words":
                units, off = np.frombuffer(raw.tobytes(), np.uint64), off // 8
            else:
                units = BYTE_VALUE[raw]
            for i, j in pieces(off, PIECE):
                doc, _, lo, hi, g, e = anchors(units[off[i]:off[j]], off[i:j + 1] - off[i], window, q)
                row = i + doc
                yield _batch(dict(zip(COLS, (g, e, rid[row], start[row], start[row] + lo, start[row] + hi, n[row]))))

    return ctx.select("rid", "lo", "n", "data").mapInArrow(run, ROWS)


def repeated_windows(docs: DataFrame, kind: str, window: int, q: int, both: bool, repeated: Callable,
                     shard: int) -> DataFrame:
    """(rid, lo, hi): runs of starts of the windows that occur elsewhere (``both``), or that
    also start earlier (smaller row id, or same row and earlier place). ``docs`` has RID and
    t, the text without nulls. ``shard``: units (bytes or words) that one task compares together."""
    conf = docs.sparkSession.conf
    parts = max(1, int(conf.get("spark.sql.shuffle.partitions")))
    size = 8 if kind == "words" else 1
    state = frozen(settle(anchor_rows(docs, kind, window, q, both), both, parts), "anchors")
    out = state.where("not open").select("rid", "lo", "hi")
    opened = state.where("open")
    ctx = contexts(docs, opened, kind, window)
    while q < window:
        units = F.sum(F.col("hi") - F.col("lo") + window)
        large = frozen(opened.groupBy("g").agg(units.alias("units")).where(f"units > {shard}").select("g"), "large")
        if not large.limit(1).count():
            break
        ctx = frozen(ctx, "contexts")
        out = out.union(compare(ctx.join(large, "g", "left_anti"), repeated, parts))
        ctx = frozen(ctx.join(large, "g", "left_semi"), "contexts")
        q = min(2 * q, window)
        state = frozen(settle(longer_anchors(ctx, kind, window, q), both, parts), "anchors")
        out = out.union(state.where("not open").select("rid", "lo", "hi"))
        opened = state.where("open")
        region = F.expr(f"substring(data, (lo - pos) * {size} + 1, (hi - lo + {window}) * {size})")
        ctx = (opened.select("g", "rid", "pos", "lo", "hi", "n")
               .join(ctx.select("rid", F.col("lo").alias("pos"), "data"), ["rid", "pos"])
               .select("g", "rid", "lo", "hi", "n", region.alias("data")))
    return out.union(compare(ctx, repeated, parts))


def spans_of(runs: DataFrame) -> DataFrame:
    """(rid, runs): each document's runs in one list, as long as its text at most."""
    return runs.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def run_lists(column) -> Iterator[np.ndarray | None]:
    """Per row of a Spark list of (lo, hi): sorted arrays, None where there are none."""
    flat = column.flatten()
    lo, hi = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "hi"))
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    at = at - at[0] if len(at) else at
    for i in range(len(column)):
        if at[i] == at[i + 1]:
            yield None
        else:
            a, b = lo[at[i]:at[i + 1]], hi[at[i]:at[i + 1]]
            order = np.argsort(a)
            yield np.stack((a[order], b[order]))


def covered(runs: np.ndarray, window: int):
    """Merged (start, end) of the units that windows starting in the runs cover."""
    start, end = runs[0], np.maximum.accumulate(runs[1] + window)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:] - 1, len(start) - 1)]
