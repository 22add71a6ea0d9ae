"""MinHash near-dedup with tensored banding, candidates verified on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.buckets import block_pairs, dealt_in_blocks, lowest_reached, objects, with_both
from sheen.llm.common import RID, components, frozen, with_row_id
from sheen.llm.hashing import LOWER, mix, pieces, text_buffer, word_hashes

#: MinHashes in a band.
BAND = 3
#: Bands of each of the two collections, by the least similarity (in percent) that they serve:
#: every pair of a band of one and a band of the other is a table key, so n + n bands make n * n
#: tables. At the threshold itself a link is missed with a chance of about 2 * (1 - s**BAND)**n.
BANDS = ((85, 10), (80, 12), (0, 16))
#: Documents of a piece; their number and a shingle's hash share 64 bits.
DOCS = 2048
#: Candidates whose minhashes agree in fewer percent are no pair of a family.
ALIKE = 45
#: Documents of a block when a family is compared.
BLOCK = 512
#: Shingles of two blocks that are counted at a time.
COLUMNS = 4096


def bands_for(percent: int) -> int:
    return next(n for least, n in BANDS if percent >= least)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int):
    """Per piece of documents: (i, j, sorted distinct shingles as 53-bit hashes, their counts).

    Words are maximal runs without white space, A-Z lower-cased. A document of fewer than
    ``width`` words has its whole sequence as one shingle, one without words none.
    """
    hashes, at = word_hashes(LOWER[buf], offsets)
    for i, j in pieces(at):
        for i in range(i, j, DOCS):
            k = min(i + DOCS, j)
            h, o = hashes[at[i]:at[k]], at[i:k + 1] - at[i]
            per = np.diff(o)
            n = len(h) - width + 1
            grams = np.zeros(max(n, 0), np.uint64)
            for w in range(width if n > 0 else 0):
                grams = (grams ^ h[w:w + n]) * np.uint64(0x9E3779B97F4A7C15)
                grams ^= grams >> np.uint64(29)
            count = np.maximum(per - width + 1, 0)
            doc = np.repeat(np.arange(k - i), count)
            start = np.repeat(o[:-1], count) + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            all_h, all_d = [mix(grams[start])], [doc]
            short = np.flatnonzero((per > 0) & (per < width))
            for d in short.tolist():
                x = np.uint64(per[d])
                for v in h[o[d]:o[d + 1]]:
                    x = mix(np.array([x ^ v]))[0]
                all_h.append(np.array([x]))
                all_d.append(np.array([d]))
            key = (np.concatenate(all_d).astype(np.uint64) << np.uint64(53)) | (np.concatenate(all_h) >> np.uint64(11))
            key.sort()
            if len(key):
                key = key[np.concatenate(([True], key[1:] != key[:-1]))]
            sizes = np.bincount((key >> np.uint64(53)).astype(np.int64), minlength=k - i)
            yield i, k, key & np.uint64((1 << 53) - 1), sizes


def _seeds(n):
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def _signatures(docs: DataFrame, width: int, hashes: int) -> DataFrame:
    """(RID, id, n, f1, f2, sig, sketch): set size, 128-bit fingerprint of the set, its minhashes
    and one byte of each."""
    seeds = _seeds(hashes)

    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            m = len(batch)
            n, f1, f2 = np.zeros(m, np.int64), np.zeros(m, np.uint64), np.zeros(m, np.uint64)
            sig = np.zeros((m, hashes), np.uint32)
            for i, j, s, sizes in shingle_sets(buf, off, width):
                n[i:j] = sizes
                full = np.flatnonzero(sizes)
                if len(full):
                    at = (np.cumsum(sizes) - sizes)[full]
                    h = mix(s)
                    f1[i + full] = np.add.reduceat(h, at)
                    f2[i + full] = np.add.reduceat(mix(h * np.uint64(0xFF51AFD7ED558CCD)), at)
                    for k in range(hashes):
                        sig[i + full, k] = np.minimum.reduceat(h * seeds[k], at) >> np.uint64(32)
            yield pa.RecordBatch.from_pydict({
                RID: batch.column(0), "id": batch.column(1), "n": pa.array(n), "f1": pa.array(f1.view(np.int64)),
                "f2": pa.array(f2.view(np.int64)), "sig": pa.array([x.tobytes() for x in sig], pa.binary()),
                "sketch": pa.array([x.tobytes() for x in sig.astype(np.uint8)], pa.binary())})

    kind = dict(docs.dtypes)["id"]
    return docs.select(RID, "id", "t").mapInArrow(run, f"{RID} long, id {kind}, n long, f1 long, f2 long, sig binary, sketch binary")


def _matrix(column, kind) -> np.ndarray:
    return np.frombuffer(text_buffer(column)[0], kind).reshape(len(column), -1)


def _candidates(sig: DataFrame, bands: int, partitions: int) -> DataFrame:
    """(a, b): of every table key, each document with the key's first one, and with the first
    one that also has one more band in common. The second keeps documents together whose key's
    first document is like neither."""
    def keys(batches):
        for batch in batches:
            s = _matrix(batch.column(1), np.uint32)
            band = np.zeros((len(s), 2 * bands), np.uint64)
            for b in range(2 * bands):
                for k in range(BAND):
                    band[:, b] = mix(band[:, b] + s[:, b * BAND + k] + np.uint64(b * 7919 + k + 1))
            first, second = band[:, :bands], band[:, bands:]
            both = mix(first[:, :, None] * np.uint64(0x9FB21C651E98DF25) + second[:, None, :])
            more = np.repeat((np.roll(first, 1, axis=1) & np.uint64(0x7FFF)).astype(np.int16), bands, axis=1)
            rid = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands * bands)
            key, more = both.reshape(-1).view(np.int64), more.reshape(-1)
            for i in range(0, len(key), 1 << 20):
                x = slice(i, i + (1 << 20))
                yield pa.RecordBatch.from_pydict({"key": pa.array(key[x]), "more": pa.array(more[x]), "rid": pa.array(rid[x])})

    def stars(batches):
        last = None  # the last row's key, more, and the first document of either
        for batch in batches:
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(x[0]):
                continue
            key, more, rid = x
            new = np.concatenate(([last is None or last[0] != key[0]], key[1:] != key[:-1]))
            new_more = new | np.concatenate(([last is None or last[1] != more[0]], more[1:] != more[:-1]))
            for fresh, before in ((new, 2), (new_more, 3)):
                at = np.flatnonzero(fresh)
                place = np.cumsum(fresh) - 1
                centre = np.where(place < 0, last[before] if last is not None else 0, rid[at][place] if len(at) else 0)
                if before == 2:
                    centres = centre
                pair = ~fresh & (centre != rid)
                if before == 3:
                    pair &= centre != centres
                yield pa.RecordBatch.from_pydict({"a": pa.array(rid[pair]), "b": pa.array(centre[pair])})
            last = key[-1], more[-1], centres[-1], centre[-1]

    rows = sig.select(RID, "sig").mapInArrow(keys, "key long, more short, rid long")
    rows = rows.repartition(partitions, "key").sortWithinPartitions("key", "more", "rid")
    return rows.mapInArrow(stars, "a long, b long").distinct()


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree in ``ALIKE`` percent of the minhashes."""
    def run(batches):
        for batch in batches:
            same = (_matrix(batch.column(2), np.uint8) == _matrix(batch.column(3), np.uint8)).mean(axis=1)
            yield pa.RecordBatch.from_pydict({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(same * 100 >= ALIKE))

    return with_both(pairs, sketches).mapInArrow(run, "a long, b long")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each set of ``left`` with each of ``right``."""
    out = np.zeros((len(left), len(right)), np.float32)
    (x, i), (y, j) = ((np.concatenate(s), np.repeat(np.arange(len(s)), [len(v) for v in s])) for s in (left, right))
    column, where = np.unique(x, return_inverse=True)
    at = np.minimum(np.searchsorted(column, y), len(column) - 1)
    hit = column[at] == y
    j, at = j[hit], at[hit]
    used = np.unique(at)  # only shingles of both sides have a column
    place = np.full(len(column), -1)
    place[used] = np.arange(len(used))
    where, at = place[where], place[at]
    i, where = i[where >= 0], where[where >= 0]
    by_x, by_y = np.argsort(where, kind="stable"), np.argsort(at, kind="stable")
    i, where, j, at = i[by_x], where[by_x], j[by_y], at[by_y]
    for c in range(0, len(used), COLUMNS):
        width = min(COLUMNS, len(used) - c)
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        s = slice(*np.searchsorted(where, (c, c + width)))
        a[i[s], where[s] - c] = 1
        s = slice(*np.searchsorted(at, (c, c + width)))
        b[j[s], at[s] - c] = 1
        out += a @ b.T
    return np.rint(out).astype(np.int64)


def _links(docs: DataFrame, families: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """(a, b): links that join the documents of families (id, component) as all links do. The
    full shingle sets of the members are compared, as blocks of documents."""
    dealt = dealt_in_blocks(families, BLOCK).groupBy("rid").agg(
        F.collect_list(F.struct("key", "component", "p", "q", "block")).alias("to"))
    # one plan at every size: texts meet their places by a sort-merge join
    texts = docs.select(F.col(RID).alias("rid"), "t").join(dealt.hint("merge"), "rid")

    def sets(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            out = []
            for _, _, s, sizes in shingle_sets(buf, off, width):
                out += [x.tobytes() for x in np.split(s, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "to": batch.column(2), "items": pa.array(out, pa.binary())})

    kind = "array<struct<key:bigint,component:bigint,p:int,q:int,block:int>>"
    rows = texts.select("rid", "t", "to").mapInArrow(sets, f"rid long, to {kind}, items binary")
    rows = rows.select("rid", "items", F.explode("to").alias("to")).select("to.*", "rid", "items")

    def run(batches):
        for left, right, (rid, items) in block_pairs(batches, lambda b: [objects(b.column(6))]):
            if not len(left) or not len(right) or (left[0] == right[0] and len(left) < 2):
                continue
            x, y = ([np.frombuffer(v, np.uint64) for v in items[at]] for at in (left, right))
            same = shared_counts(x, y)
            total = np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])
            near = 100 * same >= percent * (total - same)
            if left[0] != right[0]:
                z = np.zeros
                near = np.block([[z((len(x), len(x)), bool), near], [near.T, z((len(y), len(y)), bool)]])
                left = np.append(left, right)
            low = lowest_reached(near)
            linked = low != np.arange(len(low))
            yield pa.RecordBatch.from_pydict({"a": pa.array(rid[left][linked]), "b": pa.array(rid[left][low[linked]])})

    return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """One row per input row: RID, ``key``, n_shingles, component_id, kept.

    Rows link where 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles; component_id is the smallest key reachable by links, and its row is kept.

    1. Rows with equal sets (128-bit fingerprint) are one class, and its first row stands for it.
    2. Two collections of bands are computed, and every pair of a band from each is a table
       key. Documents form pairs with a key's first ones; pairs whose minhashes are far apart
       are dropped, and the rest join documents to families.
    3. The full sets of a family's members are compared with each other, in blocks, so that no
       link inside a family is missed, and a large family is dealt over many tasks.

    No words or null text: an empty set, linked with nothing. Fewer words than ``width``: the
    sequence is the only shingle. Repeated rows link like others. Null keys sort first and are
    not a component's id unless all are null. Empty table: empty result. Extra columns are not
    read. Very long texts are taken whole; a set lies in one row (2 GB, some 250 million shingles).
    """
    bands = bands_for(percent)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    docs = with_row_id(docs, key, text).select(RID, F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    meta = frozen(_signatures(docs, width, 2 * bands * BAND), "signatures")
    classes = frozen(meta.where("n > 0").groupBy("f1", "f2", "n").agg(F.min(RID).alias("rep"), F.count(F.lit(1)).alias("m")), "classes")
    copies = (meta.where("n > 0").join(classes.where("m > 1"), ["f1", "f2", "n"])
              .where(F.col(RID) != F.col("rep")).select(F.col(RID).alias("a"), F.col("rep").alias("b")))
    sig = meta.join(classes.select(F.col("rep").alias(RID)), RID, "left_semi").select(RID, "sig")
    pairs = frozen(_candidates(sig, bands, parts), "candidates")
    families = components(_alike(pairs, meta.select(RID, "sketch")))
    links = _links(docs, families, width, percent, parts)
    comps = frozen(components(links.union(copies)), "components")
    names = meta.select(F.col(RID).alias("component"), F.col("id").alias("component_id"))
    comps = comps.join(names, "component").select(F.col("id").alias(RID), "component", "component_id")
    return meta.select(RID, "id", "n").join(comps, RID, "left").select(
        RID, F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(
            F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.coalesce("component", RID) == F.col(RID)).alias("kept"))
