"""Embedding near-dedup with spherical-cap filters."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.buckets import across_pairs, block_pairs, dealt_in_blocks, objects, star_pairs, star_rows, with_both
from sheen.llm.common import RID, components, frozen, with_row_id
from sheen.llm.hashing import text_buffer

#: Independent codes.
CODES = 8
#: Filters that a vector passes, on average, up to ``FEW`` vectors, and other random vectors that
#: pass one of them with it. With the number of vectors they fix the cap and the size of the
#: codes: see ``settings``.
FILTERS, SHARED, FEW = 113, 0.17, 10_000
#: The higher the cap, the fewer of its filters a vector shares with one at cosine 0.9. Filters
#: grow with this power of the number of vectors, which holds the chance of sharing none below
#: 1e-3 at every size (README, "Near copies").
GROWTH = 0.1
SEED = 20
#: Products of rows and code words that are held at a time.
PRODUCTS = 4_000_000
#: Rows of a block when the vectors of a component, or of a filter, are compared.
BLOCK = 2048


def settings(n_vectors: int) -> tuple[float, int]:
    """(cap, words): a vector passes a filter whose direction, a standard normal vector, has at
    least the inner product ``cap`` with it; a code has words * words directions, a word for each
    half. The more vectors, the higher the cap: a filter's list stays as short, so candidates
    grow with the number of vectors and of filters, and a vector's decoding with the words."""
    chance = SHARED / max(n_vectors, 1000)
    filters = FILTERS * max(1.0, n_vectors / FEW) ** GROWTH
    return NormalDist().inv_cdf(1 - chance), math.ceil(math.sqrt(filters / (CODES * chance)))


def code(dim: int, seed: int, n: int):
    """A random rotation and the ``n`` normal code words of both halves."""
    rng = np.random.default_rng([SEED, dim, seed])
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return turn, rng.standard_normal((n, dim - dim // 2)), rng.standard_normal((n, dim // 2))


def decode_list(unit: np.ndarray, turn, first, second, cap: float):
    """(row, i, j): all filters (i, j) of the code whose direction, the code words i and j one
    after the other, has an inner product of at least ``cap`` with the row. Only words that
    reach the cap with the best word of the other half are combined."""
    half = len(first[0])
    x = unit @ turn
    p, q = x[:, :half] @ first.T, x[:, half:] @ second.T
    need_p, need_q = cap - q.max(axis=1), cap - p.max(axis=1)
    rows, left, right = [], [], []
    for k in range(len(unit)):
        i, j = np.flatnonzero(p[k] >= need_p[k]), np.flatnonzero(q[k] >= need_q[k])
        a, b = np.nonzero(p[k][i][:, None] + q[k][j] >= cap)
        rows.append(np.full(len(a), k))
        left.append(i[a])
        right.append(j[b])
    return np.concatenate(rows), np.concatenate(left), np.concatenate(right)


def _filters(vectors: DataFrame, n_vectors: int) -> DataFrame:
    """(key, rid) for every filter that a vector passes; keys differ by dimension and code."""
    cap, words = settings(n_vectors)
    step = max(1, min(512, PRODUCTS // words))

    def run(batches):
        codes = {}
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            buf, off = text_buffer(batch.column(1))
            dims = np.diff(off) // 8
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                for s in range(0, len(at), step):
                    rows = at[s:s + step]
                    x = np.stack([np.frombuffer(buf[off[r]:off[r + 1]].tobytes(), np.float64) for r in rows])
                    for c in range(CODES):
                        if (d, c) not in codes:
                            codes[d, c] = code(d, c, words)
                        k, i, j = decode_list(x, *codes[d, c], cap)
                        yield pa.RecordBatch.from_pydict({
                            "key": pa.array(((d * CODES + c) * words + i) * words + j), "rid": pa.array(rid[rows[k]])})

    return vectors.mapInArrow(run, "key long, rid long")


def _units(rows: DataFrame) -> DataFrame:
    """(rid, unit): unit vectors in double precision, as bytes."""
    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, np.float64)
                x = x / np.abs(x).max()
                out.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "unit": pa.array(out, pa.binary())})

    return rows.mapInArrow(run, "rid long, unit binary")


def _linked(pairs: DataFrame, units: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) with at least that cosine."""
    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [len(u) == len(v) and float(np.frombuffer(u) @ np.frombuffer(v)) >= cosine
                    for u, v in zip(x.to_pylist(), y.to_pylist())]
            yield pa.RecordBatch.from_pydict({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(keep, pa.bool_()))

    return with_both(pairs, units).mapInArrow(run, "a long, b long")


def _link_counts(comps: DataFrame, units: DataFrame, classes: DataFrame, cosine: float, parts: int) -> DataFrame:
    """(rid, links): the number of other vectors linked with each member of a component.

    Linked vectors are in one component, so its members are compared with each other, as
    blocks of rows: two blocks form one task's group, and a component that holds very many
    rows is dealt over many. Only counts leave a group, no pairs.
    """
    rows = dealt_in_blocks(comps, BLOCK).join(units, "rid").join(classes, "rid").select(
        "key", "component", "p", "q", "block", "rid", "m", "unit")

    def run(batches):
        for left, right, (rid, m, unit) in block_pairs(
                batches, lambda b: [b.column(6).to_numpy(zero_copy_only=False), objects(b.column(7))]):
            x, y = (np.stack([np.frombuffer(u) for u in unit[at]]) for at in (left, right))
            near = x @ y.T >= cosine
            if len(left) and left[0] == right[0]:
                np.fill_diagonal(near, False)
                rids, links = rid[left], near @ m[left]
            else:
                rids, links = np.append(rid[left], rid[right]), np.append(near @ m[right], near.T @ m[left])
            yield pa.RecordBatch.from_pydict({"rid": pa.array(rids), "links": pa.array(links.astype(np.int64))})

    return (rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "rid long, links long")
            .groupBy("rid").agg(F.sum("links").alias("links")))


def embedding_dedup(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """One row per input row: RID, ``key``, n_links, component_id, kept.

    Rows link where the cosine in double precision is at least ``cosine``. Equal vectors are
    one class. Each class's vector is list-decoded to the filters of ``CODES`` random product
    codes that it exceeds; classes that share a filter are candidates (a filter's classes with
    its first one, then the pairs that are still in different components), and candidates are
    verified. Pairs inside a component are counted by comparing its members, in blocks.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing: n_links 0, component_id their own key, kept. Vectors of different length never
    link. Repeated rows are rows of their own, which link. Null keys sort first and are not a
    component's id unless all are null. Empty table: empty result. Extra columns are not read.
    """
    parts = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    v = with_row_id(vectors, key, vector).select(F.col(RID).alias("rid"), F.col(key).alias("id"), F.col(vector).alias("v"))
    sound = (F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
             & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    good = v.where(sound).select("rid", "v", F.xxhash64(F.lit(1), "v").alias("f1"), F.xxhash64(F.lit(2), "v").alias("f2"))
    classes = frozen(good.groupBy("f1", "f2").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("m")), "classes")
    member = frozen(good.select("rid", "f1", "f2").join(classes, ["f1", "f2"]).select("rid", "rep", "m"), "members")
    reps = classes.select(F.col("rep").alias("rid"), "m")
    units = frozen(_units(good.select("rid", "v").join(reps, "rid", "left_semi").repartition(parts)), "units")
    stars = frozen(star_rows(_filters(units, classes.count()), parts), "stars")
    links = frozen(_linked(star_pairs(stars), units, cosine), "links")
    sketches = units.withColumnRenamed("unit", "sketch")
    more = across_pairs(stars, components(links), sketches, objects, lambda x, y: _near(x, y, cosine), parts, BLOCK)
    links = links.union(frozen(_linked(more, units, cosine), "links"))
    comps = frozen(components(links), "components")
    counts = frozen(_link_counts(comps, units, reps, cosine, parts), "counts")
    found = comps.withColumnRenamed("id", "rep").join(counts.withColumnRenamed("rid", "rep"), "rep", "left")
    out = member.join(found, "rep", "left").select(
        "rid", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    names = v.select(F.col("rid").alias("component"), F.col("id").alias("component_id"))
    out = out.join(names, "component")
    return v.select("rid", "id").join(out, "rid", "left").select(
        F.col("rid").alias(RID), F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.coalesce("component", "rid") == F.col("rid")).alias("kept"))


def _near(x, y, cosine):
    """Which of two arrays of unit vectors of one length are near, but for rounding; the pairs
    are verified."""
    return np.stack([np.frombuffer(u) for u in x]) @ np.stack([np.frombuffer(u) for u in y]).T >= cosine - 1e-9
