"""Language ID: the nearest of several clustered TF-IDF centroids per language.

A text's vector counts hashed n-grams of the UTF-8 bytes of its lower-cased letters. Document
frequencies come from all labelled rows; spherical k-means of a bounded sample of each
language gives its centroids, so that a language may have several kinds of text. A text
gets the language of the centroid with the largest cosine, and is rejected where even that one
is farther than nearly all of the centroid's own sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheen.llm.common import frozen
from sheen.llm.hashing import pieces, text_buffer

#: Lengths of the n-grams in bytes, and the number of hashed n-gram buckets.
GRAMS, BUCKETS = (2, 3, 4), 1 << 15
#: Labelled rows of a language, at most, that its centroids are clustered from.
SAMPLE = 1_000
#: Centroids of a language, and passes of the clustering.
CENTROIDS, PASSES = 3, 12
#: Share of a centroid's own sample that lies beyond its distance of rejection.
REJECTED = 0.005
#: What a text without letters gets.
UNKNOWN = "und"
#: Documents, and bytes, whose dense vectors are held at a time.
BLOCK, SLICE = 64, 1 << 19

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - (BUCKETS.bit_length() - 1))


def letters(text) -> F.Column:
    """Lower-cased letters of a text, runs of other characters as one space; words that hold a
    digit (keys, numbers, addresses) say nothing of the language and go. Null stays null."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?<!\S)[^\s\p{N}]*\p{N}\S*|[^\p{L}\p{M}]+", " "))


def term_counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of the n-gram buckets, a row for each text of a buffer. A text counts as if a
    space stood before and after it; long texts are taken in slices."""
    m = len(off) - 1
    out = np.zeros((m, BUCKETS), np.float32)
    flat = out.reshape(-1)
    padded = np.full(len(buf) + 2 * m, 32, np.uint8)
    doc = np.repeat(np.arange(m), np.diff(off))
    padded[np.arange(len(buf)) + 2 * doc + 1] = buf
    starts = off[:-1] + 2 * np.arange(m)
    ends = off[1:] + 2 * np.arange(1, m + 1)
    for a in range(0, len(padded), SLICE):
        part = padded[a:a + SLICE + max(GRAMS) - 1].astype(np.uint64)
        at = np.arange(a, min(a + SLICE, len(padded)))
        of = np.searchsorted(starts, at, "right") - 1
        room = ends[of] - at
        for n in GRAMS:
            code = np.full(1, n, np.uint64)
            k = len(part) - n + 1
            if k <= 0:
                continue
            for i in range(n):
                code = (code << np.uint64(8)) | part[i:i + k]
            k = min(k, len(at))
            whole = room[:k] >= n
            bucket = ((code[:k][whole] * _FACTOR) >> _SHIFT).astype(np.int64)
            cells, times = _counted(of[:k][whole] * BUCKETS + bucket, m * BUCKETS)
            flat[cells] += times
    return out


def _counted(cells: np.ndarray, size: int):
    if len(cells) * 8 > size:
        times = np.bincount(cells, minlength=size)
        at = np.flatnonzero(times)
        return at, times[at]
    return np.unique(cells, return_counts=True)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1 (tf: root of the count); without n-grams: zeros."""
    x = np.sqrt(counts) * idf
    return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]


def _blocks(off: np.ndarray):
    for i, j in pieces(off, SLICE):
        for k in range(i, j, BLOCK):
            yield k, min(k + BLOCK, j)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts (column t) that hold each bucket, and of all texts: ``BUCKETS`` sums."""
    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            n += len(batch)
            for i, j in _blocks(off):
                total += np.count_nonzero(term_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i]), axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.append(at, -1)), "n": pa.array(np.append(total[at], n))})

    rows = (texts.select("t").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))).toPandas()
    out, at = np.zeros(BUCKETS), rows["bucket"].to_numpy(np.int64)
    out[at[at >= 0]] = rows["n"].to_numpy(float)[at >= 0]
    return out, int(rows["n"][at < 0].sum())


def _sample(labelled: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` rows (lang, t) of each language, by hash. A language's share of about
    three times as many is taken first, so that its window is bounded however many rows it has."""
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    h = F.xxhash64(F.col("id").cast("string"), "raw")  # of the text as it is: letters() runs for few rows
    part = F.pmod(h, F.lit(1 << 31)) / float(1 << 31)
    few = (labelled.join(F.broadcast(sizes), "lang").where(part < F.lit(3.0 * SAMPLE) / F.col("n"))
           .select("lang", "t", h.alias("h")))
    w = Window.partitionBy("lang").orderBy("h")
    return few.withColumn("k", F.row_number().over(w)).where(F.col("k") <= SAMPLE).select("lang", "t")


def cluster(x: np.ndarray, k: int = CENTROIDS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: centroids of length 1, and each row's centroid. Starts
    from the row nearest the mean, then the row farthest from all chosen ones, in turn."""
    mean = x.mean(axis=0)
    chosen = [int((x @ mean).argmax())]
    best = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        far = int(best.argmin())
        if best[far] > 1 - 1e-9:
            break
        chosen.append(far)
        best = np.maximum(best, x @ x[far])
    c, label = x[chosen], None
    for _ in range(passes):
        new = (x @ c.T).argmax(axis=1)
        if label is not None and (new == label).all():
            break
        label = new
        sums = np.stack([x[label == i].sum(axis=0) if (label == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1)), 1e-12)[:, None]
    return c, (x @ c.T).argmax(axis=1)


def fit_centroids(labelled: DataFrame):
    """(languages, centroids, least cosines, idf) from rows (id, lang, raw, t) with letters, or None.

    Of each language at most ``SAMPLE`` rows are clustered, in one task; document frequencies
    are those of all rows. The driver gets ``CENTROIDS`` * ``BUCKETS`` numbers a language.
    """
    df, n = document_frequencies(labelled)
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def run(key, rows):
        x = np.concatenate([np.zeros((0, BUCKETS), np.float32), *_vectors(rows["t"].sort_values(), idf)])
        c, label = cluster(x)
        near = np.einsum("ij,ij->i", x, c[label])
        out = []
        for i in range(len(c)):
            own = near[label == i]
            least = float(np.quantile(own, REJECTED)) if len(own) else 1.0
            out.append((key[0], i, least, c[i].astype(np.float32).tobytes()))
        return pd.DataFrame(out, columns=["lang", "cluster", "least", "centroid"])

    found = (frozen(_sample(labelled), "language-sample").groupBy("lang")
             .applyInPandas(run, "lang string, cluster int, least double, centroid binary")).orderBy("lang", "cluster").collect()
    centroids = np.stack([np.frombuffer(r["centroid"], np.float32) for r in found])
    return [r["lang"] for r in found], centroids, np.array([r["least"] for r in found]), idf


def _vectors(texts, idf):
    buf, off = text_buffer(pa.array(texts, pa.string()))
    for i, j in _blocks(off):
        yield unit_vectors(term_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i]), idf)


def held_out(key) -> F.Column:
    """Whether the CRC-32 of a key as text is a multiple of 5; null keys are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn=None) -> DataFrame:
    """One row per input row: ``key``, lang_pred, score, rejected.

    Learns from the rows with a ``lang``, a text that holds a letter, and ``learn`` (a boolean
    column of ``docs``; all rows if None). A prediction reads the text alone: the language of the
    centroid with the largest cosine (of equals: the first by code point), and that cosine, 0 to
    1, as score. rejected: the text is farther from it than ``REJECTED`` of the centroid's own
    sample allows, so it may be of none of the learned languages; lang_pred still names the
    nearest one.

    A text that is null or holds no letter: ``und``, score 0, rejected. Without any row to learn
    from, all rows get that. A text whose letters are all in words with digits: the first learned
    language, score 0, rejected. Very short texts are predicted like others, with less to go by.
    Very long texts are counted whole, in slices. Null and repeated keys and repeated rows: one
    output row each. Empty table: empty result. Other columns are not read, whatever their names.
    """
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    some = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).alias("id"), F.col(lang).cast("string").alias("lang"), learn.alias("learn"), some.alias("some"),
                       F.col(text).alias("raw"), letters(F.col(text)).alias("t"))
    model = fit_centroids(rows.where("learn and some and lang is not null").select("id", "lang", "raw", "t"))
    if model is None:
        return rows.select(F.col("id").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("rejected"))
    names, centroids, least, idf = model
    given = docs.sparkSession.sparkContext.broadcast((centroids, idf))

    def run(batches):
        centroids, idf = given.value
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            best, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for i, j in _blocks(off):
                near = unit_vectors(term_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i]), idf) @ centroids.T
                best[i:j] = np.where(np.diff(off[i:j + 1]) > 0, near.argmax(axis=1), 0)
                score[i:j] = np.clip(near[np.arange(j - i), best[i:j]], 0, 1)
            some = batch.column(2).to_numpy(zero_copy_only=False)
            score[np.diff(off) == 0] = 0
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "lang_pred": pa.array([names[b] if s else UNKNOWN for b, s in zip(best, some)], pa.string()),
                "score": pa.array(score), "rejected": pa.array(~some | (score < least[best]))})

    texts = rows.select("id", F.when(F.col("some"), F.col("t")).otherwise("").alias("t"), "some")
    out = texts.mapInArrow(run, f"id {dict(texts.dtypes)['id']}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", key)
