"""Quality classifier: weak labels by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import RID, frozen, with_row_id
from sheen.llm.hashing import BYTE_VALUE, LOWER, Sequence, mix, pieces, text_buffer, word_hashes, words

#: Rows of each weak label, at most, that the scorer is fitted on: those with a given label
#: first, then by hashed id, however many documents there are. All documents are scored.
SAMPLE = 10_000
#: A document of which no labeller says anything bad may still be bad in a way that they don't
#: know. So the more good labels are given, the less such weak ones weigh: with n given ones, a
#: weak one weighs HALF / (HALF + n) of a given one.
HALF = 5.0
#: Rows of the sample, and their share of it, that a word must occur in to be a feature.
LEAST_ROWS, LEAST_SHARE = 5, 0.0005
#: Of the scorer's fit: lasso, ridge, step size, passes over the sample.
LASSO, RIDGE, STEP, EPOCHS = 8.0, 0.1, 1.0, 12
#: Words of personal abuse, lower case.
ABUSE = ("idiot moron stupid loser pathetic scum worthless trash clown disgusting imbecile jerk "
         "bastard filthy vermin retard ugly dumb fool garbage").split()

#: Bytes that are in no feature word: ASCII other than letters and digits.
_MARKS = np.zeros(256, bool)
_MARKS[:128] = True
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _MARKS[ord(_a):ord(_b) + 1] = False
#: Symbols that are rare in prose.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+<=>@\\^_`{|}~"]] = True
#: So many symbols, or capitals, say nothing, however short the text.
FEW, SOME = 4, 24
#: A word's first bytes are features too, so that forms of one stem count together.
STEMS = (4, 5)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True

#: The labellers: each says bad or good of a document, or nothing.
#: name, statistic, sign of the test, threshold, what it says.
LABELLERS = (
    ("empty", "n", "<", 1, "bad"), ("repeats", "varied", "<", 0.4, "bad"), ("runs", "run", ">", 0.2, "bad"),
    ("symbols", "symbols", ">", 0.04, "bad"), ("tables", "bars", ">", 0.15, "bad"), ("shouting", "upper", ">", 0.3, "bad"),
    ("abuse", "abuse", ">", 0.5, "bad"), ("much_abuse", "abuse", ">", 1.5, "bad"),
    ("varied", "varied", ">", 0.6, "good"), ("plain", "symbols", "<", 0.01, "good"),
)
#: Bounds of a labeller's accuracy: those that say bad are made to be precise, those that say
#: good look at one side of a document only; given labels are nearly always right.
BOUNDS = {"bad": (0.95, 0.999), "good": (0.5, 0.75), "given": (0.97, 0.999)}
#: Steps of each statistic; a document has a feature for every step that it reaches.
STEPS = {"varied": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), "run": (0.05, 0.1, 0.2, 0.4), "symbols": (0.01, 0.02, 0.04, 0.08, 0.16),
         "bars": (0.05, 0.1, 0.2, 0.3), "upper": (0.1, 0.2, 0.3, 0.5), "abuse": (0.5, 1.5, 2.5)}
_STEP_ID = {(s, k): np.uint32(mix(np.array([1 + 100 * i + k], np.uint64))[0] & np.uint64(0xFFFFFFFF))
            for i, s in enumerate(STEPS) for k in range(len(STEPS[s]))}


def _hash_of(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    return word_hashes(np.frombuffer(b"".join(data), np.uint8), off)[0]


def _feature_words(low: np.ndarray, off: np.ndarray):
    """Hashes of all words and stems of each document, and the documents' offsets in them."""
    found, counts = [], np.zeros(len(off) - 1, np.int64)
    for i, j in pieces(off):
        a, b = off[i], off[j]
        start, end, doc = words(low[a:b], off[i:j + 1] - a, _MARKS)
        if not len(start):
            continue
        seq = Sequence(BYTE_VALUE[low[a:b]])
        hashes, docs = [seq.ranges(start, end)], [doc]
        for n in STEMS:
            long = end - start > n
            hashes.append(mix(seq.ranges(start[long], start[long] + n) + np.uint64(n)))
            docs.append(doc[long])
        doc = np.concatenate(docs)
        order = np.argsort(doc, kind="stable")
        found.append(np.concatenate(hashes)[order])
        counts[i:j] = np.bincount(doc, minlength=j - i)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts)))


def _statistics(buf: np.ndarray, off: np.ndarray):
    """Statistics of each document of a buffer, and its distinct words and stems (hashes, offsets)."""
    m = len(off) - 1
    sums = np.zeros((3, m))
    for k, table in enumerate((_SYMBOL, _UPPER, _LETTER)):
        c = np.concatenate(([0], np.cumsum(table[buf])))
        sums[k] = c[off[1:]] - c[off[:-1]]
    low = LOWER[buf]
    tokens, at = word_hashes(low, off)
    n = np.diff(at).astype(float)
    some = np.maximum(n, 1)
    doc = np.repeat(np.arange(m), np.diff(at))
    same = np.zeros(len(tokens), bool)
    same[1:] = (tokens[1:] == tokens[:-1]) & (doc[1:] == doc[:-1])
    stats = {"n": n, "run": np.bincount(doc[same], minlength=m) / some,
             "symbols": np.maximum(sums[0] - FEW, 0) / np.maximum(np.diff(off), 1), "upper": np.maximum(sums[1] - SOME, 0) / np.maximum(sums[2], 1),
             "bars": np.bincount(doc[tokens == _hash_of(["|"])[0]], minlength=m) / some}
    distinct = np.zeros(m)
    terms, wat = _feature_words(low, off)
    keys, counts = [], np.zeros(m, np.int64)
    for i, j in pieces(wat):
        for i in range(i, j, 4096):
            k = min(i + 4096, j)
            for source, o, feature in ((tokens, at, False), (terms, wat, True)):
                d = np.repeat(np.arange(k - i), np.diff(o[i:k + 1])).astype(np.uint64)
                x = (d << np.uint64(32)) | (source[o[i]:o[k]] >> np.uint64(32))
                x.sort()
                x = x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x
                per = np.bincount((x >> np.uint64(32)).astype(np.int64), minlength=k - i)
                if feature:
                    keys.append((x & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                    counts[i:k] = per
                else:
                    distinct[i:k] = per
    terms = np.concatenate(keys) if keys else np.zeros(0, np.uint32)
    at = np.concatenate(([0], np.cumsum(counts)))
    # short texts repeat little by chance, long ones much
    stats["varied"] = np.where(n < 20, 1.0, distinct / np.maximum(np.minimum(some, 100 + some ** 0.85), 1))
    abuse = np.isin(terms, (_hash_of(ABUSE) >> np.uint64(32)).astype(np.uint32))
    stats["abuse"] = np.bincount(np.repeat(np.arange(m), counts)[abuse], minlength=m).astype(float)
    return stats, terms, at


def _votes(stats) -> np.ndarray:
    """One number per document: whether each labeller speaks, as digits to base 2."""
    code = 0
    for _, name, sign, limit, _ in LABELLERS:
        x = stats[name]
        code = code * 2 + (x < limit if sign == "<" else x > limit).astype(np.int64)
    return code


def _features(stats, terms, at):
    """Feature ids of each document: its distinct words and stems, and the steps that it reaches."""
    m = len(at) - 1
    ids, docs = [terms], [np.repeat(np.arange(m), np.diff(at))]
    for (s, k), feature in _STEP_ID.items():
        hit = np.flatnonzero(stats[s] < STEPS[s][k] if s == "varied" else stats[s] > STEPS[s][k])
        ids.append(np.full(len(hit), feature, np.uint32))
        docs.append(hit)
    return np.concatenate(ids), np.concatenate(docs)


def fit_labellers(votes: np.ndarray, says: list[str], given: np.ndarray, counts: np.ndarray, rounds: int = 1000):
    """Chance of bad for each vote pattern, and the accuracies of the labellers and, last, of the given labels.

    ``votes``: rows of 0 and 1 (speaks); ``given``: 0 none, 1 good, 2 bad. Expectation-maximisation:
    the chance of bad follows from the accuracies of those that speak, and an accuracy is the
    mean chance that the labeller was right, within ``BOUNDS``, to a fixed point. The patterns
    are few, whatever the number of documents.
    """
    kinds = [*says, "given"]
    sign = np.array([1 if k == "bad" else -1 for k in says])
    speak = np.column_stack((votes * sign, np.select([given == 2, given == 1], [1, -1], 0)))
    low, high = (np.array([BOUNDS[k][i] for k in kinds]) for i in (0, 1))
    right, prior = (low + high) / 2, 0.2
    p = np.zeros(len(counts))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + speak @ np.log(right / (1 - right))
        new = 1 / (1 + np.exp(-odds))
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
        prior = float(np.clip((p * counts).sum() / max(counts.sum(), 1), 0.01, 0.5))
        said = (speak != 0) * counts[:, None]
        hit = np.where(speak > 0, p[:, None], 1 - p[:, None]) * said
        right = np.clip((hit.sum(axis=0) + low) / (said.sum(axis=0) + 1), low, high)
    return p, right


def weak_labels(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(rid, p_bad, given) by the labellers; given labels (doc_id, quality, toxic) are one more."""
    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            code = np.zeros(len(batch), np.int64)
            for i, j in pieces(off):
                code[i:j] = _votes(_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i])[0])
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "id": batch.column(1), "code": pa.array(code)})

    kind = dict(docs.dtypes)["id"]
    votes = docs.select(F.col(RID).alias("rid"), "id", "t").mapInArrow(run, f"rid long, id {kind}, code long")
    told = F.lit(0)
    if labels is not None:
        bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
        told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when(
            bad, 2).when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("told"))
        votes = votes.join(told, "id", "left")
        told = F.coalesce("told", F.lit(0))
    votes = frozen(votes.select("rid", (F.col("code") * 3 + told).alias("code")), "votes")
    rows = votes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect()  # at most 3 * 2 ** labellers
    code = np.array([r["code"] for r in rows], np.int64)
    n = len(LABELLERS)
    votes_of = np.stack([code // 3 >> (n - 1 - k) & 1 for k in range(n)], axis=1).reshape(-1, n)
    p, _ = fit_labellers(votes_of, [x[4] for x in LABELLERS], code % 3, np.array([r["n"] for r in rows], float))
    known = docs.sparkSession.createDataFrame([(int(c), float(x)) for c, x in zip(code, p)], "code long, p_bad double")
    return votes.join(F.broadcast(known), "code").select("rid", "p_bad", (F.col("code") % 3 > 0).alias("given"))


def fit_scorer(docs: DataFrame, weak: DataFrame):
    """(ids, weights, bias) of a sparse logistic regression on hashed features, or None if
    the weak labels know one class only."""
    parts = []
    for bad in (True, False):
        side = weak.where((F.col("p_bad") >= 0.5) if bad else (F.col("p_bad") < 0.5))
        parts.append(side.orderBy(F.desc("given"), F.xxhash64("rid"), "rid").limit(SAMPLE).select("rid", "p_bad", "given"))
    sample = frozen(parts[0].union(parts[1]), "sample")
    if sample.agg(F.countDistinct(F.col("p_bad") >= 0.5)).first()[0] < 2:
        return None

    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            ids = []
            for i, j in pieces(off):
                f, d = _features(*_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i]))
                order = np.argsort(d, kind="stable")
                ids += [x.view(np.int32) for x in np.split(f[order], np.cumsum(np.bincount(d, minlength=j - i))[:-1])]
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32())), "p_bad": batch.column(2),
                                              "given": batch.column(3)})

    rows = docs.select(F.col(RID).alias("rid"), "t").join(F.broadcast(sample), "rid").mapInArrow(
        run, "rid long, ids array<int>, p_bad double, given boolean")
    is_bad = F.col("p_bad") >= 0.5
    n_told = sample.where(F.col("given") & ~is_bad).count()
    share = F.when(is_bad | F.col("given"), 1.0).otherwise(HALF / (HALF + n_told))
    n_bad, n_good = sample.agg(F.sum(F.when(is_bad, share)), F.sum(F.when(~is_bad, share))).first()
    even = share * F.when(is_bad, (n_bad + n_good) / (2 * n_bad)).otherwise((n_bad + n_good) / (2 * n_good))  # both classes weigh alike
    rows = frozen(rows.select((F.col("p_bad") < 0.5).cast("double").alias("good"),
                              (even * F.abs(2 * F.col("p_bad") - 1)).alias("weight"), "ids"), "features")

    def train(batches):  # at most 2 * SAMPLE rows
        good, weight, ids, counts = [], [], [], []
        for batch in batches:
            good.append(batch.column(0).to_numpy())
            weight.append(batch.column(1).to_numpy())
            counts.append(np.diff(np.frombuffer(batch.column(2).buffers()[1], np.int32)[
                batch.column(2).offset:batch.column(2).offset + len(batch) + 1]))
            ids.append(batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint32))
        if good:
            flat, ids = np.concatenate(ids), None
            names, weights, bias = fit_sparse(flat, np.concatenate(counts), np.concatenate(good), np.concatenate(weight))
            yield pa.RecordBatch.from_pydict({"f": pa.array(np.append(names.astype(np.int64), -1)),
                                              "w": pa.array(np.append(weights, bias))})

    model = rows.repartition(1).mapInArrow(train, "f long, w double").toPandas()
    f, w = model["f"].to_numpy(np.int64), model["w"].to_numpy(np.float64)
    bias, order = float(w[f == -1][0]), np.argsort(f)
    order = order[f[order] >= 0]
    return f[order].astype(np.uint32), w[order], bias


def fit_sparse(flat: np.ndarray, counts: np.ndarray, good: np.ndarray, weight: np.ndarray):
    """Logistic regression on sets of feature ids (``flat``, ``counts`` per row) with a lasso:
    (ids, weights, bias) of the features that it keeps. Online, coordinate by coordinate with
    falling step sizes (follow the regularised leader), over the rows in a fixed random order."""
    used, times = np.unique(flat, return_counts=True)
    used = used[times >= max(LEAST_ROWS, len(counts) * LEAST_SHARE)]
    ends = np.cumsum(counts)
    rows = []
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        ids = np.unique(flat[a:b])
        x = np.searchsorted(used, ids)
        ids, x = ids[x < len(used)], x[x < len(used)]
        rows.append(x[used[x] == ids].astype(np.int32))
    z, squares = np.zeros(len(used)), np.zeros(len(used))
    bias, bias_squares = 0.0, 0.0
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            x = rows[r]
            zx, nx = z[x], squares[x]
            w = np.where(np.abs(zx) <= LASSO, 0.0, (np.sign(zx) * LASSO - zx) / ((1 + np.sqrt(nx)) / STEP + RIDGE))
            p = 1 / (1 + np.exp(-min(max(w.sum() + bias, -30.0), 30.0)))
            g = (p - good[r]) * weight[r]
            move = (np.sqrt(nx + g * g) - np.sqrt(nx)) / STEP
            z[x] = zx + g - move * w
            squares[x] = nx + g * g
            bias_squares += g * g
            bias -= STEP * g / (1 + bias_squares ** 0.5)
    w = np.where(np.abs(z) <= LASSO, 0.0, (np.sign(z) * LASSO - z) / ((1 + np.sqrt(squares)) / STEP + RIDGE))
    keep = w != 0
    return used[keep], w[keep], bias


def _scores(buf: np.ndarray, off: np.ndarray, scorer) -> np.ndarray:
    """The scorer's chance of being good for each document of a buffer."""
    ids, weights, bias = scorer
    z = np.zeros(len(off) - 1)
    for i, j in pieces(off):
        stats, terms, at = _statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i])
        f, d = _features(stats, terms, at)
        where = np.minimum(np.searchsorted(ids, f), len(ids) - 1)
        hit = ids[where] == f
        s = bias + np.bincount(d[hit], weights[where[hit]], minlength=j - i)
        z[i:j] = np.where(stats["n"] > 0, 1 / (1 + np.exp(-np.clip(s, -500, 500))), 0.0)
    return z


def _fitted(docs: DataFrame, labels: DataFrame | None):
    weak = frozen(weak_labels(docs, labels), "weak")
    scorer = fit_scorer(docs, weak)
    return weak, scorer if scorer is not None and len(scorer[0]) else None


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(RID, F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def _has_words(text: str):
    return F.coalesce(F.rlike(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: RID, ``key``, p_weak, score, kept.

    Heuristic labellers vote on every document (repetition, runs of one word, symbols, table
    bars, capitals, abuse, emptiness, and labels where there are some). Expectation-
    maximisation over the counts of all vote patterns estimates how right each labeller is;
    p_weak is the posterior chance that the document is good. A sparse linear scorer over
    hashed words and stepped statistics learns these labels from a bounded sample
    (``SAMPLE`` of each) and scores every document: score is its chance of being good, and
    documents of 0.5 or more are kept.

    Null or empty text, or only white space: score 0, not kept. Repeated rows
    get equal scores. Null keys have no given label. Where the weak labels know one class
    only, they are the score. Empty table: empty result. Extra columns are not read. Very long
    texts are scored whole.
    """
    docs = _texts(with_row_id(docs, key, text), key, text)
    weak, scorer = _fitted(docs, labels)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "score": pa.array(_scores(*text_buffer(batch.column(1)), scorer))})

    out = docs.select(F.col(RID).alias("rid"), "id").join(weak.drop("given"), "rid")
    if scorer is None:
        out = out.join(docs.select(F.col(RID).alias("rid"), _has_words("t").alias("words")), "rid").withColumn(
            "score", F.when(F.col("words"), 1 - F.col("p_bad")).otherwise(0.0)).drop("words")
    else:
        out = out.join(docs.select(F.col(RID).alias("rid"), "t").mapInArrow(run, "rid long, score double"), "rid")
    return out.select(F.col("rid").alias(RID), F.col("id").alias(key), (1 - F.col("p_bad")).alias("p_weak"), "score",
                      (F.col("score") >= 0.5).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` keeps, with all their columns. Rows are scored
    and dropped where they are read; texts are not shuffled."""
    docs = with_row_id(docs, key, text)
    weak, scorer = _fitted(_texts(docs, key, text), labels)
    if scorer is None:
        return docs.where(_has_words(text)).join(
            weak.where("p_bad <= 0.5").select(F.col("rid").alias(RID)), RID, "left_semi").drop(RID)
    rows = docs.drop(RID)
    at = rows.columns.index(text)

    def run(batches):
        for batch in batches:
            t = batch.column(at)
            keep = _scores(*text_buffer(t.fill_null("") if t.null_count else t), scorer) >= 0.5
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(run, rows.schema)
