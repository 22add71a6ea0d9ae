"""Repeated strings and passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import sheen.llm.substring_dedup as substring_dedup_module
import sheen.llm.suffix_dedup as suffix_dedup_module
from sheen.llm import hashing, repeats
from sheen.llm.substring_dedup import Automaton, substring_dedup
from sheen.llm.suffix_dedup import refine, suffix_dedup

DOCS = "doc_id long, text string, rid long, g long, t int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], DOCS)


def brute_bytes(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\x01" * length
            seen.add(s)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, width):
    docs, count = {i: (t or "").encode().split() for i, t in rows}, {}
    for w in docs.values():
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            count[k] = count.get(k, 0) + 1
    out = {}
    for i, w in docs.items():
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if count[tuple(w[p:p + width])] > 1:
                gone[p:p + width] = [True] * width
        kept = b" ".join(x for x, y in zip(w, gone) if not y)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["ab", "c", "Dé", "fgh", "x" * 9, "a", "ba", "\n", "\t q"]

    def text(n):
        return " ".join(rng.choice(vocab) for _ in range(n))
    shared = [text(rng.choice([10, 40, 41, 80, 150])) for _ in range(8)]
    rows = []
    for i in range(150):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, max(0, len(p) // 3))
            parts += [p[a:len(p) - rng.randint(0, len(p) // 3)], text(rng.randint(0, 9))]
        t = rng.choice([" ", "", "\n"]).join(parts)
        if rng.random() < .2 and rows:
            t = rng.choice(rows)[1]
            if rng.random() < .6 and len(t) > 10:
                k = rng.randint(1, len(t) - 1)
                t = t[:k] + "Z" + t[k:]
        rows.append((i * 3 - 100, t))
    rows += [(1000, None), (1001, ""), (1002, "le " * 400), (1003, "le " * 300), (1004, text(3000)), (1005, "z" * 700), (1006, shared[-1] * 3)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=[False, True])
def crowded(request, monkeypatch):
    """Once with shards so small that longer q-grams cut them, up to the whole window."""
    if request.param:
        monkeypatch.setattr(suffix_dedup_module, "SHARD", 300)
        monkeypatch.setattr(substring_dedup_module, "SHARD", 100)
    return request.param


def test_strings_brute_force(spark, crowded):
    rows = corpus(1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.h) for r in suffix_dedup(docs_of(spark, rows).repartition(7))
           .withColumn("h", F.sha2("kept", 256)).collect()}
    assert got == brute_bytes(rows, 100)


def test_passages_brute_force(spark, crowded):
    rows = corpus(2)
    got = {r.doc_id: (r.n_words, r.n_removed, r.h) for r in substring_dedup(docs_of(spark, rows).repartition(7))
           .withColumn("h", F.sha2("kept", 256)).collect()}
    assert got == brute_words(rows, 35)


def test_small_batches(spark, monkeypatch):
    """Streams that break inside groups give the same result."""
    rows = corpus(3)
    monkeypatch.setattr(repeats, "CONTEXTS", 5)
    monkeypatch.setattr(repeats, "PIECE", 300)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        d = docs_of(spark, rows).repartition(3)
        got = {r.doc_id: r.h for r in suffix_dedup(d).withColumn("h", F.sha2("kept", 256)).collect()}
        assert got == {i: v[-1] for i, v in brute_bytes(rows, 100).items()}
        got = {r.doc_id: r.h for r in substring_dedup(d).withColumn("h", F.sha2("kept", 256)).collect()}
        assert got == {i: v[-1] for i, v in brute_words(rows, 35).items()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_odd_tables(spark):
    for op in (suffix_dedup, substring_dedup):
        assert op(docs_of(spark, [])).count() == 0
        t = " ".join(f"w{i}" for i in range(60))
        got = op(docs_of(spark, [(1, t), (1, t), (None, t), (2, None)])).collect()
        assert len(got) == 4
        want = {suffix_dedup: 2, substring_dedup: 3}[op]
        assert sum(r.n_removed > 0 for r in got) == want


def test_refine_and_automaton():
    rng = random.Random(7)
    for _ in range(30):
        b = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(rng.randint(101, 400))) * 2, np.uint8)
        starts = np.arange(len(b) - 100 + 1)
        bucket = refine(b, np.full(len(b), len(b)), starts)
        first = {}
        for s in starts:
            assert first.setdefault(bytes(b[s:s + 100]), bucket[s]) == bucket[s]
        assert len(set(first.values())) == len(first)
        seqs = [[rng.randint(0, 2) for _ in range(rng.randint(0, 30))] for _ in range(4)]
        weights = [rng.randint(1, 2) for _ in seqs]
        auto = Automaton(seqs, weights)
        for s in seqs:
            want = [e for e in range(4, len(s) + 1) if sum(
                w for x, w in zip(seqs, weights) for k in range(len(x) - 3) if x[k:k + 4] == s[e - 4:e]) >= 2]
            assert list(auto.repeated_ends(s, 4)) == want


def test_words_as_python():
    rng = random.Random(9)
    texts = ["".join(rng.choice("a b\n\té\x0b\x0c\r \x1c") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    data = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    buf = np.frombuffer(b"".join(data), np.uint8)
    hashes, at = hashing.word_hashes(buf, off)
    by = {}
    for i, d in enumerate(data):
        w = d.split()
        assert at[i + 1] - at[i] == len(w)
        for x, h in zip(w, hashes[at[i]:at[i + 1]].tolist()):
            assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)
