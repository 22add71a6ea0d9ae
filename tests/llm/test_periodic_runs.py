"""Periodic runs against brute force over words, and the registered query against a plain version."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sheen.llm import periodic_runs as P
from sheen.llm import queries


def plain_runs(w, least=12):
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, 2 * q) and not any(
                    all(w[k] == w[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                out.add((i, size, q))
            i = max(j, i) + 1
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(0, 50), st.integers(1, 20),
       st.sampled_from([2, 5, 12]))
def test_runs_equal_brute_force(words, a, p, least):
    words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    assert [tuple(r) for r in P.document_runs(words, least).tolist()] == plain_runs(words, least)
    assert [tuple(r) for r in P.runs_of(words, least).tolist()] == plain_runs(words, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=40))
def test_extensions(s):
    right = P.Extensions([*s, 0])
    pairs = [(i, j) for i in range(len(s)) for j in range(len(s) + 1) if i != j]
    i, j = np.array(pairs).T
    want = []
    for a, b in pairs:
        k = 0
        while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        want.append(k)
    assert right.common(i, j).tolist() == want
    order = sorted(range(len(s) + 1), key=lambda k: [*s, 0][k:])
    assert right.rank[order].tolist() == list(range(len(s) + 1))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [tuple(r) for r in plain_runs(words)] if n < 400 else [tuple(r) for r in P.runs_of(words).tolist()]
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_registered_query_equals_plain(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, sf).collect()))
    assert got == sorted(plain_row(k, t) for k, t in docs.items())
    assert sum(r[1] > 0 for r in got) >= len(got) // 20


def test_odd_rows(spark):
    long = " ".join(["lorem"] * 200_000) + " end"
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "a", 1), (3, " \t\n", "a", 1), (4, "x " * 12, "b", 2), (4, "x " * 12, "b", 2), (None, "y " * 11, "c", 3),
         (5, "a b c " * 6, "d", 4), (6, long, "e", 5), (7, "w" * 300_000, "f", 6)], "doc_id long, text string, id string, runs int")
    got = {(r["doc_id"], i): r for i, r in enumerate(P.periodic_runs(docs).collect())}
    rows = {k[0]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for k, r in got.items()}
    assert len(got) == 9
    assert rows[1] == rows[2] == rows[3] == (0, [], "")
    assert rows[4] == (12, [(0, 12, 1)], "x") and rows[None] == (11, [], " ".join("y" * 11))
    assert rows[5] == (12, [(0, 12, 2)], "a b c")
    assert rows[6] == (200_001, [(0, 200_000, 1)], "lorem end") and rows[7] == (1, [], "w" * 300_000)
    assert P.run_digests(P.periodic_runs(docs)).where("n_runs = 0").selectExpr(
        "max(start is null and length is null and period is null and exponent_milli is null)").first()[0]
    empty = P.run_digests(P.periodic_runs(P.with_planted_periods(docs.limit(0))))
    assert empty.count() == 0
    planted = {(r["doc_id"], r["text"]) for r in P.with_planted_periods(docs).collect()}
    assert (None, "y " * 11) in planted and (1, None) in planted and len(planted) == 8


def test_text_keys(spark):
    docs = spark.createDataFrame([("k1", "a b " * 9), (None, "q")], "name string, body string")
    got = P.periodic_runs(P.with_planted_periods(docs, "name", "body"), "name", "body")
    assert {r["name"] for r in got.collect()} == {"k1", None}
