"""Vector links against brute force."""

import math

import numpy as np
import pytest

from sheen.llm import buckets as B
from sheen.llm import embedding_dedup as E

TABLE = "vec_id long, embedding array<float>, label int, rid long, unit string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], TABLE)


def brute(rows, cosine=0.9):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    comp, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for n, (a, u) in enumerate(ok):
        for b, w in ok[n + 1:]:
            if len(u) == len(w) and u @ w / math.sqrt((u @ u) * (w @ w)) >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                comp[q] = p
    return {i: (links[i], root(i), root(i) == i) for i in comp}


def near(rng, base, cos):
    w = rng.standard_normal(len(base))
    w -= (w @ base) / (base @ base) * base
    return cos * base / np.linalg.norm(base) + math.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def corpus(seed, n=250, dim=64):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        b = base[rng.integers(12)]
        v = b * 3 if rng.random() < .1 else near(rng, b, rng.choice([.2, .93, .96, .99, .999]))
        rows.append((int(i * 2), [float(x) for x in np.float32(v)]))
    nan, inf = float("nan"), float("inf")
    return rows + [(9001, None), (9003, []), (9005, [0.0] * dim), (9007, [None] * dim), (9009, [nan] * dim),
                   (9011, [inf] + [1.0] * (dim - 1)), (9013, [1.0] * 5), (9015, [1.0] * 5), (9017, [2.0] * 5), (9019, [1e-30] * dim), (9021, [1e30] * dim)]


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.embedding_dedup(df).collect()}


def test_brute_force(spark):
    rows = corpus(1)
    assert result(table_of(spark, rows).repartition(5)) == brute(rows)


def test_components_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 8)
    rows = corpus(2)
    assert result(table_of(spark, rows).repartition(5)) == brute(rows)


@pytest.mark.parametrize("n", [1_000, 50_000, 300_000])
def test_recall_at_the_threshold(n):
    """Pairs at cosine 0.9 share a filter nearly always, however many vectors there are."""
    rng = np.random.default_rng(3)
    u = rng.standard_normal((200, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    v = np.stack([near(rng, x, .9) for x in u])
    found = np.zeros(200, bool)
    cap, size = E.settings(n)
    for c in range(E.CODES):
        words = E.code(64, c, size)
        a, b = (set(zip(*(z.tolist() for z in E.decode_list(x, *words, cap)))) for x in (u, v))
        found[[k for k, _, _ in a & b]] = True
    assert found.mean() >= .99


@pytest.mark.parametrize("n", [10_000, 1_000_000, 10_000_000])
def test_chance_of_sharing_no_filter(n):
    """Codes are independent, so a pair's chance is the product of those of the codes."""
    rng = np.random.default_rng(4)
    u = rng.standard_normal((1000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    v = np.stack([near(rng, x, .9) for x in u])
    cap, size = E.settings(n)
    chance = 1.0
    for c in range(E.CODES):
        words, found = E.code(64, c, size), np.zeros(len(u), bool)
        for s in range(0, len(u), 100):
            (k, i, j), (m, p, q) = (E.decode_list(x[s:s + 100], *words, cap) for x in (u, v))
            found[s + k[np.isin((k * size + i) * size + j, (m * size + p) * size + q)]] = True
        chance *= 1 - found.mean()
    assert chance <= 1e-3


def test_a_hot_filter_is_dealt_in_blocks(spark):
    """A filter that nearly all rows share, strays among them, is compared in blocks of bounded
    size: each pair of different components meets, and those of a large one do not."""
    comp = {r: 1 for r in range(1, 301)} | {r: 301 + r % 3 for r in range(301, 340)} | {r: r for r in range(340, 350)}
    members = [(7, r, c) for r, c in comp.items()] + [(8, r, 1) for r in range(1, 100)] + [(9, 1, 1), (9, 345, 345)]
    dealt = B.dealt_across(spark.createDataFrame(members, "key long, rid long, comp long"), 20).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r.key, r.p, r.q), []).append(r)
    assert max(len(g) for g in groups.values()) < 2 * 40 and {k for k, _, _ in groups} == {7, 9}
    met = {(k, *sorted((x.rid, y.rid))) for (k, p, q), g in groups.items()
           for x in g for y in g if x.block == p and y.block == q and x.comp != y.comp}
    assert met == {(k, a, b) for k, a, c in members for m, b, d in members if k == m and a < b and c != d}
    assert len(dealt) < 300 * 10 + 49 * 30

    stars = spark.createDataFrame([(k, r, 0) for k, r, _ in members], "key long, rid long, centre long")
    comps = spark.createDataFrame([x for x in comp.items() if x[0] < 340], "id long, component long")
    sketches = spark.createDataFrame([(r, b"x") for r in comp], "rid long, sketch binary")

    def near(x, y):
        assert len(x) < 40 and len(y) < 40
        return np.ones((len(x), len(y)), bool)

    got = [(r.a, r.b) for r in B.across_pairs(stars, comps, sketches, B.objects, near, 4, 20).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for _, a, b in met}


def test_odd_tables(spark):
    assert E.embedding_dedup(table_of(spark, [])).count() == 0
    v = [1.0, 2.0, 3.0]
    got = E.embedding_dedup(table_of(spark, [(1, v), (1, v), (None, v), (2, None), (2, None)])).collect()
    assert sorted(r.n_links for r in got) == [0, 0, 2, 2, 2] and sum(r.kept for r in got) == 3
