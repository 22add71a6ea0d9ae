"""Exact joins against brute force on small inputs."""

import itertools
import random

from pyspark.sql import functions as F

from sheen.functions.constants import TRAIT_DOMAINS, TRAITS
from sheen.operators import factors as FA
from sheen.operators import features as FE
from sheen.operators import ingredients as I
from sheen.operators.relational import dense_index
from sheen.plans import registry as R


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_edit_distance_examples(spark):
    v = spark.createDataFrame([("retinol",), ("retinal",), ("titanium dioxide",)], "token string")
    got = {(r.token_a, r.token_b): r.dist for r in I.edit_distance_pairs(v, 13, None).collect()}
    assert got[("retinal", "retinol")] == 1
    assert got[("retinol", "titanium dioxide")] == lev("retinol", "titanium dioxide") == 13


def test_edit_distance_is_exact(spark):
    rnd = random.Random(7)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 9))) for _ in range(300)})
    v = spark.createDataFrame([(w,) for w in words] + [(None,)], "token string")
    for k, per in ((1, None), (2, None), (3, None), (1, 3)):
        got = {(r.token_a, r.token_b): r.dist for r in I.edit_distance_pairs(v, k, per).collect()}
        want = {(a, b): d for a, b in itertools.combinations(words, 2)
                if (d := lev(a, b)) <= max(k, max(len(a), len(b)) // (per or 99))}
        assert got == want


def test_edit_bound_follows_the_length(spark, monkeypatch):
    """Long tokens, on both sides of the length where the lookup changes, and hot keys split."""
    rnd = random.Random(5)
    words = set()
    for _ in range(25):
        base = [rnd.choice(["tion", "eth", "an ", "o", "acid "]) for _ in range(rnd.randint(2, 45))]
        for _ in range(4):
            w = list("".join(base))
            for _ in range(rnd.randint(0, len(w) // 6)):
                at = rnd.randrange(len(w))
                w[at:at + rnd.randint(0, 1)] = rnd.choice(["x", "", "on"])
            words.add("".join(w))
    words = sorted(w for w in words if w)
    v = spark.createDataFrame([(w,) for w in words], "token string")
    monkeypatch.setattr(I, "HOT_KEY", 5)
    want = {(a, b): d for a, b in itertools.combinations(words, 2) if (d := lev(a, b)) <= max(2, max(len(a), len(b)) // 8)}
    assert any(d > 6 for d in want.values())
    for most in (100_000, 0):
        monkeypatch.setattr(I, "SPLIT_KEYS", most)
        rows = I.edit_distance_pairs(v).collect()
        assert {(r.token_a, r.token_b): r.dist for r in rows} == want and len(rows) == len(want)


def test_dense_index_is_a_bijection(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("u"), (F.col("id") * 7919 % 5000).cast("string"))
                                     .alias("users"))
    out = dense_index(df, "users", "uid").collect()
    pairs = sorted((r.users, r.uid) for r in out)
    assert [p[1] for p in pairs] == list(range(5000))


def test_similar_users_brute_force(spark):
    rnd = random.Random(3)
    rows = [(u, *[rnd.choice(TRAIT_DOMAINS[t][:3]) for t in TRAITS]) for u in range(400)]
    traits = spark.createDataFrame(rows, "uid int, " + ", ".join(f"{t} string" for t in TRAITS))
    reqs = [(q, *[None if (q + j) % 4 == 0 else rnd.choice(TRAIT_DOMAINS[t][:3])
                  for j, t in enumerate(TRAITS)]) for q in range(6)]
    requests = spark.createDataFrame(reqs, "req_id int, " + ", ".join(f"{t} string" for t in TRAITS))
    got = {}
    for r in FE.similar_users(traits, requests, k=10).collect():
        got.setdefault(r.req_id, []).append((r.rank, r.uid, r.dist2))
    for q in reqs:
        d = []
        for row in rows:
            qs = sum(v is not None for v in q[1:])
            m = sum(a == b for a, b in zip(q[1:], row[1:]) if a is not None)
            d.append((float(qs + 8 - 2 * m), row[0]))
        want = [(i + 1, u, dd) for i, (dd, u) in enumerate(sorted(d)[:10])]
        assert sorted(got[q[0]]) == want


def test_similar_products_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for p in range(300):
        groups = sorted({f"g{rnd.randint(0, 12)}" for _ in range(rnd.randint(0, 6))})
        rows.append((p, f"n{p % 50}", float(rnd.randint(10, 50)) / 10, rnd.random(), float(rnd.randint(1, 5)),
                     rnd.randint(1, 5), groups))
    feats = spark.createDataFrame(rows, "pro_ids int, names string, ratings double, repurchases double, "
                                        "pkg_quals double, prices int, groups array<string>") \
        .withColumn("n_groups", F.size("groups"))
    q = spark.createDataFrame([(0, 3), (1, 77), (2, 150)], "req_id int, pro_ids int")
    got = {}
    for r in FE.similar_products(feats, q, k=10).collect():
        got.setdefault(r.req_id, []).append((r.rank, r.pro_ids))
    for req, qid in [(0, 3), (1, 77), (2, 150)]:
        a = rows[qid]
        d = []
        for b in rows:
            if b[0] == qid:
                continue
            inter = len(set(a[6]) & set(b[6]))
            dd = float(len(a[6]) + len(b[6]) - 2 * inter)
            for x, y in zip(a[2:6], b[2:6]):
                dd = dd + (float(x) - float(y)) * (float(x) - float(y))
            d.append((dd, b[0]))
        want = [(i + 1, pid) for i, (_, pid) in enumerate(sorted(d)[:10])]
        assert sorted(got[req]) == want


def plain_top_k(rows, due, k):
    """Brute force over (id, vector); products summed one component after the other."""
    out = []
    for q in due:
        x = dict(rows)[q]
        scored = sorted((-sum_in_order(x, v), i) for i, v in rows if i != q and len(v) == len(x))
        out += [(q, i, round(-s, 9) + 0.0, r + 1) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def sum_in_order(x, y):
    total = 0.0
    for a, b in zip(x, y):
        total += a * b
    return total


def top_k_rows(unit, due, k, **kw):
    queries = unit.sparkSession.createDataFrame([(d,) for d in due], "pro_ids long")
    return sorted((r.req_id, r.pro_ids, round(r.score, 9) + 0.0, r["rank"]) for r in FA.cosine_top_k(unit, queries, k, **kw).collect())


def test_cosine_top_k_of_clustered_vectors(spark, monkeypatch):
    """Clusters of very different sizes, zeros and repeated vectors; blocks are ruled out, no row is lost."""
    import numpy as np
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.normal(size=6)
        for _ in range(400 if c == 0 else 40):
            v = centre + rng.normal(size=6) * 0.05
            rows.append((len(rows), (v / np.linalg.norm(v)).tolist()))
    rows += [(2000 + i, rows[i * 7][1]) for i in range(40)] + [(3000, [0.0] * 6), (3001, [0.0] * 6)]
    monkeypatch.setattr(FA, "BLOCK", 16)
    counted = []
    scored = FA._scored
    monkeypatch.setattr(FA, "_scored", lambda pairs, asked, blocks, k: counted.append((pairs.count(), asked.count() * blocks.count())) or scored(pairs, asked, blocks, k))
    unit = spark.createDataFrame(rows, "pro_ids long, vec array<double>").repartition(5)
    due = [i for i, _ in rows if i % 20 == 0]
    assert top_k_rows(unit, due, 5) == plain_top_k(rows, due, 5)
    assert sum(n for n, _ in counted) < counted[0][1] / 2
    few = rows[:3]
    assert top_k_rows(unit.where("pro_ids < 3"), [0, 1], 10) == plain_top_k(few, [0, 1], 10)


def test_cosine_top_k_odd_vectors(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.6, 0.8]) for i in range(1, 1300)] + [(5001, [1.0]), (5003, [0.5])]
    odd = [(5000, None), (5002, [float("nan"), 1.0]), (5004, []), (None, [1.0, 0.0])]
    unit = spark.createDataFrame(rows + odd, "pro_ids long, vec array<double>").repartition(3)
    assert top_k_rows(unit, [20, 21, 5000, 5001, 5002, 9999], 3) == plain_top_k(rows, [20, 21, 5001], 3)
    none = unit.limit(0)
    assert FA.cosine_top_k(none, none.select("pro_ids")).count() == 0 and FA.cosine_scores(none, none.select("pro_ids")).count() == 0
    every = FA.cosine_scores(unit, spark.createDataFrame([(20,), (5001,)], "pro_ids long")).collect()
    assert len(every) == 1299 + 2 and {round(r.score, 6) for r in every if r.req_id == 20} == {1.0, 0.6}


def test_factor_top_k_on_fitted_factors(spark, sf):
    """The registered search over fitted factors against brute force, and their names."""
    u = [(r.pro_ids, r.f) for r in R.unit_factors_fx(spark, sf).collect()]
    due = [i for i, _ in u if i % 20 == 0]
    got = sorted((r.req_id, r.pro_ids, round(r.score, 9) + 0.0, r["rank"]) for r in R.QUERIES["factor_top_k"](spark, sf).collect())
    assert [(g[0], round(g[2], 7), g[3]) for g in got] == [(w[0], round(w[2], 7), w[3]) for w in plain_top_k(u, due, 10)]
    named = R.QUERIES["named_factors"](spark, sf)
    assert named.where("names is null").count() == 0 and named.count() == 20 * len(u)


def test_grid_nearest_brute_force(spark):
    """Uneven points, ties, queries outside, fewer points than asked for, and null coordinates."""
    rnd = random.Random(11)
    points = [(i, rnd.choice([0.0, 1.0, 2.5]), rnd.random() * 10 ** rnd.randint(-3, 2)) for i in range(150)] + [(900, None, 1.0)]
    queries = [(1000 + i, rnd.random() * 3, rnd.random() * 10) for i in range(40)] + [(5000, -40.0, 9.0), (5001, 0.0, 500.0), (6000, None, 0.0)]
    p = spark.createDataFrame(points, "id int, x double, y double")
    q = spark.createDataFrame(queries, "q long, x double, y double")
    for k in (1, 7, 200):
        got = {}
        for r in FE.grid_nearest(p, q, k, ["x", "y"], "id").collect():
            got.setdefault(r.q, []).append((r.cost, r.id))
        assert set(got) == {x[0] for x in queries if x[1] is not None}
        for name, x, y in queries:
            if x is not None:
                want = sorted(((x - a) ** 2 + (y - b) ** 2, i) for i, a, b in points if a is not None)
                last = want[min(k, len(want)) - 1][0]
                assert sorted(i for _, i in got[name]) == sorted(i for c, i in want if c <= last * (1 + 1e-9) + 1e-12)


def test_similar_products_without_groups(spark):
    """Distinct numerics and no groups at all: every request's neighbours, by brute force."""
    rnd = random.Random(9)
    rows = [(p, f"n{p}", rnd.random() * 4, rnd.random(), rnd.random() * 5, rnd.randint(1, 5), []) for p in range(250)]
    feats = spark.createDataFrame(rows, "pro_ids int, names string, ratings double, repurchases double, "
                                        "pkg_quals double, prices int, groups array<string>").withColumn("n_groups", F.size("groups"))
    q = feats.select(F.col("pro_ids").alias("req_id"), "pro_ids")
    got = {}
    for r in FE.similar_products(feats, q, k=10).collect():
        got.setdefault(r.req_id, []).append((r["rank"], r.pro_ids))
    for a in rows:
        want = sorted((sum((float(x) - float(y)) * (float(x) - float(y)) for x, y in zip(a[2:6], b[2:6])), b[0]) for b in rows if b[0] != a[0])
        assert [i for _, i in sorted(got[a[0]])] == [i for _, i in want[:10]]
    few = FE.similar_products(feats.where("pro_ids < 4"), q.where("pro_ids < 4"), k=10)
    assert few.count() == 12


def test_similar_users_with_repeated_rows(spark):
    """Profiles that many users share, users with several equal rows, and unset traits."""
    rnd = random.Random(8)
    rows = [(u % 60, *[rnd.choice([None, *TRAIT_DOMAINS[t][:2]]) if j < 3 else "same" for j, t in enumerate(TRAITS)]) for u in range(200)]
    rows += rows[:30] * 2
    schema = ", ".join(f"{t} string" for t in TRAITS)
    traits = spark.createDataFrame(rows, f"uid int, {schema}")
    reqs = [(q, *[rnd.choice([None, TRAIT_DOMAINS[t][0]]) if j < 4 else "same" for j, t in enumerate(TRAITS)]) for q in range(8)] + [(99, *[None] * 8)]
    got = {}
    for r in FE.similar_users(traits, spark.createDataFrame(reqs, f"req_id int, {schema}"), k=10).collect():
        got.setdefault(r.req_id, []).append((r["rank"], r.uid, r.dist2))
    for q in reqs:
        d = sorted((float(sum(v is not None for v in q[1:]) + sum(v is not None for v in row[1:])
                          - 2 * sum(a == b for a, b in zip(q[1:], row[1:]) if a is not None)), row[0]) for row in rows)
        assert sorted(got[q[0]]) == [(i + 1, u, dd) for i, (dd, u) in enumerate(d[:10])]
