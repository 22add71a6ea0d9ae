"""Near copies against brute force."""

import random

from sheen.llm import minhash
from sheen.llm.minhash import near_dedup

DOCS = "doc_id long, text string, rid long, sig string, n int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 3) for i, t in rows], DOCS)


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = [bytes(x).lower() for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    comp = {i: i for i, _ in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                comp[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed, n=220):
    rng = random.Random(seed)
    vocab = ["Lorem", "ipsum", "dÉ", "x", "yy", "Zz", "qw", "er", "ty", "ui"]
    base = [[rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 60, 200, 700]))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(int(len(w) * rng.choice([0, 0, .005, .02, .03, .06]))):
            w[rng.randrange(len(w))] = rng.choice(vocab) + str(rng.randint(0, 99))
        t = rng.choice([" ", "\n", "\t "]).join(w)
        rows.append((i * 2, t.upper() if rng.random() < .1 else t))
    return [*rows, (9001, None), (9003, ""), (9005, " \n"), (9007, None), (9009, "one"), (9011, "ONE"), (9013, "one two")]


def check(spark, rows, **kw):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(docs_of(spark, rows).repartition(5), **kw).collect()}
    want = brute([(i, t and t.encode().decode() or t) for i, t in rows], kw.get("width", 3), kw.get("percent", 85))
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert got == want


def test_near_copies_brute_force(spark):
    check(spark, corpus(1))


def test_five_words(spark):
    check(spark, corpus(2), width=5, percent=80)


def test_family_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 6)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    check(spark, corpus(4))


def test_links_without_the_first_pairs_without_the_first_document(spark):
    """b and c are near copies of each other but only half like a, which comes first."""
    rng = random.Random(5)
    a = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = [(0, " ".join(a))]
    for k in range(1, 30):
        b = a[:330] + [f"x{j}" for j in range(70)]
        b[k * 5] = "edit"
        rows.append((k, " ".join(b)))
    check(spark, rows)


def test_odd_tables(spark):
    assert near_dedup(docs_of(spark, [])).count() == 0
    t = " ".join(f"w{i}" for i in range(50))
    got = near_dedup(docs_of(spark, [(5, t), (5, t), (None, t), (3, None), (3, t + " more")])).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 2
    assert sorted(r.n_shingles for r in got) == [0, 48, 48, 48, 49]


def test_miss_rate_of_the_keys():
    """By the formula, a link at the threshold is missed less than once in a thousand."""
    for percent in (80, 85, 95):
        s, n = percent / 100, minhash.bands_for(percent)
        assert 2 * (1 - s ** minhash.BAND) ** n < 1e-3
