"""Quality classifier on held-out labels, tokens against the public library, the pipeline."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from sheen.llm import pieces, quality
from sheen.session import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, given int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1) for i, t in rows], DOCS)


def test_labels_held_out(spark):
    """Fitted on two thirds of the labels, judged on the rest."""
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    held = labels.where("doc_id % 3 = 0")
    got = quality.quality_scores(table(spark, sf, "documents"), labels.where("doc_id % 3 <> 0")).join(held, "doc_id")
    n = {(r.quality, r.toxic): (r.n, r.kept) for r in got.groupBy("quality", "toxic").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert n[0, 0][1] <= 0.02 * n[0, 0][0]  # junk
    assert n[1, 1][1] <= 0.2 * n[1, 1][0]  # abuse, also in languages without a labeller
    assert n[1, 0][1] >= 0.99 * n[1, 0][0]  # clean


def test_labellers_by_hand():
    votes = np.array([[1, 0, 0], [0, 1, 0], [1, 1, 0], [0, 0, 1], [0, 0, 0]])
    p, right = quality.fit_labellers(votes, ["bad", "bad", "good"], np.array([0, 0, 0, 0, 1]), np.array([10.0, 10, 10, 300, 100]))
    assert (p[:3] > 0.5).all() and (p[3:] < 0.1).all() and len(right) == 4 and (right < 1).all()


def test_labellers_equal_a_plain_em():
    """Posteriors and accuracies of expectation-maximisation, pattern by pattern and row by row."""
    rng = np.random.default_rng(5)
    votes = rng.integers(0, 2, (30, 4))
    says, given = ["bad", "bad", "good", "good"], rng.integers(0, 3, 30)
    counts = rng.integers(1, 50, 30).astype(float)
    got, right = quality.fit_labellers(votes, says, given, counts)
    kinds = [*says, "given"]
    acc, prior, p = [sum(quality.BOUNDS[k]) / 2 for k in kinds], 0.2, [0.0] * 30
    for _ in range(1000):
        new = []
        for v, g in zip(votes, given):
            said = [(1 if k == "bad" else -1) if x else 0 for x, k in zip(v, says)] + [{0: 0, 1: -1, 2: 1}[int(g)]]
            bad, good = prior, 1 - prior
            for x, a in zip(said, acc):
                bad *= {1: a, -1: 1 - a, 0: 1}[x]
                good *= {1: 1 - a, -1: a, 0: 1}[x]
            new.append((bad / (bad + good), said))
        done = max(abs(x - y) for (x, _), y in zip(new, p)) < 1e-9
        if done:
            break
        p = [x for x, _ in new]
        prior = min(max(sum(x * c for x, c in zip(p, counts)) / counts.sum(), 0.01), 0.5)
        for j, k in enumerate(kinds):
            low, high = quality.BOUNDS[k]
            n = sum(c for (_, said), c in zip(new, counts) if said[j])
            hit = sum(c * (x if said[j] > 0 else 1 - x) for (x, said), c in zip(new, counts) if said[j])
            acc[j] = min(max((hit + low) / (n + 1), low), high)
    assert np.allclose(got, p, atol=1e-7) and np.allclose(right, acc, atol=1e-7)


def test_weak_good_labels_weigh_less_the_more_are_given(spark):
    """No number of given labels changes how rows are treated at once: scores move little by little."""
    rng = random.Random(2)
    rows = [(i, prose(rng)) for i in range(60)] + [(100 + i, "spam " * (30 + i)) for i in range(20)]
    docs = docs_of(spark, rows)
    kept = []
    for n in (0, 1, 30, 60):
        labels = spark.createDataFrame([(i, 1, 0) for i in range(n)] + [(100, 0, 0)], "doc_id long, quality int, toxic int")
        kept.append({r.doc_id for r in quality.quality_scores(docs, labels).where("kept").collect()})
    assert all(k == set(range(60)) for k in kept)


PROSE = ["The river went past the old mill.", "Nobody in the house had heard the rain.", "She wrote three letters before noon,",
         "and then walked slowly to the harbour.", "A small boat waited there for the evening tide."]


def prose(rng, n=6):
    return " ".join(rng.sample(PROSE, min(n, 5)) + [f"It was the {rng.randint(1, 999)}th day of the journey."])


def test_quality_odd_tables(spark):
    assert quality.quality_scores(docs_of(spark, [])).count() == 0
    assert quality.good_documents(docs_of(spark, [])).count() == 0
    rng = random.Random(1)
    rows = [(i, prose(rng)) for i in range(40)] + [(100 + i, "spam " * (30 + i)) for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, prose(rng)), (0, rows[0][1]), (203, prose(rng) * 2000)]
    got = {(r.doc_id, r.score): r.kept for r in quality.quality_scores(docs_of(spark, rows)).collect()}
    assert len(quality.quality_scores(docs_of(spark, rows)).collect()) == len(rows)
    kept = {i for (i, _), k in got.items() if k}
    assert kept >= set(range(40)) and not kept & {200, 201, 202} and not kept & set(range(100, 120))
    out = quality.good_documents(docs_of(spark, rows))
    assert out.columns == docs_of(spark, []).columns and {r.doc_id for r in out.collect()} == kept
    assert quality.good_documents(docs_of(spark, rows[:40])).count() == 40  # one class only


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def test_tokens_like_the_library(spark, library, sf):
    rng = random.Random(1)
    bits = "the aeiou  \n\tqXé漢字🙂ﬁ①1234.,!?()<>=ing er on\u200b"
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for i in range(500)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, " " * 99), (1004, "a" * 5000), (1005, "<0x41> <s> </s>"),
             (1006, "a▁b"), (None, "no id"), (0, rows[0][1])]
    rows += [(2000 + r.doc_id, r.text) for r in table(spark, sf, "documents").limit(60).collect()]
    for size in (pieces.CHUNK, 50):
        pieces.CHUNK, before = size, pieces.CHUNK
        encoder = pieces.Encoder(pieces.read_model(pieces.default_model()))
        data = [(t or "").encode() for _, t in rows]
        off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
        out = []
        for i, j, tokens, counts in encoder.encode(np.frombuffer(b"".join(data), np.uint8), off):
            out += [x.tolist() for x in np.split(tokens, np.cumsum(counts)[:-1])]
        pieces.CHUNK = before
        assert out == library.encode([t or "" for _, t in rows])
    got = pieces.encode(docs_of(spark, rows).repartition(3))
    # U+2581 decodes to a space, which is not the text
    assert all(r.round_trip == (r.doc_id != 1006) and r.n_tokens == len(r.ids) for r in got.collect()) and got.count() == len(rows)
    back = pieces.decode(got).collect()
    want = sorted(((i is not None, i or 0, (t or "").replace("▁", " ")) for i, t in rows))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in back) == want
    assert pieces.encode(docs_of(spark, [])).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage on a small corpus, each judged on what its predecessor kept."""
    rng = random.Random(3)
    vocab = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(120):
        t = " ".join(rng.choice(vocab) for _ in range(60)) + "."
        rows.append((i, t, "abc"[i % 3]))
    rows += [(200 + i, rows[i][1].replace(" ", "  "), "a") for i in range(10)]  # exact copies; the longer text stays
    rows += [(300 + i, rows[20 + i][1] + " more", "b") for i in range(10)]  # near copies
    rows += [(400 + i, "spam " * 50, "c") for i in range(10)] + [(500, None, None), (501, "", "a"), (0, rows[0][1], "a")]
    docs = spark.createDataFrame([(i, t, "en", s, 1, 7, "x") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int, taken string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "sentencepiece":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
    ids = {n: sorted(r.doc_id for r in x) for n, x in seen.items()}
    assert ids["quality"] == sorted([*range(120), *range(200, 210), *range(300, 310), 0])
    assert ids["exact_dedup"] == sorted([*range(10, 120), *range(200, 210), *range(300, 310)])
    assert ids["near_dedup"] == sorted([*range(10, 120), *range(200, 210)])
    n, kept = {}, {r.doc_id: r.source for r in seen["near_dedup"]}
    for i in ids["mix_sources"]:
        n[i] = n.get(i, 0) + 1
    assert set(n) <= set(kept) and max(n.values()) <= 3
    words = {s: sum(len(r.text.split()) * n.get(r.doc_id, 0) for r in seen["near_dedup"] if r.source == s) for s in "abc"}
    total = sum(len(r.text.split()) for r in seen["near_dedup"])
    for s, w in zip("abc", (5, 2, 1)):
        assert abs(words[s] - total * w / 8) <= 60
    assert ids["sentencepiece"] == ids["mix_sources"] and all(r.round_trip for r in seen["sentencepiece"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(whole) == sorted(seen["sentencepiece"])


def test_pipeline_odd_tables(spark, tmp_path):
    """An empty table, and one with null keys and texts, a very long text, and its near copy."""
    rng = random.Random(5)
    vocab = [f"term{k}" for k in range(500)]
    long = " ".join(rng.choice(vocab) for _ in range(150_000)) + "."
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(50)) + ".", "ab"[i % 2]) for i in range(40)]
    odd = [(None, "A text without a key, " + rows[0][1], "a"), (None, None, None), (70, None, "a"), (71, " \n", None),
           (80, long, "a"), (81, long + " more", "a"), rows[3], rows[3]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, component int"
    for k, table in enumerate(([], rows + odd)):
        at = f"{tmp_path}/{k}"
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([(i, t, None, s, None, 7, "x", 3) for i, t, s in table], schema).write.parquet(
            f"{at}/documents.parquet")
        docs = spark.read.parquet(f"{at}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:3]:
            out = stage(spark, docs, at)
            assert out.columns == docs.columns
            out.write.parquet(f"{at}/{name}")
            docs = spark.read.parquet(f"{at}/{name}")
        kept = [r.doc_id for r in docs.collect()]
        # the row without a key is a near copy of row 0 and sorts before it
        assert sorted(i for i in kept if i is not None) == ([*range(1, 40), 80] if table else [])
        assert kept.count(None) == (1 if table else 0)
        got = corpus_pipeline.run(spark, at).collect()
        assert all(r.round_trip for r in got) and bool(got) == bool(table)
        assert all(stage(spark, spark.read.parquet(f"{at}/documents.parquet").limit(0), at).count() == 0
                   for _, stage in corpus_pipeline.STAGES)
