"""Whitening against numpy, and its edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheen.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, h int, n int, w int"


def table_of(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in enumerate(vectors)], schema)


def plain(vectors, components=16, weights=None):
    """(n, deviation, whitened, explained) by numpy, for the distinct vectors or weighted ones."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit, times = np.unique(x, axis=0, return_counts=True)
    w = times if weights == "count" else np.ones(len(fit), int)
    n, s = int(w.sum()), (w[:, None] * fit).sum(axis=0)
    c = (n * fit - s) / n
    v = (c * w[:, None]).T @ c / n
    e, d = np.linalg.eigh(v)
    e, d = e[::-1][:components], d[:, ::-1][:, :components]
    y = n * x - s
    return n, (y * y).sum(axis=1), (y / n) @ d / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("weight", ["one", "count"])
def test_equals_numpy(spark, weight):
    rng = np.random.default_rng(3)
    distinct = rng.normal(0, 1, (120, 20)) @ np.diag(1.3 ** -np.arange(20.0))
    vectors = [distinct[i].astype(np.float32).tolist() for i in [*range(120), *[5] * 200, *rng.integers(0, 120, 60)]]
    got = whitening.whiten(table_of(spark, vectors), weight=weight).orderBy("vec_id").collect()
    n, deviation, z, explained = plain(vectors, weights=weight)
    assert [int(r["deviation"]) for r in got] == deviation.tolist() and {r["n"] for r in got} == {n}
    assert np.allclose(np.abs([r["whitened"] for r in got]), np.abs(z), atol=1e-9)
    assert np.allclose(got[0]["explained"], explained, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_registered_rows(spark, sf):
    got = queries.op11_whitening(spark, sf).toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, z, explained = plain([r["embedding"] for r in vectors])
    wide = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert np.allclose(np.abs(wide), np.abs(z), atol=1e-8) and got.n.unique().tolist() == [n]
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == deviation.tolist()
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, explained)
    assert dict(queries.op11_whitening(spark, sf).dtypes)["deviation"] == "bigint"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, 2.0, -1.0], [0.5, -0.25, 3.0], [1.5, 0.0, 0.0], [0.1, 2.0, -1.0]]
    odd = [None, [], [None, 1.0, 1.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1e30, 1.0, 1.0], [1.0, 2.0]]
    got = whitening.whiten(table_of(spark, good + odd)).orderBy("vec_id").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3] and {r["n"] for r in got} == {3}
    assert got[0]["whitened"] == got[3]["whitened"]
    # three points span two directions: the third has no variance
    assert [z is None for z in got[0]["whitened"]] == [False, False, True] and got[0]["explained"][2] == 0
    rows = whitening.component_rows(whitening.whiten(table_of(spark, good)))
    assert rows.count() == 12 and rows.where("whitened is null").count() == 4


def test_one_vector_and_none(spark):
    got = whitening.whiten(table_of(spark, [[1.0, 2.0]] * 5)).collect()
    assert len(got) == 5 and got[0]["n"] == 1 and got[0]["whitened"] == [None, None] and got[0]["identity_error"] == 0
    for vectors in ([], [None]):
        empty = whitening.whiten(table_of(spark, vectors))
        assert empty.count() == 0 and whitening.component_rows(empty).count() == 0
        assert empty.dtypes == whitening.whiten(table_of(spark, [[1.0, 2.0], [2.0, 1.0]])).dtypes


def test_large_entries_stay_exact(spark):
    vectors = [[2.0 ** 45, 1.0], [-(2.0 ** 44), 3.0], [7.0, 2.0 ** 40]]
    got = whitening.whiten(table_of(spark, vectors)).orderBy("vec_id").collect()
    x = [[int(64 * c) + 1_000_000 for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    assert [int(r["deviation"]) for r in got] == [sum((3 * c - t) ** 2 for c, t in zip(v, s)) for v in x]


def test_null_keys_and_text_keys(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), (None, [2.0, 1.0]), ("a", [1.0, 2.0])], "vec_id string, embedding array<double>")
    got = whitening.whiten(rows)
    assert sorted(str(r["vec_id"]) for r in got.collect()) == ["None", "a", "a"]
    assert got.select(F.max("n")).first()[0] == 2
