"""Language ID: held-out accuracy, a plain version of the vectors, and edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from sheen.llm import language_id as L
from sheen.llm import queries

SCHEMA = "doc_id long, text string, lang string, t string, some string, learn int"


def test_counts_equal_plain():
    texts = ["de la", "", "x", "é ü", "abc " * 50]
    data = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    small, L.SLICE = L.SLICE, 37
    try:
        got = L.term_counts(np.frombuffer(b"".join(data), np.uint8), off)
    finally:
        L.SLICE = small
    want = np.zeros_like(got)
    for i, d in enumerate(data):
        d = b" " + d + b" "
        for n in L.GRAMS:
            for k in range(len(d) - n + 1):
                code = n
                for c in d[k:k + n]:
                    code = code << 8 | c
                want[i, (code * 0x9E3779B97F4A7C15) % 2 ** 64 >> 64 - 15] += 1
    assert (got == want).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op13_language_id(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) == len(got)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and both.score.between(0, 1).all()
    assert set(got.lang_pred) <= set(docs.lang)


def test_predictions_read_the_text_alone(spark):
    """Held-out rows get the same answer whatever their language, id and other columns say."""
    rows = [(i, " ".join(w[(i * 7 + k) % 4] for k in range(12)), lang, "t", "s", 1)
            for i in range(80) for lang, w in [(("xx", ["olo", "bolo", "molo", "tolo"]) if i % 2 else ("yy", ["iki", "piki", "riki", "siki"]))]]
    new = [(1000 + i, "olo molo bolo", lang, "z", "z", 0) for i, lang in enumerate(["xx", "yy", None])]
    docs = spark.createDataFrame(rows + new, SCHEMA)
    got = {r["doc_id"]: r for r in L.languages(docs, learn=F.col("doc_id") < 1000).collect()}
    assert len(got) == 83 and {got[1000 + i]["lang_pred"] for i in range(3)} == {"xx"}
    assert len({got[1000 + i]["score"] for i in range(3)}) == 1
    assert all(got[i]["lang_pred"] == ("xx" if i % 2 else "yy") for i in range(80))


def test_odd_rows(spark):
    base = [(i, "olo bolo molo " * 5 if i % 2 else "iki piki riki " * 5, "xx" if i % 2 else "yy", "", "", 0) for i in range(40)]
    odd = [(100, None, "xx", "", "", 0), (101, "", "zz", "", "", 0), (102, "123 -- 456!", "qq", "", "", 0), (None, "olo bolo", None, "", "", 0),
           (103, "olo bolo", "xx", "", "", 0), (103, "olo bolo", "xx", "", "", 0), (104, "iki riki " * 300_000, None, "", "", 0),
           (105, "4f 5g", None, "", "", 0), (106, "Ж", None, "", "", 0)]
    got = L.languages(spark.createDataFrame(base + odd, SCHEMA)).collect()
    rows = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in got}
    assert len(got) == 49 and len([r for r in got if r["doc_id"] == 103]) == 2
    assert rows[100] == rows[101] == rows[102] == ("und", 0.0, True)
    assert rows[None][0] == rows[103][0] == "xx" and rows[104][0] == "yy"
    assert rows[105] == ("xx", 0.0, True) and rows[106][0] in ("xx", "yy") and rows[106][2]
    empty = L.languages(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and [c for c, _ in empty.dtypes] == ["doc_id", "lang_pred", "score", "rejected"]
    unknown = L.languages(spark.createDataFrame(odd, SCHEMA), learn=F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}


def test_held_out_of_null_keys(spark):
    docs = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long")
    got = {r[0]: r[1] for r in docs.select("doc_id", L.held_out(F.col("doc_id"))).collect()}
    assert got == {None: False, 1: zlib.crc32(b"1") % 5 == 0, 2: zlib.crc32(b"2") % 5 == 0}


def test_cluster_separates():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(0, 0.05, (60, 8)))
    x[:30, 0] += 1
    x[30:, 3] += 1
    x /= np.linalg.norm(x, axis=1)[:, None]
    c, label = L.cluster(x, 2)
    assert len(set(label[:30])) == len(set(label[30:])) == 1 and label[0] != label[-1]
    assert L.cluster(x[:1])[0].shape == (1, 8)
