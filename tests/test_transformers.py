"""Fitted transformers, approximate neighbours, sketches, snapshots and rejected lines."""

import random

from pyspark.sql import functions as F

from sheen.functions.constants import TRAITS
from sheen.operators import factors as FA
from sheen.operators import features as FE
from sheen.operators import relational as R
from sheen.operators import transformers as TR
from sheen.plans import registry as RG
from sheen.sources import io as IO

FEATS = "pro_ids int, names string, ratings double, repurchases double, pkg_quals double, prices int, groups array<string>"


def products(spark, n=300, seed=1):
    rnd = random.Random(seed)
    rows = [(p, f"n{p}", rnd.randint(10, 50) / 10, rnd.random(), float(rnd.randint(1, 5)), rnd.randint(1, 5),
             sorted({f"g{rnd.randint(0, 30)}" for _ in range(rnd.choice([0, 0, 3, 8]))})) for p in range(n)]
    return rows, spark.createDataFrame(rows, FEATS).withColumn("n_groups", F.size("groups"))


def test_product_vectors_of_products_never_seen(spark, tmp_path):
    rows, feats = products(spark, 60)
    IO.save_artifacts(spark, str(tmp_path), {}, {"m": TR.fit_product_vectors(feats)})
    model = IO.load_artifacts(spark, str(tmp_path))["m"]
    names = TR.vector_columns(model)
    assert names == sorted({g for r in rows for g in r[6]}) + FE.NUMERIC
    new = [(900, "x", 2.0, 0.5, 1.0, 3, ["g1", "g1", "unheard of"]), (901, "y", 0.0, 0.0, 0.0, 0, [])]
    got = {}
    for r in TR.long_form(model.transform(spark.createDataFrame(new, FEATS)), "pro_ids").where("value <> 0").collect():
        got.setdefault(r.pro_ids, {})[names[r.feature_idx]] = r.value
    assert got == {900: {"g1": 1.0, "ratings": 2.0, "repurchases": 0.5, "pkg_quals": 1.0, "prices": 3.0}}
    assert TR.long_form(TR.fit_product_vectors(feats.limit(0)).transform(feats), "pro_ids").where("value <> 0").count() > 0


def test_trait_vectors_of_users_never_seen(spark):
    users = spark.createDataFrame([(i, *[f"v{(i + j) % 3}" if (i + j) % 4 else None for j in range(8)]) for i in range(12)],
                                  "uid int, " + ", ".join(f"{t} string" for t in TRAITS))
    model = TR.fit_trait_vectors(users)
    names = TR.vector_columns(model)
    new = spark.createDataFrame([(1, "v1", "unheard of", *[None] * 6), (2, *[None] * 8)], users.schema)
    got = [(r.uid, names[r.feature_idx], r.value) for r in TR.long_form(model.transform(new), "uid").collect()]
    assert got == [(1, f"{TRAITS[0]}=v1", 1.0)]
    one_hot = {(r.uid, r.slot) for r in FE.one_hot_traits(users).collect()}
    assert {(r.uid, r.feature_idx) for r in TR.long_form(model.transform(users), "uid").collect()} == one_hot


def recall(exact, approx):
    """Share of the exact neighbours' places that the approximate ones fill at no greater distance."""
    far = {(r.req_id, r["rank"]): r.dist2 for r in exact.collect()}
    got = {(r.req_id, r["rank"]): r.dist2 for r in approx.collect()}
    return sum(k in got and got[k] <= d + 1e-9 for k, d in far.items()) / len(far)


def test_approx_recall(spark):
    _, feats = products(spark, 800)
    q = feats.where("pro_ids % 20 = 0").select(F.col("pro_ids").alias("req_id"), "pro_ids")
    got = TR.similar_products_approx(feats, q, 10).persist()
    assert recall(FE.similar_products(feats, q, 10), got) >= 0.9
    assert got.where("req_id = pro_ids").count() == 0 and got.groupBy("req_id").count().where("count > 10").count() == 0
    true = got.join(feats.select(F.col("pro_ids").alias("req_id"), F.struct("groups", *FE.NUMERIC).alias("a")), "req_id").join(
        feats.select("pro_ids", F.struct("groups", *FE.NUMERIC).alias("b")), "pro_ids")
    for r in true.collect():
        d = len(set(r.a.groups) ^ set(r.b.groups)) + sum((float(r.a[c]) - float(r.b[c])) ** 2 for c in FE.NUMERIC)
        assert abs(d - r.dist2) < 1e-6


def test_approx_recall_of_the_registered_query(spark, sf):
    exact = FE.similar_products(RG.features_fx(spark, sf), RG.approx_due_fx(spark, sf), 10)
    assert recall(exact, RG.QUERIES["similar_products_approx"](spark, sf)) >= 0.9


def test_pivot_sums_are_all_ratings(spark):
    r = spark.createDataFrame([(u % 9, u, float(u % 5 + 1)) for u in range(500)] * 2, "pro_ids int, uid int, lipies double")
    wide = FA.rating_pivot(r, 16)
    assert len(wide.columns) == 17
    sums = {x.pro_ids: sum(x[c] for c in wide.columns[1:]) for x in wide.collect()}
    assert sums == {x.pro_ids: x.s for x in r.groupBy("pro_ids").agg(F.sum("lipies").alias("s")).collect()}
    each = FA.rating_pivot(r.where("uid < 5"), 5).collect()
    assert [x.u03 for x in each if x.pro_ids == 3] == [8.0]


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(0, 60_000).select((F.col("id") % 7).cast("string").alias("cat"), (F.col("id") % 20_011).alias("user"))
    kept = R.count_sketches(df, "user", "cat")
    assert kept.count() == 7
    est = R.union_counts(kept).first()[0]
    assert abs(est - 20_011) <= 20_011 * R.SKETCH_BOUND
    for r in R.union_counts(kept, ["cat"]).collect():
        assert abs(r.estimate - 8_571) <= 8_571 * R.SKETCH_BOUND
    assert R.union_counts(R.count_sketches(df.limit(0), "user", "cat")).first()[0] in (0, None)


def test_a_second_crawl_replaces_one_category(spark, tmp_path):
    df = spark.createDataFrame([(i, str(700 + i % 4)) for i in range(40)], "pro_ids int, cat_id string")
    path = IO.sink_by_category(df, str(tmp_path / "c"))
    IO.sink_by_category(df.where("cat_id = '702' and pro_ids < 10"), path)
    got = {(r.pro_ids, r.cat_id) for r in IO.load_categories(spark, path).collect()}
    assert got == {(i, str(700 + i % 4)) for i in range(40) if i % 4 != 2 or i < 10}


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text("pro_ids,uid,lipies\n1,2,3.0\n1,x,3\n5,6\n7,8,\n9,10,1.5,extra\n,3,2\n4,4,4\n")
    good, bad = IO.scan_ratings(spark, str(tmp_path / "r.csv"))
    assert sorted(map(tuple, good.collect())) == [(1, 2, 3.0), (4, 4, 4.0)]
    assert sorted(map(tuple, bad.collect())) == [(",3,2.0", "missing"), ("1,x,3", "types"), ("5,6", "columns"), ("7,8,", "missing"),
                                                 ("9,10,1.5,extra", "columns")]
