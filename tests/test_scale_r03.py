"""Work that must not be repeated or pile up in one task as tables grow."""

import random

import numpy as np
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from sheen.operators import affinity as AF
from sheen.operators import collab as CO
from sheen.operators import factors as FA
from sheen.operators import ingredients as I
from sheen.operators import transformers as TR
from sheen.plans import registry as RG
from sheen.sources import io as IO


def test_one_row_group_is_spread_though_its_file_has_many_splits(spark, tmp_path):
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).coalesce(1).write.parquet(str(tmp_path / "one"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        one = spark.read.parquet(str(tmp_path / "one"))
        assert one.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        out = IO.spread_files(one, str(tmp_path / "copy"))
        longest = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert longest * spark.sparkContext.defaultParallelism <= 1.5 * 20_000
        assert out.exceptAll(one).count() == 0 and out.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_table_is_spread(spark, tmp_path):
    assert IO.spread_files(spark.range(0), str(tmp_path / "copy")).count() == 0


def test_texts_are_tokenised_once(spark, monkeypatch):
    texts = [(1, ["retinol", "water"]), (2, ["retinal", "water", "water"]), (3, []), (None, ["zinc"])]
    read = spark.sparkContext.accumulator(0)

    def count(t):
        read.add(1)
        return t

    tokens = spark.createDataFrame(texts, "pro_ids int, tokens array<string>").repartition(1)
    tokens = tokens.select("pro_ids", F.udf(count, "array<string>").asNondeterministic()("tokens").alias("tokens"))
    monkeypatch.setattr(RG, "tokens_fx", lambda spark, sf: tokens)
    got = {r.pro_ids: list(r.groups) for r in RG.pgroups_fx(spark, "").collect()}
    assert got == {1: ["rtnl", "wtr"], 2: ["rtnl", "wtr"], None: ["znc"]}
    assert read.value == len(texts)
    assert sorted(map(tuple, I.group_members(RG.groups_fx(spark, "")).select("group", "exemplar", "n_members").distinct().collect())) == [
        ("rtnl", "retinal", 2), ("wtr", "water", 1), ("znc", "zinc", 1)]
    assert read.value == 2 * len(texts)


def test_pivot_keeps_no_wide_sums_before_the_shuffle(spark):
    r = spark.createDataFrame([(u % 9 or None, u, float(u % 5 + 1)) for u in range(200)], "pro_ids int, uid int, lipies double")
    wide = FA.rating_pivot(r, 16)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.index("Aggregate") < plan.index("RepartitionByExpression")
    sums = {x.pro_ids: sum(x[c] for c in wide.columns[1:]) for x in wide.collect()}
    assert sums == {x.pro_ids: x.s for x in r.groupBy("pro_ids").agg(F.sum("lipies").alias("s")).collect()}


def test_cosine_scores_shuffle_few_pairs_of_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(3)]) for i in range(1300)]
    unit = spark.createDataFrame(rows, "pro_ids long, vec array<double>")
    met, scored = [], FA._scored
    monkeypatch.setattr(FA, "_scored", lambda pairs, *a: met.append(pairs.count()) or scored(pairs, *a))
    got = FA.cosine_scores(unit, unit.where("pro_ids % 20 = 0").select("pro_ids")).collect()
    assert met == [1]
    vec = dict(rows)
    assert len(got) == 65 * 1300 == len({(r.req_id, r.pro_ids) for r in got})
    assert all(abs(r.score - sum(x * y for x, y in zip(vec[r.req_id], vec[r.pro_ids]))) < 1e-12 for r in got)


def test_product_vocabulary_stays_off_the_driver(spark, tmp_path, monkeypatch):
    """Neither the fit nor the search collects the groups; results are those of the definition."""
    rows = [(p % 97, f"n{p}", 1.0 + p % 3, 0.5, 2.0, p % 4 if p % 10 else None, sorted({f"g{p * j % 501}" for j in range(p % 6)})) for p in range(200)]
    feats = spark.createDataFrame(rows, "pro_ids int, names string, ratings double, repurchases double, pkg_quals double, prices int, groups array<string>")
    feats = feats.withColumn("n_groups", F.size("groups"))
    collect, most = type(feats).collect, []
    monkeypatch.setattr(type(feats), "collect", lambda df: most.append(len(r := collect(df))) or r)
    IO.save_artifacts(spark, str(tmp_path), {}, {"m": TR.fit_product_vectors(feats)})
    vectors = IO.load_artifacts(spark, str(tmp_path))["m"].transform(feats)
    near = TR.similar_products_approx(feats, feats.where("pro_ids % 20 = 0").select(F.col("pro_ids").alias("req_id"), "pro_ids").distinct(), 3)
    assert max(most, default=0) <= 8
    monkeypatch.undo()
    groups = sorted({g for r in rows for g in r[6]})
    want = sorted((r[0], groups.index(g), 1.0) for r in rows for g in r[6])
    want += [(r[0], len(groups) + j, float(r[2 + j])) for r in rows for j in range(4) if r[2 + j]]
    got = TR.long_form(vectors, "pro_ids").where("value <> 0 and not isnan(value)").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert TR.long_form(vectors, "pro_ids").where("isnan(value)").count() == 20
    plain = {}
    for r in near.collect():
        plain.setdefault(r.req_id, []).append(r.dist2)
    sound = [r for r in rows if r[5] is not None]
    for q, found in plain.items():
        far = sorted(min(len(set(a[6]) ^ set(b[6])) + sum((x - y) ** 2 for x, y in zip(a[2:6], b[2:6])) for a in sound if a[0] == q)
                     for b in sound if b[0] != q)
        assert len(found) == 3 and max(found) >= far[0]


def test_best_rows_of_a_query_are_merged_without_sorting_all():
    rnd = np.random.default_rng(3)
    score, ids = np.round(rnd.normal(size=(7, 90)), 1), rnd.permutation(90)
    score[2, :] = -np.inf
    score[3, 5:] = -np.inf
    got, sorted_rows, lexsort = None, [], np.lexsort
    np.lexsort = lambda keys, **how: sorted_rows.append(len(keys[0])) or lexsort(keys, **how)
    try:
        for a, z in ((0, 4), (4, 40), (40, 41), (41, 90)):
            got = FA._best(score[:, a:z], ids[a:z], 6, *(got or ()))
    finally:
        np.lexsort = lexsort
    assert sum(sorted_rows) < score.size
    for r in range(7):
        want = sorted((-s, i) for s, i in zip(score[r], ids) if s > -np.inf)[:6]
        assert [(-s, i) for s, i in zip(got[0][r], got[1][r]) if s > -np.inf] == want


def test_als_grid_keeps_the_shuffles_of_few_iterations(spark, sf, monkeypatch):
    """Ratings are made once, and each fit checkpoints often; the error is that of a plain fit."""
    seen, fit = [], type(CO.als_estimator()).fit
    ratings = RG._ratings_for_als
    monkeypatch.setattr(RG, "_ratings_for_als", lambda *a: ratings(*a).withColumn("lipies", F.udf(lambda x: made_once.add(1) or x, "double")("lipies")))
    made_once = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(CO, "als_grid", lambda als: [{als.rank: 2, als.regParam: p} for p in (0.1, 0.2)])
    monkeypatch.setattr(type(CO.als_estimator()), "fit", lambda als, r, pm: seen.append(als.getCheckpointInterval()) or fit(als, r, pm))
    got = RG.QUERIES["als_grid"](spark, sf).collect()
    monkeypatch.undo()
    r = RG._ratings_for_als(spark, sf).checkpoint()
    assert seen == [CO.KEPT_ITERATIONS] * 2 and made_once.value == r.count()
    for x in got:
        model = CO.als_estimator().setRank(2).setRegParam(x.reg_param).fit(r)
        assert abs(CO.rmse_evaluator().evaluate(model.transform(r)) - x.train_rmse) < 1e-4


def test_component_of_a_million_edges_needs_no_rounds_of_shuffles(spark, monkeypatch):
    """It runs in one task; Spark rows are for larger ones only."""
    def rows(*a, **k):
        raise AssertionError("rounds of Spark rows")

    monkeypatch.setattr(AF, "affinity_propagation", rows)
    n = 1050
    edges = spark.range(n).withColumnRenamed("id", "i").crossJoin(spark.range(n).withColumnRenamed("id", "k")).where("i <> k")
    edges = edges.withColumn("s", -(F.abs(F.col("i") - F.col("k")) % 7 + 1).cast("double"))
    got = AF.affinity_groups(edges, spark.range(n + 1).withColumnRenamed("id", "i"), max_iter=10)
    out = {r.i: r for r in got.collect()}
    assert len(out) == n + 1 and out[0].iterations == 10 and out[n].iterations == 0 and out[n].exemplar == n


def test_fits_of_all_folds_are_one_queue(spark, monkeypatch):
    """Longest first, with the folds and metrics of Spark's own validator."""
    rnd = random.Random(7)
    rows = [(rnd.randrange(30), rnd.randrange(20), float(rnd.randrange(1, 6))) for _ in range(400)]
    ratings = spark.createDataFrame(rows, "uid int, pro_ids int, lipies double").coalesce(1)
    als = CO.als_estimator(max_iter=2, blocks=2)
    want = CrossValidator(estimator=als, estimatorParamMaps=CO.als_grid(als, [2, 4], [.1, .2]), evaluator=CO.rmse_evaluator(),
                          numFolds=3, seed=42).fit(ratings)
    ranks, fit = [], ALS._fit
    monkeypatch.setattr(ALS, "_fit", lambda self, df: ranks.append(self.getRank()) or fit(self, df))
    got = CO.als_cross_validate(ratings, folds=3, parallelism=1, ranks=[2, 4], regs=[.1, .2], max_iter=2, blocks=2)
    assert ranks == 6 * [4] + 6 * [2] + [got.bestModel.rank]
    assert np.allclose(got.avgMetrics, want.avgMetrics, rtol=1e-6) and np.allclose(got.stdMetrics, want.stdMetrics, rtol=1e-4, atol=1e-6)
    assert got.bestModel.rank == want.bestModel.rank
