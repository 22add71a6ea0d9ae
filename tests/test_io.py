"""Sources and sinks round trips (folders under the test's own directory)."""

import pytest
from pyspark.sql import functions as F

from sheen.sources import io as IO


def test_csv_and_partitioned_round_trip(spark, tmp_path):
    rows = [(i % 7, i, float(i % 5 + 1), str(701 + i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "pro_ids int, uid int, lipies double, cat_id string")
    back = IO.scan_ratings_csv(spark, IO.sink_ratings_csv(df, str(tmp_path / "csv")))
    assert back.schema.simpleString() == "struct<pro_ids:int,uid:int,lipies:double>"
    assert back.exceptAll(df.drop("cat_id")).count() == 0 and back.count() == 200
    path = IO.sink_by_category(df, str(tmp_path / "cats"))
    allcats = IO.load_categories(spark, path)
    assert dict(allcats.dtypes)["cat_id"] == "string" and allcats.count() == 200
    two = IO.load_categories(spark, path, ["701", "702"])
    assert two.select("cat_id").distinct().count() == 2
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cat_id" in plan and "IN (701,702)" in plan
    assert two.count() == df.where(F.col("cat_id").isin("701", "702")).count()


def test_artifacts_round_trip(spark, tmp_path):
    """Tables and the ALS model go out and come back; a half-written set is not loaded."""
    from sheen.operators import collab as CO
    ratings = spark.createDataFrame([(u, p, float((u * p) % 5 + 1)) for u in range(12) for p in range(9) if (u + p) % 3],
                                    "uid int, pro_ids int, lipies double")
    model = CO.als_fit(ratings, rank=3, reg=0.1, max_iter=3, blocks=2)
    labels = spark.createDataFrame([("a", "b"), ("b", "b"), (None, None)], "token string, group string")
    path = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        IO.load_artifacts(spark, path)
    IO.save_artifacts(spark, path, {"labels": labels, "empty": labels.limit(0)}, {"als": model}, {"why": "test"})
    got = IO.load_artifacts(spark, path)
    assert got["labels"].exceptAll(labels).count() == 0 and got["labels"].count() == 3 and got["empty"].count() == 0
    assert got["empty"].schema == labels.schema and IO.latest_manifest(spark, path)["about"] == {"why": "test"}
    want = {r.uid: [x.pro_ids for x in r.recommendations] for r in CO.als_top_n(model, 4).collect()}
    assert {r.uid: [x.pro_ids for x in r.recommendations] for r in CO.als_top_n(got["als"], 4).collect()} == want
    assert list(IO.load_artifacts(spark, path, ["empty"])) == ["empty"]
    with pytest.raises(KeyError):
        IO.load_artifacts(spark, path, ["nothing"])

    class Broken:
        def write(self):
            raise OSError("lost")

    with pytest.raises(OSError):
        IO.save_artifacts(spark, path, {"labels": labels.limit(1)}, {"als": Broken()})
    assert IO.load_artifacts(spark, path)["labels"].count() == 3     # still the complete version
    IO.save_artifacts(spark, path, {"labels": labels.limit(1)})
    assert IO.load_artifacts(spark, path)["labels"].count() == 1 and set(IO.load_artifacts(spark, path)) == {"labels"}


def test_fitted_once_for_an_input(spark, tmp_path):
    src = str(tmp_path)
    spark.range(5).write.parquet(f"{src}/orders.parquet")
    calls = []

    def fit():
        calls.append(1)
        return {"t": spark.range(len(calls))}, {}

    for _ in range(3):
        assert IO.fitted(spark, src, "kind", ["orders"], fit)["t"].count() == 1
    spark.range(6).write.mode("append").parquet(f"{src}/orders.parquet")
    assert IO.fitted(spark, src, "kind", ["orders"], fit)["t"].count() == 2 and len(calls) == 2


def test_recommend_serves_saved_models(spark, sf):
    """The registered query equals the request chain over the artifacts that it loads."""
    from sheen.operators import serve as S
    from sheen.plans import registry as R
    from sheen.sources import fixtures as FX
    got = R.QUERIES["recommend"](spark, sf).collect()
    tables, _ = R.all_artifacts(spark, sf)
    want = S.recommend(FX.requests_fx(spark, sf), tables["traits"], tables["recs"], tables["catalog"], tables["features"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and got
    per = {}
    for r in got:
        per.setdefault(r.req_id, []).append(r.pick)
    assert all(sorted(p) == list(range(1, len(p) + 1)) and len(p) <= 10 for p in per.values())
    assert set(per) == {r.req_id for r in FX.requests_fx(spark, sf).where("product_name is not null").collect()}
    counts = {r.artifact: r.n_rows for r in R.QUERIES["save_artifacts"](spark, sf).collect()}
    assert counts["labels"] == counts["exemplar_members"] == tables["labels"].count() > 0


def test_spread_files(spark, tmp_path):
    """A file that one task reads is copied into several; the rows stay the same."""
    src = str(tmp_path / "one")
    spark.range(1000).coalesce(1).write.parquet(src)
    df = spark.read.parquet(src)
    got = IO.spread_files(df, str(tmp_path / "copy"))
    assert got.rdd.getNumPartitions() > df.rdd.getNumPartitions() and got.exceptAll(df).count() == 0 and got.count() == 1000
    assert IO.spread_files(df, str(tmp_path / "copy")).count() == 1000
    wide = spark.range(1000).repartition(64)
    assert IO.spread_files(wide, str(tmp_path / "none")) is wide
    assert IO.spread_files(df.limit(0), str(tmp_path / "empty")).count() == 0
