"""Findings of round 4: the whole of a method, and work that stays bounded as tables grow."""

import threading
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from sheen.operators import collab as CO
from sheen.operators import factors as FA
from sheen.operators import ingredients as I
from sheen.operators import pages as PG
from sheen.plans import registry as RG
from sheen.sources import fixtures as FX
from sheen.sources import io as IO


def test_pivot_has_a_column_for_each_user_and_means(spark):
    rows = [(1, 7, 2.0), (1, 7, 5.0), (1, 71, 1.0), (2, 71, 4.0), (2, None, 3.0), (3, 7, None), (None, 90, 5.0)]
    wide = FA.rating_pivot(spark.createDataFrame(rows, "pro_ids int, uid int, lipies double"))
    got = {x.pro_ids: (x.n_users, list(x.users), list(x.means)) for x in wide.collect()}
    # users 7 and 71 are columns of their own, though equal modulo 64; a user's ratings of a product are averaged
    assert got == {1: (3, [7, 71], [3.5, 1.0]), 2: (3, [71], [4.0]), 3: (3, [], []), None: (3, [90], [5.0])}
    cells = wide.select("pro_ids", *[FA.pivot_cell(F.lit(u)).alias(f"u{u}") for u in (7, 71, 90)]).collect()
    assert {x.pro_ids: tuple(x)[1:] for x in cells} == {1: (3.5, 1.0, 0.0), 2: (0.0, 4.0, 0.0), 3: (0.0, 0.0, 0.0), None: (0.0, 0.0, 5.0)}


def test_pages_are_parsed_in_bounded_slices(spark, monkeypatch):
    html = pa.array(["x" * 10, None, "y" * 600, "z" * 2000, "", "u" * 500, "v" * 500])
    monkeypatch.setattr(PG, "PARSE_BYTES", 1000)
    assert list(PG._slices(html)) == [(0, 3), (3, 1), (4, 3)]
    assert list(PG._slices(html.slice(3))) == [(0, 1), (1, 3)]
    assert list(PG._slices(pa.array([], pa.string()))) == []
    # each slice leaves as a batch of its own, and nothing is lost
    pages = spark.createDataFrame([(i, f"<h1>a</h1><h1>{'b' * 300}{i}</h1>") for i in range(40)], "page_id long, html string").coalesce(1)
    part = PG.parse_pages(pages, keep=False)
    assert part.columns == ["page_id", "parsed"]
    assert sorted((r.page_id, r.names) for r in part.select("page_id", "parsed.names").collect()) == [(i, "b" * 300 + str(i)) for i in range(40)]


def test_rendered_pages_read_line_items_and_texts_once(spark, sf):
    """Rows of reviews and texts of documents pass one shuffle for a purpose, not one for each use."""
    pages = RG.rendered_pages_fx(spark, sf)
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and sum("Relation" in x and "l_orderkey" in x for x in plan.splitlines()) == 1
    products = FX.page_products_fx(spark, sf)
    texts = [x for x in products._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in x]
    assert len(texts) == 1
    cols = ["pro_ids", *PG.PRODUCT]
    assert products.select(cols).exceptAll(FX.products_raw_fx(spark, sf).select(cols)).isEmpty()
    assert products.count() == FX.products_raw_fx(spark, sf).count()


def test_groups_without_exemplars_move_the_vocabulary_once(spark):
    vocab = spark.createDataFrame([("retinol",), ("retinal",), ("zinc",), (None,)], "token string")
    groups = I.stand_in_groups(vocab)
    assert sorted(map(tuple, groups.select("token", "group", "exemplar").collect())) == [
        ("retinal", "rtnl", "retinal"), ("retinol", "rtnl", "retinal"), ("zinc", "znc", "zinc")]
    plan = groups.select("token", "group")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_kept_rows_are_compressed_and_go(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.array(F.lit("a long name of a group"), F.lit(None).cast("string")).alias("groups"))
    out = IO.kept(rows, "test-kept")
    assert out.schema["groups"].dataType.elementType.typeName() == "string"
    assert out.count() == 20_000 and out.exceptAll(rows).isEmpty()
    folder = out.inputFiles()[0].rsplit("/", 1)[0]
    fs, path = IO._fs(spark, folder)
    assert fs.getContentSummary(path).getLength() < 20_000 * 22
    IO.drop_kept(out)
    assert not fs.exists(path)


def test_grid_fits_run_at_a_time_and_keep_their_order(spark, monkeypatch):
    together, begun = threading.Barrier(2), []

    def fit(ratings, pm):
        begun.append(pm["rank"])
        together.wait(60)  # breaks if one fit waits for the other
        return SimpleNamespace(transform=lambda r: pm["rank"] + pm["reg"])

    als = SimpleNamespace(rank="rank", getRank=lambda: 10, fit=fit)
    monkeypatch.setattr(CO, "rmse_evaluator", lambda: SimpleNamespace(evaluate=lambda x: x))
    grid = [{"rank": r, "reg": p} for r in (10, 50) for p in (.25, .5)]
    assert CO.grid_rmse(als, spark.range(1), grid) == [10.25, 10.5, 50.25, 50.5]
    assert begun[:2] == [50, 50]


def test_blocks_of_a_fit_follow_the_ratings(spark, sf, monkeypatch):
    assert CO.BLOCKS == ALS().getNumUserBlocks() == CO.als_fit_blocks(0) == CO.als_fit_blocks(36_000_000)
    assert CO.als_fit_blocks(216_000_000) == 54
    seen, fit = [], CO.als_fit
    monkeypatch.setattr(CO, "FULL_BLOCK", 500)
    monkeypatch.setattr(CO, "als_fit", lambda r, **kw: seen.append(kw["blocks"]) or fit(r, max_iter=1, **kw))
    n = RG.QUERIES["als_fit"](spark, sf).count()
    assert n == RG._ratings_for_als(spark, sf).count() and seen == [-(-n // 500)] and n > 5000


def test_gram_needs_no_shuffle(spark, monkeypatch):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, f array<double>").repartition(4)
    empty = df.where("id < 0")
    monkeypatch.setattr(type(df), "groupBy", lambda *a: 1 / 0)
    f = np.array([x for _, x in rows])
    assert np.allclose(FA._gram(df, 2), f.T @ f)
    assert (FA._gram(empty, 2) == np.zeros((2, 2))).all()
