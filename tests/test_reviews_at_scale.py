"""What grows with the reviews: texts are no part of them, and a row's strings are parsed once."""

import random

from pyspark.sql import functions as F

from sheen.functions import markup as M
from sheen.functions import parse as P
from sheen.functions import text as T
from sheen.operators import clean as C
from sheen.operators import pages as PG

RAW = ["pro_ids", *PG.PRODUCT, "users", "chars", "reviews", "lipies", "dates"]


def raw_reviews(spark, n=60):
    rows = [(str(i % 3), f"n{i % 3}", "4.1", "85% would repurchase", "Package Quality: 4.0", "Price: $$", f"water & {i % 3}",
             "Brand#1", "1", "701", f"\tu{i}\t", "Age: 19-24\tSkin: Dry, Fair, Cool\tHair: Red, Wavy, Fine\tEyes: Blue",
             f"\n  good <b> {i} \n", "l-4-0", "\ton 1/7/2019\t") for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW))


def test_pages_take_the_text_of_their_product(spark):
    raw = raw_reviews(spark)
    products = raw.select("pro_ids", *PG.PRODUCT).distinct().withColumn("ingredients", F.concat(F.lit("new "), F.col("ingredients")))
    pages = PG.render_review_pages(raw.withColumn("ingredients", F.lit("carried")), products=products)
    rows, rejected = PG.extract_reviews(pages)
    assert rejected.count() == 0 and rows.count() == 60
    assert {(r.pro_ids, r.ingredients) for r in rows.collect()} == {(str(i), f"new water & {i}") for i in range(3)}
    assert PG.extract_reviews(PG.render_review_pages(raw))[0].count() == 60


def test_characteristics_are_split_once(spark):
    plan = C.clean_reviews(raw_reviews(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\\bAge:") == 1


def test_split_patterns_cut_the_same(spark):
    rnd = random.Random(5)
    bits = [",", "and", "active ", "ingredients", "ingredient", " ", "  ", "\t", "\n", "\x07", "-", "_", " - ", "step 1", "others", "other ",
            "inactive ", "previous ", ".", "*", "[]", "[", "]", ":", "/", ";", "a", "B", "\x85", "　", "Age: ", "Skin:\t", "Hair: x", "Eyes: b"]
    rows = [("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))),) for _ in range(3000)] + [(None,)]
    df = spark.createDataFrame(rows, "t string")
    assert T.FAST_SPLIT_RE != T.INGREDIENT_SPLIT_RE
    assert df.where(~F.split(F.lower("t"), T.INGREDIENT_SPLIT_RE, -1).eqNullSafe(T.split_ingredients(F.col("t")))).count() == 0
    traits = F.filter(F.split(F.col("t"), P.TRAIT_SPLIT_RE, -1), lambda x: x != "")
    assert df.where(~traits.eqNullSafe(P.split_traits(F.col("t")))).count() == 0
    assert df.where(~F.regexp_replace("t", T.STRIP_RE, "").eqNullSafe(T.ustrip(F.col("t")))).count() == 0


def test_plain_pages_read_as_by_the_parser(spark, monkeypatch):
    rnd = random.Random(7)
    pages = [r.html for r in PG.render_review_pages(raw_reviews(spark)).collect()]
    odd = ["<", "</p>", ">", "&amp;", "&", "<title>", "</title>", "<br>", "<br/>", '"', '<P CLASS="x">', "<!-- c -->", "<script>", "</span >"]
    for h in list(pages):
        for _ in range(40):
            at = rnd.randrange(len(h))
            pages.append(h[:at] + rnd.choice(odd) + h[at + rnd.randint(0, 3):])
    assert all(M.ReviewPage().feed_plain(h) for h in pages[:3])
    got = [M.page_fields(h) for h in pages]
    monkeypatch.setattr(M.ReviewPage, "feed_plain", lambda self, html: False)
    assert got == [M.page_fields(h) for h in pages]


def test_customers_without_a_nation_have_the_last_characteristics(spark, tmp_path):
    from sheen.plans import registry as RG
    tables = {
        "lineitem": ([(1, 1, 3.0), (2, 1, 4.0)], "l_orderkey long, l_partkey long, l_quantity double"),
        "orders": ([(1, 1, "1996-01-02"), (2, 2, "1996-01-03")], "o_orderkey long, o_custkey long, o_orderdate string"),
        "customer": ([(1, "Customer 1", None), (2, "Customer 2", 3)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "rose", "Brand#1", 7)], "p_partkey long, p_name string, p_brand string, p_size int"),
        "documents": ([(1, "water, oil")], "doc_id long, text string")}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.to_date("o_orderdate"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {r.users: r for r in RG.QUERIES["clean_reviews"](spark, str(tmp_path)).collect()}
    assert (got["Customer 1"].age, got["Customer 1"].eyes, got["Customer 1"].hair_texture) == ("Unknown", "Violet", "Other")
    assert got["Customer 2"].age == "19-24"
    assert {r.ingredients for r in RG.clean_fx(spark, str(tmp_path)).collect()} == {"water, oil"}
