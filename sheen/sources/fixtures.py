"""Fixture views over the driver's tables (see FIXTURES.md).

Each view exists twice: as a DataFrame plan (what queries run) and as SQL CTE text
(what the DuckDB oracle runs). The two are written independently; the oracle
comparison checks they agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheen.functions.constants import TRAIT_DOMAINS, TRAITS
from sheen.session import table

TRAIT_PRIMES = [3, 5, 7, 11, 13, 17, 19, 23]


# ----------------------------------------------------------------------------- DataFrames

def ratings_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid INT, pro_ids INT, lipies DOUBLE): one rating per line item."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("pro_ids"),
        ((F.col("l_quantity").cast("int") % 5) + 1).cast("double").alias("lipies"),
    )


def catalog_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalog: 8 content columns, ingredients null where no document."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return p.join(d, p.p_partkey == d.doc_id, "left").select(
        F.col("p_partkey").cast("int").alias("pro_ids"),
        F.col("p_name").alias("names"),
        F.col("p_brand").alias("brands"),
        (F.lit(1) + (F.col("p_size") % 41) / F.lit(10.0)).alias("ratings"),
        (F.col("p_size") / F.lit(100.0)).alias("repurchases"),
        (F.lit(1) + F.col("p_size") % 5).cast("double").alias("pkg_quals"),
        (F.lit(1) + (F.col("p_partkey") % 5).cast("int")).alias("prices"),
        F.col("text").alias("ingredients"),
    )


def ingredient_texts_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pro_ids, ingredients) straight from the documents."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("pro_ids"),
                                                    F.col("text").alias("ingredients"))


def products_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("pro_ids"))


def _trait_value(key: str, trait: str, j: int, nation: str = "c_nationkey", missing: int | None = None) -> F.Column:
    """``missing``: the place in the domain that a null nation stands for."""
    dom = TRAIT_DOMAINS[trait]
    at = (((F.col(key) * TRAIT_PRIMES[j] + F.col(nation)) % len(dom)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in dom]), at if missing is None else F.coalesce(at, F.lit(missing)))


def traits_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid INT, 8 trait strings): one trait row per customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.select(
        F.col("c_custkey").cast("int").alias("uid"),
        *[_trait_value("c_custkey", t, j).alias(t) for j, t in enumerate(TRAITS)],
    )


def products_raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product's columns of ``reviews_raw_fx``, a row per part and catalog row."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    cat = catalog_fx(spark, sf_dir)
    return p.join(cat, F.col("p_partkey").cast("int") == cat.pro_ids).select(
        F.col("pro_ids").cast("string").alias("pro_ids"),
        "names",
        F.col("ratings").cast("string").alias("ratings"),
        F.concat(F.col("p_size").cast("string"), F.lit("% would repurchase")).alias("repurchases"),
        F.concat(F.lit("Package Quality: "), F.col("pkg_quals").cast("string")).alias("pkg_quals"),
        F.concat(F.lit("Price: "), F.repeat(F.lit("$"), F.col("prices"))).alias("prices"),
        F.coalesce(F.col("ingredients"), F.lit("")).alias("ingredients"),
        "brands",
        F.split_part(F.col("brands"), F.lit("#"), F.lit(2)).alias("brand_ids"),
        (F.lit(701) + F.col("pro_ids") % 9).cast("string").alias("cat_id"),
    )


def page_products_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of ``products_raw_fx`` for each product, made where its pages are: texts are moved once, to
    the text of their product's id, instead of to the catalog and then to the pages."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").cast("string").alias("pro_ids"), "p_name", "p_brand", "p_size",
                                            F.col("p_partkey").cast("int").alias("_key")).where("_key is not null")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pro_ids"), "text").where("pro_ids is not null")
    rows = p.dropDuplicates(["pro_ids"]).join(d.repartition("pro_ids").dropDuplicates(["pro_ids"]), "pro_ids", "left")
    return rows.select(
        "pro_ids",
        F.col("p_name").alias("names"),
        (F.lit(1) + (F.col("p_size") % 41) / F.lit(10.0)).cast("string").alias("ratings"),
        F.concat(F.col("p_size").cast("string"), F.lit("% would repurchase")).alias("repurchases"),
        F.concat(F.lit("Package Quality: "), (F.lit(1) + F.col("p_size") % 5).cast("double").cast("string")).alias("pkg_quals"),
        F.concat(F.lit("Price: "), F.repeat(F.lit("$"), F.lit(1) + (F.col("_key") % 5).cast("int"))).alias("prices"),
        F.coalesce("text", F.lit("")).alias("ingredients"),
        F.col("p_brand").alias("brands"),
        F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).alias("brand_ids"),
        (F.lit(701) + F.col("_key") % 9).cast("string").alias("cat_id"),
    )


def reviews_raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows with typed values turned back into the page's source strings.

    Orders meet their customer first, which are fewer rows than line items. Line items are shuffled
    with numbers and the customer's name only: products come last, by the
    text of their id (so that later steps by ``pro_ids`` need no shuffle), and the strings
    are made after all joins."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").cast("string").alias("_pro"), "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    tr = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("uid"),
                                                 F.col("c_nationkey").alias("_nation"))
    users = c.join(tr, F.col("c_custkey").cast("int") == tr.uid).select("c_custkey", "c_name", "_nation")
    prod = products_raw_fx(spark, sf_dir)
    tab, nl = F.lit("\t"), F.lit("\n")
    placed = o.join(users, o.o_custkey == users.c_custkey).select("o_orderkey", "o_orderdate", "c_custkey", "c_name", "_nation")
    rows = (li.join(placed, li.l_orderkey == placed.o_orderkey)
            .join(prod, F.col("_pro") == prod.pro_ids))
    # Spark takes element_at of an array without nulls for never null: a null place reads as -1, the last
    t = {x: _trait_value("c_custkey", x, j, "_nation", -1) for j, x in enumerate(TRAITS)}
    return rows.select(
        "pro_ids", "names", "ratings", "repurchases", "pkg_quals", "prices", "ingredients", "brands", "brand_ids",
        F.concat(tab, F.col("c_name"), tab).alias("users"),
        F.concat(F.lit("Age: "), t["age"], tab,
                 F.lit("Skin: "), F.concat_ws(", ", t["skin_type"], t["skin_tone"], t["skin_undertone"]), tab,
                 F.lit("Hair: "), F.concat_ws(", ", t["hair_color"], t["hair_type"], t["hair_texture"]), tab,
                 F.lit("Eyes: "), t["eyes"]).alias("chars"),
        F.concat(nl, F.lit("  "), F.col("names"), F.lit(" used by "), F.col("c_name"), F.lit("  "),
                 nl).alias("reviews"),
        F.concat(F.lit("l-"), ((F.col("l_quantity").cast("int") % 5) + 1).cast("string"),
                 F.lit("-0")).alias("lipies"),
        F.concat(tab, F.lit("on "), F.date_format("o_orderdate", "M/d/yyyy"), tab).alias("dates"),
        "cat_id",
    )


def recs_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the ALS output: each user's ten products by summed rating."""
    r = ratings_fx(spark, sf_dir).groupBy("uid", "pro_ids").agg(F.sum("lipies").alias("s"))
    w = Window.partitionBy("uid").orderBy(F.desc("s"), "pro_ids")
    top = r.withColumn("rn", F.row_number().over(w)).where("rn <= 10")
    wide = top.groupBy("uid").agg(
        *[F.max(F.when(F.col("rn") == i, F.col("pro_ids"))).cast("string").alias(f"rec{i}")
          for i in range(1, 11)])  # max over the int id: a hash aggregate, cast afterwards
    return wide


def requests_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recommendation request (traits + favourite product name) per customer, so the
    batch grows with the data. A customer without a product of the same number asks for
    an unknown one."""
    tr = traits_fx(spark, sf_dir)
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("pk"), F.col("p_name"))
    req = tr.join(part, tr.uid == part.pk, "left")
    keep = (F.col("uid") % 5) != 0
    return req.select(
        F.col("uid").alias("req_id"),
        *[F.when(keep, F.col(t)).alias(t) for t in TRAITS],
        F.when(F.col("uid") == 19, F.lit("no such product")).otherwise(F.col("p_name"))
        .alias("product_name"),
    )


# ----------------------------------------------------------------------------- SQL text

def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_trait(trait: str, j: int) -> str:
    dom = TRAIT_DOMAINS[trait]
    return (f"{_sql_list(dom)}[CAST((c_custkey * {TRAIT_PRIMES[j]} + c_nationkey) % {len(dom)} AS INTEGER) + 1]"
            f" AS {trait}")


FX_SQL: dict[str, str] = {
    "ratings_fx": """ratings_fx AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS pro_ids,
         CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS DOUBLE) AS lipies
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "catalog_fx": """catalog_fx AS (
  SELECT CAST(p_partkey AS INTEGER) AS pro_ids, p_name AS names, p_brand AS brands,
         1 + (p_size % 41) / CAST(10 AS DOUBLE) AS ratings,
         p_size / CAST(100 AS DOUBLE) AS repurchases,
         CAST(1 + p_size % 5 AS DOUBLE) AS pkg_quals,
         1 + CAST(p_partkey % 5 AS INTEGER) AS prices,
         text AS ingredients
  FROM part LEFT JOIN documents ON p_partkey = doc_id)""",
    "traits_fx": "traits_fx AS (\n  SELECT CAST(c_custkey AS INTEGER) AS uid,\n    "
                 + ",\n    ".join(_sql_trait(t, j) for j, t in enumerate(TRAITS))
                 + "\n  FROM customer)",
    "reviews_raw_fx": """reviews_raw_fx AS (
  SELECT CAST(cf.pro_ids AS VARCHAR) AS pro_ids, cf.names,
         CAST(cf.ratings AS VARCHAR) AS ratings,
         CAST(p_size AS VARCHAR) || '% would repurchase' AS repurchases,
         'Package Quality: ' || CAST(cf.pkg_quals AS VARCHAR) AS pkg_quals,
         'Price: ' || repeat('$', cf.prices) AS prices,
         coalesce(cf.ingredients, '') AS ingredients,
         cf.brands, split_part(cf.brands, '#', 2) AS brand_ids,
         chr(9) || c_name || chr(9) AS users,
         'Age: ' || t.age || chr(9) || 'Skin: ' || t.skin_type || ', ' || t.skin_tone || ', '
           || t.skin_undertone || chr(9) || 'Hair: ' || t.hair_color || ', ' || t.hair_type
           || ', ' || t.hair_texture || chr(9) || 'Eyes: ' || t.eyes AS chars,
         chr(10) || '  ' || cf.names || ' used by ' || c_name || '  ' || chr(10) AS reviews,
         'l-' || CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS VARCHAR) || '-0' AS lipies,
         chr(9) || 'on ' || strftime(o_orderdate, '%-m/%-d/%Y') || chr(9) AS dates,
         CAST(701 + cf.pro_ids % 9 AS VARCHAR) AS cat_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey
       JOIN catalog_fx cf ON CAST(l_partkey AS INTEGER) = cf.pro_ids
       JOIN traits_fx t ON CAST(c_custkey AS INTEGER) = t.uid)""",
    "recs_fx": "recs_fx AS (\n  SELECT uid, "
               + ", ".join(f"max(CASE WHEN rn = {i} THEN CAST(pro_ids AS VARCHAR) END) AS rec{i}"
                           for i in range(1, 11))
               + """
  FROM (SELECT uid, pro_ids, row_number() OVER (PARTITION BY uid ORDER BY s DESC, pro_ids) AS rn
        FROM (SELECT uid, pro_ids, sum(lipies) AS s FROM ratings_fx GROUP BY uid, pro_ids))
  WHERE rn <= 10 GROUP BY uid)""",
    "requests_fx": "requests_fx AS (\n  SELECT t.uid AS req_id, "
                   + ", ".join(f"CASE WHEN t.uid % 5 <> 0 THEN t.{c} END AS {c}" for c in TRAITS)
                   + """,
         CASE WHEN t.uid = 19 THEN 'no such product' ELSE p_name END AS product_name
  FROM traits_fx t LEFT JOIN part ON t.uid = CAST(p_partkey AS INTEGER))""",
}

FX_DEPS = {
    "ratings_fx": [], "catalog_fx": [], "traits_fx": [],
    "reviews_raw_fx": ["catalog_fx", "traits_fx"],
    "recs_fx": ["ratings_fx"], "requests_fx": ["traits_fx"],
}


def with_fx(names: list[str], extra_ctes: list[str] | None = None) -> str:
    """``WITH`` clause holding the named fixture views (and their dependencies)
    followed by any extra CTE texts."""
    ordered: list[str] = []

    def add(n):
        for d in FX_DEPS[n]:
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [FX_SQL[n] for n in ordered] + list(extra_ctes or [])
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
