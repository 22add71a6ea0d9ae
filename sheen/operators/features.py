"""Product and user features, and exact nearest neighbours for request batches (§2.6).

Distances use identities instead of dense vectors:

* products: ``d^2 = |A| + |B| - 2|A and B| + sum of squared numeric differences``
  over multi-hot group sets A, B and the four unscaled numeric columns;
* users: ``d^2 = set(request) + set(row) - 2 * matches`` over the 8 one-hot traits.

Neighbours are exact and come from equi-joins, never from requests x candidates: products
share one of their rare groups or fall back on profiles without a common group, users share
a subset of their traits. Requests for one product or trait profile are answered once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheen.functions.constants import SLOT_OFFSETS, TRAIT_DOMAINS, TRAITS
from sheen.operators.relational import dense_index
from sheen.session import ensure_checkpoint_dir
from sheen.sources.io import kept

NUMERIC = ["ratings", "repurchases", "pkg_quals", "prices"]


# ----------------------------------------------------------------------------- products

def product_features(catalog: DataFrame, product_groups: DataFrame, key: str = "pro_ids"
                     ) -> DataFrame:
    """(key, names, groups sorted array, n_groups, 4 numerics); products without
    ingredients have an empty group set."""
    pg = product_groups.select(key, "groups")
    return (catalog.select(key, "names", *NUMERIC).join(pg, key, "left")
            .withColumn("groups", F.coalesce("groups", F.array().cast("array<string>")))
            .withColumn("n_groups", F.size("groups")))


def multi_hot_groups(product_groups: DataFrame, key: str = "pro_ids") -> DataFrame:
    """Long-form 0/1 matrix: (key, group, feature_idx, value); features are the
    groups in sorted order, as a dictionary vectoriser numbers them."""
    long = product_groups.select(key, F.explode("groups").alias("group"))
    names = dense_index(long.select("group").distinct(), "group", "feature_idx")
    return long.join(names, "group").withColumn("value", F.lit(1.0))


def assemble_features(multi_hot: DataFrame, catalog: DataFrame, key: str = "pro_ids"
                      ) -> DataFrame:
    """Append the four numeric columns after the group features (long form)."""
    n_groups = multi_hot.agg(F.max("feature_idx").alias("m")).select(
        F.coalesce(F.col("m") + 1, F.lit(0)).alias("base"))
    num = catalog.select(key, F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.lit(c).alias("group"), F.col(c).cast("double").alias("value"))
        for j, c in enumerate(NUMERIC)])).alias("f")).select(key, "f.*")
    num = num.join(F.broadcast(n_groups), how="cross").select(
        key, "group", (F.col("base") + F.col("j")).alias("feature_idx"), "value")
    return multi_hot.select(key, "group", "feature_idx", "value").unionByName(num)


def feature_by_name(features: DataFrame, requests: DataFrame, name_col: str = "product_name",
                    key: str = "pro_ids") -> DataFrame:
    """Resolve each request's product name to one product: the smallest id among
    products of that name. Unknown names get no row.

    The catalog is first semi-joined with the request names, so the per-name minimum runs
    over the requested names only."""
    names = requests.select(F.col(name_col).alias("names")).where(F.col("names").isNotNull())
    ids = features.join(names, "names", "left_semi").groupBy("names").agg(F.min(key).alias(key))
    return requests.join(ids, requests[name_col] == ids["names"]).select(
        "req_id", F.col(name_col).alias("product_name"), key)


def top_k(scored: DataFrame, k: int, order: list, part: str = "req_id") -> DataFrame:
    """Rows 1..k per ``part`` by a total order; Spark inserts a partial
    WindowGroupLimit before the shuffle, so each task sends at most k rows per key."""
    w = Window.partitionBy(part).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def product_distance(inter, q: str = "q_") -> F.Column:
    d2 = (F.col(f"{q}n_groups") + F.col("n_groups") - 2 * inter).cast("double")
    for col in NUMERIC:
        diff = F.col(f"{q}{col}").cast("double") - F.col(col).cast("double")
        d2 = d2 + diff * diff
    return d2


#: Halvings of the widest extent that the grid's cells are measured in.
LEVELS = 12


def grid_nearest(points: DataFrame, queries: DataFrame, k: int, dims: list[str], id_col: str) -> DataFrame:
    """(q, id_col, cost): for each query the ``k`` points with the smallest squared Euclidean
    distance over ``dims``, ties to the smaller id, and every point that ties with the last.

    ``points``: (id_col, dims); ``queries``: (q, dims). Exact, by grids of cells whose width
    doubles from level to level. A query first takes the finest level at which the cells nearest
    to it (two along each dimension) hold k points, which bounds its k-th distance. All points within that
    distance lie in the cells, two along each dimension again, of a level at least twice as wide. Rows with a
    null coordinate are in no cell.
    """
    box = points.select(*dims).unionByName(queries.select(*dims)).agg(
        *[f(c).alias(f"{n}{j}") for j, c in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    low = [float(box[f"lo{j}"] or 0.0) for j in range(len(dims))]
    extent = max([float(box[f"hi{j}"] or 0.0) - low[j] for j in range(len(dims))] + [1e-9]) * 1.001
    width = F.lit(extent) / F.pow(F.lit(2.0), LEVELS - F.col("level"))  # the widest: one cell holds all points
    sound = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in dims])
    points, queries = points.where(sound), queries.where(sound)

    def cell(j, x):
        return F.floor((x - low[j]) / width)

    cells = (points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .withColumn("h", F.xxhash64("level", *[cell(j, F.col(c)) for j, c in enumerate(dims)])).checkpoint(eager=True))

    def corners(df, reach):
        """Rows of ``df`` with each cell that meets the query's box of ``reach`` on either side."""
        for j, c in enumerate(dims):
            df = df.withColumn(f"c{j}", F.explode(F.array_distinct(F.array(cell(j, F.col(c) - reach), cell(j, F.col(c) + reach)))))
        return df.withColumn("h", F.xxhash64("level", *[f"c{j}" for j in range(len(dims))])).drop(*[f"c{j}" for j in range(len(dims))])

    cost = reduce(lambda x, y: x + y, [(F.col(f"q_{c}") - F.col(c)) * (F.col(f"q_{c}") - F.col(c)) for c in dims])

    def met(asked):
        asked = asked.select("q", "h", "level", *[F.col(c).alias(f"q_{c}") for c in dims], *[c for c in asked.columns if c == "most"])
        return asked.join(cells, ["h", "level"]).withColumn("cost", cost)

    every = queries.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    sizes = cells.groupBy("h", "level").agg(F.count(F.lit(1)).alias("n"))
    fit = (corners(every, width / 2).select("q", "level", "h").join(sizes, ["h", "level"]).groupBy("q", "level").agg(F.sum("n").alias("n"))
           .groupBy("q").agg(F.coalesce(F.min(F.when(F.col("n") >= k, F.col("level"))), F.lit(LEVELS)).alias("level")))
    first = met(corners(queries.join(fit, "q"), width / 2))
    near = top_k(first.select("q", id_col, "cost"), k, [F.col("cost"), F.col(id_col)], "q")
    most = near.groupBy("q").agg(F.max("cost").alias("most"), F.count(F.lit(1)).alias("n")).select(
        "q", F.when(F.col("n") >= k, F.col("most")).alias("most"))  # null: fewer than k points in all
    slightly = lambda c: c * (1 + 1e-9) + 1e-12  # noqa: E731  # more than rounding may add
    reach = slightly(F.sqrt("most"))
    wide = F.least(F.lit(LEVELS), F.greatest(F.lit(0), F.ceil(F.log2(2 * reach / extent) + LEVELS))).cast("int")
    second = queries.join(most, "q").withColumn("level", F.when(F.col("most").isNull(), LEVELS).otherwise(wide))
    # at the widest level all points are in one cell, which half its width reaches
    second = met(corners(second, F.least(F.coalesce(reach, F.lit(extent)), F.lit(extent / 2))))
    second = second.where(F.col("most").isNull() | (F.col("cost") <= slightly(F.col("most")))).select("q", id_col, "cost").checkpoint(eager=True)
    last = top_k(second, k, [F.col("cost"), F.col(id_col)], "q").groupBy("q").agg(F.max("cost").alias("last"))
    return second.join(last, "q").where(F.col("cost") <= slightly(F.col("last"))).drop("last")


def similar_products(features: DataFrame, query_ids: DataFrame, k: int = 10,
                     key: str = "pro_ids") -> DataFrame:
    """The k nearest catalog products of each request's product, itself excluded.

    ``query_ids`` holds (req_id, key). Output (req_id, rank, key, dist2). Ties
    go to the smaller id, and self is excluded by id rather than by position. Products
    with a null numeric column are near none.

    Exact, without comparing every request to every product:

    1. Products collapse to profiles (n_groups, numerics), k + 1 smallest ids each, and requests to
       distinct numerics. As if no group were shared, the distance is Euclidean over the numerics
       and the root of n_groups: ``grid_nearest`` finds each request's k nearest profiles. A product
       that shares no group is among them, or is not among the k nearest at all.
    2. A product that beats these by shared groups shares at least half of its groups
       less the bound's slack, so also one of its rarest ones: an equi-join on the rarer
       half of each product's groups finds it. Its most common groups are never joined on.
    """
    ensure_checkpoint_dir(features.sparkSession)
    cols = ["n_groups", *NUMERIC]
    feats = features.select(key, "groups", *cols)
    wanted = query_ids.select(F.col(key).alias("q_id")).distinct()
    q = (feats.join(wanted, feats[key] == wanted["q_id"])
         .select("q_id", F.col("groups").alias("q_groups"), *[F.col(c).alias(f"q_{c}") for c in cols]))
    q = kept(q, "requested")

    prof = feats.select(key, *cols).withColumn("_r", F.row_number().over(
        Window.partitionBy(*cols).orderBy(key))).where(F.col("_r") <= k + 1).drop("_r").checkpoint(eager=True)
    dims = ["_root", *[f"_{c}" for c in NUMERIC]]
    at = [F.sqrt("n_groups").alias("_root"), *[F.col(c).cast("double").alias(f"_{c}") for c in NUMERIC]]
    points = prof.groupBy(*cols).agg(F.min(key).alias(key)).select(key, *at)
    spots = q.select(F.lit(0.0).alias("_root"), *[F.col(f"q_{c}").cast("double").alias(f"_{c}") for c in NUMERIC]).distinct()
    spots = spots.withColumn("q", F.xxhash64(*dims)).checkpoint(eager=True)  # a name; equal names would only merge two searches
    near = grid_nearest(points, spots, k + 1, dims, key).select("q", F.col(key).alias("_first"))
    same = [prof[c] == F.col(f"_p_{c}") for c in cols]
    first = prof.select(F.col(key).alias("_first"), *[F.col(c).alias(f"_p_{c}") for c in cols])
    held = near.join(first, "_first").join(prof, reduce(lambda x, y: x & y, same)).select("q", key, *cols)
    mine = q.drop("q_groups").withColumn("q", F.xxhash64(F.lit(0.0), *[F.col(f"q_{c}").cast("double") for c in NUMERIC]))
    base = mine.join(held, "q").where(F.col(key) != F.col("q_id")).select(
        "q_id", "q_n_groups", key, product_distance(F.lit(0)).alias("dist2"))
    base = top_k(base, k, [F.col("dist2"), F.col(key)], "q_id").checkpoint(eager=True)
    bound = base.groupBy("q_id", "q_n_groups").agg(F.max("dist2").alias("m"), F.count(F.lit(1)).alias("n"))
    most = bound.agg(F.max(F.col("m") - F.col("q_n_groups")).alias("s"), F.min("n").alias("n")).first()
    top = prof.agg(F.max("n_groups")).first()[0] or 0
    slack = float(top) if most["s"] is None or most["n"] < k else float(most["s"])  # fewer than k products: all may be near
    parts = [base.select("q_id", key, "dist2")]

    long = feats.where(F.col("n_groups") > 0).select(key, "n_groups", F.explode("groups").alias("group"))
    freq = long.groupBy("group").agg(F.count(F.lit(1)).alias("df"))
    need = F.greatest(F.lit(1), F.ceil((F.col("n_groups") - F.lit(slack)) / 2))
    rare = (long.join(freq, "group").withColumn("_r", F.row_number().over(
        Window.partitionBy(key).orderBy("df", "group")))
        .where(F.col("_r") <= F.col("n_groups") - need + 1).select("group", key))
    pairs = (q.select("q_id", F.explode("q_groups").alias("group")).join(rare, "group")
             .where(F.col(key) != F.col("q_id")).select("q_id", key).distinct())
    inter = F.size(F.array_intersect("q_groups", "groups"))
    parts.append(pairs.join(q, "q_id").join(feats, key).select("q_id", key, product_distance(inter).alias("dist2")))

    scored = reduce(DataFrame.unionByName, parts).groupBy("q_id", key).agg(F.min("dist2").alias("dist2"))
    best = top_k(scored, k, [F.col("dist2"), F.col(key)], "q_id")
    return (query_ids.select("req_id", F.col(key).alias("q_id")).join(best, "q_id")
            .select("req_id", key, "dist2", "rank"))


# ----------------------------------------------------------------------------- users

def trait_domains(spark) -> DataFrame:
    """(trait, value, slot): the request form's fixed 56 slots."""
    rows = [(t, v, SLOT_OFFSETS[t] + i) for t in TRAITS for i, v in enumerate(TRAIT_DOMAINS[t])]
    return spark.createDataFrame(rows, "trait string, value string, slot int")


def unpivot_traits(df: DataFrame, id_col: str) -> DataFrame:
    """(id, trait, value) for each non-null trait."""
    return df.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(t).alias("trait"), F.col(t).alias("value")) for t in TRAITS])).alias("x")
    ).select(id_col, "x.trait", "x.value").where(F.col("value").isNotNull())


def one_hot_traits(trait_rows: DataFrame, id_col: str = "uid") -> DataFrame:
    """One-hot of the 8 traits as fitted on the data: categories of each trait in
    sorted order, traits in table order. Long form (id, trait, value, slot).
    """
    long = unpivot_traits(trait_rows, id_col)
    cats = long.select("trait", "value").distinct()
    order = F.create_map(*[x for j, t in enumerate(TRAITS) for x in (F.lit(t), F.lit(j))])
    cats = cats.withColumn("t_ord", order[F.col("trait")])
    per = Window.partitionBy("trait").orderBy("value")
    cats = cats.withColumn("local", F.row_number().over(per) - 1)
    sizes = cats.groupBy("t_ord").agg(F.count(F.lit(1)).alias("n"))
    offs = sizes.select("t_ord", F.coalesce(F.sum("n").over(
        Window.orderBy("t_ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    slots = cats.join(offs, "t_ord").select("trait", "value", (F.col("off") + F.col("local"))
                                             .cast("int").alias("slot"))
    return long.join(slots, ["trait", "value"])


def feature_names(one_hot: DataFrame) -> DataFrame:
    """(slot, name) with names as the encoder prints them: x<trait#>_<value>."""
    order = F.create_map(*[x for j, t in enumerate(TRAITS) for x in (F.lit(t), F.lit(j))])
    return one_hot.select("slot", "trait", "value").distinct().select(
        "slot", F.concat(F.lit("x"), order[F.col("trait")].cast("string"), F.lit("_"),
                         F.col("value")).alias("name"))


def request_vector(requests: DataFrame, domains: DataFrame) -> DataFrame:
    """Long form of each request's 56-slot 0/1 vector: (req_id, slot) per set
    trait; a trait that is unset or not in its domain sets nothing."""
    long = unpivot_traits(requests, "req_id")
    return long.join(F.broadcast(domains), ["trait", "value"]).select("req_id", "trait", "slot")


def _trait_keys(masks: list[int]) -> F.Column:
    """A 64-bit hash of the values of each subset of a row's set traits that ``masks`` names."""
    bit = lambda m, j: F.shiftright(m, j).bitwiseAND(F.lit(1)) == 1
    full = reduce(lambda a, b: a + b, [F.when(F.col(t).isNotNull(), 1 << j).otherwise(0) for j, t in enumerate(TRAITS)])
    named = F.filter(F.array(*[F.lit(m) for m in masks]), lambda m: m.bitwiseAND(full) == m)
    return F.transform(named, lambda m: F.struct(F.bit_count(m).alias("shared"), F.xxhash64(
        m, *[F.when(bit(m, j), F.col(f"h_{t}")).otherwise(F.lit(0)) for j, t in enumerate(TRAITS)]).alias("key")))


def similar_users(trait_rows: DataFrame, requests: DataFrame, k: int = 10, id_col: str = "uid") -> DataFrame:
    """The k nearest trait rows of each request: (req_id, rank, uid, dist2).

    Ties go to the smaller uid. A user whose traits changed has several rows and
    can appear more than once, as in a neighbour search over rows.

    Exact by equi-joins. Rows collapse to trait profiles with their k smallest ids. A profile is
    indexed under each subset of its set traits that some request may share, and each subset
    keeps its k first rows by (traits set, uid). A row that agrees with the request in
    exactly the traits M is under M, and whoever displaces it there is at least as near, so
    the lookups of the request's subsets hold the k nearest. The limits per profile and subset are
    partial before the shuffle: a subset that all rows share sends k rows per task. Subsets
    are compared by 64-bit hashes, and distances are those of the profiles that meet.
    """
    spark = trait_rows.sparkSession
    ensure_checkpoint_dir(spark)
    n_set = reduce(lambda a, b: a + b, [F.when(F.col(t).isNotNull(), 1).otherwise(0) for t in TRAITS])
    hashes = [F.xxhash64(t).alias(f"h_{t}") for t in TRAITS]
    none = [F.col(t).isNull() for t in TRAITS]
    mask = reduce(lambda a, b: a + b, [F.when(~x, 1 << j).otherwise(0) for j, x in enumerate(none)])
    asked = requests.select(*TRAITS).distinct().select(*TRAITS, *hashes, n_set.alias("q_set"), mask.alias("mask"),
                                                       F.xxhash64(mask, *TRAITS).alias("q")).checkpoint(eager=True)
    tops = [r["mask"] for r in asked.select("mask").distinct().collect()]  # at most 256
    masks = sorted({m for m in range(1 << len(TRAITS)) if any(m & t == m for t in tops)})
    if not masks:
        return requests.select("req_id").limit(0).join(trait_rows.select(id_col).limit(0), how="cross").select(
            "req_id", id_col, F.lit(0.0).alias("dist2"), F.lit(0).alias("rank"))
    rows = trait_rows.select(id_col, *TRAITS, *hashes, n_set.alias("n_set"), F.xxhash64(mask, *TRAITS).alias("profile"))
    rows = top_k(rows, k, [F.col(id_col)], "profile").withColumnRenamed("rank", "nth")
    each = rows.select(id_col, "nth", "n_set", "profile", F.explode(_trait_keys(masks)).alias("x")).select(
        id_col, "nth", "n_set", "profile", "x.key")
    index = top_k(each, k, [F.col("n_set"), F.col(id_col), F.col("profile"), F.col("nth")], "key").drop("rank")
    wanted = asked.select("q", "q_set", F.explode(_trait_keys(masks)).alias("x")).select("q", "q_set", "x.*")
    near = wanted.join(index, "key").groupBy("q", id_col, "profile", "nth").agg(
        F.min(F.col("q_set") + F.col("n_set") - 2 * F.col("shared")).cast("double").alias("dist2"))
    best = top_k(near, k, [F.col("dist2"), F.col(id_col), F.col("profile"), F.col("nth")], "q").drop("profile", "nth")
    q = requests.select("req_id", F.xxhash64(mask, *TRAITS).alias("q"))
    return q.join(best, "q").select("req_id", id_col, "dist2", "rank")
