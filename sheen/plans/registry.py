"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
driver's tables (through the fixture views of FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheen.functions import parse as P
from sheen.functions.constants import TRAITS
from sheen.functions.text import ustrip
from sheen.operators import clean as C
from sheen.operators import relational as R
from sheen.operators import serve as S
from sheen.session import ensure_checkpoint_dir
from sheen.sources import fixtures as FX
from sheen.sources import io as IO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def joined(arr) -> F.Column:
    """Arrays leave as '|'-joined text so both engines hash them alike."""
    return F.array_join(arr, "|")


# ----------------------------------------------------------------------------- shared views

def clean_fx(spark, sf) -> DataFrame:
    return C.clean_reviews(FX.reviews_raw_fx(spark, sf))


def uid_fx(spark, sf) -> DataFrame:
    return R.assign_uid(clean_fx(spark, sf))


# ----------------------------------------------------------------------------- §2.3 cleaning

@query("clean_ratings")
def q_clean_ratings(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select("pro_ids", P.clean_ratings(F.col("ratings")).alias("ratings"))


@query("clean_repurchases")
def q_clean_repurchases(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select("pro_ids", P.clean_repurchases(F.col("repurchases")).alias("repurchases"))


@query("clean_pkg_quals")
def q_clean_pkg_quals(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select("pro_ids", P.clean_pkg_quals(F.col("pkg_quals")).alias("pkg_quals"))


@query("clean_prices")
def q_clean_prices(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select("pro_ids", P.clean_prices(F.col("prices")).alias("prices"))


@query("split_traits")
def q_split_traits(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    ch = P.split_traits(F.col("chars"))
    return raw.select("users", joined(ch).alias("chars"), F.size(ch).alias("n_parts"))


@query("strip_text")
def q_strip_text(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select(ustrip(F.col("users")).alias("users"),
                      ustrip(F.col("reviews")).alias("reviews"),
                      ustrip(F.col("dates")).alias("dates"))


@query("clean_lipies")
def q_clean_lipies(spark, sf):
    raw = FX.reviews_raw_fx(spark, sf)
    return raw.select("pro_ids", P.clean_lipies(F.col("lipies")).alias("lipies"))


@query("parse_dates")
def q_parse_dates(spark, sf):
    return clean_fx(spark, sf).select("pro_ids", "users", "dates")


@query("format_month")
def q_format_month(spark, sf):
    return clean_fx(spark, sf).select("pro_ids", "users",
                                      P.format_month(F.col("dates")).alias("month"))


@query("traits_to_columns")
def q_traits_to_columns(spark, sf):
    return clean_fx(spark, sf).select("users", "age", joined("skin").alias("skin"),
                                      joined("hair").alias("hair"), "eyes")


@query("split_strip_lists")
def q_split_strip_lists(spark, sf):
    return clean_fx(spark, sf).select("users", joined("skin").alias("skin"),
                                      F.size("skin").alias("n_skin"),
                                      joined("hair").alias("hair"), F.size("hair").alias("n_hair"))


@query("lists_to_columns")
def q_lists_to_columns(spark, sf):
    return clean_fx(spark, sf).select("users", "skin_type", "skin_tone", "skin_undertone",
                                      "hair_color", "hair_type", "hair_texture")


@query("ingredients_to_string")
def q_ingredients_to_string(spark, sf):
    return clean_fx(spark, sf).select("pro_ids", "ingredients").distinct()


@query("category_name")
def q_category_name(spark, sf):
    return clean_fx(spark, sf).select("pro_ids", "cat_id",
                                      P.category_name(F.col("cat_id")).alias("category"))


@query("profile_table")
def q_profile_table(spark, sf):
    c = clean_fx(spark, sf).select("pro_ids", "names", "ratings", "ingredients", "users",
                                   "lipies", "dates")
    return C.profile_table(c)


@query("clean_reviews")
def q_clean_reviews(spark, sf):
    c = clean_fx(spark, sf)
    return c.select("pro_ids", "names", "ratings", "repurchases", "pkg_quals", "prices",
                    "brands", "brand_ids", "users", "reviews", "lipies", "dates", "cat_id",
                    *TRAITS)


@query("blank_to_null")
def q_blank_to_null(spark, sf):
    raw = C.blank_to_null(FX.reviews_raw_fx(spark, sf))
    return raw.select("pro_ids", F.col("ingredients").isNull().alias("no_ingredients")).distinct()


# ----------------------------------------------------------------------------- §2.4 relational

@query("project_columns")
def q_project_columns(spark, sf):
    return R.project_columns(clean_fx(spark, sf), "ratings")


@query("distinct_users")
def q_distinct_users(spark, sf):
    return R.distinct_users(clean_fx(spark, sf))


@query("assign_uid")
def q_assign_uid(spark, sf):
    return uid_fx(spark, sf)


@query("join_uid")
def q_join_uid(spark, sf):
    j = R.join_uid(clean_fx(spark, sf), uid_fx(spark, sf))
    return j.select("pro_ids", "uid", "lipies")


@query("distinct_products")
def q_distinct_products(spark, sf):
    return R.distinct_products(clean_fx(spark, sf))


@query("key_products")
def q_key_products(spark, sf):
    return R.key_products(R.distinct_products(clean_fx(spark, sf))).select("pro_ids", "names")


@query("distinct_traits")
def q_distinct_traits(spark, sf):
    j = R.join_uid(clean_fx(spark, sf), uid_fx(spark, sf))
    return R.distinct_traits(j)


@query("product_lookup")
def q_product_lookup(spark, sf):
    keys = FX.recs_fx(spark, sf).select(F.col("rec1").cast("int").alias("pro_ids"))
    return R.product_lookup(FX.catalog_fx(spark, sf), keys).drop("ingredients")


@query("unique_counts")
def q_unique_counts(spark, sf):
    c = clean_fx(spark, sf)
    j = R.join_uid(c, uid_fx(spark, sf))
    traits = R.distinct_traits(j).select(F.concat_ws("|", *TRAITS, F.col("uid").cast("string"))
                                         .alias("row"))
    return R.unique_counts(users=(c, "users"), products=(c, "pro_ids"), trait_rows=(traits, "row"))


@query("unique_count_sketches")
def q_unique_count_sketches(spark, sf):
    """Distinct users and products from sketches that are kept per category and united, and whether
    the estimate is within its bound of the exact count."""
    c = clean_fx(spark, sf).select("cat_id", "users", "pro_ids").checkpoint()
    parts = []
    for what, col in (("users", "users"), ("products", "pro_ids")):
        kept = IO.load_table(spark, IO.save_table(R.count_sketches(c, col, "cat_id"), IO.shared_path(spark, f"sketches-{what}")))
        exact = c.select(col).distinct().agg(F.count(F.lit(1)).alias("n"))
        parts.append(exact.crossJoin(R.union_counts(kept)).select(  # one row each
            F.lit(what).alias("what"), "n", (F.abs(F.col("estimate") - F.col("n")) <= F.ceil(F.col("n") * R.SKETCH_BOUND)).alias("within")))
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------------------- §2.8 serving

@query("rating_histogram")
def q_rating_histogram(spark, sf):
    return S.rating_histogram(FX.ratings_fx(spark, sf), FX.catalog_fx(spark, sf))


@query("histogram_series")
def q_histogram_series(spark, sf):
    h = S.rating_histogram(FX.ratings_fx(spark, sf), FX.catalog_fx(spark, sf))
    return S.histogram_series(h)


@query("product_options")
def q_product_options(spark, sf):
    return S.product_options(FX.catalog_fx(spark, sf))


# ----------------------------------------------------------------------------- §2.5 ingredients
from sheen.functions import text as T  # noqa: E402
from sheen.operators import ingredients as I  # noqa: E402


def tokens_fx(spark, sf) -> DataFrame:
    """Tokenised where the texts are read, from files that give every core some."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheen-texts-{IO.input_key(spark, sf, ['documents'])}"
    return I.product_tokens(IO.spread_files(FX.ingredient_texts_fx(spark, sf), path), products=FX.products_fx(spark, sf))


def vocab_fx(spark, sf) -> DataFrame:
    return I.token_vocabulary(tokens_fx(spark, sf))


def tokens_only_fx(spark, sf) -> DataFrame:
    return I.token_vocabulary(tokens_fx(spark, sf), with_index=False)


def groups_fx(spark, sf) -> DataFrame:
    """Written once: its vocabulary is read by the groups and by their exemplars."""
    return I.stand_in_groups(IO.kept(tokens_only_fx(spark, sf).select("token"), "vocabulary"))


def tokens_groups_fx(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Tokens and their groups; the texts are tokenised once for both."""
    tokens = IO.kept(tokens_fx(spark, sf), "tokens")
    return tokens, I.stand_in_groups(I.token_vocabulary(tokens, with_index=False).select("token"))


def _arr_out(df, arr):
    return df.select("pro_ids", joined(arr).alias("tokens"), F.size(arr).alias("n_tokens"))


@query("split_ingredients")
def q_split_ingredients(spark, sf):
    c = FX.catalog_fx(spark, sf)
    return _arr_out(c, T.split_ingredients(F.coalesce(F.col("ingredients"), F.lit(""))))


@query("strip_tokens")
def q_strip_tokens(spark, sf):
    c = FX.catalog_fx(spark, sf)
    return _arr_out(c, T.strip_tokens(T.split_ingredients(F.coalesce(F.col("ingredients"), F.lit("")))))


def _one_rule(spark, sf, rule):
    c = FX.catalog_fx(spark, sf)
    base = T.strip_tokens(T.split_ingredients(F.coalesce(F.col("ingredients"), F.lit(""))))
    return _arr_out(c, F.transform(base, rule))


@query("water_rule")
def q_water_rule(spark, sf):
    return _one_rule(spark, sf, T.water_rule)


@query("oil_rule")
def q_oil_rule(spark, sf):
    return _one_rule(spark, sf, T.oil_rule)


@query("extract_rule")
def q_extract_rule(spark, sf):
    return _one_rule(spark, sf, T.extract_rule)


@query("length_filter")
def q_length_filter(spark, sf):
    c = FX.catalog_fx(spark, sf)
    base = T.strip_tokens(T.split_ingredients(F.coalesce(F.col("ingredients"), F.lit(""))))
    return _arr_out(c, F.filter(base, lambda t: F.length(t) > 3))


@query("ingredient_tokens")
def q_ingredient_tokens(spark, sf):
    t = tokens_fx(spark, sf)
    return _arr_out(t, F.col("tokens"))


@query("token_vocabulary")
def q_token_vocabulary(spark, sf):
    return vocab_fx(spark, sf).withColumnRenamed("first_key", "first_pro_ids")


@query("token_edit_distance")
def q_token_edit_distance(spark, sf):
    pairs = I.edit_distance_pairs(tokens_only_fx(spark, sf))
    return pairs.withColumn("similarity", -F.col("dist"))


@query("group_lookup")
def q_group_lookup(spark, sf):
    return I.group_lookup(*tokens_groups_fx(spark, sf))


@query("group_members")
def q_group_members(spark, sf):
    return I.group_members(groups_fx(spark, sf))


@query("product_groups")
def q_product_groups(spark, sf):
    pg = I.product_groups(*tokens_groups_fx(spark, sf))
    return pg.select("pro_ids", joined("groups").alias("groups"), "n_groups")


# ----------------------------------------------------------------------------- §2.6 features
from sheen.operators import factors as FA  # noqa: E402
from sheen.operators import features as FE  # noqa: E402
from sheen.operators import transformers as TR  # noqa: E402
from sheen.session import table  # noqa: E402


def pgroups_fx(spark, sf) -> DataFrame:
    """Written once: the features read it for their names and for their rows."""
    tokens, groups = tokens_groups_fx(spark, sf)
    out = IO.kept(I.product_groups(tokens, groups), "product-groups")
    IO.drop_kept(tokens)
    return out


def features_fx(spark, sf, groups: DataFrame | None = None) -> DataFrame:
    """Catalog features, materialised once: the token table is reused by the
    vocabulary and the product groups, and the features by both sides of the
    neighbour search (request products and candidates)."""
    made = groups is None
    tokens, groups = tokens_groups_fx(spark, sf) if made else (tokens_fx(spark, sf), groups)
    out = IO.kept(FE.product_features(FX.catalog_fx(spark, sf), I.product_groups(tokens, groups)), "features")
    if made:
        IO.drop_kept(tokens)
    return out


def query_products_fx(spark, sf) -> DataFrame:
    return FE.feature_by_name(FX.catalog_fx(spark, sf), FX.requests_fx(spark, sf))


@query("multi_hot_groups")
def q_multi_hot_groups(spark, sf):
    return FE.multi_hot_groups(pgroups_fx(spark, sf))


@query("assemble_features")
def q_assemble_features(spark, sf):
    return FE.assemble_features(FE.multi_hot_groups(pgroups_fx(spark, sf)), FX.catalog_fx(spark, sf))


@query("feature_by_name")
def q_feature_by_name(spark, sf):
    return query_products_fx(spark, sf)


@query("similar_products")
def q_similar_products(spark, sf):
    return FE.similar_products(features_fx(spark, sf), query_products_fx(spark, sf), k=10)


@query("one_hot_traits")
def q_one_hot_traits(spark, sf):
    return FE.one_hot_traits(FX.traits_fx(spark, sf))


@query("feature_names")
def q_feature_names(spark, sf):
    return FE.feature_names(FE.one_hot_traits(FX.traits_fx(spark, sf)))


@query("trait_domains")
def q_trait_domains(spark, sf):
    counts = FE.unpivot_traits(FX.traits_fx(spark, sf), "uid").groupBy("trait", "value").agg(
        F.count(F.lit(1)).alias("n_users"))
    return (FE.trait_domains(spark).join(counts, ["trait", "value"], "left")
            .withColumn("n_users", F.coalesce("n_users", F.lit(0).cast("bigint"))))


@query("request_vector")
def q_request_vector(spark, sf):
    return FE.request_vector(FX.requests_fx(spark, sf), FE.trait_domains(spark))


@query("similar_users")
def q_similar_users(spark, sf):
    return FE.similar_users(FX.traits_fx(spark, sf), FX.requests_fx(spark, sf), k=10)


def saved_and_loaded(spark, name: str, model):
    """A fitted pipeline by way of its saved form."""
    path = IO.shared_path(spark, name)
    IO.save_artifacts(spark, path, {}, {name: model})
    return IO.load_artifacts(spark, path)[name]


@query("product_vectors")
def q_product_vectors(spark, sf):
    """``assemble_features`` by the fitted, saved and loaded transformer; zeros are not stored."""
    feats = features_fx(spark, sf)
    model = saved_and_loaded(spark, "product-vectors", TR.fit_product_vectors(feats))
    return TR.long_form(model.transform(feats), "pro_ids").where("value <> 0")


@query("trait_vectors")
def q_trait_vectors(spark, sf):
    """``one_hot_traits`` by the fitted, saved and loaded transformer."""
    model = saved_and_loaded(spark, "trait-vectors", TR.fit_trait_vectors(FX.traits_fx(spark, sf)))
    return TR.long_form(model.transform(FX.traits_fx(spark, sf)), "uid").select("uid", F.col("feature_idx").cast("int").alias("slot"), "value")


@query("trait_vectors_of_requests")
def q_trait_vectors_of_requests(spark, sf):
    """Request vectors by the transformer fitted on the users of even id: values of other users only set nothing."""
    users = FX.traits_fx(spark, sf)
    model = TR.fit_trait_vectors(users.where("uid % 2 = 0"))
    return TR.long_form(model.transform(FX.requests_fx(spark, sf)), "req_id").select("req_id", F.col("feature_idx").cast("int").alias("slot"), "value")


def approx_due_fx(spark, sf) -> DataFrame:
    """Every product whose id is divisible by 20 as a request."""
    return FX.products_fx(spark, sf).where("pro_ids % 20 = 0").select(F.col("pro_ids").alias("req_id"), "pro_ids")


@query("similar_products_approx")
def q_similar_products_approx(spark, sf):
    return TR.similar_products_approx(features_fx(spark, sf), approx_due_fx(spark, sf))


@query("rating_matrix")
def q_rating_matrix(spark, sf):
    return FA.rating_matrix(FX.ratings_fx(spark, sf))


@query("rating_pivot")
def q_rating_pivot(spark, sf):
    """A row per product over all users; arrays leave as text, means with six places."""
    p = FA.rating_pivot(FX.ratings_fx(spark, sf))
    return p.select("pro_ids", "n_users", joined(F.col("users").cast("array<string>")).alias("users"),
                    joined(F.transform("means", lambda m: F.format_string("%.6f", m))).alias("means"))


@query("max_abs_scale")
def q_max_abs_scale(spark, sf):
    return FA.max_abs_scale(FA.rating_matrix(FX.ratings_fx(spark, sf)))


@query("nmf_factors")
def q_nmf_factors(spark, sf):
    return factor_artifacts(spark, sf)["product_factors"]


def unit_embeddings_fx(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id"), F.col("embedding").alias("vec"))
    return FA.l2_normalize(e)


@query("l2_normalize")
def q_l2_normalize(spark, sf):
    u = unit_embeddings_fx(spark, sf)
    return u.select("vec_id", F.posexplode("vec").alias("pos", "value")).withColumn(
        "value", F.round("value", 9))


@query("name_factors")
def q_name_factors(spark, sf):
    """Unit vectors with the names of their products."""
    u = unit_embeddings_fx(spark, sf).select("vec_id", F.posexplode("vec").alias("pos", "value"))
    c = FX.catalog_fx(spark, sf).select(F.col("pro_ids").cast("bigint").alias("vec_id"), "names")
    return u.join(c, "vec_id", "left").select("vec_id", "names", "pos", F.round("value", 9).alias("value"))


def cosine_due_fx(spark, sf) -> DataFrame:
    """Every row whose id is divisible by 20, a share that grows with the table."""
    return table(spark, sf, "embeddings").where(F.col("vec_id") % 20 == 0).select("vec_id")


@query("cosine_scores")
def q_cosine_scores(spark, sf):
    s = FA.cosine_scores(unit_embeddings_fx(spark, sf), cosine_due_fx(spark, sf), key="vec_id")
    return s.select("req_id", "vec_id", F.round("score", 9).alias("score"))


@query("cosine_top_k")
def q_cosine_top_k(spark, sf):
    s = FA.cosine_top_k(unit_embeddings_fx(spark, sf), cosine_due_fx(spark, sf), 10, key="vec_id")
    return s.select("req_id", "vec_id", F.round("score", 9).alias("score"), "rank")


#: The name that the search had before ``cosine_top_k`` took every due query.
QUERIES["cosine_top_k_due"] = q_cosine_top_k


def unit_factors_fx(spark, sf) -> DataFrame:
    return FA.l2_normalize(factor_artifacts(spark, sf)["product_factors"], "f")


@query("named_factors")
def q_named_factors(spark, sf):
    """The products' fitted factors at length 1, with the names of the products."""
    u = unit_factors_fx(spark, sf).select("pro_ids", F.posexplode("f").alias("pos", "value"))
    return u.join(FX.catalog_fx(spark, sf).select("pro_ids", "names"), "pro_ids", "left")


@query("factor_top_k")
def q_factor_top_k(spark, sf):
    """The ten products whose fitted factors are most similar, for each product whose id is divisible by 20."""
    u = unit_factors_fx(spark, sf)
    return FA.cosine_top_k(u, u.where("pro_ids % 20 = 0").select("pro_ids"), 10, vec="f")


# ----------------------------------------------------------------------------- §2.7 collaborative filtering
from sheen.operators import collab as CO  # noqa: E402


def _ratings_for_als(spark, sf):
    return FX.ratings_fx(spark, sf)


@query("als_fit")
def q_als_fit(spark, sf):
    r = _ratings_for_als(spark, sf)
    model = CO.als_fit(r, rank=10, reg=0.1, blocks=CO.als_fit_blocks(r.count()))
    return model.transform(r).select("uid", "pro_ids", "lipies", "prediction")


@query("als_grid")
def q_als_grid(spark, sf):
    """Training RMSE of every grid point (rank x regParam)."""
    ensure_checkpoint_dir(spark)
    r = _ratings_for_als(spark, sf).checkpoint(eager=True)
    als = CO.als_estimator().setCheckpointInterval(CO.KEPT_ITERATIONS)
    grid = CO.als_grid(als)
    rows = [(int(pm[als.rank]), float(pm[als.regParam]), rmse) for pm, rmse in zip(grid, CO.grid_rmse(als, r, grid))]
    return spark.createDataFrame(rows, "rank int, reg_param double, train_rmse double")


def _mean_predictions(spark, sf):
    r = FX.ratings_fx(spark, sf)
    mean = r.groupBy("pro_ids").agg(F.avg("lipies").alias("prediction"))
    return r.join(mean, "pro_ids")


@query("als_rmse")
def q_als_rmse(spark, sf):
    """RMSE formula on stand-in predictions (each product's mean rating)."""
    return CO.rmse(_mean_predictions(spark, sf)).select(F.round("rmse", 9).alias("rmse"))


def als_artifacts(spark, sf) -> dict:
    """metrics of the cross-validated grid, the best model refitted on all ratings, and its ten
    recommendations for each user: fitted once, then loaded."""
    def fit():
        r = _ratings_for_als(spark, sf).checkpoint(eager=True)
        blocks = CO.als_blocks(r.count())
        cv = CO.als_cross_validate(r.coalesce(blocks) if blocks < 8 else r, parallelism=8, blocks=blocks)
        recs = CO.als_top_n(cv.bestModel, 10)
        return {"metrics": CO.cv_metrics(spark, cv), "recs": recs}, {"als": cv.bestModel}
    return IO.fitted(spark, sf, "als", ["lineitem", "orders"], fit)


@query("als_cross_validate")
def q_als_cross_validate(spark, sf):
    return als_artifacts(spark, sf)["metrics"]


@query("als_top_n")
def q_als_top_n(spark, sf):
    """Ten recommendations of the cross-validated model, which is loaded where it has been fitted."""
    recs = CO.als_top_n(als_artifacts(spark, sf)["als"], 10)
    return recs.select("uid", F.posexplode("recommendations").alias("pos", "r")).select(
        "uid", (F.col("pos") + 1).alias("rank"), F.col("r.pro_ids").alias("pro_ids"),
        F.col("r.rating").alias("rating"))


def stand_in_recommendations(spark, sf) -> DataFrame:
    """(uid, recommendations) shaped like ALS output: each user's ten products by
    summed rating, best first."""
    from pyspark.sql import Window
    s = FX.ratings_fx(spark, sf).groupBy("uid", "pro_ids").agg(F.sum("lipies").alias("rating"))
    w = Window.partitionBy("uid").orderBy(F.desc("rating"), "pro_ids")
    top = s.withColumn("rn", F.row_number().over(w)).where("rn <= 10")
    return top.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("rn", "pro_ids", "rating")))
                                  .alias("r")).select(
        "uid", F.transform("r", lambda x: F.struct(x["pro_ids"].alias("pro_ids"),
                                                   x["rating"].alias("rating"))).alias("recommendations"))


@query("recs_to_columns")
def q_recs_to_columns(spark, sf):
    return CO.recs_to_columns(stand_in_recommendations(spark, sf))


# ----------------------------------------------------------------------------- §2.8 serving
def neighbours_fx(spark, sf):
    return FE.similar_users(FX.traits_fx(spark, sf), FX.requests_fx(spark, sf), k=10)


def similar_fx(spark, sf):
    return FE.similar_products(features_fx(spark, sf), query_products_fx(spark, sf), k=10)


@query("neighbor_recs")
def q_neighbor_recs(spark, sf):
    return S.neighbor_recs(neighbours_fx(spark, sf), FX.recs_fx(spark, sf))


@query("rec_details")
def q_rec_details(spark, sf):
    d = S.rec_details(S.neighbor_recs(neighbours_fx(spark, sf), FX.recs_fx(spark, sf)),
                      FX.catalog_fx(spark, sf))
    return d.drop("ingredients")


@query("rec_dedup")
def q_rec_dedup(spark, sf):
    n = S.neighbor_recs(neighbours_fx(spark, sf), FX.recs_fx(spark, sf))
    return S.rec_dedup(n, FX.catalog_fx(spark, sf)).drop("ingredients")


@query("content_recs")
def q_content_recs(spark, sf):
    return S.content_recs(similar_fx(spark, sf), FX.catalog_fx(spark, sf)).drop("ingredients")


def hybrid_fx(spark, sf):
    users = S.rec_ids(S.neighbor_recs(neighbours_fx(spark, sf), FX.recs_fx(spark, sf)), FX.catalog_fx(spark, sf))
    return S.hybrid_union(users, similar_fx(spark, sf))


@query("hybrid_union")
def q_hybrid_union(spark, sf):
    return S.with_details(hybrid_fx(spark, sf), FX.catalog_fx(spark, sf)).drop("ingredients")


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return S.with_details(S.seeded_sample(hybrid_fx(spark, sf)), FX.catalog_fx(spark, sf)).drop("ingredients")


@query("unknown_product")
def q_unknown_product(spark, sf):
    return S.unknown_product(FX.requests_fx(spark, sf), FX.catalog_fx(spark, sf))


@query("recommend_sql")
def q_recommend_sql(spark, sf):
    return S.recommend(FX.requests_fx(spark, sf), FX.traits_fx(spark, sf), FX.recs_fx(spark, sf),
                       FX.catalog_fx(spark, sf), features_fx(spark, sf))


# ----------------------------------------------------------------------------- §2.2 pages
from sheen.functions.constants import PRODUCT_LINK_MARKER, SKIPPED_REVIEW_URL  # noqa: E402
from sheen.operators import pages as PG  # noqa: E402

HOST = "https://reviews.example.com"


def categories_fx(spark, sf) -> DataFrame:
    """Search pages per category: products of the category, ten to a page."""
    c = FX.catalog_fx(spark, sf).select((F.lit(701) + F.col("pro_ids") % 9).cast("string").alias("cat_id"))
    return c.groupBy("cat_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(10.0)).cast("int").alias("n_pages"))


def links_fx(spark, sf) -> DataFrame:
    """A product link and its review count text ('1,399') for every rated product."""
    n = FX.ratings_fx(spark, sf).groupBy("pro_ids").agg(F.count(F.lit(1)).alias("n"))
    return n.select("pro_ids", F.concat(F.lit(PRODUCT_LINK_MARKER), F.col("pro_ids").cast("string"),
                                        F.lit("/page=1/")).alias("link"),
                    F.format_number("n", 0).alias("n_reviews"))


def rendered_pages_fx(spark, sf) -> DataFrame:
    return PG.render_review_pages(FX.reviews_raw_fx(spark, sf), products=FX.page_products_fx(spark, sf))


@query("frontier_urls")
def q_frontier_urls(spark, sf):
    return PG.frontier_urls(categories_fx(spark, sf), HOST)


@query("cap_pages")
def q_cap_pages(spark, sf):
    f = categories_fx(spark, sf)
    prefix = F.concat(F.lit(HOST), F.lit("/product/searching.asp/CategoryId="), F.col("cat_id"),
                      F.lit("/NumberOfReviews=5/SD=DESC/SC=HOWMANY/page="))
    link = lambda p: F.concat(prefix, p.cast("string"), F.lit("/"))
    links = F.array(link(F.lit(1)), link(F.lit(2)), link(F.col("n_pages")), link(F.lit(2)))
    return f.select("cat_id", PG.cap_pages(links, prefix).alias("n_search_pages"))


@query("page_links")
def q_page_links(spark, sf):
    p = table(spark, sf, "pages")
    links = PG.page_links(F.col("html"), "/")
    return p.select("page_id", joined(links).alias("links"), F.size(links).alias("n_links"))


@query("every_second")
def q_every_second(spark, sf):
    p = table(spark, sf, "pages")
    links = PG.page_links(F.col("html"), "/")
    return p.select("page_id", joined(PG.every_second(links, 0)).alias("even"),
                    joined(PG.every_second(links, 1)).alias("odd"))


@query("flatten_lists")
def q_flatten_lists(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.explode(PG.page_links(F.col("html"), "/")).alias("link"))


@query("title_guard")
def q_title_guard(spark, sf):
    return PG.title_guard(table(spark, sf, "pages")).select("page_id", "url")


@query("canonical_link")
def q_canonical_link(spark, sf):
    return links_fx(spark, sf).select("pro_ids", P.canonical_link(F.col("link"), PRODUCT_LINK_MARKER)
                                      .alias("canonical"))


@query("extract_id")
def q_extract_id(spark, sf):
    return links_fx(spark, sf).select("pro_ids", P.extract_id(F.col("link"), PRODUCT_LINK_MARKER)
                                      .alias("item_id"))


@query("review_page_count")
def q_review_page_count(spark, sf):
    return links_fx(spark, sf).select("pro_ids", "n_reviews",
                                      P.review_page_count(F.col("n_reviews")).alias("n_pages"))


@query("expand_review_pages")
def q_expand_review_pages(spark, sf):
    return PG.expand_review_pages(links_fx(spark, sf)).select("pro_ids", "page", "url")


@query("skip_bad_pages")
def q_skip_bad_pages(spark, sf):
    urls = PG.expand_review_pages(links_fx(spark, sf)).select("pro_ids", "page", "url")
    # the fixed bad page, and the last page of every tenth product
    last = urls.where("pro_ids % 10 = 0").groupBy("pro_ids").agg(F.max_by("url", "page").alias("url")).select("url")
    block = spark.createDataFrame([(SKIPPED_REVIEW_URL,)], "url string").union(last)
    return PG.skip_bad_pages(urls, block)


@query("page_text_fields")
def q_page_text_fields(spark, sf):
    f = PG.page_text_fields(PG.parse_pages(PG.title_guard(rendered_pages_fx(spark, sf)), keep=False))
    return f.select(*PG.SCALARS).distinct()


@query("page_review_arrays")
def q_page_review_arrays(spark, sf):
    a = PG.page_review_arrays(PG.page_text_fields(PG.parse_pages(rendered_pages_fx(spark, sf), keep=False)))
    return a.groupBy("pro_ids").agg(*[F.sum(F.size(c)).alias("n_" + c[:-2]) for c in PG.REVIEW_ARRAYS])


@query("explode_reviews")
def q_explode_reviews(spark, sf):
    rows, _ = PG.extract_reviews(rendered_pages_fx(spark, sf))
    return rows.select(*PG.SCALARS, "users", "chars", "reviews", "lipies", "dates", "cat_id")


@query("quarantine_pages")
def q_quarantine_pages(spark, sf):
    pages = rendered_pages_fx(spark, sf).select("page_id", "url", "html").unionByName(
        table(spark, sf, "pages").select("page_id", "url", "html"))
    good, rejected = PG.quarantine_pages(PG.page_review_arrays(PG.page_text_fields(PG.parse_pages(pages, keep=False))))
    g = good.select(F.lit("good").alias("status"), F.size("users_a").alias("n"), F.lit(0).alias("r"))
    r = rejected.select(F.lit("rejected").alias("status"), F.col("n_users").alias("n"), F.lit(1).alias("r"))
    return g.unionByName(r).groupBy("status").agg(F.sum("n").cast("bigint").alias("n_reviews"),
                                                  F.sum("r").cast("bigint").alias("n_rejected"))


@query("tag_category")
def q_tag_category(spark, sf):
    return PG.tag_category(rendered_pages_fx(spark, sf)).select("pro_ids", "users", "lipies", "cat_id")


# ----------------------------------------------------------------------------- §2.1 sources and sinks

@query("sink_ratings_csv")
def q_sink_ratings_csv(spark, sf):
    path = IO.sink_ratings_csv(FX.ratings_fx(spark, sf), IO.shared_path(spark, "ratings-csv"))
    return IO.scan_ratings_csv(spark, path)


@query("scan_ratings_csv")
def q_scan_ratings_csv(spark, sf):
    path = IO.shared_path(spark, "ratings-csv")
    FX.ratings_fx(spark, sf).select("pro_ids", "uid", "lipies").write.option("header", True).csv(path)
    return IO.scan_ratings_csv(spark, path).select("pro_ids", "uid", "lipies")


@query("scan_ratings_rejects")
def q_scan_ratings_rejects(spark, sf):
    """Ratings and rejected lines of a file in which some lines have a wrong type, a missing
    column or a missing value."""
    r = FX.ratings_fx(spark, sf)
    part = F.col("uid") % 10
    rating = F.col("lipies").cast("int").cast("string")
    line = (F.when(part == 3, F.concat_ws(",", F.col("pro_ids").cast("string"), F.concat(F.lit("user "), F.col("uid").cast("string")), rating))
            .when(part == 4, F.concat_ws(",", F.col("pro_ids").cast("string"), F.col("uid").cast("string")))
            .when(part == 5, F.concat_ws(",", F.col("pro_ids").cast("string"), F.col("uid").cast("string"), F.lit("")))
            .otherwise(F.concat_ws(",", F.col("pro_ids").cast("string"), F.col("uid").cast("string"), rating)))
    path = IO.shared_path(spark, "ratings-lines")
    r.select(line.alias("value")).write.text(path)
    good, rejected = IO.scan_ratings(spark, path, header=False)
    return good.select(F.lit("good").alias("reason"), F.concat_ws(",", F.col("pro_ids").cast("string"), F.col("uid").cast("string"), rating).alias("line")).unionByName(rejected)


@query("sink_by_category")
def q_sink_by_category(spark, sf):
    """Nine snapshots, one of which a second crawl replaces with fewer rows."""
    rows = clean_fx(spark, sf).select("pro_ids", "users", "lipies", "cat_id")
    path = IO.sink_by_category(rows, IO.shared_path(spark, "by-category"))
    IO.sink_by_category(rows.where("cat_id = '705' and lipies >= 3"), path)
    return IO.load_categories(spark, path)


@query("load_categories")
def q_load_categories(spark, sf):
    path = IO.sink_by_category(clean_fx(spark, sf).select("pro_ids", "users", "lipies", "cat_id"),
                               IO.shared_path(spark, "by-category"))
    return IO.load_categories(spark, path).groupBy("cat_id").agg(F.count(F.lit(1)).alias("n"))


@query("save_clean")
def q_save_clean(spark, sf):
    cols = ["pro_ids", "users", "lipies", "dates", *TRAITS]
    path = IO.save_table(clean_fx(spark, sf).select(*cols), IO.shared_path(spark, "clean"))
    return IO.load_table(spark, path)


@query("ratings_marts")
def q_ratings_marts(spark, sf):
    j = R.join_uid(clean_fx(spark, sf), uid_fx(spark, sf))
    paths = IO.ratings_marts(j, IO.shared_path(spark, "marts"))
    return IO.load_table(spark, paths["prod_ratings_no_rev"])


def group_artifacts(spark, sf) -> dict:
    """labels and exemplars of the tokens, and the catalog features of these groups: fitted once,
    then loaded."""
    def fit():
        tokens = tokens_fx(spark, sf).checkpoint(eager=True)
        vocab = I.token_vocabulary(tokens)
        labels = AF.token_groups(vocab, I.edit_distance_pairs(vocab)).checkpoint(eager=True)
        exemplars = labels.groupBy("group", "exemplar").agg(F.count(F.lit(1)).alias("n_members"))
        features = FE.product_features(FX.catalog_fx(spark, sf), I.product_groups(tokens, labels))
        return {"labels": labels, "exemplars": exemplars, "features": features}, {}
    return IO.fitted(spark, sf, "groups", ["documents", "part"], fit)


def factor_artifacts(spark, sf) -> dict:
    """Product and user factors of the rating matrix: fitted once, then loaded."""
    def fit():
        w, h = FA.nmf_factors(FA.rating_matrix(FX.ratings_fx(spark, sf)), k=20)
        return {"product_factors": w, "user_factors": h}, {}
    return IO.fitted(spark, sf, "factors", ["lineitem", "orders"], fit)


def all_artifacts(spark, sf) -> tuple[dict, dict]:
    """Everything that serving loads, as (tables, models)."""
    groups, als, factors = group_artifacts(spark, sf), als_artifacts(spark, sf), factor_artifacts(spark, sf)
    recs = CO.recs_to_columns(als["recs"])
    return {"catalog": FX.catalog_fx(spark, sf), "traits": FX.traits_fx(spark, sf), "recs": recs,
            "labels": groups["labels"], "exemplars": groups["exemplars"], "features": groups["features"],
            "product_factors": factors["product_factors"], "user_factors": factors["user_factors"]}, {"als": als["als"]}


@query("save_artifacts")
def q_save_artifacts(spark, sf):
    """Rows of each table, and of the ALS model's factors, saved and loaded back."""
    tables, models = all_artifacts(spark, sf)
    path = IO.shared_path(spark, "artifacts")
    IO.save_artifacts(spark, path, tables, models)
    loaded = IO.load_artifacts(spark, path)
    als, exemplars = loaded.pop("als"), loaded.pop("exemplars")
    loaded |= {"als_users": als.userFactors, "als_products": als.itemFactors}
    count = F.count(F.lit(1))
    parts = [df.agg(count.alias("n_rows")).select(F.lit(name).alias("artifact"), "n_rows") for name, df in loaded.items()]
    parts.append(exemplars.select(F.lit("exemplar_members").alias("artifact"), "n_members").groupBy("artifact").agg(
        F.sum("n_members").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)


@query("load_artifacts")
def q_load_artifacts(spark, sf):
    """The serving query over stand-in artifacts saved and loaded back."""
    path = IO.shared_path(spark, "artifacts")
    IO.save_artifacts(spark, path, {"catalog": FX.catalog_fx(spark, sf), "features": features_fx(spark, sf),
                                    "recs": FX.recs_fx(spark, sf), "traits": FX.traits_fx(spark, sf)})
    a = IO.load_artifacts(spark, path)
    return S.recommend(FX.requests_fx(spark, sf), a["traits"], a["recs"], a["catalog"], a["features"])


# ----------------------------------------------------------------------------- iterative / model keys
from sheen.operators import affinity as AF  # noqa: E402


def ap_groups_fx(spark, sf, **kw) -> DataFrame:
    vocab = vocab_fx(spark, sf)
    return AF.token_groups(vocab, I.edit_distance_pairs(vocab), **kw)


@query("token_groups")
def q_token_groups(spark, sf):
    """With the number of rounds of the token's component, and whether its exemplars had settled by then."""
    return ap_groups_fx(spark, sf)


@query("recommend")
def q_recommend(spark, sf):
    """The full pipeline on real models, which are loaded where they have been fitted:
    affinity-propagation ingredient groups for the content half, ALS recommendations for the
    similar-users half."""
    recs = CO.recs_to_columns(als_artifacts(spark, sf)["recs"])
    return S.recommend(FX.requests_fx(spark, sf), FX.traits_fx(spark, sf), recs, FX.catalog_fx(spark, sf),
                       group_artifacts(spark, sf)["features"])
