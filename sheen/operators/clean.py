"""Raw review rows -> typed review rows (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.functions import parse as P
from sheen.functions.text import ustrip


def blank_to_null(df: DataFrame, col: str = "ingredients") -> DataFrame:
    return df.withColumn(col, F.nullif(F.col(col), F.lit("")))


OUT = ["pro_ids", "names", "ratings", "repurchases", "pkg_quals", "prices", "ingredients", "brands", "brand_ids", "users",
       "chars", "reviews", "lipies", "dates", "age", "skin", "hair", "eyes", "skin_type", "skin_tone", "skin_undertone",
       "hair_color", "hair_type", "hair_texture"]


def clean_reviews(raw: DataFrame, safe: bool = False) -> DataFrame:
    """Type every column of the raw review table, in the cleaning script's order.

    ``safe`` turns unparsable numbers into nulls instead of failing the job. The characteristics are
    split once for a row, in projections of their own: Spark computes an expression with
    lambdas anew for each column that uses it.
    """
    extra = [c for c in raw.columns if c not in OUT]
    raw = raw.withColumn("_chars", P.split_traits(F.col("chars")))
    raw = raw.withColumns({"_skin": P.split_strip(F.get("_chars", 1)), "_hair": P.split_strip(F.get("_chars", 2))})
    chars, skin, hair = F.col("_chars"), F.col("_skin"), F.col("_hair")
    cols = {
        "pro_ids": F.col("pro_ids"),
        "names": F.col("names"),
        "ratings": P.clean_ratings(F.col("ratings"), safe),
        "repurchases": P.clean_repurchases(F.col("repurchases")),
        "pkg_quals": P.clean_pkg_quals(F.col("pkg_quals")),
        "prices": P.clean_prices(F.col("prices")),
        "ingredients": P.ingredients_to_string(F.nullif(F.col("ingredients"), F.lit(""))),
        "brands": F.col("brands"),
        "brand_ids": F.col("brand_ids"),
        "users": ustrip(F.col("users")),
        "chars": chars,
        "reviews": ustrip(F.col("reviews")),
        "lipies": P.clean_lipies(F.col("lipies")),
        "dates": P.parse_dates(ustrip(F.col("dates"))),
        "age": F.get(chars, 0),
        "skin": skin,
        "hair": hair,
        "eyes": F.get(chars, 3),
        "skin_type": F.get(skin, 0),
        "skin_tone": F.get(skin, 1),
        "skin_undertone": F.get(skin, 2),
        "hair_color": F.get(hair, 0),
        "hair_type": F.get(hair, 1),
        "hair_texture": F.get(hair, 2),
    }
    return raw.select(*[v.alias(k) for k, v in cols.items()], *extra)


def profile_table(df: DataFrame, key: str = "pro_ids") -> DataFrame:
    """Row count, non-null count per column and distinct keys, as one row.

    One aggregation; with a single distinct column Spark plans it as two grouped
    phases with partial aggregation, no Expand.
    """
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.col(c)).alias(f"nn_{c}") for c in df.columns],
                  F.count_distinct(F.col(key)).alias(f"n_distinct_{key}"))
