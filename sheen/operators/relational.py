"""Projection, keys, de-duplication and joins (§2.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheen.functions.constants import CONTENT_COLS, RATING_COLS, TRAITS
from sheen.sources.io import kept

COLUMN_SETS = {"ratings": RATING_COLS, "catalog": CONTENT_COLS, "traits": TRAITS + ["uid"]}


def project_columns(df: DataFrame, which: str) -> DataFrame:
    return df.select(*COLUMN_SETS[which])


def distinct_users(reviews: DataFrame, col: str = "users") -> DataFrame:
    return reviews.select(col).distinct()


def dense_index(df: DataFrame, order_col: str, out_col: str) -> DataFrame:
    """Number rows 0..n-1 in ``order_col`` order without a single-task window.

    Rows are range-partitioned on the key (an explicit partition count, which
    AQE never coalesces), sorted inside each partition and tagged with
    ``monotonically_increasing_id`` (partition number in the high bits, local
    position in the low 33). That tagging is frozen in files of the shared folder,
    so the per-partition counts and the rows read the same partitioning even if
    an executor is lost. Only the counts - one row per partition - meet in one
    place to become offsets.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tagged = kept(df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
                  .withColumn("_mid", F.monotonically_increasing_id()), "dense-index")
    low = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_ln", low)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, F.col("_off") + F.col("_ln"))
            .drop("_pid", "_ln", "_off", "_mid"))


def assign_uid(reviews: DataFrame, col: str = "users") -> DataFrame:
    """Bijection users -> 0..n-1 (ordered by name, so re-runs agree)."""
    return dense_index(distinct_users(reviews, col), col, "uid")


def join_uid(reviews: DataFrame, users: DataFrame, col: str = "users") -> DataFrame:
    return reviews.join(users, col, "inner")


def distinct_products(reviews: DataFrame) -> DataFrame:
    return reviews.select(*CONTENT_COLS).distinct()


def key_products(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("pro_ids", F.col("pro_ids").cast("bigint"))


def distinct_traits(df: DataFrame) -> DataFrame:
    return df.select(*TRAITS, "uid").distinct()


def product_lookup(catalog: DataFrame, keys: DataFrame, key: str = "pro_ids") -> DataFrame:
    """Catalog rows for a batch of keys (semi-join: a key never repeats a row)."""
    return catalog.join(keys.select(key), key, "left_semi")


def unique_counts(**frames: tuple[DataFrame, str]) -> DataFrame:
    """Long form (what, n): for each name -> (frame, column), its number of distinct
    values. Each count is its own grouped pass (no Expand over all columns at once)."""
    parts = [df.select(col).distinct().agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("what"), "n")
             for name, (df, col) in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Base-2 logarithm of the registers of a distinct-count sketch, and three times its standard error.
SKETCH_BITS = 12
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def count_sketches(df: DataFrame, col: str, by: str) -> DataFrame:
    """(by, sketch): a mergeable distinct-count sketch of ``col`` for each value of ``by``; a few
    KB each, kept beside the snapshots so that a total needs no second pass over the rows."""
    return df.groupBy(by).agg(F.hll_sketch_agg(F.col(col).cast("string"), SKETCH_BITS).alias("sketch"))


def union_counts(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Estimated distinct count (``estimate``) of the union of all sketches, or for each ``by``. It is
    within ``SKETCH_BOUND`` of the exact one (three standard errors)."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    return sketches.groupBy(*by).agg(union) if by else sketches.agg(union)
