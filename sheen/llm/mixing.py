"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheen.llm.common import RID, forget, frozen, ranked, running_offsets, with_row_id

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its size.
MOST_EPOCHS = 3
#: Rows of a key range that one task sorts.
RANGE_ROWS = 1_024
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size, n_docs) with src_no and target.

    Sources in code-point order (null last) take the weights in turn and share the total
    size by weight. A target above ``most_epochs`` times its source's size stops there and
    the excess is shared again by weight, until none is above: each round is one sum over
    the sources, and only two numbers reach the driver.
    """
    order = [F.col("source").isNull(), F.col("source")]
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("src_no") % len(weights) + 1).cast("int"))
    s = frozen(ranked(sizes, order, "src_no").withColumn("w", w), "sources")
    cap = F.lit(most_epochs) * F.col("source_size")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, None
    while True:
        above = cap < F.lit(share) * F.col("w")
        x = s.agg(F.sum(F.when(above, cap).otherwise(0)).alias("cap"), F.sum(above.cast("long")).alias("n"),
                  F.sum(F.when(~above, F.col("w")).otherwise(0.0)).alias("w")).first()
        if x["n"] == stopped or not x["w"]:
            break
        stopped, share = x["n"], (total - x["cap"]) / x["w"]
    return s.withColumn("target", F.least(cap.cast("double"), F.lit(share) * F.col("w"))).drop("w")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = SEED) -> DataFrame:
    """One row per input row: RID, ``key``, size, source_size, target, taken.

    Every document gets a hash-random key; within each source, documents are sorted by it
    in key ranges of about ``RANGE_ROWS`` rows (as many ranges as the source needs, so a hot
    source is dealt over many tasks), and running sums of the sizes come from the sums
    within a range plus the sums of the earlier ranges. A source's target is read in whole
    epochs over all its documents; the rest is cut at the exact budget, so the document at
    the cut gives only the words that still fit.

    size: number of words; null or empty text: 0 words, taken 0. Null source: a source of
    its own, last in order. Ties (repeated rows) are ordered by row id. Empty table: empty
    result. Extra columns are not read. Very long texts are counted whole, and cut like others
    where their source's budget ends. The same input gives the same mix.
    """
    docs = with_row_id(docs, key, text)
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"))), 1, 15),
                    16, 10).cast("long")
    d = frozen(docs.select(RID, F.col(key).alias("id"), F.col(source).alias("source"),
                           F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))
                           .cast("long").alias("size")).withColumn("k", hashed), "sizes")
    src = frozen(source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                        F.count(F.lit(1)).alias("n_docs"))), "targets")
    ranges = F.ceil(F.col("n_docs") / F.lit(RANGE_ROWS))
    d2 = frozen(d.join(src.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                .withColumn("part", F.floor(F.col("k") / F.lit(float(1 << 60)) * ranges))
                .select(RID, "id", "size", "k", "src_no", "part", "source_size", "target"), "ranges")
    forget(d)
    before = running_offsets(d2.groupBy("src_no", "part").agg(F.sum("size").alias("sum")),
                             ["src_no"], ["part"], "sum", "before").drop("sum")
    w = Window.partitionBy("src_no", "part").orderBy("k", RID).rowsBetween(Window.unboundedPreceding, -1)
    inside = d2.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("before") - F.col("inside")
    return inside.join(before, ["src_no", "part"]).select(
        RID, F.col("id").alias(key), "size", "source_size", "target",
        (epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **columns) -> DataFrame:
    """The mix as documents: each row as often as the mix takes it. The document at the
    cut of a source stays whole where at least half of it fits, so no text is cut."""
    docs = with_row_id(docs, columns.get("key", "doc_id"), columns.get("text", "text"))
    taken = mix(docs, **columns).select(
        RID, F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1)
        .cast("int").alias("__times__")).where("__times__ > 0")
    return (docs.join(taken, RID).withColumn("__times__", F.explode(F.sequence(F.lit(1), F.col("__times__"))))
            .drop(RID, "__times__"))
