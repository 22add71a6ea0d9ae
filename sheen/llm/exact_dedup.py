"""Exact dedup by deterministic block naming (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import RID, forget, frozen, with_row_id

#: Bytes of a block.
BLOCK = 2048


def normalised(text):
    """The text without space, tab, line feed, vertical tab, form feed, carriage return."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _blocks(norm: str):
    """Array of the fixed-size byte blocks of a string column; an empty text has one, empty."""
    return F.expr(f"transform(sequence(0L, greatest(0L, (octet_length({norm}) - 1L) div {BLOCK})), "
                  f"i -> substring(cast({norm} as binary), cast(i * {BLOCK} + 1 as int), {BLOCK}))")


def _block_names(texts: DataFrame, seed: int) -> DataFrame | None:
    """Integer names of the distinct blocks: (h1, h2, name); None if two different blocks
    share the 128 bits (h1, h2), so that the caller takes another seed."""
    blocks = (texts.select(F.explode(_blocks("t")).alias("block"))
              .select(F.xxhash64(F.lit(seed), "block").alias("h1"),
                      F.xxhash64(F.lit(seed + 1), "block").alias("h2"), "block").distinct())
    named = frozen(blocks.sortWithinPartitions("h1", "h2", "block")
                   .select("h1", "h2", F.monotonically_increasing_id().alias("name")), "names")
    clash = (named.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").limit(1).count())
    if clash:
        forget(named)
        return None
    return named


def identities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(RID, n_chars, sha, level, name): equal (level, name) if and only if the
    normalised texts are equal.

    Level 0 names every distinct block by its place in the sorted blocks; texts cross one
    shuffle, as distinct blocks, and rows find their names by the 128-bit key of the block,
    which was checked to belong to one content. Level k+1 names the distinct pairs of
    adjacent level-k names the same way, until a document has a single name, after
    ``ceil(log2(blocks))`` levels. Hot blocks shrink before each shuffle, because only
    distinct ones are sorted; the joins that bring names back are plain joins that Spark
    can split.
    """
    texts = docs.select(F.col(RID), F.col(text).alias("o")).withColumn("t", normalised(F.col("o")))
    seed, names = 7, None
    while names is None:
        names = _block_names(texts, seed)
        seed += 2 * (names is None)
    meta = frozen(texts.select(
        RID, F.char_length(F.coalesce("o", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2("t", 256).alias("sha"), _blocks("t").alias("b")).select(
        RID, "n_chars", "sha",
        F.transform("b", lambda x: F.struct(F.xxhash64(F.lit(seed), x).alias("h1"),
                                            F.xxhash64(F.lit(seed + 1), x).alias("h2"))).alias("keys")),
        "documents")
    rows = meta.select(RID, F.size("keys").alias("n"), F.posexplode("keys").alias("i", "k"))
    rows = frozen(rows.select(RID, "n", "i", "k.h1", "k.h2").join(names, ["h1", "h2"])
                  .select(RID, "n", "i", "name"), "named")
    done, level = [rows.where("n = 1").select(RID, F.lit(0).alias("level"), "name")], 0
    most = meta.agg(F.max(F.size("keys"))).first()[0] or 0
    rows = rows.where("n > 1")
    while most > 1 << level:
        pairs = frozen(rows.groupBy(RID, "n", F.expr("i div 2").alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r")), "pairs")
        names = frozen(pairs.select("l", "r").distinct().sortWithinPartitions("l", "r")
                       .withColumn("name", F.monotonically_increasing_id()), "names")
        rows = frozen(pairs.join(names, ["l", "r"]).select(RID, "n", F.col("i").cast("int"), "name"), "named")
        forget(pairs)
        forget(names)
        level += 1
        ended = F.col("n") <= (1 << level)
        done.append(rows.where(ended).select(RID, F.lit(level).alias("level"), "name"))
        rows = rows.where(~ended)
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return meta.drop("keys").join(out, RID)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: RID, ``key``, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after deleting white space
    (``[\\x20\\x09-\\x0D]``). Of equal texts the row with the most code points in its
    original text stays, then the one with the smallest key, then the first row.

    Null text: like an empty one; all empty texts form one group. Null key: sorts after
    every other key within its group. Repeated rows: each keeps its own result row, one of
    them stays. Empty table: empty result. Extra columns are not read. Very long texts are
    named block by block, each block a row. The key must be a number.
    """
    docs = with_row_id(docs, key, text)
    ids = frozen(docs.select(RID, F.col(key).alias("id")).join(identities(docs, text), RID), "identities")
    best = ids.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("n_chars"), (-F.col("id")).alias("i"), (-F.col(RID)).alias("r"))).alias("best"))
    best = frozen(best, "groups")
    return ids.join(best, ["level", "name"]).select(
        RID, F.col("id").alias(key), (-F.col("best.i")).alias("keep_id"), "group_size",
        (F.col(RID) == -F.col("best.r")).alias("kept"), F.col("sha").alias("text_sha256"))
