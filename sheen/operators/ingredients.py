"""Ingredient text -> tokens -> vocabulary -> edit-distance pairs -> groups (§2.5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.functions import text as T
from sheen.operators.relational import dense_index
from sheen.session import ensure_checkpoint_dir


def product_tokens(texts: DataFrame, col: str = "ingredients", key: str = "pro_ids",
                   products: DataFrame | None = None) -> DataFrame:
    """(key, tokens array); the whole text is tokenised where it is read.

    Texts go into no shuffle or join: tokenise the text table itself, and pass the table of
    ``products`` (key) to get a row, with an empty list, for products without a text too.
    Tokenising is CPU-bound, so text tables want small input splits
    (``spark.sql.files.maxPartitionBytes`` of about 32 MB).
    """
    out = texts.select(key, T.ingredient_tokens(F.col(col)).alias("tokens"))
    if products is None:
        return out
    none = F.array().cast("array<string>")
    return products.select(key).join(out, key, "left").select(key, F.coalesce("tokens", none).alias("tokens"))


def explode_tokens(tokens: DataFrame, key: str = "pro_ids", with_pos: bool = False) -> DataFrame:
    """(key, [pos,] token) rows. The ``_outer`` generator plus a null filter
    keeps Catalyst from inferring ``size(tokens) > 0`` and pushing a second copy of
    the tokenizer expression to the scan."""
    if with_pos:
        rows = tokens.select(key, F.posexplode_outer("tokens").alias("pos", "token"))
    else:
        rows = tokens.select(key, F.explode_outer("tokens").alias("token"))
    return rows.where(F.col("token").isNotNull())


def token_vocabulary(tokens: DataFrame, key: str = "pro_ids", with_index: bool = True
                     ) -> DataFrame:
    """Distinct tokens in first-seen order: (token, first_key, first_pos, token_idx).

    The first sighting is a ``min`` over (key, position) - a partial aggregate per
    task, so a token that appears in a third of all products costs one row per
    task before the shuffle.
    """
    exploded = explode_tokens(tokens, key, with_pos=True)
    key_type = tokens.schema[key].dataType.simpleString()
    if key_type in ("int", "smallint", "tinyint"):
        # (key, pos) packed in one bigint: a hash aggregate instead of a sort-based one
        packed = F.shiftleft(F.col(key).cast("bigint"), 32) + F.col("pos")
        first = (exploded.groupBy("token").agg(F.min(packed).alias("f"))
                 .select("token", F.shiftright("f", 32).cast(key_type).alias("first_key"),
                         (F.col("f").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int").alias("first_pos")))
    else:
        first = (exploded.groupBy("token")
                 .agg(F.min(F.struct(F.col(key), F.col("pos"))).alias("f"))
                 .select("token", F.col(f"f.{key}").alias("first_key"), F.col("f.pos").alias("first_pos")))
    if not with_index:
        return first
    ordered = first.withColumn("_ord", F.struct("first_key", "first_pos"))
    return dense_index(ordered, "_ord", "token_idx").drop("_ord")


#: Edits that tokens may differ by: so many, or one for every ``PER_EDIT`` characters of the longer one.
EDITS, PER_EDIT = 2, 8
#: Tokens up to this length are looked up by length and place; longer ones, of which there are
#: few and whose segments are long, by the text of a segment alone.
PLACED = 96
#: Rows of one segment key beyond which the key is split over several tasks.
HOT_KEY = 1_000
#: Split keys that are broadcast at most; more of them are joined by a shuffle.
SPLIT_KEYS = 100_000


def edit_bound(length, max_dist: int, per_edit: int | None) -> F.Column:
    """Edits allowed between two tokens whose longer one has ``length`` characters."""
    least = F.lit(max_dist)
    return F.greatest(least, F.floor(length / per_edit).cast("int")) if per_edit else least


def _segment(length, bound, i):
    """(start, size) of segment ``i`` when ``length`` characters are cut into ``bound`` + 1
    near-equal pieces, the longer pieces last."""
    parts = bound + 1
    base, extra = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    return i * base + F.greatest(F.lit(0), i - (parts - extra)), base + F.when(i >= parts - extra, 1).otherwise(0)


def _fits(at, start, i, bound, longer):
    """Whether segment ``i``, at ``start`` of the longer token, may lie unchanged at ``at`` of the
    one that is ``longer`` characters shorter: at most i edits before it and the rest after it."""
    shift = at - start
    return (F.abs(shift) <= i) & (F.abs(shift + longer) <= bound - i)


#: Two-letter sequences of a token as a set of 120 bits, each set if an odd number of them falls on
#: it: an edit changes at most four.
_BITS = """aggregate(sequence(1, greatest(length(t) - 1, 1)), 0L, (acc, p) -> acc ^ if(
    (ascii(substring(t, p, 1)) * 31 + ascii(substring(t, p + 1, 1))) % 120 div 60 = {half},
    shiftleft(1L, (ascii(substring(t, p, 1)) * 31 + ascii(substring(t, p + 1, 1))) % 60), 0L))"""


def _split_hot(index: DataFrame, probe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index rows of a key with many rows get one of several salts; probe rows of it, all."""
    hot = (index.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_KEY)
           .select("h", F.ceil(F.col("n") / HOT_KEY).cast("int").alias("parts")).checkpoint(eager=True))
    if hot.count() <= SPLIT_KEYS:
        hot = F.broadcast(hot)
    parts = F.coalesce("parts", F.lit(1))
    return (index.join(hot, "h", "left").withColumn("salt", F.pmod(F.col("a"), parts).cast("int")).drop("parts"),
            probe.join(hot, "h", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"))


def edit_distance_pairs(vocab: DataFrame, max_dist: int = EDITS, per_edit: int | None = PER_EDIT, col: str = "token"
                        ) -> DataFrame:
    """All pairs (token_a < token_b) within an edit bound: ``max_dist`` edits, or one for every
    ``per_edit`` characters of the longer token if that is more.

    Exact without comparing all pairs. The longer token of a pair is cut into one segment more
    than its bound; within the bound one segment survives in the other token, shifted by no more
    places than there are edits on either side of it. So tokens meet in an equi-join on segments,
    the number of which follows the length. A key with many rows is split (``HOT_KEY``). Joined
    rows carry ids and a 120-bit sketch that bounds the distance from below; texts are joined to
    the pairs that pass it, and verified with the thresholded ``levenshtein``.
    """
    spark = vocab.sparkSession
    ensure_checkpoint_dir(spark)
    v = vocab.select(F.col(col).alias("t")).where("t is not null").withColumn("n", F.length("t"))
    v = v.select(F.monotonically_increasing_id().alias("id"), "t", "n", edit_bound(F.col("n"), max_dist, per_edit).alias("k"),
                 F.expr(_BITS.format(half=0)).alias("s1"), F.expr(_BITS.format(half=1)).alias("s2")).checkpoint(eager=True)

    placed = lambda n, i, s: F.xxhash64(n, i, s)
    anywhere = lambda s: F.xxhash64(F.lit(-1), s)
    start, size = _segment(F.col("n"), F.col("k"), F.col("i"))
    text = F.substring("t", F.col("st") + 1, F.col("sl"))
    index = (v.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k")))).withColumn("st", start).withColumn("sl", size)
             .select(F.when(F.col("n") <= PLACED, placed(F.col("n"), F.col("i"), text)).otherwise(anywhere(text)).alias("h"),
                     F.col("id").alias("a"), F.col("n").alias("an"), "k", "i", "st", F.col("s1").alias("a1"), F.col("s2").alias("a2")))

    # lengths that may meet: a table of lengths, not of tokens
    lens = v.select("n", "k").distinct()
    met = lens.select("n").join(lens.select(F.col("n").alias("len"), "k"), (F.col("len") >= F.col("n")) & (F.col("len") - F.col("k") <= F.col("n")))
    seg = (met.where(F.col("len") <= PLACED).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
           .withColumn("st", _segment(F.col("len"), F.col("k"), F.col("i"))[0])
           .withColumn("sl", _segment(F.col("len"), F.col("k"), F.col("i"))[1]))
    longer, rest = F.col("len") - F.col("n"), F.col("k") - F.col("i")
    low = F.greatest(F.col("st") - F.least("i", longer + rest), F.lit(0))
    high = F.least(F.col("st") + F.least(F.col("i"), rest - longer), F.col("n") - F.col("sl"))
    seg = seg.withColumn("lo", low).withColumn("hi", high).where("lo <= hi").select("n", "len", "i", "sl", "lo", "hi")
    own = ["id", "n", "t", "s1", "s2"]
    near = (v.select(*own).join(seg, "n").select(*own, "len", "i", "sl", F.explode(F.sequence("lo", "hi")).alias("q"))
            .withColumn("h", placed(F.col("len"), F.col("i"), F.substring("t", F.col("q") + 1, F.col("sl")))))
    size_of = F.floor(F.col("len") / (F.col("k") + 1)).cast("int")
    sizes = (met.where(F.col("len") > PLACED).select("n", F.explode(F.array(size_of, size_of + 1)).alias("sl")).distinct()
             .where("sl <= n"))
    far = (v.select(*own).join(sizes, "n").select(*own, "sl", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("sl"))).alias("q"))
           .withColumn("h", anywhere(F.substring("t", F.col("q") + 1, F.col("sl")))))
    out = ["h", F.col("id").alias("b"), F.col("n").alias("bn"), "q", F.col("s1").alias("b1"), F.col("s2").alias("b2")]
    probe = near.select(*out).unionByName(far.select(*out))

    index, probe = _split_hot(index, probe)
    apart = F.col("an") - F.col("bn")
    differ = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    found = (index.join(probe, ["h", "salt"])
             .where((apart >= 0) & (apart <= F.col("k")) & ((apart > 0) | (F.col("a") < F.col("b")))
                    & _fits(F.col("q"), F.col("st"), F.col("i"), F.col("k"), apart) & (differ <= 4 * F.col("k")))
             .select("a", "b", "k").distinct())
    texts = v.select("id", "t")
    pairs = (found.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
             .withColumn("dist", F.expr("levenshtein(ta, tb, k)")).where("dist >= 0"))
    return pairs.select(F.least("ta", "tb").alias("token_a"), F.greatest("ta", "tb").alias("token_b"), "dist")


def group_lookup(tokens: DataFrame, groups: DataFrame, key: str = "pro_ids") -> DataFrame:
    """(key, token, group) for every token of every product."""
    exploded = explode_tokens(tokens, key)
    return exploded.join(groups.select("token", "group"), "token")


def group_members(groups: DataFrame) -> DataFrame:
    """Per group member: (group, exemplar, token, n_members).

    Long form on purpose: a group may hold a third of the vocabulary, so members
    are never gathered into one value; the count is a partial aggregate.
    """
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n_members"))
    return groups.select("group", "exemplar", "token").join(sizes, "group")


def product_groups(tokens: DataFrame, groups: DataFrame, key: str = "pro_ids") -> DataFrame:
    """Per product: its distinct groups, sorted, and how many (each counts once). Rows are moved to
    their product once, for the distinct step and for the list."""
    g = group_lookup(tokens, groups, key).select(key, "group").repartition(key).distinct()
    return (g.groupBy(key).agg(F.array_sort(F.collect_list("group")).alias("groups"))
            .withColumn("n_groups", F.size("groups")))


def stand_in_groups(vocab: DataFrame) -> DataFrame:
    """Deterministic SQL-checkable grouping: tokens sharing a consonant key form a
    group; the exemplar is the group's smallest token."""
    g = vocab.select("token", T.consonant_key(F.col("token")).alias("group")).where("group is not null")
    ex = g.groupBy("group").agg(F.min("token").alias("exemplar"))
    # each group has one exemplar: as a left join it is left out by plans that don't ask for exemplars
    return g.join(ex, "group", "left")
