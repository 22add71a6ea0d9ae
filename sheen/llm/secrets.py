"""Secret scans with an incremental blob ledger (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheen.llm.common import RID, scratch_path, with_row_id

#: Rules in the order in which kinds are listed: kind, pattern, group whose length counts, least length.
#: The first three are the base rules; every match of a pattern is found first, and short ones are dropped.
RULES = {
    1: (("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
        ("hex", r"[0-9a-f]{32,}", 0, 32)),
}
RULES[2] = (*RULES[1],
            ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
            ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1))
BASE_KINDS = ("assign", "access", "hex")
LATEST = 2


def scan_texts(blobs: DataFrame, version: int = LATEST) -> DataFrame:
    """(blob, spans) of (blob, t): spans (start, kind_no, end), code points, end exclusive.

    The text between the matches and the matches themselves, as two arrays of equal order,
    give each match its gap and its length; a running sum over a blob's matches of a kind
    turns them into positions. Patterns with ``{n,}`` at their end find the same long runs
    as the open pattern, since a run is matched from its first character on.
    """
    def found(no, pattern, group, least):
        p, t = F.lit(pattern), F.col("t")
        zipped = F.arrays_zip(F.split(t, pattern, -1).alias("gap"), F.regexp_extract_all(t, p, 0).alias("hit"),
                              F.regexp_extract_all(t, p, F.lit(group)).alias("part"))
        rows = F.transform(zipped, lambda x, i: F.struct(
            F.lit(no).alias("no"), i.alias("i"), F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["hit"]).alias("len"), (F.char_length(x["part"]) >= least).alias("ok")))
        return F.when(F.rlike(t, p), rows)

    none = F.array().cast("array<struct<no:int,i:int,gap:int,len:int,ok:boolean>>")
    found_all = F.concat(*[F.coalesce(found(no, *rule[1:]), none) for no, rule in enumerate(RULES[version])])
    rows = blobs.select("blob", F.explode_outer(F.filter(found_all, lambda x: x["len"].isNotNull())).alias("m"))
    rows = rows.select("blob", "m.*")
    w = Window.partitionBy("blob", "no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(w)
    rows = rows.withColumn("end", end).select(
        "blob", F.when(F.col("ok"), F.struct((F.col("end") - F.col("len")).alias("start"),
                                             F.col("no").alias("kind_no"), F.col("end"))).alias("s"))
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list("s")).alias("spans"))


def scan_versions(spark: SparkSession, versions: DataFrame, ledger: str, version: int = LATEST,
                  path: str = "path", text: str = "text") -> DataFrame:
    """(path, blob, spans) for every row of ``versions``, scanning only what is new.

    Each text is addressed by the SHA-256 of its content. The ledger, a Parquet folder of
    (blob, spans) partitioned by rule_version, says which pairs were scanned before, by any run: only
    unseen pairs are scanned, once each however many paths hold the blob, and appended.
    Findings are joined back to all paths. Rows without findings get an empty list.

    A run reads its own rule version's part of the ledger. Two runs at the same time may both append a blob; it
    is read once. Null text: like an empty one. Repeated rows: one result row each. Any path
    type, null paths included. Empty table: empty result and nothing appended. Extra columns are
    not read. Very long texts are scanned whole, each in one task.
    """
    v = versions.select(F.col(path).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn(
        "blob", F.sha2("t", 256))
    schema = "blob string, rule_version int, spans array<struct<start:bigint,kind_no:int,end:bigint>>"
    blobs = v.select("blob", "t").distinct()
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        seen = spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == version)
        blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
    new = scan_texts(blobs, version).select("blob", F.lit(version).alias("rule_version"), "spans")
    new.write.mode("append").partitionBy("rule_version").option("compression", "zstd").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger).where(
        (F.col("rule_version") == version) & (F.size("spans") > 0)).select("blob", "spans").dropDuplicates(["blob"])
    return v.select("p", "blob").join(known, "blob", "left").select(
        F.col("p").alias(path), "blob",
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")).alias("spans"))


def secret_digests(spark: SparkSession, docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document: counts of the base kinds and the span lists (see ``scan_versions``); without
    a ``ledger`` of earlier runs, a new one is filled."""
    docs = with_row_id(docs)
    found = scan_versions(spark, docs, ledger or scratch_path(spark, "ledger"), LATEST, RID)
    kinds = F.array(*[F.lit(r[0]) for r in RULES[LATEST]])
    n_base = len(BASE_KINDS)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(no):
        return F.size(F.filter("spans", lambda s: s["kind_no"] == no)).cast("long")

    base = F.filter("spans", lambda s: s["kind_no"] < n_base)
    ids = docs.select(RID, "doc_id")
    return ids.join(found, RID).select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
