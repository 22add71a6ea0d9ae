"""Shared pieces of the training-data operators: row ids, frozen tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from sheen.session import ensure_checkpoint_dir, table

#: Row id column that ``with_row_id`` adds; a table must not use this name itself.
RID = "__rid__"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def frozen(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, and values such as
    ``monotonically_increasing_id`` cannot change between two uses.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a frozen table that a newer one has replaced."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add a unique long ``RID`` whose order is the order of ``key`` (nulls first).

    Where ``key`` is unique and never null it is the row id itself. Otherwise rows are
    sorted by key, then text, numbered, and the numbered copy is frozen, so repeated
    rows stay separate rows in every later pass.
    """
    if RID in docs.columns:
        return docs
    repeated = (docs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                .where((F.col("n") > 1) | F.col(key).isNull()).limit(1).count())
    if not repeated:
        return docs.withColumn(RID, F.col(key).cast("long"))
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = (docs.repartitionByRange(n, F.col(key), F.xxhash64(text))
                .sortWithinPartitions(F.col(key), F.xxhash64(text), F.col(text))
                .withColumn(RID, F.monotonically_increasing_id()))
    return frozen(numbered, "rows")


def running_offsets(df: DataFrame, by: list[str], order: list, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the earlier rows of ``by`` (for small per-group tables)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def ranked(df: DataFrame, order: list, out: str) -> DataFrame:
    """Rows numbered 0, 1, ... in ``order``, without a window over all rows.

    Rows are range-partitioned and numbered inside their partition, frozen, and shifted
    by the row counts of the earlier partitions (one row per partition).
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tagged = frozen(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("__mid__", F.monotonically_increasing_id()), "ranked")
    tagged = (tagged.withColumn("__pid__", F.shiftright("__mid__", 33))
              .withColumn("__pos__", F.col("__mid__").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = tagged.groupBy("__pid__").agg(F.count(F.lit(1)).alias("__n__"))
    w = Window.orderBy("__pid__").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__pid__", F.coalesce(F.sum("__n__").over(w), F.lit(0)).alias("__off__"))
    return (tagged.join(sizes, "__pid__")
            .withColumn(out, F.col("__off__") + F.col("__pos__"))
            .drop("__mid__", "__pid__", "__pos__", "__n__", "__off__"))


#: Edges of a part file of the tables that the component rounds write.
EDGES_A_FILE = 200_000


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b long): rows (id, component), the component
    being the smallest id reachable. Ids without an edge are not returned.

    Alternating large-star and small-star rounds. A round deals the edges by node, sorts a
    node's neighbours, and reads them as a running minimum, so a node that holds many of the
    edges needs no memory; it writes the new edges in the shared folder and counts those that
    changed. The table of the round before is deleted.
    """
    def written(df, changed, files):
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(changed.cast("long")), F.lit(0)).alias("c"))
        out = frozen((df.coalesce(files) if files else df).select("v", "u"), "edges")
        return out, seen.get["n"], seen.get["c"]

    def star(cur, large, n):
        near = cur.select(F.col("v").alias("x"), F.col("u").alias("y"))
        if large:
            near = near.union(cur.select(F.col("u").alias("x"), F.col("v").alias("y")))
        w = Window.partitionBy("x").orderBy("y")
        rows = near.select("x", "y", F.min("y").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                           F.lag("y").over(w).alias("p")).where("p is null or p <> y")
        if large:
            m = F.least("x", "m")
            rows = rows.where("y > x").select(F.col("y").alias("v"), m.alias("u"), (m != F.col("x")).alias("c"))
        else:
            first = F.col("p").isNull()
            rows = rows.select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("v"), F.col("m").alias("u"), (~first).alias("c"))
        return written(rows, F.col("c"), max(4, -(-n // EDGES_A_FILE)))

    start = (edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    cur, n, _ = written(start, F.lit(False), None)
    while n:
        wide, n, moved = star(cur, True, n)
        forget(cur)
        cur, n, more = star(wide, False, n)
        forget(wide)
        if not moved and not more:
            break
    roots = cur.select(F.col("u").alias("id")).distinct()
    return (cur.select(F.col("v").alias("id"), F.col("u").alias("component"))
            .union(roots.select("id", F.col("id").alias("component"))))
