"""Sources and sinks (§2.1): CSV ratings, per-category snapshots, clean table,
rating marts, model artifacts.

Every path is a folder in shared storage; the helper ``shared_path`` places
scratch output under the session's checkpoint folder, which on a cluster is the
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sheen.session import drop_unused_shuffles, ensure_checkpoint_dir

RATINGS_SCHEMA = "pro_ids INT, uid INT, lipies DOUBLE"


def shared_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sheen-io/{name}-{uuid.uuid4().hex}"


def sink_ratings_csv(ratings: DataFrame, path: str) -> str:
    """Ratings as CSV with a header, no index column."""
    ratings.select("pro_ids", "uid", "lipies").write.mode("overwrite").option("header", True).csv(path)
    return path


def scan_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the ratings CSV. The schema is given instead of inferred: inference
    would read the whole input once more before the job starts."""
    return spark.read.schema(RATINGS_SCHEMA).option("header", True).csv(path)


def scan_ratings(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The ratings CSV as (good rows, rejected lines). A line that doesn't have the schema's columns
    or types is kept as it is, with the reason; a missing key or rating is a reason too."""
    raw = (spark.read.schema(f"{RATINGS_SCHEMA}, line STRING").option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "line").csv(path))
    missing = F.col("pro_ids").isNull() | F.col("uid").isNull() | F.col("lipies").isNull()
    good = raw.where(F.col("line").isNull() & ~missing).drop("line")
    fields = F.size(F.split("line", ",", -1))
    reason = F.when(F.col("line").isNull(), "missing").when(fields != 3, "columns").otherwise("types")
    whole = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("pro_ids", "uid", "lipies")])
    return good, raw.where(F.col("line").isNotNull() | missing).select(F.coalesce("line", whole).alias("line"), reason.alias("reason"))


def sink_by_category(reviews: DataFrame, path: str, col: str = "cat_id") -> str:
    """One snapshot folder per category (Hive-style partitions). Categories that ``reviews`` holds
    are replaced; snapshots of other categories stay, so that one can be crawled again by itself."""
    reviews.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path)
    return path


def load_categories(spark: SparkSession, path: str, cat_ids: list[str] | None = None,
                    col: str = "cat_id") -> DataFrame:
    """All category snapshots as one table; ``cat_ids`` prunes partitions. The
    partition column stays a string (no type inference on '701')."""
    df = _read_string_parts(spark, path, col)
    if cat_ids:
        df = df.where(F.col(col).isin(cat_ids))
    return df


def _read_string_parts(spark: SparkSession, path: str, col: str = "cat_id") -> DataFrame:
    """Snapshots with the partition column as a string, by an explicit schema: the columns of
    the files, whose types are theirs, plus ``col``."""
    found = spark.read.parquet(path).schema
    schema = StructType([StructField(f.name, StringType() if f.name == col else f.dataType) for f in found])
    return spark.read.schema(schema).parquet(path)


def save_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to scratch and read from there, compressed by columns: rows of texts take
    several times as much in a checkpoint, which holds them as they are in memory. The shuffles that made
    them are not needed any more and go."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    drop_unused_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_kept(df: DataFrame) -> None:
    """Delete the files of ``kept`` rows that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, path = _fs(df.sparkSession, folder)
        fs.delete(path, True)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ratings_marts(reviews_uid: DataFrame, path: str) -> dict[str, str]:
    """Two rating tables: with and without the review text."""
    paths = {"prod_ratings": f"{path}/prod_ratings", "prod_ratings_no_rev": f"{path}/prod_ratings_no_rev"}
    save_table(reviews_uid.select("pro_ids", "lipies", "uid", "reviews"), paths["prod_ratings"])
    save_table(reviews_uid.select("pro_ids", "lipies", "uid"), paths["prod_ratings_no_rev"])
    return paths


#: A scan is spread if its longest task has more than so many times a core's share of the rows.
UNEVEN = 1.25


def spread_files(df: DataFrame, path: str) -> DataFrame:
    """``df`` unless one task of its scan would read more than ``UNEVEN`` times a core's share of the
    rows; then a copy in several files a core, written as the rows are read (no shuffle), because
    work that is done where rows are read runs in as many tasks as the files give. The rows of
    the tasks are counted (from the files' footers): a file splits into many tasks, but a row
    group is read by one of them and the others get nothing. Large tables have many row groups and
    are read as they are."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if not _fs(spark, path)[0].exists(_fs(spark, f"{path}/_SUCCESS")[1]):
        n = F.count(F.lit(1)).alias("n")
        total, most = df.groupBy(F.spark_partition_id().alias("task")).agg(n).agg(F.sum("n"), F.max("n")).first()
        if total and most * cores <= UNEVEN * total:
            return df
        rows = max(1, -(-(total or 0) // (4 * cores)))
        df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ----------------------------------------------------------------------------- artifacts
# A set of artifacts is a folder with one sub-folder per version and one manifest per
# complete version. The manifest is written last and renamed into place, so a set that was
# only half written is never loaded, and readers of an older version are not disturbed.

_MANIFEST = "manifest-"
#: Where the classes of models that are loaded may be.
MODELS = ("pyspark.ml.", "sheen.operators.transformers")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def save_artifacts(spark: SparkSession, path: str, tables: dict[str, DataFrame], models: dict | None = None,
                   about: dict | None = None) -> str:
    """Persist a set of artifacts below ``path``: tables as Parquet, Spark ML models by their own
    writer, then a manifest that names them, their schemas and classes, and ``about``.
    Returns the version."""
    version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"
    manifest = {"version": version, "about": about or {}, "tables": {}, "models": {}}
    for name, df in tables.items():
        save_table(df, f"{path}/{version}/{name}")
        manifest["tables"][name] = df.schema.jsonValue()
    for name, m in (models or {}).items():
        m.write().overwrite().save(f"{path}/{version}/{name}")
        manifest["models"][name] = f"{type(m).__module__}.{type(m).__name__}"
    fs, temp = _fs(spark, f"{path}/.{version}.json")
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(temp, _fs(spark, f"{path}/{_MANIFEST}{version}.json")[1]):
        raise OSError(f"the manifest of {path}/{version} can't be put in place")
    return version


def latest_manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest complete version's manifest, None if there is none."""
    fs, pattern = _fs(spark, f"{path}/{_MANIFEST}*.json")
    found = fs.globStatus(pattern) or []
    names = sorted(str(f.getPath().toString()) for f in found)
    if not names:
        return None
    return json.loads(spark.read.text(names[-1], wholetext=True).first()[0])


def load_artifacts(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, object]:
    """Tables and models of the newest complete version, or those of ``names``. Tables are read
    by the manifest's schema, without a look at their files."""
    manifest = latest_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no complete set of artifacts in {path}")
    base, out = f"{path}/{manifest['version']}", {}
    for name, schema in manifest["tables"].items():
        if names is None or name in names:
            out[name] = spark.read.schema(StructType.fromJson(schema)).parquet(f"{base}/{name}")
    for name, kind in manifest["models"].items():
        if names is None or name in names:
            module, _, cls = kind.rpartition(".")
            if not module.startswith(MODELS):
                raise ValueError(f"{name} is no known model: {kind}")
            out[name] = getattr(importlib.import_module(module), cls).load(f"{base}/{name}")
    if missing := set(names or []) - set(out):
        raise KeyError(f"{path} has no {sorted(missing)}")
    return out


def input_key(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """Names the present contents of input tables: their paths, sizes, file counts and times."""
    marks = []
    for t in sorted(tables):
        fs, p = _fs(spark, f"{sf_dir}/{t}.parquet")
        size = fs.getContentSummary(p)
        marks.append((str(fs.makeQualified(p).toString()), size.getLength(), size.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return hashlib.sha256(json.dumps(marks).encode()).hexdigest()[:24]


def fitted(spark: SparkSession, sf_dir: str, kind: str, tables: list[str], fit) -> dict[str, object]:
    """The artifacts that ``fit()`` (a pair of dicts: tables, models) makes of these input tables.
    They are fitted once, kept in the session's shared folder, and loaded from then on; other
    contents of the input are another set."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheen-artifacts/{kind}-{input_key(spark, sf_dir, tables)}"
    if latest_manifest(spark, path) is None:
        frames, models = fit()
        save_artifacts(spark, path, frames, models, {"kind": kind, "input": sf_dir})
    return load_artifacts(spark, path)
