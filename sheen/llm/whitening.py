"""Embedding whitening: principal components of the distinct vectors, with unit variance.

Equal vectors are one row of the fit list, weighted by one or by how often they occur. The
covariance is a sum of matrix products of centred blocks, one product for each Arrow batch.
Every distinct vector is whitened once and joined back to the rows that hold it.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheen.llm.common import frozen

#: Grid of the fit: a component c becomes the integer floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that are returned, at most.
COMPONENTS = 16
#: A finite entry whose grid point is beyond this has no exact double; its row goes like one that isn't finite.
LARGEST = float(1 << 52)
#: An eigenvalue below this share of the trace is rounding, not variance.
NO_VARIANCE = 1e-12
_LOW = 26


def grid_vectors(vectors: DataFrame, vec: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The rows whose vector is not null, not empty and finite throughout, with ``x``: its
    components as integers floor(scale * c) + shift, and ``h``, a hash of ``x``."""
    c = F.col("__v__")
    odd = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e * F.lit(float(scale))) > LARGEST))
    rows = vectors.withColumn("__v__", F.col(vec).cast("array<double>")).where(c.isNotNull() & (F.size(c) > 0) & ~odd)
    x = F.transform(c, lambda e: F.floor(e * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long"))
    return rows.withColumn("x", x).withColumn("h", F.xxhash64("x")).drop("__v__")


def _rows(column, dtype) -> np.ndarray:
    """A list column of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)


def _sums(fit: DataFrame, dims: int) -> list[int]:
    """Exact weighted sum of ``x`` in every dimension: ``dims`` numbers reach the driver."""
    def run(batches):
        high, low = [0] * dims, [0] * dims
        for b in batches:
            x, w = _rows(b.column(0), np.int64), b.column(1).to_numpy()[:, None]
            high = [p + int(q) for p, q in zip(high, (w * (x >> _LOW)).sum(axis=0))]
            low = [p + int(q) for p, q in zip(low, (w * (x & ((1 << _LOW) - 1))).sum(axis=0))]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()), "s": pa.array(
            [Decimal((p << _LOW) + q) for p, q in zip(high, low)], pa.decimal128(38, 0))})

    total = fit.select("x", "w").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    found = {r["i"]: int(r["s"]) for r in total.collect()}
    return [found.get(i, 0) for i in range(dims)]


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where they suffice, else Python's."""
    if n * max(float(np.abs(x).max(initial=0)), 1.0) < 2.0 ** 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(y: np.ndarray) -> pa.Array:
    """Sum of squares of each row, exact; null beyond 38 digits."""
    if y.dtype != object and float((y.astype(float) ** 2).sum(axis=1).max(initial=0)) < 2.0 ** 62:
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = [sum(int(v) * int(v) for v in row) for row in y]
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], pa.decimal128(38, 0))


def _covariance(rows: DataFrame, dims: int, n: int, centred) -> np.ndarray:
    """Weighted covariance, divisor n, of the rows (values, w); ``centred`` subtracts the mean from
    a block first. A task sums the products of its blocks and emits the cells of the upper
    triangle, which Spark adds up: dims * (dims + 1) / 2 numbers reach the driver."""
    i, j = np.triu_indices(dims)

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            y = centred(b.column(0))
            total += y.T @ (b.column(1).to_numpy()[:, None] * y)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(i), dtype=np.int32)), "v": pa.array(total[i, j])})

    cells = rows.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((dims, dims))
    k = cells["cell"].to_numpy(np.int64)
    out[i[k], j[k]] = out[j[k], i[k]] = cells["v"].to_numpy(float) / n
    return out


def fit_whitening(fit: DataFrame, dims: int, components: int = COMPONENTS):
    """(n, S, directions, eigenvalues, trace) of the fit rows (x, w): the total weight, the exact
    sums, and the eigenvectors of the covariance as columns, by falling eigenvalue. Of either
    sign the one whose largest entry is positive is taken. A matrix of dims * dims numbers is
    all that the driver holds."""
    n = int(fit.agg(F.sum("w")).first()[0])
    sums = _sums(fit, dims)

    def centred(column):
        return _offsets(_rows(column, np.int64), n, sums).astype(float) / n

    v = _covariance(fit.select("x", "w"), dims, n, centred)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    big = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0)
    return n, sums, vectors * np.where(big < 0, -1.0, 1.0), values, float(np.trace(v))


def whiten(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id", weight: str = "one",
           components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row for each row of ``vectors`` with a usable vector: ``key``, n long (total weight of
    the fit list), deviation decimal(38,0) (sum over dimensions of (n * x - S)^2, exact),
    whitened array<double>, explained array<double>, identity_error double.

    ``weight``: "one" fits every distinct vector once, "count" as often as it occurs. Component
    k's entry of ``whitened`` is x minus the mean, along the covariance's k-th eigenvector, over
    the root of its eigenvalue; ``explained`` is the eigenvalue's share of the trace.
    identity_error is the largest absolute entry of the whitened rows' covariance minus the
    identity. All vectors have as many entries of both arrays: ``components``, or one for each
    dimension if these are fewer.

    Rows whose vector is null, empty, or holds null, NaN, infinite or unrepresentable entries
    (``LARGEST``) are not returned. Vectors must have one length: of several, that of most rows
    counts (of equals, the longest) and the others are not returned. A component without
    variance (fewer distinct vectors than components) has a null ``whitened`` entry, 0 as
    explained, and no part in identity_error. Repeated rows, null and repeated keys: one output
    row each. Empty table: empty result. Other columns are not read. The driver holds one
    matrix of dimensions squared, whatever the number of rows.
    """
    if weight not in ("one", "count"):
        raise ValueError(f"weight is 'one' or 'count', not {weight!r}")
    rows = grid_vectors(vectors.select(F.col(key).alias("id"), F.col(vec).alias("v")), "v", scale, shift)
    groups = frozen(rows.groupBy("h", "x").agg(F.count(F.lit(1)).alias("times")), "vectors")
    sizes = groups.groupBy(F.size("x").alias("d")).agg(F.sum("times").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dims = sizes["d"] if sizes else 0
    fit = groups.where(F.size("x") == dims).withColumn("w", F.lit(1).cast("long") if weight == "one" else F.col("times"))
    schema = "n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not dims:
        return rows.select(F.col("id").alias(key)).limit(0).selectExpr(
            key, *[f"cast(null as {t.split(' ', 1)[1]}) {t.split(' ', 1)[0]}" for t in schema.split(", ")])
    n, sums, directions, values, trace = fit_whitening(fit, dims, components)
    some = values > NO_VARIANCE * trace if trace > 0 else np.zeros(len(values), bool)
    project = directions[:, some] / np.sqrt(values[some])
    explained = [float(e) / trace if ok else 0.0 for e, ok in zip(values, some)]
    at = np.flatnonzero(some)

    def run(batches):
        for b in batches:
            y = _offsets(_rows(b.column(1), np.int64), n, sums)
            z = (y.astype(float) / n) @ project
            full = np.full((len(b), len(values)), np.nan)
            full[:, at] = z
            flat = pa.array(full.ravel(), from_pandas=True)  # NaN as null: no variance there
            yield pa.RecordBatch.from_pydict({
                "h": b.column(0), "x": b.column(1), "w": b.column(2), "deviation": _squares(y),
                "whitened": pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1) * len(values), pa.int32()), flat)})

    done = frozen(fit.select("h", "x", "w").mapInArrow(
        run, "h long, x array<long>, w long, deviation decimal(38,0), whitened array<double>"), "whitened")
    error = _identity_error(done.select("whitened", "w"), n, at)
    model = done.select("h", "x", "deviation", "whitened")
    return (rows.select("id", "h", "x").join(model, ["h", "x"])
            .select(F.col("id").alias(key), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*[F.lit(e) for e in explained]).alias("explained"), F.lit(error).alias("identity_error")))


def _identity_error(done: DataFrame, n: int, at: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the components ``at`` minus the identity."""
    if not len(at):
        return 0.0

    def block(column):
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        return flat.reshape(len(column), -1)[:, at]

    def run(batches):
        total = np.zeros(len(at))
        for b in batches:
            total += (b.column(1).to_numpy()[:, None] * block(b.column(0))).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(at)), pa.int32()), "s": pa.array(total)})

    sums = done.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    mean = np.zeros(len(at))
    for r in sums:
        mean[r["i"]] = r["s"] / n
    return float(np.abs(_covariance(done, len(at), n, lambda c: block(c) - mean) - np.eye(len(at))).max())


def component_rows(whitened: DataFrame, key: str = "vec_id") -> DataFrame:
    """``whiten``'s rows in long form: one for each component, numbered from 1."""
    return (whitened.select(key, "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("p", "whitened"))
            .select(key, (F.col("p") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get("explained", F.col("p")).alias("explained"), "identity_error"))
