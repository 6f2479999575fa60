"""Embedding whitening from distinct vectors and their multiplicities.

Vectors are mapped to whole numbers, and equal ones grouped: each distinct vector
is held once, with how many rows have it. Sums are exact whole numbers; the
covariance is the sum over tasks of a weighted product of centred vectors, and
each distinct vector is whitened once, then joined back to its rows. The driver
sees sums and products of dimensions only, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import sliced, stored

SCALE = 1024
OFFSET = 100_000
#: Whole numbers up to this size are mapped exactly; vectors with larger entries take no part.
LARGEST = 2**52


def _free(names: list[str], name: str) -> str:
    while any(name.lower() == n.lower() for n in names):
        name = "_" + name
    return name


def whole_vectors(vector: Column) -> Column:
    """floor(1024 * c) + 100000 of every entry; null if one is missing, not finite or too large, or there are none."""
    entries = vector.cast("array<double>")
    usable = (F.size(entries) > 0) & F.forall(entries, lambda c: F.coalesce(F.abs(c) < LARGEST // SCALE, F.lit(False)) & ~F.isnan(c))
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * SCALE).cast("long") + OFFSET))


def _lists(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _summed(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Fit weights in all, and the weighted sum of each dimension, both exact."""
    parts = distinct.select("weight", F.posexplode("x").alias("i", "v")).groupBy("i")
    rows = parts.agg(F.sum("weight").alias("n"), F.sum(F.col("v").cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")).alias("s")).collect()
    sums = {r["i"]: int(r["s"]) for r in rows}
    return int(rows[0]["n"]), [sums[i] for i in range(dims)]


def _product(vectors: DataFrame, center: np.ndarray, divisor: int, width: int) -> np.ndarray:
    """The weighted covariance about center of the column v (array<double>): each task gives one product, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in sliced(batches, 8192):
            x = _lists(part.column(0)).astype(np.float64) - center
            weight = np.asarray(part.column(1)).astype(np.float64)
            product = (x * weight[:, None]).T @ x
            total = product if total is None else total + product
        if total is not None:
            i, j = np.triu_indices(width)
            arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "s"])

    rows = vectors.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((width, width))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / divisor
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S)**2 of each row, exact; null where a long can't hold it."""
    total = np.array(sums, dtype=object)
    low, high = x.min(axis=0).astype(object) * n - total, x.max(axis=0).astype(object) * n - total
    if max(int(np.abs(x).max()) * n, max(abs(s) for s in sums)) < 2**62 and sum(max(a * a, b * b) for a, b in zip(low, high, strict=True)) < 2**63:
        apart = x * n - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((int(v) * n - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [d if d < 2**63 else None for d in exact]


def whiten(
    vectors: DataFrame,
    components: int = 8,
    weighted: bool = True,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row for each usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    An entry c counts as x = floor(1024 * c) + 100000. Components are unit eigenvectors
    of the covariance of all x-vectors (weighted=False: of the distinct ones), by
    falling eigenvalue; whitened is the centred vector's part along it, over the root
    of the eigenvalue. explained is the eigenvalue's share of the trace, deviation the
    sum over dimensions of (n * x - S)**2 (null beyond 64 bits), identity_error how
    far the covariance of whitened is from the identity at most.

    Rows take no part whose vector is null, empty, or holds null, NaN, infinite entries
    or ones of 2**42 and more, nor those of another length than most rows have (of
    equal ones the longest). Null and repeated ids, and repeated rows, pass as they are.
    Components without spread, under 1e-12 of the largest eigenvalue, are left out; so
    equal vectors, one vector, or none at all give no rows. Other columns are not read.
    """
    schema = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    key = _free(["x", "h"], id_col)
    mapped = vectors.select(F.col(f"`{id_col}`").alias(key), whole_vectors(F.col(f"`{vector_col}`")).alias("x")).where(F.col("x").isNotNull())
    length = mapped.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    none = vectors.sparkSession.createDataFrame([], schema)
    if length is None:
        return none
    dims = length["d"]
    # A hash in front of the vector lets sorts and joins compare one number first.
    mapped = mapped.where(F.size("x") == dims).withColumn("h", F.xxhash64("x"))
    distinct = mapped.groupBy("h", "x").agg((F.count(F.lit(1)) if weighted else F.lit(1)).cast("long").alias("weight"))
    distinct = stored(distinct, "distinct")
    n, sums = _summed(distinct, dims)
    # Whole part and rest of the mean apart, so that large offsets cost no digits.
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    covariance = _product(
        distinct.select(F.zip_with("x", F.array(*[F.lit(int(w)) for w in whole]), lambda a, b: (a - b).cast("double")).alias("v"), "weight"), rest, n, dims
    )
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    spread = (values > 0) & (values > 1e-12 * max(values[0], 0))
    values, axes = values[spread], axes[:, spread]
    if not len(values):
        return none
    # The same sign in every run: the largest entry of a component is positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))])
    onto = axes / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, 8192):
            x = _lists(part.column(1))
            white = ((x - whole) - rest) @ onto
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64()))
            columns = [part.column(0), part.column(1), part.column(2), lists, pa.array(_deviations(x, n, sums), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "x", "weight", "v", "deviation"])

    shape = "h long, x array<long>, weight long, v array<double>, deviation long"
    white = stored(distinct.select("h", "x", "weight").mapInArrow(run, shape), "white")
    again = white.select("v", "weight")
    mean = again.select("weight", F.posexplode("v").alias("i", "c")).groupBy("i").agg((F.sum(F.col("c") * F.col("weight")) / n).alias("m")).collect()
    center = np.zeros(len(values))
    for r in mean:
        center[r["i"]] = r["m"]
    error = float(np.abs(_product(again, center, n, len(values)) - np.eye(len(values))).max())
    share = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values])
    rows = mapped.join(white.select("h", "x", "v", "deviation"), ["h", "x"]).select(key, "deviation", F.posexplode("v").alias("at", "whitened"))
    return rows.select(
        F.col(key).alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
