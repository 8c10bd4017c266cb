"""Whitening of embeddings: exact cross-products from bit planes, centred as integers before the eigenvectors are taken."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
PLANE_BITS = 1 << 26  # bits of all planes of a block
LIMB = 10 ** 18
LARGEST = 2.0 ** 55  # entries from here on have no x as long


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of every two columns of ``x`` (rows, columns) of long, as an object array of ints.

    Each column less its least value is cut into bit planes, and each plane is packed across rows into 64-bit words. With planes a
    and b, popcount(a & b) << (a + b) summed over all pairs of planes is the sum of products; the least values are added back.
    """
    rows, columns = x.shape
    least = x.min(axis=0)
    y = (x - least).astype(np.uint64)  # the difference of two longs fits, also where it wraps
    bits = max(1, int(y.max()).bit_length())
    words = -(-rows // 64)
    planes = np.zeros((columns, bits, words), np.uint64)
    for b in range(bits):
        packed = np.packbits(((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
        padded = np.zeros((words * 8, columns), np.uint8)
        padded[:len(packed)] = packed
        planes[:, b] = np.ascontiguousarray(padded.T).view(np.uint64)
    small = 2 * bits + rows.bit_length() + 1 < 63
    weight = np.array([1 << b for b in range(bits)], dtype=np.int64 if small else object)
    products = np.zeros((columns, columns), np.int64 if small else object)
    for i in range(columns):
        for a in range(bits):
            counts = np.bitwise_count(planes[i:] & planes[i, a]).sum(axis=2, dtype=np.int64)
            products[i, i:] += ((counts if small else counts.astype(object)) @ weight) * weight[a]
    ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64)
    sums = ones.astype(object) @ weight.astype(object)
    products = products.astype(object)
    products = np.triu(products) + np.triu(products, 1).T
    low = least.astype(object)
    return products + low[:, None] * sums[None, :] + sums[:, None] * low[None, :] + rows * low[:, None] * low[None, :]


class Whitening:
    """What a fit gives: n, exact sums per dimension, eigenvalues by falling size, eigenvectors as columns, the exact trace."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray):
        self.n, self.sums = n, sums
        total = np.array(sums, dtype=object)
        self.scaled = n * products - total[:, None] * total[None, :]  # n * n times the covariance
        covariance = (self.scaled / (n * n)).astype(np.float64)
        value, vector = np.linalg.eigh(covariance)
        self.values, self.vectors = value[::-1].copy(), vector[:, ::-1].copy()
        noise = len(sums) * 2.0 ** -52 * max(float(self.values[0]), 0.0)
        self.used = self.values > noise  # directions in which the rows vary
        self.trace = float(sum(self.scaled.diagonal()) / (n * n))

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as long where that fits, else as objects."""
        largest = max(abs(int(x.max())), abs(int(x.min())))
        if self.n * largest + max(map(abs, self.sums)) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2 per row, exact."""
        t = self.apart(x)
        if t.dtype == object:
            return (t * t).sum(axis=1).tolist()
        if int(np.abs(t).max()) ** 2 * t.shape[1] < 1 << 63:
            return (t * t).sum(axis=1).tolist()
        t = np.abs(t)
        limbs = [t >> 42, (t >> 21) & 0x1FFFFF, t & 0x1FFFFF]
        a, b, c = limbs
        parts = [(p.sum(axis=1), s) for p, s in ((a * a, 84), (2 * a * b, 63), (2 * a * c + b * b, 42), (2 * b * c, 21), (c * c, 0))]
        return sum(p.astype(object) << s for p, s in parts).tolist()

    def project(self, x: np.ndarray, most: int) -> np.ndarray:
        """Whitened rows: (x - S / n) on each of the first ``most`` components over sqrt(e); NaN where nothing varies."""
        centred = (self.apart(x) / self.n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred @ self.vectors[:, :most] / np.sqrt(np.maximum(self.values[:most], 0))
        out[:, ~self.used[:most]] = np.nan
        return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and x = floor(64 * entry) + 1000000 as array of long, without rows whose vector is null, empty or holds null or non-finite entries."""
    rows = vectors.select(vectors[id].alias("id"), vectors[vector].cast("array<double>").alias("v"))
    whole = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    return rows.where(F.col("v").isNotNull() & whole).select(
        "id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def fit(distinct: DataFrame, d: int, column: str = "x") -> Whitening | None:
    """From rows of arrays of ``d`` longs, each row counted; None without rows.

    A task adds a column of ones, so that sums and the count are products as well, and returns one row for every two columns, whatever
    the number of its rows; the driver gets their sums, (d + 1)(d + 2) / 2 rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, parts, size, most = None, [], 0, 1 << 16

        def added():
            x = np.concatenate(parts)
            found = scatter(np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
            return found if total is None else total + found

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"], d)
            for at in range(0, len(x), 1 << 13):
                parts.append(x[at:at + (1 << 13)])
                size += len(parts[-1])
                width = max(1, int(parts[-1].max() - parts[-1].min()).bit_length())
                most = min(most, max(64, PLANE_BITS // (width * (d + 1))))
                if size >= most:
                    total, parts, size = added(), [], 0
        if parts:
            total = added()
        if total is None:
            return
        i, j = np.triu_indices(d + 1)
        value = total[i, j].tolist()
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(v // LIMB) for v in value], kind),
             pa.array([Decimal(v % LIMB) for v in value], kind)], names=["i", "j", "high", "low"])

    parts = distinct.select(F.col(column).alias("x")).mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow().to_pylist()
    if not rows:
        return None
    whole = np.zeros((d + 1, d + 1), dtype=object)
    for r in rows:
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = int(r["high"]) * LIMB + int(r["low"])
    return Whitening(whole[d, d], whole[d, :d].tolist(), whole[:d, :d])


def identity_error(distinct: DataFrame, model: Whitening, d: int, components: int, column: str = "x") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    used = np.flatnonzero(model.used[:components])
    if not len(used):
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(used), len(used)))
        for batch in batches:
            if batch.num_rows:
                w = model.project(_matrix(batch["x"], d), components)[:, used]
                total += w.T @ w
        i, j = np.triu_indices(len(used))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    sums = distinct.select(F.col(column).alias("x")).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return max(abs(r.s / model.n - (r.i == r.j)) for r in sums.collect())


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: ``id``, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    Entries become x = floor(64 * entry) + 1000000. Rows whose vector is null, empty, holds a null, NaN or infinite entry or one of
    2 ** 55 or more (which has no x as long) are dropped; so are rows of another length than the most frequent one (of two, the
    longer). The fit takes each distinct x vector once: repeated rows change nothing, and all of them are returned, as are rows with
    null or repeated ids. An empty table gives no rows. Vectors of d < ``components`` entries have d components. A component
    along which the fitted rows do not vary (one distinct row has no other) has explained 0 and a null whitened value.

    Only distinct x vectors are shuffled, combined in each task first, so a very common vector is one row per task. The driver gets
    sums over the dimensions; their number does not depend on the rows.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id]
    rows = usable(vectors, id, vector)
    fields = (f"`{id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], fields)
    d = sizes[0].d
    rows = rows.where(F.size("x") == d)
    distinct = written(rows.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, d)
    most = min(components, d)
    error = identity_error(distinct, model, d, most)
    discard(distinct)
    share = np.where(model.used[:most], model.values[:most] / model.trace if model.trace else 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"], d)
            count = len(x)
            each = pa.array(np.repeat(np.arange(count), most))
            white = model.project(x, most).reshape(-1)
            deviation = pa.array([Decimal(v) for v in model.deviations(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch["key"].take(each), pa.array(np.tile(np.arange(1, most + 1), count), pa.int32()),
                 pa.array(np.full(count * most, model.n, np.int64)), deviation.take(each), pa.array(white, mask=np.isnan(white)),
                 pa.array(np.tile(share, count)), pa.array(np.full(count * most, error))],
                names=[id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("id").alias("key"), "x").mapInArrow(run, fields)
