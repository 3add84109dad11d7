"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers x = floor(256 * c).  Every distinct x vector counts
once in the fit.  A task shifts each dimension by its least value and packs
the bit planes of what is left across rows into 64-bit words; the number of
rows in which plane a of dimension i and plane b of dimension j are both set
is a popcount of their AND, and the sums of these counts weighted by 2**(a+b)
are the cross-products, exactly.  Tasks hand on only sums (in 32-bit limbs,
added up by Spark), so what the driver gets is one matrix of dimension x
dimension whatever the number of rows.  It is centred as integers,
n * sum(x_i x_j) - S_i S_j, before the eigendecomposition.

Edge cases: rows whose vector is null, empty or holds a null or non-finite
entry are dropped, and so are rows whose vector has another length than most
(on ties the longer length counts); entries of 2**53 and beyond count as
2**53 (with their sign); repeated rows each get their rows of the result, a
null vec_id stays null; other columns are ignored.  Components whose
eigenvalue is zero to rounding can't be scaled to variance one and are left
out, so an empty table, or one with a single distinct vector, gives no rows.
A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import bounded_batches, cut

SCALE = 256.0
MOST = float(1 << 61)       # |x| at most: shifted values fit a long
COMPONENTS = 4
BLOCK_CELLS = 1 << 20       # integers whose planes are multiplied at a time
LIMB = 32                   # bits of the pieces in which sums leave a task


def _flat(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values as doubles, bounds, usable) of an Arrow list column: a usable
    vector is not null, not empty and all finite."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    values = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (bad[bounds[1:]] == bad[bounds[:-1]]) & (np.diff(bounds) > 0)
    if column.null_count:
        usable &= ~column.is_null().to_numpy(zero_copy_only=False)
    return values, bounds, usable


def integer_rows(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): positions of the usable vectors of ``width`` entries and
    their integers, one row each."""
    values, bounds, usable = _flat(column)
    rows = np.flatnonzero(usable & (np.diff(bounds) == width))
    at = bounds[rows][:, None] + np.arange(width)
    with np.errstate(over="ignore"):
        return rows, np.clip(np.floor(SCALE * values[at]), -MOST, MOST).astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes, of the least width that holds it: equal rows, equal bytes."""
    most = np.abs(x).max(axis=1)
    out: list[bytes] = [b""] * len(x)
    for kind, low, high in (("<i2", 0, 1 << 15), ("<i4", 1 << 15, 1 << 31), ("<i8", 1 << 31, 1 << 63)):
        at = np.flatnonzero((most >= low) & (most < high))
        for i, row in zip(at.tolist(), x[at].astype(kind)):
            out[i] = row.tobytes()
    return out


def unpacked(column, width: int) -> np.ndarray:
    data = column.to_pylist()
    x = np.empty((len(data), width), np.int64)
    kinds = {2 * width: "<i2", 4 * width: "<i4", 8 * width: "<i8"}
    for size, kind in kinds.items():
        at = [i for i, b in enumerate(data) if len(b) == size]
        if at:
            x[at] = np.frombuffer(b"".join(data[i] for i in at), kind).reshape(len(at), width)
    return x


def bit_sliced_products(u: np.ndarray) -> np.ndarray:
    """sum over rows of u_i * u_j (i <= j) for non-negative integers ``u``
    (rows x dimensions), as Python integers: weighted AND-popcounts of bit
    planes that are packed across rows."""
    rows, dims = u.shape
    bits = np.array([int(v).bit_length() for v in u.max(axis=0)])
    live = np.flatnonzero(bits)
    start = np.concatenate([[0], np.cumsum(bits[live])])   # first plane of each live dimension
    words = np.zeros((start[-1], -(-rows // 64)), np.uint64)
    weight = []
    for k, d in enumerate(live):
        for b in range(bits[d]):
            plane = np.packbits((u[:, d] >> b & 1).astype(np.uint8))
            words[start[k] + b].view(np.uint8)[:len(plane)] = plane
            weight.append(1 << b)
    # 2**(a+b) * count fits a long only for few bits: Python integers otherwise
    kind = np.int64 if 2 * int(bits.max(initial=0)) + rows.bit_length() < 63 else object
    weight = np.array(weight, kind)
    out = np.zeros((dims, dims), kind)
    for k, d in enumerate(live):
        s = start[k]
        for p in range(s, start[k + 1]):
            count = np.bitwise_count(words[p] & words[s:]).sum(axis=1, dtype=np.int64).astype(kind)
            out[d, live[k:]] += weight[p] * np.add.reduceat(count * weight[s:], start[k:-1] - s)
    return out.astype(object)


def scatter(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, cross-products for i <= j) of integer rows, exact Python integers."""
    n, low = len(x), x.min(axis=0)
    u = x - low
    wide = int(u.max()).bit_length() + n.bit_length() >= 63
    total, low = (u.astype(object) if wide else u).sum(axis=0).astype(object), low.astype(object)
    cross = bit_sliced_products(u) + np.outer(low, total) + np.outer(total, low) + n * np.outer(low, low)
    return n, total + n * low, cross


def _limbs(i: np.ndarray, j: np.ndarray, value) -> Iterator[tuple[int, int, int, int]]:
    for a, b, v in zip(i.tolist(), j.tolist(), value):
        sign, v, k = (1, int(v), 0) if v >= 0 else (-1, -int(v), 0)
        while v:
            yield a, b, k, sign * (v & (1 << LIMB) - 1)
            v >>= LIMB
            k += 1


@dataclass
class Whitening:
    """n vectors of the fit, their sums, the components (columns, by falling
    eigenvalue), the eigenvalues and the trace."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows."""
        mean = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s - s // self.n * self.n) / self.n for s in self.sums])
        return (((x - mean).astype(np.float64) - rest) @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n * x - S)**2, exact."""
        sums = np.array(self.sums, object)
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max(map(abs, self.sums))
        if most * most * len(sums) < 1 << 63:
            d = self.n * x - sums.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        out = ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in out]


def decompose(n: int, sums: list[int], cross: np.ndarray, components: int) -> Whitening:
    """The leading components of the covariance, centred as integers first."""
    s = np.array(sums, object)
    centred = n * cross - np.outer(s, s)     # n**2 * covariance
    scale = max(1, max(abs(int(v)) for v in centred.ravel()))
    # correctly rounded quotients of Python integers, then plain doubles
    unit = np.array([[int(v) / scale for v in row] for row in centred])
    values, vectors = np.linalg.eigh(unit)
    trace = sum(int(centred[i, i]) for i in range(len(s)))
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    real = values > len(s) * np.finfo(float).eps * (trace / scale)
    values, vectors = values[real], vectors[:, real]
    # one sign for all rows: the entry of greatest size is positive
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, list(sums), vectors, values * (scale / (n * n)), trace / (n * n))


def usual_width(table: DataFrame, vector: str) -> int:
    """The commonest number of entries; 0 if no row has any."""
    row = (table.groupBy(F.size(F.coalesce(vector, F.array().cast(table.schema[vector].dataType))).alias("w")).count()
           .where("w > 0").orderBy(F.desc("count"), F.desc("w")).first())
    return row["w"] if row else 0


def distinct_vectors(table: DataFrame, vector: str, width: int) -> DataFrame:
    """(x binary): every distinct integer vector once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, x = integer_rows(b.column(0), width)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(packed(x), pa.binary())], ["x"])

    return table.select(vector).mapInArrow(run, "x binary").distinct()


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in ``vectors`` (x binary); None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross, held = 0, 0, 0, []
        for b in chain(batches, [None]):
            if b is not None and b.num_rows:
                held.append(unpacked(b.column(0), width))
            if held and (b is None or sum(map(len, held)) * width >= BLOCK_CELLS):
                k, s, c = scatter(np.concatenate(held))
                n, sums, cross, held = n + k, sums + s, cross + c, []
        if n:
            up = np.triu_indices(width)
            found = [(-1, -1, 0, n), *_limbs(np.full(width, -1), np.arange(width), sums), *_limbs(*up, cross[up])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["i", "j", "k", "v"])

    parts = vectors.mapInArrow(run, "i long, j long, k long, v long").groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect()
    total: dict[tuple[int, int], int] = {}
    for r in parts:  # at most width * (width + 3) / 2 sums of a few limbs
        total[r.i, r.j] = total.get((r.i, r.j), 0) + (r.v << LIMB * r.k)
    n = total.get((-1, -1), 0)
    if not n:
        return None
    cross = np.zeros((width, width), object)
    for a in range(width):
        for b in range(a, width):
            cross[a, b] = cross[b, a] = total.get((a, b), 0)
    return decompose(n, [total.get((-1, a), 0) for a in range(width)], cross, components)


def identity_error(vectors: DataFrame, width: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity, over the fit's vectors."""
    m = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(m), np.zeros((m, m))
        for b in batches:
            w = model.project(unpacked(b.column(0), width))
            sums += w.sum(axis=0)
            cross += w.T @ w
        flat = np.concatenate([sums, cross.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], ["i", "v"])

    got = vectors.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(m + m * m)
    for r in got:
        flat[r.i] = r.v
    mean = flat[:m] / model.n
    return float(np.abs(flat[m:].reshape(m, m) / model.n - np.outer(mean, mean) - np.eye(m)).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    spark = table.sparkSession
    bounded_batches(spark)
    table = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    width = usual_width(table, "vector")
    model = None
    if width:
        vectors = cut(distinct_vectors(table, "vector", width))
        model = fit(vectors, width, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUT)
    m, error = len(model.values), identity_error(vectors, width, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = integer_rows(b.column(1), width)
            if not len(rows):
                continue
            ids = b.column(0).take(pa.array(np.repeat(rows, m)))
            deviation = pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), m)))
            k = len(rows)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, m + 1), k), pa.int32()), pa.array(np.full(k * m, model.n), pa.int64()), deviation,
                 pa.array(model.project(x).ravel()), pa.array(np.tile(model.values / model.trace, k)), pa.array(np.full(k * m, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(run, OUT)
