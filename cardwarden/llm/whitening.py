"""Whitening of embeddings from exact integer sums.

Entries become integers, floor(256 * c). Of the distinct vectors, each block of rows is shifted to start at zero per dimension
and cut into bit planes, and each plane is packed into 64-bit words, one bit a row. The number of rows in which bit p of
dimension d and bit q of dimension e are both set is the popcount of the AND of two planes; weighted by 2 ** (p + q) and summed
they are the cross-product of the two dimensions, without rounding. A plane of ones stands for a dimension that is always
1, so that sums and the count come out of the same pass. Blocks are summed in Spark as 32-bit limbs. The covariance is centred
as integers, n * sum(xy) - sum(x) * sum(y), before it is divided; its components come from eigh, then Jacobi rotations
in extended precision.

Only matrices of the vectors' width reach the driver, never rows. A vector that many rows repeat is merged before it
is shuffled.

Rows whose vector is null or holds a null, NaN or infinite entry are left out. Entries beyond a 64-bit integer become the
nearest one. A vector shorter than the longest one ends in zeros; an empty one is all zeros. Null and repeated vec_ids are kept, row by
row. If a component's eigenvalue is zero to double precision (one vector, or equal ones), its `whitened` is null and it doesn't count for
identity_error; `explained` is null where there is no variance at all. deviation is null beyond a 64-bit integer. An empty table gives no
rows. Only the id and the vector are read, so other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import stored

SCALE = 256
TOP = 4
#: Rows that are cut into bit planes at once: 64 words a plane.
BLOCK_ROWS = 4096
LIMBS = 6
_MOST = (1 << 63) - 1


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x of every row with a finite vector. Written once."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long"))
    kept = stored(rows.where(finite).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")), "vectors")
    width = kept.agg(F.max(F.size("x"))).first()[0] or 0
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    return kept.withColumn("x", F.concat("x", zeros))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the columns of y (unsigned), lowest bit first, and a last one of ones; and where each column's begin."""
    rows = len(y)
    words = -(-rows // 64)
    bits = [int(m).bit_length() for m in y.max(axis=0)]
    starts = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)
    planes = np.zeros((int(starts[-1]) + 1, words * 8), np.uint8)
    for p in range(max(bits, default=0)):
        has = np.flatnonzero(np.array(bits) > p)
        set_ = ((y[:, has] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes[starts[has] + p, : -(-rows // 8)] = np.packbits(set_, axis=0).T
    planes[-1, : -(-rows // 8)] = np.packbits(np.ones(rows, np.uint8))
    return planes.view(np.uint64), starts


def cross_products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of x and of a column of ones, as Python integers."""
    rows, width = x.shape
    low = x.min(axis=0)
    planes, starts = bit_planes(x.astype(np.uint64) - low.astype(np.uint64))
    begins, ends = starts, np.append(starts[1:], starts[-1] + 1)
    bits = int((ends - begins).max())
    kind = np.int64 if 2 * bits + int(rows).bit_length() + 2 < 63 else object  # of what the weighted counts fit in
    weight = np.array([1 << p for b, e in zip(begins, ends) for p in range(e - b)], object).astype(kind)
    owner = np.repeat(np.arange(width + 1), ends - begins)
    out = np.zeros((width + 1, width + 1), object)
    for d in range(width + 1):
        total = np.zeros(len(owner), kind)[begins[d] :]
        for p in range(begins[d], ends[d]):
            counts = np.bitwise_count(planes[p] & planes[begins[d] :]).sum(axis=1, dtype=np.int64)
            total += counts.astype(kind) * weight[p]
        sums = np.zeros(width + 1, kind)
        np.add.at(sums, owner[begins[d] :], total * weight[begins[d] :])
        out[d, d:] = sums[d:]
        out[d:, d] = sums[d:]
    shift = np.array([int(v) for v in low] + [0], object)  # x = y + low
    ones = out[width].copy()
    return out + np.outer(shift, ones) + np.outer(ones, shift) + rows * np.outer(shift, shift)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cross-products of a task's rows: a row per pair of columns, cut into limbs."""
    total = 0
    for batch in batches:
        x = _matrix(batch.column(0))
        for at in range(0, len(x), BLOCK_ROWS):
            total = total + cross_products(x[at : at + BLOCK_ROWS])
    if isinstance(total, int):
        return
    i, j = np.triu_indices(len(total))
    limbs = [[] for _ in range(LIMBS)]
    for v in total[i, j]:
        v = int(v)
        for k in range(LIMBS):
            limbs[k].append(v & 0xFFFFFFFF if k < LIMBS - 1 else v)
            v >>= 32
    names = ["i", "j", *[f"l{k}" for k in range(LIMBS)]]
    yield pa.record_batch([pa.array(c, pa.int64()) for c in (i, j, *limbs)], names)


def eigen(covariance: list[list[Fraction]]) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns.

    eigh's error is that of the largest eigenvalue. What it leaves beside the diagonal is turned away in extended precision, so
    that small eigenvalues are exact for their own size too.
    """
    high = np.array([[float(v) for v in row] for row in covariance])
    rest = np.array([[float(v - Fraction(float(v))) for v in row] for row in covariance])
    exact = high.astype(np.longdouble) + rest
    q = np.linalg.eigh(high)[1].astype(np.longdouble)
    q = q @ (1.5 * np.eye(len(q)) - 0.5 * (q.T @ q))  # orthogonal beyond double precision
    a = q.T @ exact @ q
    a = (a + a.T) / 2
    tiny = np.finfo(np.longdouble).eps
    for _ in range(12):
        size = np.sqrt(np.abs(np.diag(a)))
        off = np.abs(a) > 8 * tiny * np.maximum(np.outer(size, size), tiny * size.max() ** 2)
        pairs = np.argwhere(np.triu(off, 1))
        if not len(pairs):
            break
        for i, j in pairs:
            if a[i, j] == 0:
                continue
            theta = (a[j, j] - a[i, i]) / (2 * a[i, j])
            t = (1 if theta >= 0 else -1) / (abs(theta) + np.sqrt(theta * theta + 1))
            c = 1 / np.sqrt(t * t + 1)
            turn = np.array([[c, t * c], [-t * c, c]])
            a[:, [i, j]] = a[:, [i, j]] @ turn
            a[[i, j]] = turn.T @ a[[i, j]]
            q[:, [i, j]] = q[:, [i, j]] @ turn
    values = np.diag(a)
    order = np.argsort(-values, kind="stable")
    q = q[:, order]
    q = q * np.where(q[np.abs(q).argmax(axis=0), np.arange(len(q))] < 0, -1, 1)  # the largest entry is positive
    return values[order].astype(float), q.astype(float)


@dataclass
class Whitening:
    """n distinct vectors, the sums of their entries, eigenvalues and eigenvectors (columns), and the share of variance of each."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float | None]
    identity_error: float = 0.0

    @property
    def rank(self) -> int:
        """Components whose eigenvalue is more than rounding."""
        most = self.values.max(initial=0.0)
        return int((self.values > most * len(self.values) * np.finfo(float).eps).sum()) if most > 0 else 0

    def weights(self, top: int) -> np.ndarray:
        """Eigenvectors over the roots of their eigenvalues; NaN where that is zero."""
        top = min(top, len(self.values))
        out = np.full((len(self.values), top), np.nan)
        real = min(top, self.rank)
        out[:, :real] = self.vectors[:, :real] / np.sqrt(self.values[:real])
        return out

    def scores(self, x: np.ndarray, top: int) -> tuple[list[int | None], np.ndarray]:
        """Exact squared deviation and whitened values of each row of x."""
        most = max([abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))]) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most * most * max(1, len(self.sums)) < 1 << 62 else object
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        squares = [int(v) for v in (off * off).sum(axis=1)]
        centred = off.astype(float) / self.n
        return [v if v <= _MOST else None for v in squares], centred @ self.weights(top)


def fit(x: DataFrame, top: int = TOP) -> Whitening | None:
    """The whitening of the distinct vectors in the column x, all of one width; None without any."""
    distinct = stored(x.select("x").distinct(), "distinct-vectors")
    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = distinct.mapInArrow(_scatter, ", ".join(f"{c} long" for c in ("i", "j", *limbs)))
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect()  # width squared
    if not sums:
        return None
    width = max(r.i for r in sums)
    m = [[0] * (width + 1) for _ in range(width + 1)]
    for r in sums:
        m[r.i][r.j] = m[r.j][r.i] = sum(r[f"l{k}"] << (32 * k) for k in range(LIMBS))
    n, totals = m[width][width], m[width][:width]
    centred = [[n * m[i][j] - totals[i] * totals[j] for j in range(width)] for i in range(width)]
    if not width:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)), [])
    values, vectors = eigen([[Fraction(v, n * n) for v in row] for row in centred])
    trace = sum(centred[i][i] for i in range(width)) / (n * n)
    found = Whitening(n, totals, values, vectors, [float(v) / trace if trace else None for v in values])
    found.identity_error = _identity_error(distinct, found, top)
    return found


def _identity_error(distinct: DataFrame, model: Whitening, top: int) -> float:
    """Largest difference between the covariance of the whitened vectors and the identity, from the vectors themselves."""
    real = min(top, model.rank)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.scores(_matrix(batch.column(0)), real)[1]
            z = np.column_stack([z, np.ones(len(z))])
            i, j = np.triu_indices(real + 1)
            yield pa.record_batch([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array((z.T @ z)[i, j])], ["i", "j", "v"])

    if not real:
        return 0.0
    sums = distinct.mapInArrow(moments, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    v = {(r.i, r.j): r.v / model.n for r in sums}
    return max(abs(v[i, j] - v[i, real] * v[j, real] - (i == j)) for i in range(real) for j in range(i, real))


_ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """A row for each finite vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors = integer_vectors(rows, vec_id, vector)
    model = fit(vectors, top)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], _ROW)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = min(top, len(model.values))
        for batch in batches:
            deviation, z = model.scores(_matrix(batch.column(1)), top)
            each = np.repeat(np.arange(len(z)), k)
            component = np.tile(np.arange(k), len(z))
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(component + 1, pa.int32()),
                    pa.array(np.full(len(each), model.n)),
                    pa.array([deviation[i] for i in each], pa.int64()),
                    pa.array(z.ravel(), mask=np.isnan(z).ravel()),
                    pa.array([model.explained[c] for c in component], pa.float64()),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(project, _ROW)
