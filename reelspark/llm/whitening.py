"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers ``floor(scale * c)``. The fit list holds each distinct
integer vector once. A task takes the fit list in blocks of ``BLOCK`` rows,
shifts every dimension by its smallest value in the block and packs each bit
plane of the shifted values across the rows into 64-bit words. The popcount of
the AND of two planes, weighted by both bits' values, counts their part of a
cross-product, so all cross-products are exact integers. A border dimension
of ones gives the sums and the number of rows by the same step.

Tasks return their cross-products in limbs of 32 bits, which Spark adds as
longs; the driver receives one row per pair of dimensions, whatever the number
of rows. There the matrix is centred as integers (``n * Sxy - Sx * Sy``)
before the eigendecomposition; only then it becomes double.

Defined results: rows whose vector is null or holds null or non-finite entries
are dropped, and so are entries beyond a long's range (their row is dropped as
one that has no integer vector). The fit uses the vectors of the most common
length, of two equally common the longer; rows of another length, empty ones
too, keep their rows with null ``deviation`` and ``whitened``. A component
without variance has null ``whitened``; with no variance at all ``explained``
is null. Rows that repeat an id or a vector each get their rows; a null id
stays null. No usable row: no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
COMPONENTS = 4
BLOCK = 4096             # rows of a bit-sliced block
LIMBS = 5                # limbs of 32 bits of one cross-product of a task
_LONG = 2.0 ** 63


class Whitening(NamedTuple):
    """The fit: everything a row needs, of a size set by the dimensions."""
    n: int                   # rows of the fit list
    sums: list               # per dimension, exact
    values: list             # eigenvalues, falling
    vectors: list            # unit eigenvectors, one list per component
    explained: list          # share of the trace per component, None without variance
    identity_error: float


def integer_vectors(df: DataFrame, vec: str = "embedding", id_col: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the usable rows as integer vectors."""
    scaled = F.transform(F.col(vec).cast("array<double>"), lambda c: F.floor(c * scale))
    v = F.col(vec).cast("array<double>")
    usable = F.col(vec).isNotNull() & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (c * scale >= -_LONG) & (c * scale < _LONG))
    return df.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("x"))


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of every bit plane of unsigned ``shifted``
    (rows x dimensions), packed across the rows."""
    planes, dims, bits = [], [], []
    rows = len(shifted)
    width = -(-rows // 64) * 8
    for d in range(shifted.shape[1]):
        column = shifted[:, d]
        for b in range(int(column.max()).bit_length()):
            packed = np.zeros(width, np.uint8)
            ones = np.packbits((column >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little")
            packed[:len(ones)] = ones
            planes.append(packed.view(np.uint64))
            dims.append(d)
            bits.append(b)
    words = np.array(planes) if planes else np.zeros((0, width // 8), np.uint64)
    return words, np.array(dims, np.int64), np.array(bits, np.int64)


def block_scatter(x: np.ndarray) -> np.ndarray:
    """Exact cross-products of one block (rows x dimensions of int64) with a
    border of ones, as a matrix of Python integers."""
    rows, dim = x.shape
    low = x.min(axis=0)
    shifted = np.ones((rows, dim + 1), np.uint64)
    shifted[:, :dim] = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2^64, so never out of range
    words, dims, bits = bit_planes(shifted)
    product = [[0] * (dim + 1) for _ in range(dim + 1)]
    starts = np.searchsorted(dims, np.arange(dim + 2))
    wide = bits.max(initial=0) > 24
    weights = None if wide else np.int64(1) << bits
    for k in range(len(dims)):
        # Plane k against its own dimension and those after it.
        p, first = int(dims[k]), int(starts[dims[k]])
        counts = np.bitwise_count(words[k] & words[first:]).sum(axis=1, dtype=np.int64)
        row = product[p]
        if wide:
            for q, b, c in zip(dims[first:].tolist(), bits[first:].tolist(), counts.tolist()):
                row[q] += c << (b + int(bits[k]))
        else:
            edges = starts[p:] - first
            sums = np.concatenate([[0], np.cumsum(counts * weights[first:])])
            shift = int(bits[k])
            for q, s in zip(range(p, dim + 1), (sums[edges[1:]] - sums[edges[:-1]]).tolist()):
                row[q] += s << shift
    moved = [int(v) for v in low] + [0]
    one = [product[p][dim] for p in range(dim)] + [rows]
    for p in range(dim + 1):
        for q in range(p, dim + 1):
            product[p][q] += moved[p] * one[q] + moved[q] * one[p] + moved[p] * moved[q] * rows
    return np.array(product, object)


def _partial_scatter(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                x = np.asarray(b.column(0).slice(at, BLOCK).flatten()).reshape(-1, dim)
                product = block_scatter(x)
                total = product if total is None else total + product
        if total is None:
            return
        p, q = np.triu_indices(dim + 1)
        limbs = [[] for _ in range(LIMBS)]
        for value in total[p, q]:
            for k in range(LIMBS):  # the last limb carries the sign
                limbs[k].append(value & 0xFFFFFFFF if k < LIMBS - 1 else value)
                value >>= 32
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(q, pa.int32()), *(pa.array(v, pa.int64()) for v in limbs)],
            ["p", "q", *(f"limb{k}" for k in range(LIMBS))])
    return run


def scatter(fit_list: DataFrame, dim: int) -> tuple[int, list, list]:
    """(n, sums, cross-products) of the vectors ``x`` of length ``dim``, exact."""
    names = [f"limb{k}" for k in range(LIMBS)]
    parts = fit_list.select("x").mapInArrow(_partial_scatter(dim), "p int, q int, " + ", ".join(f"{n} long" for n in names))
    total = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in parts.groupBy("p", "q").agg(*[F.sum(n).alias(n) for n in names]).collect():
        total[r["p"]][r["q"]] = total[r["q"]][r["p"]] = sum(r[n] << (32 * k) for k, n in enumerate(names))
    return total[dim][dim], total[dim][:dim], [row[:dim] for row in total[:dim]]


def components_of(n: int, sums: list, products: list, k: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Largest ``k`` eigenvalues of the covariance, their unit vectors (rows)
    and their shares of the trace."""
    dim = len(sums)
    square = n * n
    v = np.array([[(n * products[p][q] - sums[p] * sums[q]) / square for q in range(dim)] for p in range(dim)], float)
    trace = sum(n * products[p][p] - sums[p] * sums[p] for p in range(dim)) / square
    values, vectors = np.linalg.eigh(v)
    k = min(k, dim)
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    floor = max(values[0], 0) * dim * np.finfo(float).eps
    values = np.where(values > floor, values, 0.0)
    return values, vectors, [float(e) / trace if trace else None for e in values]


def _centred(x: np.ndarray, n: int, sums: list, small: bool) -> np.ndarray:
    """``n * x - S`` exactly: int64 where it must fit, else Python integers."""
    return n * x - np.array(sums, np.int64) if small else n * x.astype(object) - np.array(sums, object)


def _fits(x: np.ndarray, n: int, sums: list) -> bool:
    """Whether ``n * x - S`` and the sum of its squares stay within an int64."""
    big = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums)) if x.size else 0
    return big * big * max(x.shape[1], 1) < 1 << 62


def _project(centred: np.ndarray, fit: Whitening) -> np.ndarray:
    """Whitened rows x components; a component without variance gives NaN."""
    y = (centred / fit.n).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = (y @ np.array(fit.vectors, float).T) / np.sqrt(np.array(fit.values, float))
    out[:, np.array(fit.values) == 0] = np.nan
    return out


def identity_error(fit_list: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, over the components with variance."""
    dim, k = len(fit.sums), len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            x = np.asarray(b.column(0).flatten()).reshape(-1, dim)
            for at in range(0, len(x), BLOCK):
                part = x[at:at + BLOCK]
                w = _project(_centred(part, fit.n, fit.sums, _fits(part, fit.n, fit.sums)), fit)
                w = np.concatenate([np.nan_to_num(w), np.ones((len(w), 1))], axis=1)
                total += w.T @ w
        p, q = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(p.ravel()), pa.array(q.ravel()), pa.array(total.ravel())], ["p", "q", "s"])

    total = np.zeros((k + 1, k + 1))
    parts = fit_list.select("x").mapInArrow(run, "p long, q long, s double")
    for r in parts.groupBy("p", "q").agg(F.sum("s").alias("s")).collect():
        total[r["p"], r["q"]] = r["s"]
    total /= fit.n
    cov = total[:k, :k] - np.outer(total[:k, k], total[:k, k])
    live = np.flatnonzero(np.array(fit.values) > 0)
    return float(np.abs(cov[np.ix_(live, live)] - np.eye(len(live))).max(initial=0.0))


def fit_whitening(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Fit over the distinct ``x`` of the most common length; None without rows."""
    dim = vectors.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dim is None:
        return None
    if dim["dim"] == 0:
        return Whitening(0, [], [], [], [], 0.0)
    fit_list = materialise(vectors.where(F.size("x") == dim["dim"]).select("x").distinct(), "fit-list")
    n, sums, products = scatter(fit_list, dim["dim"])
    values, axes, explained = components_of(n, sums, products, k)
    fit = Whitening(n, sums, values.tolist(), axes.tolist(), explained, 0.0)
    return fit._replace(identity_error=identity_error(fit_list, fit))


def transform(vectors: DataFrame, fit: Whitening) -> DataFrame:
    """Per row and component: ``vec_id, component, n, deviation (decimal text),
    whitened, explained, identity_error``."""
    dim, k = len(fit.sums), len(fit.values)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                lists = part.column(1)
                right = np.asarray(lists.value_lengths()) == dim
                x = np.asarray(lists.filter(pa.array(right)).flatten()).reshape(-1, dim)
                small = _fits(x, fit.n, fit.sums)
                c = _centred(x, fit.n, fit.sums, small)
                rows = len(right)
                deviation, whitened = np.full(rows, None, object), np.full((rows, k), None, object)
                deviation[right] = [str(d) for d in (c * c).sum(axis=1).tolist()]
                w = _project(c, fit).astype(object)
                w[:, np.array(fit.values) == 0] = None
                whitened[right] = w
                ids = part.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array([fit.n] * (rows * k), pa.int64()),
                     pa.array(np.repeat(deviation, k).tolist(), pa.string()), pa.array(whitened.ravel().tolist(), pa.float64()),
                     pa.array(fit.explained * rows, pa.float64()), pa.array([fit.identity_error] * (rows * k), pa.float64())], names)

    return vectors.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame, vec: str = "embedding", id_col: str = "vec_id",
           scale: int = SCALE, k: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable row, fitted on the same table."""
    vectors = integer_vectors(embeddings, vec, id_col, scale)
    fit = fit_whitening(vectors, k)
    return transform(vectors.limit(0), Whitening(1, [0], [], [], [], 0.0)) if fit is None else transform(vectors, fit)
