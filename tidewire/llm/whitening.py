"""Whitening of embeddings: moments merged pairwise (Chan), one eigendecomposition, a second pass that checks it.

Each task centres a block by the block's own mean before multiplying, and merges its blocks; tasks are merged by the same
formula in a tree, so neither a large common offset nor the order of the rows costs digits, and the driver gets a few
matrices whatever the number of tasks.  Sums are whole numbers throughout and so exact.

Rows whose vector is null, empty, or holds null or non-finite entries have no part and no rows.  Repeated rows count each
and a null id is kept.  Vectors of different lengths can't share a covariance: each length is a fit list of its own.
Directions without variance (a constant dimension, one row, fewer rows than dimensions) can't be whitened and have no
component.  A ``deviation`` beyond a long is null.  An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

#: Whole numbers beyond this could overflow the sums.
_MOST = 1 << 40
#: Levels of the tree that merges tasks: the driver merges about the cube root of their number.
_DEPTH = 3

#: By length of vector: rows, sum (whole numbers stay whole), centred scatter.
Moments = dict[int, tuple[int, np.ndarray, np.ndarray]]


def block_moments(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    centred = x - x.sum(axis=0) / len(x)
    return len(x), x.sum(axis=0), centred.T @ centred


def merged(a: Moments, b: Moments) -> Moments:
    """The moments of both lists of rows, by Chan's formula for each length."""
    out = dict(a)
    for d, (nb, sb, mb) in b.items():
        if d not in out:
            out[d] = (nb, sb, mb)
            continue
        na, sa, ma = out[d]
        apart = sb / nb - sa / na
        out[d] = (na + nb, sa + sb, ma + mb + np.outer(apart, apart) * (na * nb / (na + nb)))
    return out


@dataclass(frozen=True)
class Whitening:
    """Of vectors of one length: rows, sums, projection (one column a component, by falling eigenvalue), shares."""

    n: int
    total: np.ndarray
    project: np.ndarray
    explained: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.total / self.n) @ self.project


def solve(n: int, total: np.ndarray, scatter: np.ndarray, most: int) -> Whitening:
    values, vectors = np.linalg.eigh(scatter / n)
    order = np.argsort(values)[::-1][:most]
    order = order[values[order] > max(values.max(), 0) * len(values) * 4 * np.finfo(float).eps]
    return Whitening(n, total, vectors[:, order] / np.sqrt(values[order]), values[order] / max(np.trace(scatter) / n, np.finfo(float).tiny))


def _blocks(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole numbers) for each length of vector in a batch."""
    column = batch.column(batch.num_columns - 1)
    ends = column.offsets.to_numpy()
    flat = np.floor(column.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(flat) and np.abs(flat).max() >= _MOST:
        raise ValueError(f"whole numbers of entries have to be below {_MOST}")
    size = np.diff(ends)
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield rows, flat[ends[rows][:, None] + np.arange(d)].astype(np.int64) + shift


def _moments(rows: DataFrame, scale: int, shift: int, of: Callable[[np.ndarray], np.ndarray]) -> Moments:
    """The merged moments of ``of(x)`` over all rows, by length of x."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(("whitening",))
        found: Moments = {}
        for batch in batches:
            for _, x in _blocks(batch, scale, shift):
                y = of(x)
                if y.shape[1]:
                    found = merged(found, {x.shape[1]: block_moments(y)})
        for d, (n, total, scatter) in found.items():
            whole = np.issubdtype(total.dtype, np.integer)
            yield pa.RecordBatch.from_pydict({"d": pa.array([d], pa.int32()), "n": [n], "whole": [whole], "total": [total.tobytes()], "scatter": [scatter.tobytes()]})

    def read(row) -> Moments:
        total = np.frombuffer(row["total"], np.int64 if row["whole"] else np.float64)
        return {row["d"]: (row["n"], total, np.frombuffer(row["scatter"], np.float64).reshape(len(total), len(total)))}

    parts = rows.select("v").mapInArrow(partial, "d int, n long, whole boolean, total binary, scatter binary").rdd.map(read)
    # treeReduce, with a zero for tasks and tables without rows
    return parts.treeAggregate({}, merged, merged, depth=_DEPTH)


def sound_vectors(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v): vectors of doubles without a null or non-finite entry."""
    rows = embeddings.select(F.struct("*").alias("row")).select(F.col("row").getField(key).alias("key"), F.col("row").getField(vector).cast("array<double>").alias("v"))
    return rows.where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    Entries c become x = floor(scale * c) + shift.  Components are the ``most`` first unit eigenvectors of the covariance
    of x (divisor n), numbered from 1 by falling eigenvalue e; ``whitened`` is x less its mean on the component over
    sqrt(e), ``explained`` e's share, ``deviation`` the exact sum of (n * x - sum)^2, and ``identity_error`` the largest
    absolute entry of whitened's covariance, over a second pass of all rows, less the identity.
    """
    rows = sound_vectors(embeddings, key, vector)
    fits = {d: solve(*m, most) for d, m in _moments(rows, scale, shift, lambda x: x).items()}
    if fits:
        check = _moments(rows, scale, shift, lambda x: fits[x.shape[1]](x))
        errors = {d: float(np.abs(m / n - np.eye(len(m))).max()) for d, (n, _, m) in check.items()}
    else:
        errors = {}
    kind = rows.schema["key"].dataType.simpleString()
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(("whitening",))
        for batch in batches:
            for at, x in _blocks(batch, scale, shift):
                fit = fits[x.shape[1]]
                k = len(fit.explained)
                if not k:
                    continue
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)), np.full(len(at) * k, fit.n),
                    deviations(x, fit.n, fit.total).take(pa.array(np.repeat(np.arange(len(at)), k))), fit(x).ravel(), np.tile(fit.explained, len(at)), np.full(len(at) * k, errors[x.shape[1]]),
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return rows.mapInArrow(out, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Each row's exact sum of (n * x - total)^2; null where it is beyond a long."""
    apart = n * x - total
    if float(np.abs(apart).max()) ** 2 * x.shape[1] < 2.0**62:
        return pa.array((apart * apart).sum(axis=1))
    sums = [sum(v * v for v in row) for row in apart.tolist()]
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
