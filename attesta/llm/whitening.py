"""Embedding whitening: the leading principal components by matrix-free block subspace iteration.

No covariance matrix is built. A pass over the rows gives A W = Xᵀ(X W) / n for a block W of a few
directions, where X holds the centred rows; the driver holds thin blocks only (dimensions x at most
``MOST`` columns). After each pass the directions so far are made orthonormal (QR) and a Rayleigh-Ritz step
takes the best approximations from their span. Their residuals A u - e u are the next pass's block, so the
subspace keeps what earlier passes found; beyond ``MOST`` columns it restarts from the best. It ends when the
residuals certify all components, or the directions span the whole space, where Rayleigh-Ritz is exact. Plain
iteration of a fixed block would need hundreds of passes on spectra as flat as those of random vectors.

Entries are whole numbers, x = floor(scale * c) + shift, so that the sums S, and the deviations
sum((n x - S)^2), are exact. Centred entries are taken as (x - S div n) - (S mod n) / n, which loses nothing
before the last rounding.

Vectors that are null or hold null or non-finite entries take no part; shorter vectors are filled with zeros
up to the longest. Entries beyond 2^62 in size after scaling saturate there. Null and repeated ids are rows
like others, equal vectors get equal results, columns of other names are ignored. Components whose eigenvalue
is zero (within rounding) can't be scaled to unit variance and are left out, so there are at most as many as the
rank; an empty table, equal rows, or vectors without entries give no rows. A deviation beyond 38 digits is null.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.topk import usable

#: Most columns that the subspace keeps, and the residual, as a share of the largest eigenvalue, that certifies a component.
MOST, RESIDUAL = 256, 1e-13
#: Passes after which it gives up, with an error.
PASSES = 500
_FAR = 2.0**62
_ROWS = 4_096


def _whole(column, dims: int, scale: float, shift: int) -> np.ndarray:
    """The vectors of an Arrow column of lists of doubles as rows of whole numbers."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(ends) and (ends == dims).all():
        raw = flat.reshape(-1, dims)
    else:
        raw = np.zeros((len(ends), dims))
        raw[np.arange(dims)[None, :] < ends[:, None]] = flat
    return np.clip(np.floor(scale * raw), -_FAR, _FAR).astype(np.int64) + shift


def _mapped(rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over slices of bounded size of the Arrow batches of a partition."""

    def small(batches):
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                yield b.slice(lo, _ROWS)

    return rows.mapInArrow(lambda batches: run(small(batches)), schema)


def _sums(rows: DataFrame, dims: int, scale: float, shift: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension. Tasks add high and low halves."""

    def run(batches):
        import pyarrow as pa

        n, high, low = 0, np.zeros(dims, dtype=np.int64), np.zeros(dims, dtype=np.int64)
        for b in batches:
            x = _whole(b.column("v"), dims, scale, shift)
            n, high, low = n + len(x), high + (x >> 31).sum(0), low + (x & 0x7FFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(high), pa.array(low)], ["dim", "n", "high", "low"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    got = {r["dim"]: r for r in _mapped(rows, run, "dim int, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), exact("high"), exact("low")).collect()}
    return (got[0]["n"], [(int(got[i]["high"]) << 31) + int(got[i]["low"]) for i in range(dims)]) if got else (0, [0] * dims)


class _Centre:
    """Whole rows about their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.floor, self.rest = n, [s // n for s in sums], [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def near(self, x: np.ndarray) -> np.ndarray:
        """x - S div n: no overflow, as both are below 2^63 in size and of a range below 2^63."""
        return x - np.array(self.floor, dtype=np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.near(x).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum((n x - S)^2) = n^2 sum(y^2) - 2 n sum(y r) + sum(r^2), y = x - S div n, r = S mod n."""
        y, dims = self.near(x), x.shape[1]
        most = int(np.abs(y).max(initial=0))
        if dims * most * most < 2**62 and dims * most < 2**31 and self.n < 2**62:
            squares = (y * y).sum(1).tolist()
            high, low = ((y @ np.array([f(r) for r in self.rest], dtype=np.int64)).tolist() for f in (lambda r: r >> 31, lambda r: r & 0x7FFFFFFF))
            cross = [(h << 31) + w for h, w in zip(high, low, strict=True)]
        else:
            whole = y.tolist()
            squares = [sum(v * v for v in row) for row in whole]
            cross = [sum(v * r for v, r in zip(row, self.rest, strict=True)) for row in whole]
        last = sum(r * r for r in self.rest)
        return [self.n * self.n * s - 2 * self.n * c + last for s, c in zip(squares, cross, strict=True)]


def _products(rows: DataFrame, dims: int, scale: float, shift: int, centre: _Centre, q: np.ndarray, gram: bool = False) -> tuple[np.ndarray, float]:
    """Xᵀ(X Q) / n, or with ``gram`` (X Q)ᵀ(X Q) / n, and the covariance's trace, by one pass: tasks add their rows'
    shares, and the entries are summed after that, so the driver gets one number for each entry whatever the
    number of tasks."""
    height, width = (q.shape[1] if gram else dims), q.shape[1]

    def run(batches):
        import pyarrow as pa

        out, total = np.zeros((height, width)), 0.0
        for b in batches:
            x = centre.rows(_whole(b.column("v"), dims, scale, shift))
            y = x @ q
            out, total = out + (y if gram else x).T @ y, total + float((x * x).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height * width + 1, dtype=np.int64)), pa.array(np.append(out.ravel(), total))], ["at", "v"])

    got = _mapped(rows, run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas().sort_values("at")
    sums = got["v"].to_numpy() / centre.n
    return sums[:-1].reshape(height, width), float(sums[-1])


def _orthonormal(block: np.ndarray, basis: np.ndarray | None, room: int) -> np.ndarray:
    """Directions of ``block`` beyond the span of ``basis``, at most ``room``: projected twice, then by QR."""
    for _ in range(2):
        if basis is not None:
            block = block - basis @ (basis.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        block = np.linalg.qr(block)[0]
    return block[:, :room]


def components(rows: DataFrame, dims: int, scale: float, shift: int, centre: _Centre, k: int, block: int, seed: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(eigenvalues, eigenvectors in columns, trace, passes) of the covariance's k leading components.

    The subspace spans the whole space at the latest when it has as many columns as there are dimensions;
    only where it may not grow so far does it restart from its best half."""
    rng = np.random.default_rng(seed)
    basis = image = None
    new = _orthonormal(rng.standard_normal((dims, min(dims, block))), None, dims)
    for turn in range(1, PASSES + 1):
        made, trace = _products(rows, dims, scale, shift, centre, new)
        basis, image = (new, made) if basis is None else (np.hstack([basis, new]), np.hstack([image, made]))
        inner = basis.T @ image
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        vectors, images = basis @ turns, image @ turns
        residuals = images - vectors * values
        if basis.shape[1] == dims or (np.linalg.norm(residuals[:, :k], axis=0) <= RESIDUAL * max(values[0], 0)).all():
            return values[:k], vectors[:, :k], trace, turn
        if basis.shape[1] + block > max(MOST, 4 * block) and dims > max(MOST, 4 * block):
            keep = 2 * block
            basis, image = vectors[:, :keep], images[:, :keep]
        new = _orthonormal(residuals[:, :block], basis, dims - basis.shape[1])
        if not new.shape[1]:
            return values[:k], vectors[:, :k], trace, turn
    raise RuntimeError(f"after {PASSES} passes the residuals don't certify all components")


def whiten(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", k: int = 8, scale: float = 1024.0, shift: int = 100_000, seed: int = 7) -> DataFrame:
    """(vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error) for each vector that takes
    part and each of up to k components, numbered from 1 by falling eigenvalue. The sign of a component is the
    one that makes its largest entry positive.

    ``identity_error`` is measured: a last pass gives the covariance of the whitened values."""
    rows = vectors.where(usable(F.col(vec))).select(F.col(id).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    empty = f"{id} long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    n, sums = _sums(rows, dims, scale, shift) if dims else (0, [])
    if not n:
        return vectors.sparkSession.createDataFrame([], empty)
    centre = _Centre(n, sums)
    e, u, trace, _ = components(rows, dims, scale, shift, centre, min(k, dims), min(dims, 2 * k), seed)
    held = e > 1e-13 * trace
    e, u = e[held], u[:, held]
    if not len(e):
        return vectors.sparkSession.createDataFrame([], empty)
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(len(e))] < 0, -1.0, 1.0)
    to = u / np.sqrt(e)
    error = float(np.abs(_products(rows, dims, scale, shift, centre, to, gram=True)[0] - np.eye(len(e))).max())

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = _whole(b.column("v"), dims, scale, shift)
            far = [Decimal(d) if d < 10**38 else None for d in centre.deviations(x)]
            y = centre.rows(x) @ to
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(far, pa.decimal128(38, 0)), pa.array(list(y), pa.list_(pa.float64()))], ["id", "deviation", "y"])

    kind = dict(rows.dtypes)["id"]
    out = _mapped(rows, run, f"id {kind}, deviation decimal(38,0), y array<double>").select("id", "deviation", F.posexplode("y").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(float(x / trace)) for x in e]), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
