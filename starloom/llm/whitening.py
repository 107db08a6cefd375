"""Embedding whitening: components of the covariance by QDWH spectral divide-and-conquer, then a broadcast projection.

Entries are taken as whole numbers ``floor(scale * c)``, so that counts and sums are exact. The covariance is that of the
distinct vectors, centred before multiplying: tasks add up products of centred slices, and only one ``dims`` x ``dims``
matrix comes to the driver, with ``dims`` at most ``MOST_DIMS``.

The matrix is split there. For a shift s between the eigenvalues the polar factor U of V - s (QDWH: dynamically weighted
Halley iterations, each a QR or Cholesky step) is the matrix sign, and (U + I) / 2 projects on the eigenvectors above s.
An orthogonal basis of that space and of its complement splits V in two smaller blocks, which are split in turn until
each is a single number: the eigenvalue of its column.

Edge cases: rows whose vector is null, empty, or holds a null or non-finite entry are dropped; if lengths differ, those
of the length that most distinct vectors have stay (the longer one on a tie); entries beyond 64 bits are cut to that
range; repeated rows and null ``vec_id`` give rows of their own; there are no components of an eigenvalue that is zero
to rounding, so a table of equal vectors, like an empty one, gives an empty result; a deviation beyond 64 bits is null;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import slices
from starloom.session import materialize, work_folder

SCALE, COMPONENTS, MOST_DIMS = 256, 4, 4096
SLICE_ENTRIES = 1 << 19
MOST_STEPS = 12
_EPS = np.finfo(float).eps


# --- spectral divide-and-conquer -----------------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low, eye = _EPS, np.eye(n)  # a lower bound of the least singular value: too low costs a step or two, never accuracy
    for _ in range(MOST_STEPS):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = (1 + d) ** 0.5
        p = root + 0.5 * (8 - 4 * d + 8 * (2 - square) / (square * root)) ** 0.5
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([r**0.5 * x, eye]))[0]
            new = (q / r) * x + (p - q / r) / r**0.5 * (both[:n] @ both[n:].T)
        else:
            lower = np.linalg.cholesky(eye + r * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            new = (q / r) * x + (p - q / r) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        if abs(1 - low) < 10 * _EPS and moved < (10 * _EPS) ** (1 / 3):
            break
    return x


def _halves(a: np.ndarray) -> tuple[np.ndarray, int, float] | None:
    """An orthogonal basis whose first ``k`` columns span the eigenvectors of ``a`` above a shift, with what stays of ``a``
    between the two halves; the best of a few shifts. None if no shift separates anything."""
    n, diagonal, best = len(a), np.diag(a), None
    draws = np.random.Generator(np.random.PCG64(n)).standard_normal((n, n))
    spread = max(diagonal.max() - diagonal.min(), np.linalg.norm(a - np.diag(diagonal)) / n**0.5)
    for shift in (np.median(diagonal), diagonal.mean(), diagonal.mean() + spread / 8, diagonal.mean() - spread / 8):
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved):
            continue
        projector = (polar_factor(moved) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis = np.linalg.qr(projector @ draws[:, :k])[0]
        basis = np.linalg.qr(projector @ basis, mode="complete")[0]
        rest = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or rest < best[2]:
            best = basis, k, rest
        if rest <= 20 * n * _EPS * np.linalg.norm(a):
            break
    return best


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    n = len(a)
    a, size = (a + a.T) / 2, np.linalg.norm(a)
    values, vectors, waiting = [], [], [(a, np.eye(n))]
    while waiting:
        block, basis = waiting.pop()
        off = block - np.diag(np.diag(block))
        halves = _halves(block) if len(block) > 1 and np.linalg.norm(off) > _EPS * size else None
        if halves is None:  # diagonal already, or a multiple of the identity
            values.extend(np.diag(block))
            vectors.append(basis)
            continue
        turn, k, _ = halves
        for part in (turn[:, :k], turn[:, k:]):
            inner = part.T @ block @ part
            waiting.append(((inner + inner.T) / 2, basis @ part))
    vectors = np.hstack(vectors) if vectors else np.zeros((n, 0))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[:, order]


# --- passes over the rows ------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _whole(embeddings: DataFrame, scale: float) -> DataFrame:
    """``vec_id`` and ``x`` of the rows whose vector is complete."""
    unusable = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~unusable)
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint")).alias("x"))


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: vectors, and sums of the high and low halves of their entries, which cannot run over."""
    totals: dict[int, list] = {}
    for b in slices(batches, "x", SLICE_ENTRIES):
        lengths = pc.list_value_length(b.column("x")).to_numpy(zero_copy_only=False)
        for d in np.unique(lengths).tolist():
            x = _matrix(b.column("x").filter(pa.array(lengths == d)))
            old = totals.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
            old[0] += len(x)
            old[1] += (x >> 32).sum(axis=0)
            old[2] += (x & 0xFFFFFFFF).sum(axis=0)
    rows = [(d, n, high, low) for d, (n, high, low) in totals.items()]
    if rows:
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["dims", "n", "high", "low"])


def _totals(fit: DataFrame) -> tuple[int, list[int]] | None:
    """Number of the fit list's vectors of the most frequent length, and their sums per dimension, exact."""
    parts = fit.mapInArrow(_summed, "dims int, n bigint, high array<bigint>, low array<bigint>")
    counts = parts.groupBy("dims").agg(F.sum("n").alias("n"), F.max("dims").alias("d"))
    most = counts.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    if most.dims > MOST_DIMS:
        raise ValueError(f"vectors of {most.dims} entries; at most {MOST_DIMS} are provided for")
    each = parts.filter(F.col("dims") == most.dims).select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "h"))
    sums = each.groupBy("i").agg(*[F.sum(F.col(f"h.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    found = {r.i: int(r.high) * (1 << 32) + int(r.low) for r in sums.collect()}  # as many numbers as dimensions
    return most.n, [found[i] for i in range(most.dims)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n`` with the whole part subtracted in whole numbers."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(float) - part


def _products(n: int, sums: list[int], axes: np.ndarray | None = None):
    """Sums of products of the centred vectors, or of their projections on ``axes``: ``i`` and row ``i`` of the matrix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for b in slices(batches, "x", SLICE_ENTRIES):
            c = _centred(_matrix(b.column("x")), n, sums)
            c = c if axes is None else c @ axes
            total = total + c.T @ c
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], ["i", "row"])

    return run


def _covariance(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray | None = None) -> np.ndarray:
    parts = fit.mapInArrow(_products(n, sums, axes), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    size = len(sums) if axes is None else axes.shape[1]
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # size * size numbers
        out[r.i, r.j] = r.v / n
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of ``(n * x - sums) ** 2``, exact, null beyond 64 bits."""
    low, high = np.array([s // n for s in sums], dtype=object), np.array([s % n for s in sums], dtype=object)
    near = x.astype(float) * n - np.array([float(s) for s in sums])
    if (near * near).sum(axis=1).max(initial=0) < 2.0**62 and max(map(abs, sums), default=0) < 2**62 and np.abs(x.astype(float)).max(initial=0) * n < 2.0**62:
        each = x * n - np.array(sums, np.int64)
        return (each * each).sum(axis=1).tolist()
    exact = [int((((row - low) * n - high) ** 2).sum()) for row in x.astype(object)]
    return [v if v < 1 << 63 else None for v in exact]


def _projected(n: int, sums: list[int], axes: np.ndarray, explained: np.ndarray, error: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        for b in slices(batches, "x", SLICE_ENTRIES):
            x = _matrix(b.column("x"))
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    pa.array([d for d in _deviations(x, n, sums) for _ in range(k)], pa.int64()),
                    pa.array((_centred(x, n, sums) @ axes).reshape(-1)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """Whitened coordinates of ``embeddings`` (``vec_id``, ``embedding``), one row per row and component.

    ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation``, ``whitened``,
    ``explained`` (share of the variance) and ``identity_error`` (how far the covariance of the whitened coordinates,
    measured over the distinct vectors, is from the identity).
    """
    spark = embeddings.sparkSession
    rows = _whole(embeddings, scale)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fit = materialize(rows.select("x").distinct(), work_folder(spark))
    known = _totals(fit)
    if known is None:
        return spark.createDataFrame([], schema)
    n, sums = known
    same_length = F.size("x") == len(sums)
    fit, rows = fit.filter(same_length), rows.filter(same_length)
    covariance = _covariance(fit, n, sums)
    values, vectors = eigen(covariance)
    trace = float(np.trace(covariance))
    k = min(components, int((values > len(sums) * _EPS * max(values.max(initial=0), 0)).sum()))
    if not k:
        return spark.createDataFrame([], schema)
    axes = vectors[:, :k] / np.sqrt(values[:k])
    error = float(np.abs(_covariance(fit, n, sums, axes) - np.eye(k)).max())
    return rows.mapInArrow(_projected(n, sums, axes, values[:k] / trace, error), schema)
