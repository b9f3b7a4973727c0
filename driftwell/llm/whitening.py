"""Operator 13, embedding whitening: principal directions by matrix-free block Lanczos.

The covariance is never formed. A block of vectors is multiplied by it in one distributed pass: each
task sends the sum of c (c.Q) over its centred rows c, and Spark adds these sums up. The driver holds the
Krylov basis, a few columns as long as one embedding. Every new block is made orthogonal to the whole
basis, twice. A block that loses rank (the space is used up) is filled with random directions, which
starts the search anew in what is left. Residuals of the Ritz pairs, computed from the products that are
at hand, tell when to stop; a basis that spans everything ends it too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries become floor(SCALE * c) + SHIFT; an entry of LIMIT or more in size has no exact long of that kind.
SCALE, SHIFT, LIMIT = 1024, 100_000, float(1 << 40)
#: Components returned; columns of a block; residual at which a pair is found, relative to the largest eigenvalue.
COMPONENTS, BLOCK, TOLERANCE = 8, 16, 1e-13
#: Eigenvalues below this share of the largest are zero up to rounding.
ZERO = 1e-12
MOST = (1 << 63) - 1


def whole(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows whose vector has neither null nor non-finite entries."""
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < LIMIT))  # NaN is above every number
    return rows.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(v.isNotNull() & (F.size(v) > 0) & fine)


def scaled(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """Rows x dims of the longs that the entries become."""
    v = batch.column(batch.schema.get_field_index("v"))
    return np.floor(SCALE * v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)).astype(np.int64) + SHIFT


class Fit:
    """What the fit list has: n rows, dims entries each, sums of each entry (exact)."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.dims = n, sums, len(sums)

    def deviations(self, batch: pa.RecordBatch) -> np.ndarray:
        """n * x - S, exact: longs, or Python's integers where these could be too large."""
        x = scaled(batch, self.dims)
        if self.n * int(np.abs(x).max(initial=0)) < 1 << 61:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, batch: pa.RecordBatch) -> np.ndarray:
        return self.deviations(batch).astype(np.float64) / self.n

    def squares(self, batch: pa.RecordBatch) -> list[int | None]:
        """Sum of the squared deviations of each row, exact; None where no long holds it."""
        d = self.deviations(batch)
        if d.dtype == object or self.dims * int(np.abs(d).max(initial=0)) ** 2 > MOST:
            d = d.astype(object)
            return [s if s <= MOST else None for s in (d * d).sum(axis=1)]
        return (d * d).sum(axis=1).tolist()


def added(rows: DataFrame, what: Callable[[pa.RecordBatch], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all batches of rows of the arrays that `what` makes of them: a row a task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = what(batch)
                total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["s"])

    parts = rows.mapInArrow(run, f"s array<{kind}>").select(F.posexplode("s").alias("i", "s"))
    return np.array([r["s"] for r in parts.groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()])


def fit_list(valid: DataFrame) -> tuple[Fit | None, DataFrame]:
    """The Fit of whole() rows, and those rows that have its number of entries: the most common one, the larger of equally common ones."""
    sizes = valid.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if sizes is None:
        return None, valid
    rows = valid.where(F.size("v") == sizes["dims"])
    return Fit(sizes["n"], [int(s) for s in added(rows, lambda b: scaled(b, sizes["dims"]).sum(axis=0), "long")]), rows


def orthonormal(block: np.ndarray, basis: np.ndarray, scale: float, rng: np.random.Generator) -> np.ndarray:
    """As many orthonormal columns, orthogonal to the basis: first those of the block, random ones for what it lacks."""
    width = min(block.shape[1], basis.shape[0] - basis.shape[1])
    found = np.zeros((basis.shape[0], 0))
    while found.shape[1] < width:
        every = np.concatenate([basis, found], axis=1)
        for _ in range(2):
            block = block - every @ (every.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        u = u[:, s > 1e-10 * scale][:, : width - found.shape[1]]
        u = u - every @ (every.T @ u)
        found = np.concatenate([found, np.linalg.qr(u)[0]], axis=1)
        block, scale = rng.standard_normal((basis.shape[0], width - found.shape[1])), 1.0
    return found


def block_lanczos(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int = BLOCK, tolerance: float = TOLERANCE, seed: int = 13) -> tuple[np.ndarray, np.ndarray, int]:
    """(values falling, unit vectors as columns, passes) of the `wanted` largest eigenpairs of a symmetric positive operator.

    product(Q) multiplies dims x width. A block is at least as wide as `wanted`, so that equal eigenvalues
    don't hide each other.
    """
    rng = np.random.default_rng(seed)
    basis = image = np.zeros((dims, 0))
    new, passes = orthonormal(rng.standard_normal((dims, max(block, wanted))), basis, 1.0, rng), 0
    while True:
        out, passes = product(new), passes + 1
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, out], axis=1)
        t = basis.T @ image
        values, s = np.linalg.eigh((t + t.T) / 2)
        values, s = values[::-1], s[:, ::-1]
        vectors = basis @ s
        residual = np.linalg.norm(image @ s[:, :wanted] - vectors[:, :wanted] * values[:wanted], axis=0)
        if basis.shape[1] == dims or (residual <= tolerance * max(values[0], 0.0)).all():
            return values[:wanted], vectors[:, :wanted] / np.linalg.norm(vectors[:, :wanted], axis=0), passes
        new = orthonormal(out, basis, max(values[0], np.finfo(float).tiny), rng)


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, block: int = BLOCK, tolerance: float = TOLERANCE) -> DataFrame:
    """A row for each whole vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped, as are entries of
    2 ** 40 and more, and vectors of another length than most have (of two lengths equally common, the
    larger stays). Null and repeated vec_ids stay, each row for itself. Components without variance have
    no row, so one vector alone, equal vectors or an empty table give none. Equal eigenvalues: any
    orthonormal basis of theirs, the same for all rows. A deviation that no long can hold is null (from
    about two million rows of 64 entries of a spread of 0.125 on); the explained shares don't need it. Other columns are ignored.

    Spark reads the vectors once for each block of the basis and five times more (lengths, sums,
    whitened covariance, results); only sums of dims x block numbers come to the driver.
    """
    kind = embeddings.schema[vec_id].dataType.simpleString()
    shape = f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit, rows = fit_list(whole(embeddings, vec_id, vector))
    if fit is None:
        return embeddings.sparkSession.createDataFrame([], shape)
    trace = 0.0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal trace

        def part(batch: pa.RecordBatch) -> np.ndarray:
            c = fit.centred(batch)
            return np.append((c.T @ (c @ q)).ravel(), (c * c).sum())

        *flat, trace = added(rows.select("v"), part) / fit.n
        return np.array(flat).reshape(q.shape)

    values, vectors, _ = block_lanczos(product, fit.dims, min(components, fit.dims), block, tolerance)
    real = values > ZERO * max(values[0], np.finfo(float).tiny)
    values, vectors = values[real], vectors[:, real]
    k = len(values)
    if not k:
        return embeddings.sparkSession.createDataFrame([], shape)
    maps, explained = vectors / np.sqrt(values), (values / trace).tolist()

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w = fit.centred(batch) @ maps
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    got = added(rows.select("v"), moments) / fit.n
    mean = got[k * k :]
    error = float(np.abs(got[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m:
                again = pa.array(np.repeat(np.arange(m), k))
                number = np.tile(np.arange(1, k + 1, dtype=np.int32), m)
                columns = [batch.column(0).take(again), pa.array(number), pa.array(np.full(m * k, fit.n)), pa.array(fit.squares(batch), pa.int64()).take(again)]
                columns += [pa.array((fit.centred(batch) @ maps).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names=[vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, shape)
