"""Whitening of embeddings by spectral divide and conquer (operator 12).

Entries c become integers x = floor(256 c). Counts, sums and the centred
covariance of the distinct x vectors are summed in the tasks and merged in two
levels; the driver gets a few sums per dimension and one d x d matrix for each
length of vector. There the matrix is taken apart: the polar factor of the
matrix less a shift, found by dynamically weighted Halley steps (QDWH), tells
the eigenvalues above the shift from those below, so (factor + 1) / 2 projects
onto the subspace above; in orthonormal bases of both sides the matrix falls
into two smaller ones, and so on down to single components. Only the parts that
can hold a wanted component are followed. Means and components are broadcast and
the rows whitened where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.llm.common import stored

SCALE = 256.0
COMPONENTS = 4
SLICES = 64
# What the covariances of all lengths of vector may take on the driver.
MODEL_BYTES = 256 << 20
_EPS = np.finfo(float).eps

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, n_dims int")


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of every row whose vector has finite entries only."""
    vec = F.col(vec_col).cast("array<double>")
    fit = vec.isNotNull() & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.filter(F.coalesce(fit, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vec, lambda c: F.floor(c * F.lit(SCALE))).alias("x")))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as one matrix) for each length in a list column."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        part = column if len(rows) == len(sizes) else column.take(pa.array(rows))
        yield rows, part.flatten().to_numpy().reshape(-1, d)


def _summed(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray | None], dtype: str) -> dict[int, np.ndarray]:
    """Per length d, the sum over all rows of ``measure(matrix)``, a matrix of any
    fixed shape for that d. One message per line of it and task; lines are added up
    by slice of the tasks, then over the slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_length(batch.column(0)):
                got = measure(x)
                if got is not None:
                    held[x.shape[1]] = held.get(x.shape[1], 0) + np.atleast_2d(got)
        part = TaskContext.get().partitionId() % SLICES
        for d, lines in held.items():
            k = len(lines)
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * k, pa.int32()), "line": pa.array(range(k), pa.int32()), "slice": pa.array([part] * k, pa.int32()),
                "part": pa.array([line.astype(dtype).tobytes() for line in lines], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer(), dtype) for p in table["part"])
        first = table.slice(0, 1)
        return first.set_column(first.schema.get_field_index("part"), "part", pa.array([total.tobytes()], pa.binary()))

    schema = "d int, line int, slice int, part binary"
    lines = rows.select("x").mapInArrow(run, schema)
    lines = lines.groupBy("d", "line", "slice").applyInArrow(add, schema).groupBy("d", "line").applyInArrow(add, schema)
    out: dict[int, list] = {}
    for r in sorted(lines.collect(), key=lambda r: (r["d"], r["line"])):
        out.setdefault(r["d"], []).append(np.frombuffer(bytes(r["part"]), dtype))
    return {d: np.array(v) for d, v in out.items()}


# --- QDWH ----------------------------------------------------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its matrix sign, by
    dynamically weighted Halley steps (by QR while badly conditioned, then by
    Cholesky)."""
    m = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / (np.sqrt(m) * np.linalg.norm(np.linalg.inv(x), 1))
    except np.linalg.LinAlgError:
        low = _EPS
    low, eye = min(max(low, _EPS), 1.0), np.eye(m)
    for _ in range(30):
        l2 = low * low
        step = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + step)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * step + 8 * (2 - l2) / (l2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))[0]
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * q[:m] @ q[m:].T
        else:
            lower = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if moved <= np.cbrt(5 * _EPS) and 1 - low <= 10 * _EPS:
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int, float] | None:
    """(orthonormal basis, k, coupling): the first k columns span the eigenvectors
    above the shift, the others those below; None if all are on one side."""
    m = len(a)
    projector = (polar_factor(a - shift * np.eye(m)) + np.eye(m)) / 2
    k = round(np.trace(projector))
    if not 0 < k < m:
        return None
    basis = rng.normal(size=(m, m))
    for _ in range(3):  # each further round takes out what a random start left of the other side
        above = projector @ basis[:, :k]
        below = basis[:, k:] - projector @ basis[:, k:]
        basis = np.linalg.qr(np.concatenate([above, below], axis=1))[0]
    return basis, k, float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))


def leading_components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns): the ``most`` leading ones
    of a symmetric matrix, by divide and conquer on spectral projectors."""
    scale, rng = np.linalg.norm(matrix), np.random.default_rng(11)
    tiny = 4 * len(matrix) * _EPS * scale
    found: list[np.ndarray] = []

    def follow(a: np.ndarray, basis: np.ndarray, want: int) -> None:
        m, diagonal = len(a), np.diag(a)
        if want <= 0:
            return
        if m == 1 or np.linalg.norm(a - np.mean(diagonal) * np.eye(m)) <= tiny:
            found.extend(basis.T[np.argsort(-diagonal, kind="stable")][:want])  # one value: any basis is one of eigenvectors
            return
        middle, width = np.mean(diagonal), np.linalg.norm(a - np.mean(diagonal) * np.eye(m)) / np.sqrt(m)
        best = None  # the mean lies strictly between the least and the largest eigenvalue
        for shift in (np.median(diagonal), middle, *(middle + f * width for f in (0.1, -0.1, 0.23, -0.23, 0.41, -0.41))):
            got = _split(a, shift, rng)
            if got and (best is None or got[2] < best[2]):
                best = got
            if best and best[2] <= tiny:
                break
        if best is None:  # not told apart in double precision
            found.extend(basis.T[np.argsort(-diagonal, kind="stable")][:want])
            return
        q, k, _ = best
        upper, lower = q[:, :k], q[:, k:]
        for side, wanted in ((upper, want), (lower, want - k)):
            part = side.T @ a @ side
            follow((part + part.T) / 2, basis @ side, wanted)

    follow((matrix + matrix.T) / 2, np.eye(len(matrix)), min(most, len(matrix)))
    vectors = np.linalg.qr(np.array(found).T)[0]
    values = np.einsum("ij,ik,kj->j", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- the operator --------------------------------------------------------------------------------------------------

@dataclass
class Whitening:
    """For one length of vector: the fit list's size and sums, and per component the
    column that whitens centred vectors (NaN for a component without variance)."""

    n: int
    sums: list[int]
    mean: np.ndarray
    columns: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(float) - self.mean) @ self.columns

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of n x - S, exactly; None beyond the range of a long."""
        most = max(int(x.max()), -int(x.min()), 1)
        if (self.n * most + max(map(abs, self.sums))) ** 2 * x.shape[1] < 1 << 63:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            return (apart * apart).sum(axis=1).tolist()
        exact = (sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of vector, from the distinct x vectors (stored)."""
    def count_and_sums(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)])  # halves, so that sums can't overflow

    first = _summed(distinct, count_and_sums, "<i8")
    if 8 * sum(d * d for d in first) > MODEL_BYTES:
        raise ValueError(f"covariances of vectors of {sorted(first)} entries exceed {MODEL_BYTES} bytes")
    sizes = {d: int(v[0, 0]) for d, v in first.items()}
    sums = {d: [(int(h) << 32) + int(w) for h, w in zip(v[0, 1:1 + d], v[0, 1 + d:], strict=True)] for d, v in first.items()}
    means = {d: np.array([s / sizes[d] for s in v]) for d, v in sums.items()}

    def products(x: np.ndarray) -> np.ndarray:
        y = x.astype(float) - means[x.shape[1]]
        return y.T @ y

    models = {}
    for d, total in _summed(distinct, products, "<f8").items():
        covariance = total / sizes[d]
        trace = float(np.trace(covariance))
        values, vectors = leading_components(covariance, components)
        held = values > d * _EPS * trace
        columns = vectors / np.where(held, np.sqrt(np.where(held, values, 1.0)), np.nan)
        models[d] = Whitening(sizes[d], sums[d], means[d], columns,
                              np.maximum(values, 0) / trace if trace > 0 else np.full(len(values), np.nan))

    def moments(x: np.ndarray) -> np.ndarray:
        w = np.nan_to_num(models[x.shape[1]].whiten(x))
        return np.concatenate([w.sum(0)[None], w.T @ w])

    for d, total in _summed(distinct, moments, "<f8").items():
        m = models[d]
        held = ~np.isnan(m.columns[0])
        if held.any():
            mean = total[0] / m.n
            error = total[1:] / m.n - np.outer(mean, mean) - np.eye(len(mean))
            m.identity_error = float(np.abs(error[np.ix_(held, held)]).max())
    return models


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and
    n_dims, one row per vector and leading component.

    Defined cases: vectors that are null or hold null or non-finite entries are left
    out; vectors of different lengths are whitened by length, each with its own fit
    list, sums and components; vectors without entries have no component and give no
    row; fewer entries than ``components`` give as many components as entries; an id
    may be null or repeated, every row is its own vector; a component without
    variance has null in ``whitened`` (all of them, if one distinct vector is all
    there is; then ``explained`` and ``identity_error`` are null too); entries beyond
    the range of a long count as its bounds; a deviation beyond that range is null;
    an empty table gives no rows. Other columns are not read, whatever their names.
    ``identity_error`` and equal vectors: over the fit list, each distinct vector once."""
    rows = integer_rows(vectors, id_col, vec_col)
    models = fit(stored(rows.select("x").distinct(), "whitening-fit"), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _by_length(batch["x"]):
                m, d = models[x.shape[1]], x.shape[1]
                k, n = m.columns.shape[1], len(x)
                w = m.whiten(x).ravel()
                each = np.repeat(np.arange(n), k)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, m.n)), pa.array(m.deviation(x), pa.int64()).take(pa.array(each)),
                     pa.array(w, mask=np.isnan(w)), pa.array(np.tile(m.explained, n), mask=np.isnan(np.tile(m.explained, n))),
                     pa.array([m.identity_error] * (n * k), pa.float64()), pa.array(np.full(n * k, d, np.int32))],
                    [f.split()[0] for f in RESULT.split(", ")])

    return rows.mapInArrow(run, RESULT)
