"""Embedding whitening (operator 11): leading principal components by a Jacobi-Davidson method, without a covariance matrix.

Each entry c becomes the integer x = floor(64 c) + 1000000, so counts and sums are exact.  The vectors are packed once
into blocks of rows (written table); after that everything that needs all rows is one *distributed centred product*:
a task turns its blocks into C = (n x - S) / n (an exact integer difference, divided once) and adds up C^T (C Q) for
a thin matrix Q; Spark adds up the cells of the tasks.  The d x d covariance is never formed.

The driver holds d x m matrices only (d: width of a vector, m: at most BASIS columns), and works on them:

* Rayleigh-Ritz in the basis gives the leading pairs (theta, u) and their residuals r = V u - theta u.
* For each pair not yet exact, the correction (I - U U^T)(V - theta I)(I - U U^T) t = -r is solved by a few steps of
  MINRES, all columns side by side, so that a step is one distributed product.
* Pairs at double precision are locked: they stay in the basis and in U, but get no more corrections.  The basis is
  extended by the corrections, and restarted from its leading Ritz vectors when it is full.
* In the end the products of the Ritz vectors are taken afresh, and the work goes on unless they pass as well.

Defined results: a vector that is null or holds null or non-finite entries is dropped; so is one whose length is not
the most frequent (of equally frequent ones the largest) length of the table; null vec_id stays; repeated rows count
as often as they stand; components whose eigenvalue is 0 (up to rounding) can't be whitened and are left out, so one
row, or equal rows only, give no rows; entries beyond +-2^56 count as that; deviation is null where it does not fit in
a long; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import written

COMPONENTS = 32
OFFSET = 1_000_000
FACTOR = 64
BLOCK_BYTES = 4_000_000
#: Columns of the basis, MINRES steps a correction, and residuals (of the largest eigenvalue) that count as exact or,
#: where rounding in the sums lets them shrink no further, as the end.
BASIS = 4 * COMPONENTS
INNER_STEPS = 8
EXACT = 2.0 ** -45
FLOOR = 1e-11
OUTER_STEPS = 300
_WIDE = 2 ** 62

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_BLOCK = pa.schema([("d", pa.int32()), ("vec_id", pa.list_(pa.int64())), ("top", pa.int64()), ("kind", pa.string()), ("x", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, embedding -> blocks of at most BLOCK_BYTES of integer rows of one length."""
    for batch in batches:
        ids, column = batch.column("vec_id"), batch.column("embedding")
        there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        lists = column.take(pa.array(there))
        ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].astype(np.int64)
        values = lists.flatten()
        c = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
        bad = np.r_[0, np.cumsum(~np.isfinite(c))]
        good = bad[ends[1:]] == bad[ends[:-1]]
        length = np.diff(ends)
        for d in np.unique(length[good & (length > 0)]):
            rows = np.flatnonzero(good & (length == d))
            step = max(1, BLOCK_BYTES // (8 * int(d)))
            for i in range(0, len(rows), step):
                some = rows[i: i + step]
                wide = c[ends[some][:, None] + np.arange(d)]
                x = np.floor(FACTOR * np.clip(wide, -2.0 ** 56, 2.0 ** 56)).astype(np.int64) + OFFSET
                top = int(np.abs(x).max())
                kind = "<i4" if top < 2 ** 31 else "<i8"
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([ids.take(pa.array(there[some])).to_pylist()], _BLOCK.field("vec_id").type),
                                                  pa.array([top]), pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], schema=_BLOCK)


class Blocks:
    """The packed rows, and sums over all of them."""

    def __init__(self, table: DataFrame):
        self.d = self.n = 0
        sizes = table.groupBy("d").agg(F.sum(F.size("vec_id")).alias("n"), F.max("top").alias("top"))
        best = sizes.orderBy(F.desc("n"), F.desc("d")).first()
        if best is None:
            return
        self.d, self.n = best.d, best.n
        self.table = table.filter(F.col("d") == self.d)
        self.narrow = self.n * best.top < _WIDE // 4
        # Sums of the upper and lower halves stay in 64 bits; the driver puts them together.
        halves = self._cells(lambda x: np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]), "long", centred=False)
        self.sums = [int(a) * 2 ** 32 + int(b) for a, b in zip(halves[: self.d], halves[self.d:], strict=True)]

    def _cells(self, part: Callable[[np.ndarray], np.ndarray], kind: str, centred: bool = True) -> np.ndarray:
        """Sum of part(rows) over all blocks, cell by cell: added up in each task, then by Spark."""
        opened = self.opened if centred else _integers

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x in opened(batch):
                    more = part(x)
                    total = more if total is None else total + more
            if total is not None:
                flat = np.asarray(total).reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "value"])

        rows = self.table.select("d", "kind", "x").mapInArrow(add, f"cell long, value {kind}").groupBy("cell").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(rows), dtype=np.int64 if kind == "long" else np.float64)
        for r in rows:
            out[r.cell] = r.value
        return out

    @property
    def opened(self) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
        differences, n = self.differences, self.n

        def opened(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            return (x.astype(np.float64) / n for x in differences(batch))
        return opened

    @property
    def differences(self) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
        """n x - S, exact: in 64 bits, or by Python's integers where those are too few."""
        n, kind = self.n, np.int64 if self.narrow else object
        sums = np.array(self.sums, dtype=kind)
        return lambda batch: (x.astype(kind) * n - sums for x in _integers(batch))

    def sum(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return self._cells(part, "double")

    def product(self, q: np.ndarray) -> np.ndarray:
        """V q for the covariance V."""
        return self.sum(lambda c: c.T @ (c @ q)).reshape(q.shape) / self.n


def _integers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for d, kind, x in zip(batch.column("d").to_pylist(), batch.column("kind").to_pylist(), batch.column("x"), strict=True):
        yield np.frombuffer(x.as_buffer(), dtype=kind).reshape(-1, d).astype(np.int64)


def _minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of apply(t) = b for symmetric ``apply``, one per column, all columns a step at a time."""
    norm = np.linalg.norm(b, axis=0)
    beta, eta = norm.copy(), norm.copy()
    v, v_old = b / norm, np.zeros_like(b)
    w, w_old, t = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c = c_old = np.ones_like(norm)
    s = s_old = np.zeros_like(norm)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, following)
        live = (rho > 0) & (np.abs(eta) > 1e-3 * norm)
        if not live.any():
            break
        rho = np.where(rho > 0, rho, 1.0)
        w, w_old = (v - s_old * beta * w_old - (s * alpha + c_old * c * beta) * w) / rho, w
        c, c_old, s, s_old = delta / rho, c, following / rho, s
        t = np.where(live, t + c * eta * w, t)
        eta = np.where(live, -s * eta, eta)
        v, v_old, beta = p / np.where(following > 0, following, 1.0), v, following
    return t


def _new_directions(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of t add to ``basis`` (orthogonalised twice)."""
    t = t / np.maximum(np.linalg.norm(t, axis=0), 1e-300)
    for _ in range(2):
        t = t - basis @ (basis.T @ t)
    u, size, _ = np.linalg.svd(t, full_matrices=False)
    u = u[:, size > 1e-10]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, basis: int = BASIS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of the symmetric d x d matrix behind ``product``."""
    basis = max(basis, 3 * k)
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((d, min(d, k + 8))))[0]
    w, best, stalled, fresh = product(q), np.inf, 0, True
    for _ in range(OUTER_STEPS):
        h = q.T @ w
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        u = q @ y[:, :k]
        r = w @ y[:, :k] - u * theta[:k]
        left = np.linalg.norm(r, axis=0) / max(theta[0], 1e-300)
        unlocked = np.flatnonzero(left > EXACT)
        worst = float(left.max())
        best, stalled = (worst, 0) if worst < best / 2 else (best, stalled + 1)
        if not len(unlocked) or (worst <= FLOOR and stalled >= 2) or theta[0] <= 0:
            if fresh:
                return theta[:k], u
            # The last word has a product of the Ritz vectors themselves, not one carried along by rotations.
            q = np.linalg.qr(np.hstack([u, q @ y[:, k: 2 * k]]))[0]
            w, fresh = product(q), True
            continue
        some = theta[unlocked]

        def projected(t: np.ndarray, u=u, some=some) -> np.ndarray:
            t = t - u @ (u.T @ t)
            t = product(t) - t * some
            return t - u @ (u.T @ t)

        if q.shape[1] == d:  # Rayleigh-Ritz in the whole space: only rounding is left
            q = np.linalg.qr(q @ y)[0]
            w, fresh = product(q), True
            stalled += 1
            continue
        if q.shape[1] + len(unlocked) > min(basis, d) and q.shape[1] > 2 * k:
            q, w = q @ y[:, : 2 * k], w @ y[:, : 2 * k]
        residual = r[:, unlocked] - u @ (u.T @ r[:, unlocked])
        more = _new_directions(_minres(projected, -residual, INNER_STEPS), q)[:, : d - q.shape[1]]
        if not more.shape[1]:
            more = _new_directions(rng.standard_normal((d, min(4, d - q.shape[1]))), q)
        q, w, fresh = np.hstack([q, more]), np.hstack([w, product(more)]), False
    raise ArithmeticError(f"Jacobi-Davidson did not converge in {OUTER_STEPS} steps (residual {best:.1e})")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining vector and component."""
    spark = embeddings.sparkSession
    table = written(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        _pack, "d int, vec_id array<long>, top long, kind string, x binary"), "vectors")
    blocks = Blocks(table)
    if not blocks.n:
        return spark.createDataFrame([], SCHEMA)
    trace = float(blocks.sum(lambda c: (c * c).sum(axis=0)).sum()) / blocks.n
    if trace <= 0:
        return spark.createDataFrame([], SCHEMA)
    values, vectors = jacobi_davidson(blocks.product, blocks.d, min(components, blocks.d))
    # Of a matrix of lower rank the other eigenvalues are rounding errors of the sums.
    there = values > max(values[0], 0.0) * 1e-12
    values, vectors = values[there], vectors[:, there]
    k, n = len(values), blocks.n
    scaled = vectors / np.sqrt(values)
    mean = blocks.sum(lambda c: (c @ scaled).sum(axis=0)) / n

    def gram(c: np.ndarray) -> np.ndarray:
        z = c @ scaled - mean
        return z.T @ z

    error = float(np.abs(blocks.sum(gram).reshape(k, k) / n - np.eye(k)).max())
    differences, narrow, explained = blocks.differences, blocks.narrow, values / trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("vec_id"), differences(batch), strict=True):
                z = (x.astype(np.float64) / n) @ scaled
                if narrow and float(np.abs(x).max()) ** 2 * x.shape[1] < _WIDE:
                    deviation = pa.array((x * x).sum(axis=1), pa.int64())
                else:
                    exact = (sum(v * v for v in row) for row in x.astype(object).tolist())
                    deviation = pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())
                every = np.repeat(np.arange(len(x)), k)
                m = len(every)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.repeat(pa.scalar(n, pa.int64()), m),
                    deviation.take(pa.array(every)), pa.array(z.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.repeat(pa.scalar(error), m)],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.table.select("d", "kind", "x", "vec_id").mapInArrow(rows, SCHEMA)
