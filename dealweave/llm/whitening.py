"""Whitening of embeddings by the leading eigenvectors of their covariance, found by block Jacobi-Davidson.

The covariance V is never formed. What the method asks of it are products with a few vectors: tasks centre their rows exactly,
in whole numbers, multiply them, and Spark adds up one small matrix a task. The driver holds only matrices of a vector's length
by a few columns. Every round it takes the Ritz pairs of its subspace; those whose residuals reach double precision are
locked, from the largest down; for all others the projected correction equations

    (I - Q Q') (V - e I) (I - Q Q') t = -r,    Q: the locked vectors and the wanted Ritz vectors

are solved approximately by MINRES, all of them side by side, so that one pass over the data serves one step of each. The
solutions widen the subspace, which is cut back to its best part when it has grown too large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, settle

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
INNER = 6
#: Subspace columns, in multiples of the components, beyond which it is cut back.
WIDEST = 4
BLOCK_ROWS = 4096
#: Residuals up to so many units of rounding, of the largest eigenvalue, count as double precision.
ROUNDING = 16
MOST_ROUNDS = 200
#: Entries beyond are taken as this; whole numbers up to it have room for the shift.
_LARGEST = 2.0**62


# --- rows -----------------------------------------------------------------------------------------------------------


def rounded(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(64 c) + 1000000 of each entry c, of the vectors that are not null and whose entries all are finite numbers.

    Of vectors of several lengths only those of the most frequent one remain (ties: the shortest); vectors of no entries never do.
    """
    parts = F.col(vec_col).cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(vec_col).isNotNull()).filter(~bad & (F.size(F.col(vec_col)) > 0))
    lengths = rows.groupBy(F.size(F.col(vec_col)).alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.filter(F.size(F.col(vec_col)) == (lengths["d"] if lengths else 0))
    within = lambda x: F.greatest(F.least(F.floor(x * SCALE).cast("double"), F.lit(_LARGEST)), F.lit(-_LARGEST))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(parts, lambda x: within(x).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0))
        for lo in range(0, len(x), BLOCK_ROWS):
            part = x[lo:lo + BLOCK_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["k", "x"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The lists, all of one length, as rows."""
    flat = np.asarray(column.flatten()).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit numbers where they have room, else Python's."""
    reach = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if reach < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


@dataclass
class Fit:
    """The distinct vectors, in blocks in a shared folder, with their number and sums."""

    blocks: DataFrame
    d: int
    n: int
    sums: list[int]

    @classmethod
    def of(cls, rows: DataFrame, folder: str) -> Fit:
        """Counts and sums are exact: entries are added as decimals, which hold any sum of longs."""
        distinct = rows.select("x").distinct()
        blocks = settle(distinct.mapInArrow(_blocks, "k int, x binary"), folder)
        n = int(blocks.agg(F.sum("k")).first()[0] or 0)
        sums = blocks.mapInArrow(_sums, "i int, high long, low long").groupBy("i").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("h"), F.sum(F.col("low").cast("decimal(38,0)")).alias("l"))
        sums = [int(r["h"]) * 2**32 + int(r["l"]) for r in sums.orderBy("i").collect()]
        return cls(blocks, len(sums), n, sums)

    def add_up(self, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all centred blocks of what ``make`` gives for one: a matrix whose size no row number enters."""
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    x = np.frombuffer(raw, np.int64).reshape(-1, len(sums))
                    got = make(_centred(x, n, sums).astype(np.float64) / n)
                    total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["i", "y"])

        parts = self.blocks.select("x").mapInArrow(run, "i int, y double").groupBy("i").agg(F.sum("y").alias("y"))
        return parts.orderBy("i").toPandas()["y"].to_numpy()

    def product(self, z: np.ndarray) -> np.ndarray:
        """V z of a few columns z."""
        return self.add_up(lambda c: c.T @ (c @ z)).reshape(z.shape) / self.n


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the high and the low 32 bits of each entry's numbers, by block: both have room."""
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(raw, np.int64).reshape(k, -1)
            high = (x >> 32).sum(0)
            low = (x & 0xFFFFFFFF).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1]), pa.int32()), pa.array(high), pa.array(low)], names=["i", "high", "low"])


# --- the method -----------------------------------------------------------------------------------------------------


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of A_j x_j = b_j for all columns j, the symmetric A_j applied side by side by ``product``."""
    k = b.shape[1]
    x, old, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    go = beta > 0
    v = np.divide(b, beta, out=np.zeros_like(b), where=go)
    eta, beta = beta.copy(), np.zeros(k)
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    for _ in range(steps):
        if not go.any():
            break
        p = product(v) - beta * old
        alpha = (v * p).sum(0)
        p -= alpha * v
        after = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, after)
        r2, r3 = s * alpha + c_old * c * beta, s_old * beta
        go = go & (r1 > 0)
        safe = np.where(r1 > 0, r1, 1.0)
        w_old, w = w, (v - r3 * w_old - r2 * w) / safe
        c_old, c, s_old, s = c, delta / safe, s, after / safe
        x += np.where(go, c * eta, 0.0) * w
        eta = -s * eta
        go = go & (after > 1e-300)
        old, v, beta = v, np.divide(p, after, out=np.zeros_like(p), where=after > 1e-300), after
    return x


def _fresh(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``t`` add to the orthonormal ``bases``."""
    out = np.zeros((len(t), 0))
    for j in range(t.shape[1]):
        u = t[:, j]
        size = np.linalg.norm(u)
        if not size:
            continue
        u = u / size
        for _ in range(3):
            for q in (*bases, out):
                u = u - q @ (q.T @ u)
            left = np.linalg.norm(u)
            if left < 1e-10:
                break
            u = u / left
        else:
            out = np.hstack([out, u[:, None]])
    return out


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int = COMPONENTS, inner: int = INNER, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric operator on d entries, falling, their unit vectors, and their residuals' norms.

    ``product`` applies the operator to the columns of a matrix. Ends when every residual is within ROUNDING units of rounding of
    the largest eigenvalue, or when no direction is left that the subspace lacks.
    """
    k = min(k, d)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, min(d, k + 2))))[0]
    vq = product(q)
    x, vx = np.zeros((d, 0)), np.zeros((d, 0))  # locked
    for _ in range(MOST_ROUNDS):
        values, y = _ritz(q, vq)
        u, vu = q @ y, vq @ y
        want = k - x.shape[1]
        r = vu[:, :want] - u[:, :want] * values[:want]
        norms = np.linalg.norm(r, axis=0)
        top = max([abs(values[0]), *np.abs((x * vx).sum(0))])
        good = norms <= ROUNDING * np.finfo(float).eps * np.sqrt(d) * top
        lock = int(np.argmin(np.r_[good, False]))
        if lock == want:
            break
        x, vx = np.hstack([x, u[:, :lock]]), np.hstack([vx, vu[:, :lock]])
        u, vu, values, r, good = u[:, lock:], vu[:, lock:], values[lock:], r[:, lock:], good[lock:]
        want -= lock
        away = np.hstack([x, u[:, :want]])
        theta = values[:want][~good]

        def off(z, away=away):
            return z - away @ (away.T @ z)

        def corrected(z, theta=theta):
            z = off(z)
            return off(product(z) - z * theta)

        t = off(minres(corrected, -off(r[:, ~good]), inner))
        if u.shape[1] + t.shape[1] > WIDEST * k:
            u, vu = u[:, :want + k], vu[:, :want + k]
        new = _fresh(t, x, u)
        if not new.shape[1]:  # the corrections are rounding: any other direction
            new = _fresh(np.random.default_rng(seed + 1).normal(size=(d, min(want, d - x.shape[1] - u.shape[1]))), x, u)
            if not new.shape[1]:
                break
        q, vq = np.hstack([u, new]), np.hstack([vu, product(new)])
        q, vq = _orthonormal(q, vq)
    q, vq = _orthonormal(np.hstack([x, q]), np.hstack([vx, vq]))
    values, y = _ritz(q, vq)
    u, vu = q @ y[:, :k], vq @ y[:, :k]
    size = np.linalg.norm(u, axis=0)
    return values[:k], u / size, np.linalg.norm(vu - u * values[:k], axis=0)


def _orthonormal(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``q`` made orthonormal to the last digit, and its products with it."""
    q2, r = np.linalg.qr(q)
    return q2, np.linalg.solve(r.T, vq.T).T


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, falling, and coordinates of the Ritz vectors."""
    h = q.T @ vq
    values, y = np.linalg.eigh((h + h.T) / 2)
    return values[::-1], y[:, ::-1]


# --- the operator ---------------------------------------------------------------------------------------------------

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


@dataclass
class Model:
    """What whitens: number and sums of the fit list, eigenvalues, vectors, their residuals, the trace, the measured error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def spread(self) -> np.ndarray:
        """sqrt(e); nan where e is zero but for rounding."""
        real = self.values > 1e-12 * max(self.trace, 0)
        return np.where(real, np.sqrt(np.maximum(self.values, 0)), np.nan)


def fit(rows: DataFrame, folder: str, components: int = COMPONENTS) -> Model:
    """The model of the distinct x of ``rows`` (:func:`rounded`)."""
    data = Fit.of(rows, folder)
    if not data.n:
        return Model(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, None)
    trace = float(data.add_up(lambda c: np.array([(c * c).sum()]))[0]) / data.n
    values, vectors, residuals = eigenpairs(data.product, data.d, components)
    model = Model(data.n, data.sums, values, vectors, residuals, trace, None)
    spread = model.spread
    sure = ~np.isnan(spread)
    if sure.any():
        onto = vectors[:, sure] / spread[sure]
        mean = data.add_up(lambda c: (c @ onto).sum(0)) / data.n
        own = data.add_up(lambda c: (w := c @ onto - mean).T @ w).reshape(len(mean), -1) / data.n
        model.identity_error = float(np.abs(own - np.eye(len(mean))).max())
    return model


def apply(rows: DataFrame, model: Model) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained) of every row of :func:`rounded`, one row a component."""
    n, sums, k = model.n, model.sums, len(model.values)
    onto = model.vectors / model.spread if k else model.vectors
    explained = [float(e) / model.trace if model.trace else None for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            c = _centred(_matrix(batch.column(1)), n, sums)
            w = ((c.astype(np.float64) / n) @ onto).ravel()
            if c.dtype == object or int(np.abs(c).max()) ** 2 * len(sums) >= 2**63:
                exact = [sum(int(v) ** 2 for v in row) for row in c]
                exact = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            else:
                exact = pa.array((c * c).sum(1))
            each = np.repeat(np.arange(len(batch)), k)
            own = [pa.array(batch.column(0)).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(batch)), pa.int32()), pa.array(np.full(len(each), n)), exact.take(pa.array(each))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(w, from_pandas=True), pa.array(explained * len(batch), pa.float64())], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, _OUT)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every remaining vector and component.

    Which vectors remain, see :func:`rounded`; of fewer entries than components each has as many as entries. Repeated rows are returned as often as
    they occur but fitted once; a null id stays null; other columns are ignored; no vectors, no rows. A component whose eigenvalue is zero (but
    for rounding) has no whitened value: it is null and does not enter identity_error, which is null if there is no other component. deviation is
    null where it does not fit a long, explained where all vectors are equal.
    """
    spark: SparkSession = vectors.sparkSession
    folder = scratch(spark, "whitening")
    rows = settle(rounded(vectors, id_col, vec_col), f"{folder}/rows")
    model = fit(rows, f"{folder}/fit", components)
    return apply(rows, model).withColumn("identity_error", F.lit(model.identity_error).cast("double"))


def op12(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
