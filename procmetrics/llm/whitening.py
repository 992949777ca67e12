"""Whitening of embeddings along principal components found by Jacobi-Davidson.

The covariance is never formed. Its product with a few directions is a job over the stored fit list: each task centres its
vectors first, then multiplies, and the tasks' partial products (dimensions x directions) are added by Spark. The driver
holds only matrices of that shape. Starting from a random block, each round takes Ritz pairs of the subspace, locks
those whose residual is at double precision, corrects the others by the projected equation
(I - QQ')(V - theta I)(I - QQ') t = -r, solved by a few MINRES steps for all of them at once, and widens the subspace by the
corrections.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: Components that are returned, and an entry c's integer, floor(SCALE * c) + OFFSET.
COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Entries must be smaller than this after scaling: a deviation has to fit 64 bits.
LARGEST = 1 << 31
#: Vectors in a stored block.
BLOCK = 4096
#: Ritz vectors beside the wanted ones in the first block, MINRES steps of a correction, and rounds until an error is raised.
GUARD, INNER, ROUNDS = 8, 3, 200
#: A residual has reached double precision at this share of the largest eigenvalue, times the root of the dimension.
PRECISION = 16 * np.finfo(np.float64).eps

OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def points(vectors: DataFrame) -> DataFrame:
    """vec_id and x of every row that takes part."""
    d = vectors.where("embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("e"))
    d = d.where((F.size("e") > 0) & ~F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    usual = d.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = d.where(F.size("e") == F.lit(usual.d if usual else 0))
    scaled = F.transform("e", lambda c: F.when(F.abs(c * SCALE) < LARGEST, F.floor(c * SCALE) + OFFSET).otherwise(
        F.raise_error(F.lit("an entry is too large for a deviation of 64 bits")).cast("long")))
    return d.select("vec_id", scaled.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(y):
        return pa.RecordBatch.from_arrays(
            [pa.array([len(y)], pa.int64()), pa.array([y.sum(axis=0, dtype=np.int64).tolist()], pa.list_(pa.int64())),
             pa.array([y.astype("<i4").tobytes()], pa.binary())], names=["n", "sums", "y"])

    held, rows = [], 0
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            held.append(_matrix(part.column(0)) - OFFSET)
            rows += part.num_rows
            if rows >= BLOCK:
                yield block(np.concatenate(held))
                held, rows = [], 0
    if rows:
        yield block(np.concatenate(held))


class FitList:
    """Each distinct vector once, in stored blocks, with their number, exact sums and centred products."""

    def __init__(self, x: DataFrame):
        blocks = x.select("x").distinct().mapInArrow(_packed, "n long, sums array<long>, y binary")
        self.blocks = store(blocks, "fit-list")
        exact = F.sum(F.col("s").cast("decimal(38,0)"))
        sums = (self.blocks.select("n", F.posexplode("sums").alias("j", "s")).groupBy("j")
                .agg(F.sum("n").alias("n"), exact.alias("s")).orderBy("j").collect())
        self.n, self.dim = (sums[0].n, len(sums)) if sums else (0, 0)
        #: Sums of x less OFFSET, exact; and their mean.
        self.sums = [int(r.s) for r in sums]
        self.mean = np.array([float(Fraction(s, self.n)) for s in self.sums])
        self.jobs = 0

    def added(self, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """The sum of ``part(centred vectors)``, a matrix of ``width`` columns, over all blocks."""
        mean, dim = self.mean, self.dim

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for raw in b.column(0):
                    y = np.frombuffer(raw.as_buffer(), "<i4").reshape(-1, dim)
                    one = part(y - mean)
                    total = one if total is None else total + one
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total)), pa.int32()), *(pa.array(c) for c in np.ascontiguousarray(total.T))],
                    names=["j", *(f"c{i}" for i in range(width))])

        self.jobs += 1
        columns = [f"c{i}" for i in range(width)]
        parts = self.blocks.select("y").mapInArrow(run, ", ".join(["j int", *(f"{c} double" for c in columns)]))
        rows = parts.groupBy("j").agg(*(F.sum(c).alias(c) for c in columns)).collect()
        out = np.zeros((len(rows), width))
        for r in rows:
            out[r.j] = r[1:]
        return out

    def product(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``u``."""
        return self.added(lambda c: c.T @ (c @ u), u.shape[1]) / self.n


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``t`` add to ``against``; directions that add nothing are left out."""
    t = t / np.maximum(np.linalg.norm(t, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        for a in against:
            t = t - a @ (a.T @ t)
        left, size, _ = np.linalg.svd(t, full_matrices=False)
        t = left[:, size > 1e-10]
    for a in against:
        t = t - a @ (a.T @ t)
    return np.linalg.qr(t)[0]


def _corrections(product, theta: np.ndarray, u: np.ndarray, r: np.ndarray, locked: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of the projected correction equations, one a column, by ``steps`` MINRES steps in common."""
    def project(t):
        t = t - locked @ (locked.T @ t)
        return t - u * (u * t).sum(axis=0)

    def over(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)

    b = project(-r)
    beta = np.linalg.norm(b, axis=0)
    v_old, v = np.zeros_like(b), over(b, np.broadcast_to(beta, b.shape))
    eta, beta = beta.copy(), np.zeros_like(beta)
    c_old = c = np.ones_like(eta)
    s_old = s = np.zeros_like(eta)
    w_old, w, x = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    for _ in range(steps):
        p = project(product(v) - theta * v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        after = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        one, two, three = np.hypot(delta, after), s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old = c, s
        c, s = over(delta, one), over(after, one)
        w_old, w = w, over(v - three * w_old - two * w, np.broadcast_to(one, v.shape))
        x = x + c * eta * w
        eta = -s * eta
        v_old, v, beta = v, over(p, np.broadcast_to(after, p.shape)), after
    return x


def leading(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of the symmetric operator ``product``."""
    wanted = min(wanted, dim)
    first = min(dim, wanted + GUARD)
    most = min(dim, 4 * first)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dim, first)))
    image = product(basis)
    for _ in range(ROUNDS):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        basis, image = basis @ s, image @ s
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        top = max(abs(theta).max(initial=0), abs(values).max(initial=0))
        small = np.linalg.norm(residual, axis=0) <= PRECISION * np.sqrt(dim) * top
        ready = 0
        while ready < len(theta) and len(values) + ready < wanted and small[ready]:
            ready += 1
        locked, values = np.hstack([locked, basis[:, :ready]]), np.append(values, theta[:ready])
        basis, image, theta, residual, small = basis[:, ready:], image[:, ready:], theta[ready:], residual[:, ready:], small[ready:]
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        ask = [i for i in range(min(wanted - len(values), len(theta))) if not small[i]]
        room = dim - locked.shape[1] - basis.shape[1]
        if basis.shape[1] + len(ask) > most:
            kept = min(basis.shape[1], 2 * first)
            basis, image, room = basis[:, :kept], image[:, :kept], dim - locked.shape[1] - kept
        if room == 0:
            # the subspace is the whole space: rounding is what is left, so orthonormalise and multiply anew
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        t = _corrections(product, theta[ask], basis[:, ask], residual[:, ask], locked, INNER)
        t = _orthonormal(t, locked, basis)[:, :room]
        if not t.shape[1]:
            t = _orthonormal(np.random.default_rng(seed + 1).standard_normal((dim, min(room, first))), locked, basis)
        basis, image = np.hstack([basis, t]), np.hstack([image, product(t)])
    raise RuntimeError(f"residuals did not reach double precision in {ROUNDS} rounds")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component.

    Rows (vec_id, embedding) whose vector is null or empty, holds null or non-finite entries, or has another length than
    most take no part. The fit list holds each distinct vector once, however often it is repeated; every row gets its
    result, so repeated rows and repeated or null ids give rows each. Components without variance (of equal, or of fewer
    vectors than dimensions) cannot be whitened and are left out; without any, or with an empty table, the result is
    empty. Equal eigenvalues share a space, of which some orthonormal basis is taken. Entries of 2**31 / 64
    and more, and deviations beyond 64 bits, raise an error. Other columns are not read.
    """
    x = points(vectors)
    fit = FitList(x)
    spread = fit.added(lambda c: (c * c).sum(axis=0)[None], fit.dim).sum() / fit.n if fit.n else 0.0
    if not spread:
        return x.sparkSession.createDataFrame([], OUT)
    values, axes = leading(fit.product, fit.dim, components)
    some = values > 64 * np.finfo(float).eps * fit.dim * values[0]
    values, axes = values[some], axes[:, some]
    k, scaled = len(values), axes / np.sqrt(values)
    centre = fit.added(lambda c: (c @ scaled).sum(axis=0)[None], k)[0] / fit.n

    def spread_of(c):
        w = c @ scaled - centre
        return w.T @ w

    error = float(abs(fit.added(spread_of, k) / fit.n - np.eye(k)).max())
    n, mean, explained = fit.n, fit.mean, values / spread
    sums = np.array([s % (1 << 64) for s in fit.sums], np.uint64).astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                y = _matrix(part.column(1)) - OFFSET
                centred = y - mean
                if n * n * (centred * centred).sum(axis=1).max() >= 2.0 ** 63:
                    raise OverflowError("a deviation does not fit 64 bits")
                # modulo 2**64, which is exact as the result is smaller
                off = y * n - sums
                ids = part.column(0)
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * k, n)), pa.array(np.repeat((off * off).sum(axis=1), k)),
                     pa.array((centred @ scaled).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    names=[c.split()[0] for c in OUT.split(", ")])
    return x.mapInArrow(run, OUT)
