"""Embedding whitening by Jacobi-Davidson.

Vectors are scaled to integers; the leading eigenvectors of the covariance of
the distinct ones give coordinates of unit variance. The covariance is never
built: every step multiplies it with a few vectors at a time in one pass over
the centred rows (``Centred.product``), of which d numbers per vector come back.
The eigenvectors are found by Jacobi-Davidson: Rayleigh-Ritz in a small
subspace, which is extended by the solutions of the projected correction
equations of all wanted pairs that have not converged; these are solved by a
few steps of MINRES side by side, so that one pass serves all of them. Pairs
whose residual is down at double precision are locked, in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm.common import col, fresh, land, named, ship
from celltally.llm.textkit import release

SCALE, WANTED = 256, 4
#: Vectors packed into one row of the fit list.
PACK = 4096
#: MINRES steps of a correction, Ritz vectors kept at a restart, subspace at most.
INNER, KEEP, SPACE = 4, 8, 28
#: Largest residual of a locked pair, in roundings of the largest eigenvalue; a
#: residual that does not fall any more is locked at so many.
TOLERANCE, STALLED = 8, 512
ROUNDS = 500
EPS = np.finfo(float).eps
SEED = 5


def scaled(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` whose vector has finite entries only, with ``x``: floor(256 * entry) as longs.

    Entries too large for a long count as not finite.
    """
    x = fresh(rows, "x")
    limit = F.lit(float(1 << 53))
    entries = F.transform(col(vector), lambda c: c.cast("double") * SCALE)
    fine = F.coalesce(F.forall(entries, lambda v: F.coalesce(F.abs(v) < limit, F.lit(False))), F.lit(False))  # NaN is above all numbers
    return rows.where(fine).withColumn(x, F.transform(entries, lambda v: F.floor(v).cast("long")))


class Centred:
    """The fit list: ``n`` distinct vectors of ``d`` entries, packed, with exact sums."""

    def __init__(self, distinct: DataFrame, d: int):
        """``distinct``: x, each vector once."""
        self.spark, self.d = distinct.sparkSession, d

        def pack(batches):
            held, n = [], 0
            for batch in batches:
                held.append(batch.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8"))
                n += batch.num_rows
                if n >= PACK:
                    yield packed(held, n)
                    held, n = [], 0
            if n:
                yield packed(held, n)
            release()

        def packed(held, n):
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([np.concatenate(held).tobytes()], pa.binary())], names=["n", "rows"])

        self.rows = land(distinct.mapInArrow(pack, "n long, rows binary"), "whiten-fit")
        self.n = int(self.rows.agg(F.sum("n")).first()[0] or 0)

        def sums(batches):
            for x in vectors(batches, d):
                big = int(np.abs(x).max()) * len(x) < 1 << 62
                total = x.sum(0) if big else x.astype(object).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(int(t)) for t in total])], names=["i", "total"])

        exact = self.rows.mapInArrow(sums, "i int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        self.sums = [0] * d
        for r in exact.collect():  # d rows
            self.sums[r.i] = int(r.total)
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(d)

    def summed(self, size: int, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over blocks of centred rows of ``of_block`` (``size`` numbers); added up by Spark."""
        mean, d = self.mean, self.d

        def run(batches):
            total = np.zeros(size)
            for x in vectors(batches, d):
                total += of_block(x - mean)
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["i", "total"])

        out = np.zeros(size)
        for r in self.rows.mapInArrow(run, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect():  # size rows
            out[r.i] = r.total
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``block``, in one pass over the rows."""
        return self.summed(block.size, lambda c: (c.T @ (c @ block)).ravel()).reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(self.d, lambda c: (c * c).sum(0)).sum() / self.n)


def vectors(batches, d: int):
    for batch in batches:
        for rows in batch.column("rows"):
            yield np.frombuffer(rows.as_buffer(), "<i8").reshape(-1, d)


# --------------------------------------------------------- Jacobi-Davidson

def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal ``against``."""
    kept = np.zeros((len(block), 0))
    for v in block.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            v = v - against @ (against.T @ v)
            v = v - kept @ (kept.T @ v)
        left = np.linalg.norm(v)
        if size > 0 and left > 1e-10 * size:
            kept = np.column_stack([kept, v / left])
    return kept


def minres(b: np.ndarray, project: Callable, shift: float, steps: int, rtol: float) -> Generator:
    """MINRES for the projected, shifted covariance, as a coroutine: yields the
    vector to multiply, is sent the product, returns the solution."""
    beta = np.linalg.norm(b)
    x, v_old, v = np.zeros_like(b), np.zeros_like(b), b / beta
    w_old, w_older = np.zeros_like(b), np.zeros_like(b)
    c, s, c_old, s_old, eta, start, beta_in = 1.0, 0.0, 1.0, 0.0, beta, beta, 0.0
    for _ in range(steps):
        u = project((yield v) - shift * v) - beta_in * v_old
        alpha = v @ u
        u = u - alpha * v
        beta_out = np.linalg.norm(u)
        delta = c * alpha - c_old * s * beta_in
        rho1 = math.hypot(delta, beta_out)
        rho2, rho3 = s * alpha + c_old * c * beta_in, s_old * beta_in
        if rho1 == 0:
            break
        c_old, s_old, c, s = c, s, delta / rho1, beta_out / rho1
        w = (v - rho3 * w_older - rho2 * w_old) / rho1
        w_older, w_old = w_old, w
        x = x + c * eta * w
        eta = -s * eta
        if beta_out <= EPS * abs(shift) or abs(eta) <= rtol * start:
            break
        v_old, v, beta_in = v, u / beta_out, beta_out
    return x


def side_by_side(solvers: list[Generator], product: Callable) -> list[np.ndarray]:
    """Runs coroutines that want products; one pass serves all that still run."""
    done, wants = [None] * len(solvers), {}
    for i, s in enumerate(solvers):
        wants[i] = next(s)
    while wants:
        block = product(np.column_stack(list(wants.values())))
        for j, i in enumerate(list(wants)):
            try:
                wants[i] = solvers[i].send(block[:, j])
            except StopIteration as end:
                done[i] = end.value
                del wants[i]
    return done


def leading(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int = WANTED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) of a symmetric matrix that
    only ``product`` knows, and their unit eigenvectors as columns."""
    rnd = np.random.default_rng(SEED)
    wanted = min(wanted, d)
    locked, values = np.zeros((d, 0)), []
    basis = orthonormal(rnd.normal(size=(d, min(d, wanted + KEEP))), locked)
    image = product(basis)
    best, stale = math.inf, 0
    for _ in range(ROUNDS):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        left = wanted - len(values)
        residual = image[:, :left] - basis[:, :left] * theta[:left]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        unit = EPS * max(abs(theta[0]), *map(abs, values), np.finfo(float).tiny)
        stale = stale + 1 if size[0] > best / 2 else 0
        best = min(best, size[0])
        full = len(values) + basis.shape[1] == d  # nothing can be added: the pairs are those of the whole matrix
        if full or size[0] <= TOLERANCE * unit or (stale >= 3 and size[0] <= STALLED * unit):
            locked, values = np.column_stack([locked, basis[:, 0]]), [*values, float(theta[0])]
            if len(values) == wanted:
                return np.array(values), locked
            basis, image, best, stale = basis[:, 1:], image[:, 1:], math.inf, 0
            if basis.shape[1]:
                continue
        wanting = np.flatnonzero(size > TOLERANCE * unit) if basis.shape[1] else []
        if basis.shape[1] > SPACE - wanted:
            basis, image = basis[:, :max(KEEP, left)], image[:, :max(KEEP, left)]
        span = np.column_stack([locked, basis[:, :left]])
        project = lambda v, q=span: v - q @ (q.T @ v)
        starts = [(i, project(project(-residual[:, i]))) for i in wanting]
        solvers = [minres(b, project, theta[i], INNER, 0.01) for i, b in starts if np.linalg.norm(b) > 0]
        found = side_by_side(solvers, product)
        new = orthonormal(np.column_stack([project(t) for t in found]) if found else np.zeros((d, 0)), np.column_stack([locked, basis]))
        if not new.shape[1]:
            new = orthonormal(rnd.normal(size=(d, 1)), np.column_stack([locked, basis]))
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    raise RuntimeError(f"{len(values)} of {wanted} eigenpairs converged in {ROUNDS} rounds")


# ------------------------------------------------------------------ operator

class Whitening:
    """Fitted components: ``values`` (falling), ``vectors`` (columns), trace and identity error."""

    def __init__(self, fit: Centred, wanted: int = WANTED):
        self.n, self.sums, self.mean = fit.n, fit.sums, fit.mean
        self.trace = fit.trace() if fit.n else 0.0
        self.values, self.vectors, self.error = np.zeros(0), np.zeros((fit.d, 0)), 0.0
        if self.trace > 0:
            values, found = leading(fit.product, fit.d, wanted)
            real = values > fit.d * EPS * self.trace  # beyond the rank of the rows there is nothing to scale
            self.values = values[real]
            self.vectors = found[:, real] * np.sign(found[np.abs(found).argmax(0), range(found.shape[1])])[real]
            k = len(self.values)
            project = self.vectors / np.sqrt(self.values)
            sums = fit.summed(k, lambda c: (c @ project).sum(0)) / fit.n
            square = fit.summed(k * k, lambda c: ((w := c @ project - sums).T @ w).ravel()).reshape(k, k) / fit.n
            self.error = float(np.abs(square - np.eye(k)).max(initial=0.0))


def fitted(rows: DataFrame, x: str, wanted: int = WANTED) -> tuple[Whitening, int]:
    """The whitening of ``rows`` (see ``scaled``) and the vectors' length: that
    of most rows (the longer of equals); vectors of another length are not fitted."""
    ship(rows.sparkSession)
    lengths = rows.groupBy(F.size(x).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    distinct = rows.where((F.size(x) == d) & (F.size(x) > 0)).select(F.col(x).alias("x")).distinct()
    return Whitening(Centred(distinct, d), wanted), d


def whitened(rows: DataFrame, vector: str = "embedding", wanted: int = WANTED) -> tuple[DataFrame, Whitening, str, str]:
    """The rows that stay, with ``whitened`` (one double per component) and
    ``deviation`` (the squared distance to the mean, times n squared; null
    where no long holds it), the model, and the two columns' names.

    Rows whose vector is null, holds a null or non-finite entry, is empty, or
    has another length than most are dropped; repeated rows stay and count once
    in the fit; other columns are kept as they are; an empty table, or one with
    a single distinct vector, has no component.
    """
    kept = scaled(rows, named(rows, vector))
    x = kept.columns[-1]
    model, d = fitted(kept, x, wanted)
    values, deviation = fresh(rows, "whitened"), fresh(rows, "deviation")
    n, sums, mean, project = model.n, model.sums, model.mean, model.vectors / np.sqrt(model.values)

    def run(batches):
        for batch in batches:
            v = batch.column(x).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)
            most = n * int(np.abs(v).max(initial=0)) + max(map(abs, sums), default=0)
            safe = most * most * d < 1 << 63
            away = v.astype(np.int64 if safe else object) * n - np.array(sums, np.int64 if safe else object)
            square = (away * away).sum(1)
            if not safe:
                square = [s if s < 1 << 63 else None for s in square]
            out = (v - mean) @ project
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))
            keep = [i for i, name in enumerate(batch.schema.names) if name != x]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), lists, pa.array(square, pa.int64())],
                                             names=[*(batch.schema.names[i] for i in keep), values, deviation])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema] + [f"{values} array<double>", f"{deviation} long"])
    found = kept.where((F.size(x) == d) & (F.size(x) > 0)).mapInArrow(run, schema)
    return found, model, values, deviation


def report(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The registered query: one row per remaining row and component."""
    slim = rows.select(col("vec_id").alias("vec_id"), col(vector).alias("vector"))
    found, model, values, deviation = whitened(slim, "vector")
    explained = [float(e / model.trace) for e in model.values]
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1) if explained else F.lit(None).cast("double")
    return found.select("vec_id", F.col(deviation).alias("deviation"), F.posexplode(values).alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(model.error).alias("identity_error"))
