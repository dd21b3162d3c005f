"""Operator 13: embedding whitening by incremental eigendecomposition.

Entries become integers, x = floor(64 * c) + 1000000; the fit list holds each
distinct x vector once. Its covariance is decomposed in three steps.

1. Every partition keeps the spectrum (eigenvalues and vectors) of the scatter
   of the vectors it has seen about their mean. A vector is one rank-one update,
   n / (n + 1) times the outer product of its distance from that mean: the
   secular equation gives the eigenvalues (all roots at once, each as an offset
   from its nearest pole), Loewner's formula a vector for which they are exact,
   so that the eigenvectors stay orthogonal. Entries of no weight and equal
   eigenvalues are deflated first.
2. Spectra are combined, ``FAN`` to a task and level by level: each eigenpair of
   one is a rank-one update of the other, the distance of the means one more.
3. Rayleigh-Ritz refinement: the centred covariance in the basis found is summed
   over the whole fit list, and its eigenvectors turn the basis into the final
   components. As the basis is complete, this takes away what rounding the
   updates have gathered.

Counts and sums are integers and exact. The driver holds matrices of d * d numbers
(d: the length of a vector), never rows. Copies are reduced in the tasks before
the shuffle that makes the fit list, so no vector is hot.

Defined results: rows whose vector is null, or holds null or non-finite entries,
are dropped; a null vec_id and repeated rows are kept; vectors of several lengths
are fitted length by length; equal eigenvalues keep the order of the solver;
components without variance (among them all of a fit list of one vector, and
vectors of no entries) give no rows; an empty table gives none; a deviation
beyond a long is null; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.llm.common import cut, shuffle_width

COMPONENTS = 16
SCALE, ORIGIN = 64, 1_000_000
#: Spectra combined in one task.
FAN = 8
#: Vectors worked on at a time in the passes after the updates.
CHUNK = 1024
#: Eigenvalues below this share of the largest are no variance.
NO_VARIANCE = 1e-13
EPS = float(np.finfo(np.float64).eps)
MAX_ROUNDS = 80


def secular_roots(poles: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weight / (poles - x)) for rising poles and positive
    weights, one behind each pole, as (number of the nearest pole, offset)."""
    k = len(poles)
    gap = np.append(np.diff(poles), weight.sum())
    middle = gap / 2
    at_middle = 1 + (weight[:, None] / (poles[:, None] - poles[None] - middle[None])).sum(axis=0)
    left = at_middle >= 0
    left[-1] = True
    origin = np.arange(k) + ~left
    delta = poles[:, None] - poles[origin][None]
    lo = np.where(left, 0.0, -middle)
    hi = np.where(left, middle, 0.0)
    hi[-1] = gap[-1]
    t = (lo + hi) / 2
    lower = np.tri(k, dtype=bool).T  # poles up to the root's own
    w, j = weight[:, None], np.arange(k)
    nxt = np.minimum(j + 1, k - 1)
    for _ in range(MAX_ROUNDS):
        apart = delta - t[None]
        terms = w / apart
        slopes = terms / apart
        f = 1 + terms.sum(axis=0)
        done = (np.abs(f) <= 4 * EPS * (1 + np.abs(terms).sum(axis=0))) | (hi - lo <= 2 * EPS * np.abs(t))
        if done.all():
            break
        lo, hi = np.where(f < 0, t, lo), np.where(f > 0, t, hi)
        total = slopes.sum(axis=0)
        before = np.where(lower, slopes, 0.0).sum(axis=0)
        d1, d2 = apart[j, j], apart[nxt, j]
        c = f - d1 * before - d2 * (total - before)
        a, b = (d1 + d2) * f - d1 * d2 * total, d1 * d2 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):  # a step that is no number is halved instead
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = d1[-1] + d1[-1] ** 2 * before[-1] / (f[-1] - d1[-1] * before[-1])
        new = t + step
        good = np.isfinite(new) & (new > lo) & (new < hi)
        t = np.where(done, t, np.where(good, new, (lo + hi) / 2))
    return origin, t


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of
    basis diag(values) basis' + rho v v', for rho >= 0."""
    z = v @ basis
    norm = float(np.sqrt(z @ z))
    if not norm or not rho:
        return values, basis
    z, rho = z / norm, rho * norm * norm
    tol = 8 * EPS * max(abs(values[-1]), rho)
    active = np.flatnonzero(rho * np.abs(z) > tol)
    close = np.flatnonzero(np.diff(values[active]) <= tol)
    if len(close):  # equal eigenvalues: turn their plane so that one of the two has no weight
        basis = basis.copy()
        idle = []
        for m in close:
            i, j = active[m], active[m + 1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            one, two = basis[:, i].copy(), basis[:, j].copy()
            basis[:, i], basis[:, j] = c * one - s * two, s * one + c * two
            z[i], z[j] = 0.0, r
            idle.append(m)
        active = np.delete(active, idle)
    if not len(active):
        return values, basis
    poles = values[active]
    origin, offset = secular_roots(poles, rho * z[active] ** 2)
    # minus[i, j] = pole i - root j, without cancellation
    minus = (poles[:, None] - poles[origin][None]) - offset[None]
    apart = poles[:, None] - poles[None]
    np.fill_diagonal(apart, 1.0)
    ratio = minus / apart
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(z[active])
    turn = exact[:, None] / minus
    turn /= np.sqrt((turn * turn).sum(axis=0))[None]
    values, basis = values.copy(), basis.copy() if not len(close) else basis
    values[active] = poles[origin] + offset
    basis[:, active] = basis[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Count, exact sums (of x - ORIGIN) and the spectrum of the scatter."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, np.zeros(dim, np.int64)
        self.values, self.basis = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        if self.n:
            away = x - self.sums / self.n
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n / (self.n + 1))
        self.n, self.sums = self.n + 1, self.sums + x

    def join(self, other: "Spectrum") -> None:
        if not other.n:
            return
        if not self.n:
            self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector, float(value))
        n = self.n + other.n
        away = other.sums / other.n - self.sums / self.n
        self.values, self.basis = rank_one(self.values, self.basis, away, self.n * other.n / n)
        self.n, self.sums = n, self.sums + other.sums

    def row(self) -> dict:
        return {"n": [self.n], "sums": [self.sums.tobytes()], "vals": [self.values.tobytes()],
                "basis": [np.ascontiguousarray(self.basis).tobytes()]}

    @classmethod
    def of(cls, row: dict, dim: int) -> "Spectrum":
        out = cls(dim)
        out.n, out.sums = row["n"], np.frombuffer(row["sums"], np.int64)
        out.values = np.frombuffer(row["vals"])
        out.basis = np.frombuffer(row["basis"]).reshape(dim, dim)
        return out


SPECTRUM = "part long, n long, sums binary, vals binary, basis binary"


def _batch(part: int, spectrum: Spectrum) -> dict:
    return {"part": pa.array([part], pa.int64()),
            **{k: pa.array(v, pa.int64() if k == "n" else pa.binary()) for k, v in spectrum.row().items()}}


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The x - ORIGIN of a batch, one row each."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - ORIGIN


def _decompose(dim: int):
    def run(batches):
        from pyspark import TaskContext
        own = Spectrum(dim)
        for batch in batches:
            for x in _vectors(batch, dim):
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_pydict(_batch(TaskContext.get().partitionId(), own))
    return run


def _combine(dim: int):
    def run(key, rows):  # Spark tells the two arguments by their number
        spectra = [Spectrum.of(r, dim) for r in sorted(rows.to_pylist(), key=lambda r: (-r["n"], r["part"]))]
        for other in spectra[1:]:
            spectra[0].join(other)
        return pa.table(_batch(key[0].as_py(), spectra[0]))
    return run


def decompose(fit: DataFrame, dim: int) -> Spectrum:
    """The spectrum of all vectors ``x`` of ``fit``."""
    spectra = cut(fit.mapInArrow(_decompose(dim), SPECTRUM), "whitening-spectra")
    while (last := spectra.agg(F.max("part")).first()[0]) is not None and last > 0:
        spectra = cut(spectra.groupBy(F.floor(F.col("part") / FAN).alias("grp"))
                      .applyInArrow(_combine(dim), SPECTRUM), "whitening-spectra")
    rows = spectra.collect()  # one row
    return Spectrum.of(rows[0].asDict(), dim) if rows else Spectrum(dim)


def _products(dim: int, mean: np.ndarray, turn: np.ndarray):
    """Sums, over a partition, of the products of all pairs of the turned
    centred entries (cells of the upper triangle) and of the entries."""
    k = turn.shape[1]
    upper = np.triu_indices(k)

    def run(batches):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            x = _vectors(batch, dim)
            for lo in range(0, len(x), CHUNK):
                y = (x[lo:lo + CHUNK] - mean) @ turn
                total += y.T @ y
                sums += y.sum(axis=0)
        values = np.concatenate([total[upper], sums])
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(values))), "value": pa.array(values)})
    return run


def covariance(fit: DataFrame, dim: int, n: int, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the turned vectors, centred before multiplying."""
    k = turn.shape[1]
    cells = (fit.mapInArrow(_products(dim, mean, turn), "cell long, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())  # a number for each pair of entries
    values = np.zeros(k * (k + 1) // 2 + k)
    values[cells["cell"].to_numpy(np.int64)] = cells["value"].to_numpy()
    out, left = np.zeros((k, k)), values[-k:] / n  # what centring has left by rounding
    out[np.triu_indices(k)] = values[:-k]
    out = out + np.triu(out, 1).T
    return out / n - np.outer(left, left)


def components(fit: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, sums of x - ORIGIN, eigenvalues falling, components as columns)."""
    found = decompose(fit, dim)
    if found.n < 2:
        return found.n, found.sums, np.zeros(0), np.zeros((dim, 0))
    mean = found.sums / found.n
    basis = np.linalg.qr(found.basis)[0]
    values, turn = np.linalg.eigh(covariance(fit, dim, found.n, mean, basis))
    return found.n, found.sums, values[::-1], (basis @ turn)[:, ::-1]


def _whitened(dim: int, n: int, sums: np.ndarray, values: np.ndarray, turn: np.ndarray, trace: float, error: float):
    k = len(values)
    mean, scaled, explained = sums / n, turn / np.sqrt(values), values / trace

    def deviations(x: np.ndarray) -> list:
        rough = ((float(n) * (x - mean)) ** 2).sum(axis=1)
        if not len(x) or rough.max() < 2.0 ** 61:
            away = n * x - sums
            return (away * away).sum(axis=1).tolist()
        exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
        return [d if d < 1 << 63 else None for d in exact]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                x = _vectors(part, dim)
                rows = len(x)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * k, n, np.int64)),
                    "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    "whitened": pa.array(((x - mean) @ scaled).ravel()),
                    "explained": pa.array(np.tile(explained, rows)),
                    "identity_error": pa.array(np.full(rows * k, error))})
    return run


OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           n_components: int = COMPONENTS) -> DataFrame:
    """One row for each remaining row and component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                      F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where("v IS NOT NULL AND size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = "
                   "double('infinity'))")
            .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(ORIGIN)).alias("x")))
    # Copies go in the tasks first; the files keep the width of the shuffle for the updates.
    fit = cut(rows.select("x").distinct().repartition(shuffle_width(spark), "x"), "whitening-fit")
    lengths = [r["d"] for r in fit.groupBy(F.size("x").alias("d")).count().orderBy("d").collect()]
    parts = []
    for dim in lengths:
        own = fit.where(F.size("x") == dim)
        n, sums, values, turn = components(own, dim)
        kept = int((values > NO_VARIANCE * max(values[0], 0)).sum()) if len(values) and values[0] > 0 else 0
        kept = min(kept, n_components)
        if not kept:
            continue
        trace, values, turn = float(values.sum()), values[:kept], turn[:, :kept]
        white = covariance(own, dim, n, sums / n, turn / np.sqrt(values))
        error = float(np.abs(white - np.eye(kept)).max())
        parts.append(rows.where(F.size("x") == dim)
                     .mapInArrow(_whitened(dim, n, sums, values, turn, trace, error), OUTPUT))
    if not parts:
        return spark.createDataFrame([], OUTPUT)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
