"""Whitening of embeddings by incremental eigendecomposition.

Components are quantised to integers, x = floor(256 * c). The covariance of the
distinct vectors (the fit list) is never formed: its spectrum is kept up to date
while the vectors go by.

* Every partition keeps a count, a mean and the eigendecomposition U diag(s) U'
  of its centred scatter matrix. A vector v adds n / (n + 1) * (v - mean)(v - mean)',
  a rank-one update: with z = U'(v - mean) the new eigenvalues are the roots of
  the secular equation 1 + rho * sum z_i^2 / (s_i - r) = 0, one between every two
  old ones. Entries of z that are negligible, and one of two (nearly) equal
  eigenvalues after a rotation, are deflated: their pairs stay as they are. The
  vectors come from weights recomputed from the roots (so they are orthogonal to
  working precision).
* Spectra of partitions are combined in a tree of groups: the second one's
  eigenpairs and the difference of the means go into the first as successive
  rank-one updates of the same kind.
* The leading vectors are refined by distributed Rayleigh-Ritz steps: one pass
  over the fit list gives the covariance times the basis, hence the Ritz values
  and the residuals; while a residual is above rounding, the basis is widened by
  the residuals and the step is repeated.

What goes through the driver is the model: at most d x d numbers for vectors of
d components, whatever the number of rows. Partitions and the tree's groups hold
d x d numbers each.

Results for odd input: rows with a null vector or null or non-finite components
are dropped; rows that repeat (or have no id) each give their own results; equal
vectors count once in the fit. Every vector length is a space of its own (its
own n, S and components). Components with an eigenvalue of zero (to working
precision: fewer than two distinct vectors, constant or dependent entries) cannot
be scaled to variance one and have no row; so a table without spread gives an
empty result, as do an empty table and empty vectors. ``deviation`` is null where
it is beyond 64 bits. Extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ready_workers

SCALE = 256
COMPONENTS = 4
#: Further vectors that take part in the refinement.
GUARD = 4
#: Vectors of one partition's spectrum, and spectra combined at a time.
SPECTRUM_ROWS = 4_096
FAN_IN = 8
#: Relative size of a residual that counts as rounding, and of an eigenvalue that counts as zero.
RESIDUAL = 1e-13
ZERO = 1e-12
ROUNDS = 30
_EPS = np.finfo(float).eps


def _deflate(s: np.ndarray, u: np.ndarray, z: np.ndarray, rho: float):
    """Ascending ``s`` with columns of ``u`` and weights ``z``: rotates one of
    two (nearly) equal eigenvalues' weights away; returns the places that take
    part in the update."""
    tol = 8 * _EPS * max(abs(s[-1]), abs(s[0]), rho * float(z @ z))
    size = np.sqrt(rho) * float(np.linalg.norm(z))
    active = np.flatnonzero(np.sqrt(rho) * np.abs(z) * size > tol)
    if (np.diff(s[active]) <= 64 * tol).any():
        active = active.tolist()
        kept = active[:1]
        for i in active[1:]:
            j = kept[-1]
            r = np.hypot(z[i], z[j])
            c, t = z[i] / r, z[j] / r
            if (s[i] - s[j]) * abs(c * t) <= tol:
                # j's weight moves to i; the off-diagonal entry left over is below the tolerance
                u[:, j], u[:, i] = c * u[:, j] - t * u[:, i], t * u[:, j] + c * u[:, i]
                s[j], s[i] = c * c * s[j] + t * t * s[i], t * t * s[j] + c * c * s[i]
                z[j], z[i] = 0.0, r
                kept[-1] = i
            else:
                kept.append(i)
        active = kept
    return np.array(active, dtype=int)


def secular_roots(s: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w_i / (s_i - r) = 0 for ascending distinct s and w > 0,
    as (origin, offset): root k is s[origin_k] + offset_k, the origin being the
    nearer pole, so that differences to the poles keep their digits."""
    m = len(s)
    upper = np.append(s[1:], s[-1] + w.sum())
    gap = upper - s
    # the sign in the middle of the interval tells the nearer pole
    middle = 1 + (w[None, :] / (s[None, :] - (s + gap / 2)[:, None])).sum(axis=1)
    left = middle >= 0
    left[-1] = True
    origin = np.where(left, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    delta = s[None, :] - s[origin][:, None]
    last = np.zeros(m, dtype=bool)
    last[-1] = True
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(last, gap, np.where(left, gap / 2, 0.0))
    below = np.tri(m)
    above = 1 - below
    near, far = np.arange(m), np.minimum(np.arange(m) + 1, m - 1)
    pole_a, pole_b = delta[near, near], delta[near, far]
    # start: the two nearest poles as they are, the others as the constant they add in the middle
    half_a, half_b = -gap / 2, np.where(last, np.inf, gap / 2)
    w_b = np.where(last, 0.0, w[far])
    rest = middle - w / half_a - w_b / half_b
    p, q = rest * (pole_a + pole_b) + w + w_b, rest * pole_a * pole_b + w * pole_b + w_b * pole_a
    with np.errstate(divide="ignore", invalid="ignore"):
        root = np.sqrt(np.maximum(p * p - 4 * rest * q, 0))
        x = np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * rest))
        x = np.where(last, pole_a + w / rest, x)
    x = np.where(np.isfinite(x) & (x > low) & (x < high), x, (low + high) / 2)
    act = np.arange(m)
    for _ in range(100):
        now, lo, hi, end = x[act], low[act], high[act], last[act]
        d = delta[act] - now[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            term = w / d
            slope = term / d
        psi, phi = np.einsum("ij,ij->i", term, below[act]), np.einsum("ij,ij->i", term, above[act])
        f = 1 + psi + phi
        hi = np.where(f > 0, np.minimum(hi, now), hi)
        lo = np.where(f < 0, np.maximum(lo, now), lo)
        done = (np.abs(f) <= 16 * _EPS * (1 + np.abs(psi) + np.abs(phi))) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        # rational interpolation: each side as one pole matching value and slope
        psi1, phi1 = np.einsum("ij,ij->i", slope, below[act]), np.einsum("ij,ij->i", slope, above[act])
        da, db = pole_a[act] - now, pole_b[act] - now
        a = f - da * psi1 - db * phi1
        pa_, pb_ = da * da * psi1, db * db * phi1
        # a + pa / (da - h) + pb / (db - h) = 0 for the step h
        p, q = a * (da + db) + pa_ + pb_, f * da * db
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * a * q, 0))
            h = np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * a))
            h = np.where(end, da + pa_ / (f - da * psi1), h)
        trial = now + h
        inside = (trial > lo) & (trial < hi)
        if not inside.all():
            # next to a pole: halve on a logarithmic scale where the bracket spans many sizes
            a_, b_ = np.minimum(np.abs(lo), np.abs(hi)), np.maximum(np.abs(lo), np.abs(hi))
            wide = (a_ > 0) & (b_ > 4 * a_)
            half = np.where(wide, np.where(lo + hi >= 0, 1.0, -1.0) * np.sqrt(np.where(wide, a_ * b_, 0)), (lo + hi) / 2)
            trial = np.where(inside, trial, half)
        x[act], low[act], high[act] = np.where(done, now, trial), lo, hi
        act = act[~done]
    return origin, x


def rank_one(s: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigendecomposition (ascending) of u diag(s) u' + rho v v', rho > 0."""
    z = u.T @ v
    if not z.any():
        return s, u
    s, u = s.copy(), u.copy()
    at = _deflate(s, u, z, rho)
    if len(at):
        old = s[at]
        order = np.argsort(old, kind="stable")
        at, old = at[order], old[order]
        w = rho * z[at] ** 2
        origin, offset = secular_roots(old, w)
        # differences pole - root, each from the root's nearer pole
        diff = (old[None, :] - old[origin][:, None]) - offset[:, None]
        new = old[origin] + offset
        weight = np.sqrt(np.abs(_row_products(old, diff))) * np.where(z[at] < 0, -1.0, 1.0)
        vectors = weight[None, :] / diff
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        u[:, at] = u[:, at] @ vectors.T
        s[at] = new
    order = np.argsort(s, kind="stable")
    return s[order], u[:, order]


def _row_products(poles: np.ndarray, diff: np.ndarray) -> np.ndarray:
    """Squared weights for which the computed roots are exact: per pole i the
    product over roots k of (root_k - pole_i) over that of (pole_j - pole_i),
    j != i. Roots below i are paired with the pole below them, the others with
    the pole above, so every factor is near one."""
    m = len(poles)
    i, k = np.indices((m, m))
    partner = np.where(k < i, k, k + 1)
    bottom = np.where(partner < m, (poles[None, :] - poles[:, None])[i, np.minimum(partner, m - 1)], 1.0)
    return np.prod(-diff.T / bottom, axis=1)


class Spectrum:
    """Count, mean and eigendecomposition of a centred scatter matrix."""

    def __init__(self, mean: np.ndarray, n: int = 0, s: np.ndarray | None = None, u: np.ndarray | None = None):
        d = len(mean)
        self.n, self.mean = n, mean
        self.s = np.zeros(d) if s is None else s
        self.u = np.eye(d) if u is None else u

    def add(self, v: np.ndarray) -> None:
        step = v - self.mean
        if self.n:
            self.s, self.u = rank_one(self.s, self.u, step, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + step / self.n

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.s[::-1], other.u.T[::-1]):
            if value > 0:
                self.s, self.u = rank_one(self.s, self.u, vector, float(value))
        step, total = other.mean - self.mean, self.n + other.n
        self.s, self.u = rank_one(self.s, self.u, step, self.n * other.n / total)
        self.mean = self.mean + step * (other.n / total)
        self.n = total


_SPECTRUM = "part int, n long, mean array<double>, s array<double>, u binary"
_SPECTRUM_ARROW = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())),
                             ("s", pa.list_(pa.float64())), ("u", pa.binary())])


def _pack(part: int, it: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "n": it.n, "mean": it.mean.tolist(), "s": it.s.tolist(),
                                        "u": np.ascontiguousarray(it.u).tobytes()}], schema=_SPECTRUM_ARROW)


def _unpack(row: dict) -> Spectrum:
    d = len(row["mean"])
    return Spectrum(np.array(row["mean"]), row["n"], np.array(row["s"]), np.frombuffer(row["u"]).reshape(d, d).copy())


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that remain, x = floor(256 * c) as array of long."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col("vec_id"), v.alias("v"), bad.alias("bad")).where("v is not null and not bad")
            .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), d)


def partition_spectra(fit: DataFrame, d: int) -> DataFrame:
    """One spectrum per partition of the fit list."""

    def run(batches):
        from pyspark import TaskContext

        own = None
        for batch in batches:
            for v in _matrix(batch.column(0), d).astype(float):
                own = own or Spectrum(v)
                own.add(v)
        if own:
            yield _pack(TaskContext.get().partitionId(), own)

    return fit.select("x").mapInArrow(run, _SPECTRUM)


def combined(spectra: DataFrame) -> Spectrum:
    """All spectra of a table as one, by a tree of groups of ``FAN_IN``."""

    def merge(key, t):
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])
        own = _unpack(rows[0])
        for r in rows[1:]:
            own.merge(_unpack(r))
        return pa.Table.from_batches([_pack(key[0].as_py(), own)])

    spectra = materialise(spectra, "spectra")
    while spectra.count() > 1:
        grouped = spectra.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("part")
        spectra = materialise(grouped.applyInArrow(merge, _SPECTRUM), "spectra")
    return _unpack(spectra.first().asDict())


def covariance_times(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """Centred covariance (divisor n) times ``basis``, summed over the
    partitions, and the covariance's trace."""
    d, r = basis.shape

    def run(batches):
        total, n, squares = np.zeros((d, r)), 0, 0.0
        for batch in batches:
            x = _matrix(batch.column(0), d) - mean
            total += x.T @ (x @ basis)
            squares += float((x * x).sum())
            n += len(x)
        yield pa.RecordBatch.from_pylist([{"n": n, "m": [*total.ravel().tolist(), squares]}],
                                         schema=pa.schema([("n", pa.int64()), ("m", pa.list_(pa.float64()))]))

    parts = fit.select("x").mapInArrow(run, "n long, m array<double>")
    sums = parts.select("n", F.posexplode("m").alias("at", "v")).groupBy("at").agg(
        F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("at").collect()
    values = np.array([row["v"] for row in sums]) / sums[0]["n"]
    return values[:-1].reshape(d, r), float(values[-1])


def refined(fit: DataFrame, start: Spectrum, mean: np.ndarray, k: int, guard: int = GUARD):
    """Leading eigenvalues (falling) and unit eigenvectors of the covariance by
    Rayleigh-Ritz steps from the start's leading vectors; the trace."""
    d = len(mean)
    basis = np.linalg.qr(start.u[:, ::-1][:, : min(d, k + guard)])[0]
    for _ in range(ROUNDS):
        image, trace = covariance_times(fit, mean, basis)
        small = basis.T @ image
        values, y = np.linalg.eigh((small + small.T) / 2)
        values, y = values[::-1], y[:, ::-1]
        ritz = basis @ y
        residual = (image @ y - ritz * values)[:, :k]
        wrong = np.linalg.norm(residual, axis=0) > RESIDUAL * d * max(values[0], 0)
        if not wrong.any() or basis.shape[1] == d:
            break
        kept = ritz if basis.shape[1] < 4 * (k + guard) else ritz[:, : 2 * (k + guard)]
        basis = np.linalg.qr(np.hstack([kept, residual[:, wrong]]))[0][:, :d]
    ritz = ritz[:, :k]
    return values[:k], ritz / np.linalg.norm(ritz, axis=0), trace


def _exact(x: np.ndarray, limit: int) -> np.ndarray:
    """``x`` as it is if its entries stay below ``limit`` in size, else as Python integers."""
    return x if -limit < int(x.min(initial=0)) and int(x.max(initial=0)) < limit else x.astype(object)


def exact_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sum of every dimension over the fit list."""

    def run(batches):
        sums = [0] * d
        for batch in batches:
            sums = [a + int(b) for a, b in zip(sums, _exact(_matrix(batch.column(0), d), 1 << 48).sum(axis=0))]
        yield pa.RecordBatch.from_pylist([{"s": [Decimal(v) for v in sums]}],
                                         schema=pa.schema([("s", pa.list_(pa.decimal128(38, 0)))]))

    parts = fit.select("x").mapInArrow(run, "s array<decimal(38,0)>")
    return [int(r["s"]) for r in parts.select(F.posexplode("s").alias("at", "s")).groupBy("at").agg(
        F.sum("s").alias("s")).orderBy("at").collect()]


def _whiten(rows: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """``rows`` (other columns, then x) with x replaced by ``w``, the whitened
    components as an array, and ``deviation``, the exact sum of (n * x - S)^2."""
    d, scaled = len(sums), vectors / np.sqrt(values)
    mean = np.array([s / n for s in sums])
    others = [c for c in rows.columns if c != "x"]
    schema = rows.select(*others, F.lit(None).cast("array<double>").alias("w"), F.lit(None).cast("long").alias("deviation")).schema

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(batch.num_columns - 1), d)
            # int64 while every square and the sum of d of them fit
            apart = max(int(x.max(initial=0)), -int(x.min(initial=0))) * n + max(map(abs, sums))
            exact = x if apart * apart * d < 2**63 else x.astype(object)
            deviation = ((n * exact - np.array(sums, dtype=exact.dtype)) ** 2).sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array(list((x - mean) @ scaled), pa.list_(pa.float64())),
                pa.array([v if v < 2**63 else None for v in deviation], pa.int64())], names=schema.names)

    return rows.select(*others, "x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, k: int = COMPONENTS, spectrum_rows: int = SPECTRUM_ROWS) -> DataFrame:
    """One row per remaining row and component up to ``k``: vec_id, component
    (from 1, by falling eigenvalue), n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    ready_workers(spark)
    rows = materialise(quantised(vectors), "whitening-rows")
    # distinct first (a hot vector is reduced before the shuffle)
    listed = materialise(rows.select("x").distinct(), "whitening-fit")
    out = rows.select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                      F.lit(0).cast("long").alias("deviation"), *[F.lit(0.0).alias(c) for c in (
                          "whitened", "explained", "identity_error")]).where("false")
    for row in listed.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy("d").collect():
        d, n = row["d"], row["count"]
        fit = listed.where(F.size("x") == d)
        sums = exact_sums(fit, d)
        mean = np.array([s / n for s in sums])
        cores = spark.sparkContext.defaultParallelism
        parts = max(-(-n // spectrum_rows), min(2 * cores, -(-n // (spectrum_rows // 8 or 1))))
        start = combined(partition_spectra(fit.repartition(parts, "x"), d))
        values, basis, trace = refined(fit, start, mean, k)
        good = values > ZERO * trace
        values, basis = values[good], basis[:, good]
        if not len(values):
            continue
        seen = _whiten(fit, n, sums, values, basis).select(*[F.get("w", F.lit(i)).alias(f"w{i}") for i in range(len(values))])
        errors = [F.abs(F.covar_pop(f"w{i}", f"w{j}") - (1.0 if i == j else 0.0)) for i in range(len(values)) for j in range(i + 1)]
        identity_error = seen.agg(F.array_max(F.array(*errors)).alias("e")).first()["e"]
        explained = F.array(*[F.lit(float(v / trace)) for v in values])
        own = _whiten(rows.where(F.size("x") == d), n, sums, values, basis)
        out = out.unionByName(own.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
            "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
            F.get(explained, F.col("at")).alias("explained"), F.lit(identity_error).alias("identity_error")))
    return out
