"""Whitening of embeddings: blockwise QR, bidiagonal form, singular values by dqds, directions by twisted factorisations.

Components become whole numbers x = floor(256 c).  The fit list is each distinct x vector
once, n of them with sums S by dimension (exact, as decimals).  The covariance is never formed:

1. blocks of centred rows (n x - S, exact, over n) are reduced to triangular factors, one a
   task, and those, ``FAN`` a task, to one R of d by d: the covariance is R'R / n;
2. R = U B V' by Householder reflections, B upper bidiagonal.  Only R, whose size is that of
   the dimensions, comes to the driver, as does all that follows from it;
3. the differential quotient difference algorithm with shifts (dqds) gives the squares of B's
   singular values, the small ones as accurately as the great ones.  A shift comes from the last two
   rows; one that is too great shows as a negative pivot and is lessened;
4. for each of them the stationary and the progressive transforms of B'B give a twisted
   factorisation; its least pivot says where to twist, and the vector follows outwards from
   there by products alone.  Vectors of values that lie close together are solved for again
   and made orthogonal; V takes them back to the dimensions.

A pass over the fit list says how far the whitened covariance is from the identity, and one
over all rows gives their components.

Defined results: rows whose vector is null, or has a null or non-finite component, are left
out; shorter vectors are padded with zeros; a component beyond the range of a long when
multiplied is the nearest long; so is a deviation beyond it; components without variance
(to double precision) are left out, so there may be fewer than asked for, and none of equal
vectors or of one row; of equal eigenvalues any orthonormal directions, the same for all
rows, are given; a direction's largest entry is positive; rows that repeat an id each have
their components; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import keep, table

SCALE, TOP = 256, 4
FAN = 16  # triangular factors reduced in one task
STRIP = 8  # rows reduced at once, in dimensions
LARGEST = (1 << 63) - 1
EPS = np.finfo(float).eps


# dense work on d by d matrices


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r V, and V, by Householder reflections from both sides."""
    a, d = r.copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = np.abs(x).max(initial=0.0)
        if size == 0 or len(x) < 2 or not x[1:].any():
            return np.zeros(len(x)), 0.0
        w = x / size
        w[0] += math.copysign(np.linalg.norm(w), w[0])
        return w, 2 / (w @ w)

    for k in range(d):
        w, beta = reflector(a[k:, k])
        if beta:
            a[k:, k:] -= np.outer(beta * w, w @ a[k:, k:])
        if k < d - 2:
            w, beta = reflector(a[k, k + 1 :])
            if beta:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, beta * w)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, beta * w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int, float]:
    """One transform with a shift, where its pivots turned negative (the number of them if none did), and the least of them."""
    n = len(q)
    nq, ne, d = [0.0] * n, [0.0] * (n - 1), q[0] - shift
    least = d
    for i in range(n - 1):
        if not d >= 0:
            return nq, ne, i, d
        nq[i] = top = d + e[i]
        ratio = q[i + 1] / top if top else 0.0
        ne[i] = e[i] * ratio
        d = (d * ratio if top else q[i + 1]) - shift
        least = min(least, d)
    nq[-1] = d
    return nq, ne, n if d >= 0 else n - 1, least


def least_of_corner(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows and columns, which the least of all does not exceed."""
    before = e[-2] if len(e) > 1 else 0.0
    x, y = q[-2] + before, q[-1] + e[-1]
    larger = (x + y) / 2 + math.hypot((x - y) / 2, math.sqrt(q[-2]) * math.sqrt(e[-1]))
    return (q[-2] * (q[-1] / larger) + before * (y / larger)) if larger else 0.0


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal (diagonal ``a``, superdiagonal ``b``), falling."""
    found: list[float] = []
    open_ = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    steps = 200 * len(a) + 200
    while open_:
        q, e, moved = open_.pop()
        most = math.inf  # what the least value is known not to exceed
        while len(q) > 1:
            if e[-1] <= 16 * EPS * EPS * (moved + q[-1]):
                found.append(q.pop() + moved)
                e.pop()
                most = math.inf
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= EPS * EPS * moved), None)
            if cut is not None:
                open_.append((q[: cut + 1], e[:cut], moved))
                q, e, most = q[cut + 1 :], e[cut + 1 :], math.inf
                continue
            if 1.5 * q[0] < q[-1]:  # read from the other end, which leaves the values as they are
                q, e = q[::-1], e[::-1]
                continue
            shift = min(least_of_corner(q, e), most) if min(q) > 0 and most > 0 else 0.0
            for tries in range(5):
                steps -= 1
                nq, ne, good, least = dqds_step(q, e, shift)
                if good == len(q):
                    break
                late = shift + nq[-1] if good == len(q) - 1 else 0.0  # at most the least value, and near it
                shift = 0.0 if tries == 3 else late if 0 < late < shift else shift / 16
            most = least
            if steps < 0:
                raise ArithmeticError("dqds does not converge")
            q, e, moved = nq, ne, moved + shift
        if q:
            found.append(q[0] + moved)
    return np.sort(np.array(found))[::-1]


class Twisted:
    """B'B - value as N G N', N unit and bidiagonal from both ends towards the row of the least pivot."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        tiny = EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
        a = np.where(np.abs(a) < EPS * tiny, EPS * tiny, a)
        piv, low = a * a, b / a[:-1] if n > 1 else b
        least = EPS * tiny * tiny
        fine = lambda x: x if abs(x) > least else math.copysign(least, x)
        self.down, self.lower, s = np.empty(n), np.empty(n - 1), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            self.down[i] = fine(s[i] + piv[i])
            self.lower[i] = piv[i] * low[i] / self.down[i]
            s[i + 1] = self.lower[i] * low[i] * s[i] - value
        self.up, self.upper, p = np.empty(n), np.empty(n - 1), np.empty(n)
        p[-1] = piv[-1] - value
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = fine(piv[i] * low[i] ** 2 + p[i + 1])
            ratio = piv[i] / self.up[i + 1]
            self.upper[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        middle = np.nan_to_num(s + p + value, nan=np.inf)
        self.r = int(np.argmin(np.abs(middle)))
        self.middle = fine(float(middle[self.r]))

    def outwards(self, g: np.ndarray) -> np.ndarray:
        """Solves N'z = g."""
        z = g.copy()
        for i in range(self.r - 1, -1, -1):
            z[i] -= self.lower[i] * z[i + 1]
        for i in range(self.r, len(z) - 1):
            z[i + 1] -= self.upper[i] * z[i]
        return z

    def vector(self) -> np.ndarray:
        return unit(self.outwards(np.eye(1, len(self.down), self.r)[0]))

    def solved(self, f: np.ndarray) -> np.ndarray:
        """Solves (B'B - value) y = f, as far as a value so near an eigenvalue lets it."""
        w, r = f.copy(), self.r
        for i in range(r):
            w[i + 1] -= self.lower[i] * w[i]
        for i in range(len(w) - 2, r - 1, -1):
            w[i] -= self.upper[i] * w[i + 1]
        pivots = np.concatenate((self.down[:r], [self.middle], self.up[r + 1 :]))
        return self.outwards(unit(w) / pivots)


def unit(z: np.ndarray) -> np.ndarray:
    z = z / np.abs(z).max()
    return z / np.linalg.norm(z)


def apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """What of ``z`` is orthogonal to ``others``."""
    for _ in range(2):
        for o in others:
            z = z - (o @ z) * o
    return z


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for ``values`` (falling), as columns."""
    found: list[np.ndarray] = []
    rng = np.random.default_rng(12)
    for i, value in enumerate(values):
        twisted = Twisted(a, b, value)
        near = [v for v, own in zip(found, values, strict=False) if own - value <= 1e-3 * own]
        z = twisted.vector()
        if near:
            left = apart(z, near)
            z = unit(left) if np.linalg.norm(left) > 0.1 else unit(apart(rng.standard_normal(len(a)), near))
            for _ in range(4):
                z = unit(apart(unit(twisted.solved(z)), near))
        found.append(unit(apart(z, found)))
    return np.array(found).T


@dataclass
class Whitening:
    """What turns rows into components: directions (columns) with their eigenvalues, the fit list's size and sums."""

    n: int
    sums: np.ndarray  # whole numbers
    directions: np.ndarray
    values: np.ndarray
    trace: float


def solved(r: np.ndarray, n: int, sums: np.ndarray, components: int) -> Whitening:
    """The whitening that follows from the triangular factor of the centred fit list."""
    d = r.shape[1]
    square = np.zeros((d, d))
    square[: len(r)] = r
    a, b, v = bidiagonal(square)
    squares = squared_values(a, b)
    rank = int((squares > (8 * d * EPS) ** 2 * squares[0]).sum()) if squares[0] > 0 else 0
    top = squares[: min(components, rank)]
    directions = v @ right_vectors(a, b, top) if len(top) else np.zeros((d, 0))
    directions *= np.sign(directions[np.abs(directions).argmax(0), np.arange(len(top))])
    return Whitening(n, sums, directions, top / n, float((r * r).sum()) / n)


# passes over rows


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows of ``vectors`` (vec_id, vector) that take part: x as bytes of longs without zeros at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch["vector"].is_valid())
            if not batch.num_rows:
                continue
            lists = batch["vector"]
            c = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(c))))
            with np.errstate(all="ignore"):
                y = np.floor(c * SCALE)
                x = np.where(y >= 2.0**63, LARGEST, np.where(y < -(2.0**63), -LARGEST - 1, np.where(np.abs(y) < 2.0**63, y, 0).astype(np.int64)))
            fine = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            rows = []
            for i in fine:
                own = x[ends[i] : ends[i + 1]]
                if len(own) and own[-1] == 0:
                    own = own[: np.flatnonzero(own)[-1] + 1] if own.any() else own[:0]
                rows.append(own.tobytes())
            yield pa.RecordBatch.from_pydict({"vec_id": batch["vec_id"].take(pa.array(fine)), "x": pa.array(rows, pa.binary())})

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "vector").mapInArrow(run, f"vec_id {kind}, x binary")


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of longs, padded with zeros to ``d``."""
    out = np.zeros((len(column), d), np.int64)
    for row, x in zip(out, column, strict=True):
        own = np.frombuffer(x.as_buffer(), np.int64)
        row[: len(own)] = own
    return out


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: longs where they suffice, else Python integers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)), max(map(abs, sums.tolist()), default=0) // n + 1)
    if n * most < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(y: np.ndarray, n: int) -> np.ndarray:
    return y / n if y.dtype != object else np.array([[c / n for c in row] for row in y.tolist()], float).reshape(y.shape)


def squared_lengths(y: np.ndarray) -> np.ndarray:
    """Sums of squares, exact and no greater than the largest long."""
    if y.dtype != object and ((y.astype(float) ** 2).sum(1) < 9.2e18).all():
        return (y * y).sum(1)
    return np.array([min(sum(c * c for c in row), LARGEST) for row in y.tolist()], np.int64)


def sums_of(fit: DataFrame, d: int) -> np.ndarray:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for batch in batches:
            x = matrix(batch["x"], d)
            high, low = x >> 32, x & 0xFFFFFFFF  # a batch has fewer than 2 ** 31 rows
            total += (high.sum(0).astype(object) << 32) + low.sum(0).astype(object)
        for at, s in enumerate(total):
            yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "s": pa.array([str(s)])})

    parts = fit.mapInArrow(run, "at int, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = dict(parts.collect())  # a row for each dimension
    return np.array([int(found.get(i, 0)) for i in range(d)], object)


def triangular(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred fit list."""
    d = len(sums)

    def bottom(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP * d):
                own = centred(deviations(matrix(batch["x"].slice(at, STRIP * d), d), n, sums), n)
                r = np.linalg.qr(np.vstack((r, own)), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    def above(_key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for own in batch["r"]:
                r = np.linalg.qr(np.vstack((r, np.frombuffer(own.as_buffer()).reshape(-1, d))), mode="r")
        yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    rs = keep(fit.mapInArrow(bottom, "r binary"), "white-r")
    while (k := rs.count()) > 1:
        group = F.pmod(F.xxhash64("r"), F.lit(-(-k // FAN)))
        rs = keep(rs.withColumn("g", group).groupBy("g").applyInArrow(above, "r binary"), "white-r")
    return np.frombuffer(rs.first()["r"]).reshape(-1, d)


def fitted(fit: DataFrame, components: int = TOP) -> Whitening | None:
    """The whitening of the distinct vectors ``fit`` (x); None where none varies."""
    n, width = fit.agg(F.count(F.lit(1)), F.max(F.octet_length("x"))).first()
    if not n or not width:
        return None
    sums = sums_of(fit, width // 8)
    return solved(triangular(fit, n, sums), n, sums, components)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of ``rows`` (vec_id, x): the squared length of n x - S and the components."""
    n, sums, directions, scale = model.n, model.sums, model.directions, np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = deviations(matrix(batch["x"], len(sums)), n, sums)
            white = centred(y, n) @ directions / scale
            of = pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32())
            parts = [batch["vec_id"], pa.array(squared_lengths(y), pa.int64()), pa.ListArray.from_arrays(of, pa.array(white.ravel()))]
            yield pa.RecordBatch.from_arrays(parts, ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = batch["whitened"].flatten().to_numpy().reshape(-1, k)
            total += np.concatenate((w.sum(0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(total)), pa.int32()), "s": pa.array(total)})

    white = whiten(fit.select(F.lit(0).alias("vec_id"), "x"), model).select("whitened")
    found = dict(white.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s")).collect())  # k + k * k rows
    total = np.array([found[i] for i in range(k + k * k)]) / model.n
    mean, product = total[:k], total[k:].reshape(k, k)
    return float(np.abs(product - np.outer(mean, mean) - np.eye(k)).max())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    rows = whole_numbers(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))
    fit = keep(rows.select("x").distinct(), "white-fit")
    model = fitted(fit)
    if model is None or not len(model.values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    error = identity_error(fit, model)
    share = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    found = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return found.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("i") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
