"""Embedding whitening through a bidiagonal qd solver.

Vectors become integers; each distinct one once is the fit list. Its size and sums are
exact. Tasks centre their rows and reduce them block by block to a d x d triangle (QR);
the triangles are reduced in groups of ``FAN`` until one is left, so neither the driver nor
a task ever holds more than ``FAN`` triangles. The last triangle R is made bidiagonal by
Householder reflections, the dqds iteration finds its singular values to high relative
accuracy, and twisted factorisations give the singular vectors, which are the eigenvectors
of the covariance. Every row, repeated or not, is then projected where it lies.

Defined cases: rows whose vector is null or holds a null or non-finite entry are dropped,
a null id stays; shorter vectors count as padded with zeros; entries beyond 2**63 / scale
are cut there; components without variance (beyond rounding) are left out, so one distinct
vector, or none, gives no rows; a ``deviation`` beyond the range of ``decimal(38,0)``, and
in the query beyond a long, is null; texts and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored

SCALE = 256
COMPONENTS = 4
#: Triangles reduced together.
FAN = 16
EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------- bidiagonal solver (d x d, on the driver)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r`` = U B V^T by Householder reflections."""
    m = np.array(r, dtype=float)
    d = m.shape[0]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        tail = np.abs(x[1:]).max(initial=0.0)
        if tail == 0.0:
            return None
        x = x / max(tail, abs(x[0]))
        u = x.copy()
        u[0] += math.copysign(float(np.sqrt(x @ x)), x[0])
        return u / np.sqrt(u @ u)

    for i in range(d):
        u = reflector(m[i:, i])
        if u is not None:
            m[i:, i:] -= 2 * np.outer(u, u @ m[i:, i:])
        if i + 2 < d:
            u = reflector(m[i, i + 1 :])
            if u is not None:
                m[i:, i + 1 :] -= 2 * np.outer(m[i:, i + 1 :] @ u, u)
                v[:, i + 1 :] -= 2 * np.outer(v[:, i + 1 :] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One shifted qd transform and the sum of 1/d (trace of the inverse for shift 0); None if it is not positive."""
    n, d, inverse = len(q), q[0] - shift, 0.0
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    for i in range(n - 1):
        if d < 0:
            return None
        inverse += 1 / d if d > 0 else math.inf
        new_q[i] = d + e[i]
        if new_q[i] <= 0:
            return None
        t = q[i + 1] / new_q[i]
        new_e[i] = e[i] * t
        d = d * t - shift
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, inverse + (1 / d if d > 0 else math.inf)


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal matrix's singular values, falling, by dqds.

    Shifts are 1 / trace of the inverse, which never exceeds the smallest value, so the
    transforms keep all quantities positive and each value to high relative accuracy.
    """
    negligible = (10 * EPS) ** 2
    work = [(list(diagonal**2), list(upper**2), 0.0)]
    found: list[float] = []
    while work:
        q, e, base = work.pop()
        while True:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= negligible * max(base, q[i], q[i + 1])), None)
            if cut is not None:  # split; carry on with the lower part
                work.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(q[0] + base)
                break
            if q[-1] > 1.5 * q[0]:  # graded upwards: the reversed matrix has the same values
                q, e = q[::-1], e[::-1]
            plain = _dqds_step(q, e, 0.0)
            if plain is None or not math.isfinite(plain[2]):
                if plain is None or plain[0] == q:
                    e[-1] = 0.0
                else:
                    q, e = plain[:2]
                continue
            shift = (1 - 16 * EPS * len(q)) / plain[2]
            q, e = plain[:2]  # the transform with shift 0 has the same values
            shifted = _dqds_step(q, e, shift)
            if shifted is not None and base + shift > base:
                q, e, base = shifted[0], shifted[1], base + shift
    return np.sort(np.array(found))[::-1]


def _twisted(pivots: np.ndarray, ratios: np.ndarray, value: float, tiny: float):
    """Stationary and progressive factors of L D L^T - value, and the twist terms."""
    n = len(pivots)
    plus, up = np.empty(n), np.empty(n - 1)
    s = np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        plus[i] = s[i] + pivots[i] or tiny
        up[i] = pivots[i] * ratios[i] / plus[i]
        s[i + 1] = up[i] * ratios[i] * s[i] - value
    plus[-1] = s[-1] + pivots[-1]
    minus, down = np.empty(n), np.empty(n - 1)
    p = np.empty(n)
    p[-1] = pivots[-1] - value
    for i in range(n - 2, -1, -1):
        minus[i + 1] = pivots[i] * ratios[i] ** 2 + p[i + 1] or tiny
        t = pivots[i] / minus[i + 1]
        down[i] = ratios[i] * t
        p[i] = p[i + 1] * t - value
    minus[0] = p[0]
    return plus, up, minus, down, s + p + value


def _inverse_step(factors, twist: int, rhs: np.ndarray, tiny: float) -> np.ndarray:
    """Solve with N G N^T, the factorisation twisted at ``twist``."""
    plus, up, minus, down, gamma = factors
    n, y = len(rhs), rhs.copy()
    for i in range(twist):
        y[i + 1] -= up[i] * y[i]
    for i in range(n - 1, twist, -1):
        y[i - 1] -= down[i - 1] * y[i]
    y[:twist] /= plus[:twist]
    y[twist + 1 :] /= minus[twist + 1 :]
    y[twist] /= gamma[twist] or tiny
    for i in range(twist - 1, -1, -1):
        y[i] -= up[i] * y[i + 1]
    for i in range(twist, n - 1):
        y[i + 1] -= down[i] * y[i]
    return y / np.sqrt(y @ y)


def singular_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Right singular vectors of the ``count`` largest values (columns).

    B^T B = L D L^T; the factorisation twisted where its pivot is least gives the vector
    in one solve. Vectors of close values are made orthogonal by further solves.
    """
    n = len(diagonal)
    scale = math.sqrt(values[0])
    pivot = np.maximum(np.abs(diagonal), EPS**2 * scale)  # a zero pivot moves no value by more than that
    ratios = upper * np.where(diagonal < 0, -1.0, 1.0)[: n - 1] / pivot[: n - 1]
    pivots, tiny = pivot**2, EPS * EPS * values[0]
    out = np.zeros((n, count))
    random = np.random.default_rng(1)
    for k in range(count):
        factors = _twisted(pivots, ratios, values[k], tiny)
        twist = int(np.argmin(np.abs(factors[-1])))
        unit = np.zeros(n)
        unit[twist] = 1.0
        vector = _inverse_step(factors, twist, unit, tiny)
        close = [j for j in range(k) if values[j] - values[k] <= 1e-3 * values[0]]
        if close:
            before = out[:, close]
            for _ in range(6):
                rest = vector - before @ (before.T @ vector)
                length = math.sqrt(rest @ rest)
                vector = rest / length if length > 0.5 else _inverse_step(factors, twist, _away(random, before), tiny)
                if length > 1 - 1e-12:
                    break
            vector -= before @ (before.T @ vector)
            vector /= math.sqrt(vector @ vector)
        out[:, k] = vector
    return out


def _away(random: np.random.Generator, before: np.ndarray) -> np.ndarray:
    x = random.normal(size=before.shape[0])
    return x - before @ (before.T @ x)


# ---------------------------------------------------------------- distributed part


def integer_vectors(df: DataFrame, embedding: str = "embedding", scale: int = SCALE, **keep: Column) -> DataFrame:
    """``x`` = floor(scale * entry) of the rows that take part, with the columns of ``keep``."""
    e = F.col(f"`{embedding}`")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    x = F.transform(e, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    return df.where(e.isNotNull() & ~bad).select(*[c.alias(k) for k, c in keep.items()], x.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows padded with zeros to ``dims``."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), dims), np.int64)
    flat = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    total = [0] * dims
    for b in batches:
        x = _matrix(b.column("x"), dims)
        exact = len(x) * max(float(np.abs(x.astype(float)).max(initial=0)), 1) < 2**62
        total = [a + int(s) for a, s in zip(total, (x if exact else x.astype(object)).sum(axis=0))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(dims), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["dim", "s"]
    )


def _triangle(batches: Iterator[pa.RecordBatch], mean: np.ndarray) -> Iterator[pa.RecordBatch]:
    dims = len(mean)
    r = np.zeros((0, dims))
    for b in batches:
        r = np.linalg.qr(np.vstack([r, _matrix(b.column("x"), dims) - mean]), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_square(r).tobytes()], pa.binary())],
            names=["part", "r"],
        )


def _square(r: np.ndarray) -> np.ndarray:
    out = np.zeros((r.shape[1], r.shape[1]))
    out[: len(r)] = r
    return out


def _reduced(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The triangle R of all centred rows, from the triangles of blocks."""
    dims = len(mean)

    def stack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [np.frombuffer(x).reshape(dims, dims) for x in rows.sort_values("part")["r"]]
        return pd.DataFrame({"part": [key[0]], "r": [_square(np.linalg.qr(np.vstack(blocks), mode="r")).tobytes()]})

    parts = stored(map_arrow(fit, lambda it: _triangle(it, mean), "part long, r binary"), "triangles")
    while parts.count() > 1:
        groups = parts.groupBy(F.expr(f"part div {FAN}").alias("part"))
        parts = stored(groups.applyInPandas(stack, "part long, r binary"), "triangles")
    return np.frombuffer(parts.first()["r"]).reshape(dims, dims)


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size and exact sums, and the components (columns)."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.variances)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - sums)**2 of every row, exact."""
        reach = self.n * max(float(np.abs(x.astype(float)).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        whole = np.int64 if reach**2 * max(len(self.sums), 1) < 2**62 else object
        d = x.astype(whole) * self.n - np.array(self.sums, dtype=whole)
        return [int(v) for v in (d * d).sum(axis=1)]


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, as a stored table."""
    return stored(vectors.select("x").distinct(), "distinct_vectors")


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list; None if it is empty or its vectors have no entry."""
    ship(distinct.sparkSession)
    dims, n = distinct.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    if not n or not dims:
        return None
    cells = map_arrow(distinct, lambda it: _sums(it, dims), "dim int, s decimal(38,0)")
    total = {r.dim: int(r.s) for r in cells.groupBy("dim").agg(F.sum("s").alias("s")).collect()}  # dims rows
    sums = [total[i] for i in range(dims)]
    r = _reduced(distinct, np.array([s / n for s in sums]))
    trace = float((r**2).sum()) / n
    diagonal, upper, v = bidiagonal(r)
    values = squared_singular_values(diagonal, upper)
    # rounding of the centred rows alone leaves singular values of this size
    noise = EPS * max(dims, 10) * math.sqrt(n) * max(abs(s / n) for s in sums)
    floor = max((EPS * max(dims, 10)) ** 2 * values[0], noise**2)
    count = int((values[:components] > floor).sum())
    if not count:
        return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), trace)
    vectors = v @ singular_vectors(diagonal, upper, values, count)
    return Whitening(n, sums, vectors, values[:count] / n, trace)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, dims = len(model.variances), len(model.sums)
    if not k:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for b in batches:
            w = model.project(_matrix(b.column("x"), dims))
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(total)], names=["cell", "t"])

    cells = map_arrow(distinct, moments, "cell int, t double").groupBy("cell").agg(F.sum("t").alias("t")).collect()
    flat = np.array([t for _, t in sorted((c.cell, c.t) for c in cells)]) / model.n
    covariance = flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening | None, key: str) -> DataFrame:
    """``key``, exact ``deviation`` and the ``whitened`` entries of every row of ``vectors``."""
    key_type = vectors.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, deviation decimal(38,0), whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = len(model.sums)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dims)
            deviation = [v if v < 10**38 else None for v in model.deviation(x)]
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(deviation, pa.decimal128(38, 0)), pa.array(list(model.project(x)), pa.list_(pa.float64()))],
                names=[key, "deviation", "whitened"],
            )

    return map_arrow(vectors, task, schema)
