"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, so counts, sums and products add up exactly in any order: the covariance is the same on every
run. Its eigenvalues are found one by one. The triangular factors of the covariance less a shift (L D L', with pivots of one
or two rows) have as many positive pivots as there are eigenvalues above the shift; bisection by that count isolates the
k-th largest. Rayleigh quotient iteration then converges cubically, with the same factors as its solver. An eigenvalue is
accepted if it lies in its interval, its residual is down to rounding, and the counts just below and above it say that it is
number k. A pair already found is taken out of the matrix before the next search inside a cluster too tight to separate.

Only the covariance (dimension squared) reaches the driver, and only the components go to the tasks; rows stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import keep

#: Entries are counted in steps of 1 / STEPS, from -OFFSET on.
STEPS, OFFSET = 64, 1_000_000
#: Components returned.
COMPONENTS = 16
#: Whole numbers up to which a double is exact; entries beyond have no step and count as not finite.
EXACT = 1 << 52
#: Rows a task multiplies together.
ROWS = 8192
#: Eigenvalues below this share of the largest are zero as far as doubles can tell.
RANK = 1e-12

_PIVOT = (1 + 17**0.5) / 8


# Spectrum slicing


@dataclass
class Factors:
    """P' (A - shift) P = L D L'."""

    order: np.ndarray
    low: np.ndarray
    blocks: list[tuple[int, np.ndarray]]
    positive: int

    def solve(self, b: np.ndarray) -> np.ndarray:
        n, x = len(b), b[self.order].astype(float)
        for k in range(n):
            x[k + 1 :] -= self.low[k + 1 :, k] * x[k]
        for k, block in self.blocks:
            x[k : k + len(block)] = np.linalg.solve(block, x[k : k + len(block)])
        for k in range(n - 1, -1, -1):
            x[k] -= self.low[k + 1 :, k] @ x[k + 1 :]
        out = np.empty(n)
        out[self.order] = x
        return out


def factor(matrix: np.ndarray, shift: float) -> Factors:
    """Factors with complete pivoting; a pivot that vanishes is replaced by one at rounding level."""
    n = len(matrix)
    a = matrix - shift * np.eye(n)
    tiny = np.finfo(float).eps * max(float(np.abs(matrix).max(initial=0)), abs(shift), 1e-300)
    order, low, blocks, positive, k = np.arange(n), np.eye(n), [], 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            low[[i, j], :k] = low[[j, i], :k]
            order[[i, j]] = order[[j, i]]

    while k < n:
        size = np.abs(a[k:, k:])
        on = size.diagonal().copy()
        np.fill_diagonal(size, 0)
        single, (p, q) = int(on.argmax()), np.unravel_index(int(size.argmax()), size.shape)
        if on[single] >= _PIVOT * size[p, q]:
            swap(k, k + single)
            pivot = a[k, k] if abs(a[k, k]) > tiny else -tiny
            blocks.append((k, np.array([[pivot]])))
            positive += pivot > 0
            column = a[k + 1 :, k].copy()
            low[k + 1 :, k] = column / pivot
            a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], column)
            k += 1
        else:
            p, q = sorted((int(p), int(q)))
            swap(k, k + p)
            swap(k + 1, k + q)
            block, columns = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2].copy()
            blocks.append((k, block))
            positive += 1  # such a block has one eigenvalue of either sign
            low[k + 2 :, k : k + 2] = np.linalg.solve(block, columns.T).T
            a[k + 2 :, k + 2 :] -= low[k + 2 :, k : k + 2] @ columns.T
            k += 2
    return Factors(order, low, blocks, positive)


def leading(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The `many` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    n = len(matrix)
    many = min(many, n)
    values, vectors = np.zeros(many), np.zeros((n, many))
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    if not scale:
        return values, np.eye(n)[:, :many]
    fine = 4 * n * np.finfo(float).eps * scale
    counts: dict[float, int] = {-scale - fine: n, scale + fine: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = factor(matrix, shift).positive
        return counts[shift]

    rng = np.random.default_rng(n)
    for k in range(1, many + 1):
        found = vectors[:, : k - 1]
        # Pairs found are moved to the far end below, so that the next search cannot meet them again.
        rest = matrix - (found * (values[: k - 1] + 2 * scale)) @ found.T
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        while True:
            while high - low > fine and (counts[low] != k or counts[high] != k - 1):
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
            value, vector, off = refine(rest, (low + high) / 2, rng.normal(size=n), found)
            # The counts around it say that it is number k; within a cluster they can only say that k is among its numbers.
            if off <= fine and above(value - 2 * fine) >= k and above(value + 2 * fine) < k:
                break
            middle = (low + high) / 2
            if high - low <= fine / 8:
                raise ArithmeticError(f"no eigenvector for eigenvalue {k}")
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        values[k - 1] = value
        vectors[:, k - 1] = vector * (1 if vector[np.abs(vector).argmax()] > 0 else -1)
    return values, vectors


def refine(matrix: np.ndarray, shift: float, vector: np.ndarray, found: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Two steps of inverse iteration at the shift, then Rayleigh quotient iteration: value, unit vector, residual."""

    def unit(v: np.ndarray) -> np.ndarray:
        v = v / np.linalg.norm(v)
        v = v - found @ (found.T @ v)
        return v / np.linalg.norm(v)

    vector, factors = unit(vector), factor(matrix, shift)
    for _ in range(2):
        vector = unit(factors.solve(vector))
    best = (np.inf, shift, vector)
    for _ in range(12):
        value = float(vector @ matrix @ vector)
        off = float(np.linalg.norm(matrix @ vector - value * vector))
        if off >= best[0]:
            break
        best = (off, value, vector)
        vector = unit(factor(matrix, value).solve(vector))
    return best[1], best[2], best[0]


# Fit and apply


@dataclass
class Whitening:
    n: int  # vectors of the fit list
    total: list[int]  # their sum in each dimension
    trace: float
    values: np.ndarray
    vectors: np.ndarray  # a column for each component
    identity_error: float | None = None

    @property
    def known(self) -> int:
        """Components whose eigenvalue can be told from zero."""
        return int((self.values > RANK * max(self.values.max(initial=0), 1e-300)).sum())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in doubles; the whole part of the mean goes first, in whole numbers."""
        whole = [s // self.n for s in self.total]
        part = np.array([float(Fraction(s, self.n) - w) for s, w in zip(self.total, whole, strict=True)])
        return (x - np.array(whole, np.int64)).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        k = self.known
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly; None where it has no place in a long."""
        whole = np.array([s // self.n for s in self.total], np.int64)
        part = [s - self.n * int(w) for s, w in zip(self.total, whole, strict=True)]
        near = x - whole
        reach = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if reach * reach * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * near - np.array(part, np.int64)) ** 2).sum(axis=1).tolist()
        sums = (sum((self.n * int(v) - p) ** 2 for v, p in zip(row, part, strict=True)) for row in near)
        return [s if s < 1 << 63 else None for s in sums]


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a column of lists: which are usable, their lengths, and x of all usable ones below each other."""
    lists = column.cast(pa.large_list(pa.float64()))
    length = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    c = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        bad = ~(np.abs(c) < EXACT / STEPS)
    end = np.cumsum(length)
    run = np.concatenate([[0], np.cumsum(bad)])
    good = (run[end] == run[end - length]) & np.asarray(lists.is_valid())
    x = np.floor(STEPS * c[np.repeat(good, length)]).astype(np.int64) + OFFSET
    return good, length, x


def vectors_of(table: DataFrame, vector: str) -> DataFrame:
    """Each different usable vector once: `dim`, `x` (its whole numbers as bytes)."""

    def run(batches):
        for batch in batches:
            good, length, x = _whole(batch.column(0))
            dim = length[good]
            end = np.cumsum(dim) * 8
            raw = x.tobytes()
            rows = [raw[e - 8 * d : e] for e, d in zip(end.tolist(), dim.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(dim, pa.int32()), pa.array(rows, pa.binary())], ["dim", "x"])

    return table.select(F.col(vector).alias("v")).mapInArrow(run, "dim int, x binary").where("dim > 0").distinct()


def _blocks(batches, dim: int):
    for batch in batches:
        rows = batch.column(0)
        for i in range(0, len(rows), ROWS):
            part = rows.slice(i, ROWS)
            yield np.frombuffer(b"".join(part.to_pylist()), np.int64).reshape(len(part), dim)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y exactly: by doubles while every sum stays a whole number they can hold."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, len(y)) < EXACT:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _summed(df: DataFrame) -> dict[tuple[int, int], int]:
    rows = df.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    return {(r.i, r.j): int(r.s) for r in rows}


_SUMS = "i int, j int, s decimal(38,0)"


def _sums(cells: list[tuple[int, int, int]]) -> pa.RecordBatch:
    i, j, s = zip(*cells, strict=True)
    kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip((i, j, [*map(int, s)]), kinds, strict=True)], ["i", "j", "s"])


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn the components from each different vector once; None without a usable vector.

    Vectors are those of the most frequent length (of several, the longest). What reaches the driver is a number for each
    pair of dimensions, whatever the rows.
    """
    distinct = keep(vectors_of(table, vector), "whitening")
    dims = distinct.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).take(1)
    if not dims:
        return None
    dim, n = dims[0]
    rows = distinct.where(F.col("dim") == dim).select("x")

    def totals(batches):
        total = np.zeros(dim, object)
        for x in _blocks(batches, dim):
            total += x.astype(object).sum(axis=0) if np.abs(x).max() >= EXACT // ROWS else x.sum(axis=0).astype(object)
        yield _sums([(i, 0, s) for i, s in enumerate(total)])

    found = _summed(rows.mapInArrow(totals, _SUMS))
    total = [found[i, 0] for i in range(dim)]
    # Products of the vectors less the mean, the mean rounded to whole numbers; the rest of it is taken off exactly.
    near = [round(Fraction(s, n)) for s in total]
    rest = np.array([s - n * m for s, m in zip(total, near, strict=True)], object)
    middle = np.array(near, np.int64)

    def products(batches):
        out = np.zeros((dim, dim), object)
        for x in _blocks(batches, dim):
            out += _products(x - middle)
        yield _sums([(i, j, out[i, j]) for i in range(dim) for j in range(i, dim)])

    cells = _summed(rows.mapInArrow(products, _SUMS))
    v = np.zeros((dim, dim))
    for (i, j), s in cells.items():
        v[i, j] = v[j, i] = float(Fraction(n * s - rest[i] * rest[j], n * n))
    model = Whitening(n, total, float(np.trace(v)), *leading(v, components))
    k = model.known
    if k:

        def covariance(batches):
            out = np.zeros((k + 1, k))
            for x in _blocks(batches, dim):
                w = model.whitened(x)
                out[:k] += w.T @ w
                out[k] += w.sum(axis=0)
            at = np.indices(out.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(out.ravel())], ["i", "j", "s"])

        sums = np.zeros((k + 1, k))
        for i, j, s in rows.mapInArrow(covariance, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
            sums[i, j] = s
        mean = sums[k] / n
        model.identity_error = float(np.abs(sums[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


COLUMNS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or empty, holds NULL or an entry that is not finite (or too large to count in steps), or has
    another length than most vectors are left out. A vector that occurs again, under the same key or not, is one in the fit
    and a row of its own in the result. A NULL key stays NULL. Vectors of few dimensions have as many components; where the
    vectors do not vary along a component `whitened` is NULL, and `explained` is 0 (NULL if they do not vary at all).
    `deviation` is NULL where the sum exceeds a long. Without a usable vector the result is empty. No other column is read.
    """
    model = fit(table, vector, components)
    source = table.select(F.col(key).alias(key), F.col(vector).alias("__vector"))
    spark = table.sparkSession
    kind = f"`{key}` {source.schema[0].dataType.simpleString()}, {COLUMNS}"
    if model is None:
        return spark.createDataFrame([], kind)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        m: Whitening = sent.value
        dim, many, known = len(m.total), len(m.values), m.known
        share = [(float(e / m.trace) if k < known else 0.0) if m.trace else None for k, e in enumerate(m.values)]
        for batch in batches:
            good, length, flat = _whole(batch.column(1))
            fits = length[good] == dim
            x = flat[np.repeat(fits, length[good])].reshape(-1, dim)
            place = np.flatnonzero(good)[fits]
            for i in range(0, len(x), ROWS):
                part = x[i : i + ROWS]
                rows = len(part)
                values = np.full((rows, many), np.nan)
                values[:, :known] = m.whitened(part)
                again = np.repeat(np.arange(rows), many)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(place[i : i + ROWS][again])),
                        pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * many, m.n)),
                        pa.array(m.deviation(part), pa.int64()).take(pa.array(again)),
                        pa.array(values.ravel(), mask=np.isnan(values.ravel())),
                        pa.array(share * rows, pa.float64()),
                        pa.array([m.identity_error] * (rows * many), pa.float64()),
                    ],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return source.mapInArrow(run, kind)
