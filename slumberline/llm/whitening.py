"""Whitening of embeddings: leading eigenvalues by spectrum slicing, rows projected and scaled.

A row is left out if its vector is null or has a null, NaN or infinite entry. An entry c becomes the whole number
``floor(64 c) + 1000000``. The fit list is all rows that are left: n vectors x with sums S. V is their covariance (divisor n).

1. One aggregation gives n, S and the range of each dimension.
2. Every task adds up products of x, centred at the whole numbers nearest to the means, in blocks of rows; rows of the matrix
   are summed by Spark. The products are whole numbers, summed exactly where they fit into 63 bits, so that V doesn't hang on
   the order of rows (else in double precision); what the means lie beside the whole numbers is taken off exactly.
3. On the driver, a matrix of dimensions times dimensions: ``inertia`` counts the eigenvalues above a shift by the signs of D in
   the factorisation L D L' of V minus the shift, with pivots of one or two rows (Bunch and Kaufman). Bisection of the
   spectrum by counts isolates each leading eigenvalue, or a cluster that double precision can't tell apart.
   Rayleigh quotient iteration from inside the interval converges cubically; a result outside its interval, or with a large
   residual, is started anew after more bisection. Counts at both sides of every computed eigenvalue certify its number.
4. Rows are projected in Arrow batches; the covariance of what comes out is computed in one more pass and compared with the identity.

Defined results: the dimension is that of most rows (ties: the larger one), and rows of other lengths are left out like null ones; an entry
beyond 2**53 in absolute value, before the offset, counts as that bound; eigenvalues below ``RANK`` (1e-11) of the largest
have no component, so constant dimensions, few rows or one row give fewer components, and equal rows alone give none and no
rows; equal eigenvalues get orthonormal vectors, whose choice within their space is fixed by the start vectors; the largest entry of a component (the first
of equal ones) is positive; a deviation beyond 63 bits is null; null and repeated ids and repeated vectors are rows like
others; an empty table gives an empty result. Other columns are not read; vectors may be long, memory goes with the square of their dimension.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
RANK = 1e-11
BOUND = 2.0**53
# Rows that a task multiplies at once.
ROWS = 4096
# Growth bound of Bunch-Kaufman pivoting, a fixed value of the method.
ALPHA = (1 + 17**0.5) / 8
EPS = float(np.finfo(np.float64).eps)


# --- vectors ------------------------------------------------------------------------------------


def whole_vectors(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a usable vector, and those vectors as whole numbers without the offset, in doubles."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usable = lengths == dimension
    flat = column.filter(pa.array(usable)).flatten()
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dimension)
    finite = np.isfinite(values).all(axis=1)
    usable[usable] = finite
    with np.errstate(over="ignore"):
        scaled = np.floor(values[finite] * SCALE)
    return usable, np.clip(scaled, -BOUND, BOUND)


def slabs(batches: Iterable[pa.RecordBatch], at: int, dimension: int):
    """Batches in pieces of bounded size, with what ``whole_vectors`` gives for them."""
    rows = max(1, min(ROWS, (1 << 22) // dimension))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            piece = batch.slice(start, rows)
            usable, x = whole_vectors(piece.column(at), dimension)
            yield piece, usable, x


# --- moments ------------------------------------------------------------------------------------


def common_dimension(rows: DataFrame, vector: str) -> int:
    """The length of most vectors; 0 without any."""
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0)
    lengths = rows.filter(usable).groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    first = lengths.agg(F.max(F.struct("rows", "d")).alias("most")).first()["most"]
    return first["d"] if first else 0


def sums_task(dimension: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        n, high, low = 0, np.full(dimension, -np.inf), np.full(dimension, np.inf)
        total = [0] * dimension
        for _, _, x in slabs(batches, 0, dimension):
            if len(x):
                n += len(x)
                high, low = np.maximum(high, x.max(axis=0)), np.minimum(low, x.min(axis=0))
                # Exact: 26 low bits apart from the rest, so that neither sum leaves 63 bits.
                whole = x.astype(np.int64)
                above = (whole >> 26).sum(axis=0)
                below = (whole & ((1 << 26) - 1)).sum(axis=0)
                total = [t + (int(a) << 26) + int(b) for t, a, b in zip(total, above, below)]
        if n:
            columns = [
                pa.array(np.arange(dimension, dtype=np.int32)),
                pa.array([n] * dimension, pa.int64()),
                pa.array([str(t) for t in total], pa.string()),
                pa.array(high),
                pa.array(low),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "total", "high", "low"])

    return task


@dataclass(frozen=True)
class Moments:
    """Of the fit list: its size, exact sums per dimension without the offset, and the range."""

    n: int
    sums: list[int]
    largest: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centres(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.float64)

    def rests(self) -> list[int]:
        """n times what the mean lies above its centre."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centres())]

    def spread(self) -> float:
        """No centred entry is larger."""
        return 2 * self.largest + 1


def moments(rows: DataFrame, vector: str) -> Moments | None:
    dimension = common_dimension(rows, vector)
    if not dimension:
        return None
    schema = "i int, n bigint, total string, high double, low double"
    parts = rows.select(vector).mapInArrow(sums_task(dimension), schema)
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    largest = F.max(F.greatest(F.abs("high"), F.abs("low"))).alias("largest")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), total, largest).orderBy("i").collect()
    if not found:
        return None
    return Moments(found[0]["n"], [int(r["total"]) for r in found], max(r["largest"] for r in found))


def products_task(centres: np.ndarray, exact: bool, projection: np.ndarray | None = None, shift: np.ndarray | None = None):
    """The sums of products of centred vectors, one row per row of the matrix; projected ones if so asked."""
    dimension = len(centres)
    kind = np.int64 if exact else np.float64

    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        width = dimension if projection is None else projection.shape[1]
        total, ones = np.zeros((width, width), dtype=kind), np.zeros(width)
        for _, _, x in slabs(batches, 0, dimension):
            y = x - centres
            if projection is not None:
                y = (y - shift) @ projection
            ones += y.sum(axis=0)
            product = y.T @ y
            total += np.rint(product).astype(np.int64) if exact else product
        values = pa.array(list(total), pa.list_(pa.int64() if exact else pa.float64()))
        columns = [pa.array(np.arange(width, dtype=np.int32)), values, pa.array(ones)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "products", "total"])

    return task


def summed_products(rows: DataFrame, vector: str, task, exact: bool, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The matrix of sums of products as Python numbers, and the sums."""
    kind = "bigint" if exact else "double"
    parts = rows.select(vector).mapInArrow(task, f"i int, products array<{kind}>, total double")
    cells = parts.select("i", "total", F.posexplode("products").alias("j", "product"))
    found = cells.groupBy("i", "j").agg(F.sum("product").alias("product"), F.sum("total").alias("total")).collect()
    matrix, sums = np.zeros((width, width), dtype=object if exact else np.float64), np.zeros(width)
    for r in found:
        matrix[r["i"], r["j"]] = r["product"]
        sums[r["i"]] = r["total"]
    return matrix, sums


def covariance(rows: DataFrame, vector: str, fit: Moments) -> np.ndarray:
    """V of the fit list."""
    centres, rests, n = fit.centres(), fit.rests(), fit.n
    block = max(1, min(ROWS, (1 << 22) // fit.dimension))
    exact = fit.spread() ** 2 * max(n, 1) < 2.0**62 and fit.spread() ** 2 * block < BOUND
    sums, _ = summed_products(rows, vector, products_task(centres, exact), exact, fit.dimension)
    if exact:
        # n * sum - rest * rest is a whole number, and so is n * n.
        rest = np.array(rests, dtype=object)
        return ((n * sums - np.outer(rest, rest)) / (n * n)).astype(np.float64)
    shift = np.array([r / n for r in rests])
    return sums / n - np.outer(shift, shift)


# --- spectrum slicing -----------------------------------------------------------------------------


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``: the positive ones of D in L D L' = a - shift."""
    m = a - shift * np.eye(len(a))
    size = np.abs(m).max(initial=0.0)
    tiny = EPS * size * EPS if size else 1.0
    above, k, n = 0, 0, len(m)
    while k < n:
        step = 1
        if k + 1 < n:
            column = np.abs(m[k + 1 :, k])
            r = int(column.argmax()) + k + 1
            most = column[r - k - 1]
            if most > 0 and abs(m[k, k]) < ALPHA * most:
                others = np.abs(m[r, k:]).copy()
                others[r - k] = 0
                reach = others.max()
                if abs(m[k, k]) * reach >= ALPHA * most * most:
                    pass
                elif abs(m[r, r]) >= ALPHA * reach:
                    m[[k, r]] = m[[r, k]]
                    m[:, [k, r]] = m[:, [r, k]]
                else:
                    step = 2
                    if r != k + 1:
                        m[[k + 1, r]] = m[[r, k + 1]]
                        m[:, [k + 1, r]] = m[:, [r, k + 1]]
        if step == 1:
            pivot = m[k, k]
            if abs(pivot) <= tiny:
                pivot = tiny  # an eigenvalue at the shift to the last bit counts as above it
            above += pivot > 0
            factor = m[k + 1 :, k] / pivot
            m[k + 1 :, k + 1 :] -= np.outer(factor, m[k, k + 1 :])
        else:
            above += 1  # such a block has one eigenvalue of either sign
            pivots = m[k : k + 2, k : k + 2]
            rows = m[k : k + 2, k + 2 :]
            m[k + 2 :, k + 2 :] -= rows.T @ np.linalg.solve(pivots, rows)
        k += step
    return above


@dataclass
class Slice:
    """An interval of the spectrum: ``above`` counts the eigenvalues over its upper end, ``within`` those inside."""

    low: float
    high: float
    above: int
    within: int


def slices(a: np.ndarray, wanted: int, least_width: float) -> list[Slice]:
    """Disjoint intervals, from the top, that hold the ``wanted`` leading eigenvalues, each only one or a cluster no wider
    than ``least_width``."""
    radius = np.abs(a).sum(axis=1).max(initial=0.0) * (1 + 1e-9) + least_width
    todo, found = [Slice(-radius, radius, 0, len(a))], []
    while todo:
        part = todo.pop()
        if part.above >= wanted or not part.within:
            continue
        if part.within == 1 and part.high - part.low <= 1e-3 * radius or part.high - part.low <= least_width:
            found.append(part)
            continue
        middle = (part.low + part.high) / 2
        over = min(max(inertia(a, middle) - part.above, 0), part.within)
        todo.append(Slice(part.low, middle, part.above + over, part.within - over))
        todo.append(Slice(middle, part.high, part.above, over))
    return found


def rayleigh(a: np.ndarray, part: Slice, found: np.ndarray, start: np.ndarray, good: float) -> tuple[float, np.ndarray, float]:
    """An eigenvalue in the interval, its unit vector orthogonal to the columns of ``found``, and the residual."""

    def free(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found @ (found.T @ v)
        return v / np.linalg.norm(v)

    v, shift = free(start), (part.low + part.high) / 2
    best = (shift, v, np.inf)
    for turn in range(30):
        try:
            w = np.linalg.solve(a - shift * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(a - (shift + max(abs(shift), good) * EPS * 4) * np.eye(len(a)), v)
        if not np.isfinite(w).all():
            break
        v = free(w / np.linalg.norm(w))
        value = float(v @ (a @ v))
        residual = float(np.linalg.norm(a @ v - value * v))
        if residual < best[2]:
            best = (value, v, residual)
        elif turn > 4 and best[2] <= good:
            break
        # Inverse iteration at the middle until the quotient lies in the interval, then at the quotient.
        if part.low <= value <= part.high:
            shift = value
    return best


@dataclass(frozen=True)
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def leading(a: np.ndarray, wanted: int = COMPONENTS) -> Spectrum:
    """The leading eigenvalues of a covariance, falling, with unit vectors in columns; only those above ``RANK``."""
    size, trace = len(a), float(np.trace(a))
    norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if not size or not norm:
        return Spectrum(np.zeros(0), np.zeros((size, 0)), trace)
    good = 64 * EPS * norm * max(size, 2) ** 0.5
    least_width = 16 * EPS * norm
    random = np.random.default_rng(7)
    vectors, values = np.zeros((size, 0)), []
    todo = slices(a, min(wanted, size), least_width)[::-1]
    while todo and len(values) < min(wanted, size):
        part = todo.pop()
        own: list[tuple[float, np.ndarray]] = []
        for _ in range(part.within):
            basis = np.column_stack([vectors, *[v for _, v in own]])
            for _ in range(6):
                value, v, residual = rayleigh(a, part, basis, random.standard_normal(size), good)
                inside = part.low - good <= value <= part.high + good
                if inside and residual <= good:
                    own.append((value, v))
                    break
            else:
                own = []
                break
        if not own:
            # Not isolated well enough: cut the interval in two and count again.
            middle = (part.low + part.high) / 2
            if part.high - part.low <= least_width / 16:
                raise ArithmeticError(f"no eigenvector found between {part.low} and {part.high}")
            over = min(max(inertia(a, middle) - part.above, 0), part.within)
            for half in (Slice(part.low, middle, part.above + over, part.within - over), Slice(middle, part.high, part.above, over)):
                if half.within:
                    todo.append(half)
            continue
        for value, v in sorted(own, key=lambda pair: -pair[0]):
            values.append(value)
            vectors = np.column_stack([vectors, v])
    values_, vectors = np.array(values[:wanted]), vectors[:, :wanted]
    order = np.argsort(-values_, kind="stable")
    values_, vectors = values_[order], vectors[:, order]
    kept = values_ > RANK * values_[0]
    values_, vectors = values_[kept], vectors[:, kept]
    certify(a, values_, 4 * good)
    first = np.abs(vectors).argmax(axis=0)
    return Spectrum(values_, vectors * np.sign(vectors[first, np.arange(len(values_))]), trace)


def certify(a: np.ndarray, values: np.ndarray, margin: float) -> None:
    """Counts beside every eigenvalue agree with its number: as many lie above as were numbered before it."""
    for k, value in enumerate(values):
        if inertia(a, value + margin) > k or inertia(a, value - margin) < k + 1:
            raise ArithmeticError(f"eigenvalue {k + 1} = {value} is numbered wrongly")


# --- rows ----------------------------------------------------------------------------------------


def deviations(x: np.ndarray, fit: Moments) -> list[int | None]:
    """The sum over dimensions of (n x - S)**2, exact."""
    centres, rests, n = fit.centres(), fit.rests(), fit.n
    if (n * fit.spread() + n) ** 2 * fit.dimension < 2.0**63:
        off = n * (x - centres).astype(np.int64) - np.array(rests, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    found = []
    for row in x - centres:
        total = sum((n * int(c) - r) ** 2 for c, r in zip(row, rests))
        found.append(total if total < 1 << 63 else None)
    return found


def whiten_task(fit: Moments, spectrum: Spectrum, error: float):
    centres, shift = fit.centres(), np.array([r / fit.n for r in fit.rests()])
    projection = spectrum.vectors / np.sqrt(spectrum.values)
    count = len(spectrum.values)
    explained = spectrum.values / spectrum.trace

    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for piece, usable, x in slabs(batches, 1, fit.dimension):
            white = (x - centres - shift) @ projection
            rows = np.flatnonzero(usable)
            each = np.repeat(rows, count)
            deviation = pa.array(deviations(x, fit), pa.int64())
            columns = [
                piece.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(each), fit.n, dtype=np.int64)),
                deviation.take(pa.array(np.repeat(np.arange(len(rows)), count))),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, len(rows))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=RESULT)

    return task


RESULT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``rows`` (vec_id and ``vector``) and component: the columns of ``RESULT``."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = rows.select("vec_id", vector)
    fit = moments(rows, vector)
    spectrum = leading(covariance(rows, vector, fit), components) if fit else None
    if not spectrum or not len(spectrum.values):
        return rows.sparkSession.createDataFrame([], schema)
    shift = np.array([r / fit.n for r in fit.rests()])
    projection = spectrum.vectors / np.sqrt(spectrum.values)
    task = products_task(fit.centres(), False, projection, shift)
    products, sums = summed_products(rows, vector, task, False, len(spectrum.values))
    mean = sums / fit.n
    error = float(np.abs(products / fit.n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return rows.mapInArrow(whiten_task(fit, spectrum, error), schema)
