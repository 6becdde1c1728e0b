"""Embedding whitening by spectrum slicing.

Vectors become whole numbers, so equal ones are found exactly; every different vector counts once in the fit. Spark sums the
fit's moments, and what reaches the driver is one matrix of the vectors' width. There the number of eigenvalues above a
shift is read off the signs of an LDLᵀ factorisation of the shifted covariance (Sylvester's law of inertia). Halving by such counts
isolates each leading eigenvalue in an interval of its own; Rayleigh quotient iteration inside it converges
cubically to the eigenvalue and its vector, and counts on either side certify that it is the k-th. Eigenvalues that
stay together down to the precision of numbers are taken as one group, whose plane is found by inverse iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import small_batches
from topictide.session import materialise

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LONG = np.iinfo(np.int64)
RANK = 1e-12  # share of the trace below which an eigenvalue counts as zero
_ALPHA = (1 + 17**0.5) / 8  # pivots of Bunch and Kaufman


def count_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` exceed ``shift``: positive pivots of LDLᵀ of ``a - shift``.

    Pivots are single entries or two-by-two blocks (one eigenvalue on either side), chosen so that factors stay bounded."""
    a = a - shift * np.eye(len(a))
    n, k, above = len(a), 0, 0
    tiny = np.finfo(float).eps * max(float(np.abs(a).max(initial=0.0)), np.finfo(float).tiny)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = float(below.max(initial=0.0))
        single = abs(a[k, k]) >= _ALPHA * most
        if not single:
            row = np.abs(a[k:, r])
            row[r - k] = 0
            other = float(row.max())
            if abs(a[k, k]) * other >= _ALPHA * most * most:
                single = True
            elif abs(a[r, r]) >= _ALPHA * other:
                swap(k, r)
                single = True
        if single:
            pivot = a[k, k] if abs(a[k, k]) > tiny else -tiny  # an eigenvalue at the shift is not above it
            above += pivot > 0
            column = a[k + 1 :, k] / pivot
            a[k + 1 :, k + 1 :] -= np.outer(column, a[k, k + 1 :])
            k += 1
        else:
            swap(k + 1, r)
            block = a[k : k + 2, k : k + 2].copy()
            above += 1  # the determinant is negative
            if k + 2 < n:
                rest = a[k + 2 :, k : k + 2].copy()
                a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
    return int(above)


def _solve(a: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(a - shift)⁻¹ b; a shift that is an eigenvalue to the last digit moves by one."""
    step = np.finfo(float).eps * max(abs(shift), float(np.abs(a).max()))
    for k in range(4):
        try:
            x = np.linalg.solve(a - (shift + k * step) * np.eye(len(a)), b)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all():
            return x
    return b


def rayleigh_iteration(a: np.ndarray, low: float, high: float, found: np.ndarray, rounds: int = 12) -> tuple[float, np.ndarray] | None:
    """The eigenpair in (low, high), or None if the iteration leaves the interval."""
    rng = np.random.default_rng(len(found.T))
    x = rng.standard_normal(len(a))
    shift = (low + high) / 2
    for k in range(rounds):
        x = _solve(a, shift, x)
        x -= found @ (found.T @ x)
        x /= np.linalg.norm(x)
        value = float(x @ a @ x)
        if k >= 1:  # the first steps with the fixed shift turn the vector towards the interval
            if not low <= value <= high:
                return None
            if np.linalg.norm(a @ x - value * x) <= 8 * len(a) * np.finfo(float).eps * np.abs(a).max():
                return value, x
            shift = value
    return None


def _plane(a: np.ndarray, shift: float, m: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` eigenpairs nearest to ``shift``, falling, by inverse iteration on a block."""
    x = np.random.default_rng(m).standard_normal((len(a), m))
    for _ in range(6):
        x = _solve(a, shift, x)
        x, _ = np.linalg.qr(x - found @ (found.T @ x))
    values, turn = np.linalg.eigh(x.T @ a @ x)
    return values[::-1], (x @ turn)[:, ::-1]


def leading_eigenpairs(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues of the covariance ``a`` above zero, falling, and their unit vectors (columns)."""
    trace = float(np.trace(a))
    if not len(a) or trace <= 0:
        return np.empty(0), np.empty((len(a), 0))
    bound = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)  # no eigenvalue exceeds the largest row sum
    floor = RANK * trace
    known = {floor: count_above(a, floor), bound: 0}  # counts by shift
    most = min(most, known[floor])
    values, vectors = np.empty(0), np.empty((len(a), 0))

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(a, shift)
        return known[shift]

    width = 64 * np.finfo(float).eps * bound
    while len(values) < most:
        k = len(values)  # the (k + 1)-th: the interval has at most k above its high end and more than k above its low end
        high = min(s for s, c in known.items() if c <= k)
        low = max(s for s, c in known.items() if c > k)
        while known[low] - known[high] > 1 and high - low > width:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) > k else (low, middle)
        if known[low] - known[high] == 1:
            pair = rayleigh_iteration(a, low, high, vectors)
            while pair is None and high - low > width:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) > k else (low, middle)
                pair = rayleigh_iteration(a, low, high, vectors)
            if pair is not None:
                values, vectors = np.r_[values, pair[0]], np.c_[vectors, pair[1]]
                continue
        m = known[low] - k
        some, plane = _plane(a, (low + high) / 2, m, vectors)
        values, vectors = np.r_[values, some], np.c_[vectors, plane]
    certify(a, values[:most], bound)
    return values[:most], vectors[:, :most]


def certify(a: np.ndarray, values: np.ndarray, bound: float) -> None:
    """Raise unless the k-th of the falling ``values`` has fewer than k eigenvalues above it and k or more not below it."""
    slack = 256 * len(a) * np.finfo(float).eps * bound
    for k, value in enumerate(values.tolist()):
        if count_above(a, value + slack) > k or count_above(a, value - slack) < k + 1:
            raise ArithmeticError(f"the {k + 1}-th eigenvalue is not certified by the counts")


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` different vectors with sums ``sums``; ``vectors`` has the components as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose entries are all there and finite, as whole numbers less ``OFFSET``, eight bytes each."""
    for batch in batches:
        column = batch.column("v").cast(pa.large_list(pa.float64()))
        offsets = column.offsets.to_numpy()
        flat = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
        offsets = offsets - offsets[0]
        bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
        sizes = np.diff(offsets)
        keep = (bad[offsets[1:]] == bad[offsets[:-1]]) & (sizes > 0) & ~np.asarray(column.is_null())
        with np.errstate(over="ignore"):
            scaled = np.floor(np.where(np.isfinite(flat), flat, 0) * SCALE)
        x = np.clip(scaled, float(LONG.min // 4), float(LONG.max // 4)).astype(np.int64)
        kept = np.flatnonzero(keep).tolist()
        data = [x[offsets[i] : offsets[i + 1]].tobytes() for i in kept]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(kept, pa.int64())), pa.array(sizes[kept].astype(np.int32)), pa.array(data, pa.binary())],
            names=["id", "width", "x"],
        )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def whole_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, width, x) of the usable rows."""
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_whole, f"id {kind}, width int, x binary")


def _sums(width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width, object), 0
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            low = x.astype(np.float64)
            safe = not len(x) or np.abs(low).max() * len(x) < 2.0**62
            total = total + (x.sum(axis=0) if safe else x.astype(object).sum(axis=0))
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(int(t)) for t in total]], pa.list_(pa.string()))], names=["n", "sums"])

    return add


def _products(mean: np.ndarray, matrix: np.ndarray):
    """Sums of products of centred vectors, turned by ``matrix`` if there is one, in rows of the result."""
    width = len(mean)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((matrix.shape[1], matrix.shape[1]))
        for batch in batches:
            y = (_matrix(batch.column("x"), width) - mean) @ matrix
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return add


def _moments(fit: DataFrame, mean: np.ndarray, matrix: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor ``n``) of the centred and turned vectors; entries are summed by place, so the driver gets one matrix."""
    parts = fit.select("x").mapInArrow(_products(mean, matrix), "i long, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((matrix.shape[1], matrix.shape[1]))
    for r in cells.collect():  # width times width cells
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


def fit_whitening(whole: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors of ``whole``; None without any.

    Vectors of one width are fitted: that of most rows (of equal counts the larger)."""
    widths = whole.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return None
    width = widths["width"]
    fit = materialise(whole.where(F.col("width") == width).select("x").distinct(), "fit-list")
    parts = fit.mapInArrow(_sums(width), "n long, sums array<string>")
    cells = parts.select("n", F.posexplode("sums").alias("j", "s")).groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(cells.collect())  # one row per entry of a vector
    n, sums = rows[0]["n"], tuple(int(r["s"]) for r in rows)
    mean = np.array([s / n for s in sums])
    covariance = _moments(fit, mean, np.eye(width), n)
    values, vectors = leading_eigenpairs(covariance, components)
    # one sign for every run: the largest loading is positive
    if len(values):
        largest = np.round(vectors, 9)[np.abs(np.round(vectors, 9)).argmax(axis=0), np.arange(len(values))]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    model = Whitening(n, sums, values, vectors, float(np.trace(covariance)))
    error = 0.0
    if len(values):
        error = float(np.abs(_moments(fit, mean, model.matrix, n) - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, model.trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over dimensions of (n x - S)², exact; what exceeds a long is the largest long."""
    away = np.abs(x.astype(np.float64) * n - np.array(sums, np.float64)).max(initial=0.0)
    if away * away * x.shape[1] < 2.0**61 and n * np.abs(x.astype(np.float64)).max(initial=0.0) < 2.0**62:
        d = x * np.int64(n) - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    return [min(sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)), LONG.max) for row in x.tolist()]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, n, deviation, whitened, values, trace, identity_error), one row per usable row of ``embeddings``.

    Rows whose vector is null, empty, holds null or non-finite entries, or has another width than most, are left out. Entries c become
    x = floor(64 c) + 1000000. ``whitened`` has one entry per component (at most ``components``, less where the covariance has
    fewer eigenvalues above zero, none if all vectors are equal), ``values`` their eigenvalues. ``deviation`` is the
    squared distance from the mean times n², exact, and the largest long where it exceeds that. The fit takes each different vector
    once; repeated rows and null ids are rows like others. The driver holds width times width numbers. Other
    columns are not read; without a usable row the result is empty.
    """
    small_batches(embeddings.sparkSession)
    whole = whole_vectors(embeddings, id_col, vector_col)
    kind = whole.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n long, deviation long, whitened array<double>, `values` array<double>, trace double, identity_error double"
    model = fit_whitening(whole, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    width, mean, matrix = len(model.sums), model.mean, model.matrix

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(_deviations(x, model.n, model.sums), pa.int64()),
                    pa.array(list((x - mean) @ matrix), pa.list_(pa.float64())),
                ],
                names=["id", "deviation", "whitened"],
            )

    same = whole.where(F.col("width") == width).select("id", "x")
    rows = same.mapInArrow(project, f"id {kind}, deviation long, whitened array<double>")
    values = F.array(*[F.lit(float(v)) for v in model.values]).cast("array<double>")
    return rows.select(
        F.col("id").alias(id_col),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        values.alias("values"),
        F.lit(model.trace).alias("trace"),
        F.lit(model.identity_error).alias("identity_error"),
    )
