"""Whitening of embeddings by Jacobi-Davidson.

The leading eigenvectors of the covariance are found without ever forming it: the data are only seen
through centred products V·Q with a block of vectors Q, one distributed pass each, whose partial sums are
added up before they reach the driver. Ritz pairs of a small subspace give the current estimates;
each unconverged pair widens the subspace by the solution of its projected correction equation, solved by
a few steps of MINRES for all pairs at once. Converged leading pairs are locked and projected out,
until every residual is at the level of double precision. The driver holds arrays of dimensions
times subspace size, never rows.

Vectors are held in fixed point, as whole numbers x = floor(64 c) + 1000000 of each entry c, so that
sums and deviations are exact. Centring takes the whole part of the mean off first, as an integer.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import ship, spill

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
SUM_TASKS = 32  # tasks that add up the partial sums of all others
LARGEST = float(2**40)  # entries beyond count as not finite: their fixed point would not fit

Product = Callable[[np.ndarray], np.ndarray]


def fixed_point(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x) of the vectors that are whole and finite, as arrays of longs.

    Vectors that are null, or hold a null, a non-finite entry or one beyond ``LARGEST``, are dropped; so are
    those not of the commonest length (ties: the longer).
    """
    value = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.col(vector).isNotNull() & F.forall(
        F.col(vector),
        lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST), F.lit(False)),
    )
    kept = embeddings.filter(usable).select(
        F.col(key).alias("key"),
        F.transform(value, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"),
    )
    kept = spill(kept, "vectors")
    sizes = kept.groupBy(F.size("x").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return kept.filter(F.size("x") == (common["size"] if common else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch["x"]
    return column.flatten().to_numpy().reshape(len(column), -1)


def _summed(
    vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str
) -> np.ndarray:
    """The sum of ``part`` over all batches of vectors; an array of ``shape``."""
    size, dtype = int(np.prod(shape)), np.int64 if kind == "long" else np.float64
    sums = pa.schema([("slot", pa.int32()), ("sums", pa.list_(pa.from_numpy_dtype(dtype)))])

    def row(total: np.ndarray, slot: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"slot": slot, "sums": total.ravel()}], sums)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch))
        yield row(total, TaskContext.get().partitionId() % SUM_TASKS)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size, dtype), False
        for batch in batches:
            for sums in batch["sums"]:
                total += sums.values.to_numpy()
                some = True
        if some:
            yield row(total, 0)

    schema = f"slot int, sums array<{'bigint' if kind == 'long' else 'double'}>"
    parts = vectors.select("x").mapInArrow(partial, schema).repartition(SUM_TASKS, "slot")
    total = np.zeros(size, dtype)
    for found in parts.mapInArrow(added, schema).collect():  # at most one row per summing task
        total += np.array(found["sums"], dtype)
    return total.reshape(shape)


@dataclass(frozen=True)
class Centre:
    """Mean of n vectors: whole part and rest, from exact sums."""

    n: int
    sums: np.ndarray
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: np.ndarray) -> "Centre":
        return cls(n, sums, sums // n, (sums % n) / n)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def centre_of(vectors: DataFrame) -> Centre | None:
    """None if there are no vectors or no dimensions."""
    head = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    if not head["n"] or not head["d"]:
        return None
    sums = _summed(vectors, lambda x: x.sum(axis=0), (head["d"],), "long")
    return Centre.of(head["n"], sums)


def covariance_product(vectors: DataFrame, centre: Centre) -> Product:
    """Q to V·Q, one pass over the vectors; V is their covariance with divisor n."""

    def product(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centre.apply(x)
            return y.T @ (y @ q)

        return _summed(vectors, part, q.shape, "double") / centre.n

    return product


def minres(operator: Product, b: np.ndarray, steps: int) -> np.ndarray:
    """Solutions of ``operator(x) = b`` for each column of ``b``, all columns in step."""

    def ratio(above: np.ndarray, below: np.ndarray) -> np.ndarray:
        return np.divide(above, below, out=np.zeros_like(above), where=below > 0)

    dot = lambda u, v: np.einsum("ij,ij->j", u, v)
    x, r = np.zeros_like(b), b.copy()
    p, s = b, operator(b)
    before = None
    for step in range(steps):
        norm = dot(s, s)
        along = ratio(dot(r, s), norm)
        x, r = x + along * p, r - along * s
        if step == steps - 1:
            break
        new_p, new_s = s, operator(s)
        for old_p, old_s, old_norm in [(p, s, norm), *([before] if before else [])]:
            back = ratio(dot(new_s, old_s), old_norm)
            new_p, new_s = new_p - back * old_p, new_s - back * old_s
        before, p, s = (p, s, norm), new_p, new_s
    return x


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what columns of ``t`` add to the span of ``against``."""
    scale = np.linalg.norm(t, axis=0)
    t = t[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        t = t - against @ (against.T @ t)
    if not t.size:
        return t
    u, size, _ = np.linalg.svd(t, full_matrices=False)
    u = u[:, size > 1e-10]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0]


def jacobi_davidson(
    product: Product,
    dimensions: int,
    wanted: int,
    block: int = 24,
    inner: int = 6,
    tolerance: float = 1e-14,
    rounds: int = 200,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Residuals are brought below ``tolerance`` times the largest eigenvalue. Raises if that takes more
    than ``rounds`` rounds of widening.
    """
    wanted = min(wanted, dimensions)
    start, most = min(dimensions, wanted + 8), min(dimensions, 2 * wanted + 3 * block)
    u = np.linalg.qr(np.random.default_rng(0).standard_normal((dimensions, start)))[0]
    au = product(u)
    locked, a_locked = np.zeros((dimensions, 0)), np.zeros((dimensions, 0))
    for _ in range(rounds):
        h = u.T @ au
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        u, au = u @ turn, au @ turn
        residual = au - u * values
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        largest = np.linalg.norm(a_locked, axis=0).max(initial=abs(values[0]) if values.size else 0.0)
        good = norms <= tolerance * max(largest, np.finfo(float).tiny)
        lead = int(np.argmin(good)) if not good.all() else len(good)
        locked, a_locked = np.hstack([locked, u[:, :lead]]), np.hstack([a_locked, au[:, :lead]])
        u, au, values, residual = u[:, lead:], au[:, lead:], values[lead:], residual[:, lead:]
        left = wanted - locked.shape[1]
        if left <= 0 or not u.shape[1]:
            break
        aim = min(left, block, u.shape[1])
        if u.shape[1] + aim > most:
            keep = min(u.shape[1], left + 8)
            u, au = u[:, :keep], au[:, :keep]
        fixed, shift = np.hstack([locked, u[:, :aim]]), values[:aim]

        def correction(t: np.ndarray, fixed: np.ndarray = fixed, shift: np.ndarray = shift) -> np.ndarray:
            t = t - fixed @ (fixed.T @ t)
            t = product(t) - shift * t
            return t - fixed @ (fixed.T @ t)

        wide = _orthonormal(minres(correction, -residual[:, :aim], inner), np.hstack([locked, u]))
        if not wide.shape[1]:  # the subspace is everything there is
            locked, a_locked = np.hstack([locked, u]), np.hstack([a_locked, au])
            break
        u, au = np.hstack([u, wide]), np.hstack([au, product(wide)])
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} eigenvectors not found in {rounds} rounds")
    basis = np.linalg.qr(locked)[0]
    h = basis.T @ product(basis)
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, vectors = values[::-1][:wanted], (basis @ turn)[:, ::-1][:, :wanted]
    return values, vectors / np.linalg.norm(vectors, axis=0)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: mean, eigenvalues and eigenvectors, total variance and how far the
    covariance of the whitened vectors is from the identity. Eigenvalues at rounding level are 0."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; not a number for components without variance."""
        spread = np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return self.centre.apply(x) @ self.vectors / spread


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors (x); None if there are none."""
    ship(vectors.sparkSession)
    centre = centre_of(vectors)
    if centre is None:
        return None
    d = len(centre.sums)
    values, basis = jacobi_davidson(covariance_product(vectors, centre), d, components)
    noise = d * np.finfo(float).eps * max(values[0], 0.0)
    values = np.where(values > noise, values, 0.0)
    k = len(values)
    first = Whitening(centre, values, basis, 0.0, None)

    def part(x: np.ndarray) -> np.ndarray:
        w, y = np.nan_to_num(first.apply(x)), centre.apply(x)
        return np.append((w.T @ w).ravel(), (y * y).sum())

    sums = _summed(vectors, part, (k * k + 1,), "double") / centre.n
    real = values > 0
    off = np.abs(sums[:-1].reshape(k, k) - np.eye(k))[np.ix_(real, real)]
    return Whitening(centre, values, basis, float(sums[-1]), float(off.max()) if real.any() else None)


def _deviations(x: np.ndarray, centre: Centre) -> pa.Array:
    """Sums of (n x - S)² as longs; null where a long is too short."""
    widest = int(np.abs(x - centre.whole).max(initial=0)) + 1
    if len(centre.sums) * (centre.n * widest) ** 2 < 1 << 63:
        gap = centre.n * (x - centre.whole) - centre.sums % centre.n
        return pa.array((gap * gap).sum(axis=1))
    sums = [int(s) for s in centre.sums]
    exact = [sum((centre.n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, fitted: Whitening | None) -> DataFrame:
    """Vectors (key, x) to (key, n, deviation, whitened array); the array has a null for a component
    without variance. No rows where nothing was fitted."""
    kind = vectors.schema["key"].dataType
    shape = f"key {kind.simpleString()}, n long, deviation long, whitened array<double>"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], shape)
    k = len(fitted.values)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            flat = pa.array(fitted.apply(x).ravel(), from_pandas=True)
            whitened = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, flat)
            n = pa.array(np.full(len(x), fitted.centre.n))
            columns = [batch["key"], n, _deviations(x, fitted.centre), whitened]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "deviation", "whitened"])

    return vectors.mapInArrow(rows, shape)


def by_component(whitened: DataFrame, fitted: Whitening | None) -> DataFrame:
    """One row per vector and component, numbered from 1 by falling variance."""
    values = [] if fitted is None else [float(v) for v in fitted.values]
    trace = 0.0 if fitted is None else fitted.trace
    shares = F.array(*[F.lit(v / trace if trace > 0 else None).cast("double") for v in values])
    shares = shares if values else F.array().cast("array<double>")
    long = whitened.select("key", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "key",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(None if fitted is None else fitted.identity_error).cast("double").alias("identity_error"),
    )


def whitened_embeddings(
    embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Whitened components of ``embeddings`` (key, vector), one row each.

    Rows that ``fixed_point`` drops have none; copies count as often as they occur and get equal
    components. Where eigenvalues tie, any orthonormal basis of their space is right. A component
    without variance has a null for its value. An empty table gives no rows; other columns are not read.
    """
    vectors = fixed_point(embeddings, key, vector)
    fitted = fit(vectors, components)
    return by_component(whiten(vectors, fitted), fitted).withColumnRenamed("key", key)
