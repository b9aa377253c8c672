"""Embedding whitening: spectra grown by rank-one updates, combined, refined and applied."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import kind_of, stored
from marketbars.session import work_dir

COMPONENTS = 4
# Distinct vectors that a task works into one spectrum, and the most tasks.
VECTORS, TASKS = 4096, 10_000
# Spectra combined by one task.
FAN = 16
EPS = float(np.finfo(float).eps)
LONGEST = (1 << 63) - 1


# --- the spectrum of a matrix plus an outer product --------------------------------------


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(squares / (poles - x)), one behind each pole; poles rise strictly.

    Returns the roots and the matrix of their distances: root i less pole j. Each root is
    sought as a distance from the nearer pole, so that small distances are exact. Steps go to the
    root of a rational function with the same value and slope on either side, else to the middle.
    """
    k = len(poles)
    at = np.arange(k)
    after = np.append(poles[1:], poles[-1] + squares.sum())
    gap = after - poles
    middle = poles + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        falls = 1 + (squares / (poles - middle[:, None])).sum(axis=1) <= 0
    falls[-1] = False
    origin = np.where(falls, after, poles)
    shifted = poles - origin[:, None]
    low = np.where(falls, -gap / 2, 0.0)
    high = np.where(falls, 0.0, gap / 2)
    high[-1] = gap[-1]
    before = shifted[at, at]
    behind = np.append(shifted[at[:-1], at[1:]], np.inf)
    left = at[None, :] <= at[:, None]
    x = (low + high) / 2
    for _ in range(100):
        distance = shifted - x[:, None]
        with np.errstate(all="ignore"):
            terms = squares / distance
            slopes = terms / distance
            psi, psi_slope = (terms * left).sum(axis=1), (slopes * left).sum(axis=1)
            phi, phi_slope = terms.sum(axis=1) - psi, slopes.sum(axis=1) - psi_slope
            value = 1 + psi + phi
            low, high = np.where(value < 0, x, low), np.where(value > 0, x, high)
            near, far = before - x, behind - x
            far = np.where(np.isinf(far), 0.0, far)
            c = value - psi_slope * near - phi_slope * far
            # The step y solves c * y * y - b * y + e = 0.
            b = value * (near + far) - near * far * (psi_slope + phi_slope)
            e = value * near * far
            root = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
            step = np.where(b > 0, 2 * e / (b + root), (b - root) / (2 * c))
            step[-1] = near[-1] + psi_slope[-1] * near[-1] ** 2 / c[-1]
            new = x + step
            good = (new > low) & (new < high)
            new = np.where(good, new, (low + high) / 2)
        done = np.abs(value) <= 16 * EPS * (1 + np.abs(psi) + np.abs(phi))
        if (done | (np.abs(new - x) <= 2 * EPS * np.abs(new))).all():
            break
        x = np.where(done, x, new)
    return origin + x, x[:, None] - shifted


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray):
    """Spectrum of vectors * diag(values) * vectors' + u * u'; values rise.

    Deflation: directions that ``u`` does not touch stay as they are, and of directions with equal
    values all but one are turned away from it. The others' values are roots of the secular
    equation; the vectors come from the coefficients for which these roots are exact.
    """
    z = vectors.T @ u
    norm = float(np.sqrt(z @ z))
    bound = 4 * EPS * max(abs(float(values[-1])), abs(float(values[0])), norm * norm)
    if norm * norm <= bound * EPS:
        return values, vectors
    vectors = vectors.copy()
    heads = np.flatnonzero(np.diff(values) > bound) + 1
    if len(heads) + 1 < len(values):
        for begin, end in zip([0, *heads], [*heads, len(values)], strict=True):
            if end - begin > 1:
                mirror = z[begin:end].copy()
                length = np.copysign(np.sqrt(mirror @ mirror), mirror[-1])
                mirror[-1] += length
                square = mirror @ mirror
                if square > 0:
                    block = vectors[:, begin:end]
                    vectors[:, begin:end] = block - np.outer(block @ mirror, 2 / square * mirror)
                    z[begin:end] = 0
                    z[end - 1] = -length
    touched = np.flatnonzero(np.abs(z) * norm > bound)
    if not len(touched):
        return values, vectors
    poles, z = values[touched], z[touched]
    k = len(poles)
    roots, distance = secular_roots(poles, z * z)
    i, j = np.arange(k)[:, None], np.arange(k)[None, :]
    beside = np.where(i < j, i, np.minimum(i + 1, k - 1))
    divisor = np.where(i == k - 1, 1.0, poles[beside] - poles)
    exact = np.copysign(np.sqrt(np.abs((distance / divisor).prod(axis=0))), z)
    turned = -exact[:, None] / distance.T
    turned /= np.sqrt((turned * turned).sum(axis=0))
    values = values.copy()
    values[touched] = roots
    vectors[:, touched] = vectors[:, touched] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Eigenvalues and vectors of the sum of squares about the mean of ``n`` vectors."""

    dim: int
    n: int = 0
    mean: np.ndarray = field(init=False)
    values: np.ndarray = field(init=False)
    vectors: np.ndarray = field(init=False)

    def __post_init__(self):
        self.mean, self.values = np.zeros((2, self.dim))
        self.vectors = np.eye(self.dim)

    def add(self, x: np.ndarray) -> None:
        apart = x - self.mean
        self.n += 1
        if self.n > 1:
            u = apart * np.sqrt((self.n - 1) / self.n)
            self.values, self.vectors = rank_one(self.values, self.vectors, u)
        self.mean = self.mean + apart / self.n

    def join(self, other: Spectrum) -> None:
        """As if the other's vectors had been added: one update per direction and the means'."""
        if not other.n:
            return
        apart, n = other.mean - self.mean, self.n + other.n
        steps = np.sqrt(np.maximum(other.values, 0)) * other.vectors
        for u in [*steps.T[other.values > 0], apart * np.sqrt(self.n * other.n / n)]:
            self.values, self.vectors = rank_one(self.values, self.vectors, u)
        self.mean = self.mean + apart * (other.n / n)
        self.n = n

    def row(self, part: int, sums: list[int]) -> dict:
        packed = (np.ascontiguousarray(x, "<f8").tobytes() for x in (self.mean, self.values))
        mean, values = packed
        vectors = np.ascontiguousarray(self.vectors, "<f8").tobytes()
        sums = [str(s) for s in sums]
        return dict(part=part, n=self.n, sums=sums, mean=mean, values=values, vectors=vectors)

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        mean, values, vectors = (
            np.frombuffer(row[c], "<f8").copy() for c in ("mean", "values", "vectors")
        )
        found = cls(len(mean), row["n"])
        found.mean, found.values = mean, values
        found.vectors = vectors.reshape(len(mean), len(mean))
        return found


# --- over the whole table ----------------------------------------------------------------

SPECTRA = pa.schema(
    [
        ("part", pa.int64()),
        ("n", pa.int64()),
        ("sums", pa.list_(pa.string())),
        ("mean", pa.binary()),
        ("values", pa.binary()),
        ("vectors", pa.binary()),
    ]
)
SPECTRA_SQL = (
    "part bigint, n bigint, sums array<string>, mean binary, values binary, vectors binary"
)
SQUARES = pa.schema([("part", pa.int64()), ("squares", pa.binary())])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of equal length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def column_sums(x: np.ndarray) -> list[int]:
    """Exact sums of 64-bit integers."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(h << 32) + low for h, low in zip(high.tolist(), low.tolist(), strict=True)]


def spectra(fit: DataFrame, dim: int) -> DataFrame:
    """The spectrum of every partition of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, sums = Spectrum(dim), [0] * dim
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            sums = [a + b for a, b in zip(sums, column_sums(x), strict=True)]
            for vector in x.astype(float):
                held.add(vector)
        if held.n:
            row = held.row(TaskContext.get().partitionId(), sums)
            yield pa.RecordBatch.from_pylist([row], SPECTRA)

    return fit.select("x").mapInArrow(run, SPECTRA_SQL)


def joined(rows: list[dict]) -> dict:
    first, *rest = rows
    held, sums = Spectrum.of(first), [int(s) for s in first["sums"]]
    for row in rest:
        held.join(Spectrum.of(row))
        sums = [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
    return held.row(0, sums)


def added(rows: list[dict]) -> dict:
    total = sum(np.frombuffer(r["squares"], "<f8") for r in rows)
    return dict(part=0, squares=total.tobytes())


def gathered(
    rows: DataFrame, schema: pa.Schema, combine: Callable[[list[dict]], dict], folder: str, fan: int
) -> dict:
    """One row made of all: tasks combine ``fan`` of them, then of what these made, and so on."""
    rows = stored(rows, f"{folder}/0")
    held, level = rows.count(), 0
    while held > 1:
        groups, level = -(-held // fan), level + 1

        def one(group: pa.Table) -> pa.Table:
            found = sorted(group.to_pylist(), key=lambda r: r["part"])
            made = combine(found) | {"part": found[0]["slot"]}
            return pa.Table.from_pylist([made], schema)

        slots = rows.withColumn("slot", F.pmod("part", F.lit(groups)))
        slots = slots.repartition(groups, "slot").groupBy("slot").applyInArrow(one, rows.schema)
        rows = stored(slots, f"{folder}/{level}")
        held = rows.count()
    return rows.first().asDict()


def squares(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> DataFrame:
    """Per partition the products of centred vectors' coordinates in ``basis``, summed."""

    def run(batches: Iterator[pa.RecordBatch]):
        total, seen = np.zeros((basis.shape[1],) * 2), False
        for batch in batches:
            y = (matrix(batch.column("x"), len(mean)) - mean) @ basis
            total += y.T @ y
            seen = True
        if seen:
            row = dict(part=TaskContext.get().partitionId(), squares=total.tobytes())
            yield pa.RecordBatch.from_pylist([row], SQUARES)

    return fit.select("x").mapInArrow(run, "part bigint, squares binary")


@dataclass(frozen=True)
class Whitening:
    """What a fit found. ``vectors`` has the components as columns, by falling value."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def integers(embedding: Column, scale: int) -> Column:
    """floor(scale * entry) of every entry as a double; beyond a long the nearest long."""
    return F.transform(embedding, lambda v: F.floor(v.cast("double") * scale))


def usable(embedding: Column) -> Column:
    def finite(v):
        v = v.cast("double")
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))

    return embedding.isNotNull() & F.forall(embedding, finite)


def fit_whitening(
    fit: DataFrame, dim: int, folder: str, components: int = COMPONENTS,
    vectors: int = VECTORS, fan: int = FAN,
) -> Whitening | None:
    """Components of the rows of ``fit`` (x: array of longs, each once); None without variance.

    Each task works its vectors into a spectrum; spectra are combined ``fan`` at a time. The
    final basis spans the whole space, so one pass of Rayleigh-Ritz (the covariance in that basis,
    summed over all tasks, is diagonalised) leaves rounding errors only, whatever the updates lost.
    """
    tasks = max(1, min(TASKS, -(-fit.count() // vectors)))
    dealt = fit.repartition(tasks, "x")
    row = gathered(spectra(dealt, dim), SPECTRA, joined, f"{folder}/spectra", fan)
    sums, n = [int(s) for s in row["sums"]], row["n"]
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(Spectrum.of(row).vectors)[0]
    found = gathered(squares(fit, mean, basis), SQUARES, added, f"{folder}/ritz", fan)
    covariance = np.frombuffer(found["squares"], "<f8").reshape(dim, dim) / n
    values, turned = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 16 * dim * EPS * values[-1]]
    if not len(order):
        return None
    chosen = basis @ turned[:, order]
    chosen /= np.sqrt((chosen * chosen).sum(axis=0))
    # Either sign would do: the largest entry is positive.
    chosen *= np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(order))])
    whole = Whitening(n, sums, values[order], chosen, float(np.trace(covariance)), 0.0)
    found = gathered(squares(fit, mean, whole.scaled), SQUARES, added, f"{folder}/white", fan)
    white = np.frombuffer(found["squares"], "<f8").reshape(len(order), -1) / n
    error = float(np.abs(white - np.eye(len(order))).max())
    return Whitening(n, sums, values[order], chosen, whole.trace, error)


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sums of (n * x - sum) squared, exact; None where one exceeds a long."""
    # Right modulo 2 ** 64 whatever overflows in between.
    sums = np.array([s % (1 << 64) for s in model.sums], np.uint64)
    apart = x.view(np.uint64) * np.uint64(model.n) - sums
    found = (apart * apart).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
    about = ((x - model.mean) ** 2).sum(axis=1) * float(model.n) ** 2
    for row in np.flatnonzero(about > 0.999 * LONGEST).tolist():
        exact = sum(
            (model.n * v - s) ** 2 for v, s in zip(x[row].tolist(), model.sums, strict=True)
        )
        found[row] = exact if exact <= LONGEST else None
    return found


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    scale: int = 256,
    vectors: int = VECTORS,
    fan: int = FAN,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every vector.

    Rows whose vector is null or holds a null or non-finite entry are left out. The others become
    whole numbers, floor(``scale`` * entry), saturated to 64 bits. Components are fitted on each
    distinct vector once, ``n`` in all; a row is returned for every vector and component, up to
    ``components``. ``deviation`` is exact, null where it exceeds a long. ``identity_error`` is
    measured on the fit list.

    Vectors must have one length: of several lengths the most frequent counts (of equally frequent
    ones the longest), and rows of other lengths are left out. Components without variance (fewer
    distinct vectors than dimensions, constant entries) do not exist: with one distinct vector
    there is no row. Components of equal variance are any basis of their space. Repeated rows and
    null vec_ids are kept. An empty table gives no rows; other columns are not read.
    """
    folder = work_dir(embeddings.sparkSession, "whitening")
    kind = kind_of(embeddings, "vec_id")
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    rows = embeddings.filter(usable(F.col("embedding"))).select(
        "vec_id", integers(F.col("embedding"), scale).alias("x")
    )
    lengths = rows.groupBy(F.size("x").alias("dim")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    model = None
    if common is not None and common.dim:
        rows = rows.filter(F.size("x") == common.dim)
        fit = stored(rows.select("x").distinct(), f"{folder}/fit")
        model = fit_whitening(fit, common.dim, folder, components, vectors, fan)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]):
        k = len(model.values)
        shares = model.values / model.trace
        for batch in batches:
            x = matrix(batch.column("x"), len(model.sums))
            white = (x - model.mean) @ model.scaled
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pa.array(deviations(x, model), pa.int64()).take(pa.array(each)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                [f.split()[0] for f in schema.split(", ")],
            )

    return rows.mapInArrow(run, schema)
