"""Embedding whitening with components from FEAST contour integration.

Two passes over the vectors give their exact sums and the centred covariance,
each as partial sums per task. The covariance (d x d, whatever the rows) is cut
into intervals of few eigenvalues by inertia counts: the negative pivots of
``V - s I`` are the eigenvalues below s. Every interval is a task: a rational
filter, the quadrature of the resolvent over a circle around the interval, maps
random vectors to the span of its eigenvectors by complex shifted solves, and
Rayleigh-Ritz takes the pairs out of it. An interval is done when it holds as many
pairs as the inertia counts say. Another pass whitens the vectors and measures the
covariance of the outcome.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import ship_package

COMPONENTS = 32
#: x = floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
#: eigenvalues per interval, quadrature nodes on a half circle, refinements before the subspace grows
INTERVAL, NODES, ROUNDS = 12, 8, 12
#: eigenvalues below this share of the trace are zero: their components carry rounding alone
ZERO_SHARE = 1e-12
_SEED = 7
# entries of x are held in 64 bits; larger ones stand at the end of that range
_LARGEST = 1 << 61


# -- eigenpairs of one symmetric matrix


def negative_pivots(a: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix: the inertia of its L D L^T
    factorisation with 1 x 1 and 2 x 2 pivots (Bunch-Kaufman)."""
    a, k, negative = np.array(a, float), 0, 0
    bound = (1 + np.sqrt(17)) / 8
    while k < len(a):
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0)
        width = 1
        if abs(a[k, k]) < bound * largest:
            r = k + 1 + int(below.argmax())
            across = np.abs(a[r, k:])
            across[r - k] = 0
            if abs(a[k, k]) * across.max() < bound * largest**2:
                width = 1 if abs(a[r, r]) >= bound * across.max() else 2
                swap = k + width - 1
                a[[swap, r]] = a[[r, swap]]
                a[:, [swap, r]] = a[:, [r, swap]]
        pivot, rest = a[k : k + width, k : k + width], a[k + width :, k : k + width]
        negative += 1 if width == 2 else int(pivot[0, 0] < 0)  # a 2 x 2 pivot has one of each sign
        if width == 2 or pivot[0, 0] != 0:
            a[k + width :, k + width :] -= rest @ np.linalg.solve(pivot, rest.T)
        k += width
    return negative


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    return negative_pivots(shift * np.eye(len(v)) - v)


def intervals(v: np.ndarray, components: int = COMPONENTS, per_interval: int = INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between): disjoint intervals that together hold the
    largest ``components`` eigenvalues (more only where equal ones cannot be told apart)."""
    trace, top = float(np.trace(v)), float(np.abs(v).sum(axis=1).max(initial=0)) * 1.01
    floor = ZERO_SHARE * trace
    if not trace > 0:
        return []
    resolution = 1e-14 * top

    low, high, above = floor, top, eigenvalues_above(v, floor)  # ``low`` has at least the wanted count above it
    wanted = min(components, above)
    while above > wanted and high - low > resolution:
        middle = (low + high) / 2
        n = eigenvalues_above(v, middle)
        if n >= wanted:
            low, above = middle, n
        else:
            high = middle
    # (low, high, eigenvalues above low, eigenvalues above high)
    done, open_ = [], [(low, top, above, 0)]
    while open_:
        low, high, above, beyond = open_.pop()
        n = above - beyond
        if not n:
            continue
        # few eigenvalues, of one order of magnitude: the filter tells them from those outside
        if high - low <= resolution or (n <= per_interval and high <= 4 * low):
            done.append((low, high, n))
            continue
        middle = np.sqrt(low * high) if high > 4 * low else (low + high) / 2
        between = eigenvalues_above(v, middle)
        open_ += [(middle, high, between, beyond), (low, middle, above, between)]
    return done


def rational_filter(v: np.ndarray, low: float, high: float, y: np.ndarray, nodes: int = NODES) -> np.ndarray:
    """The contour integral of the resolvent around [low, high], applied to ``y``."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(y)
    for t, w in zip(points, weights):
        turn = np.exp(-0.5j * np.pi * (t - 1))  # the upper half circle; the lower one is its conjugate
        out += (w / 2 * radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, y)).real
    return out


def interval_pairs(v: np.ndarray, low: float, high: float, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``expected`` eigenpairs of [low, high], to rounding."""
    d = len(v)
    rng = np.random.default_rng(_SEED)
    size = min(d, expected + max(4, expected // 2))
    tolerance = 8 * np.finfo(float).eps * np.sqrt(d) * np.abs(v).sum(axis=1).max()
    # a circle around one point would have no radius
    centre, radius = (low + high) / 2, max((high - low) / 2, tolerance)
    low, high = centre - radius, centre + radius
    y = rng.standard_normal((d, size))
    while True:
        best, settled = np.inf, False
        for _ in range(ROUNDS):
            y = np.linalg.qr(rational_filter(v, low, high, y) if size < d else y)[0]
            values, turn = np.linalg.eigh(y.T @ v @ y)
            y = y @ turn
            # those furthest inside, as many as there are
            inside = np.argsort(np.abs(values - centre), kind="stable")[:expected]
            left = np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max()
            settled = left <= tolerance and np.all(np.abs(values[inside] - centre) <= radius + tolerance)
            if left > best / 2 or size == d:
                break  # as good as it gets
            best = left
        if settled or size == d:
            return values[inside], y[:, inside]
        # the filter does not part the pairs from their neighbours: take these in
        grown = min(d, 2 * size)
        y, size = np.hstack([y, rng.standard_normal((d, grown - size))]), grown


def _solve(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                v = np.frombuffer(row["v"], float).reshape(d, d)
                values, vectors = interval_pairs(v, row["low"], row["high"], row["n"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"])

    return run


def components_of(spark: SparkSession, v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of ``v``, falling, and their unit eigenvectors as
    columns: one task per interval, then Rayleigh-Ritz over all of them, which
    also settles vectors of neighbouring intervals against each other."""
    found = intervals(v, components)
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    rows = [(float(low), float(high), n, bytearray(v.tobytes())) for low, high, n in found]
    cuts = spark.createDataFrame(rows, "low double, high double, n int, v binary").repartition(len(rows))
    pairs = cuts.mapInArrow(_solve(len(v)), "value double, vector array<double>").toArrow()
    if len(pairs) != sum(n for _, _, n in found):
        raise ArithmeticError("the intervals hold other eigenvalues than their inertia counts")
    span = np.linalg.qr(np.array(pairs["vector"].to_pylist()).T)[0]
    values, turn = np.linalg.eigh(span.T @ v @ span)
    order = np.argsort(-values, kind="stable")[: min(components, len(values))]
    return values[order], (span @ turn)[:, order]


# -- vectors


def _numbers(column: pa.Array) -> np.ndarray:
    """x of a column of equally long vectors, one row each."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.clip(np.floor(c * SCALE), -_LARGEST, _LARGEST).astype(np.int64) + SHIFT


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` (array of double) of the rows that take part: vectors of finite
    entries, of the length that most of them have (ties: the shorter)."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull()).where(finite)
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (common["size"] if common else 0)).where(F.size("v") > 0)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and dimension: rows and the sum of x, in two halves that cannot overflow."""
    n, high, low = 0, 0, 0
    for b in batches:
        if b.num_rows:
            x = _numbers(b.column(1))
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
    if n:
        d = len(high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"]
        )


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of x per dimension."""
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    partial = rows.mapInArrow(_sums, "i int, n long, high long, low long")
    found = partial.groupBy("i").agg(whole("n"), whole("high"), whole("low")).orderBy("i").collect()
    return (int(found[0]["n"]) if found else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


class Centre:
    """x - S / n without rounding S / n first: it is split into whole and rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row the exact sum of (n x - S) ** 2."""
        near, rest = x - self.whole, [s % self.n for s in self.sums]
        # n x - S = n (x - whole) - rest
        reach = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if reach**2 * max(1, x.shape[1]) < 1 << 63:
            y = near * self.n - np.array(rest, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = near.astype(object) * self.n - np.array(rest, object)
        return (y * y).sum(axis=1).tolist()


def _products(outer, width: int):
    """Per task the sum over rows of z z^T, of z, and their number; ``outer`` gives z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for b in batches:
            if b.num_rows:
                z = outer(_numbers(b.column(1)))
                total += np.hstack([z.T @ z, z.sum(axis=0)[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"]
        )

    return run


def covariance(rows: DataFrame, outer, width: int, n: int) -> np.ndarray:
    """Covariance (divisor ``n``) of ``outer(x)``, which is centred already up to rounding."""
    cells = rows.mapInArrow(_products(outer, width), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "cell"))
    total = np.zeros((width, width + 1))
    found = cells.groupBy("i", "j").agg(F.sum("cell").alias("cell")).toArrow()
    total[found["i"].to_numpy(), found["j"].to_numpy()] = found["cell"].to_numpy()
    mean = total[:, width] / n
    out = total[:, :width] / n - np.outer(mean, mean)
    return (out + out.T) / 2


def _whiten(centre: Centre, project: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _numbers(b.column(1))
            deviation = centre.deviations(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([y if y < 1 << 63 else None for y in deviation], pa.int64()),
                 pa.array([Decimal(y) if y < 10**38 else None for y in deviation], pa.decimal128(38, 0)),
                 pa.array(list(centre(x) @ project), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "deviation_exact", "whitened"],
            )

    return run


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact``: one row per vector that takes part and component.

    Left out are null vectors and those with null or non-finite entries, then
    those of another length than most (ties: the shorter length stays). Rows that
    repeat an id or a vector count each, null ids stay null. Eigenvalues below
    ``ZERO_SHARE`` of the trace give no component: equal vectors, a single one, or
    an empty table give no rows. Entries beyond 2^55 stand at the end of that range.
    ``deviation`` is null where it does not fit a long; ``deviation_exact`` has it
    up to 38 digits. Other columns are not read. The driver holds the covariance,
    the square of the dimension, whatever the number of rows.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = vectors(df, id_col, vec_col)
    n, sums = exact_sums(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if not n:
        return spark.createDataFrame([], schema)
    centre = Centre(n, sums)
    v = covariance(rows, centre, len(sums), n)
    values, axes = components_of(spark, v, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    project = axes / np.sqrt(values)
    off = np.abs(covariance(rows, lambda x: centre(x) @ project, len(values), n) - np.eye(len(values))).max()
    share: Column = F.array(*(F.lit(float(e)) for e in values / np.trace(v)))
    found = rows.mapInArrow(_whiten(centre, project), "vec_id long, deviation long, deviation_exact decimal(38,0), whitened array<double>")
    found = found.select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("i", "whitened"))
    return found.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("i") + 1).alias("explained"), F.lit(float(off)).alias("identity_error"), "deviation_exact",
    )
