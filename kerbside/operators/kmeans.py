"""Many K-means fits of the same weighted points in one go (for M2, M3, M5).

Fits start by k-means||. Of a few points Spark ML draws it, fit by fit, decoding
and keeping the points anew each time; of more, all fits draw in the same few
passes, by hashes of the points, so that neither the layout nor the cluster
decides. The iterations of all fits then share their passes: one narrow Spark job an iteration adds up, in
every task, the points nearest to each centre of each unfinished fit, and only
these sums reach the driver. So the points are held once, whatever the number
of fits, and are read once per iteration instead of once per iteration and fit.

Of many more points than a grid has filled cells, all are first summed up by cell,
and the starts are drawn and iterated on these sums, whose number is bounded.
All fits then iterate over all points from there, to the same end as ever, which
is a few passes away instead of some dozens.

Points are laid out along a Z-order curve. Neighbours whose bounding box lies
wholly on one centre's side go to that centre as one sum; other boxes are
opened, and points that no smaller box settles are compared one by one. The result is that of comparing
every point.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package: functions go to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOX_SIZES = (512, 32)  # points in a box, and in each box inside it
FAN_OUT = (16, 32, 1)
POINTS_PER_ROW = 131_072
ROWS_PER_PARTITION = 500_000
FEWEST_ROWS = 16_000  # of a partition, where there are fewer than SPREAD
SPREAD = 16
CURVE_BITS, CURVE_RANGE = 10, 4.0  # a dimension's cells, within this many standard deviations
CLEAR = 1e-9  # how far a box must lie on a centre's side, for rounding
SEPARATE_STARTS = 250_000  # up to so many points Spark ML draws the starts
START_STEPS = 2  # of k-means||, as in Spark ML
CELL_BITS = 21  # of a grid of at most 2 ** 21 cells
FEWEST_CELLS, CELL_SHARE = 1_000, 0.125  # filled cells to draw starts from: so many at least, and at most this share of the points
CELL_TOLERANCE = 0.01  # of the fits' tolerance, for iterations on the cells
SLICE = 16_384  # points compared at once


def as_array(df: DataFrame, col: str) -> Column:
    """A point's coordinates, from a vector or an array."""
    return F.col(col) if isinstance(df.schema[col].dataType, T.ArrayType) else vector_to_array(col)


@dataclass(frozen=True)
class Summary:
    """As of a Spark ML fit: the cost is that of the last assignment."""
    trainingCost: float
    numIter: int


@dataclass(frozen=True)
class Centres:
    """A fitted model: its centres, and the assignment of rows to the nearest
    (the first of equally near ones)."""
    centres: np.ndarray
    summary: Summary
    col: str
    prediction_col: str

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame) -> DataFrame:
        def distance(c) -> Column:
            return sum(((F.col("__x")[i] - F.lit(float(v))) * (F.col("__x")[i] - F.lit(float(v))) for i, v in enumerate(c)), F.lit(0.0))

        near = df.withColumn("__x", as_array(df, self.col)).withColumn("__d", F.array(*map(distance, self.centres)))
        nearest = (F.array_position("__d", F.array_min("__d")) - 1).cast("int")
        return near.withColumn(self.prediction_col, nearest).drop("__x", "__d")


def start(points: DataFrame, k: int, seed: int, col: str) -> np.ndarray:
    """The k starting centres (fewer if there are fewer distinct ones)."""
    # The row solver: choosing one would first take statistics of all points.
    return np.array(KMeans(k=k, seed=seed, maxIter=0, solver="row", featuresCol=col, weightCol="weight").fit(points).clusterCenters())


def _curve(dims: int, bits: int) -> Column:
    """A point's place on the Z-order curve of 2 ** bits cells a dimension."""
    cell = [F.floor((F.col(f"x{i}") + CURVE_RANGE) * (2 ** bits / (2 * CURVE_RANGE))) for i in range(dims)]
    cell = [F.least(F.greatest(c, F.lit(0)), F.lit(2 ** bits - 1)).cast("long") for c in cell]
    return sum((F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1)), dims * b + i) for i, c in enumerate(cell) for b in range(bits)),
               F.lit(0).cast("long"))


def _flat(points: DataFrame, col: str, dims: int) -> DataFrame:
    """Points as columns x0, x1, ... and weight."""
    rows = points.select(as_array(points, col).alias("x"), "weight")
    return rows.select(*(F.col("x")[i].alias(f"x{i}") for i in range(dims)), "weight")


def cells(points: DataFrame, col: str, dims: int) -> DataFrame:
    """All points summed up in the filled cells of a grid: the mean of a cell's
    rows (``col``) and their number (``weight``)."""
    rows = _flat(points, col, dims).withColumn("at", _curve(dims, CELL_BITS // dims))
    sums = rows.groupBy("at").agg(F.sum("weight").alias("weight"),
                                  *(F.sum(F.col("weight") * F.col(f"x{i}")).alias(f"x{i}") for i in range(dims)))
    return sums.select(F.array(*(F.col(f"x{i}") / F.col("weight") for i in range(dims))).alias(col), "weight")


def pack(points: DataFrame, col: str, dims: int, n: int) -> DataFrame:
    """The points (``col``, ``weight``) in the order of the curve, many to a
    row: coordinates and weight as bytes of doubles, and so their boxes."""
    names = [*(f"x{i}" for i in range(dims)), "weight"]
    rows = _flat(points, col, dims).withColumn("at", _curve(dims, min(CURVE_BITS, 62 // dims)))
    order = ["at", *names[:dims]]
    partitions = max(-(-n // ROWS_PER_PARTITION), min(SPREAD, -(-n // FEWEST_ROWS)), 1)

    def packed(batches):
        parts = [np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in names]) for b in batches]
        held, size = np.concatenate([np.empty((0, dims + 1)), *parts]), POINTS_PER_ROW
        for i in range(0, len(held), size):
            block = held[i:i + size]
            boxes = np.concatenate(_boxes(_filled_up(block)))
            yield pa.RecordBatch.from_pydict({"points": pa.array([block.tobytes()], pa.binary()), "boxes": pa.array([boxes.tobytes()], pa.binary())})

    return rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(packed, "points binary, boxes binary")


@dataclass(frozen=True)
class Held:
    """Packed points, kept for many passes."""
    packed: DataFrame
    n: int
    dims: int


@contextmanager
def hold(points: DataFrame, col: str) -> Iterator[Held]:
    """The points that weigh something, packed and kept while in use."""
    points = points.where("weight > 0")
    n, dims = points.agg(F.count(F.lit(1)), F.max(F.size(as_array(points, col)))).first()
    packed = pack(points, col, dims, n).persist()
    try:
        yield Held(packed, n, dims)
    finally:
        packed.unpersist()


def _filled_up(held: np.ndarray) -> np.ndarray:
    """The points, the last box filled up with copies that weigh nothing."""
    short = -len(held) % BOX_SIZES[0]
    return np.concatenate([held, np.repeat(held[-1:] * ([1.0] * (held.shape[1] - 1) + [0.0]), short, axis=0)]) if short else held


def _sums(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weight, weighted coordinates and weighted squared norm of each point."""
    w = w[:, None]
    return np.column_stack([w, w * x, w * (x * x).sum(axis=1, keepdims=True)])


def _boxes(held: np.ndarray) -> list[np.ndarray]:
    """Middle, half width and sums of the points in the boxes of each size."""
    dims, out = held.shape[1] - 1, []
    x, sums = held[:, :dims], _sums(held[:, :dims], held[:, dims])
    for size in BOX_SIZES:
        boxed = x.reshape(-1, size, dims)
        low, high = boxed.min(axis=1), boxed.max(axis=1)
        out.append(np.column_stack([(low + high) / 2, (high - low) / 2, sums.reshape(-1, size, dims + 2).sum(axis=1)]))
    return out


def add_nearest(totals: list[np.ndarray], held: np.ndarray, fits: Sequence[np.ndarray], boxes: np.ndarray | None = None) -> None:
    """Add to each fit's totals, centre by centre, the sums of weight, weighted
    coordinates and weighted squared norm of the points nearest to it. ``boxes``
    are those of the points, if the caller has them."""
    held, dims = _filled_up(held), held.shape[1] - 1
    levels = _boxes(held) if boxes is None else np.split(boxes, [len(held) // BOX_SIZES[0]])
    for total, c in zip(totals, fits):
        ids, offset = np.arange(len(c))[:, None], (c * c).sum(axis=1)[:, None] / 2
        apart, at = np.abs(c[:, None] - c[None]), None
        for level, inside in zip([*levels, None], FAN_OUT):
            if level is None:
                rows = held.take(at, axis=0)
                middle, half, sums = rows[:, :dims], None, _sums(rows[:, :dims], rows[:, dims])
            else:
                rows = level if at is None else level.take(at, axis=0)
                middle, half, sums = rows[:, :dims], rows[:, dims:2 * dims], rows[:, 2 * dims:]
            near = c @ middle.T - offset  # the nearest centre has the largest value
            best = near.argmax(axis=0)
            chosen = ids == best
            if half is not None:
                slack = near.max(axis=0) - near - CLEAR
                sure = np.ones(len(best), bool)
                for j, gaps in enumerate(apart):  # a box that lies across no border of its centre
                    mine = np.flatnonzero(best == j)
                    sure[mine] = ((slack[:, mine] > gaps @ half[mine].T) | (ids == j)).all(axis=0)
                chosen &= sure
                at = (np.flatnonzero(~sure) if at is None else at[~sure])[:, None] * inside + np.arange(inside)
                at = at.ravel()
            total += chosen.astype(float) @ sums


def nearest_sums(packed: DataFrame, fits: Sequence[np.ndarray]) -> list[np.ndarray]:
    """``add_nearest`` over all points: one narrow job, a row of sums a task."""
    dims = fits[0].shape[1]

    def added(batches):
        totals = [np.zeros((len(c), dims + 2)) for c in fits]
        for batch in batches:
            for points, boxes in zip(batch.column(0), batch.column(1)):
                add_nearest(totals, np.frombuffer(points.as_buffer()).reshape(-1, dims + 1), fits,
                            np.frombuffer(boxes.as_buffer()).reshape(-1, 3 * dims + 2))
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate(totals).tobytes()], pa.binary())})

    rows = packed.mapInArrow(added, "sums binary").collect()
    whole = sum(np.frombuffer(r["sums"]) for r in rows).reshape(-1, dims + 2)
    return np.split(whole, np.cumsum([len(c) for c in fits])[:-1])


def cost_of(centres: np.ndarray, sums: np.ndarray) -> float:
    """The weighted squared distances behind a fit's sums."""
    cross = 2 * (centres * sums[:, 1:-1]).sum(axis=1)
    return max(0.0, float((sums[:, -1] - cross + sums[:, 0] * (centres * centres).sum(axis=1)).sum()))


def _mixed(h: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(x: np.ndarray) -> np.ndarray:
    """One number per point; the last digits, which summing orders sway, are left out."""
    h = np.zeros(len(x), np.uint64)
    for i in range(x.shape[1]):
        h = _mixed(h + np.rint(x[:, i] * 2.0 ** 30).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h


def _uniform(hashes: np.ndarray, salt: Sequence[int]) -> np.ndarray:
    """A draw from (0, 1) per point, another one for each salt."""
    key = np.random.default_rng(list(salt)).integers(0, 2 ** 64, dtype=np.uint64)
    return ((_mixed(hashes + key) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53


def _drawn(packed: DataFrame, pick, dims: int) -> list[tuple[int, tuple[float, ...]]]:
    """What ``pick(x, weight, hashes)`` takes of the points, which gives pairs of a fit and rows."""
    def picked(batches):
        for batch in batches:
            for raw in batch.column(0):
                held = np.frombuffer(raw.as_buffer()).reshape(-1, dims + 1)
                x, w = held[:, :dims], held[:, dims]
                found = [(i, row) for i, rows in pick(x, w, _hashes(x)) for row in rows.tolist()]
                yield pa.RecordBatch.from_pydict({"fit": pa.array([i for i, _ in found], pa.int32()),
                                                  "row": pa.array([row for _, row in found], pa.list_(pa.float64()))})

    return [(r["fit"], tuple(r["row"])) for r in packed.select("points").mapInArrow(picked, "fit int, row array<double>").collect()]


def start_together(packed: DataFrame, grid: Sequence[tuple[int, int]], dims: int) -> list[np.ndarray]:
    """k-means|| for every (k, seed): a first centre by weight, two rounds that
    draw 2k points on average by weighted squared distance, and k-means++ on
    the candidates, weighed by the points nearest to them."""
    def first(x, w, hashes):  # the least of exponential draws at the rate of the weights
        for i, (k, seed) in enumerate(grid):
            late = -np.log(_uniform(hashes, (seed, k, 0))) / w
            at = late.argmin()
            yield i, np.append(late[at], x[at])[None]

    best = dict(sorted(_drawn(packed, first, dims), reverse=True))
    fits = [np.array([best[i][1:]]) for i in range(len(grid))]
    for step in range(1, START_STEPS + 1):
        costs = [cost_of(c, s) for c, s in zip(fits, nearest_sums(packed, fits))]
        shares = [2 * k / cost if cost else 0.0 for (k, _), cost in zip(grid, costs)]

        def far(x, w, hashes, fits=fits, shares=shares, step=step):
            low, high, heaviest = x.min(axis=0), x.max(axis=0), w.max()
            for i, ((k, seed), c) in enumerate(zip(grid, fits)):
                u = _uniform(hashes, (seed, k, step))
                # No point lies further from a centre than the corner of all points that is furthest from it.
                most = (np.maximum(np.abs(c - low), np.abs(high - c)) ** 2).sum(axis=1).min()
                maybe = np.flatnonzero(u < shares[i] * heaviest * most)
                d = ((x[maybe][:, None] - c[None]) ** 2).sum(axis=2).min(axis=1)
                yield i, x[maybe[u[maybe] < shares[i] * w[maybe] * d]]

        new = sorted(_drawn(packed, far, dims))
        fits = [np.array([*map(tuple, c), *(p for f, p in new if f == i)]) for i, c in enumerate(fits)]
    weights = [s[:, 0] for s in nearest_sums(packed, fits)]
    return [_of_candidates(c, w, k, seed) for (k, seed), c, w in zip(grid, fits, weights)]


def _of_candidates(c: np.ndarray, w: np.ndarray, k: int, seed: int, rounds: int = 30) -> np.ndarray:
    """k of the weighted candidates by k-means++, and a few iterations on them."""
    if len(c) <= k:
        return c
    rng = np.random.default_rng([seed, k])
    out = c[[rng.choice(len(c), p=w / w.sum())]]
    while len(out) < k:
        far = w * ((c[:, None] - out[None]) ** 2).sum(axis=2).min(axis=1)
        if not far.sum():
            break
        out = np.vstack([out, c[rng.choice(len(c), p=far / far.sum())]])
    for _ in range(rounds):
        label = ((c[:, None] - out[None]) ** 2).sum(axis=2).argmin(axis=1)
        mine = (label[:, None] == np.arange(len(out))).T * w
        weight = mine.sum(axis=1, keepdims=True)
        out = np.where(weight > 0, mine @ c / np.where(weight > 0, weight, 1.0), out)
    return out


def iterate(packed: DataFrame, grid: Sequence[tuple[int, int]], centres: Sequence[np.ndarray], max_iter: int,
            tolerance: float) -> tuple[list[np.ndarray], list[float], list[int]]:
    """Centres, costs and iterations of all fits, in shared passes. A fit ends
    as in Spark ML with a tolerance of (tolerance / k) ** 0.5: when no centre
    moved further."""
    centres, costs, iterations, active = list(centres), [0.0] * len(grid), [0] * len(grid), list(range(len(grid)))
    for _ in range(max_iter):
        if not active:
            break
        moving = []
        for i, sums in zip(active, nearest_sums(packed, [centres[i] for i in active])):
            old, weight = centres[i], sums[:, :1]
            costs[i] = cost_of(old, sums)
            centres[i] = np.where(weight > 0, sums[:, 1:-1] / np.where(weight > 0, weight, 1.0), old)
            iterations[i] += 1
            if (((centres[i] - old) ** 2).sum(axis=1) > tolerance / grid[i][0]).any():
                moving.append(i)
        active = moving
    return centres, costs, iterations


def _start_on_cells(points: DataFrame, grid: Sequence[tuple[int, int]], max_iter: int, tolerance: float, col: str,
                    n: int, dims: int) -> list[np.ndarray] | None:
    """Starts drawn from the cells and moved to where they rest on these; None
    where nearly all points are in a few cells, or far apart in many."""
    summed = cells(points, col, dims).persist()
    try:
        if not FEWEST_CELLS <= summed.count() <= CELL_SHARE * n:
            return None
        with hold(summed, col) as held:
            return iterate(held.packed, grid, start_together(held.packed, grid, dims), max_iter, CELL_TOLERANCE * tolerance)[0]
    finally:
        summed.unpersist()


def fit_all(points: DataFrame, grid: Sequence[tuple[int, int]], max_iter: int, tolerance: float, col: str,
            prediction_col: str, parallel: int, held: Held | None = None) -> list[Centres]:
    """One model for each (k, seed) of ``grid``, each iterated over all points
    to its end (``iterate``). ``held`` are the points, if the caller holds them."""
    points = points.where("weight > 0")
    with nullcontext(held) if held else hold(points, col) as held:
        if held.n > SEPARATE_STARTS:
            centres = _start_on_cells(points, grid, max_iter, tolerance, col, held.n, held.dims)
            if centres is None:
                centres = start_together(held.packed, grid, held.dims)
        else:
            draw = inheritable_thread_target(points.sparkSession)(lambda ks: start(points, ks[0], ks[1], col))
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                centres = list(pool.map(draw, grid))
        ended = iterate(held.packed, grid, centres, max_iter, tolerance)
    return [Centres(c, Summary(cost, n), col, prediction_col) for c, cost, n in zip(*ended)]


def row_scores(x: np.ndarray, mine: np.ndarray, weight: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Silhouettes of rows at the points ``x`` in the clusters ``mine`` (below
    0: in none, scores 0), from each cluster's rows, mean and mean squared norm."""
    far = np.maximum((x * x).sum(axis=1)[:, None] + spread - 2 * x @ mean.T, 0.0)
    rows, size = np.arange(len(x)), weight[mine]
    own = far[rows, mine] * size / np.maximum(size - 1, 1)
    far[rows, mine] = np.inf
    other = far.min(axis=1)
    widest = np.maximum(own, other)
    return np.where((mine < 0) | (size <= 1) | (widest == 0), 0.0, (other - own) / np.where(widest == 0, 1.0, widest))


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The first of the nearest centres, by the sums that ``Centres.transform`` compares."""
    d = np.zeros((len(c), len(x)))
    for i in range(x.shape[1]):
        apart = x[:, i] - c[:, i:i + 1]
        d += apart * apart
    return d.argmin(axis=0)


def silhouettes(packed: DataFrame, fits: Sequence[np.ndarray]) -> list[float | None]:
    """Each fit's mean silhouette of the rows behind the points, None where
    fewer than two clusters are filled: two passes, whatever the number of fits."""
    dims = fits[0].shape[1]

    def slices(batches):
        for batch in batches:
            for points in batch.column(0):
                whole = np.frombuffer(points.as_buffer()).reshape(-1, dims + 1)
                for at in range(0, len(whole), SLICE):
                    yield whole[at:at + SLICE, :dims], whole[at:at + SLICE, dims]

    def summed(batches):
        totals = [np.zeros((len(c), dims + 2)) for c in fits]
        for x, w in slices(batches):
            sums = _sums(x, w)
            for total, c in zip(totals, fits):
                total += (np.arange(len(c))[:, None] == nearest(x, c)).astype(float) @ sums
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate(totals).tobytes()], pa.binary())})

    def added(fn) -> np.ndarray:
        return sum(np.frombuffer(r["sums"]) for r in packed.select("points").mapInArrow(fn, "sums binary").collect())

    clusters, places = [], []
    for sums in np.split(added(summed).reshape(-1, dims + 2), np.cumsum([len(c) for c in fits])[:-1]):
        filled = sums[:, 0] > 0
        weight, total, norm = sums[filled, 0], sums[filled, 1:-1], sums[filled, -1]
        clusters.append((weight, total / weight[:, None], norm / weight))
        places.append(np.cumsum(filled) - 1)

    def scored(batches):
        out = np.zeros(len(fits) + 1)
        for x, w in slices(batches):
            out[-1] += w.sum()
            for i, (c, place, of) in enumerate(zip(fits, places, clusters)):
                if len(of[0]) > 1:
                    out[i] += w @ row_scores(x, place[nearest(x, c)], *of)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([out.tobytes()], pa.binary())})

    *scores, rows = added(scored)
    return [float(s / rows) if len(of[0]) > 1 else None for s, of in zip(scores, clusters)]
