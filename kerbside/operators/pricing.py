"""Price model with per-row attributions (M6-M9).

* M6: a split by the md5 of the row's key, so a row's side does not depend on
  partitioning and any engine can repeat it.
* M7: gradient-boosted trees (squared loss, 100 trees, depth 6, step 0.3) by
  histogram: each feature is cut into at most ``BINS`` bins, a missing value
  having one of its own below the others, and rows are aggregated to cells
  (combinations of bins) with their count and mean label. A squared-loss split
  depends on counts and sums only, so trees grown on the weighted cells are
  those of the rows, and the hundreds of passes of a fit read a table that the
  bins bound, however many rows there are. Only a missing label keeps a row out
  of fitting and scoring.
* M8: MAE and R^2 from one aggregate pass over the test predictions.
* M9: exact Shapley values of the features. By default a coalition's value is
  the trees' expectation when only the coalition's features are known: at a
  split on another feature both branches count, in proportion to the training
  rows that went there. With background points it is the model's weighted mean
  prediction with the other features from each point. The model is constant in
  each cell, so the values of all cells are computed once from the tree nodes;
  a row's are looked up by a join with that table, whose size the bins bound.
  Contributions + base value = prediction for every row, labelled or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import factorial, prod

import numpy as np
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kerbside.session import scratch_path, shared_dir

# Model features, label, split share and seed, and the boosted
# tree settings.
FEATURES = ("vehicle_age", "mileage", "engine_size", "is_ulez_compliant")
LABEL = "price"
TRAIN_SHARE = 80
SEED = 42
TREES = 100
DEPTH = 6
STEP = 0.3
# Fill for a missing feature; the features are ages, distances, litres and a flag.
MISSING = -1.0e6
# Bins of a feature, the one of missing values included.
BINS = 32
# Cells of one attribution table; trees are split into groups within it.
MAX_CELLS = 1 << 18
# Training partitions: one per 50,000 cells up to the task slots, then one per
# 2,000,000 cells; each tree level is a job, so small inputs want few tasks.
SMALL_PARTITION_ROWS = 50_000
ROWS_PER_PARTITION = 2_000_000


def split_train_test(df: DataFrame, train_share: int = TRAIN_SHARE, seed: int = SEED,
                     key: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """M6: the first 32 bits of md5(seed|key...) modulo 100 < share -> train,
    else test. Without ``key`` all columns form the key (equal rows go to one
    side); NULL counts as an empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key or df.columns)]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    tagged = df.withColumn("__bucket", bucket)
    return (tagged.filter(F.col("__bucket") < train_share).drop("__bucket"),
            tagged.filter(F.col("__bucket") >= train_share).drop("__bucket"))


def model_input(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    """All rows, with the features as doubles (missing ones, NULL or NaN,
    filled) and the label, which may be NULL."""
    cols = {f"__x_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(MISSING)), F.lit(MISSING)) for c in features}
    return df.withColumns(cols).withColumn("__label", F.col(label).cast("double"))


def labelled_input(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    return model_input(df, features, label).dropna(subset=["__label"])


@dataclass
class PriceModel:
    """Boosted trees over bin numbers, and the cuts between the bins."""
    trees: GBTRegressionModel
    cuts: list[list[float]]
    features: tuple[str, ...]

    def binned(self, df: DataFrame) -> DataFrame:
        return _binned(df, self.features, self.cuts)

    def nodes(self) -> list[list[Row]]:
        """Per tree its nodes, by id. A model is saved as one row per node;
        their number is bounded by trees and depth."""
        spark = SparkSession.getActiveSession()
        path = scratch_path(spark, "trees")
        self.trees.write().save(path)
        out: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
            out.setdefault(r.treeID, []).append(r)
        return [sorted(out[t], key=lambda n: n.id) for t in sorted(out)]


def feature_cuts(labelled: DataFrame, features: Sequence[str] = FEATURES, bins: int = BINS) -> list[list[float]]:
    """Per feature the ascending cuts of its bins, the missing value's first.
    One pass over all rows with bounded sketches: all values of a feature with
    few of them, else values at equal shares of the rows."""
    fine = [k / 1000 for k in range(1001)]
    known = [F.when(F.col(f"__x_{c}") > MISSING / 2, F.col(f"__x_{c}")) for c in features]
    row = labelled.agg(*(F.percentile_approx(c, fine, 10000).alias(f"c{i}") for i, c in enumerate(known))).first()
    cuts = []
    for i in range(len(features)):
        found = list(row[i] or [])
        values = sorted(set(found))
        if len(values) >= bins:
            values = sorted({found[round(k * 1000 / (bins - 1))] for k in range(bins)})
        # a bin starts at each value but the least, whose bin is open below
        cuts.append([-float("inf"), MISSING / 2, *(float(v) for v in values[1:bins - 1]), float("inf")])
    return cuts


def _binned(df: DataFrame, features: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    """Add ``__b_<feature>``, the number of the feature's bin as a double. The
    sum drops the column's nominal attribute: bins are in order."""
    out = Bucketizer(splitsArray=cuts, inputCols=[f"__x_{c}" for c in features],
                     outputCols=[f"__b_{c}" for c in features]).transform(df)
    return out.withColumns({f"__b_{c}": F.col(f"__b_{c}") + 0.0 for c in features})


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"__b_{c}" for c in features], outputCol="features")


def training_cells(train: DataFrame, cuts: list[list[float]], features: Sequence[str] = FEATURES,
                   label: str = LABEL) -> DataFrame:
    """Cells of the labelled rows: bins, ``__n`` rows and their mean ``__label``.
    Aggregated map-side first, so a very common cell is one row per task."""
    names = [f"__b_{c}" for c in features]
    rows = _binned(labelled_input(train, features, label), features, cuts)
    return rows.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("__n"), F.avg("__label").alias("__label"))


def train_price_model(train: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL,
                      trees: int = TREES, depth: int = DEPTH, step: float = STEP,
                      seed: int = SEED, bins: int = BINS) -> PriceModel:
    """M7: two passes over the rows (cuts, cells); the iterative fit reads the
    cells, which are cached, in partitions that follow their number."""
    cuts = feature_cuts(labelled_input(train, features, label), features, bins)
    names = [f"__b_{c}" for c in features]
    cells = training_cells(train, cuts, features, label).persist()
    slots, n = cells.sparkSession.sparkContext.defaultParallelism, cells.count()
    parts = max(1, min(slots, -(-n // SMALL_PARTITION_ROWS)), -(-n // ROWS_PER_PARTITION))
    # Few cells are gathered from the cache without another shuffle; their keys are unique, so the sort fixes the order.
    dealt = cells.coalesce(1) if parts == 1 else cells.repartition(parts, *names)
    data = _assembler(features).transform(dealt.sortWithinPartitions(*names))
    data = data.select("features", "__label", "__n").persist()
    # Boosting state is checkpointed to the shared folder every 10 trees, so a
    # lost executor costs at most 10 trees of lineage, not the whole run.
    shared_dir(data.sparkSession)
    gbt = GBTRegressor(featuresCol="features", labelCol="__label", weightCol="__n", maxIter=trees, maxDepth=depth,
                       maxBins=max(bins, 2), stepSize=step, lossType="squared", seed=seed, checkpointInterval=10)
    try:
        return PriceModel(gbt.fit(data), cuts, tuple(features))
    finally:
        data.unpersist()
        cells.unpersist()


def predict(model: PriceModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    binned = model.binned(model_input(df, model.features, label))
    return model.trees.transform(_assembler(model.features).transform(binned))


def score_regression(predictions: DataFrame, label: str = "__label", prediction: str = "prediction") -> DataFrame:
    """M8: one row (n, mae, r2) from a single aggregate pass."""
    y, p = F.col(label), F.col(prediction)
    agg = predictions.agg(F.count(y).alias("n"), F.avg(F.abs(y - p)).alias("mae"),
                          F.sum((y - p) * (y - p)).alias("ss_res"), F.var_pop(y).alias("var_y"))
    return agg.select("n", "mae", (F.lit(1.0) - F.col("ss_res") / F.nullif(F.col("var_y") * F.col("n"), F.lit(0.0)))
                      .alias("r2"))


def weighted_background(train: DataFrame, n: int, features: Sequence[str] = FEATURES, label: str = LABEL,
                        seed: int = SEED) -> list[tuple[list[float], float]]:
    """Background sample for M9: up to ``n`` distinct training points, each with
    its weight. The commonest n // 2 points stand for their own rows; the other
    points are picked by hash order and share the rows of all the rest in
    proportion to their own. Bounded top-n, stable across runs and
    partitionings; copies of a row are one point."""
    names = [f"__x_{c}" for c in features]
    points = labelled_input(train, features, label).groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).persist()
    try:
        key = F.xxhash64(F.lit(seed), *names)
        rows = points.agg(F.sum("__n")).first()[0] or 0
        common = points.orderBy(F.desc("__n"), key, *names).limit(n // 2).collect()
        held = {tuple(r[c] for c in names) for r in common}
        # the common points may be among the smallest hashes: at most n // 2 of n + n // 2
        rest = [r for r in points.orderBy(key, *names).limit(n + n // 2).collect() if tuple(r[c] for c in names) not in held]
        rest = rest[:n - len(common)]
    finally:
        points.unpersist()
    own = sum(r["__n"] for r in rest)
    share = (rows - sum(r["__n"] for r in common)) / own if own else 1.0
    return [([float(r[c]) for c in names], r["__n"] * (share if i >= len(common) else 1.0)) for i, r in enumerate([*common, *rest])]


def background_points(train: DataFrame, n: int, features: Sequence[str] = FEATURES, label: str = LABEL,
                      seed: int = SEED) -> list[list[float]]:
    """The points of ``weighted_background``."""
    return [p for p, _ in weighted_background(train, n, features, label, seed)]


@dataclass
class Leaf:
    """A leaf's value, the box of bins that reach it and, per feature, the
    share of training rows that take its side at the splits on that feature."""
    value: float
    low: list[int]
    high: list[int]
    share: list[float]


def _tree_leaves(nodes: list[Row], bins: list[int]) -> list[Leaf]:
    """The leaves of one tree; ``bins`` are the features' bin counts. A node's
    first statistic is the weight of the training rows that reached it."""
    by_id = {n.id: n for n in nodes}
    out, stack = [], [(by_id[0], Leaf(0.0, [0] * len(bins), list(bins), [1.0] * len(bins)))]
    while stack:
        node, box = stack.pop()
        if node.leftChild < 0:
            out.append(Leaf(node.prediction, box.low, box.high, box.share))
            continue
        f, first = node.split.featureIndex, int(node.split.leftCategoriesOrThreshold[0]) + 1  # the first bin on the right
        for child, low, high in ((by_id[node.leftChild], 0, first), (by_id[node.rightChild], first, bins[f])):
            held = Leaf(0.0, list(box.low), list(box.high), list(box.share))
            held.low[f], held.high[f] = max(box.low[f], low), min(box.high[f], high)
            held.share[f] *= child.impurityStats[0] / node.impurityStats[0]
            stack.append((child, held))
    return out


def _tree_groups(trees: list[list[Leaf]], bins: list[int], max_cells: int) -> list[tuple[list[Leaf], list[list[int]]]]:
    """(leaves, per feature the first bins of its intervals) for groups of
    trees whose intervals form at most ``max_cells`` cells."""
    groups = []
    for leaves in trees:
        starts = [{0, *(x.low[f] for x in leaves)} for f in range(len(bins))]
        joined = [a | b for a, b in zip(groups[-1][1], starts)] if groups else None
        if joined and prod(map(len, joined)) <= max_cells:
            groups[-1] = (groups[-1][0] + leaves, joined)
        elif prod(map(len, starts)) <= max_cells:
            groups.append((leaves, starts))
        else:
            raise ValueError("one tree has more cells than max_cells")
    return [(leaves, [sorted(s) for s in starts]) for leaves, starts in groups]


def _coalition_values(leaves: list[Leaf], starts: list[list[int]], background) -> list[np.ndarray]:
    """Per coalition (bit mask of features) its value in each cell: an array
    with one axis per feature, of length 1 where the coalition leaves it out.
    ``background``: None, or (interval numbers per point, shares)."""
    n, sizes = len(starts), [len(s) for s in starts]
    masks = range(1 << n) if background is None else [(1 << n) - 1]
    values = {m: np.zeros([sizes[f] if m >> f & 1 else 1 for f in range(n)]) for m in masks}
    for leaf in leaves:
        box = [slice(int(np.searchsorted(s, leaf.low[f])), int(np.searchsorted(s, leaf.high[f]))) for f, s in enumerate(starts)]
        for m, table in values.items():
            share = prod(leaf.share[f] for f in range(n) if not m >> f & 1)
            table[tuple(box[f] if m >> f & 1 else slice(None) for f in range(n))] += leaf.value * share
    if background is not None:
        whole = values[(1 << n) - 1]
        for m in range((1 << n) - 1):
            values[m] = sum(share * whole[tuple(slice(None) if m >> f & 1 else slice(point[f], point[f] + 1) for f in range(n))]
                            for point, share in zip(*background))
    return [values[m] for m in range(1 << n)]


def shapley_tables(model: PriceModel, points: Sequence[Sequence[float]] | None = None,
                   weights: Sequence[float] | None = None, max_cells: int = MAX_CELLS) -> list[tuple[list[list[int]], np.ndarray]]:
    """Per group of trees: the first bins of each feature's intervals, and per
    cell (in row-major order) the features' Shapley values, the base value and
    the prediction. Sums over groups give the model's."""
    n, bins = len(model.features), [len(c) - 1 for c in model.cuts]
    tree_weights = list(model.trees.treeWeights)
    trees = [[Leaf(x.value * w, x.low, x.high, x.share) for x in _tree_leaves(nodes, bins)]
             for w, nodes in zip(tree_weights, model.nodes())]
    share = None
    if points is not None:
        filled = [[MISSING if v is None or v != v else float(v) for v in p] for p in points]
        placed = [[int(np.searchsorted(c, v, side="right")) - 1 for c, v in zip(model.cuts, p)] for p in filled]
        share = [w / sum(weights) for w in weights] if weights else [1.0 / len(placed)] * len(placed)
    out = []
    for leaves, starts in _tree_groups(trees, bins, max_cells):
        background = None if points is None else (
            [[int(np.searchsorted(s, b, side="right")) - 1 for s, b in zip(starts, p)] for p in placed], share)
        value = _coalition_values(leaves, starts, background)
        shape = [len(s) for s in starts]
        columns = []
        for i in range(n):
            total = np.zeros(shape)
            for size in range(n):
                w = factorial(size) * factorial(n - size - 1) / factorial(n)
                for others in combinations([j for j in range(n) if j != i], size):
                    m = sum(1 << j for j in others)
                    total = total + w * (value[m | 1 << i] - value[m])
            columns.append(total)
        columns += [np.broadcast_to(value[0], shape), value[-1]]
        out.append((starts, np.stack([c.reshape(-1) for c in columns], axis=1)))
    return out


def price_attribution(model: PriceModel, rows: DataFrame,
                      reference: Sequence[float] | Sequence[Sequence[float]] | None = None,
                      label: str = LABEL, weights: Sequence[float] | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """M9: per row, ``phi_<feature>`` for each feature, ``base_value`` and
    ``prediction``; sum(phi) + base_value == prediction.

    Without ``reference`` the training rows of the trees' nodes are the
    background. ``reference`` is one point or a list of background points, of
    equal ``weights`` if none are given. One pass over ``rows``: each row's
    cell number is an expression of its bins, joined with the table of cells
    (at most ``max_cells`` rows for each group of trees, broadcast)."""
    points = reference
    if reference is not None and isinstance(reference[0], (int, float)):
        points = [list(reference)]
    names = [f"phi_{f}" for f in model.features] + ["base_value", "prediction"]
    tables = shapley_tables(model, points, weights, max_cells)
    data = model.binned(model_input(rows, model.features, label))
    for g, (starts, values) in enumerate(tables):
        cell = F.lit(0)
        for feature, first, cuts in zip(model.features, starts, model.cuts):
            intervals = np.searchsorted(first, np.arange(len(cuts) - 1), side="right") - 1
            number = F.element_at(F.array(*(F.lit(int(i)) for i in intervals)), F.col(f"__b_{feature}").cast("int") + 1)
            cell = cell * len(first) + number
        table = rows.sparkSession.createDataFrame(
            [(i, *v) for i, v in enumerate(values.tolist())],
            f"__cell{g} int, " + ", ".join(f"__v{g}_{k} double" for k in range(len(names))))
        data = data.withColumn(f"__cell{g}", cell).join(F.broadcast(table), f"__cell{g}")
    sums = {name: reduce(lambda a, b: a + b, (F.col(f"__v{g}_{k}") for g in range(len(tables)))) for k, name in enumerate(names)}
    return data.withColumns(sums).select(*rows.columns, *names)


@dataclass
class PriceModelRun:
    model: PriceModel
    train: DataFrame
    test: DataFrame
    background: int
    seed: int

    @property
    def metrics(self) -> DataFrame:
        return score_regression(predict(self.model, self.test))

    @property
    def attributions(self) -> DataFrame:
        """M9 for every test row, against the training rows of the trees'
        nodes, or a background sample if one is asked for."""
        if not self.background:
            return price_attribution(self.model, self.test)
        points, weights = zip(*weighted_background(self.train, self.background, seed=self.seed))
        return price_attribution(self.model, self.test, points, weights=weights)


def run_price_model(fact: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED,
                    background: int = 0, key: Sequence[str] | None = None) -> PriceModelRun:
    """M6-M9 on the warehouse fact (which has vehicle_age). Metrics and
    attributions are planned when asked for. ``fact`` is read several times:
    pass a written layer."""
    train, test = split_train_test(fact, seed=seed, key=key)
    return PriceModelRun(train_price_model(train, trees=trees, depth=depth, seed=seed), train, test, background, seed)
