"""Market segmentation.

Scaling and the starts of K-means are Spark ML jobs, the silhouette is two
aggregates; only k centroids, sums and scores reach the driver. The 10 random
restarts per K are 10 seeds per K, the lowest training cost kept; the fits share
their passes over the points (``kmeans``). Fits and silhouettes read the *distinct* scaled points with their
row counts as weights, which gives the cost and the mean silhouette of the rows
themselves, however often a point repeats; the points are partitioned by value
and sorted, so a result does not depend on how the input was split or on the
cluster's size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.operators.kmeans import Centres, Held, as_array, fit_all, hold, row_scores, silhouettes

# Features, K range, restarts, iteration limit, tolerance, seed,
# the small-data fallback, and the cluster labels by ascending mean price.
FEATURES = ("PRICE", "MILEAGE", "YEAR")
K_RANGE = tuple(range(2, 8))
RESTARTS = 10
MAX_ITER = 300
# A fit ends when the squared shifts of its centres sum to no more than this
# share of the features' variance, which is 1 once they are scaled.
TOLERANCE = 1e-4
SEED = 42
FALLBACK_K = 3
CLUSTER_LABELS = ("Budget Entry", "Standard Market", "Premium Segment")
FIXED_K_NAME = "Assigned by Snowpark"

ROWS_PER_PARTITION = 2_000_000
PARALLEL_FITS = 8


def drop_incomplete(df: DataFrame, cols: Sequence[str] = ("price", "mileage", "year")) -> DataFrame:
    """Rows with all of ``cols`` non-NULL."""
    return df.dropna(subset=list(cols))


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case column names."""
    return df.toDF(*[c.upper() for c in df.columns])


def feature_table(silver: DataFrame) -> DataFrame:
    """P15 + P16: the clustering input with upper-case columns."""
    return upper_columns(drop_incomplete(silver))


def scale_features(df: DataFrame, features: Sequence[str] = FEATURES, out: str = "scaled") -> tuple[DataFrame, PipelineModel]:
    """M1: zero mean, unit (sample) variance per feature. The sample/population
    ratio is one constant across features, so distances keep their order."""
    cast = df.withColumns({f"__f_{c}": F.col(c).cast("double") for c in features})
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol="__raw_features"),
        StandardScaler(inputCol="__raw_features", outputCol=out, withMean=True, withStd=True),
    ])
    model = pipe.fit(cast)
    return model.transform(cast).drop("__raw_features", *[f"__f_{c}" for c in features]), model


@dataclass
class KResult:
    k: int
    silhouette: float
    cost: float
    model: Centres


def weighted_points(scaled: DataFrame, features: Sequence[str] = FEATURES, col: str = "scaled",
                    partitions: int | None = None) -> DataFrame:
    """Distinct points (``col``) with the rows that have them (``weight``), for
    the fits. Partial aggregation reduces a very common point to one row per
    task before the shuffle; partitions follow from the row count alone."""
    keys = [F.col(c).cast("double").alias(f"__k_{c}") for c in features]
    names, at = [f"__k_{c}" for c in features], range(len(features))
    # Coordinates, not vectors: these would make it an aggregation by sorting.
    points = (scaled.select(*keys, as_array(scaled, col).alias("__x")).select(*names, *(F.col("__x")[i].alias(f"__x{i}") for i in at))
              .groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("weight"), *(F.first(f"__x{i}").alias(f"__x{i}") for i in at)))
    if partitions is None:
        partitions = max(1, -(-scaled.count() // ROWS_PER_PARTITION))
    placed = points.repartition(partitions, *names).sortWithinPartitions(*names)
    return placed.select(array_to_vector(F.array(*(f"__x{i}" for i in at))).alias(col), "weight")


def _best_of_restarts(points: DataFrame, ks: Sequence[int], restarts: int, seed: int, max_iter: int,
                      col: str, parallel_fits: int = PARALLEL_FITS, held: Held | None = None) -> dict[int, Centres]:
    """For each K, the lowest-cost model of ``restarts`` seeds. All (K, seed)
    fits share the passes over the points."""
    grid = [(k, seed + i) for k in ks for i in range(restarts)]
    models = fit_all(points, grid, max_iter, TOLERANCE, col, "__cluster", parallel_fits, held)
    best: dict[int, Centres] = {}
    for (k, _), m in zip(grid, models):
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def silhouette(assigned: DataFrame, col: str = "scaled", cluster_col: str = "__cluster", weight_col: str = "weight") -> float | None:
    """Mean silhouette of the rows behind weighted points, by squared
    Euclidean distance; None where fewer than two clusters are filled. The
    mean distance of a point to a cluster follows from the cluster's weight,
    sum of points and sum of squared norms, so one aggregate gives k rows and
    a second pass, with these as constants, the scores. A row's distance to its
    own cluster leaves the row itself out, not the rows that equal it; a row
    alone in its cluster scores 0."""
    x = assigned.select(as_array(assigned, col).alias("x"), F.col(cluster_col).alias("c"), F.col(weight_col).alias("w"))
    one = x.first()
    n = len(one["x"]) if one else 0
    x = x.withColumn("norm", sum((F.col("x")[i] * F.col("x")[i] for i in range(n)), F.lit(0.0)))
    sums = x.groupBy("c").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("norm")).alias("norm"),
                              *(F.sum(F.col("w") * F.col("x")[i]).alias(f"x{i}") for i in range(n))).orderBy("c").collect()
    if len(sums) < 2:
        return None

    filled = [r for r in sums if r["c"] is not None]
    weight = np.array([r["w"] for r in filled])
    mean = np.array([[r[f"x{i}"] for i in range(n)] for r in filled]) / weight[:, None]
    spread = np.array([r["norm"] for r in filled]) / weight

    def scored(batches):
        for batch in batches:
            points, w, mine = (batch.column(i) for i in range(3))
            points, w, mine = points.flatten().to_numpy().reshape(-1, n), w.to_numpy(), mine.to_numpy()
            s = row_scores(points, mine, weight, mean, spread)
            yield pa.RecordBatch.from_pydict({"s": [float(w @ s)], "w": [float(w.sum())]})

    place = F.coalesce(F.array_position(F.array(*(F.lit(r["c"]) for r in filled)), F.col("c")), F.lit(0)) - 1
    parts = x.select("x", F.col("w").cast("double"), place.cast("long").alias("c")).mapInArrow(scored, "s double, w double")
    return parts.agg(F.sum("s") / F.sum("w")).first()[0]


def select_k(scaled: DataFrame, points: DataFrame | None = None, k_range: Sequence[int] = K_RANGE,
             restarts: int = RESTARTS, seed: int = SEED, max_iter: int = MAX_ITER, col: str = "scaled",
             parallel_fits: int = PARALLEL_FITS) -> tuple[int, list[KResult]]:
    """M2: the K with the highest silhouette (first K on ties). ``points`` are
    the rows' ``weighted_points``, if the caller has them. One rule at every size: K needs as many distinct
    points and fewer K than rows. Fewer rows than max(k_range), or no K with
    two filled clusters -> K=3, or the number of distinct points if lower."""
    points = weighted_points(scaled) if points is None else points
    distinct, n = points.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    fallback = max(1, min(FALLBACK_K, distinct))
    ks = [k for k in k_range if k <= distinct and k < n]
    if n < max(k_range) or not ks:
        return fallback, []
    with hold(points, col) as held:
        best = _best_of_restarts(points, ks, restarts, seed, max_iter, col, parallel_fits, held)
        scores = silhouettes(held.packed, [best[k].centres for k in ks])
    results = [KResult(k, s, best[k].summary.trainingCost, best[k]) for k, s in zip(ks, scores) if s is not None]
    if not results:
        return fallback, []
    return max(results, key=lambda r: (r.silhouette, -r.k)).k, results


def k_report(spark: SparkSession, results: Sequence[KResult]) -> DataFrame:
    """M2's evaluation as rows (k, silhouette, cost)."""
    return spark.createDataFrame([(r.k, float(r.silhouette), float(r.cost)) for r in results],
                                 "k int, silhouette double, cost double")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Per cluster: n and mean price, mileage, year."""
    return clustered.groupBy("CLUSTER_ID").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("PRICE").cast("double")).alias("mean_price"),
        F.avg(F.col("MILEAGE").cast("double")).alias("mean_mileage"),
        F.avg(F.col("YEAR").cast("double")).alias("mean_year"))


def rank_clusters(profile: DataFrame) -> DataFrame:
    """Rank clusters by mean price ascending -> Budget Entry, Standard
    Market, Premium Segment, then 'Segment i'. The input has k rows."""
    rank = F.row_number().over(Window.orderBy(F.col("mean_price").asc_nulls_last(), F.col("CLUSTER_ID")))
    label = F.concat(F.lit("Segment "), rank.cast("string"))
    for i in reversed(range(len(CLUSTER_LABELS))):
        label = F.when(rank == i + 1, F.lit(CLUSTER_LABELS[i])).otherwise(label)
    return profile.select("CLUSTER_ID", label.alias("CLUSTER_LABEL"))


def name_clusters(clustered: DataFrame, labels: DataFrame) -> DataFrame:
    """M4: label + ' (Compliant)' / ' (Non-Compliant)'; an id without a label
    is 'Unknown'. AQE broadcasts ``labels`` if its measured size is small."""
    joined = clustered.join(labels, "CLUSTER_ID", "left")
    suffix = F.when(F.col("IS_ULEZ_COMPLIANT"), F.lit("(Compliant)")).otherwise(F.lit("(Non-Compliant)"))
    name = F.concat_ws(" ", F.coalesce(F.col("CLUSTER_LABEL"), F.lit("Unknown")), suffix)
    return joined.withColumn("CLUSTER_NAME", name).drop("CLUSTER_LABEL")


@dataclass
class Segmentation:
    clusters: DataFrame
    k: int
    silhouette: float | None
    report: DataFrame | None


def segment_market(spark: SparkSession, silver: DataFrame, k: int | None = None, restarts: int = RESTARTS,
                   seed: int = SEED, max_iter: int = MAX_ITER, name: bool = True) -> Segmentation:
    """M3 (k=None: choose K by M2, reusing its winning model and score) or M5
    (fixed k, constant cluster name). Output: upper-cased Silver columns +
    CLUSTER_ID, CLUSTER_NAME. ``silver`` is read several times: pass a written
    layer rather than a plan that is costly to repeat."""
    feats = feature_table(silver)
    scaled, _ = scale_features(feats)
    points = weighted_points(scaled.select("scaled", *FEATURES)).persist()
    report = silhouette = None
    try:
        if k is None:
            k, results = select_k(scaled, points, restarts=restarts, seed=seed, max_iter=max_iter)
            won = next((r for r in results if r.k == k), None)
            report = k_report(spark, results) if results else None
        else:
            k, won = max(1, min(k, points.count())), None
        if k < 2:
            # K-means needs two distinct points: everything is cluster 0.
            assigned = scaled.withColumn("__cluster", F.lit(0))
        elif won:
            silhouette, assigned = won.silhouette, won.model.transform(scaled)
        else:
            with hold(points, "scaled") as held:
                model = _best_of_restarts(points, [k], restarts, seed, max_iter, "scaled", held=held)[k]
                silhouette = silhouettes(held.packed, [model.centres])[0]
            assigned = model.transform(scaled)
    finally:
        points.unpersist()
    out = assigned.withColumn("CLUSTER_ID", F.col("__cluster").cast("int")).drop("__cluster", "scaled")
    if name:
        # One row a cluster: joined by key, all rows would first move to k partitions.
        out = name_clusters(out, F.broadcast(rank_clusters(cluster_profile(out))))
    else:
        out = out.withColumn("CLUSTER_NAME", F.lit(FIXED_K_NAME))
    return Segmentation(out, k, silhouette, report)


def cluster_distribution(clusters: DataFrame) -> DataFrame:
    """Rows per cluster name, most frequent first."""
    return (clusters.groupBy("CLUSTER_NAME").agg(F.count(F.lit(1)).alias("count"))
                    .orderBy(F.col("count").desc(), F.col("CLUSTER_NAME")))


def run_clustering(spark: SparkSession, silver: DataFrame, table: str | None = None, k: int = 3) -> str:
    """M5: fixed-K procedure; returns a status string."""
    cols = ["brand", "model", "year", "price", "mileage", "is_ulez_compliant"]
    src = drop_incomplete(silver.select(*cols))
    if src.isEmpty():
        return "No data to process"
    seg = segment_market(spark, src, k=k, name=False)
    if table:
        from kerbside.sinks.layers import save_clusters_table
        save_clusters_table(seg.clusters, table)
    return "SUCCESS: Clustered Market Data Updated"
