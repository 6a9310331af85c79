import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kerbside.operators import kmeans, pricing, segments


def _features(spark, points, flags=None):
    rows = [(str(i), "B", "M", int(y), float(p), int(m), (flags[i] if flags else i % 2 == 0))
            for i, (p, m, y) in enumerate(points)]
    return spark.createDataFrame(rows, "id string, brand string, model string, year int, price double, "
                                       "mileage int, is_ulez_compliant boolean")


def _scaled(spark, points):
    return segments.scale_features(segments.feature_table(_features(spark, points)))[0]


def test_small_inputs_fall_back_to_k3(spark):
    k, results = segments.select_k(_scaled(spark, [(1000 * i, 10 * i, 2000 + i) for i in range(5)]))
    assert k == 3 and results == []
    k7, results7 = segments.select_k(_scaled(spark, [(1000 * i, 10 * i, 2000 + i) for i in range(7)]), restarts=2)
    assert 7 not in [r.k for r in results7] and 2 <= k7 <= 6


def test_k_does_not_depend_on_how_often_points_repeat(spark):
    three = [(5000, 90000, 2005), (20000, 40000, 2014), (60000, 5000, 2022)]
    for n in (20, 30, 3000):
        k, results = segments.select_k(_scaled(spark, three * n), restarts=2)
        assert k == 3 and [r.k for r in results] == [2, 3]


def test_equal_rows_are_one_cluster(spark):
    seg = segments.segment_market(spark, _features(spark, [(9000, 100, 2010)] * 100), restarts=2)
    assert seg.k == 1 and {r.CLUSTER_ID for r in seg.clusters.collect()} == {0}
    fixed = segments.segment_market(spark, _features(spark, [(9000, 100, 2010)] * 100), k=3, restarts=2, name=False)
    assert {r.CLUSTER_ID for r in fixed.clusters.collect()} == {0}


def test_cost_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(11)
    points = [(int(rng.integers(1000, 60000)), int(rng.integers(0, 90000)), int(rng.integers(2000, 2024))) for _ in range(600)]
    df = _features(spark, points)
    costs = []
    for n in (1, 4, 16):
        scaled, _ = segments.scale_features(segments.feature_table(df.repartition(n)))
        p = segments.weighted_points(scaled)
        costs.append(segments._best_of_restarts(p, [4], 3, 42, segments.MAX_ITER, "scaled")[4].summary.trainingCost)
    assert max(costs) - min(costs) < 1e-6


def test_silhouette_of_weighted_points_is_that_of_the_rows(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    rng = np.random.default_rng(12)
    rows = [(int(rng.integers(1, 40)) * 1000, int(rng.integers(0, 9)) * 5000, int(rng.integers(2000, 2010))) for _ in range(300)]
    scaled = _scaled(spark, rows + rows[:60] * 3 + [(900000, 1, 1950)])  # repeated rows, and one alone in its cluster
    points = segments.weighted_points(scaled)
    for k in (2, 3, 6):
        model = KMeans(k=k, seed=1, featuresCol="scaled", weightCol="weight", predictionCol="__cluster").fit(points)
        want = ClusteringEvaluator(featuresCol="scaled", predictionCol="__cluster").evaluate(model.transform(scaled))
        assert abs(segments.silhouette(model.transform(points)) - want) < 1e-9
    one = points.withColumn("__cluster", F.lit(0))
    assert segments.silhouette(one) is None and segments.silhouette(one.limit(0)) is None


def test_weighted_points_hold_every_row(spark):
    p = segments.weighted_points(_scaled(spark, [(1, 2, 2000)] * 50 + [(3, 4, 2001)] * 7 + [(5, 6, 2002)])).collect()
    assert sorted(r.weight for r in p) == [1.0, 7.0, 50.0]


def test_scaling_is_zero_mean_unit_sample_std(spark):
    df = _features(spark, [(1000 * i + 7, (i * 37) % 11, 2000 + i % 5) for i in range(40)])
    scaled, _ = segments.scale_features(segments.feature_table(df))
    arr = np.array([r[0] for r in scaled.select(vector_to_array("scaled")).collect()])
    assert np.allclose(arr.mean(axis=0), 0, atol=1e-9)
    assert np.allclose(arr.std(axis=0, ddof=1), 1, atol=1e-9)


def _cloud(spark, n=3000):
    rng = np.random.default_rng(5)
    return _scaled(spark, [(float(rng.gamma(3, 9000)), int(rng.integers(0, 150000)), int(rng.integers(2000, 2024))) for _ in range(n)])


def _spark_fit(points, k, seed):
    from pyspark.ml.clustering import KMeans

    return KMeans(k=k, seed=seed, maxIter=segments.MAX_ITER, tol=(segments.TOLERANCE / k) ** 0.5, featuresCol="scaled",
                  weightCol="weight", predictionCol="__cluster").fit(points)


def test_joint_fits_are_those_of_spark_ml(spark):
    points = segments.weighted_points(_cloud(spark)).persist()
    grid = [(2, 42), (3, 43), (7, 44)]
    for (k, seed), got in zip(grid, kmeans.fit_all(points, grid, segments.MAX_ITER, segments.TOLERANCE, "scaled", "__cluster", 2)):
        want = _spark_fit(points, k, seed)
        assert np.allclose(got.clusterCenters(), want.clusterCenters(), atol=1e-9)
        assert abs(got.summary.trainingCost - want.summary.trainingCost) < 1e-6 and got.summary.numIter == want.summary.numIter
        both = got.transform(points).withColumnRenamed("__cluster", "mine")
        assert want.transform(both).where("mine <> __cluster").count() == 0
    points.unpersist()


def test_joint_starts_are_as_good_and_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "SEPARATE_STARTS", 0)
    points = segments.weighted_points(_cloud(spark))
    costs = []
    for rows in (kmeans.ROWS_PER_PARTITION, 500):
        monkeypatch.setattr(kmeans, "ROWS_PER_PARTITION", rows)
        best = segments._best_of_restarts(points, [3, 6], 8, 42, segments.MAX_ITER, "scaled")
        assert [len(best[k].clusterCenters()) for k in (3, 6)] == [3, 6]
        costs.append([best[k].summary.trainingCost for k in (3, 6)])
    assert np.allclose(*costs)
    for k, cost in zip((3, 6), costs[0]):
        assert cost < 1.01 * min(_spark_fit(points, k, 42 + i).summary.trainingCost for i in range(8))


def test_fits_share_their_passes_over_the_points(spark, monkeypatch):
    """However many fits there are, an iteration is one pass, and no fit decodes points of its own."""
    passes, starts = [], []
    summed, start = kmeans.nearest_sums, kmeans.start
    monkeypatch.setattr(kmeans, "SEPARATE_STARTS", 0)
    monkeypatch.setattr(kmeans, "nearest_sums", lambda packed, fits: passes.append(len(fits)) or summed(packed, fits))
    monkeypatch.setattr(kmeans, "start", lambda *a: starts.append(a) or start(*a))
    grid = [(k, 42 + i) for k in (2, 5) for i in range(6)]
    models = kmeans.fit_all(segments.weighted_points(_cloud(spark)), grid, segments.MAX_ITER, segments.TOLERANCE, "scaled", "__cluster", 8)
    assert not starts and passes[:4] == [12] * 4
    assert len(passes) == kmeans.START_STEPS + 1 + max(m.summary.numIter for m in models)


def test_sums_by_boxes_are_those_of_the_points():
    rng = np.random.default_rng(3)
    x = np.sort(np.column_stack([rng.normal(size=3000), rng.integers(0, 9, 3000), rng.integers(0, 3, 3000)]), axis=0)
    held = np.column_stack([x, rng.integers(1, 5, 3000)])
    fits = [x[rng.choice(3000, k, replace=False)] for k in (1, 4, 7)]
    totals = [np.zeros((len(c), 5)) for c in fits]
    kmeans.add_nearest(totals, held, fits)
    for c, got in zip(fits, totals):
        label = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        want = [[w.sum(), *(w[:, None] * p).sum(axis=0), (w * (p * p).sum(axis=1)).sum()]
                for j in range(len(c)) for p, w in [(x[label == j], held[label == j, 3])]]
        assert np.allclose(got, want)


def _blobs(spark):
    rng = np.random.default_rng(7)
    pts = []
    for cp, cm, cy in [(5000, 90000, 2005), (20000, 40000, 2014), (60000, 5000, 2022)]:
        for _ in range(40):
            pts.append((cp + rng.normal(0, 300), cm + rng.normal(0, 500), cy + int(rng.integers(-1, 2))))
    return _features(spark, pts)


def test_three_blobs_give_three_named_segments(spark):
    df = _blobs(spark)
    seg = segments.segment_market(spark, df, restarts=3)
    assert seg.k == 3
    out = seg.clusters.collect()
    assert len(out) == 120 and all(r.CLUSTER_ID is not None for r in out)
    means = {}
    for r in out:
        base = r.CLUSTER_NAME.rsplit(" (", 1)[0]
        means.setdefault(base, []).append(r.PRICE)
        assert r.CLUSTER_NAME.endswith("(Compliant)" if r.IS_ULEZ_COMPLIANT else "(Non-Compliant)")
    order = sorted(means, key=lambda b: np.mean(means[b]))
    assert order == ["Budget Entry", "Standard Market", "Premium Segment"]
    again = segments.segment_market(spark, df, restarts=3).clusters
    key = lambda rows: sorted((r.ID, r.CLUSTER_NAME) for r in rows)
    assert key(again.collect()) == key(out)
    dist = segments.cluster_distribution(seg.clusters).collect()
    assert sum(r["count"] for r in dist) == 120


def test_fixed_k_procedure(spark):
    assert segments.run_clustering(spark, _blobs(spark).limit(0)) == "No data to process"
    assert segments.run_clustering(spark, _blobs(spark)).startswith("SUCCESS")


def _fact(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        age = int(rng.integers(1, 20))
        rows.append((f"r{i}", float(20000 - 500 * age + rng.normal(0, 200)), age, int(rng.integers(0, 90000)),
                     float(rng.choice([1.0, 1.5, 2.0])), bool(age < 8)))
    return spark.createDataFrame(rows, "id string, price double, vehicle_age int, mileage int, "
                                       "engine_size double, is_ulez_compliant boolean")


def test_split_is_disjoint_complete_and_stable(spark):
    df = _fact(spark, 2000)
    train, test = pricing.split_train_test(df)
    tr = {r.id for r in train.collect()}
    te = {r.id for r in test.collect()}
    assert not tr & te and len(tr | te) == 2000
    assert abs(len(tr) / 2000 - 0.8) < 0.02 + 0.01
    tr2, _ = pricing.split_train_test(df.repartition(7))
    assert {r.id for r in tr2.collect()} == tr


def test_price_model_fits_and_attributions_add_up(spark):
    run = pricing.run_price_model(_fact(spark), trees=20, depth=4, background=1)
    assert run.metrics.first().r2 > 0.8
    rows = run.attributions.collect()
    assert len(rows) == run.test.count() > 0
    for r in rows:
        total = r.base_value + sum(r[f"phi_{f}"] for f in pricing.FEATURES)
        assert abs(total - r.prediction) < 1e-6


def test_attributions_with_background_sample_add_up(spark):
    fact = _fact(spark)
    train, test = pricing.split_train_test(fact)
    model = pricing.train_price_model(train, trees=10, depth=3)
    points = pricing.background_points(train, 3)
    assert len(points) == 3 and points == pricing.background_points(train.repartition(5), 3)
    rows = pricing.price_attribution(model, test, points).collect()
    for r in rows:
        total = r.base_value + sum(r[f"phi_{f}"] for f in pricing.FEATURES)
        assert abs(total - r.prediction) < 1e-6


def test_missing_labels_and_features_keep_their_rows(spark):
    from pyspark.sql import functions as F

    fact = _fact(spark).withColumns({
        "price": F.when(F.col("mileage") % 5 > 0, F.col("price")),
        "engine_size": F.when(F.col("mileage") % 3 > 0, F.col("engine_size"))})
    run = pricing.run_price_model(fact, trees=5, depth=3, background=2)
    rows = run.attributions.collect()
    assert len(rows) == run.test.count() and any(r.price is None for r in rows) and any(r.engine_size is None for r in rows)
    assert all(abs(r.base_value + sum(r[f"phi_{f}"] for f in pricing.FEATURES) - r.prediction) < 1e-6 for r in rows)
    assert run.metrics.first().n == sum(r.price is not None for r in rows)
    assert pricing.labelled_input(run.train).count() == run.train.where("price IS NOT NULL").count()


def _brute_attribution(run, row, points=None, weights=None):
    """Shapley values by walking every tree for every coalition."""
    from itertools import combinations
    from math import factorial

    model, n = run.model, len(pricing.FEATURES)
    trees, tree_weights = model.nodes(), model.trees.treeWeights

    def bins(values):
        filled = [pricing.MISSING if v is None else float(v) for v in values]
        return [sum(v >= c for c in cuts[1:-1]) for v, cuts in zip(filled, model.cuts)]

    def walk(nodes, at, x, known):
        node = nodes[at]
        if node.leftChild < 0:
            return node.prediction
        f, cut = node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]
        if f in known:
            return walk(nodes, node.leftChild if x[f] <= cut else node.rightChild, x, known)
        return sum(nodes[c].impurityStats[0] / node.impurityStats[0] * walk(nodes, c, x, known) for c in (node.leftChild, node.rightChild))

    def value(known):
        x = bins(row)
        if points is None:
            return sum(w * walk(t, 0, x, known) for w, t in zip(tree_weights, trees))
        total = 0.0
        for p, share in zip(points, weights):
            mixed = [a if f in known else b for f, (a, b) in enumerate(zip(x, bins(p)))]
            total += share / sum(weights) * sum(w * walk(t, 0, mixed, set(range(n))) for w, t in zip(tree_weights, trees))
        return total

    phis = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        phis.append(sum(factorial(k) * factorial(n - k - 1) / factorial(n) * (value({*s, i}) - value(set(s)))
                        for k in range(n) for s in combinations(rest, k)))
    return [*phis, value(set()), value(set(range(n)))]


def test_attributions_are_shapley_values_of_the_trees(spark):
    fact = _fact(spark, 300).withColumns({
        "engine_size": F.when(F.col("mileage") % 4 > 0, F.col("engine_size")),
        "is_ulez_compliant": F.when(F.col("mileage") % 7 > 0, F.col("is_ulez_compliant"))})
    run = pricing.run_price_model(fact, trees=6, depth=4)
    names = [f"phi_{f}" for f in pricing.FEATURES] + ["base_value", "prediction"]
    told = {r.id: r.prediction for r in pricing.predict(run.model, run.test).collect()}
    got = run.attributions.collect()
    assert len(got) == len(told) > 20
    for r in got[:25]:
        assert np.allclose([r[c] for c in names], _brute_attribution(run, [r[f] for f in pricing.FEATURES]))
    assert all(abs(r.prediction - told[r.id]) < 1e-6 for r in got)
    # the same from many small tables as from one
    small = {r.id: [r[c] for c in names] for r in pricing.price_attribution(run.model, run.test, max_cells=1500).collect()}
    assert all(np.allclose(small[r.id], [r[c] for c in names]) for r in got)
    assert len(pricing.shapley_tables(run.model, max_cells=1500)) > 1
    points, weights = zip(*pricing.weighted_background(run.train, 5))
    for r in pricing.price_attribution(run.model, run.test.limit(8), points, weights=weights).collect():
        assert np.allclose([r[c] for c in names], _brute_attribution(run, [r[f] for f in pricing.FEATURES], points, weights))


def test_cells_hold_all_labelled_rows_and_give_the_trees_of_the_rows(spark):
    from pyspark.ml.regression import GBTRegressor

    fact = _fact(spark, 1500).withColumn("mileage", (F.col("mileage") % 13).cast("int"))
    cuts = pricing.feature_cuts(pricing.labelled_input(fact))
    assert [len(c) for c in cuts] == [21, 15, 5, 4]  # 19 ages, 13 distances, 3 sizes, 2 flags, and the missing value's bin
    cells = pricing.training_cells(fact, cuts)
    assert cells.agg(F.sum("__n")).first()[0] == 1500 and cells.count() < 1500
    model = pricing.train_price_model(fact, trees=5, depth=3)
    rows = pricing._assembler(pricing.FEATURES).transform(model.binned(pricing.labelled_input(fact)))
    whole = GBTRegressor(featuresCol="features", labelCol="__label", maxIter=5, maxDepth=3, stepSize=pricing.STEP, seed=42, maxBins=32).fit(
        rows.coalesce(1))
    one = {r.id: r.prediction for r in whole.transform(rows).collect()}
    assert all(abs(one[r.id] - r.prediction) < 1e-6 for r in pricing.predict(model, fact).collect())


def test_many_valued_features_are_cut_at_equal_shares(spark):
    df = spark.range(20000).selectExpr("cast(id as double) AS __x_a", f"if(id % 10 = 0, {pricing.MISSING}, cast(id % 3 as double)) AS __x_b")
    a, b = pricing.feature_cuts(df, ["a", "b"])
    assert len(a) == 33 and b == [-float("inf"), pricing.MISSING / 2, 1.0, 2.0, float("inf")]
    sizes = pricing._binned(df, ["a", "b"], [a, b]).groupBy("__b_a").count().collect()
    assert len(sizes) == 31 and all(550 < r["count"] < 750 for r in sizes)


def test_background_weighs_distinct_points_by_their_rows(spark):
    from pyspark.sql import functions as F

    fact = _fact(spark, 200)
    hot = fact.limit(1).crossJoin(spark.range(100)).drop("id").withColumn("id", F.lit("hot")).select(fact.columns)
    train = fact.unionByName(hot)  # one row is a third of all
    for n in (3, 16, 500):
        found = pricing.weighted_background(train, n)
        points, weights = [tuple(p) for p, _ in found], [w for _, w in found]
        assert len(set(points)) == len(points) == min(n, 200) and abs(sum(weights) - 300) < 1e-6
        assert max(weights) == 101 if n > 3 else 101 in weights
    assert found == pricing.weighted_background(train.repartition(5), 500)
    model = pricing.train_price_model(train, trees=3, depth=2)
    points, weights = zip(*pricing.weighted_background(train, 8))
    base = pricing.price_attribution(model, fact.limit(2), points, weights=weights).first().base_value
    rows = [(f"p{i}", 0.0, int(p[0]), int(p[1]), p[2], bool(p[3])) for i, p in enumerate(points)]
    told = {r.id: r.prediction for r in pricing.predict(model, spark.createDataFrame(rows, fact.schema)).collect()}
    assert abs(base - sum(told[f"p{i}"] * w for i, w in enumerate(weights)) / sum(weights)) < 1e-6


def test_starts_on_cells_leave_few_passes_over_the_points(spark, monkeypatch):
    """All points weigh in the cells, and every fit ends on the points as a fit by Spark ML does."""
    monkeypatch.setattr(kmeans, "SEPARATE_STARTS", 0)
    points = segments.weighted_points(_cloud(spark)).persist()
    grid = [(k, 42 + i) for k in (3, 6) for i in range(8)]
    fit = lambda: kmeans.fit_all(points, grid, segments.MAX_ITER, segments.TOLERANCE, "scaled", "__cluster", 8)
    before = fit()
    monkeypatch.setattr(kmeans, "CELL_BITS", 15)
    monkeypatch.setattr(kmeans, "FEWEST_CELLS", 100)
    monkeypatch.setattr(kmeans, "CELL_SHARE", 0.9)
    cells = kmeans.cells(points, "scaled", 3).collect()
    assert 100 < len(cells) < 2500 and sum(r.weight for r in cells) == 3000
    assert np.allclose(sum(r.weight * np.array(r.scaled) for r in cells), 0, atol=1e-6)
    after = fit()
    passes = lambda models: sum(m.summary.numIter for m in models)
    assert 3 * passes(after) < 2 * passes(before) and all(m.summary.numIter for m in after)
    x = np.array([r.scaled.toArray() for r in points.collect()])
    for (k, _), m in zip(grid, after):
        c = np.array(m.clusterCenters())
        label = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[label == j].mean(axis=0) for j in range(k)]) - c
        assert (moved ** 2).sum(axis=1).max() < 2 * segments.TOLERANCE / k
    for k in (3, 6):
        best = [min(m.summary.trainingCost for (j, _), m in zip(grid, models) if j == k) for models in (after, before)]
        assert best[0] < 1.01 * best[1]
    monkeypatch.setattr(kmeans, "FEWEST_CELLS", 3000)  # too few cells: starts from the points
    assert [m.summary.numIter for m in fit()] == [m.summary.numIter for m in before]
    points.unpersist()


def test_scores_of_all_k_share_two_passes(spark, monkeypatch):
    scaled = _cloud(spark, 700)
    points = segments.weighted_points(scaled.unionByName(scaled.limit(90))).persist()
    rng = np.random.default_rng(2)
    fits = [rng.normal(size=(k, 3)) for k in (2, 5)]
    fits += [np.vstack([fits[1], [[99.0] * 3]]), np.array([[0.0] * 3, [99.0] * 3])]  # centres that no point is near
    monkeypatch.setattr(kmeans, "SLICE", 100)
    with kmeans.hold(points, "scaled") as held:
        got = kmeans.silhouettes(held.packed, fits)
    want = [segments.silhouette(kmeans.Centres(c, kmeans.Summary(0.0, 0), "scaled", "__cluster").transform(points)) for c in fits]
    assert got[3] is want[3] is None and np.allclose(got[:3], want[:3], atol=1e-12, rtol=0)
    points.unpersist()


def test_names_move_no_rows(spark):
    seg = segments.segment_market(spark, _blobs(spark), k=3, restarts=1, name=True)
    plan = seg.clusters._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
