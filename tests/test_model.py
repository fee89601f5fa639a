from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from claimsieve.operators import clusters, model, scoring
from claimsieve.params import Params
from claimsieve.plans import catalogue

PARAMS = Params(feature_columns=("a", "b", "amount_to_avg_ratio"))


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    rows = []
    for j, (size, center) in enumerate([(200, (0, 0, 1)), (120, (10, 0, 5)), (60, (0, 10, 9))]):
        for p in rng.normal(center, 0.2, (size, 3)):
            rows.append((j, *map(float, p)))
    rows.append((0, None, 0.0, 1.0))
    return spark.createDataFrame(rows, "planted int, a double, b double, amount_to_avg_ratio double").repartition(4)


@pytest.fixture(scope="module")
def fitted(planted):
    return model.train(planted, PARAMS)


def test_planted_clusters_are_found(planted, fitted):
    rows = clusters.assign(planted.na.drop(), fitted.centroids).groupBy("planted", clusters.CLUSTER).count().collect()
    assert sorted(r["count"] for r in rows) == [60, 120, 200]


def test_fit_is_repeatable(planted, fitted):
    again = model.train(planted, PARAMS)
    assert np.allclose(sorted(again.centroids.centers), sorted(fitted.centroids.centers))


def test_expressions_agree_with_the_pipeline(planted, fitted):
    both = clusters.assign(fitted.pipeline.transform(planted.na.drop()).withColumnRenamed(clusters.CLUSTER, "by_pipeline"), fitted.centroids)
    assert both.filter(F.col("by_pipeline") != F.col(clusters.CLUSTER)).isEmpty()


def test_metrics(planted, fitted):
    row = model.evaluate(fitted).first()
    assert (row.n_clusters, row.n_samples) == (3, 380)
    x = np.array([tuple(r) for r in planted.na.drop().select(*PARAMS.feature_columns).collect()])
    x = np.floor(x * model.UNITS + 0.5) / model.UNITS  # the rule of the fit: features in whole units
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    centers = np.array(fitted.centroids.centers)
    assert row.inertia == pytest.approx(((z[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum())
    by_pipeline = fitted.pipeline.transform(planted.na.drop())
    c = fitted.centroids
    standard = [((F.col(n) - m) / s).alias(f"z_{n}") for n, m, s in zip(c.columns, c.means, c.deviations)]
    vectors = VectorAssembler(inputCols=[f"z_{n}" for n in c.columns], outputCol="features")
    spark_ml = ClusteringEvaluator(predictionCol=clusters.CLUSTER).evaluate(
        vectors.transform(by_pipeline.select(clusters.CLUSTER, *standard))
    )
    assert row.silhouette_sq == pytest.approx(spark_ml)
    assert row.silhouette_sq > 0.5


def test_equal_rows_weigh_what_they_count(planted, fitted):
    thrice = planted.unionAll(planted).unionAll(planted)
    again = model.train(thrice, PARAMS)
    assert (fitted.n_samples, again.n_samples) == (380, 3 * 380)
    assert again.centroids.centers == fitted.centroids.centers
    one, three = model.evaluate(fitted).first(), model.evaluate(again).first()
    assert three.inertia == pytest.approx(3 * one.inertia) and three.n_samples == 3 * one.n_samples
    rows = clusters.assign(thrice.na.drop(), again.centroids, keep=True)
    assert three.silhouette_sq == pytest.approx(clusters.silhouette_squared(rows, again.centroids).first().silhouette_sq)


def test_column_without_spread(planted):
    flat = planted.withColumn("a", F.when(F.col("a").isNotNull(), F.lit(0.1)))
    fitted = model.train(flat, PARAMS)
    assert fitted.centroids.deviations[0] == 0.0 and all(c[0] == 0.0 for c in fitted.centroids.centers)


def test_save_and_load_with_scale(spark, fitted, tmp_path):
    model.save(fitted, str(tmp_path / "staging"))
    pipeline, centroids = model.load(spark, str(tmp_path / "production"), str(tmp_path / "staging"))
    assert centroids == fitted.centroids and len(pipeline.stages) == 1
    with pytest.raises(ValueError, match="no model"):
        model.load(spark, str(tmp_path / "nothing"))


def test_too_few_rows(planted):
    with pytest.raises(ValueError, match="0 complete rows"):
        model.train(planted.filter("a > 1e9"), PARAMS)
    with pytest.raises(ValueError, match="380 complete rows"):
        model.train(planted, PARAMS, min_rows=1000)


def test_scale_of_training_against_scale_of_the_batch(planted, fitted):
    shifted = planted.withColumn("a", F.col("a") * 5)
    trained = scoring.gold(shifted, fitted.centroids, PARAMS)
    refitted = scoring.gold(shifted, fitted.centroids, PARAMS, refit_scale=True)
    plain = scoring.gold(planted, fitted.centroids, PARAMS)
    count = lambda df: sorted(r["count"] for r in df.groupBy(clusters.CLUSTER).count().collect())
    assert count(refitted) == count(plain) == [60, 120, 200]
    assert trained.count() == 380
    worst = plain.filter("is_anomaly").select("planted").distinct().collect()
    assert [r.planted for r in worst] == [2]


def placed_points(fitted):
    c = fitted.centroids
    grid = model._grid(c.columns, tuple(m * model.UNITS for m in c.means), tuple(s * model.UNITS for s in c.deviations))
    return fitted.points.select(*[x.alias(f"x{i}") for i, x in enumerate(grid)])


@pytest.mark.parametrize(("near_rows", "reach"), [(2_000_000, 8.0), (0, 8.0), (0, 0.4), (2_000_000, 0.4)])
def test_settled_points_change_no_step(spark, monkeypatch, near_rows, reach):
    """Against plain steps over all points from the same start, on points without gaps between the clusters."""
    rng = np.random.default_rng(11)
    x = np.floor(np.concatenate([rng.normal(0, 3000, (700, 3)), rng.exponential(4000, (300, 3))])).astype(int)
    placed = spark.createDataFrame([tuple(map(int, p)) for p in x], "x0 long, x1 long, x2 long").repartition(5)
    monkeypatch.setattr(model, "NEAR_ROWS", near_rows)
    monkeypatch.setattr(model, "REACH", reach)
    taken = []
    chosen = model.start
    monkeypatch.setattr(model, "start", lambda *a: taken.append(chosen(*a)) or taken[0])
    got = model.fit(placed, PARAMS.feature_columns, PARAMS)
    now, before = taken[0], None
    while now != before:
        before = now
        own = ((x[:, None] - np.array(now)[None]) ** 2).sum(axis=2).argmin(axis=1)
        now = tuple(tuple((2 * int(v) + int(n)) // (2 * int(n)) for v in x[own == j].sum(axis=0)) for j, n in enumerate(np.bincount(own)))
    assert got == tuple(sorted(now, key=lambda c: (c[2], c)))


def test_the_layout_of_the_rows_changes_nothing(spark, fitted, planted):
    try:
        for partitions, adaptive, rows in ((4, "true", planted), (16, "false", planted.repartition(1)), (64, "true", planted.repartition(37, "b"))):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            again = model.train(rows, PARAMS)
            assert again.centroids == fitted.centroids
            again.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_seeds_are_the_points_of_the_highest_priority(spark, fitted):
    placed = placed_points(fitted)
    x = np.unique(np.array([tuple(r) for r in placed.collect()]), axis=0)
    far = (x**2).sum(axis=1)
    order = np.lexsort((*x.T[::-1], -(far / model.draw(x, 42))))
    got = model._seeds(placed.unionAll(placed), 3, ((0, 0, 0),), 42)
    assert got == tuple(map(tuple, x[order[: model.SEEDS]].tolist()))


def test_start_has_the_lowest_cost_of_all_choices():
    rng = np.random.default_rng(2)
    points = tuple(sorted({tuple(map(int, p)) for p in rng.integers(-50, 50, (9, 2))}))
    weights = [int(w) for w in rng.integers(1, 9, len(points))]

    def cost(chosen):
        return sum(w * min(sum((a - b) ** 2 for a, b in zip(p, c)) for c in chosen) for p, w in zip(points, weights))

    got = model.start(points, weights, 3)
    assert cost(got) == min(cost(c) for c in combinations(points, 3))


def test_one_by_one_beyond_the_choices_tried(monkeypatch):
    monkeypatch.setattr(model, "CHOICES", 0)
    points = ((0, 0), (1, 0), (100, 0), (101, 0), (0, 90))
    assert {(x // 50, y // 50) for x, y in model.start(points, [5, 1, 5, 1, 5], 3)} == {(0, 0), (2, 0), (0, 1)}


def test_few_different_points_and_far_ones(spark):
    same = spark.createDataFrame([(1.0, 2.0, 3.0)] * 5, "a double, b double, amount_to_avg_ratio double")
    assert model.train(same, PARAMS).centroids.centers == ((0.0, 0.0, 0.0),) * 3
    far = spark.createDataFrame([(1 << 31, 0, 0)], "x0 long, x1 long, x2 long")
    with pytest.raises(Exception, match="scale it first"):
        model.fit(far, PARAMS.feature_columns, PARAMS)


def test_gold_reads_the_records_once(spark):
    plan = catalogue.gold_anomalies(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "billed_amount" in plan


def test_squares_and_seeds_of_copies(spark):
    """Distances by column, and seeds that do not depend on how often a point is there."""
    x = np.random.default_rng(5).integers(-9, 10, (400, 3))
    centers = ((0, 0, 0), (3, -2, 5))
    assert np.array_equal(model._squares(x, centers), np.stack([((x - np.array(c)) ** 2).sum(axis=1) for c in centers], axis=1))
    placed = spark.createDataFrame(x.tolist(), "x0 long, x1 long, x2 long")
    once = model._seeds(placed.distinct(), 3, centers, 42)
    assert len(once) == model.SEEDS and model._seeds(placed.unionAll(placed), 3, centers, 42) == once
