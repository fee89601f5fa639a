import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsieve.operators import drift


def exact(a, b):
    points = np.concatenate([a, b])
    share = lambda x: np.searchsorted(np.sort(x), points, "right") / len(x)
    return np.abs(share(a) - share(b)).max()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    old = np.column_stack([rng.lognormal(0, 2, 40_000), rng.normal(0, 1, 40_000)])
    new = np.column_stack([rng.lognormal(0.4, 2, 30_000), rng.normal(0, 1, 30_000)])
    frame = lambda x: spark.createDataFrame([(int(i % 7), float(a), float(b)) for i, (a, b) in enumerate(x)], "day int, a double, b double")
    return old, new, frame(old), frame(new)


def test_distances_are_within_their_bound(rows):
    old, new, trained, now = rows
    columns = ("a", "b")
    by_day = drift.sketches(now, columns, ("day",))
    assert by_day.count() == 14
    for found in (drift.sketches(now, columns), drift.merged(by_day)):
        got = {r.feature: r for r in drift.drift_check(found, drift.sketches(trained, columns), threshold=0.05).collect()}
        assert {f: r.n for f, r in got.items()} == {"a": 30_000, "b": 30_000}
        for i, c in enumerate(columns):
            assert abs(got[c].distance - exact(new[:, i], old[:, i])) <= drift.distance_error()
        assert got["a"].alert and not got["b"].alert
    daily = drift.drift_check(by_day, drift.sketches(trained, columns), by=("day",)).collect()
    for r in daily:
        assert abs(r.distance - exact(new[r.day :: 7, columns.index(r.feature)], old[:, columns.index(r.feature)])) <= drift.distance_error()


def test_sketches_do_not_grow_with_the_rows(rows):
    _, _, trained, _ = rows
    many = trained.unionAll(trained).unionAll(trained).unionAll(trained)
    size = lambda df: df.agg(F.max(F.length("sketch"))).first()[0]
    assert size(drift.sketches(many, ("a",))) < 2 * size(drift.sketches(trained, ("a",))) < 100_000


def test_null_nan_and_unknown_features(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double")
    found = drift.sketches(df, ("a", "b"))
    assert [(r.feature, r.n) for r in found.collect()] == [("a", 2)]
    other = drift.sketches(df.withColumnRenamed("a", "c"), ("c",))
    assert drift.drift_check(found, other).collect() == []
    assert drift.drift_check(found, found).first().distance == 0.0
    assert drift.sketches(df.limit(0), ("a",)).collect() == []
