import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsieve.operators import clusters, monitoring, reports, scoring
from claimsieve.operators.clusters import Centroids

UNIT = Centroids(("x", "y"), ((0.0, 0.0), (4.0, 0.0), (0.0, 4.0)), (0.0, 0.0), (1.0, 1.0))


def ratios(spark, rows):
    return spark.createDataFrame(rows, "claim_id string, amount_to_avg_ratio double, cluster_prediction int")


def test_only_rows_of_the_worst_cluster_above_the_threshold_are_flagged(spark):
    df = ratios(spark, [("calm", 0.42, 2), ("odd", 1.9, 0), ("steady", 1.05, 2), ("odd but low", 1.02, 0), ("far", 2.3, 2)])
    assert clusters.anomaly_cluster(df).first().anomaly_cluster == 0
    got = {r.claim_id: (r.is_anomaly, pytest.approx(r.anomaly_confidence), r.risk_level) for r in scoring.score_assigned(df).collect()}
    assert got == {
        "calm": (False, 0.0, "NORMAL"), "steady": (False, 0.0, "NORMAL"), "odd but low": (False, 0.0, "NORMAL"),
        "far": (False, 0.0, "REVIEW"), "odd": (True, 0.45, "MEDIUM"),
    }


@pytest.mark.parametrize(
    "ratio, expected",
    [
        (1.1, (False, 0.0, "NORMAL")),
        (1.5, (True, 0.25, "LOW")),
        (1.8, (True, 0.4, "LOW")),
        (2.4, (True, 0.7, "MEDIUM")),
        (2.5, (True, 0.75, "HIGH")),
        (3.0, (True, 1.0, "HIGH")),
        (9.0, (True, 1.0, "HIGH")),
    ],
)
def test_band_edges_are_strict(spark, ratio, expected):
    df = ratios(spark, [("it", ratio, 1), ("other", 0.0, 0)])
    row = scoring.score_assigned(df).filter("claim_id = 'it'").first()
    assert (row.is_anomaly, pytest.approx(row.anomaly_confidence), row.risk_level) == expected


def test_review_needs_more_than_its_ratio(spark):
    df = ratios(spark, [("worst", 50.0, 1), ("edge", 1.5, 0), ("above", 1.501, 0)])
    got = {r.claim_id: r.risk_level for r in scoring.score_assigned(df).collect()}
    assert got == {"worst": "HIGH", "edge": "NORMAL", "above": "REVIEW"}


def test_ties_take_the_lower_label_and_one_cluster_flags_nothing(spark):
    assert clusters.anomaly_cluster(ratios(spark, [("a", 2.0, 2), ("b", 2.0, 1), ("c", 1.0, 0)])).first().anomaly_cluster == 1
    alone = ratios(spark, [("a", 5.0, 0), ("b", 1.0, 0)])
    assert clusters.anomaly_cluster(alone).first().anomaly_cluster is None
    assert {(r.is_anomaly, r.risk_level) for r in scoring.score_assigned(alone).collect()} == {(False, "REVIEW"), (False, "NORMAL")}


def points(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    where = rng.integers(0, 3, n)
    xy = np.array([[0, 0], [4, 0], [0, 4]])[where] + rng.normal(0, 1, (n, 2))
    return xy, spark.createDataFrame([(float(a), float(b)) for a, b in xy], "x double, y double")


def brute(xy, labels, power):
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2)) ** power
    out = []
    for i, own in enumerate(labels):
        mates = (labels == own) & (np.arange(len(labels)) != i)
        if not mates.any():
            out.append(0.0)
            continue
        a = d[i, mates].mean()
        b = min(d[i, labels == j].mean() for j in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_assignment_inertia_and_silhouettes_match_brute_force(spark):
    xy, df = points(spark)
    centers = np.array(UNIT.centers)
    d2 = ((xy[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    labels = d2.argmin(axis=1)
    assigned = clusters.assign(df, UNIT, keep=True)
    assert [r.cluster_prediction for r in assigned.select("cluster_prediction").collect()] == labels.tolist()
    assert clusters.inertia(assigned).first().inertia == pytest.approx(d2.min(axis=1).sum())
    assert clusters.silhouette_squared(assigned, UNIT).first().silhouette_sq == pytest.approx(brute(xy, labels, 2))


def test_lonely_rows_and_single_clusters(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.1, 0.0), (4.0, 0.0)], "x double, y double")
    assigned = clusters.assign(df, UNIT, keep=True)
    xy, labels = np.array([[0, 0], [0.1, 0], [4, 0]]), np.array([0, 0, 1])
    assert clusters.silhouette_squared(assigned, UNIT).first().silhouette_sq == pytest.approx(brute(xy, labels, 2))
    one = assigned.filter("cluster_prediction = 0")
    assert clusters.silhouette_squared(one, UNIT).first().silhouette_sq is None


def test_distance_ties_go_to_the_lower_label(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, 2.0)], "x double, y double")
    assert [r.cluster_prediction for r in clusters.assign(df, UNIT).collect()] == [0, 0]


@pytest.fixture(scope="module")
def gold(spark):
    rows = [
        (f"C{i}", f"H{i % 2}", 10.0 * i, 4.0 if i % 4 == 1 else 1.0, 1 if i % 4 == 1 else 0, f"2024-01-{1 + i // 10:02d}")
        for i in range(240)
    ]
    df = spark.createDataFrame(
        rows, "claim_id string, hospital_id string, billed_amount double, amount_to_avg_ratio double, cluster_prediction int, day string"
    )
    return scoring.score_assigned(df.withColumn("service_ts", F.to_timestamp("day")).drop("day"))


def test_reports(gold):
    total = reports.anomaly_summary(gold).first()
    assert (total.total_claims, total.anomalies, total.anomaly_rate) == (240, 60, 0.25)
    assert reports.anomaly_summary(gold.limit(0)).first().anomaly_rate == 0.0
    assert {r.risk_level: r.n_claims for r in reports.risk_counts(gold).collect()} == {"HIGH": 60, "NORMAL": 180}
    daily = reports.daily_anomaly_rate(gold, days=5).collect()
    assert [str(r.claim_date) for r in daily] == [f"2024-01-{d}" for d in (24, 23, 22, 21, 20)]
    weekly = reports.weekly_anomaly_trend(gold).collect()
    assert [str(r.claim_week) for r in weekly] == ["2024-01-22", "2024-01-15", "2024-01-08", "2024-01-01"]
    top = reports.top_anomalous_providers(gold).collect()
    assert [(r.hospital_id, r.anomaly_rate) for r in top] == [("H1", 0.5), ("H0", 0.0)]
    assert reports.top_anomalous_providers(gold, more_than=120).isEmpty()
    recent = reports.recent_anomaly_alert(gold).first()
    assert recent.recent_claims == 20 and recent.alert
    shown = reports.flagged_claims(gold, ("claim_id", "risk_level"), ("claim_id",), 3).collect()
    assert [r.claim_id for r in shown] == ["C1", "C101", "C105"]


def test_monitoring(spark, gold, sample):
    assert monitoring.anomaly_rate_check(gold).first().alert
    assert not monitoring.anomaly_rate_check(gold, 0.25).first().alert
    row = monitoring.retention_check(sample).first()
    assert (row.bronze_count, row.silver_count, row.alert) == (11, 6, True)
    stored = monitoring.stored_retention_check(spark.range(100), spark.range(90)).first()
    assert stored.retention == 0.9 and not stored.alert
    nulls = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    assert {r.feature: (r.nulls, r.null_share, r.alert) for r in monitoring.null_share_check(nulls, ("a", "b")).collect()} == {
        "a": (0, 0.0, False), "b": (1, 0.5, True),
    }
    for value, expected in ((0.6, (True, False)), (0.4, (False, False)), (0.2, (False, True))):
        checked = monitoring.silhouette_check(spark.range(1).select(F.lit(value).alias("silhouette"))).first()
        assert (checked.on_target, checked.alert) == expected


def test_the_alert_of_a_stored_layer_reads_the_newest_days(spark, gold, tmp_path):
    path = str(tmp_path / "gold")
    gold.withColumn("day", F.to_date("service_ts")).write.partitionBy("day").parquet(path)
    found = reports.stored_recent_anomaly_alert(spark, path)
    assert found.first() == reports.recent_anomaly_alert(gold).first()
    days = sorted(p.name for p in (tmp_path / "gold").glob("day=*"))
    for old in days[:-2]:
        for file in (tmp_path / "gold" / old).glob("*.parquet"):
            file.write_bytes(b"not a parquet file")
    assert len(days) > 3 and reports.stored_recent_anomaly_alert(spark, path).first() == reports.recent_anomaly_alert(gold).first()
    assert {file.split("/")[-2] for file in found.inputFiles()} == set(days[-2:])
    with pytest.raises(ValueError, match="no day"):
        reports.stored_recent_anomaly_alert(spark, str(tmp_path))
