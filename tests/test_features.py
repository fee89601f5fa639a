import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimsieve.functions import keys, money, scores
from claimsieve.operators import cleansing
from claimsieve.operators import features as feat


def test_baseline_of_the_sample(sample):
    base = {r.hospital_id: r for r in feat.provider_baseline(cleansing.cleanse(sample)).collect()}
    north, amounts = base["north"], (320.4, 74.15, 611.0, 88.6)
    assert north.hosp_avg_billed == pytest.approx(statistics.fmean(amounts))
    assert (north.hosp_min_billed, north.hosp_max_billed, north.hosp_claim_count) == (74.15, 611.0, 4)
    assert north.hosp_stddev_billed == pytest.approx(statistics.stdev(amounts))
    for single in ("quay", "south"):
        assert base[single].hosp_claim_count == 1 and base[single].hosp_stddev_billed is None


def test_features_of_the_sample(sample):
    built = feat.features(cleansing.cleanse(sample))
    got = {r.claim_id: r for r in built.collect()}
    assert {k: r.amount_to_avg_ratio for k, r in got.items()} == {
        "north-1": 1.171, "north-2": 0.271, "north-3": 2.234, "north-4": 0.324, "quay-1": 1.0, "south-1": 1.0,
    }
    assert got["quay-1"].amount_z_score == got["south-1"].amount_z_score == 0.0
    assert not any(r.is_above_2std for r in got.values())
    assert cleansing.drop_incomplete(built).count() == 4
    assert {r.check_name: r.violations for r in feat.feature_checks(built).collect()} == {"null_ratio": 0, "extreme_ratio": 0}


def test_provider_without_amounts_and_without_name(claim_frame):
    rows = [
        ("A", "P", "ZERO", "I", 0.0, "S"),
        ("B", "P", "ZERO", "I", 0.0, "S"),
        ("C", "P", None, "I", 5.0, "S"),
        ("D", "P", "SAME", "I", 0.1, "S"),
        ("E", "P", "SAME", "I", 0.1, "S"),
        ("F", "P", "SAME", "I", 0.1, "S"),
    ]
    df = claim_frame(rows)
    for small in (True, False):
        got = {r.claim_id: r for r in feat.features(df, small=small).collect()}
        assert len(got) == 6
        assert got["A"].amount_to_avg_ratio is None and got["A"].amount_z_score == 0.0
        assert got["C"].hosp_avg_billed is None and got["C"].amount_to_avg_ratio is None and got["C"].amount_z_score == 0.0
        assert got["D"].hosp_stddev_billed == 0.0 and got["D"].amount_z_score == 0.0
    checks = {r.check_name: r.violations for r in feat.feature_checks(feat.features(df)).collect()}
    assert checks == {"null_ratio": 3, "extreme_ratio": 0}


def test_null_safe_baseline_serves_rows_without_provider(claim_frame):
    df = claim_frame([("A", "P", None, "I", 5.0, "S"), ("B", "P", None, "I", 7.0, "S"), ("C", "P", "H", "I", 1.0, "S")])
    joined = feat.attach_baseline(df, feat.provider_baseline(df), null_safe=True)
    assert {r.claim_id: r.hosp_avg_billed for r in joined.collect()} == {"A": 6.0, "B": 6.0, "C": 1.0}


def test_nan_ratio_is_extreme(spark):
    df = spark.createDataFrame([(float("nan"),), (1000.0,), (1000.1,), (None,)], "amount_to_avg_ratio double")
    assert {r.check_name: r.violations for r in feat.feature_checks(df).collect()} == {"null_ratio": 1, "extreme_ratio": 2}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(st.integers(0, 4_999_999), min_size=2, max_size=30), parts=st.integers(1, 4))
def test_moments_match_plain_python_for_any_partitioning(claim_frame, cents, parts):
    df = claim_frame([(f"C{i}", "P", "H", "I", c / 100, "S") for i, c in enumerate(cents)]).repartition(parts)
    row = feat.provider_baseline(df).first()
    whole = feat.provider_baseline(df.coalesce(1)).first()
    assert tuple(row) == tuple(whole)
    assert row.hosp_avg_billed == pytest.approx(statistics.fmean(cents) / 100)
    assert row.hosp_stddev_billed == pytest.approx(statistics.stdev(cents) / 100, abs=1e-9)


def test_floating_point_baseline_agrees(claim_frame):
    df = claim_frame([(f"C{i}", "P", "H", "I", float(i), "S") for i in range(10)])
    exact, builtin = feat.provider_baseline(df).first(), feat.provider_baseline(df, scale=None).first()
    for name in exact.asDict():
        assert exact[name] == builtin[name] or exact[name] == pytest.approx(builtin[name])


def test_standardize_uses_the_population_and_handles_no_spread(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    got = [(r.std_a, r.std_b) for r in feat.standardize(df, ("a", "b")).orderBy("a").collect()]
    sd = statistics.pstdev([1, 2, 6])
    assert [g[0] for g in got] == pytest.approx([(v - 3) / sd for v in (1, 2, 6)])
    assert [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_scalar_expressions(spark):
    row = spark.range(1).select(
        scores.ratio_to_baseline(F.lit(1.0), F.lit(0.0)).alias("by_zero"),
        scores.ratio_to_baseline(F.lit(2.0), F.lit(3.0)).alias("ratio"),
        scores.z_score(F.lit(5.0), F.lit(1.0), F.lit(None).cast("double")).alias("no_spread"),
        scores.above_k_std(F.lit(2.0)).alias("edge"),
        money.minor_units(F.lit(12.35)).alias("cents"),
        money.from_minor_units(F.lit(1235)).alias("amount"),
        keys.padded_id("HOSP", F.lit(42), 3).alias("padded"),
        keys.padded_id("HOSP", F.lit(12345), 3).alias("long"),
        keys.prefixed_id("CLM", F.lit(1), F.lit(2)).alias("joined"),
    ).first()
    assert row.by_zero is None and row.ratio == 0.667 and row.no_spread == 0.0 and row.edge is False
    assert row.cents == 1235 and row.amount == 12.35
    assert (row.padded, row.long, row.joined) == ("HOSP-042", "HOSP-12345", "CLM-1-2")
    assert math.isclose(row.amount * 100, 1235)
