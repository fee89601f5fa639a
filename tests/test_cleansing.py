import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimsieve.operators import cleansing
from tests.conftest import SAMPLE


def ids(df):
    return sorted(r["claim_id"] for r in df.collect())


def by_id(df, column):
    return {r["claim_id"]: r[column] for r in df.collect()}


def test_documented_silver(sample):
    silver = cleansing.cleanse(sample)
    assert ids(silver) == ["north-1", "north-2", "north-3", "north-4", "quay-1", "south-1"]
    assert by_id(silver, "billed_amount")["north-4"] == 88.6
    codes = by_id(silver, "diagnosis_code")
    assert codes["north-3"] == codes["quay-1"] == "UNKNOWN"


def test_compat_silver_loses_null_codes_and_keeps_empty_ones(sample):
    silver = cleansing.cleanse(sample, compat=True)
    assert ids(silver) == ["north-1", "north-2", "north-3", "north-4", "south-1"]
    assert by_id(silver, "diagnosis_code")["north-3"] == ""
    checks = {r["check_name"]: (r["violations"], r["ok"]) for r in cleansing.post_clean_checks(silver).collect()}
    assert checks == {"negative_amount": (0, True), "null_record_id": (0, True), "empty_code": (1, False)}


def test_metrics_documented_and_compat(sample):
    row = cleansing.cleansing_metrics(sample).first()
    assert (row.initial_count, row.final_count, row.duplicates_removed) == (11, 6, 1)
    assert (row.invalid_diagnosis_removed, row.null_diagnosis_imputed) == (2, 2)
    assert (row.negative_amounts_corrected, row.outliers_filtered) == (2, 2)
    assert row.records_removed == 5 and row.cleansing_rate == pytest.approx(5 / 11)
    row = cleansing.cleansing_metrics(sample, compat=True).first()
    assert (row.invalid_diagnosis_removed, row.null_diagnosis_imputed, row.outliers_filtered) == (3, 1, 2)


def test_metrics_of_an_empty_table(sample):
    row = cleansing.cleansing_metrics(sample.limit(0)).first()
    assert row.initial_count == 0 and row.final_count == 0 and row.cleansing_rate == 0.0


def test_edges(claim_frame):
    rows = [
        ("A", "P", "H", "I10", 10.0, "PENDING"),
        ("A", "P", "H", "I10", 10.0, "PENDING"),  # exact copy
        ("A", "P", "H", "I10", 11.0, "PENDING"),  # same id, other amount
        ("B", "P", "H", "I10", None, "PENDING"),
        ("C", "P", "H", "I10", 50000.0, "PENDING"),
        ("D", "P", "H", "I10", 49999.99, "PENDING"),
        ("E", "P", "H", "I10", -60000.0, "PENDING"),
        ("F", "P", "H", "I10", float("nan"), "PENDING"),
        ("G", "P", None, None, -1.0, None),
        ("G", "P", None, None, -1.0, None),  # NULLs are equal
    ]
    silver = cleansing.cleanse(claim_frame(rows))
    assert sorted((r.claim_id, r.billed_amount) for r in silver.collect()) == [
        ("A", 10.0), ("A", 11.0), ("D", 49999.99), ("G", 1.0),
    ]


def test_early_range_filter_is_the_cap_after_the_sign(claim_frame):
    amounts = [None, float("nan"), 0.0, -0.0, 49999.99, 50000.0, -50000.0, -49999.99, float("inf"), -float("inf")]
    df = claim_frame([(f"C{i}", "P", "H", "I10", a, "PENDING") for i, a in enumerate(amounts)])
    stepwise = (
        df.transform(cleansing.drop_exact_duplicates)
        .transform(cleansing.drop_invalid_code)
        .transform(cleansing.impute_code)
        .transform(cleansing.absolute_amounts)
        .transform(cleansing.cap_amounts)
    )
    assert ids(cleansing.cleanse(df)) == ids(stepwise) == ["C2", "C3", "C4", "C7"]


def test_absolute_amounts_keep_null(claim_frame):
    got = by_id(cleansing.absolute_amounts(claim_frame([("A", "P", "H", "I", None, "S"), ("B", "P", "H", "I", -2.5, "S")])), "billed_amount")
    assert got == {"A": None, "B": 2.5}


def test_drop_incomplete_takes_null_and_nan(claim_frame):
    df = claim_frame([("A", "P", "H", "I", 1.0, "S"), ("B", "P", None, "I", 1.0, "S"), ("C", "P", "H", "I", float("nan"), "S")])
    assert ids(cleansing.drop_incomplete(df)) == ["A"]
    row = cleansing.incomplete_count(df).first()
    assert (row.kept, row.dropped) == (1, 2)


claims = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.just("P"),
    st.sampled_from(["H1", None]),
    st.sampled_from(["I10", "", None, "INVALID-CODE-999"]),
    st.sampled_from([None, 0.0, -3.0, 7.5, 50000.0, -70000.0]),
    st.just("PENDING"),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(claims, min_size=0, max_size=25))
def test_metrics_reconcile_and_match_plain_python(claim_frame, rows):
    df = claim_frame(rows)
    m = cleansing.cleansing_metrics(df).first()
    distinct = set(rows)
    good = [r for r in distinct if r[3] != "INVALID-CODE-999"]
    kept = [r for r in good if r[4] is not None and abs(r[4]) < 50000]
    assert m.initial_count - m.duplicates_removed - m.invalid_diagnosis_removed - m.outliers_filtered == m.final_count
    assert (m.duplicates_removed, m.final_count) == (len(rows) - len(distinct), len(kept))
    assert cleansing.cleanse(df).count() == m.final_count


def test_cleansing_is_idempotent(sample):
    once = cleansing.cleanse(sample)
    twice = cleansing.cleanse(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert len(SAMPLE) == 11 and not any(math.isnan(r.billed_amount) for r in once.collect())
    assert once.filter(F.col("billed_amount") < 0).isEmpty()
