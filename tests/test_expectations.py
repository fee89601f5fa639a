import pytest
from pyspark.sql import functions as F

from claimsieve.operators import cleansing, expectations as ex
from claimsieve.operators import features as feat


def statuses(results):
    return {r.expectation_name: r.status for r in results.collect()}


def test_bronze_passes(sample):
    got = statuses(ex.check_layer(sample, "bronze", "t"))
    assert got == {
        "non_empty_table": "passed",
        "required_columns_exist": "passed",
        "claim_id_not_null": "passed",
        "billed_amount_populated": "passed",
    }


def test_empty_table_fails_without_dividing(sample):
    got = statuses(ex.check_layer(sample.limit(0), "bronze", "t"))
    assert got["non_empty_table"] == "failed" and got["billed_amount_populated"] == "failed"


def test_missing_columns_fail_and_skip_their_checks(sample):
    results = ex.check_layer(sample.drop("claim_id", "billed_amount"), "bronze", "t")
    got = statuses(results)
    assert got["required_columns_exist"] == "failed"
    assert "claim_id_not_null" not in got and "billed_amount_populated" not in got
    message = results.filter("expectation_name = 'required_columns_exist'").first().message
    assert message == "missing: billed_amount, claim_id"


def test_null_ids_warn_and_null_amounts_have_a_strict_tolerance(spark):
    df = spark.range(100).select(
        F.when(F.col("id") > 0, F.lit("c")).alias("claim_id"),
        F.lit("p").alias("patient_id"),
        F.when(F.col("id") > 0, F.lit(1.0)).alias("billed_amount"),
        F.lit("PENDING").alias("claim_status"),
    )
    results = ex.check_layer(df, "bronze", "t")
    got = statuses(results)
    assert got["claim_id_not_null"] == "warning"
    assert got["billed_amount_populated"] == "failed"  # exactly 1 % is too much
    report = ex.report(results).first()
    assert (report.passed, report.failed, report.warnings, report.total_checks) == (2, 1, 1, 4)
    assert not report.is_valid and report.failed_checks == "billed_amount_populated"
    assert report.summary == "t: 4 checks, 2 passed, 1 failed, 1 warnings: INVALID"
    assert sorted(r.expectation_name for r in ex.findings(results).collect()) == [
        "billed_amount_populated", "claim_id_not_null",
    ]


def test_silver_on_raw_rows(sample):
    got = statuses(ex.check_layer(sample, "silver", "t"))
    assert got["no_negative_amounts"] == got["no_invalid_diagnosis_codes"] == got["no_extreme_outliers"] == "failed"
    assert set(statuses(ex.check_layer(cleansing.cleanse(sample), "silver", "t")).values()) == {"passed"}


def test_compat_silver_counts_raw_checks_twice(sample):
    results = ex.check_layer(cleansing.cleanse(sample), "silver", "t", compat=True)
    assert ex.report(results).first().passed == 4 * 2 + 3


def test_feature_checks(sample):
    built = feat.features(cleansing.cleanse(sample))
    assert set(statuses(ex.check_layer(built, "features", "t")).values()) == {"passed"}
    broken = built.withColumn("amount_to_avg_ratio", F.when(F.col("claim_id") == "north-1", -1.0))
    got = statuses(ex.check_layer(broken, "features", "t"))
    assert got["no_null_ratios"] == "failed" and got["positive_ratios"] == "failed"
    zero = built.withColumn("amount_to_avg_ratio", F.lit(0.0))
    assert statuses(ex.check_layer(zero, "features", "t"))["positive_ratios"] == "passed"
    assert statuses(ex.check_layer(built.drop("hosp_avg_billed"), "features", "t"))["required_features_exist"] == "failed"


@pytest.mark.parametrize("layer", ["gold", "other"])
def test_layer_without_checks_is_skipped_and_valid(sample, layer):
    results = ex.check_layer(sample, layer, "t")
    assert statuses(results) == {"layer_validation": "skipped"}
    report = ex.report(results).first()
    assert report.total_checks == 0 and report.is_valid
    assert ex.is_valid(results)


def test_unreadable_table(spark):
    results = ex.validate_table(spark, "no_such_table", "bronze")
    assert statuses(results) == {"table_exists": "failed"}
    assert not ex.is_valid(results)
    with pytest.raises(ValueError, match="table_exists"):
        ex.require_valid(results)


def test_gate(sample):
    ex.require_valid(ex.check_layer(sample, "bronze", "t"))
    with pytest.raises(ValueError, match="no_negative_amounts, no_invalid_diagnosis_codes, no_extreme_outliers"):
        ex.require_valid(ex.check_layer(sample, "silver", "t"))


@pytest.mark.parametrize(
    "failed, total, severity",
    [(0, 10, "NONE"), (1, 20, "LOW"), (1, 10, "MEDIUM"), (5, 10, "MEDIUM"), (6, 10, "HIGH"), (0, 0, "NONE")],
)
def test_incident_severity(spark, failed, total, severity):
    report = spark.createDataFrame([("t", "l", failed, total)], "table_name string, layer string, failed long, total_checks long")
    assert ex.incident_severity(report).first().severity == severity
