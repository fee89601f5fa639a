"""What the plans look like: where they scan, shuffle, broadcast and run Python."""

import re

import pytest
from pyspark.sql import functions as F

from claimsieve.operators import cleansing, scoring
from claimsieve.operators import features as feat
from claimsieve.plans import catalogue

SMALL = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def test_no_python_in_the_checked_queries(spark):
    for name in ("silver_claims", "features", "gold_fixed_centroids", "silhouette_sq", "expectation_report"):
        plan = catalogue.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
        assert "CartesianProduct" not in plan and "Join Cross" not in plan, name


def test_silver_shuffles_the_records_once(spark):
    plan = final_plan(catalogue.silver(spark, SMALL))
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 1
    assert plan.count("FileScan parquet") == 2


def test_features_share_the_exchange_of_the_records(spark):
    plan = final_plan(catalogue.features(spark, SMALL))
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 2
    assert "BroadcastHashJoin [coalesce(hospital_id" in plan


def test_many_providers_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        clean = catalogue.silver(spark, SMALL)
        built = feat.features(clean, small=False)
        assert "SortMergeJoin" in final_plan(built)
        assert built.count() == clean.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def lines_that_ran(df):
    """The final part of the adaptive plan and of its subqueries."""
    df.collect()
    lines, depth = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        indent = len(line) - len(line.lstrip(" :+-*"))
        if depth is not None and indent <= depth:
            depth = None
        if "== Initial Plan ==" in line and depth is None:
            depth = indent - 3
            continue
        if depth is None:
            lines.append(line)
    return lines


def test_gold_reads_the_raw_rows_once_and_shares_their_exchanges(spark):
    for df in (scoring.gold(catalogue.features(spark, SMALL), catalogue.BAND), catalogue.queries()["gold_fixed_centroids"](spark, SMALL)):
        lines = lines_that_ran(df)
        assert sum("FileScan parquet [l_" in line for line in lines) == 1
        assert sum("ReusedExchange" in line for line in lines) >= 4


def test_all_expectations_read_the_raw_rows_once(spark):
    lines = lines_that_ran(catalogue.queries()["expectation_report"](spark, SMALL))
    assert sum("FileScan parquet [l_" in line for line in lines) == 1
    assert sum("ReusedExchange" in line for line in lines) >= 2


def test_amount_range_reaches_the_file_scan(spark, sample, tmp_path):
    path = str(tmp_path / "claims")
    sample.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = cleansing.cleanse(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(billed_amount,-50000.0)" in plan and "LessThan(billed_amount,50000.0)" in plan


def test_baseline_reads_only_its_columns(spark, sample, tmp_path):
    path = str(tmp_path / "claims")
    sample.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = feat.provider_baseline(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"ReadSchema: struct<claim_id:string,hospital_id:string,billed_amount:double>", plan)
    assert "partial_sum" in plan and "partial_count" in plan


def test_adaptive_execution_is_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


@pytest.mark.parametrize("small", [True, False])
def test_a_hot_provider_with_copies_keeps_every_row(spark, small):
    rows = spark.range(0, 60_000, numPartitions=8)
    df = rows.select(
        F.concat(F.lit("C"), F.col("id") % 50_000).alias("claim_id"),
        F.lit("P").alias("patient_id"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("H"), F.col("id") % 97)).alias("hospital_id"),
        F.lit("I10").alias("diagnosis_code"),
        (F.col("id") % 50_000 / 100).alias("billed_amount"),
        F.lit("PENDING").alias("claim_status"),
    )
    copies = df.unionAll(df.filter("hospital_id = 'HOT'"))
    built = feat.features(cleansing.cleanse(copies), small=small)
    assert built.count() == df.distinct().count()
    hot = built.filter("hospital_id = 'HOT'").select("hosp_claim_count").distinct().collect()
    assert [r[0] for r in hot] == [df.filter("hospital_id = 'HOT'").distinct().count()]
    assert built.filter("hospital_id IS NULL AND hosp_avg_billed IS NOT NULL").isEmpty()


def test_a_hot_provider_is_split_when_the_baseline_is_not_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.shuffle.partitions": "16",
    }
    rows = spark.range(0, 120_000, numPartitions=8)
    df = rows.select(
        F.sha2(F.col("id").cast("string"), 256).alias("claim_id"),
        F.lit("P").alias("patient_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("H"), F.col("id") % 997)).alias("hospital_id"),
        F.lit("I10").alias("diagnosis_code"),
        (F.col("id") % 40_000 / 100).alias("billed_amount"),
        F.lit("PENDING").alias("claim_status"),
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        built = feat.features(cleansing.cleanse(df), small=False).agg(
            F.count(F.lit(1)).alias("n"), F.sum("hosp_claim_count").alias("s"), F.max("claim_id").alias("wide")
        )
        plan = final_plan(built)
        row = built.first()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin(skew=true)" in plan
    want = df.groupBy("hospital_id").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert (row.n, row.s) == (120_000, want)
