import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimsieve.operators import cleansing
from claimsieve.operators import features as feat
from claimsieve.plans import catalogue, increments
from claimsieve.plans.increments import Store
from claimsieve.sources import tables
from claimsieve.streaming.scorer import DAY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    """The claims of the small table, within forty days."""
    day = F.pmod(F.xxhash64("claim_id"), F.lit(40))
    return catalogue.bronze(spark, SMALL).withColumn("service_ts", F.timestamp_seconds(F.lit(794_016_000) + day * 86_400 + 7)).persist()


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def delivered(spark, raw, tmp_path_factory):
    """Three deliveries: most rows, the rest with some of the first again, and a few days of nothing new."""
    folder = tmp_path_factory.mktemp("store")
    store = Store(str(folder / "silver"), str(folder / "moments"))
    key = F.xxhash64("claim_id") % 10
    increments.deliver(spark, raw.filter(key != 3), store)
    increments.deliver(spark, raw.filter((key == 3) | (key == 1)), store)
    again = increments.deliver(spark, raw.filter(F.to_date("service_ts").between("1995-03-02", "1995-03-04")), store)
    assert again == ["1995-03-02", "1995-03-03", "1995-03-04"]
    return store


def test_deliveries_give_the_baseline_of_one_batch(spark, raw, delivered):
    whole = feat.provider_baseline(cleansing.cleanse(raw))
    assert rows_of(increments.baseline(spark, delivered).select(whole.columns)) == rows_of(whole)
    days = [r[0] for r in increments.stored(spark, delivered.silver).select(DAY).distinct().collect()]
    built = increments.features_of_days(spark, delivered, days)
    batch = feat.features(cleansing.cleanse(raw))
    assert rows_of(built.select(batch.columns)) == rows_of(batch)


def test_other_days_are_neither_read_nor_written(spark, raw, delivered):
    day = "1995-03-06"
    one = raw.filter(F.date_format("service_ts", "yyyy-MM-dd") == day).withColumn("claim_status", F.lit("APPEALED"))
    before = files_of(delivered.moments) | files_of(delivered.silver)
    assert increments.deliver(spark, one, delivered) == [day]
    after = files_of(delivered.moments) | files_of(delivered.silver)
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed and all(f"{DAY}={day}" in f for f in changed)
    touched = increments.stored(spark, delivered.silver).where(F.col(DAY).isin([day]))
    plan = feat.moments(touched, ("hospital_id", DAY))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_day", plan)
    plan = increments.baseline(spark, delivered)._jdf.queryExecution().executedPlan().toString()
    assert "moments" in plan and "claim_id" not in plan


def test_a_failed_check_changes_no_day(spark, tmp_path):
    target = str(tmp_path / "layer")
    rows = spark.range(30).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias(DAY))
    check = lambda df: cleansing.violation_rows(df, {"no_big_id": F.col("id") > 1000})
    assert increments.store_days(rows, target, check) == ["d0", "d1", "d2"]
    before = files_of(target)
    with pytest.raises(ValueError, match="no_big_id"):
        increments.store_days(spark.createDataFrame([(2000, "d1"), (5, "d2")], f"id long, {DAY} string"), target, check)
    assert files_of(target) == before
    assert increments.store_days(spark.createDataFrame([(7, "d1"), (8, "d9")], f"id long, {DAY} string"), target, check) == ["d1", "d9"]
    got = sorted((r.id, r[DAY]) for r in increments.stored(spark, target).collect() if r[DAY] in ("d1", "d9"))
    assert got == [(7, "d1"), (8, "d9")]
    assert {f for f in files_of(target) if f"{DAY}=d0" in f or f"{DAY}=d2" in f} <= set(before)
    assert increments.store_days(rows.limit(0), target, check) == []


def test_moments_that_no_rows_can_have_are_refused(spark):
    moments = spark.createDataFrame(
        [("H", "d", 2, 10, Decimal(20), 9.0, 1.0, 2)],
        f"hospital_id string, {DAY} string, _n long, _s long, _q decimal(38,0), {feat.LOW} double, {feat.HIGH} double, {feat.COUNT} long",
    )
    assert {r.check_name: r.ok for r in increments.moment_checks(moments).collect()} == {
        "edges_in_order": False, "spread_not_negative": False, "amounts_without_sum": True,
    }


def test_nothing_delivered(spark, raw, tmp_path):
    store = Store(str(tmp_path / "silver"), str(tmp_path / "moments"))
    assert increments.deliver(spark, raw.limit(0), store) == []
    with pytest.raises(ValueError, match="nothing was delivered"):
        increments.baseline(spark, store)


def test_bucketed_layers_need_no_exchange_of_the_records(spark, raw):
    clean = tables.write_bucketed(cleansing.cleanse(raw), "silver_by_hospital", "hospital_id", 8)
    assert tables.hot_share(clean.groupBy("hospital_id").count(), "count") < 0.5
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in off:
        spark.conf.set(key, "-1")
    try:
        built = feat.features(clean, bucketed=True)
        rows = rows_of(built)
        plan = built._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    finally:
        for key in off:
            spark.conf.unset(key)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert rows == rows_of(feat.features(cleansing.cleanse(raw)).select(built.columns))
