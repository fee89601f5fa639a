import pytest
from pyspark.sql import functions as F

from claimsieve.operators import cleansing
from claimsieve.plans import medallion
from claimsieve.plans.medallion import Layers
from claimsieve.sources import claims, tables


@pytest.fixture(scope="module")
def raw(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    return claims.claims_from_line_items(read("lineitem"), read("orders"))


@pytest.mark.parametrize("kind", ["tables", "paths"])
def test_bronze_to_gold(spark, raw, tmp_path, kind):
    names = ("bronze", "silver", "features", "gold", "metrics")
    layers = Layers(*[f"run_{n}" for n in names]) if kind == "tables" else Layers(*[str(tmp_path / n) for n in names])
    tables.write_layer(raw, layers.bronze)
    gold = medallion.run(spark, layers, str(tmp_path / "model"))
    assert gold.count() == tables.scan(spark, layers.features).na.drop().count() > 0
    assert set(r[0] for r in gold.select("risk_level").distinct().collect()) <= {"HIGH", "MEDIUM", "LOW", "REVIEW", "NORMAL"}
    assert gold.filter("is_anomaly AND amount_to_avg_ratio <= 1.1").isEmpty()
    assert tables.scan(spark, layers.metrics).first().n_clusters == 3
    # A second run replaces the layers and appends to the metrics.
    medallion.run(spark, layers, str(tmp_path / "model"))
    assert tables.scan(spark, layers.silver).count() == cleansing.cleanse(raw).count()
    assert tables.scan(spark, layers.metrics).count() == 2


def test_failed_check_keeps_the_old_layer(spark, raw, sample):
    layers = Layers("gate_bronze", "gate_silver", "gate_features", "gate_gold", "gate_metrics")
    tables.write_layer(raw, layers.bronze)
    before = medallion.to_silver(spark, layers).count()
    tables.write_layer(sample, layers.bronze)
    with pytest.raises(ValueError, match="empty_code"):
        medallion.to_silver(spark, layers, compat=True)
    assert tables.scan(spark, layers.silver).count() == before
    medallion.to_silver(spark, layers)
    assert tables.scan(spark, layers.silver).count() == 6


def test_feature_gate(spark, claim_frame):
    layers = Layers("zero_bronze", "zero_silver", "zero_features", "zero_gold", "zero_metrics")
    tables.write_layer(claim_frame([("A", "P", None, "I", 1.0, "S"), ("B", "P", "H", "I", 2.0, "S")]), layers.silver)
    with pytest.raises(ValueError, match="null_ratio"):
        medallion.to_features(spark, layers)
    assert not spark.catalog.tableExists(layers.features)


def counted(df, seen):
    """The same rows; ``seen`` counts how often one is read."""

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(look, df.schema)


def test_checks_and_metrics_are_counted_while_writing(spark, raw, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    layers = Layers(*[str(tmp_path / n) for n in ("bronze", "silver", "features", "gold", "metrics")])
    tables.write_layer(raw, layers.bronze)
    monkeypatch.setattr(medallion, "scan", lambda s, name: counted(tables.scan(s, name), seen) if name == layers.bronze else tables.scan(s, name))
    stored, metrics = medallion.silver_with_metrics(spark, layers, expect=True)
    assert seen.value == raw.count()
    assert metrics == cleansing.cleansing_metrics(raw).first().asDict()
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, cleansing.cleanse(raw).collect()))


def test_expectations_of_the_raw_rows_keep_silver_from_being_published(spark, claim_frame):
    layers = Layers("expect_bronze", "expect_silver", "expect_features", "expect_gold", "expect_metrics")
    rows = [("A", "P", "H", "I10", None, "S"), ("A", "P", "H", "I10", None, "S"), ("B", "P", "H", "I10", 2.0, "S")]
    tables.write_layer(claim_frame(rows), layers.bronze)
    with pytest.raises(ValueError, match="billed_amount_populated"):
        medallion.run(spark, layers, "unused")
    assert not spark.catalog.tableExists(layers.silver)
    medallion.to_silver(spark, layers)
    assert tables.scan(spark, layers.silver).count() == 1
    tables.write_layer(claim_frame(rows).drop("billed_amount"), "narrow_bronze")
    for name, problem in (("narrow_bronze", "required_columns_exist"), ("no_such_bronze", "table_exists")):
        with pytest.raises(ValueError, match=problem):
            medallion.run(spark, Layers(name, "narrow_silver"), "unused")


def test_gold_needs_a_model(spark, tmp_path):
    with pytest.raises(ValueError, match="no model"):
        medallion.to_gold(spark, Layers(), str(tmp_path / "production"), str(tmp_path / "staging"))


def test_partitioned_gold_reports(spark, raw, tmp_path):
    dated = raw.withColumn("service_ts", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("claim_id"), F.lit(10**6))))
    path = str(tmp_path / "dated")
    tables.write_layer(dated.withColumn("day", F.to_date("service_ts")), path, partition_by=("day",))
    assert tables.scan(spark, path).count() == raw.count() > 0
