import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsieve.session import cluster_settings
from claimsieve.sources import claims, tables


def test_schema():
    fields = {f.name: (f.dataType.simpleString(), f.nullable) for f in claims.CLAIM_SCHEMA.fields}
    assert fields["claim_id"] == ("string", False) and fields["patient_id"] == ("string", False)
    assert fields["billed_amount"] == ("double", True) and len(fields) == 6


def test_fixture_readers(spark, tmp_path):
    rows = [{"claim_id": "A", "billed_amount": 1.5}, {"claim_id": "B", "billed_amount": None}]
    (tmp_path / "c.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "c.csv").write_text("claim_id,billed_amount\nA,1.5\nB,2\n")
    assert dict(tables.read_fixture(spark, str(tmp_path / "c.json")).dtypes)["billed_amount"] == "double"
    csv = tables.read_fixture(spark, str(tmp_path / "c.csv"))
    assert set(dict(csv.dtypes).values()) == {"string"} and csv.count() == 2
    with pytest.raises(ValueError, match=".xml"):
        tables.read_fixture(spark, str(tmp_path / "c.xml"))


def test_bad_records_are_set_aside(spark, tmp_path):
    schema = T.StructType([T.StructField("claim_id", T.StringType()), T.StructField("billed_amount", T.DoubleType())])
    lines = ['{"claim_id": "A", "billed_amount": 1.5}', '{"claim_id": "B", "billed_amount": "much"}', '{"claim_id": "C"', '{"claim_id": "D"}']
    (tmp_path / "c.json").write_text("\n".join(lines))
    (tmp_path / "c.csv").write_text("claim_id,billed_amount\nA,1.5\nB,much\nC,2,3\nD\nE,\n")
    (tmp_path / "whole.json").write_text('[{"claim_id": "A", "billed_amount": 1}, {"claim_id": "B", "billed_amount": 2}]')
    for name, kept, set_aside in (("c.json", ["A", "D"], lines[1:3]), ("c.csv", ["A", "E"], ["B,much", "C,2,3", "D"])):
        good, bad = tables.read_rescued(spark, str(tmp_path / name), schema)
        assert good.schema.simpleString() == schema.simpleString()
        assert sorted(r.claim_id for r in good.collect()) == kept
        assert sorted(r.record for r in bad.collect()) == set_aside
        assert all(r.file.endswith(name) for r in bad.collect())
        assert good.count() + bad.count() == len(kept) + len(set_aside)
    good, bad = tables.read_rescued(spark, str(tmp_path / "whole.json"), schema, multi_line=True)
    assert good.count() == 2 and bad.count() == 0
    with pytest.raises(ValueError, match=".xml"):
        tables.read_rescued(spark, str(tmp_path / "c.xml"), schema)


def test_table_names():
    assert tables.full_table_name("t", "db") == "db.t"
    assert tables.full_table_name("t", catalog="c", schema="s") == "c.s.t"


def test_sinks(spark, sample, tmp_path):
    path = str(tmp_path / "claims")
    tables.write_layer(sample, path)
    tables.write_layer(sample, path, overwrite=False)
    assert tables.scan(spark, path).count() == 22
    tables.write_layer(sample, path)
    assert tables.scan(spark, path).count() == 11
    tables.write_layer(sample, "sink_table")
    tables.write_layer(sample, "sink_table", overwrite=False)
    assert tables.scan(spark, "sink_table").count() == 22
    with pytest.raises(AnalysisException):
        tables.scan(spark, "missing_table").count()


def test_partitioned_write_prunes(spark, sample, tmp_path):
    path = str(tmp_path / "by_hospital")
    tables.write_layer(sample, path, partition_by=("hospital_id",))
    one = tables.scan(spark, path).filter("hospital_id = 'south'")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hospital_id" in plan
    assert len(list((tmp_path / "by_hospital" / "hospital_id=north").glob("*.parquet"))) == 1


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(0, 400_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("provider"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        path = str(tmp_path / "hot")
        tables.write_layer(hot, path, partition_by=("provider",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "provider=hot").glob("*.parquet"))) > 3
    assert spark.read.parquet(path).count() == 400_000


def test_shared_folder_comes_from_the_session(spark):
    assert tables.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert tables.stage(spark.range(5), "five").count() == 5


def test_publishing_follows_the_schema(spark, sample):
    for i, df in enumerate((sample, sample.limit(2), sample.withColumn("more", F.lit(1)))):
        folder = tables.new_folder(spark, "version")
        df.write.parquet(folder)
        tables.publish(spark.read.parquet(folder), folder, "published")
        got = spark.table("published")
        assert got.columns == df.columns and got.count() == df.count()


def test_cluster_sizes():
    big = cluster_settings(100 << 40, 4000)
    assert big["spark.sql.shuffle.partitions"] == str(100 << 10)
    assert cluster_settings(1, 16)["spark.sql.shuffle.partitions"] == "32"


def test_key_count(spark):
    assert tables.key_count_at_most(spark.range(1000), "id", 5000)
    assert not tables.key_count_at_most(spark.range(1000), "id", 500)
