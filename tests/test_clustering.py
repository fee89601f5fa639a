import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimsieve.plans import catalogue
from claimsieve.sources import clustering


def groups(folder):
    """(column -> (smallest, largest)) of every row group."""
    found = []
    for file in sorted(folder.glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(i) for i in range(meta.num_columns)]
            found.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics and c.statistics.has_min_max})
    return found


def read_share(found, column, value):
    return sum(g[column][0] <= value <= g[column][1] for g in found) / len(found)


@pytest.fixture(scope="module")
def records(spark):
    rows = spark.range(0, 60_000, numPartitions=6)
    return rows.select(
        F.concat(F.lit("H"), F.lpad((F.xxhash64("id") % 500 + 500).cast("string"), 4, "0")).alias("provider"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(360)).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


def test_filters_on_either_column_skip_most_row_groups(spark, records, tmp_path):
    clustering.write_clustered(records, str(tmp_path / "z"), ("day", "provider"), files=64, group_bytes=64 << 10)
    by_day = records.repartitionByRange(64, "day").sortWithinPartitions("day")
    by_day.write.option("parquet.block.size", 64 << 10).parquet(str(tmp_path / "day"))
    z, plain = groups(tmp_path / "z"), groups(tmp_path / "day")
    import datetime

    day, provider = datetime.date(2024, 5, 17), "H0312"
    assert len(z) >= 64
    assert read_share(z, "day", day) < 0.3 and read_share(z, "provider", provider) < 0.3
    assert read_share(plain, "provider", provider) > 0.9
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.columns == records.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, records.collect()))


def test_nulls_few_values_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), (None, 2.0, 2), ("a", 2.0, 3), ("a", 2.0, 3)], "p string, x double, _z int")
    clustering.write_clustered(df, str(tmp_path / "few"), ("p", "x"), files=3)
    back = spark.read.parquet(str(tmp_path / "few"))
    assert back.columns == df.columns and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    clustering.write_clustered(df.limit(0), str(tmp_path / "none"), ("p", "x"), files=2)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0


def test_the_query_reads_back_what_it_filters(spark):
    assert catalogue.queries()["clustered_scan"](spark, "/root/testdata/sf0.001").count() > 0
