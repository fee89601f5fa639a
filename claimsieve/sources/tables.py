"""Scans, sinks and intermediate tables."""

from __future__ import annotations

import uuid
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def full_table_name(table: str, database: str | None = None, catalog: str = "spark_catalog", schema: str = "default") -> str:
    """catalog.schema.table, or database.table when a database is given."""
    return f"{database}.{table}" if database is not None else f"{catalog}.{schema}.{table}"


def scan(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A path (anything with a slash) or a catalog table; a missing one raises AnalysisException."""
    return spark.read.format(fmt).load(name) if "/" in name else spark.read.table(name)


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of objects (inferred types) or CSV with a header (all strings)."""
    suffix = PurePath(path).suffix
    if suffix == ".json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == ".csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"no reader for {suffix or 'a path without suffix'}: {path}")


CORRUPT = "_corrupt_record"


def read_rescued(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a JSON or CSV file or folder under a declared schema, from one read.

    A record that does not parse, has a value of another type, or too few or too many fields (CSV) is
    set aside whole: its text and its file. Both parts are written once, so neither reads the files again.
    JSON has a record a line, or with ``multi_line`` one array or object a file, which is then good or bad as a whole.
    """
    suffix = PurePath(path).suffix
    if suffix not in (".json", ".csv"):
        raise ValueError(f"no reader for {suffix or 'a path without suffix'}: {path}")
    held = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(held).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if suffix == ".json":
        found = reader.option("multiLine", multi_line).json(path)
    else:
        found = reader.option("header", True).csv(path)
    kept = stage(found.withColumn("_file", F.input_file_name()), "rescued")
    good = kept.where(F.col(CORRUPT).isNull()).select(*schema.names)
    return good, kept.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), F.col("_file").alias("file"))


def newest_values(spark: SparkSession, folder: str, column: str, n: int = 1) -> list[str]:
    """The last ``n`` values of a partition column in text order, from the names of the folders: no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in files.listStatus(path) if x.isDirectory()]
    return sorted(x.removeprefix(f"{column}=") for x in names if x.startswith(f"{column}=") and "__HIVE_DEFAULT" not in x)[-n:]


def write_layer(
    df: DataFrame,
    name: str,
    overwrite: bool = True,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write a layer to a path or a catalog table.

    With ``partition_by`` the rows are first rebalanced on those columns: one directory then
    gets a few full files instead of one small file per task, and adaptive execution splits a
    value that holds too many rows for one task over several.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode("overwrite" if overwrite else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(name) if "/" in name else writer.saveAsTable(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the checkpoint folder, or else a folder of the warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    return folder.rstrip("/") if folder else f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_stages"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a written table in the shared folder and read it back.

    The copy is columnar, survives lost executors, prunes columns for later readers and
    has a known size, so that joins against it are planned on facts.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def publish(staged: DataFrame, folder: str, table: str, fmt: str = "parquet") -> None:
    """Make an already written folder the content of a catalog table without copying a row.

    With changed columns a new table takes the name. The old one is set aside until then and comes
    back if that fails.
    """
    spark = staged.sparkSession
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=folder, source=fmt, schema=staged.schema)
        return
    if spark.table(table).dtypes == staged.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return
    fresh = f"{table}_{uuid.uuid4().hex}"
    spare = f"{table}_old_{uuid.uuid4().hex}"
    spark.catalog.createTable(fresh, path=folder, source=fmt, schema=staged.schema)
    spark.sql(f"ALTER TABLE {table} RENAME TO {spare}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {spare} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {spare}")


def replace_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Give a written folder the name of a layer; what was there is set aside until the new one is in place."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    spare = path(f"{target.rstrip('/')}-{uuid.uuid4().hex}")
    had = files.exists(path(target))
    if had and not files.rename(path(target), spare):
        raise OSError(f"{target} cannot be set aside")
    if not files.rename(path(folder), path(target)):
        if had:
            files.rename(spare, path(target))
        raise OSError(f"{target} cannot be replaced")
    if had:
        files.delete(spare, True)


def replace_days(written: str, target: str, day: str, spark: SparkSession) -> list[str]:
    """Give the written folders of some days the place of the target's; other days' files are not touched.

    What was there is set aside and comes back if a later day fails. Returns the days.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [x.getPath().getName() for x in files.listStatus(path(written)) if x.isDirectory()]
    names = sorted(n for n in listed if n.startswith(f"{day}="))
    spare = f"{target.rstrip('/')}-{uuid.uuid4().hex}"
    files.mkdirs(path(target))
    files.mkdirs(path(spare))
    moved: list[tuple[str, bool]] = []
    try:
        for name in names:
            had = files.exists(path(f"{target}/{name}"))
            if had and not files.rename(path(f"{target}/{name}"), path(f"{spare}/{name}")):
                raise OSError(f"{target}/{name} cannot be set aside")
            moved.append((name, had))
            if not files.rename(path(f"{written}/{name}"), path(f"{target}/{name}")):
                raise OSError(f"{target}/{name} cannot be replaced")
    except Exception:
        for name, had in reversed(moved):
            files.delete(path(f"{target}/{name}"), True)
            if had:
                files.rename(path(f"{spare}/{name}"), path(f"{target}/{name}"))
        raise
    finally:
        if all(files.exists(path(f"{target}/{name}")) for name, _ in moved):
            files.delete(path(spare), True)
    return [n.removeprefix(f"{day}=") for n in names]


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """A catalog table whose rows lie in buckets by ``key``, sorted by it: one exchange, when writing.

    Aggregations by the key and joins on it with tables of as many buckets then read it without another.
    All rows of a key are in one bucket, which one task reads; see :func:`hot_share`.
    """
    writer = df.repartition(buckets, key).write.format(fmt).mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.read.table(table)


def hot_share(counts: DataFrame, n_rows: str) -> float:
    """The largest key's share of all rows, from one row a key. Buckets suit keys whose share is below that of a task."""
    row = counts.agg(F.try_divide(F.max(n_rows), F.sum(n_rows)).alias("share")).first()
    return float(row["share"] or 0.0)


def key_count_at_most(df: DataFrame, key: str, limit: int) -> bool:
    """Does ``key`` take at most ``limit`` values? One scan of one column; decides on broadcasts."""
    seen = df.agg(F.approx_count_distinct(key, 0.02).alias("n")).first()["n"]
    return seen * 1.1 <= limit


def sample_rows(df: DataFrame, order: tuple[str, ...], columns: tuple[str, ...], n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order (a top-n plan: no full sort)."""
    return df.orderBy(*order).select(*columns).limit(n)
