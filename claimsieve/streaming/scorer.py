"""Score a stream of records with a trained model and a stored provider baseline."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimsieve.functions import scores
from claimsieve.operators import cleansing, scoring
from claimsieve.operators import features as feat
from claimsieve.operators.clusters import CLUSTER, DISTANCE, Centroids, assign
from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params

#: The digest of the raw record, and its day, by which the target is partitioned.
RECORD, DAY = "_record", "_day"


def read_files(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder (or one matching a pattern) as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def record_key(columns: list[tuple[str, str]]) -> Column:
    """A digest of all columns of a raw record; equal for rows that a de-duplication takes as equal.

    128 bits of SHA-256 as bytes: it goes through every exchange and file beside the record, and doesn't compress.
    """
    same_zero = [(F.col(c) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c) for c, kind in columns]
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*same_zero), {"ignoreNullFields": "false"}), 256), 1, 32))


def clean_stream(
    records: DataFrame, params: Params = DEFAULTS, cols: Columns = CLAIMS, period: str = "yyyy-MM-dd"
) -> DataFrame:
    """Cleansed records with the digest of the raw one and its day (or month, by ``period``); copies are left to the writer.

    No state and no watermark: a file that arrives late loses nothing.
    """
    cap = F.lit(float(params.max_billed_amount))
    kept = cleansing.drop_invalid_code(records, params.invalid_diagnosis_code, cols.code).filter(
        (F.col(cols.amount) > -cap) & (F.col(cols.amount) < cap)
    )
    day = F.coalesce(F.date_format(cols.event_time, period), F.lit("none"))
    return (
        kept.withColumn(RECORD, record_key(records.dtypes))
        .withColumn(DAY, day)
        .transform(cleansing.impute_code, params.default_diagnosis_code, cols.code)
        .transform(cleansing.absolute_amounts, cols.amount)
    )


def score_stream(
    clean: DataFrame,
    baseline: DataFrame,
    centroids: Centroids,
    anomaly_label: int | None,
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    small: bool = False,
) -> DataFrame:
    """Features against the stored baseline, then cluster, flag, confidence and level.

    Scale and anomaly cluster are the trained ones (``centroids`` must carry its scale): a stream
    has no whole table to take them from.
    """
    if not centroids.means:
        raise ValueError("scoring a stream needs centroids with the scale of the training rows")
    built = (
        feat.attach_baseline(clean, baseline, cols, small)
        .transform(feat.add_ratio, cols, params)
        .transform(feat.add_z_score, cols)
        .transform(feat.add_above_k, params.std_threshold)
        .transform(cleansing.drop_incomplete)
    )
    flag = scores.anomaly_flag(
        F.col(CLUSTER), F.lit(anomaly_label).cast("int"), F.col(scoring.RATIO), params.anomaly_ratio_threshold
    )
    return (
        assign(built, centroids)
        .drop(DISTANCE)
        .withColumn(scoring.FLAG, flag)
        .transform(scoring.add_confidence, params)
        .transform(scoring.add_risk_level, params)
    )


#: Rows of a day that one task compares and writes; a larger day is dealt over several, by digest.
DAY_ROWS = 250_000
_KNOWN, _NTH, _SLOT, _SLOTS = "_known", "_nth", "_slot", "_slots"


def day_sizes(rows: DataFrame) -> dict[str, int]:
    """How many rows each day has."""
    return {r[DAY]: r["count"] for r in rows.groupBy(DAY).count().collect()}


def _dealt(rows: DataFrame, sizes: dict[str, int]) -> tuple[DataFrame, list[str]]:
    """The rows exchanged by day, or by day and slots of a day where one is large, and the columns they lie by.

    Said in full, as a batch of a stream is planned without adaptive execution, which would have to follow a hint.
    A slot that were the same for all rows would be dropped from a grouping, which then would be exchanged again.
    """
    large = [(day, 1 + n // DAY_ROWS) for day, n in sizes.items() if n > DAY_ROWS]
    if not large:
        return rows.repartition(DAY), [DAY]
    slots = rows.sparkSession.createDataFrame(large, f"{DAY} string, {_SLOTS} long")
    rows = rows.join(F.broadcast(slots), DAY, "left")
    rows = rows.withColumn(_SLOT, F.pmod(F.xxhash64(RECORD), F.coalesce(_SLOTS, F.lit(1)))).drop(_SLOTS)
    return rows.repartition(DAY, _SLOT), [DAY, _SLOT]


def append_new(
    rows: DataFrame,
    known: DataFrame | None,
    target: str,
    sizes: dict[str, int],
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append the records that are not among the ``known`` ones, each once, as ``finish`` makes them.

    Copies are found, records compared and files written after one exchange, by day and slots of a day. A ``finish``
    that needs no exchange (columns, filters, joins with a broadcast table) works on the new records where they lie.
    """
    held, columns = rows.withColumn(_KNOWN, F.lit(False)), rows.columns
    if known is not None:
        held = held.unionByName(known.select(RECORD, DAY).withColumn(_KNOWN, F.lit(True)), allowMissingColumns=True)
    dealt, lie_by = _dealt(held, sizes)
    # One sort and no buffers of texts, as first() would need; the rows then lie as the writer wants them.
    nth = F.row_number().over(Window.partitionBy(*lie_by, RECORD).orderBy(F.col(_KNOWN).desc()))
    new = dealt.withColumn(_NTH, nth).where((F.col(_NTH) == 1) & ~F.col(_KNOWN)).select(*columns)
    (finish(new) if finish else new).write.mode("append").option("compression", "zstd").partitionBy(DAY).parquet(target)


def write_new(
    stream: DataFrame, target: str, progress: str, finish: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Process what has arrived, append every raw record to ``target`` once, stop.

    A batch is compared with the stored records of its own days only: the target is partitioned by
    day, so the comparison reads those folders and two columns. Copies that arrive in any order, in
    any number of runs, are found; a repeated batch appends nothing. What ``finish`` adds to a record
    is added to new ones only, after copies are gone, so that it is neither kept nor exchanged.
    """
    schema = stream.schema
    marks = T.StructType([schema[RECORD], schema[DAY]])

    def append(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            sizes, known = day_sizes(batch), None  # of one batch
            if sizes and _exists(batch.sparkSession, target):
                known = read_target(batch.sparkSession, target, marks, keep=True).filter(F.col(DAY).isin(list(sizes)))
            if sizes:
                append_new(batch.select(*schema.names), known, target, sizes, finish)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


#: Marks of the stateful writer: the run and batch that wrote a row, whether it came late, when the state saw it.
BATCH, LATE, SEEN_AT = "_batch", "_late", "_seen_at"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Counting the rows of the state would look up every digest once more.
STATE_SETTINGS = {STATE_STORE: ROCKS_DB, "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def write_new_by_state(stream: DataFrame, target: str, progress: str, event_time: str, delay_seconds: int) -> StreamingQuery:
    """As :func:`write_new`, but copies of recent records are found in streaming state, without reading the target.

    Recent is what is at most ``delay_seconds`` older than the newest record of earlier runs: its
    digests are in the state, which forgets them when they are no longer recent. Only a record that comes later
    than that, or has no time, is compared with the stored records of its own day. A run is one
    batch, as the bound between recent and late is fixed when it starts. A batch that is repeated
    replaces its own files, so every record is stored once.
    """
    spark = stream.sparkSession
    schema = stream.schema
    name, bound = _note(spark, progress)
    known = F.lit(bound).cast("timestamp")  # NULL before the first run
    when = F.col(event_time)
    # Without a progress nothing of a filled target is in the state: all of it counts as late.
    late = when.isNull() | (when < known if bound is not None else F.lit(_exists(spark, target)))
    seen_at = F.coalesce(F.greatest(when, known), F.lit("1900-01-01 00:00:00").cast("timestamp"))
    marked = stream.withColumn(LATE, late).withColumn(SEEN_AT, seen_at)
    once = marked.withWatermark(SEEN_AT, f"{delay_seconds} seconds").dropDuplicatesWithinWatermark([RECORD])

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        try:
            own = f"{name}-{number}"
            found = batch.groupBy(DAY).agg(F.count(F.lit(1)), F.max(SEEN_AT), F.max(LATE)).collect()  # the days of one batch
            if not found:
                return
            newest, days = max(r[2] for r in found), [r[0] for r in found if r[3]]
            new = batch
            if days and _exists(session, target):
                stored = session.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(target)
                stored = stored.where(F.col(DAY).isin(days) & (F.col(BATCH) != own)).select(F.col(RECORD).alias(_KNOWN))
                # One use of the batch: in a union with itself Spark doesn't know it as cached, and runs join and state again.
                # Records of one digest have one day; by the digest alone the batch lies as the state left it.
                new = batch.join(stored, (F.col(RECORD) == F.col(_KNOWN)) & F.col(LATE), "left_anti")
            rows = _dealt(new.select(*schema.names), {r[0]: r[1] for r in found})[0].drop(_SLOT).withColumn(BATCH, F.lit(own))
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(DAY, BATCH).parquet(target)
            reached = (newest - timedelta(seconds=delay_seconds)).isoformat(" ")
            _note(session, progress, name, reached if bound is None else max(reached, bound))
        finally:
            batch.unpersist()

    before = {setting: spark.conf.get(setting, None) for setting in STATE_SETTINGS}
    for setting, value in STATE_SETTINGS.items():
        spark.conf.set(setting, value)
    try:
        return once.writeStream.foreachBatch(append).option("checkpointLocation", progress).trigger(once=True).start()
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value) if value else spark.conf.unset(setting)


def _note(spark: SparkSession, progress: str, name: str | None = None, bound: str | None = None) -> tuple[str, str | None]:
    """The name of a progress and the bound between late and recent records, kept beside it; with a name it is written."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{progress.rstrip('/')}-bound")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if name is None:
        begun = _exists(spark, progress)
        if not begun or not files.exists(path):
            return uuid.uuid4().hex, None
        held = files.open(path)
        found = jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        held.close()
        name, _, bound = found.partition("\n")
        return name, bound
    out = files.create(path, True)
    out.write(bytearray(f"{name}\n{bound}".encode()))
    out.close()
    return name, bound


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_target(spark: SparkSession, target: str, schema: T.StructType, keep: bool = False) -> DataFrame:
    """The stored records, without the digest and the day unless ``keep``."""
    stored = spark.read.schema(schema).parquet(target).select(*schema.names)
    return stored if keep else stored.drop(RECORD, DAY)
