"""Deliveries: new rows change the stored days they belong to, and the baseline, without reading other days.

The silver layer and the moments of the amounts are stored by day. A delivery is cleansed, its rows
compared with the stored ones of its own days by a digest of the raw record, and what is new
appended. Then the moments of those days are taken again and put in place of the old ones, behind
a check. A baseline is the sum of all days' moments, one row a provider and day, in whole numbers:
deliveries in any order and number give what one batch gives. A delivery that failed half way is
delivered again: rows that are stored are not appended twice, and its days' moments are taken from the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.functions.money import CENTS
from claimsieve.operators import features as feat
from claimsieve.operators.cleansing import violation_rows
from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params
from claimsieve.sources.tables import new_folder, replace_days, write_layer
from claimsieve.streaming.scorer import DAY, RECORD, append_new, clean_stream, day_sizes


@dataclass(frozen=True)
class Store:
    """Folders, partitioned by day, of the cleansed records and of their moments."""

    silver: str
    moments: str


def stored(spark: SparkSession, folder: str) -> DataFrame | None:
    """A stored layer with its day as text, or None before the first delivery."""
    try:
        found = spark.read.option("mergeSchema", "false").parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return found.withColumn(DAY, F.col(DAY).cast("string"))


def store_days(df: DataFrame, target: str, check: Callable[[DataFrame], DataFrame], day: str = DAY) -> list[str]:
    """Write the days of ``df`` once, check them, put them in place of the target's; a failed check changes nothing.

    ``check`` gives rows (check_name, ok).
    """
    spark = df.sparkSession
    folder = new_folder(spark, "days")
    write_layer(df, folder, partition_by=(day,))
    written = stored(spark, folder)
    if written is None:
        return []
    broken = [r["check_name"] for r in check(written).filter(~F.col("ok")).collect()]
    if broken:
        raise ValueError(f"{target} not changed, failed checks: " + ", ".join(broken))
    return replace_days(folder, target, day, spark)


def moment_checks(moments: DataFrame) -> DataFrame:
    """Sums that no rows can have: fewer records than amounts, edges in the wrong order, a negative spread."""
    n, s, q = F.col("_n").cast("decimal(13,0)"), F.col("_s").cast("decimal(19,0)"), F.col("_q")
    rules = {
        "edges_in_order": F.coalesce(F.col(feat.LOW) > F.col(feat.HIGH), F.lit(False)),
        "spread_not_negative": F.coalesce(n * q < s * s, F.lit(False)),
        "amounts_without_sum": (F.col("_n") > 0) & F.col("_s").isNull(),
    }
    return violation_rows(moments, rules)


def deliver(
    spark: SparkSession, rows: DataFrame, store: Store, params: Params = DEFAULTS, cols: Columns = CLAIMS, period: str = "yyyy-MM-dd"
) -> list[str]:
    """Append what is new in a delivery of raw rows and refresh the moments of its days; the days.

    ``period`` makes them months or hours, for all deliveries of a store alike.
    """
    clean = clean_stream(rows, params, cols, period)
    fresh = new_folder(spark, "delivery")
    clean.write.parquet(fresh)  # once: its days, its rows and a retry read the same
    clean = spark.read.schema(clean.schema).parquet(fresh)
    sizes = day_sizes(clean)
    days = sorted(sizes)
    if not days:
        return []
    known = stored(spark, store.silver)
    append_new(clean, None if known is None else known.where(F.col(DAY).isin(days)), store.silver, sizes)
    touched = stored(spark, store.silver).where(F.col(DAY).isin(days))
    store_days(feat.moments(touched, (cols.provider, DAY), cols, CENTS), store.moments, moment_checks)
    return days


def baseline(spark: SparkSession, store: Store, cols: Columns = CLAIMS) -> DataFrame:
    """The baseline of all stored days: reads the moments, not the records."""
    moments = stored(spark, store.moments)
    if moments is None:
        raise ValueError(f"nothing was delivered to {store.moments}")
    return feat.from_moments(feat.added_moments(moments, (cols.provider,)), cols, CENTS)


def features_of_days(spark: SparkSession, store: Store, days: list[str], params: Params = DEFAULTS, cols: Columns = CLAIMS,
                     small: bool = False) -> DataFrame:
    """The features of the records of some days against the baseline of all: reads these days' records only."""
    records = stored(spark, store.silver).where(F.col(DAY).isin(days)).drop(RECORD, DAY)
    joined = feat.attach_baseline(records, baseline(spark, store, cols), cols, small)
    return (
        joined.transform(feat.add_ratio, cols, params).transform(feat.add_z_score, cols).transform(feat.add_above_k, params.std_threshold)
    )
