"""Threshold rules over the layers: each returns value and alert as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.operators.cleansing import cleansing_metrics
from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params


def retention_check(
    bronze: DataFrame,
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    low: float = 0.80,
    high: float = 0.95,
) -> DataFrame:
    """Share of raw rows that survive cleansing; alert below ``low`` or above ``high``.

    Both counts come from the one cleansing-metrics pass.
    """
    return _retention(cleansing_metrics(bronze, params, cols), low, high)


def stored_retention_check(bronze: DataFrame, silver: DataFrame, low: float = 0.80, high: float = 0.95) -> DataFrame:
    """The same over two stored layers: two counts that a columnar file answers from its footers."""
    counts = bronze.agg(F.count(F.lit(1)).alias("initial_count")).withColumn(
        "final_count", silver.agg(F.count(F.lit(1))).scalar()
    )
    return _retention(counts, low, high)


def _retention(counts: DataFrame, low: float, high: float) -> DataFrame:
    kept = F.try_divide(F.col("final_count"), F.col("initial_count"))
    return counts.select(
        F.col("initial_count").alias("bronze_count"),
        F.col("final_count").alias("silver_count"),
        kept.alias("retention"),
        ((kept < low) | (kept > high)).alias("alert"),
    )


def anomaly_rate_check(gold: DataFrame, threshold: float = 0.10) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.count_if("is_anomaly"), F.count(F.lit(1))), F.lit(0.0))
    return gold.agg(rate.alias("anomaly_rate")).withColumn("alert", F.col("anomaly_rate") > threshold)


def null_share_check(features: DataFrame, columns: tuple[str, ...], threshold: float = 0.01) -> DataFrame:
    """Share of NULLs per feature column: one aggregation, one row per column."""
    counts = features.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_null_{c}").alias("nulls"),
            F.coalesce(F.try_divide(F.col(f"_null_{c}"), F.col("_n")), F.lit(0.0)).alias("null_share"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn("alert", F.col("null_share") > threshold)


def silhouette_check(metrics: DataFrame, column: str = "silhouette", target: float = 0.5, alert: float = 0.3) -> DataFrame:
    """On target above ``target``, alert below ``alert``."""
    value = F.col(column)
    return metrics.select(
        value.alias("silhouette"), (value > target).alias("on_target"), (value < alert).alias("alert")
    )
