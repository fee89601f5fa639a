"""Summaries and top lists over the gold layer."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params
from claimsieve.sources.tables import newest_values

FLAGGED = "is_anomaly"


def _rate() -> Column:
    """Share of flagged rows; a group is never empty."""
    return F.count_if(FLAGGED) / F.count(F.lit(1))


def anomaly_summary(gold: DataFrame) -> DataFrame:
    """Total, flagged and rate (0 for an empty layer)."""
    return gold.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(FLAGGED).alias("anomalies"),
        F.coalesce(F.try_divide(F.count_if(FLAGGED), F.count(F.lit(1))), F.lit(0.0)).alias("anomaly_rate"),
    )


def risk_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_claims"))


def risk_distribution(gold: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    """Rows and mean amount per risk level."""
    return gold.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n_claims"), F.avg(cols.amount).alias("avg_amount")
    )


def daily_anomaly_rate(gold: DataFrame, days: int = 30, cols: Columns = CLAIMS) -> DataFrame:
    """Rate per day, newest days first (one top-n, no full sort)."""
    daily = gold.groupBy(F.to_date(cols.event_time).alias("claim_date")).agg(_rate().alias("anomaly_rate"))
    return daily.orderBy(F.desc("claim_date")).limit(days)


def weekly_anomaly_trend(gold: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    """Rows, anomalies and rate per week (Monday start), newest first."""
    week = F.to_date(F.date_trunc("week", F.col(cols.event_time))).alias("claim_week")
    weekly = gold.groupBy(week).agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(FLAGGED).alias("anomalies"),
        _rate().alias("anomaly_rate"),
    )
    return weekly.orderBy(F.desc("claim_week"))


def top_anomalous_providers(gold: DataFrame, more_than: int = 100, n: int = 10, cols: Columns = CLAIMS) -> DataFrame:
    """Providers with more than ``more_than`` rows by falling rate; the provider id breaks ties."""
    per_provider = gold.groupBy(cols.provider).agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(FLAGGED).alias("anomalies"),
        _rate().alias("anomaly_rate"),
    )
    listed = per_provider.filter(F.col("total_claims") > more_than)
    return listed.orderBy(F.desc("anomaly_rate"), F.asc(cols.provider)).limit(n)


def recent_anomaly_alert(gold: DataFrame, threshold: float = 0.10, cols: Columns = CLAIMS) -> DataFrame:
    """Rate over the last day of the data and whether it exceeds the threshold.

    The reference time is the newest record, never the clock, and reaches the filter as a
    scalar subquery; on a stored layer it becomes a pushed-down range.
    """
    when = F.col(cols.event_time)
    newest = gold.agg(F.max(when)).scalar()
    recent = gold.filter(when >= newest - F.expr("INTERVAL 1 DAY"))
    rate = F.coalesce(F.try_divide(F.count_if(FLAGGED), F.count(F.lit(1))), F.lit(0.0))
    return recent.agg(
        F.count(F.lit(1)).alias("recent_claims"), F.count_if(FLAGGED).alias("anomalies"), rate.alias("anomaly_rate")
    ).withColumn("alert", F.col("anomaly_rate") > threshold)


def stored_recent_anomaly_alert(
    spark: SparkSession, folder: str, day: str = "day", threshold: float = 0.10, cols: Columns = CLAIMS
) -> DataFrame:
    """:func:`recent_anomaly_alert` over a gold layer that is partitioned by day (yyyy-MM-dd).

    The names of the folders tell the newest day; the day before it is the only other one that the last
    24 hours can reach, so older days are neither listed nor read.
    """
    days = newest_values(spark, folder, day, 2)
    if not days:
        raise ValueError(f"no day is stored in {folder}")
    since = (date.fromisoformat(days[-1]) - timedelta(days=1)).isoformat()
    paths = [f"{folder.rstrip('/')}/{day}={d}" for d in days if d >= since]
    return recent_anomaly_alert(spark.read.option("basePath", folder).parquet(*paths), threshold, cols)


def flagged_claims(gold: DataFrame, columns: tuple[str, ...], order: tuple[str, ...], n: int = 10) -> DataFrame:
    """The first flagged rows in key order."""
    return gold.filter(FLAGGED).select(*columns).orderBy(*order).limit(n)


def training_size_check(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Row count of the features and whether it is enough to train."""
    return features.agg(F.count(F.lit(1)).alias("record_count")).withColumn(
        "enough", F.col("record_count") > params.min_training_rows
    )
