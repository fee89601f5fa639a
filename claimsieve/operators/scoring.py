"""Anomaly flags, confidence and risk level of assigned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.functions import scores
from claimsieve.operators.cleansing import drop_incomplete, violation_rows
from claimsieve.operators.clusters import CLUSTER, DISTANCE, Centroids, anomaly_cluster, assign
from claimsieve.params import DEFAULTS, Params

RATIO = "amount_to_avg_ratio"
FLAG, CONFIDENCE, LEVEL = "is_anomaly", "anomaly_confidence", "risk_level"


def flag_anomalies(assigned: DataFrame, params: Params = DEFAULTS, label: str = CLUSTER, ratio: str = RATIO) -> DataFrame:
    """Flag rows of the anomaly cluster above the ratio threshold.

    The cluster's label is one value and reaches the rows through a scalar subquery.
    """
    worst = anomaly_cluster(assigned, ratio, label, params.min_clusters_for_anomaly).select("anomaly_cluster").scalar()
    flag = scores.anomaly_flag(F.col(label), worst, F.col(ratio), params.anomaly_ratio_threshold)
    return assigned.withColumn(FLAG, flag)


def add_confidence(flagged: DataFrame, params: Params = DEFAULTS, ratio: str = RATIO) -> DataFrame:
    return flagged.withColumn(CONFIDENCE, scores.anomaly_confidence(F.col(FLAG), F.col(ratio), params))


def add_risk_level(scored: DataFrame, params: Params = DEFAULTS, ratio: str = RATIO) -> DataFrame:
    return scored.withColumn(LEVEL, scores.risk_level(F.col(FLAG), F.col(CONFIDENCE), F.col(ratio), params))


def score_assigned(assigned: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return (
        assigned.transform(flag_anomalies, params).transform(add_confidence, params).transform(add_risk_level, params)
    )


def gold(
    features: DataFrame,
    model: Centroids,
    params: Params = DEFAULTS,
    refit_scale: bool = False,
    complete: bool = False,
) -> DataFrame:
    """Complete rows -> clusters -> anomaly cluster -> flag, confidence, level.

    The scale is the one the model was trained with; ``refit_scale`` takes it from the rows
    being scored instead. ``complete`` says that incomplete rows are gone already.
    """
    centroids = model.without_scale() if refit_scale else model
    rows = features if complete else drop_incomplete(features)
    return rows.transform(assign, centroids).drop(DISTANCE).transform(score_assigned, params)


def gold_checks(scored: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The gate of the gold layer: every row has a cluster, a flag and a level that agree with each other."""
    return violation_rows(scored, gold_rules(params))


def gold_rules(params: Params = DEFAULTS) -> dict[str, Column]:
    flag, ratio, confidence = F.col(FLAG), F.col(RATIO), F.col(CONFIDENCE)
    flagged_level = F.col(LEVEL).isin("HIGH", "MEDIUM", "LOW")
    return {
        "no_cluster": F.col(CLUSTER).isNull(),
        "no_flag": flag.isNull(),
        "flag_without_ratio": flag & ~(ratio > params.anomaly_ratio_threshold),
        "confidence_range": F.coalesce(~confidence.between(0.0, 1.0), F.lit(True)),
        "level_against_flag": F.coalesce(flagged_level != flag, F.lit(True)),
    }
