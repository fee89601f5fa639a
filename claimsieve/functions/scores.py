"""Scalar scores of one record against its provider and its cluster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimsieve.params import DEFAULTS, Params


def ratio_to_baseline(amount: Column, baseline: Column, decimals: int = DEFAULTS.ratio_decimals) -> Column:
    """Rounded amount / baseline; NULL when the baseline is 0 or NULL (also under ANSI mode)."""
    return F.round(F.try_divide(amount, baseline), decimals)


def z_score(amount: Column, mean: Column, stddev: Column) -> Column:
    """Standard score; 0.0 when the spread is 0 or unknown."""
    return F.when(stddev > 0, (amount - mean) / stddev).otherwise(F.lit(0.0))


def above_k_std(z: Column, k: float = DEFAULTS.std_threshold) -> Column:
    return z > F.lit(float(k))


def anomaly_flag(
    cluster: Column, anomaly_cluster: Column, ratio: Column, threshold: float = DEFAULTS.anomaly_ratio_threshold
) -> Column:
    """In the anomaly cluster and strictly above the ratio threshold; false without such a cluster."""
    return F.coalesce((cluster == anomaly_cluster) & (ratio > F.lit(float(threshold))), F.lit(False))


def anomaly_confidence(flag: Column, ratio: Column, params: Params = DEFAULTS) -> Column:
    """Distance of the ratio above 1, scaled to at most 1; 0 for unflagged rows."""
    scaled = (ratio - F.lit(1.0)) / F.lit(params.confidence_span)
    return F.when(flag, F.least(F.lit(1.0), scaled)).otherwise(F.lit(0.0))


def risk_level(flag: Column, confidence: Column, ratio: Column, params: Params = DEFAULTS) -> Column:
    """Banded confidence for flagged rows; REVIEW or NORMAL for the others."""
    return (
        F.when(flag & (confidence > params.high_confidence), "HIGH")
        .when(flag & (confidence > params.medium_confidence), "MEDIUM")
        .when(flag, "LOW")
        .when(ratio > params.review_ratio, "REVIEW")
        .otherwise("NORMAL")
    )
