"""Assignment to centroids and the measures of a clustering, as plain expressions.

Centroids are k x d numbers, so they enter the plan as literals: no join with the rows, no
vector objects, everything in generated code. k and d are parameters of the model and do not
grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.operators.features import population_moments, scaled
from claimsieve.params import DEFAULTS

CLUSTER = "cluster_prediction"
DISTANCE = "squared_distance"


@dataclass(frozen=True)
class Centroids:
    """Centres in population-standardised space.

    Without ``means`` and ``deviations`` the scale is taken from the rows being scored.
    """

    columns: tuple[str, ...]
    centers: tuple[tuple[float, ...], ...]
    means: tuple[float, ...] = field(default=())
    deviations: tuple[float, ...] = field(default=())

    @property
    def k(self) -> int:
        return len(self.centers)

    def without_scale(self) -> Centroids:
        return Centroids(self.columns, self.centers)


def _total(terms: Sequence[Column]) -> Column:
    return reduce(add, terms)


def coordinate(name: str) -> str:
    return f"_x_{name}"


def with_coordinates(df: DataFrame, model: Centroids) -> DataFrame:
    """Add the standardised coordinates as helper columns."""
    if model.means:
        scale = [(F.lit(m), F.lit(s)) for m, s in zip(model.means, model.deviations)]
    else:
        moments = population_moments(df, model.columns)
        df = df.withColumn("_m", moments.select(F.struct(*moments.columns).alias("m")).scalar())
        scale = [(F.col(f"_m.mean_{c}"), F.col(f"_m.sd_{c}")) for c in model.columns]
    return df.withColumns(
        {coordinate(c): scaled(F.col(c).cast("double"), *ms) for c, ms in zip(model.columns, scale)}
    ).drop("_m")


def assign(df: DataFrame, model: Centroids, label: str = CLUSTER, keep: bool = False) -> DataFrame:
    """Nearest centroid and squared distance to it; ties go to the lower label.

    ``keep`` leaves the coordinates in the result for the measures below.
    """
    placed = with_coordinates(df, model)
    axes = [F.col(coordinate(c)) for c in model.columns]
    candidates = [
        F.struct(
            _total([(x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(axes, center)]).alias("d"),
            F.lit(j).alias("j"),
        )
        for j, center in enumerate(model.centers)
    ]
    best = candidates[0] if model.k == 1 else F.least(*candidates)
    found = placed.withColumn("_best", best).withColumns(
        {label: F.col("_best.j"), DISTANCE: F.col("_best.d")}
    )
    return found.drop("_best") if keep else found.drop("_best", *[coordinate(c) for c in model.columns])


def _times(weight: str | None) -> Column:
    return F.lit(1).cast("bigint") if weight is None else F.col(weight)


def inertia(assigned: DataFrame, weight: str | None = None) -> DataFrame:
    """Sum of squared distances to the own centroid; ``weight`` is the rows a point stands for."""
    w = _times(weight)
    return assigned.agg(F.sum(F.col(DISTANCE) * w).alias("inertia"), F.sum(w).alias("n_samples"))


def cluster_profile(
    assigned: DataFrame, columns: tuple[str, ...] = DEFAULTS.feature_columns, label: str = CLUSTER
) -> DataFrame:
    """Rows and mean of each feature per cluster."""
    return assigned.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(f"avg_{c}") for c in columns]
    )


def anomaly_cluster(
    assigned: DataFrame,
    ratio: str = "amount_to_avg_ratio",
    label: str = CLUSTER,
    min_clusters: int = DEFAULTS.min_clusters_for_anomaly,
) -> DataFrame:
    """One row: the cluster with the highest mean ratio, lowest label on ties.

    NULL when fewer than ``min_clusters`` clusters hold rows.
    """
    means = assigned.groupBy(label).agg(F.avg(ratio).alias("_mean"))
    best = F.max_by(F.col(label), F.struct(F.col("_mean"), -F.col(label)))
    return means.agg(
        F.when(F.count(F.lit(1)) >= min_clusters, best).alias("anomaly_cluster"),
        F.count(F.lit(1)).alias("n_clusters"),
        F.max("_mean").alias("highest_mean_ratio"),
    )


def silhouette_squared(
    assigned: DataFrame, model: Centroids, label: str = CLUSTER, weight: str | None = None
) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, exact, in two linear passes.

    The summed squared distance from x to a cluster is n*|x|^2 - 2*x.S + Q with the cluster's row
    count n, coordinate sums S and sum of squares Q, so k*(d+2) totals replace all pairs of
    rows. They are one row, read through a scalar subquery. ``assigned`` comes from
    ``assign(..., keep=True)``. A row alone in its cluster scores 0; NULL with fewer than two
    clusters. ``weight`` is the number of equal rows a point stands for.
    """
    w = _times(weight)
    axes = [F.col(coordinate(c)) for c in model.columns]
    norm = _total([x * x for x in axes])
    member = [F.col(label) == j for j in range(model.k)]
    totals = assigned.agg(
        F.struct(
            *[F.sum(F.when(m, w).otherwise(0)).alias(f"n{j}") for j, m in enumerate(member)],
            *[F.sum(F.when(m, norm * w)).alias(f"q{j}") for j, m in enumerate(member)],
            *[F.sum(F.when(m, x * w)).alias(f"s{j}_{i}") for j, m in enumerate(member) for i, x in enumerate(axes)],
        ).alias("t")
    )

    def n(j: int) -> Column:
        return F.col(f"_t.n{j}")

    def summed(j: int) -> Column:
        dot = _total([x * F.col(f"_t.s{j}_{i}") for i, x in enumerate(axes)])
        return n(j) * norm - 2 * dot + F.col(f"_t.q{j}")

    own = F.coalesce(
        *[F.when(member[j], F.struct(summed(j).alias("d"), n(j).alias("n"))) for j in range(model.k)], F.lit(None)
    )
    others = [F.when(~member[j] & (n(j) > 0), F.greatest(summed(j), F.lit(0.0)) / n(j)) for j in range(model.k)]
    nearest = F.least(*others) if model.k > 1 else F.lit(None).cast("double")
    measured = assigned.withColumn("_t", totals.scalar()).select(
        own.alias("own"), nearest.alias("b"), w.alias("w")
    )
    a = F.greatest(F.col("own.d"), F.lit(0.0)) / (F.col("own.n") - 1)
    b = F.col("b")
    score = F.when(b.isNull(), None).when(F.col("own.n") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    )
    mean = F.try_divide(F.sum(score * F.col("w")), F.sum("w"))
    return measured.agg(mean.alias("silhouette_sq"), F.sum("w").alias("n_samples"))
