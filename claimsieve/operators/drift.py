"""Drift of feature distributions, from quantile sketches that can be stored by day and merged.

A sketch has a fixed size whatever it stands for. Days, deliveries and training rows are sketched
where they are written; comparing any range of days with the training rows merges stored rows and reads no
record. The distance is the largest difference between the two cumulative shares (Kolmogorov and
Smirnov's), each counted among evenly spaced quantiles of its sketch.

A share read from a sketch of size k is off by about ``2.3 / k ** 0.9`` (99 of 100 times), and by the
spacing of the quantiles; a distance by at most twice that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800
PROBES = 199


def share_error(k: int = K) -> float:
    """How far a share may be off, 99 of 100 times."""
    return 2.3 / k**0.9


def distance_error(k: int = K, probes: int = PROBES) -> float:
    return 2 * (share_error(k) + 1 / (probes + 1))


def sketches(df: DataFrame, columns: tuple[str, ...], by: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """One row per feature, and group of ``by``: rows with a value, and their sketch. NULL and NaN have no place in it."""
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    each = [F.struct(F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")).alias(c) for c, v in values.items()]
    wide = df.groupBy(*by).agg(*each)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.n"), F.col(f"{c}.sketch")) for c in columns])
    return wide.select(*by, F.inline(rows)).where("n > 0")


def merged(stored: DataFrame, by: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """The sketches of several days, deliveries or tables as one per feature (and group of ``by``)."""
    return stored.groupBy(*by, "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def distances(now: DataFrame, trained: DataFrame, by: tuple[str, ...] = (), probes: int = PROBES) -> DataFrame:
    """feature (and ``by``), n, distance; ``trained`` has one row per feature. A feature it has not is left out."""
    old = F.broadcast(trained.select("feature", F.col("sketch").alias("_old")))  # one row a feature
    ranks = F.array(*[F.lit(i / (probes + 1)) for i in range(1, probes + 1)])
    probed = now.join(old, "feature").withColumns({f"_{side}": F.kll_sketch_get_quantile_double(side, ranks) for side in ("sketch", "_old")})
    probed = probed.select(*by, "feature", "n", F.col("_sketch").alias("_a"), F.col("__old").alias("_b"))

    def gap(at: Column) -> Column:
        below = [F.size(F.filter(side, lambda x: x <= at)) for side in ("_a", "_b")]
        return F.abs(below[0] - below[1])

    gaps = F.transform(F.array_union("_a", "_b"), gap)
    return probed.select(*by, "feature", "n", (F.array_max(gaps) / F.lit(probes + 1)).alias("distance"))


def drift_check(
    now: DataFrame, trained: DataFrame, threshold: float = 0.1, by: tuple[str, ...] = (), probes: int = PROBES
) -> DataFrame:
    """The distances and whether they are above the threshold."""
    return distances(now, trained, by, probes).withColumn("alert", F.col("distance") > threshold)
