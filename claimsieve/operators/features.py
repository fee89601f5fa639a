"""Provider baselines, per-record features and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.functions.money import CENTS, minor_units
from claimsieve.functions.scores import above_k_std, ratio_to_baseline, z_score
from claimsieve.operators.cleansing import violation_rows
from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params

MEAN, LOW, HIGH, SPREAD, COUNT = (
    "hosp_avg_billed",
    "hosp_min_billed",
    "hosp_max_billed",
    "hosp_stddev_billed",
    "hosp_claim_count",
)
RATIO, Z, ABOVE = "amount_to_avg_ratio", "amount_z_score", "is_above_2std"
BASELINE_COLUMNS = (MEAN, LOW, HIGH, SPREAD, COUNT)


def provider_baseline(df: DataFrame, cols: Columns = CLAIMS, scale: int | None = CENTS) -> DataFrame:
    """Mean, min, max, sample standard deviation of the amount and the record count per provider.

    Partial aggregates are built in the map tasks, so a provider with a third of all rows sends
    one row per task. With ``scale`` the moments are whole numbers of minor units and come out
    the same for any partitioning or after a recomputed task; ``scale=None`` takes the built-in
    floating-point aggregates for amounts that are not money.
    """
    if scale is None:
        amount = F.col(cols.amount)
        return df.groupBy(cols.provider).agg(
            F.avg(amount).alias(MEAN), F.stddev_samp(amount).alias(SPREAD),
            F.min(amount).alias(LOW), F.max(amount).alias(HIGH), F.count(cols.record).alias(COUNT),
        )
    return from_moments(moments(df, (cols.provider,), cols, scale), cols, scale)


def moments(df: DataFrame, by: tuple[str, ...], cols: Columns = CLAIMS, scale: int = CENTS) -> DataFrame:
    """Counts, whole sums and edges of the amounts by any keys: what baselines are made of, and what can be added up."""
    amount = F.col(cols.amount)
    units = minor_units(amount, scale)
    return df.groupBy(*by).agg(
        F.count(amount).alias("_n"),
        F.sum(units).alias("_s"),
        F.sum(units.cast("decimal(19,0)") * units.cast("decimal(19,0)")).alias("_q"),
        F.min(amount).alias(LOW),
        F.max(amount).alias(HIGH),
        F.count(cols.record).alias(COUNT),
    )


def added_moments(stored: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Moments of the same keys, of other days or deliveries, as one."""
    sums = [F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in ("_n", "_s", "_q", COUNT)]
    return stored.groupBy(*by).agg(*sums, F.min(LOW).alias(LOW), F.max(HIGH).alias(HIGH))


def from_moments(moments: DataFrame, cols: Columns = CLAIMS, scale: int = CENTS) -> DataFrame:
    """The baseline of every provider from its moments."""
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    whole_n, whole_s = n.cast("decimal(13,0)"), s.cast("decimal(19,0)")
    spread = (whole_n * q - whole_s * whole_s).cast("double")
    pairs = n.cast("double") * (n - 1).cast("double")
    return moments.select(
        cols.provider,
        (s.cast("double") / F.nullif(n, F.lit(0)).cast("double") / F.lit(float(scale))).alias(MEAN),
        LOW,
        HIGH,
        F.when(n > 1, F.sqrt(spread / pairs) / F.lit(float(scale))).alias(SPREAD),
        COUNT,
    )


def attach_baseline(
    df: DataFrame,
    baseline: DataFrame,
    cols: Columns = CLAIMS,
    small: bool = False,
    null_safe: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """Left join with the baseline. NULL providers match nothing unless ``null_safe``.

    ``small`` says that a count has shown the baseline to fit a broadcast; the big side is then
    not shuffled. Otherwise the planner chooses from sizes, and adaptive execution splits the
    partitions of a hot provider in the sort-merge join. ``bucketed`` says that both sides lie in
    buckets by provider, which only a plain = makes use of.
    """
    right = baseline.withColumnRenamed(cols.provider, "_provider")
    left_key, right_key = F.col(cols.provider), F.col("_provider")
    # Written with <=> because a plain = makes the optimizer filter NULL providers out below the
    # baseline only: both sides then shuffle the records separately instead of sharing one exchange.
    matches = left_key == right_key if bucketed else left_key.eqNullSafe(right_key)
    if not null_safe and not bucketed:
        matches = matches & left_key.isNotNull()
    return df.join(F.broadcast(right) if small else right, matches, "left").drop("_provider")


def add_ratio(df: DataFrame, cols: Columns = CLAIMS, params: Params = DEFAULTS) -> DataFrame:
    return df.withColumn(RATIO, ratio_to_baseline(F.col(cols.amount), F.col(MEAN), params.ratio_decimals))


def add_z_score(df: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    return df.withColumn(Z, z_score(F.col(cols.amount), F.col(MEAN), F.col(SPREAD)))


def add_above_k(df: DataFrame, k: float = DEFAULTS.std_threshold) -> DataFrame:
    return df.withColumn(ABOVE, above_k_std(F.col(Z), k))


def features(
    df: DataFrame,
    cols: Columns = CLAIMS,
    params: Params = DEFAULTS,
    scale: int | None = CENTS,
    small: bool = False,
    bucketed: bool = False,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Baseline (or a stored one of the same rows), join, ratio, z-score and flag."""
    if baseline is None:
        baseline = provider_baseline(df, cols, scale)
    return (
        df.transform(attach_baseline, baseline, cols, small, False, bucketed)
        .transform(add_ratio, cols, params)
        .transform(add_z_score, cols)
        .transform(add_above_k, params.std_threshold)
    )


def feature_checks(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The gate of the features layer: NULL ratios, and extreme ones (NaN counts as extreme)."""
    return violation_rows(df, feature_rules(params))


def feature_rules(params: Params = DEFAULTS) -> dict[str, Column]:
    ratio = F.col(RATIO)
    return {"null_ratio": ratio.isNull(), "extreme_ratio": ratio > params.extreme_ratio}


def feature_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg(RATIO).alias("avg_ratio"),
        F.min(RATIO).alias("min_ratio"),
        F.max(RATIO).alias("max_ratio"),
        F.avg(Z).alias("avg_z_score"),
    )


def population_moments(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: mean_<c> and sd_<c> (population) of every column."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns]
    )


def scaled(value: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd; 0 for a column without spread."""
    return F.when(sd > 0, (value - mean) / sd).otherwise(F.lit(0.0))


def standardize(df: DataFrame, columns: tuple[str, ...] = DEFAULTS.feature_columns, prefix: str = "std_") -> DataFrame:
    """Add population-standardised copies of the columns.

    The moments are one row, read through a scalar subquery: no join, nothing collected.
    """
    moments = population_moments(df, columns)
    row = moments.select(F.struct(*moments.columns).alias("m")).scalar()
    with_row = df.withColumn("_m", row)
    z = {prefix + c: scaled(F.col(c), F.col(f"_m.mean_{c}"), F.col(f"_m.sd_{c}")) for c in columns}
    return with_row.withColumns(z).drop("_m")
