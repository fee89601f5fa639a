"""Cleansing rules and their one-pass metrics.

Each rule is ``documented`` by default. ``compat=True`` keeps the row-level result of the
three-valued-logic variant that loses NULL codes and leaves empty ones in place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct, NULLs equal. Copies collapse in the map tasks before the shuffle."""
    return df.dropDuplicates()


def _is_bad(code: Column, bad: str, compat: bool) -> Column:
    same = code.eqNullSafe(F.lit(bad))
    return same | code.isNull() if compat else same


def drop_invalid_code(
    df: DataFrame, bad: str = DEFAULTS.invalid_diagnosis_code, code: str = CLAIMS.code, compat: bool = False
) -> DataFrame:
    """Drop rows with the bad code; NULL codes stay (``compat``: they go too)."""
    return df.filter(F.col(code) != bad) if compat else df.filter(~F.col(code).eqNullSafe(F.lit(bad)))


def impute_code(
    df: DataFrame, default: str = DEFAULTS.default_diagnosis_code, code: str = CLAIMS.code, compat: bool = False
) -> DataFrame:
    """NULL or empty code -> default (``compat``: only NULL)."""
    if compat:
        return df.na.fill({code: default})
    return df.withColumn(code, F.coalesce(F.nullif(F.col(code), F.lit("")), F.lit(default)))


def absolute_amounts(df: DataFrame, amount: str = CLAIMS.amount) -> DataFrame:
    """Negative amounts lose their sign; NULL stays NULL."""
    x = F.col(amount)
    return df.withColumn(amount, F.when(x < 0, F.abs(x)).otherwise(x))


def cap_amounts(df: DataFrame, cap: float = DEFAULTS.max_billed_amount, amount: str = CLAIMS.amount) -> DataFrame:
    """Keep amounts strictly below the cap; NULL amounts go."""
    return df.filter(F.col(amount) < F.lit(float(cap)))


def cleanse(df: DataFrame, params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False) -> DataFrame:
    """De-duplicate, drop bad codes, impute codes, correct signs, cap: one shuffle in all.

    The filters are stated on the raw columns, before the sign is corrected: -cap < x < cap
    is the cap rule after ``abs``, and in this form a file scan can skip row groups by it.
    """
    return df.transform(drop_exact_duplicates).transform(_rules, params, cols, compat)


def cleanse_counted(
    different: DataFrame, params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False
) -> DataFrame:
    """:func:`cleanse` of the rows of :func:`with_copies`.

    The filters stay above the exchange, so that whatever else reads all raw rows can share it.
    """
    raw = different.drop(COPIES).columns
    there = F.when(F.col(COPIES) > 0, F.lit(True))
    held = different.select(*[F.when(there, F.col(c)).alias(c) if c in (cols.code, cols.amount) else F.col(c) for c in raw])
    return held.transform(_rules, params, cols, compat)


def _rules(different: DataFrame, params: Params, cols: Columns, compat: bool) -> DataFrame:
    cap = F.lit(float(params.max_billed_amount))
    return (
        different.transform(drop_invalid_code, params.invalid_diagnosis_code, cols.code, compat)
        .filter((F.col(cols.amount) > -cap) & (F.col(cols.amount) < cap))
        .transform(impute_code, params.default_diagnosis_code, cols.code, compat)
        .transform(absolute_amounts, cols.amount)
    )


def cleansing_metrics(
    df: DataFrame, params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False
) -> DataFrame:
    """Counts per rule in rule order, as one row, from a single pass over the raw layer.

    The de-duplication keeps the number of copies, so the count before it comes from the same
    aggregation; every later flag includes "survived the rules before".
    """
    counts = with_copies(df).agg(*metric_counts(params, cols, compat))
    removed = F.col("initial_count") - F.col("final_count")
    return counts.withColumns(
        {
            "records_removed": removed,
            "cleansing_rate": F.coalesce(F.try_divide(removed, F.col("initial_count")), F.lit(0.0)),
        }
    )


COPIES = "_copies"


def with_copies(df: DataFrame) -> DataFrame:
    """Different rows with the number of their copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def metric_counts(params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False) -> list[Column]:
    """The counters of the cleansing, as aggregates over different rows with their copies."""
    code, amount = F.col(cols.code), F.col(cols.amount)
    bad = _is_bad(code, params.invalid_diagnosis_code, compat)
    below_cap = F.coalesce(F.abs(amount) < F.lit(float(params.max_billed_amount)), F.lit(False))
    outlier = ~bad & ~below_cap
    initial = F.coalesce(F.sum(COPIES), F.lit(0))
    return [
        initial.alias("initial_count"),
        (F.count(F.lit(1)) - F.count_if(bad) - F.count_if(outlier)).alias("final_count"),
        (initial - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(bad).alias("invalid_diagnosis_removed"),
        F.count_if(~bad & (code.isNull() | (code == ""))).alias("null_diagnosis_imputed"),
        F.count_if(~bad & (amount < 0)).alias("negative_amounts_corrected"),
        F.count_if(outlier).alias("outliers_filtered"),
    ]


def cleanse_observed(
    df: DataFrame,
    seen: Observation,
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    compat: bool = False,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """:func:`cleanse`, with its counters and the violations of ``more`` over all raw rows observed as they are written.

    They are taken after the exchange of the de-duplication, in the stage that writes, where a
    task that is run again counts once; a row counts as often as it was there.
    """
    violations = [F.coalesce(F.sum(F.when(v, F.col(COPIES))), F.lit(0)).alias(name) for name, v in (more or {}).items()]
    different = with_copies(df).observe(seen, *metric_counts(params, cols, compat), *violations)
    return different.transform(_rules, params, cols, compat).drop(COPIES)


def observed_metrics(seen: Observation) -> dict[str, float]:
    """The row that :func:`cleansing_metrics` gives, from what was seen."""
    found = {k: v for k, v in seen.get.items() if k in METRICS}
    removed = found["initial_count"] - found["final_count"]
    rate = removed / found["initial_count"] if found["initial_count"] else 0.0
    return found | {"records_removed": removed, "cleansing_rate": rate}


# The counters that a report of the cleansing shows.
METRICS = (
    "initial_count", "final_count", "duplicates_removed", "invalid_diagnosis_removed", "null_diagnosis_imputed",
    "negative_amounts_corrected", "outliers_filtered",
)


def post_clean_rules(cols: Columns = CLAIMS) -> dict[str, Column]:
    """What no cleansed row may be."""
    return {
        "negative_amount": F.col(cols.amount) < 0,
        "null_record_id": F.col(cols.record).isNull(),
        "empty_code": F.col(cols.code) == "",
    }


def post_clean_checks(df: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    """One row per check on the cleansed rows: check, violations, ok."""
    return violation_rows(df, post_clean_rules(cols))


def violation_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count the violations of all rules in one aggregation and turn the row into one row per rule."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    rows = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations")) for name in rules]
    return counts.select(F.inline(F.array(*rows))).withColumn("ok", F.col("violations") == 0)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any column (or in the given ones)."""
    return df.na.drop("any", subset=columns)


def incomplete_count(df: DataFrame) -> DataFrame:
    """How many rows :func:`drop_incomplete` keeps and drops."""
    kept = F.lit(True)
    for name, kind in df.dtypes:
        kept = kept & F.col(name).isNotNull()
        if kind in ("double", "float"):
            kept = kept & ~F.isnan(name)
    return df.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))
