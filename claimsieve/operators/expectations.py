"""Declarative data-quality checks: all checks of a layer are one aggregation.

A check is data (name, violation predicate, severity, tolerance). ``evaluate`` counts the rows
and every predicate's hits in a single scan that reads only the checked columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params
from claimsieve.sources.tables import scan

PASSED, FAILED, WARNING, SKIPPED = "passed", "failed", "warning", "skipped"
RESULT_COLUMNS = ("check_no", "expectation_name", "status", "message", "record_count", "violations")


@dataclass(frozen=True)
class Check:
    """Rows matching ``violation`` break the check; ``tolerance`` is the share that must not be reached."""

    name: str
    needs: tuple[str, ...]
    violation: Column
    severity: str = FAILED
    tolerance: float | None = None


@dataclass(frozen=True)
class Suite:
    """Required columns and row checks of one layer."""

    required_name: str
    required: tuple[str, ...]
    checks: tuple[Check, ...]
    check_not_empty: bool = True


def raw_checks(params: Params = DEFAULTS, cols: Columns = CLAIMS) -> Suite:
    return Suite(
        "required_columns_exist",
        (cols.record, cols.subject, cols.amount, cols.status),
        (
            Check("claim_id_not_null", (cols.record,), F.col(cols.record).isNull(), severity=WARNING),
            Check(
                "billed_amount_populated",
                (cols.amount,),
                F.col(cols.amount).isNull(),
                tolerance=params.null_amount_tolerance,
            ),
        ),
    )


def clean_checks(params: Params = DEFAULTS, cols: Columns = CLAIMS) -> tuple[Check, ...]:
    amount, code = F.col(cols.amount), F.col(cols.code)
    return (
        Check("no_negative_amounts", (cols.amount,), amount < 0),
        Check("no_invalid_diagnosis_codes", (cols.code,), code == params.invalid_diagnosis_code),
        Check("no_extreme_outliers", (cols.amount,), amount >= params.max_billed_amount),
    )


def feature_suite(mean: str = "hosp_avg_billed", ratio: str = "amount_to_avg_ratio") -> Suite:
    return Suite(
        "required_features_exist",
        (mean, ratio),
        (
            Check("no_null_ratios", (ratio,), F.col(ratio).isNull()),
            Check("positive_ratios", (ratio,), F.col(ratio) < 0),
        ),
        check_not_empty=False,
    )


def suite_for(layer: str, params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False) -> Suite | None:
    """The checks of a layer, or None for a layer without any.

    ``compat`` counts the raw checks of the silver layer twice, in every counter.
    """
    raw = raw_checks(params, cols)
    if layer == "bronze":
        return raw
    if layer == "silver":
        return Suite(raw.required_name, raw.required, raw.checks + clean_checks(params, cols))
    if layer == "features":
        return feature_suite()
    return None


def evaluate(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per check, in order. Checks on missing columns are left out: the schema row has failed."""
    return evaluate_all(df, {0: suite}).drop("suite_no")


def evaluate_all(df: DataFrame, suites: dict[int, Suite], times: str | None = None) -> DataFrame:
    """The checks of several suites over one table, all counted in one aggregation.

    ``times`` names a column that says for how many equal rows one stands.
    """
    columns = [c for c in df.columns if c != times]
    hits = {name: F.coalesce(hit, F.lit(False)) for name, hit in violations(suites, columns).items()}
    each = F.lit(1) if times is None else F.col(times)
    total = [F.coalesce(F.sum(F.when(hit, each)), F.lit(0)).alias(name) for name, hit in (("_n", F.lit(True)), *hits.items())]
    return _results(df.agg(*total), suites, columns)


def violations(suites: dict[int, Suite], columns: Sequence[str]) -> dict[str, Column]:
    """The predicates of the checks whose columns are there, under the names their counts go by."""
    return {
        f"_v{no}_{i}": c.violation
        for no, suite in suites.items()
        for i, c in enumerate(suite.checks)
        if set(c.needs) <= set(columns)
    }


def _results(counted: DataFrame, suites: dict[int, Suite], columns: Sequence[str]) -> DataFrame:
    hits = violations(suites, columns)
    structs = [row for no, suite in suites.items() for row in _result_rows(no, suite, set(columns), F.col("_n"), hits)]
    return counted.select(F.inline(F.array(*structs)))


def observed_results(
    spark: SparkSession, n_rows: int, counts: Mapping[str, int], suite: Suite, columns: Sequence[str], layer: str, table: str
) -> DataFrame:
    """The results of a suite from counts that were observed while its rows were written: no scan."""
    names = ["_n", *violations({0: suite}, columns)]
    row = [(n_rows, *[int(counts[name]) for name in names[1:]])]
    counted = spark.createDataFrame(row, ", ".join(f"{name} long" for name in names))
    found = _results(counted, {0: suite}, columns).drop("suite_no")
    return found.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), *RESULT_COLUMNS)


def _result_rows(no: int, suite: Suite, held: set[str], n: Column, hits: dict[str, Column]) -> list[Column]:
    missing = sorted(set(suite.required) - held)
    rows: list[tuple[str, Column, Column, Column]] = []
    if suite.check_not_empty:
        filled = n > 0
        text = F.concat(n.cast("string"), F.lit(" records"))
        rows.append(("non_empty_table", F.when(filled, PASSED).otherwise(FAILED), text, F.when(filled, 0).otherwise(1)))
    schema_text = "missing: " + ", ".join(missing) if missing else "all columns present"
    rows.append((suite.required_name, F.lit(FAILED if missing else PASSED), F.lit(schema_text), F.lit(len(missing))))
    for i, c in enumerate(suite.checks):
        if f"_v{no}_{i}" not in hits:
            continue
        hit = F.col(f"_v{no}_{i}")
        ok = hit == 0 if c.tolerance is None else hit < n * F.lit(c.tolerance)
        text = F.concat(hit.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" records"))
        rows.append((c.name, F.when(ok, PASSED).otherwise(c.severity), text, hit))
    return [
        F.struct(
            F.lit(no).alias("suite_no"),
            F.lit(i).alias("check_no"),
            F.lit(name).alias("expectation_name"),
            status.alias("status"),
            text.alias("message"),
            n.alias("record_count"),
            found.cast("bigint").alias("violations"),
        )
        for i, (name, status, text, found) in enumerate(rows, start=1)
    ]


def _single(spark: SparkSession, name: str, status: str, message: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(1).alias("check_no"),
        F.lit(name).alias("expectation_name"),
        F.lit(status).alias("status"),
        F.lit(message).alias("message"),
        F.lit(None).cast("bigint").alias("record_count"),
        F.lit(None).cast("bigint").alias("violations"),
    )


def check_layer(
    df: DataFrame,
    layer: str,
    table: str,
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    compat: bool = False,
) -> DataFrame:
    """Expectation results of one layer. An unknown layer is one skipped row, which no counter counts."""
    suite = suite_for(layer, params, cols)
    if suite is None:
        results = _single(df.sparkSession, "layer_validation", SKIPPED, f"no checks for layer {layer}")
    else:
        results = evaluate(df, suite)
        if compat and layer == "silver":
            doubled = 2 + len(raw_checks(params, cols).checks)
            times = F.when(F.col("check_no") <= doubled, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
            results = results.withColumn("_time", F.explode(times)).drop("_time")
    return results.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), *RESULT_COLUMNS)


def check_layers(
    df: DataFrame,
    layers: Sequence[tuple[str, str]],
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    times: str | None = None,
) -> DataFrame:
    """Results of several known layers' suites, (layer, table name) each, over one table in one aggregation.

    A table that carries another layer's rows and columns unchanged can answer for both. ``times`` as
    in :func:`evaluate_all`.
    """
    suites = {no: suite_for(layer, params, cols) for no, (layer, _) in enumerate(layers)}
    unknown = [layers[no][0] for no, suite in suites.items() if suite is None]
    if unknown:
        raise ValueError("no checks for layers " + ", ".join(unknown))
    which = F.col("suite_no") + 1
    names = [F.element_at(F.array(*[F.lit(pair[i]) for pair in layers]), which) for i in (0, 1)]
    found = evaluate_all(df, suites, times)
    return found.select(names[0].alias("layer"), names[1].alias("table_name"), *RESULT_COLUMNS)


def validate_table(
    spark: SparkSession, table: str, layer: str, params: Params = DEFAULTS, cols: Columns = CLAIMS
) -> DataFrame:
    """Results for a stored layer; a table that cannot be read is one failed row."""
    try:
        df = scan(spark, table)
    except AnalysisException as problem:
        reason = problem.getCondition() or "unreadable"
        return _single(spark, "table_exists", FAILED, reason).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), *RESULT_COLUMNS
        )
    return check_layer(df, layer, table, params, cols)


def report(results: DataFrame) -> DataFrame:
    """Roll the results up per table: counters, validity, a summary line and the checks to look at."""
    status = F.col("status")

    def names(which: str) -> Column:
        listed = F.collect_list(F.when(status == which, F.struct("check_no", "expectation_name")))
        return F.concat_ws(", ", F.array_sort(listed).getField("expectation_name"))

    rolled = results.groupBy("table_name", "layer").agg(
        F.count_if(status == PASSED).alias("passed"),
        F.count_if(status == FAILED).alias("failed"),
        F.count_if(status == WARNING).alias("warnings"),
        names(FAILED).alias("failed_checks"),
        names(WARNING).alias("warned_checks"),
    )
    total = F.col("passed") + F.col("failed") + F.col("warnings")
    return rolled.withColumns(
        {
            "total_checks": total,
            "is_valid": F.col("failed") == 0,
            "summary": F.concat_ws(
                " ",
                F.concat(F.col("table_name"), F.lit(":")),
                total.cast("string"),
                F.lit("checks,"),
                F.col("passed").cast("string"),
                F.lit("passed,"),
                F.col("failed").cast("string"),
                F.lit("failed,"),
                F.col("warnings").cast("string"),
                F.lit("warnings:"),
                F.when(F.col("failed") == 0, "VALID").otherwise("INVALID"),
            ),
        }
    )


def findings(results: DataFrame) -> DataFrame:
    """Only the failed checks and the warnings."""
    return results.filter(F.col("status").isin(FAILED, WARNING))


def incident_severity(reported: DataFrame) -> DataFrame:
    """Severity from the share of failed checks: above half HIGH, from a tenth MEDIUM, else LOW."""
    share = F.coalesce(F.try_divide(F.col("failed"), F.col("total_checks")), F.lit(0.0))
    severity = (
        F.when(F.col("failed") == 0, "NONE").when(share > 0.5, "HIGH").when(share >= 0.1, "MEDIUM").otherwise("LOW")
    )
    return reported.select(
        "table_name", "layer", "failed", "total_checks", share.alias("failed_share"), severity.alias("severity")
    )


def is_valid(results: DataFrame) -> bool:
    """No failed check. Reads one boolean."""
    return bool(results.agg((F.count_if(F.col("status") == FAILED) == 0).alias("ok")).first()["ok"])


def require_valid(results: DataFrame) -> None:
    """Raise ValueError naming the failed checks; a results frame has one row per check."""
    bad = [r["expectation_name"] for r in results.filter(F.col("status") == FAILED).collect()]
    if bad:
        raise ValueError("failed checks: " + ", ".join(bad))


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
