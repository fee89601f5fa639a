"""The layered pipeline: each stage reads one stored layer and stores the next, or nothing.

A stage writes its rows once to a new folder, counts violations while it writes them, and only
then makes the folder the table's content. A failed check leaves the old table untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimsieve.operators import cleansing, expectations, model, scoring
from claimsieve.operators import features as feature_ops
from claimsieve.params import CLAIMS, DEFAULTS, Columns, Params
from claimsieve.sources.tables import key_count_at_most, publish, replace_folder, scan, write_layer


@dataclass(frozen=True)
class Layers:
    """Where the layers live: catalog tables, or paths (names with a slash)."""

    bronze: str = "claims_bronze"
    silver: str = "claims_silver"
    features: str = "claims_features"
    gold: str = "claims_gold"
    metrics: str = "claims_model_metrics"


def store_checked(
    df: DataFrame,
    name: str,
    rules: dict[str, Column],
    suite: expectations.Suite | None = None,
    layer: str = "",
    before: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Write once, count violations while writing, publish. A broken rule or a failed check of the suite raises.

    ``before`` may raise as well, when the rows are written and not yet published. Nothing is read a second time.
    """
    spark = df.sparkSession
    is_path = "/" in name
    folder = f"{name.rstrip('/')}-{uuid.uuid4().hex}" if is_path else _version_folder(spark, name)
    hits = expectations.violations({0: suite}, df.columns) if suite else {}
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    counts = [F.count_if(v).alias(c) for c, v in (rules | hits).items()]
    df.observe(seen, F.count(F.lit(1)).alias("_n"), *counts).write.parquet(folder)
    found = seen.get
    before()
    broken = [rule for rule in rules if found[rule]]
    if broken:
        raise ValueError(f"{name} not written, failed checks: " + ", ".join(broken))
    if suite:
        expectations.require_valid(expectations.observed_results(spark, found["_n"], found, suite, df.columns, layer, name))
    written = spark.read.schema(df.schema).parquet(folder)
    if is_path:
        replace_folder(spark, folder, name)
    else:
        publish(written, folder, name)
    return scan(spark, name)


def _version_folder(spark: SparkSession, table: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}-{uuid.uuid4().hex}"


def to_silver(
    spark: SparkSession, layers: Layers, params: Params = DEFAULTS, cols: Columns = CLAIMS, compat: bool = False
) -> DataFrame:
    return silver_with_metrics(spark, layers, params, cols, compat)[0]


def silver_with_metrics(
    spark: SparkSession,
    layers: Layers,
    params: Params = DEFAULTS,
    cols: Columns = CLAIMS,
    compat: bool = False,
    expect: bool = False,
) -> tuple[DataFrame, dict[str, float]]:
    """The silver layer and the counters of its cleansing, from one scan of bronze.

    With ``expect`` the expectations of both layers are a gate as well: those of the raw rows are
    counted on the same scan, and keep the silver layer from being published.
    """
    suite = expectations.suite_for("bronze", params, cols)
    if expect and not _has_columns(spark, layers.bronze, suite.required):
        expectations.require_valid(expectations.validate_table(spark, layers.bronze, "bronze", params, cols))
    raw, seen = scan(spark, layers.bronze), Observation(f"raw-{uuid.uuid4().hex}")
    hits = expectations.violations({0: suite}, raw.columns) if expect else {}
    cleaned = cleansing.cleanse_observed(raw, seen, params, cols, compat, hits)

    def raw_is_valid() -> None:
        found = seen.get
        results = expectations.observed_results(spark, found["initial_count"], found, suite, raw.columns, "bronze", layers.bronze)
        expectations.require_valid(results)

    clean_suite = expectations.suite_for("silver", params, cols, compat) if expect else None
    gate = raw_is_valid if expect else lambda: None
    stored = store_checked(cleaned, layers.silver, cleansing.post_clean_rules(cols), clean_suite, "silver", gate)
    return stored, cleansing.observed_metrics(seen)


def _has_columns(spark: SparkSession, table: str, required: tuple[str, ...]) -> bool:
    try:
        return set(required) <= set(scan(spark, table).columns)
    except AnalysisException:
        return False


def to_features(
    spark: SparkSession, layers: Layers, params: Params = DEFAULTS, cols: Columns = CLAIMS, expect: bool = False
) -> DataFrame:
    silver = scan(spark, layers.silver)
    small = key_count_at_most(silver, cols.provider, params.broadcast_max_rows)
    built = feature_ops.features(silver, cols, params, small=small)
    suite = expectations.suite_for("features", params, cols) if expect else None
    return store_checked(built, layers.features, feature_ops.feature_rules(params), suite, "features")


def to_model(spark: SparkSession, layers: Layers, model_path: str, params: Params = DEFAULTS) -> model.Fitted:
    """Fit, store the model, append its metrics. Needs more rows than ``params.min_training_rows``."""
    with model.trained(scan(spark, layers.features), params, min_rows=params.min_training_rows + 1) as fitted:
        model.save(fitted, model_path)
        write_layer(model.metrics_row(fitted, params), layers.metrics, overwrite=False)
    return fitted


def to_gold(
    spark: SparkSession,
    layers: Layers,
    *model_paths: str,
    params: Params = DEFAULTS,
    refit_scale: bool = False,
) -> DataFrame:
    """Score the features with the first model found (for example production, then staging)."""
    _, centroids = model.load(spark, *model_paths)
    scored = scoring.gold(scan(spark, layers.features), centroids, params, refit_scale)
    return store_checked(scored, layers.gold, scoring.gold_rules(params))


def run(
    spark: SparkSession, layers: Layers, model_path: str, params: Params = DEFAULTS, cols: Columns = CLAIMS
) -> DataFrame:
    """Bronze to gold; the expectations of each layer are a gate, counted on the scan that writes the next."""
    silver_with_metrics(spark, layers, params, cols, expect=True)
    to_features(spark, layers, params, cols, expect=True)
    to_model(spark, layers, model_path, params)
    return to_gold(spark, layers, model_path, params=params)
