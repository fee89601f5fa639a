"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimsieve.functions.money import minor_units
from claimsieve.operators import cleansing, clusters, drift, expectations, model, monitoring, reports, scoring
from claimsieve.operators import features as feat
from claimsieve.params import BAD_CODES, CLAIMS, DEFAULTS, Columns
from claimsieve.plans import increments
from claimsieve.sources import claims, clustering, tables
from claimsieve.streaming import scorer

Query = Callable[[SparkSession, str], DataFrame]

# Centres (amount, provider mean, ratio) in standardised space, used where a result has to be
# checkable without a fit: TAIL looks like a fitted model, BAND reaches all risk levels.
TAIL = clusters.Centroids(DEFAULTS.feature_columns, tuple((v, 0.0, v) for v in (0.0, 6.0, 14.0)))
BAND = clusters.Centroids(DEFAULTS.feature_columns, tuple((v, 0.0, v) for v in (-0.5, 0.25, 1.0)))

# BAND with a scale of its own, as a fitted model has one.
TRAINED = replace(BAND, means=(2600.0, 2600.0, 1.0), deviations=(2000.0, 80.0, 0.75))

# The event stream as a second fact table: users are providers, the value is an amount in whole cents.
EVENTS = Columns(
    record="event_id", subject="user_id", provider="user_id", code="event_type", amount="value", status="props",
    event_time="ts",
)
EVENT_BAND = replace(BAND, columns=(EVENTS.amount, feat.MEAN, feat.RATIO))
KEYS = ("claim_id", "patient_id", "hospital_id")
ID = (*KEYS, "service_ts")
CLAIM_COLUMNS = (*KEYS, "diagnosis_code", "billed_amount", "claim_status", "service_ts")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.scan(spark, f"{folder}/{name}.parquet")


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return claims.claims_from_line_items(table(spark, folder, "lineitem"), table(spark, folder, "orders"))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.cleanse(bronze(spark, folder))


def silver_compat(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.cleanse(bronze(spark, folder), compat=True)


def providers_fit(spark: SparkSession, folder: str) -> bool:
    """Count the providers on the one raw column that names them, before planning the join."""
    return tables.key_count_at_most(table(spark, folder, "lineitem"), "l_suppkey", DEFAULTS.broadcast_max_rows)


def features(spark: SparkSession, folder: str) -> DataFrame:
    return feat.features(silver(spark, folder), small=providers_fit(spark, folder))


def complete(spark: SparkSession, folder: str) -> DataFrame:
    """The complete feature rows: scale, anomaly cluster and scores share the exchange of the records."""
    return cleansing.drop_incomplete(features(spark, folder))


def assigned(spark: SparkSession, folder: str, centers: clusters.Centroids, keep: bool = False) -> DataFrame:
    return clusters.assign(complete(spark, folder), centers, keep=keep)


def gold(
    spark: SparkSession, folder: str, centers: clusters.Centroids = BAND, refit_scale: bool = False
) -> DataFrame:
    return scoring.gold(complete(spark, folder), centers, refit_scale=refit_scale, complete=True)


def event_features(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    small = tables.key_count_at_most(events, EVENTS.provider, DEFAULTS.broadcast_max_rows)
    return feat.features(events, EVENTS, small=small)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point aggregates depend on the order of the rows in their last bits."""
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


# --- sources and sinks -------------------------------------------------------------------


def inject_defects(spark: SparkSession, folder: str) -> DataFrame:
    clean = claims.clean_claims_from_line_items(table(spark, folder, "lineitem"), table(spark, folder, "orders"))
    return claims.inject_defects(clean, F.col("_kind"), F.col("_bad")).select(*CLAIM_COLUMNS)


def inject_defects_events(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    bad = F.element_at(F.array(*[F.lit(c) for c in BAD_CODES]), (key % len(BAD_CODES) + 1).cast("int"))
    dirty = claims.inject_defects(
        table(spark, folder, "events"), claims.keyed_kind(key, 30), bad, EVENTS.code, EVENTS.amount
    )
    return dirty.select("event_id", "user_id", "event_type", "value")


def _totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(minor_units(F.col("billed_amount"))).alias("total_cents")
    )


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Overwrite with the bronze rows, append the injected ones again, read back."""
    target = tables.new_folder(spark, "sink")
    tables.write_layer(bronze(spark, folder), target)
    tables.write_layer(inject_defects(spark, folder), target, overwrite=False)
    return _totals(tables.scan(spark, target), "claim_status")


def partitioned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write by month, read three months back: the filter on the folder names prunes the rest."""
    target = tables.new_folder(spark, "by-month")
    monthly = bronze(spark, folder).withColumn("claim_month", F.date_format("service_ts", "yyyy-MM"))
    tables.write_layer(monthly, target, partition_by=("claim_month",))
    back = spark.read.schema(monthly.schema).parquet(target)
    return _totals(back.filter(F.col("claim_month").between("1995-03", "1995-05")), "claim_month")


def clustered_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Lay the raw rows out by day and provider at once, read a span of each back."""
    target = tables.new_folder(spark, "z-order")
    rows = bronze(spark, folder)
    clustering.write_clustered(rows, target, ("service_ts", "hospital_id"), files=4 * spark.sparkContext.defaultParallelism)
    back = spark.read.schema(rows.schema).parquet(target)
    some = F.col("hospital_id").between("HOSP-000001", "HOSP-000004")
    spring = (F.col("service_ts") >= "1995-03-01") & (F.col("service_ts") < "1995-06-01")
    return _totals(back.filter(some | spring), "hospital_id")


def gold_sample(spark: SparkSession, folder: str) -> DataFrame:
    # The columns this report shows.
    shown = (
        *KEYS, "billed_amount", feat.RATIO, clusters.CLUSTER, "is_anomaly", "anomaly_confidence", "risk_level",
    )
    return tables.sample_rows(gold(spark, folder), (*ID, "billed_amount"), shown, 10)


# --- expectations -------------------------------------------------------------------------


def all_results(spark: SparkSession, folder: str) -> DataFrame:
    """All layers, and the raw rows held against the silver checks, which they fail.

    One aggregation over the raw rows answers both of their suites, and one over the features those
    of the two built layers. Both read one exchange of the different raw rows with their copies.
    """
    raw = cleansing.with_copies(bronze(spark, folder))
    built = feat.features(cleansing.cleanse_counted(raw), small=providers_fit(spark, folder))
    return expectations.union_results(
        [
            expectations.check_layers(raw, [("bronze", "claims_bronze"), ("silver", "claims_bronze")], times=cleansing.COPIES),
            expectations.check_layers(built, [("silver", "claims_silver"), ("features", "claims_features")]),
        ]
    )


# --- baselines and features ---------------------------------------------------------------


def provider_join(spark: SparkSession, folder: str) -> DataFrame:
    clean = silver(spark, folder)
    return feat.attach_baseline(clean, feat.provider_baseline(clean), small=providers_fit(spark, folder))


def provider_baseline_window(spark: SparkSession, folder: str) -> DataFrame:
    """What avg/min/max/count over (partition by provider) gives, NULL providers included.

    A window would put all rows of a provider into one task; aggregate and null-safe join send
    one row per provider and map task.
    """
    clean = silver(spark, folder)
    joined = feat.attach_baseline(
        clean, feat.provider_baseline(clean), small=providers_fit(spark, folder), null_safe=True
    )
    return joined.select(*ID, "billed_amount", *feat.BASELINE_COLUMNS)


def provider_baseline_events(spark: SparkSession, folder: str) -> DataFrame:
    return feat.provider_baseline(table(spark, folder, "events"), EVENTS)


def _deliveries(spark: SparkSession, folder: str) -> increments.Store:
    """The raw rows in two deliveries, stored by month: odd orders first, then even ones and some odd ones again."""
    store = increments.Store(*(tables.new_folder(spark, f"by-month-{layer}") for layer in ("silver", "moments")))
    lines, key = table(spark, folder, "lineitem"), F.col("l_orderkey")
    for part in (key % 2 == 1, (key % 2 == 0) | (key % 7 == 1)):
        rows = claims.claims_from_line_items(lines.filter(part), table(spark, folder, "orders"))
        increments.deliver(spark, rows, store, period="yyyy-MM")
    return store


def provider_baseline_delivered(spark: SparkSession, folder: str) -> DataFrame:
    """The baseline of the stored moments of two deliveries."""
    return increments.baseline(spark, _deliveries(spark, folder))


def features_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """Features of three months' records against the baseline of all that was delivered."""
    store = _deliveries(spark, folder)
    months = ["1995-03", "1995-04", "1995-05"]
    return increments.features_of_days(spark, store, months, small=providers_fit(spark, folder))


def features_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Features of a silver table in buckets by provider: aggregated and joined where the rows lie."""
    name = f"silver_{uuid.uuid4().hex}"
    path = tables.new_folder(spark, "silver-buckets")
    buckets = max(8, spark.sparkContext.defaultParallelism)
    clean = tables.write_bucketed(silver(spark, folder), name, "hospital_id", buckets, path=path)
    return feat.features(clean, bucketed=True)


# --- fitted model -------------------------------------------------------------------------


def trained(spark: SparkSession, folder: str) -> model.Fitted:
    """The model of all complete features. Its points leave memory with the session's cache."""
    return model.train(complete(spark, folder), complete=True)


def _trained_on_stored(spark: SparkSession, folder: str) -> tuple[DataFrame, model.Fitted]:
    """The complete features, written once for fit and scores, and the model of them."""
    rows = tables.stage(complete(spark, folder), "complete")
    fitted = model.train(rows, complete=True)
    fitted.release()
    return rows, fitted


def kmeans_fit(spark: SparkSession, folder: str) -> DataFrame:
    fitted = trained(spark, folder)
    fitted.release()
    return model.centers_frame(fitted, spark)


def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    rows, fitted = _trained_on_stored(spark, folder)
    assigned = clusters.assign(rows, fitted.centroids)
    return rounded(assigned.select(*ID, "billed_amount", clusters.CLUSTER, clusters.DISTANCE))


def gold_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the features of the tables and score them: the whole pipeline as one result."""
    rows, fitted = _trained_on_stored(spark, folder)
    return scoring.gold(rows, fitted.centroids, complete=True)


def _measured(spark: SparkSession, folder: str, measure: Callable[[model.Fitted], DataFrame]) -> DataFrame:
    """A one-row measure of a fit, taken while its points are in memory, which are then released."""
    fitted = trained(spark, folder)
    found = rounded(measure(fitted), 4)
    row = found.first()
    fitted.release()
    return spark.createDataFrame([tuple(row)], found.schema)


# --- stored layers and sketches -----------------------------------------------------------


def stored_recent_anomaly_alert(spark: SparkSession, folder: str) -> DataFrame:
    """Write the gold rows of the last months by day, read the newest two days of them back."""
    target = tables.new_folder(spark, "gold-by-day")
    scored = gold(spark, folder).where(F.col("service_ts") >= "2001-09-01")
    tables.write_layer(scored.withColumn("day", F.date_format("service_ts", "yyyy-MM-dd")), target, partition_by=("day",))
    return reports.stored_recent_anomaly_alert(spark, target)


def drift_check(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly sketches of 1996 and of the raw amounts, merged and held against those of the records before 1996."""
    clean = tables.stage(complete(spark, folder).select(*DEFAULTS.feature_columns, "service_ts"), "drift")
    before = drift.sketches(clean.where(F.col("service_ts") < "1996-01-01"), DEFAULTS.feature_columns)
    month = F.date_format("service_ts", "yyyy-MM").alias("month")
    later = clean.where(F.year("service_ts") == 1996).select(*DEFAULTS.feature_columns, month)
    monthly = tables.stage(drift.sketches(later, DEFAULTS.feature_columns, ("month",)), "sketches")
    raw = bronze(spark, folder).withColumn("billed_amount", F.abs("billed_amount") * 2)
    found = drift.merged(monthly).withColumn("layer", F.lit("claims_features"))
    found = found.unionByName(drift.sketches(raw, ("billed_amount",)).withColumn("layer", F.lit("claims_bronze")))
    return drift.drift_check(found, before, by=("layer",)).select("layer", "feature", F.col("n").alias("n_rows"), "alert")


# --- streams ------------------------------------------------------------------------------


def _claim_stream(spark: SparkSession, folder: str, arrivals: str, period: str = "yyyy-MM-dd") -> DataFrame:
    """Order lines as a file stream; the orders are a stored table beside it."""
    lines = scorer.read_files(spark, f"{arrivals}/*", table(spark, folder, "lineitem").schema)
    return scorer.clean_stream(claims.claims_from_line_items(lines, table(spark, folder, "orders")), period=period)


def _delivered(
    spark: SparkSession,
    folder: str,
    label: str,
    shape: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, str, str], StreamingQuery] = scorer.write_new,
    period: str = "yyyy-MM-dd",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Two deliveries, each processed by a run of its own: odd orders first, then even ones and some odd ones again.

    Both hold dates from the whole range, so the second one is late throughout. ``finish`` is for the new records of each.
    """
    write = partial(write, finish=finish) if finish else write
    lines = table(spark, folder, "lineitem")
    arrivals, target, progress = (tables.new_folder(spark, f"{label}-{part}") for part in ("arrivals", "out", "progress"))
    key = F.col("l_orderkey")
    for i, part in enumerate((key % 2 == 1, (key % 2 == 0) | (key % 7 == 1))):
        lines.filter(part).write.option("compression", "zstd").parquet(f"{arrivals}/delivery={i}")
        stream = shape(_claim_stream(spark, folder, arrivals, period))
        write(stream, target, progress).awaitTermination()
    return scorer.read_target(spark, target, (finish(stream) if finish else stream).schema)


def stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(spark, folder, "stream-silver", lambda stream: stream)


def stream_silver_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same with copies of the last three years' records found in state, and only older ones in the target."""
    three_years = 3 * 365 * 86_400

    def write(stream: DataFrame, target: str, progress: str) -> StreamingQuery:
        return scorer.write_new_by_state(stream, target, progress, CLAIMS.event_time, three_years)

    return _delivered(spark, folder, "stream-state", lambda stream: stream, write, "yyyy-MM")


def stream_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Score the stream with the baseline, scale and anomaly cluster of the stored records."""
    clean = tables.stage(silver(spark, folder), "silver")
    small = providers_fit(spark, folder)
    baseline = tables.stage(feat.provider_baseline(clean), "baseline")
    built = cleansing.drop_incomplete(feat.features(clean, small=small, baseline=baseline))
    scale = feat.population_moments(built, BAND.columns).first()
    placed = replace(
        BAND,
        means=tuple(scale[f"mean_{c}"] for c in BAND.columns),
        deviations=tuple(scale[f"sd_{c}"] for c in BAND.columns),
    )
    worst = clusters.anomaly_cluster(clusters.assign(built, placed)).first()["anomaly_cluster"]

    def scored(records: DataFrame) -> DataFrame:
        return scorer.score_stream(records, baseline, placed, worst, small=small)

    if not small:  # the join exchanges the records, which then have to be dealt by day
        return _delivered(spark, folder, "stream-gold", scored)
    return _delivered(spark, folder, "stream-gold", lambda stream: stream, finish=scored)


def _cut(columns: tuple[str, ...], build: Query) -> Query:
    return lambda s, d: build(s, d).select(*columns)


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "claims_bronze": bronze,
        "scan_layer": lambda s, d: table(s, d, "orders"),
        "inject_defects": inject_defects,
        "inject_defects_events": inject_defects_events,
        "sink_roundtrip": sink_roundtrip,
        "partitioned_scan": partitioned_scan,
        "clustered_scan": clustered_scan,
        "gold_sample": gold_sample,
        # cleansing
        "dedup_exact": lambda s, d: cleansing.drop_exact_duplicates(bronze(s, d)),
        "drop_invalid_code": lambda s, d: cleansing.drop_invalid_code(bronze(s, d)),
        "drop_invalid_code_compat": lambda s, d: cleansing.drop_invalid_code(bronze(s, d), compat=True),
        "impute_code": lambda s, d: cleansing.impute_code(bronze(s, d)),
        "impute_code_compat": lambda s, d: cleansing.impute_code(bronze(s, d), compat=True),
        "abs_amount": lambda s, d: cleansing.absolute_amounts(bronze(s, d)),
        "cap_outliers": lambda s, d: cleansing.cap_amounts(cleansing.absolute_amounts(bronze(s, d))),
        "silver_claims": silver,
        "silver_claims_compat": silver_compat,
        "cleansing_metrics": lambda s, d: cleansing.cleansing_metrics(bronze(s, d)),
        "cleansing_metrics_compat": lambda s, d: cleansing.cleansing_metrics(bronze(s, d), compat=True),
        "silver_checks": lambda s, d: cleansing.post_clean_checks(silver(s, d)),
        "silver_checks_compat": lambda s, d: cleansing.post_clean_checks(silver_compat(s, d)),
        "drop_incomplete": lambda s, d: cleansing.drop_incomplete(bronze(s, d)),
        "incomplete_count": lambda s, d: cleansing.incomplete_count(bronze(s, d)),
        # expectations
        "expect_bronze": lambda s, d: expectations.check_layer(bronze(s, d), "bronze", "claims_bronze"),
        "expect_silver": lambda s, d: expectations.check_layer(silver(s, d), "silver", "claims_silver"),
        "expect_silver_compat": lambda s, d: expectations.check_layer(
            silver_compat(s, d), "silver", "claims_silver", compat=True
        ),
        "expect_features": lambda s, d: expectations.check_layer(features(s, d), "features", "claims_features"),
        "feature_checks": lambda s, d: feat.feature_checks(features(s, d)),
        "expectation_report": lambda s, d: expectations.report(all_results(s, d)),
        "expectation_findings": lambda s, d: expectations.findings(all_results(s, d)),
        "incident_severity": lambda s, d: expectations.incident_severity(expectations.report(all_results(s, d))),
        # baselines and features
        "provider_baseline": lambda s, d: feat.provider_baseline(silver(s, d)),
        "provider_baseline_events": provider_baseline_events,
        "provider_baseline_delivered": provider_baseline_delivered,
        "features_of_days": features_of_days,
        "features_bucketed": features_bucketed,
        "provider_join": provider_join,
        "provider_baseline_window": provider_baseline_window,
        "ratio_feature": _cut((*ID, "billed_amount", feat.RATIO), features),
        "zscore_feature": _cut((*ID, "billed_amount", feat.Z), features),
        "above_k_std": _cut((*ID, "billed_amount", feat.ABOVE), features),
        "features": features,
        "features_events": lambda s, d: event_features(s, d).select(
            "event_id", "user_id", "value", *feat.BASELINE_COLUMNS, feat.RATIO, feat.Z, feat.ABOVE
        ),
        "feature_stats": lambda s, d: rounded(feat.feature_stats(features(s, d))),
        "standardize": lambda s, d: rounded(
            feat.standardize(complete(s, d)).select(
                *ID, "billed_amount", *[f"std_{c}" for c in DEFAULTS.feature_columns]
            )
        ),
        # clusters and scores at fixed centres
        "assign_fixed_centroids": lambda s, d: rounded(
            assigned(s, d, TAIL).select(*ID, "billed_amount", clusters.CLUSTER, clusters.DISTANCE)
        ),
        "cluster_profile": lambda s, d: rounded(clusters.cluster_profile(assigned(s, d, TAIL)), 4),
        "anomaly_cluster": lambda s, d: rounded(clusters.anomaly_cluster(assigned(s, d, BAND))),
        "inertia": lambda s, d: rounded(clusters.inertia(assigned(s, d, TAIL)), 4),
        "silhouette_sq": lambda s, d: rounded(clusters.silhouette_squared(assigned(s, d, TAIL, keep=True), TAIL)),
        "silhouette_sq_band": lambda s, d: rounded(clusters.silhouette_squared(assigned(s, d, BAND, keep=True), BAND)),
        "anomaly_flag": _cut((*ID, "billed_amount", clusters.CLUSTER, "is_anomaly"), gold),
        "anomaly_confidence": _cut((*ID, "billed_amount", "is_anomaly", "anomaly_confidence"), gold),
        "risk_level": _cut((*ID, "billed_amount", "anomaly_confidence", "risk_level"), gold),
        "gold_fixed_centroids": gold,
        "gold_fixed_centroids_tail": lambda s, d: gold(s, d, TAIL),
        "gold_trained_scale": lambda s, d: gold(s, d, TRAINED),
        "gold_refit_scale": lambda s, d: gold(s, d, TRAINED, refit_scale=True),
        "gold_events": lambda s, d: scoring.gold(event_features(s, d), EVENT_BAND),
        # reports
        "anomaly_summary": lambda s, d: reports.anomaly_summary(gold(s, d)),
        "risk_counts": lambda s, d: reports.risk_counts(gold(s, d)),
        "risk_distribution": lambda s, d: rounded(reports.risk_distribution(gold(s, d)), 4),
        "daily_anomaly_rate": lambda s, d: reports.daily_anomaly_rate(gold(s, d)),
        "weekly_anomaly_trend": lambda s, d: reports.weekly_anomaly_trend(gold(s, d)),
        "top_anomalous_providers": lambda s, d: reports.top_anomalous_providers(gold(s, d)),
        "recent_anomaly_alert": lambda s, d: reports.recent_anomaly_alert(gold(s, d)),
        "training_size_check": lambda s, d: reports.training_size_check(features(s, d)),
        "flagged_claims": lambda s, d: reports.flagged_claims(
            gold(s, d), (*ID, "billed_amount", feat.RATIO, "anomaly_confidence", "risk_level"), (*ID, "billed_amount")
        ),
        # monitoring
        "retention_check": lambda s, d: monitoring.retention_check(bronze(s, d)),
        "anomaly_rate_check": lambda s, d: monitoring.anomaly_rate_check(gold(s, d)),
        "null_share_check": lambda s, d: monitoring.null_share_check(
            features(s, d), (*feat.BASELINE_COLUMNS, feat.RATIO, feat.Z, feat.ABOVE)
        ),
        "drift_check": drift_check,
        "stored_recent_anomaly_alert": stored_recent_anomaly_alert,
        "silhouette_check_fixed": lambda s, d: monitoring.silhouette_check(
            rounded(clusters.silhouette_squared(assigned(s, d, TAIL, keep=True), TAIL)), "silhouette_sq"
        ),
        # fitted model
        "kmeans_fit": kmeans_fit,
        "kmeans_assign": kmeans_assign,
        "silhouette_sq_fitted": lambda s, d: _measured(s, d, model.evaluate).select("silhouette_sq", "n_samples"),
        "silhouette_check": lambda s, d: monitoring.silhouette_check(_measured(s, d, model.evaluate), "silhouette_sq"),
        "model_metrics": lambda s, d: _measured(s, d, model.metrics_row),
        "train_metrics": lambda s, d: _measured(s, d, model.evaluate),
        "gold_anomalies": gold_anomalies,
        # streams
        "stream_silver": stream_silver,
        "stream_silver_state": stream_silver_state,
        "stream_gold": stream_gold,
    }
