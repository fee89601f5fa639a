"""The queries of the catalogue as plain SQL over the same tables, to check results against."""

from __future__ import annotations

from claimsieve.operators import model
from claimsieve.params import DEFAULTS

_CTES: dict[str, str] = {}

_CTES["base"] = """
SELECT concat('CLM-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS claim_id,
       concat('PAT-', o_custkey) AS patient_id,
       concat('HOSP-', lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS hospital_id,
       CASE l_partkey % 6 WHEN 0 THEN 'J01.90' WHEN 1 THEN 'E11.9' WHEN 2 THEN 'I10'
                          WHEN 3 THEN 'M54.5' WHEN 4 THEN 'Z00.00' ELSE 'R53.83' END AS clean_code,
       CASE l_orderkey % 4 WHEN 0 THEN 'INVALID-CODE-999' WHEN 1 THEN 'BAD-ICD' WHEN 2 THEN '' END AS bad_code,
       CAST(round(l_extendedprice * 5) AS BIGINT) AS cents,
       (l_orderkey * 31 + l_linenumber * 7 + l_partkey) % 30 AS kind,
       CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'N' THEN 'PENDING' WHEN 'R' THEN 'DENIED' END AS claim_status,
       l_shipdate AS service_ts, l_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_CTES["injected"] = """
SELECT claim_id, patient_id, hospital_id,
       CASE WHEN kind < 3 THEN bad_code ELSE clean_code END AS diagnosis_code,
       CAST(CASE kind WHEN 0 THEN -cents WHEN 1 THEN cents * 100 WHEN 2 THEN 0 ELSE cents END AS DOUBLE)
           / CAST(100 AS DOUBLE) AS billed_amount,
       claim_status, service_ts, l_orderkey
FROM base"""

_CTES["bronze"] = """
SELECT * EXCLUDE (l_orderkey) FROM injected
UNION ALL
SELECT * EXCLUDE (l_orderkey) FROM injected WHERE l_orderkey % 50 = 0"""

_CTES["silver"] = """
SELECT claim_id, patient_id, hospital_id, coalesce(nullif(diagnosis_code, ''), 'UNKNOWN') AS diagnosis_code,
       abs(billed_amount) AS billed_amount, claim_status, service_ts
FROM (SELECT DISTINCT * FROM bronze)
WHERE diagnosis_code IS DISTINCT FROM 'INVALID-CODE-999' AND abs(billed_amount) < 50000"""

_CTES["silver_compat"] = """
SELECT claim_id, patient_id, hospital_id, coalesce(diagnosis_code, 'UNKNOWN') AS diagnosis_code,
       abs(billed_amount) AS billed_amount, claim_status, service_ts
FROM (SELECT DISTINCT * FROM bronze)
WHERE diagnosis_code <> 'INVALID-CODE-999' AND abs(billed_amount) < 50000"""


def _baseline(source: str, key: str, amount: str, record: str) -> str:
    return f"""
SELECT {key}, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100 AS DOUBLE) AS hosp_avg_billed,
       lo AS hosp_min_billed, hi AS hosp_max_billed,
       CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE)))
                            / CAST(100 AS DOUBLE) END AS hosp_stddev_billed,
       records AS hosp_claim_count
FROM (SELECT {key}, CAST(count(c) AS HUGEINT) AS n, CAST(sum(c) AS HUGEINT) AS s, CAST(sum(c * c) AS HUGEINT) AS q,
             min({amount}) AS lo, max({amount}) AS hi, count({record}) AS records
      FROM (SELECT *, CAST(round({amount} * 100) AS BIGINT) AS c FROM {source}) GROUP BY {key})"""


def _features(source: str, baseline: str, key: str, amount: str) -> str:
    return f"""
SELECT *, coalesce(amount_z_score > 2, false) AS is_above_2std
FROM (SELECT {source}.*, {baseline}.* EXCLUDE ({key}),
             round({amount} / nullif(hosp_avg_billed, 0), 3) AS amount_to_avg_ratio,
             CASE WHEN hosp_stddev_billed > 0 THEN ({amount} - hosp_avg_billed) / hosp_stddev_billed
                  ELSE CAST(0 AS DOUBLE) END AS amount_z_score
      FROM {source} LEFT JOIN {baseline} USING ({key}))"""


_CTES["baseline"] = _baseline("silver", "hospital_id", "billed_amount", "claim_id")
_CTES["features"] = _features("silver", "baseline", "hospital_id", "billed_amount")
_CTES["event_baseline"] = _baseline("events", "user_id", "value", "event_id")
_CTES["event_features"] = _features("events", "event_baseline", "user_id", "value")

_FEATURES = DEFAULTS.feature_columns
_EVENT_FEATURES = ("value", *_FEATURES[1:])
_BUILT_COLUMNS = "hosp_avg_billed IS NOT NULL AND hosp_stddev_billed IS NOT NULL AND amount_to_avg_ratio IS NOT NULL"
_CTES["complete"] = f"""
SELECT * FROM features
WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND hospital_id IS NOT NULL AND diagnosis_code IS NOT NULL
  AND billed_amount IS NOT NULL AND claim_status IS NOT NULL AND service_ts IS NOT NULL AND {_BUILT_COLUMNS}"""
_CTES["event_complete"] = f"""
SELECT * FROM event_features
WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
  AND value IS NOT NULL AND props IS NOT NULL AND {_BUILT_COLUMNS}"""


def _moments(source: str, columns: tuple[str, ...]) -> str:
    return "SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(columns)) + f" FROM {source}"


def _placed(source: str, moments: str, columns: tuple[str, ...]) -> str:
    x = [f"CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE CAST(0 AS DOUBLE) END AS x{i}" for i, c in enumerate(columns)]
    return f"SELECT {source}.*, " + ", ".join(x) + f" FROM {source}, {moments}"


_CTES["moments"] = _moments("complete", _FEATURES)
_CTES["event_moments"] = _moments("event_complete", _EVENT_FEATURES)
_CTES["trained_moments"] = """
SELECT 2600::DOUBLE AS m0, 2000::DOUBLE AS s0, 2600::DOUBLE AS m1, 80::DOUBLE AS s1, 1::DOUBLE AS m2, 0.75::DOUBLE AS s2"""
_CTES["placed"] = _placed("complete", "moments", _FEATURES)
_CTES["event_placed"] = _placed("event_complete", "event_moments", _EVENT_FEATURES)
_CTES["trained_placed"] = _placed("complete", "trained_moments", _FEATURES)


def _assigned(values: tuple[float, float, float], placed: str = "placed") -> str:
    d = [f"((x0 - ({v}::DOUBLE)) ** 2 + x1 ** 2 + (x2 - ({v}::DOUBLE)) ** 2)" for v in values]
    return f"""
SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster_prediction,
       least(d0, d1, d2) AS squared_distance
FROM (SELECT *, {d[0]} AS d0, {d[1]} AS d1, {d[2]} AS d2 FROM {placed})"""


_CTES["tail"] = _assigned((0.0, 6.0, 14.0))
_CTES["band"] = _assigned((-0.5, 0.25, 1.0))
_CTES["event_band"] = _assigned((-0.5, 0.25, 1.0), "event_placed")
_CTES["trained_band"] = _assigned((-0.5, 0.25, 1.0), "trained_placed")


def _worst(assigned: str) -> str:
    return f"""
SELECT CASE WHEN count(*) >= 2 THEN first(cluster_prediction ORDER BY mean_ratio DESC, cluster_prediction) END
           AS anomaly_cluster, count(*) AS n_clusters, max(mean_ratio) AS highest_mean_ratio
FROM (SELECT cluster_prediction, avg(amount_to_avg_ratio) AS mean_ratio FROM {assigned} GROUP BY 1)"""


def _gold(assigned: str, worst: str) -> str:
    return f"""
SELECT *, CASE WHEN is_anomaly THEN CASE WHEN anomaly_confidence > 0.7::DOUBLE THEN 'HIGH'
                                         WHEN anomaly_confidence > 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END
               WHEN amount_to_avg_ratio > 1.5::DOUBLE THEN 'REVIEW' ELSE 'NORMAL' END AS risk_level
FROM (SELECT *, CASE WHEN is_anomaly THEN least(1::DOUBLE, (amount_to_avg_ratio - 1::DOUBLE) / 2::DOUBLE)
                     ELSE 0::DOUBLE END AS anomaly_confidence
      FROM (SELECT a.* EXCLUDE (x0, x1, x2, d0, d1, d2, squared_distance),
                   coalesce(cluster_prediction = anomaly_cluster AND amount_to_avg_ratio > 1.1::DOUBLE, false)
                       AS is_anomaly
            FROM {assigned} a, {worst}))"""


_CTES["worst_band"] = _worst("band")
_CTES["worst_tail"] = _worst("tail")
_CTES["worst_event"] = _worst("event_band")
_CTES["worst_trained"] = _worst("trained_band")
_CTES["gold"] = _gold("band", "worst_band")
_CTES["gold_event"] = _gold("event_band", "worst_event")
_CTES["gold_trained"] = _gold("trained_band", "worst_trained")
_CTES["gold_tail"] = _gold("tail", "worst_tail")


def _draw(salt: int) -> str:
    """The mix of a point's grid values with a salt that its priority as a seed is divided by."""
    m = model._MODULUS
    mixed = str(salt * model._SALT % m)
    for i, factor in enumerate(model._FACTORS):
        mixed = f"(({mixed} + ((x{i} % {m} + {m}) % {m}) * {factor % m}) % {m})"
    return f"({mixed} * 48271 % {m} + 1)"


_POINT = "x0, x1, x2"
_BETWEEN = " + ".join(f"({{a}}.x{i} - {{b}}.x{i}) * ({{a}}.x{i} - {{b}}.x{i})" for i in range(3))


def _seeded(known: str, salt: int) -> str:
    """The known candidates and the points of the highest priority."""
    return f"""
SELECT * FROM {known}
UNION ALL
(SELECT {_POINT} FROM (
   SELECT p.x0, p.x1, p.x2, min({_BETWEEN.format(a="p", b="c")}) AS far
   FROM (SELECT DISTINCT {_POINT} FROM grid) p, {known} c GROUP BY ALL)
 WHERE far > 0 ORDER BY far::DOUBLE / {_draw(salt)}::DOUBLE DESC, {_POINT} LIMIT {model.SEEDS})"""


def _nearest(d: str = "d") -> str:
    return f"CASE WHEN {d}0 <= {d}1 AND {d}0 <= {d}2 THEN 0 WHEN {d}1 <= {d}2 THEN 1 ELSE 2 END"


_GRID_D = ", ".join(
    f"(x0 - c{j}0) * (x0 - c{j}0) + (x1 - c{j}1) * (x1 - c{j}1) + (x2 - c{j}2) * (x2 - c{j}2) AS d{j}" for j in range(3)
)
_FLAT = ", ".join(f"max(CASE WHEN j = {j} THEN c{i} END) AS c{j}{i}" for j in range(3) for i in range(3))


def _mean(a: str, n: str) -> str:
    """A rounded quotient of whole numbers: the remainder is taken with the sign of the divisor."""
    return f"CAST(((2 * {a} + {n}) - (((2 * {a} + {n}) % (2 * {n})) + 2 * {n}) % (2 * {n})) // (2 * {n}) AS BIGINT)"


_CTES["points"] = "SELECT " + ", ".join(
    f"CAST(floor({c} * 1000::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS u{i}" for i, c in enumerate(_FEATURES)
) + ", CAST(count(*) AS HUGEINT) AS w FROM complete GROUP BY ALL"
_CTES["unit_moments"] = "SELECT " + ", ".join(
    f"sum(w * u{i})::HUGEINT::DOUBLE / sum(w)::HUGEINT::DOUBLE AS um{i}, "
    f"sqrt((sum(w)::HUGEINT * sum(w * u{i} * u{i})::HUGEINT - sum(w * u{i})::HUGEINT * sum(w * u{i})::HUGEINT)::DOUBLE)"
    f" / sum(w)::HUGEINT::DOUBLE AS us{i}"
    for i in range(3)
) + " FROM points"
_CTES["grid"] = "SELECT u0, u1, u2, w, " + ", ".join(
    f"CASE WHEN us{i} > 0 THEN CAST(floor((u{i}::DOUBLE - um{i}) / us{i} * 4096::DOUBLE + 0.5::DOUBLE) AS BIGINT) ELSE 0 END AS x{i}"
    for i in range(3)
) + " FROM points, unit_moments"
_CTES["seeds0"] = "SELECT 0::BIGINT AS x0, 0::BIGINT AS x1, 0::BIGINT AS x2"
for _turn in range(model.ROUNDS):
    _CTES[f"seeds{_turn + 1}"] = _seeded(f"seeds{_turn}", DEFAULTS.seed + _turn)
_CTES["candidates"] = f"SELECT row_number() OVER (ORDER BY {_POINT}) AS c, {_POINT} FROM seeds{model.ROUNDS}"
_CTES["weighed"] = f"""
SELECT c.*, coalesce(n, 0) AS n
FROM candidates c LEFT JOIN (
  SELECT c, sum(w)::HUGEINT AS n
  FROM (SELECT {", ".join(f"p.x{i}" for i in range(3))}, p.w, arg_min(c.c, ({_BETWEEN.format(a="p", b="c")}, c.c)) AS c
        FROM (SELECT {_POINT}, sum(w) AS w FROM grid GROUP BY ALL) p, candidates c GROUP BY ALL)
  GROUP BY c) USING (c)"""
_CTES["apart"] = f"SELECT p.c AS p, q.c AS q, p.n * ({_BETWEEN.format(a='p', b='q')}) AS d FROM weighed p, weighed q"
_CTES["start"] = """
SELECT x.q AS j0, y.q AS j1, z.q AS j2, sum(least(x.d, y.d, z.d)) AS cost
FROM apart x JOIN apart y ON x.p = y.p AND x.q < y.q JOIN apart z ON y.p = z.p AND y.q < z.q
GROUP BY ALL ORDER BY cost, j0, j1, j2 LIMIT 1"""
_EACH = [(j, i) for j in range(3) for i in range(3)]
_CTES["fit"] = f"""
SELECT 0 AS it, true AS moving, {", ".join(f"(SELECT x{i} FROM candidates WHERE c = j{j}) AS c{j}{i}" for j, i in _EACH)} FROM start
UNION ALL
SELECT it + 1, {" OR ".join(f"n{j}{i} <> c{j}{i}" for j, i in _EACH)}, {", ".join(f"n{j}{i}" for j, i in _EACH)}
FROM (SELECT f.*, {", ".join(f"CASE WHEN m{j} > 0 THEN {_mean(f'a{j}{i}', f'm{j}')} ELSE c{j}{i} END AS n{j}{i}" for j, i in _EACH)}
      FROM fit f, (
        SELECT {", ".join(f"coalesce(sum(w) FILTER (WHERE j = {j}), 0)::HUGEINT AS m{j}" for j in range(3))},
               {", ".join(f"sum(w * x{i}) FILTER (WHERE j = {j})::HUGEINT AS a{j}{i}" for j, i in _EACH)}
        FROM (SELECT w, x0, x1, x2, {_nearest()} AS j FROM (SELECT w, x0, x1, x2, {_GRID_D} FROM grid, fit)))
      WHERE f.moving AND f.it < {DEFAULTS.max_iter})"""
_CTES["centers"] = f"""
SELECT row_number() OVER (ORDER BY c2, c0, c1) - 1 AS j, c0 / 4096::DOUBLE AS c0, c1 / 4096::DOUBLE AS c1, c2 / 4096::DOUBLE AS c2
FROM (SELECT unnest([{", ".join(f"{{'c0': c{j}0, 'c1': c{j}1, 'c2': c{j}2}}" for j in range(3))}], recursive := true)
      FROM (SELECT * FROM fit ORDER BY it DESC LIMIT 1))"""
_CTES["fitted_scale"] = f"""
SELECT {_FLAT}, {", ".join(f"any_value(um{i} / 1000::DOUBLE) AS m{i}, any_value(us{i} / 1000::DOUBLE) AS s{i}" for i in range(3))}
FROM centers, unit_moments"""


def _fitted(rows: str, columns: tuple[str, ...]) -> str:
    """Rows placed on the fitted scale, with their nearest fitted centre."""
    x = ", ".join(f"CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0::DOUBLE END AS x{i}" for i, c in enumerate(columns))
    return f"""
SELECT * EXCLUDE (c00, c01, c02, c10, c11, c12, c20, c21, c22), {_nearest()} AS cluster_prediction,
       least(d0, d1, d2) AS squared_distance
FROM (SELECT *, {_GRID_D}
      FROM (SELECT r.*, {", ".join(f"c{j}{i}" for j in range(3) for i in range(3))}, {x} FROM {rows} r, fitted_scale))"""


_CTES["fitted_rows"] = _fitted("complete", _FEATURES)
_CTES["fitted_points"] = _fitted("points", tuple(f"u{i} / 1000::DOUBLE" for i in range(3)))
_CTES["worst_fitted"] = _worst("fitted_rows")
_CTES["gold_fitted"] = _gold("fitted_rows", "worst_fitted")
_CTES["fitted_measures"] = """
SELECT sum(w * CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) / sum(w) AS silhouette_sq,
       (SELECT sum(w * squared_distance) FROM fitted_points) AS inertia, 3 AS n_clusters, CAST(sum(w) AS BIGINT) AS n_samples
FROM (SELECT id, any_value(w) AS w, max(CASE WHEN j = cluster_prediction THEN n END) AS own_n,
             max(CASE WHEN j = cluster_prediction AND n > 1 THEN d / (n - 1) END) AS a,
             min(CASE WHEN j <> cluster_prediction THEN d / n END) AS b
      FROM (SELECT p.id, p.w, p.cluster_prediction, t.j, t.n,
                   greatest(t.n * (x0 * x0 + x1 * x1 + x2 * x2) - 2 * (x0 * a0 + x1 * a1 + x2 * a2) + q, 0) AS d
            FROM (SELECT row_number() OVER () AS id, * FROM fitted_points) p,
                 (SELECT cluster_prediction AS j, sum(w)::DOUBLE AS n, sum(w * x0) AS a0, sum(w * x1) AS a1, sum(w * x2) AS a2,
                         sum(w * (x0 * x0 + x1 * x1 + x2 * x2)) AS q FROM fitted_points GROUP BY 1) t)
      GROUP BY id)"""


def _checks(layer: str, table: str, source: str, rules: list[tuple[str, str, str, str]], doubled: int = 0) -> str:
    """Expectation rows; a rule is (name, kind, predicate, severity)."""
    hits = ", ".join(f"count(*) FILTER (WHERE {p}) AS v{i}" for i, (_, k, p, _) in enumerate(rules) if k in ("row", "share"))
    parts = []
    for i, (name, kind, _, severity) in enumerate(rules):
        if kind == "filled":
            status, text, v = "CASE WHEN n > 0 THEN 'passed' ELSE 'failed' END", "concat(n, ' records')", "CASE WHEN n > 0 THEN 0 ELSE 1 END"
        elif kind == "schema":
            status, text, v = "'passed'", "'all columns present'", "0"
        else:
            ok = f"v{i} = 0" if kind == "row" else f"v{i} < n * 0.01::DOUBLE"
            status, text, v = f"CASE WHEN {ok} THEN 'passed' ELSE '{severity}' END", f"concat(v{i}, ' of ', n, ' records')", f"v{i}"
        row = (
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, {i + 1} AS check_no, '{name}' AS expectation_name, "
            f"{status} AS status, {text} AS message, n AS record_count, CAST({v} AS BIGINT) AS violations FROM c"
        )
        parts += [row] * (2 if i < doubled else 1)
    return f"(WITH c AS (SELECT count(*) AS n, {hits} FROM {source})\n" + "\nUNION ALL ".join(parts) + ")"


_RAW = [
    ("non_empty_table", "filled", "", ""),
    ("required_columns_exist", "schema", "", ""),
    ("claim_id_not_null", "row", "claim_id IS NULL", "warning"),
    ("billed_amount_populated", "share", "billed_amount IS NULL", "failed"),
]
_CLEAN = _RAW + [
    ("no_negative_amounts", "row", "billed_amount < 0", "failed"),
    ("no_invalid_diagnosis_codes", "row", "diagnosis_code = 'INVALID-CODE-999'", "failed"),
    ("no_extreme_outliers", "row", "billed_amount >= 50000", "failed"),
]
_BUILT = [
    ("required_features_exist", "schema", "", ""),
    ("no_null_ratios", "row", "amount_to_avg_ratio IS NULL", "failed"),
    ("positive_ratios", "row", "amount_to_avg_ratio < 0", "failed"),
]
_CTES["results"] = "\nUNION ALL\n".join(
    f"SELECT * FROM {part}"
    for part in (
        _checks("bronze", "claims_bronze", "bronze", _RAW),
        _checks("silver", "claims_silver", "silver", _CLEAN),
        _checks("features", "claims_features", "features", _BUILT),
        _checks("silver", "claims_bronze", "bronze", _CLEAN),
    )
)
_CTES["report"] = """
SELECT *, passed + failed + warnings AS total_checks, failed = 0 AS is_valid,
       concat(table_name, ': ', passed + failed + warnings, ' checks, ', passed, ' passed, ', failed, ' failed, ',
              warnings, ' warnings: ', CASE WHEN failed = 0 THEN 'VALID' ELSE 'INVALID' END) AS summary
FROM (SELECT table_name, layer, count(*) FILTER (WHERE status = 'passed') AS passed,
             count(*) FILTER (WHERE status = 'failed') AS failed,
             count(*) FILTER (WHERE status = 'warning') AS warnings,
             coalesce(string_agg(expectation_name, ', ' ORDER BY check_no) FILTER (WHERE status = 'failed'), '') AS failed_checks,
             coalesce(string_agg(expectation_name, ', ' ORDER BY check_no) FILTER (WHERE status = 'warning'), '') AS warned_checks
      FROM results GROUP BY table_name, layer)"""

# A CTE needs the ones it reads from; listed once, in build order.
_NEEDS = {
    "base": (),
    "injected": ("base",),
    "bronze": ("injected",),
    "silver": ("bronze",),
    "silver_compat": ("bronze",),
    "baseline": ("silver",),
    "features": ("baseline",),
    "event_baseline": (),
    "event_features": ("event_baseline",),
    "complete": ("features",),
    "moments": ("complete",),
    "placed": ("moments",),
    "tail": ("placed",),
    "band": ("placed",),
    "worst_band": ("band",),
    "worst_tail": ("tail",),
    "gold": ("worst_band",),
    "gold_tail": ("worst_tail",),
    "event_complete": ("event_features",),
    "event_moments": ("event_complete",),
    "event_placed": ("event_moments",),
    "event_band": ("event_placed",),
    "worst_event": ("event_band",),
    "gold_event": ("worst_event",),
    "trained_moments": (),
    "trained_placed": ("complete", "trained_moments"),
    "trained_band": ("trained_placed",),
    "worst_trained": ("trained_band",),
    "gold_trained": ("worst_trained",),
    "points": ("complete",),
    "unit_moments": ("points",),
    "grid": ("unit_moments",),
    "seeds0": ("grid",),
    **{f"seeds{i + 1}": (f"seeds{i}",) for i in range(model.ROUNDS)},
    "candidates": (f"seeds{model.ROUNDS}",),
    "weighed": ("candidates",),
    "apart": ("weighed",),
    "start": ("apart",),
    "fit": ("start",),
    "centers": ("fit",),
    "fitted_scale": ("centers",),
    "fitted_rows": ("fitted_scale",),
    "fitted_points": ("fitted_scale",),
    "worst_fitted": ("fitted_rows",),
    "gold_fitted": ("worst_fitted",),
    "fitted_measures": ("fitted_points",),
    "results": ("features",),
    "report": ("results",),
}


def _closure(name: str) -> list[str]:
    found: list[str] = []
    for need in _NEEDS[name]:
        found += [n for n in _closure(need) if n not in found]
    return found + [name]


def _over(name: str, body: str) -> str:
    """The query body after the CTEs it reads from."""
    needed = _closure(name)
    ctes = ",\n".join(f"{n} AS ({_CTES[n].strip()})" for n in needed)
    return f"WITH {'RECURSIVE ' * ('fit' in needed)}{ctes}\n{body}"


def _metrics(bad: str) -> str:
    return f"""
SELECT initial_count, final_count, initial_count - unique_count AS duplicates_removed,
       invalid_diagnosis_removed, null_diagnosis_imputed, negative_amounts_corrected, outliers_filtered,
       initial_count - final_count AS records_removed,
       CAST(initial_count - final_count AS DOUBLE) / initial_count AS cleansing_rate
FROM (SELECT (SELECT count(*) FROM bronze) AS initial_count, count(*) AS unique_count,
             count(*) FILTER (WHERE NOT bad AND below) AS final_count,
             count(*) FILTER (WHERE bad) AS invalid_diagnosis_removed,
             count(*) FILTER (WHERE NOT bad AND (diagnosis_code IS NULL OR diagnosis_code = '')) AS null_diagnosis_imputed,
             count(*) FILTER (WHERE NOT bad AND billed_amount < 0) AS negative_amounts_corrected,
             count(*) FILTER (WHERE NOT bad AND NOT below) AS outliers_filtered
      FROM (SELECT *, {bad} AS bad, coalesce(abs(billed_amount) < 50000, false) AS below
            FROM (SELECT DISTINCT * FROM bronze)))"""


def _violations(source: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {rule}) AS violations, "
        f"count(*) FILTER (WHERE {rule}) = 0 AS ok FROM {source}"
        for name, rule in rules.items()
    )


def _silhouette(assigned: str) -> str:
    return f"""
, totals AS (SELECT cluster_prediction AS j, CAST(count(*) AS DOUBLE) AS n, sum(x0) AS a0, sum(x1) AS a1, sum(x2) AS a2,
                    sum(x0 * x0 + x1 * x1 + x2 * x2) AS q FROM {assigned} GROUP BY 1),
numbered AS (SELECT row_number() OVER () AS id, * FROM {assigned}),
gaps AS (SELECT id, cluster_prediction, j, n,
                greatest(n * (x0 * x0 + x1 * x1 + x2 * x2) - 2 * (x0 * a0 + x1 * a1 + x2 * a2) + q, 0) AS d
         FROM numbered, totals),
scores AS (SELECT id, max(CASE WHEN j = cluster_prediction THEN n END) AS own_n,
                  max(CASE WHEN j = cluster_prediction AND n > 1 THEN d / (n - 1) END) AS a,
                  min(CASE WHEN j <> cluster_prediction THEN d / n END) AS b
           FROM gaps GROUP BY id)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END), 6) AS silhouette_sq,
       count(*) AS n_samples FROM scores"""


def _rounded(value: str) -> str:
    """Six digits, and zero without a sign."""
    return f"CASE WHEN round({value}, 6) = 0 THEN 0::DOUBLE ELSE round({value}, 6) END"


#: Layer, feature, its rows now as (value), and the training rows are those before 1996.
DRIFTS = [
    *[("claims_features", c, f"SELECT {c} AS v FROM complete WHERE year(service_ts) = 1996") for c in _FEATURES],
    ("claims_bronze", "billed_amount", "SELECT abs(billed_amount) * 2 AS v FROM bronze"),
]


def _drift(compared: tuple[str, str, str]) -> str:
    """The exact largest difference of two cumulative shares against the threshold."""
    layer, feature, now = compared
    return f"""
SELECT '{layer}' AS layer, '{feature}' AS feature, any_value(n_all)::BIGINT AS n_rows, max(abs(a - b)) > 0.1 AS alert
FROM (SELECT sum(o) OVER w / sum(o) OVER () AS a, sum(n) OVER w / sum(n) OVER () AS b, sum(n) OVER () AS n_all
      FROM (SELECT v, sum(o) AS o, sum(n) AS n
            FROM (SELECT {feature} AS v, 1 AS o, 0 AS n FROM complete WHERE service_ts < '1996-01-01'
                  UNION ALL SELECT v, 0, 1 FROM ({now}))
            GROUP BY v) WINDOW w AS (ORDER BY v))"""


_RATE = "count(*) FILTER (WHERE is_anomaly) / count(*)"
_ID = "claim_id, patient_id, hospital_id, service_ts"
_BASELINE = "hosp_avg_billed, hosp_min_billed, hosp_max_billed, hosp_stddev_billed, hosp_claim_count"
_NULL_CHECKED = (*_BASELINE.split(", "), "amount_to_avg_ratio", "amount_z_score", "is_above_2std")
_POST_CLEAN = {
    "negative_amount": "billed_amount < 0",
    "null_record_id": "claim_id IS NULL",
    "empty_code": "diagnosis_code = ''",
}
_BRONZE_CODES = "claim_id, patient_id, hospital_id, {} AS diagnosis_code, billed_amount, claim_status, service_ts"


def oracle_sql() -> dict[str, str]:
    tail_silhouette = _over("tail", "").rstrip() + _silhouette("tail")
    return {
        "claims_bronze": _over("bronze", "SELECT * FROM bronze"),
        "scan_layer": "SELECT * FROM orders",
        "inject_defects": _over("injected", "SELECT * EXCLUDE (l_orderkey) FROM injected"),
        "inject_defects_events": """
SELECT event_id, user_id,
       CASE WHEN event_id % 30 < 3 THEN CASE event_id % 3 WHEN 0 THEN 'INVALID-CODE-999' WHEN 1 THEN 'BAD-ICD' ELSE '' END
            ELSE event_type END AS event_type,
       CAST(CASE event_id % 30 WHEN 0 THEN -c WHEN 1 THEN c * 100 WHEN 2 THEN 0 ELSE c END AS DOUBLE)
           / CAST(100 AS DOUBLE) AS value
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)""",
        "sink_roundtrip": _over(
            "bronze",
            """SELECT claim_status, count(*) AS n_rows, CAST(sum(CAST(round(billed_amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM (SELECT * FROM bronze UNION ALL SELECT * EXCLUDE (l_orderkey) FROM injected) GROUP BY 1""",
        ),
        "partitioned_scan": _over(
            "bronze",
            """SELECT strftime(service_ts, '%Y-%m') AS claim_month, count(*) AS n_rows,
       CAST(sum(CAST(round(billed_amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM bronze WHERE strftime(service_ts, '%Y-%m') BETWEEN '1995-03' AND '1995-05' GROUP BY 1""",
        ),
        "clustered_scan": _over(
            "bronze",
            """SELECT hospital_id, count(*) AS n_rows, CAST(sum(CAST(round(billed_amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM bronze WHERE hospital_id BETWEEN 'HOSP-000001' AND 'HOSP-000004' OR strftime(service_ts, '%Y-%m') BETWEEN '1995-03' AND '1995-05'
GROUP BY 1""",
        ),
        "gold_sample": _over(
            "gold",
            f"""SELECT claim_id, patient_id, hospital_id, billed_amount, amount_to_avg_ratio, cluster_prediction, is_anomaly,
       anomaly_confidence, risk_level FROM gold ORDER BY {_ID}, billed_amount LIMIT 10""",
        ),
        "dedup_exact": _over("bronze", "SELECT DISTINCT * FROM bronze"),
        "drop_invalid_code": _over(
            "bronze", "SELECT * FROM bronze WHERE diagnosis_code IS DISTINCT FROM 'INVALID-CODE-999'"
        ),
        "drop_invalid_code_compat": _over("bronze", "SELECT * FROM bronze WHERE diagnosis_code <> 'INVALID-CODE-999'"),
        "impute_code": _over(
            "bronze",
            f"SELECT {_BRONZE_CODES.format("CASE WHEN diagnosis_code IS NULL OR diagnosis_code = '' THEN 'UNKNOWN' ELSE diagnosis_code END")} FROM bronze",
        ),
        "impute_code_compat": _over(
            "bronze", f"SELECT {_BRONZE_CODES.format("coalesce(diagnosis_code, 'UNKNOWN')")} FROM bronze"
        ),
        "abs_amount": _over("bronze", "SELECT * REPLACE (abs(billed_amount) AS billed_amount) FROM bronze"),
        "cap_outliers": _over(
            "bronze",
            "SELECT * REPLACE (abs(billed_amount) AS billed_amount) FROM bronze WHERE abs(billed_amount) < 50000",
        ),
        "silver_claims": _over("silver", "SELECT * FROM silver"),
        "silver_claims_compat": _over("silver_compat", "SELECT * FROM silver_compat"),
        "cleansing_metrics": _over("bronze", _metrics("diagnosis_code IS NOT DISTINCT FROM 'INVALID-CODE-999'")),
        "cleansing_metrics_compat": _over(
            "bronze", _metrics("(diagnosis_code IS NULL OR diagnosis_code = 'INVALID-CODE-999')")
        ),
        "silver_checks": _over("silver", _violations("silver", _POST_CLEAN)),
        "silver_checks_compat": _over("silver_compat", _violations("silver_compat", _POST_CLEAN)),
        "drop_incomplete": _over(
            "bronze",
            """SELECT * FROM bronze WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND hospital_id IS NOT NULL
  AND diagnosis_code IS NOT NULL AND billed_amount IS NOT NULL AND claim_status IS NOT NULL AND service_ts IS NOT NULL""",
        ),
        "incomplete_count": _over(
            "bronze",
            """SELECT count(*) FILTER (WHERE complete) AS kept, count(*) FILTER (WHERE NOT complete) AS dropped
FROM (SELECT claim_id IS NOT NULL AND patient_id IS NOT NULL AND hospital_id IS NOT NULL AND diagnosis_code IS NOT NULL
         AND billed_amount IS NOT NULL AND claim_status IS NOT NULL AND service_ts IS NOT NULL AS complete FROM bronze)""",
        ),
        "expect_bronze": _over("bronze", "SELECT * FROM " + _checks("bronze", "claims_bronze", "bronze", _RAW)),
        "expect_silver": _over("silver", "SELECT * FROM " + _checks("silver", "claims_silver", "silver", _CLEAN)),
        "expect_silver_compat": _over(
            "silver_compat",
            "SELECT * FROM " + _checks("silver", "claims_silver", "silver_compat", _CLEAN, doubled=len(_RAW)),
        ),
        "expect_features": _over(
            "features", "SELECT * FROM " + _checks("features", "claims_features", "features", _BUILT)
        ),
        "feature_checks": _over(
            "features",
            _violations(
                "features",
                {"null_ratio": "amount_to_avg_ratio IS NULL", "extreme_ratio": "amount_to_avg_ratio > 1000"},
            ),
        ),
        "expectation_report": _over("report", "SELECT * FROM report"),
        "expectation_findings": _over("results", "SELECT * FROM results WHERE status IN ('failed', 'warning')"),
        "incident_severity": _over(
            "report",
            """SELECT table_name, layer, failed, total_checks, share AS failed_share,
       CASE WHEN failed = 0 THEN 'NONE' WHEN share > 0.5::DOUBLE THEN 'HIGH' WHEN share >= 0.1::DOUBLE THEN 'MEDIUM'
            ELSE 'LOW' END AS severity
FROM (SELECT *, coalesce(failed / nullif(total_checks, 0), 0::DOUBLE) AS share FROM report)""",
        ),
        "provider_baseline": _over("baseline", "SELECT * FROM baseline"),
        "provider_baseline_delivered": _over("baseline", "SELECT * FROM baseline"),
        "features_bucketed": _over("features", "SELECT * FROM features"),
        "features_of_days": _over("features", "SELECT * FROM features WHERE strftime(service_ts, '%Y-%m') IN ('1995-03', '1995-04', '1995-05')"),
        "provider_baseline_events": _over("event_baseline", "SELECT * FROM event_baseline"),
        "provider_join": _over("baseline", "SELECT * FROM silver LEFT JOIN baseline USING (hospital_id)"),
        "provider_baseline_window": _over(
            "silver",
            f"""SELECT {_ID}, billed_amount, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) / CAST(100 AS DOUBLE) AS hosp_avg_billed,
       hosp_min_billed, hosp_max_billed,
       CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE)))
                            / CAST(100 AS DOUBLE) END AS hosp_stddev_billed, hosp_claim_count
FROM (SELECT *, CAST(count(c) OVER w AS HUGEINT) AS n, CAST(sum(c) OVER w AS HUGEINT) AS s,
             CAST(sum(c * c) OVER w AS HUGEINT) AS q, min(billed_amount) OVER w AS hosp_min_billed,
             max(billed_amount) OVER w AS hosp_max_billed, count(claim_id) OVER w AS hosp_claim_count
      FROM (SELECT *, CAST(round(billed_amount * 100) AS BIGINT) AS c FROM silver)
      WINDOW w AS (PARTITION BY hospital_id))""",
        ),
        "ratio_feature": _over("features", f"SELECT {_ID}, billed_amount, amount_to_avg_ratio FROM features"),
        "zscore_feature": _over("features", f"SELECT {_ID}, billed_amount, amount_z_score FROM features"),
        "above_k_std": _over("features", f"SELECT {_ID}, billed_amount, is_above_2std FROM features"),
        "features": _over("features", "SELECT * FROM features"),
        "features_events": _over(
            "event_features",
            f"""SELECT event_id, user_id, value, {_BASELINE}, amount_to_avg_ratio, amount_z_score, is_above_2std
FROM event_features""",
        ),
        "feature_stats": _over(
            "features",
            f"""SELECT {_rounded("avg(amount_to_avg_ratio)")} AS avg_ratio, min(amount_to_avg_ratio) AS min_ratio,
       max(amount_to_avg_ratio) AS max_ratio, {_rounded("avg(amount_z_score)")} AS avg_z_score FROM features""",
        ),
        "standardize": _over(
            "placed",
            f"""SELECT {_ID}, billed_amount, {_rounded("x0")} AS std_billed_amount,
       {_rounded("x1")} AS std_hosp_avg_billed, {_rounded("x2")} AS std_amount_to_avg_ratio FROM placed""",
        ),
        "assign_fixed_centroids": _over(
            "tail",
            f"SELECT {_ID}, billed_amount, cluster_prediction, round(squared_distance, 6) AS squared_distance FROM tail",
        ),
        "cluster_profile": _over(
            "tail",
            """SELECT cluster_prediction, count(*) AS n_rows, round(avg(billed_amount), 4) AS avg_billed_amount,
       round(avg(hosp_avg_billed), 4) AS avg_hosp_avg_billed, round(avg(amount_to_avg_ratio), 4) AS avg_amount_to_avg_ratio
FROM tail GROUP BY 1""",
        ),
        "anomaly_cluster": _over(
            "worst_band",
            "SELECT anomaly_cluster, n_clusters, round(highest_mean_ratio, 6) AS highest_mean_ratio FROM worst_band",
        ),
        "inertia": _over("tail", "SELECT round(sum(squared_distance), 4) AS inertia, count(*) AS n_samples FROM tail"),
        "silhouette_sq": tail_silhouette,
        "silhouette_sq_band": _over("band", "").rstrip() + _silhouette("band"),
        "anomaly_flag": _over("gold", f"SELECT {_ID}, billed_amount, cluster_prediction, is_anomaly FROM gold"),
        "anomaly_confidence": _over("gold", f"SELECT {_ID}, billed_amount, is_anomaly, anomaly_confidence FROM gold"),
        "risk_level": _over("gold", f"SELECT {_ID}, billed_amount, anomaly_confidence, risk_level FROM gold"),
        "gold_fixed_centroids": _over("gold", "SELECT * FROM gold"),
        "gold_fixed_centroids_tail": _over("gold_tail", "SELECT * FROM gold_tail"),
        "gold_trained_scale": _over("gold_trained", "SELECT * FROM gold_trained"),
        "gold_refit_scale": _over("gold", "SELECT * FROM gold"),
        "gold_events": _over("gold_event", "SELECT * FROM gold_event"),
        "anomaly_summary": _over(
            "gold",
            """SELECT count(*) AS total_claims, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0::DOUBLE) AS anomaly_rate FROM gold""",
        ),
        "risk_counts": _over("gold", "SELECT risk_level, count(*) AS n_claims FROM gold GROUP BY 1"),
        "risk_distribution": _over(
            "gold",
            "SELECT risk_level, count(*) AS n_claims, round(avg(billed_amount), 4) AS avg_amount FROM gold GROUP BY 1",
        ),
        "daily_anomaly_rate": _over(
            "gold",
            f"""SELECT CAST(service_ts AS DATE) AS claim_date, {_RATE} AS anomaly_rate FROM gold
GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
        ),
        "weekly_anomaly_trend": _over(
            "gold",
            f"""SELECT CAST(date_trunc('week', service_ts) AS DATE) AS claim_week, count(*) AS total_claims,
       count(*) FILTER (WHERE is_anomaly) AS anomalies, {_RATE} AS anomaly_rate FROM gold GROUP BY 1 ORDER BY 1 DESC""",
        ),
        "top_anomalous_providers": _over(
            "gold",
            f"""SELECT hospital_id, count(*) AS total_claims, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       {_RATE} AS anomaly_rate FROM gold GROUP BY 1 HAVING count(*) > 100
ORDER BY anomaly_rate DESC, hospital_id LIMIT 10""",
        ),
        "recent_anomaly_alert": _over(
            "gold",
            """SELECT recent_claims, anomalies, rate AS anomaly_rate, rate > 0.1::DOUBLE AS alert
FROM (SELECT count(*) AS recent_claims, count(*) FILTER (WHERE is_anomaly) AS anomalies,
             coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0::DOUBLE) AS rate
      FROM gold WHERE service_ts >= (SELECT max(service_ts) FROM gold) - INTERVAL 1 DAY)""",
        ),
        "stored_recent_anomaly_alert": _over(
            "gold",
            """SELECT recent_claims, anomalies, rate AS anomaly_rate, rate > 0.1::DOUBLE AS alert
FROM (SELECT count(*) AS recent_claims, count(*) FILTER (WHERE is_anomaly) AS anomalies,
             coalesce(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0), 0::DOUBLE) AS rate
      FROM gold WHERE service_ts >= (SELECT max(service_ts) FROM gold) - INTERVAL 1 DAY)""",
        ),
        "drift_check": _over("complete", "\nUNION ALL ".join(map(_drift, DRIFTS))),
        "training_size_check": _over(
            "features", "SELECT count(*) AS record_count, count(*) > 1000 AS enough FROM features"
        ),
        "flagged_claims": _over(
            "gold",
            f"""SELECT {_ID}, billed_amount, amount_to_avg_ratio, anomaly_confidence, risk_level FROM gold WHERE is_anomaly
ORDER BY {_ID}, billed_amount LIMIT 10""",
        ),
        "retention_check": _over(
            "silver",
            """SELECT bronze_count, silver_count, kept AS retention, kept < 0.8::DOUBLE OR kept > 0.95::DOUBLE AS alert
FROM (SELECT b AS bronze_count, s AS silver_count, s / nullif(b, 0) AS kept
      FROM (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s))""",
        ),
        "anomaly_rate_check": _over(
            "gold",
            "SELECT rate AS anomaly_rate, rate > 0.1::DOUBLE AS alert FROM (SELECT " + _RATE + " AS rate FROM gold)",
        ),
        "null_share_check": _over(
            "features",
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, "
                f"coalesce((count(*) - count({c})) / nullif(count(*), 0), 0::DOUBLE) AS null_share, "
                f"coalesce((count(*) - count({c})) / nullif(count(*), 0), 0::DOUBLE) > 0.01::DOUBLE AS alert FROM features"
                for c in _NULL_CHECKED
            ),
        ),
        "kmeans_fit": _over(
            "centers",
            "SELECT CAST(j AS INTEGER) AS cluster_prediction, "
            + ", ".join(f"c{i} AS std_{c}" for i, c in enumerate(_FEATURES))
            + " FROM centers",
        ),
        "kmeans_assign": _over(
            "fitted_rows",
            f"SELECT {_ID}, billed_amount, cluster_prediction, round(squared_distance, 6) AS squared_distance FROM fitted_rows",
        ),
        "silhouette_sq_fitted": _over(
            "fitted_measures", "SELECT round(silhouette_sq, 4) AS silhouette_sq, n_samples FROM fitted_measures"
        ),
        "silhouette_check": _over(
            "fitted_measures",
            """SELECT v AS silhouette, v > 0.5::DOUBLE AS on_target, v < 0.3::DOUBLE AS alert
FROM (SELECT round(silhouette_sq, 4) AS v FROM fitted_measures)""",
        ),
        "train_metrics": _over(
            "fitted_measures",
            "SELECT * REPLACE (round(silhouette_sq, 4) AS silhouette_sq, round(inertia, 4) AS inertia) FROM fitted_measures",
        ),
        "model_metrics": _over(
            "fitted_measures",
            f"""SELECT 'k-means' AS algorithm, {DEFAULTS.seed} AS seed, '{",".join(_FEATURES)}' AS features,
       * REPLACE (round(silhouette_sq, 4) AS silhouette_sq, round(inertia, 4) AS inertia) FROM fitted_measures""",
        ),
        "gold_anomalies": _over("gold_fitted", "SELECT * FROM gold_fitted"),
        "stream_silver": _over("silver", "SELECT * FROM silver"),
        "stream_silver_state": _over("silver", "SELECT * FROM silver"),
        "stream_gold": _over("gold", "SELECT * FROM gold"),
        "silhouette_check_fixed": (
            tail_silhouette.replace("SELECT round(avg(", "SELECT v AS silhouette, v > 0.5::DOUBLE AS on_target, v < 0.3::DOUBLE AS alert FROM (SELECT round(avg(")
            .replace("AS silhouette_sq,", "AS v,")
            + ")"
        ),
    }
