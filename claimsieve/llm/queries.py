"""The operators of this package as queries over the given tables, and as SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.llm import (
    conversation_repair,
    decontamination,
    exact_dedup,
    license_scan,
    lm_scoring,
    mixing,
    quality_classifier,
    quality_rules,
    sentence_pieces,
    simhash,
    source_audit,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan(table(spark, folder, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every text, decode the ids, compare: the ids as their number and hash."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select("doc_id", "text", F.xxhash64(text).alias("text_hash"))
    encoded = sentence_pieces.encode(docs, drop_text=True, rule=sentence_pieces.MERGES)
    decoded = sentence_pieces.decode(encoded)
    return decoded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.xxhash64("tokens").alias("tokens_hash"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "token_entropy",
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), rule=sentence_pieces.MERGES)


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    found = lm_scoring.backoff_scores(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"),
        "n_single",
    )


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_matches(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "lang", "n_scored", "perplexity", F.col("most").alias("most_accepted"), "kept")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    broken = conversation_repair.damage(table(spark, folder, "conversations"))
    return conversation_repair.repair(broken, copies_col=broken.columns[-1])


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.divergence(table(spark, folder, "documents"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def queries() -> dict[str, Query]:
    return {
        "op1_mix": op1_mix,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_simhash": op3_simhash,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_token_counts": op6_token_counts,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_license_scan": op8_license_scan,
        "op9_toxicity": op9_toxicity,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_source_audit": op12_source_audit,
        "op13_decontamination": op13_decontamination,
    }


OP4 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS solid
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY solid ORDER BY n_chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY solid) AS group_size,
       row_number() OVER (PARTITION BY solid ORDER BY n_chars DESC, doc_id) = 1 AS kept,
       sha256(solid) AS text_sha256
FROM t
"""

OP7 = r"""
WITH w AS (
  SELECT doc_id, row AS row, unnest(words) AS w, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)),
g AS (SELECT row, pos, w, lag(w) OVER p AS v, lag(w, 2) OVER p AS u FROM w WINDOW p AS (PARTITION BY row ORDER BY pos)),
uni AS (SELECT w, count(*) AS n FROM g GROUP BY w),
own_uni AS (SELECT row, w, count(*) AS n FROM g GROUP BY row, w),
bi AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY v, w),
own_bi AS (SELECT row, v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY row, v, w),
tri AS (SELECT u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY u, v, w),
own_tri AS (SELECT row, u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY row, u, v, w),
size AS (SELECT row, count(*) AS n FROM g GROUP BY row),
whole AS (SELECT count(*) AS n FROM g),
o_uni AS (SELECT row, w, uni.n - own_uni.n AS n FROM own_uni JOIN uni USING (w)),
o_bi AS (SELECT row, v, w, bi.n - own_bi.n AS n FROM own_bi JOIN bi USING (v, w)),
o_tri AS (SELECT row, u, v, w, tri.n - own_tri.n AS n FROM own_tri JOIN tri USING (u, v, w)),
s AS (
  SELECT g.row,
         CASE WHEN o_tri.n > 0 THEN o_tri.n::DOUBLE / cuv.n
              ELSE CASE WHEN g.u IS NULL THEN 1.0 ELSE 0.4 END::DOUBLE * CASE
                WHEN o_bi.n > 0 THEN o_bi.n::DOUBLE / cv.n
                ELSE CASE WHEN g.v IS NULL THEN 1.0 ELSE 0.4 END::DOUBLE
                     * (greatest(cw.n, 1)::DOUBLE / greatest(whole.n - size.n, 1)) END END AS value,
         CASE WHEN o_tri.n > 0 OR o_bi.n > 0 THEN 0 ELSE 1 END AS single
  FROM g JOIN size USING (row) CROSS JOIN whole
  JOIN o_uni cw ON cw.row = g.row AND cw.w = g.w
  LEFT JOIN o_uni cv ON cv.row = g.row AND cv.w = g.v
  LEFT JOIN o_bi ON o_bi.row = g.row AND o_bi.v = g.v AND o_bi.w = g.w
  LEFT JOIN o_bi cuv ON cuv.row = g.row AND cuv.v = g.u AND cuv.w = g.v
  LEFT JOIN o_tri ON o_tri.row = g.row AND o_tri.u = g.u AND o_tri.v = g.v AND o_tri.w = g.w),
per AS (SELECT row, count(*) AS n_words, sum(ln(value)) AS log_score, sum(single)::DOUBLE AS n_single FROM s GROUP BY row),
d AS (SELECT doc_id, row_number() OVER () AS row FROM documents)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0.0), 4) AS log_score,
       round(log_score / n_words, 6) AS mean_log_score, coalesce(n_single, 0)::BIGINT AS n_single
FROM d LEFT JOIN per USING (row)
"""


def _op8(templates=license_scan.TEMPLATES, how: license_scan.Scan = license_scan.Scan()) -> str:
    """All windows of all texts against all templates, without sketches."""
    rows = []
    for i, (name, notice, text) in enumerate(templates):
        parts = sorted(set(license_scan.shingles(license_scan.plain_words(text))))
        kind = license_scan.window_class(len(parts), how)
        rows += [f"({i}, '{name}', '{notice}', '{p}', {len(parts)}, {kind.width}, {kind.stride})" for p in parts]
    return rf"""
WITH t(template, license, notice, part, parts, width, stride) AS (VALUES {", ".join(rows)}),
d AS (
  SELECT doc_id, row_number() OVER () AS row,
         list_filter(string_split(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws
  FROM documents),
p AS (SELECT doc_id, row, ws, unnest(range(0, len(ws) - 4)) AS spot FROM d WHERE len(ws) > 4),
hit AS (
  SELECT p.doc_id, p.row, p.spot, t.* FROM p JOIN t
  ON t.part = array_to_string(p.ws[p.spot + 1 : p.spot + 5], ' ')),
win AS (
  SELECT doc_id, row, template, license, notice, parts, part,
         unnest(range(greatest(0, CAST(ceil((spot - width + 1)::DOUBLE / stride) AS BIGINT)), spot // stride + 1)) * stride AS start
  FROM hit),
c AS (
  SELECT doc_id, row, template, license, notice, start, count(DISTINCT part)::DOUBLE / max(parts) AS containment
  FROM win GROUP BY ALL)
SELECT doc_id, license, notice, max(containment) AS containment,
       arg_max(start, (containment, -start)) AS first_word, count(*) AS n_windows
FROM c WHERE containment >= {how.containment} - 1e-9 GROUP BY doc_id, row, template, license, notice
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER s + 5 * count(*) OVER s) AS p
  FROM dense WINDOW s AS (PARTITION BY lang, source)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER s + 5 * count(*) OVER s) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term) WINDOW s AS (PARTITION BY lang)),
far AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
every AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(far.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 50
"""

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, words, least(10, len(words)) AS width
  FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
  WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(words, spot + 1, spot + width), ' ') AS line
  FROM (SELECT *, unnest(range(0, len(words) - width + 1)) AS spot FROM b)),
runs AS (
  SELECT row, spot, width, array_to_string(list_slice(words, spot + 1, spot + width), ' ') AS line
  FROM (SELECT row, words, width, unnest(range(0, len(words) - width + 1)) AS spot
        FROM d JOIN (SELECT DISTINCT width FROM windows) ON len(words) >= width)),
hits AS (SELECT row, spot, width, item_id FROM runs JOIN windows USING (width, line)),
hit_words AS (SELECT row, count(DISTINCT word) AS n FROM (SELECT row, unnest(range(spot, spot + width)) AS word FROM hits) GROUP BY row),
hit_items AS (
  SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(hit_words.n, 0) AS n_hit, coalesce(hit_items.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, hit_words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": OP4,
        "op7_lm_scoring": OP7,
        "op8_license_scan": _op8(),
        "op12_source_audit": OP12,
        "op13_decontamination": OP13,
    }
