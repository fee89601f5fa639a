"""Quality by perplexity: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters: its n-grams of four cover a language with a table that stops growing,
while the texts to score do not. Counts, continuation counts, discounts and interpolation weights
are aggregates and joins of count tables sharded by n-gram. Texts become rows (text, n-gram, times),
joined with the tables of each order, and a text's perplexity is a sum over its rows. A table is
broadcast if it is counted to be small, so that scoring moves no text; beyond, it is joined by shards.

A text is rejected if its perplexity lies above what nearly all trusted texts of its language reach: a
quantile per language, from mergeable summaries. For this quantile trusted texts are scored without
their own counts: hashed folds of them (equal texts share one) each have a model of all the others, whose
tables are built beside those of the whole model and read by the same joins. Short texts scatter more, so
perplexities count against an allowance that falls with the length, in the quantile as in the verdict.
A quantile of few texts is raised by its uncertainty, which goes to nothing as they become many.

Defined results: NULL, empty and blank texts have perplexity NULL and are rejected; a NULL language
is a language of its own, and languages with few trusted texts take the limit of all trusted texts;
a NULL label trusts nothing, and of several labels for a text the highest counts; without trusted
text nothing is rejected but empty texts; repeated rows are scored each; an empty table gives an
empty result; further columns are ignored by ``classify`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from claimsieve.llm.common import KEY, bounded, columns_of, keep_rows, owners, slices, stored, text_key

ORDER = 4
#: A character takes 16 bits of an n-gram's key; those beyond the first plane count as one.
CHAR_BITS = 16
BEYOND = 0xFFFD
DISCOUNTS = (0.5, 1.0, 1.5)
#: Model 0 holds all trusted texts, model k all but those of fold k.
FOLDS = 4
NOTHING = np.zeros(1, np.int64)
#: Bytes of text in an Arrow batch of n-grams: a character makes a row of about 45 bytes.
GRAM_BYTES = 256 << 10


@dataclass(frozen=True)
class Limits:
    """How a language's limit follows from its trusted texts."""

    quantile: float = 0.99
    #: The limit of a text of n characters grows by exp(short / sqrt(n)): few n-grams scatter more.
    short: float = 2.0
    #: Few texts do not reach their quantile: n of them raise the limit by few / sqrt(n) of its distance from the middle.
    few: float = 2.0
    #: Texts of less than this many characters vary too much to set limits.
    min_chars: int = 200
    min_texts: int = 30


def packed(text: str) -> np.ndarray:
    """The key of the four characters that end at each position; blanks are one kind, text starts after three zeros."""
    line = " ".join(text.split())
    points = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    points = np.concatenate([np.zeros(ORDER - 1, np.uint64), np.where(points >> CHAR_BITS, BEYOND, points)])
    n = len(points) - ORDER + 1
    keys = np.zeros(n, np.uint64)
    for k in range(ORDER):
        keys = (keys << np.uint64(CHAR_BITS)) | points[k : k + n]
    return keys.view(np.int64)


def grams(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(keep..., g, n): how often each text holds each n-gram of the highest order.

    With columns to keep, a text without characters has one row of its own, without n-gram.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=GRAM_BYTES):
            counted = [np.unique(packed(t or ""), return_counts=True) for t in part.column("text").to_pylist()]
            if keep:
                counted = [(g, n) if len(g) else (NOTHING, NOTHING) for g, n in counted]
            sizes = [len(g) for g, _ in counted]
            own = pa.array(owners(sizes))
            columns = [part.column(c).take(own) for c in keep]
            columns += [pa.array(np.concatenate([x[i] for x in counted]).astype(np.int64)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "g", "n"])

    schema = docs.select(*keep).schema.add("g", LongType()).add("n", LongType())
    return docs.select(*keep, "text").mapInArrow(task, schema)


def _context(g: str) -> Column:
    """The n-gram without its last character."""
    return F.shiftrightunsigned(g, CHAR_BITS)


def _suffix(g: str, order: int) -> Column:
    """The last ``order - 1`` characters of an n-gram of that order."""
    return F.col(g).bitwiseAND(F.lit((1 << (CHAR_BITS * (order - 1))) - 1))


def _fold(key: str) -> Column:
    """The fold of a text by its hash, from 1."""
    return (F.pmod(F.col(key), F.lit(FOLDS)) + 1).cast("int")


def _discounts(counts: DataFrame) -> DataFrame:
    """(m, d): D1, D2, D3+ of one order of each model, from its counts of counts; standard ones if counts are few."""
    n = counts.groupBy("m").agg(*[F.count_if(F.col("c") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    raw = [
        F.when(
            (F.col(f"n{k}") > 0) & (F.col("n1") > 0),
            k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0)),
        )
        for k in (1, 2, 3)
    ]
    safe = [F.when((d > 0) & (d <= k), d).otherwise(F.lit(s)) for d, k, s in zip(raw, (1, 2, 3), DISCOUNTS)]
    return n.select("m", F.struct(*[d.alias(f"d{k}") for k, d in enumerate(safe, 1)]).alias("d"))


def _order_counts(top: DataFrame) -> dict[int, DataFrame]:
    """(m, g, c) per order: text counts at the top, below the number of different characters in front."""
    counts = {ORDER: top}
    for order in range(ORDER, 1, -1):
        lower = counts[order].groupBy("m", _suffix("g", order).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        counts[order - 1] = stored(lower, f"counts-{order - 1}")
    return counts


def _model_counts(trusted: DataFrame) -> DataFrame:
    """(m, g, c) of the highest order: every fold's counts go to all models but its own."""
    folds = trusted.withColumn(KEY, text_key()).select("text", _fold(KEY).alias("fold"))
    own = grams(folds, ("fold",)).where("n > 0").groupBy("fold", "g").agg(F.sum("n").alias("c"))
    models = F.filter(F.array(*[F.lit(m) for m in range(FOLDS + 1)]), lambda m: m != F.col("fold"))
    return own.select(F.explode(models).alias("m"), "g", "c").groupBy("m", "g").agg(F.sum("c").alias("c"))


def _logs(value: str) -> Column:
    """The logarithms of a column in all models, as an array with NULL where a model has none."""
    return F.array(*[F.max(F.when(F.col("m") == m, F.log(value))) for m in range(FOLDS + 1)]).alias(value)


def train(trusted: DataFrame) -> list[DataFrame]:
    """Per order, from 0 to the highest: (g, p, back), arrays over the models of logarithms.

    The probability, and the weight left for shorter n-grams after g; order 0 is an unknown character.
    """
    counts = _order_counts(stored(_model_counts(trusted), f"counts-{ORDER}"))
    tables: dict[int, DataFrame] = {}
    for order in range(1, ORDER + 1):
        held = counts[order].join(F.broadcast(_discounts(counts[order])), "m")
        cut = F.when(F.col("c") == 1, F.col("d.d1")).when(F.col("c") == 2, F.col("d.d2")).otherwise(F.col("d.d3"))
        held = held.select("m", "g", _context("g").alias("h"), "c", F.least(cut, F.col("c")).alias("cut"))
        sums = held.groupBy("m", "h").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("back"))
        if order == 1:
            floors = counts[1].groupBy("m").agg((F.lit(1.0) / (F.count(F.lit(1)) + 1)).alias("lower"))
            joined = held.join(F.broadcast(sums), ["m", "h"]).join(F.broadcast(floors), "m")
            rest = sums.join(F.broadcast(floors), "m").select("m", (F.col("back") * F.col("lower")).alias("p"))
            tables[0] = stored(rest, "model-0")
        else:
            # Outer: the context at the start of a text ends no n-gram, so it has a weight but no probability.
            tables[order - 1] = stored(
                tables[order - 1].join(sums.select("m", F.col("h").alias("g"), "back"), ["m", "g"], "full"),
                f"model-{order - 1}",
            )
            below = tables[order - 1].select("m", F.col("g").alias("s"), F.col("p").alias("lower"))
            joined = held.withColumn("s", _suffix("g", order)).join(sums, ["m", "h"]).join(below, ["m", "s"])
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("back") * F.col("lower")
        tables[order] = stored(joined.select("m", "g", p.alias("p")), f"model-{order}")
    wide = [tables[0].agg(_logs("p"))]
    for order in range(1, ORDER + 1):
        values = ("p", "back") if order < ORDER else ("p",)
        wide.append(stored(tables[order].groupBy("g").agg(*map(_logs, values)), f"logs-{order}"))
    return wide


def _log_p(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Add ``log_p`` of every n-gram, and ``held_log_p`` by the model without the text's fold.

    The longest known suffix counts, times the weights of the longer contexts.
    """
    joined, model = rows, {"log_p": F.lit(0), "held_log_p": _fold(KEY)}
    found = {name: F.lit(None).cast("double") for name in model}
    weight = {name: F.lit(0.0) for name in model}
    for order in range(ORDER, 0, -1):
        mask = F.lit((1 << (CHAR_BITS * order)) - 1 if order < 4 else -1)
        table = tables[order].select(F.col("g").alias(f"g{order}"), F.col("p").alias(f"p{order}"))
        joined = joined.withColumn(f"g{order}", F.col("g").bitwiseAND(mask)).join(bounded(table), f"g{order}", "left")
        if order < ORDER:
            # The context of order+1: that many characters before the last one.
            context = tables[order].select(F.col("g").alias(f"h{order}"), F.col("back").alias(f"b{order}"))
            joined = joined.withColumn(f"h{order}", _context(f"g{order + 1}")).join(bounded(context), f"h{order}", "left")
            weight = {name: w + F.coalesce(F.get(f"b{order}", model[name]), F.lit(0.0)) for name, w in weight.items()}
        found = {name: F.coalesce(x, F.get(f"p{order}", model[name]) + weight[name]) for name, x in found.items()}
    unknown = tables[0].select("p").scalar()
    lone = {"log_p": F.coalesce(F.get(unknown, F.lit(0)), F.lit(0.0)), "held_log_p": F.get(unknown, model["held_log_p"])}
    return joined.select(
        *rows.columns, *[F.coalesce(x, weight[name] + lone[name]).alias(name) for name, x in found.items()]
    )


def perplexity(docs: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(doc_id, lang, text hash, no, n_scored, perplexity, held_out) of every row; ``docs`` has doc_id, lang and text.

    ``held_out`` is the perplexity without the text's own fold, NULL if the other folds hold no text.
    """
    numbered = docs.withColumn("no", F.monotonically_increasing_id()).withColumn(KEY, text_key())
    keys = ("doc_id", "lang", KEY, "no")
    sums = _log_p(grams(numbered, keys), tables).groupBy(*keys).agg(
        F.sum("n").alias("n_scored"), *[F.sum(F.col("n") * F.col(x)).alias(x) for x in ("log_p", "held_log_p")]
    )
    value = {x: F.exp(F.try_divide(-F.col(x), F.col("n_scored"))) for x in ("log_p", "held_log_p")}
    return sums.select(*keys, "n_scored", value["log_p"].alias("perplexity"), value["held_log_p"].alias("held_out"))


def _good(labels: DataFrame) -> DataFrame:
    """All trusted ids. Where a count shows them to be few they travel to the texts, which then stay where they are."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q")).where("q = 1")
    return bounded(stored(good.select(F.col("doc_id").alias("_id"), F.lit(True).alias("trusted")), "trusted"))


def _allowance(limits: Limits) -> Column:
    return F.exp(limits.short / F.sqrt(F.greatest("n_scored", F.lit(1))))


def language_limits(scored: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(lang, most): the highest accepted perplexity per language, and one row for all, before the allowance.

    A quantile of the trusted texts' perplexities without their own fold.
    """
    base = scored.where(F.col("trusted") & (F.col("n_scored") >= limits.min_chars) & F.col("held_out").isNotNull())
    at = F.percentile_approx(F.col("held_out") / _allowance(limits), F.array(F.lit(0.5), F.lit(limits.quantile)), 2000)
    most = (at[1] + (at[1] - at[0]) * limits.few / F.sqrt(F.count(F.lit(1)))).alias("most")
    per = base.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), most).where(F.col("texts") >= limits.min_texts)
    overall = base.agg(F.lit(None).cast("string").alias("lang"), F.count(F.lit(1)).alias("texts"), most)
    return per.withColumn("overall", F.lit(False)).unionByName(overall.withColumn("overall", F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "?lang") -> DataFrame:
    """doc_id, lang, trusted, n_scored, perplexity, most (the limit) and kept for every row of ``docs``."""
    named = columns_of(docs, doc_id=id_col, lang=lang_col, text=text_col)
    same = F.col("doc_id") == F.col("_id")
    good = _good(labels)
    tables = train(named.join(good, same, "left_semi").select("text"))
    scored = perplexity(named, tables).drop("no").join(good, same, "left").drop("_id")
    scored = stored(scored.fillna(False, ["trusted"]), "perplexity")
    found = stored(language_limits(scored, limits).coalesce(1), "limits")
    own = found.where(~F.col("overall")).select(F.col("lang").alias("_lang"), F.col("most").alias("own"))
    overall = found.where("overall").select("most").scalar()
    joined = scored.join(bounded(own), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    joined = joined.withColumn("most", F.coalesce("own", overall) * _allowance(limits)).drop("own", "held_out")
    kept = F.col("perplexity").isNotNull() & (F.col("most").isNull() | (F.col("perplexity") <= F.col("most")))
    return joined.withColumn("kept", kept)


def accepted(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
             text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    verdicts = classify(docs, labels, limits, id_col, text_col, **columns)
    everything = verdicts.groupBy("doc_id", KEY).agg(F.max("kept").alias("kept"))
    return keep_rows(docs, everything, id_col, text_col)
