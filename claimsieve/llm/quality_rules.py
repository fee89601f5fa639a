"""Quality rules from tokeniser fertility: how well a public vocabulary fits a text of its language.

Per text a public vocabulary gives characters per token, the share of byte-fallback tokens and the
entropy of the tokens. Text of a language keeps within a narrow band of each; shouting, symbol
noise, menus and mixed encodings do not. A band is the middle of the measured corpus, per language,
and a multiple of the distance between its quartiles, narrower for longer texts; entropy is held
against that of texts with as many tokens. Every row takes part; the width and the least spreads
were chosen on the labels of sf0.1.

Defined results: NULL and empty texts have no words and fail the base rules; a NULL language is a
language of its own; repeated rows are measured and returned each; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import bounded, columns_of, owners, ranges, raw_texts, slices, stored

SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_tokens long, n_byte_tokens long, chars_per_token double, byte_share double, token_entropy double"
)
FIELDS = tuple(x.split()[0] for x in MEASURES.split(", "))
BANDED = ("chars_per_token", "byte_share", "entropy_gap")
SCALED = ("chars_per_token", "byte_share")


@dataclass(frozen=True)
class Rules:
    """Parameters: the vocabulary, the base rules and how far a band reaches."""

    vocabulary: str = public_tokenizers.path("piece_bpe_32k.model")
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Half the width of a band, in distances between quartiles; the least such distance counted.
    width: float = 2.5
    least_spread: tuple[float, float, float] = (0.5, 0.2, 0.02)
    #: Languages with fewer texts than this take the band of all texts.
    min_texts: int = 30


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def duplicate_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repeated_words(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per text the words that lie in a three-word window found twice or more in that text."""
    out = np.zeros(n_docs, np.int64)
    if len(words) < 3:
        return out
    vocabulary = int(words.max()) + 1
    same = np.flatnonzero(doc[2:] == doc[:-2])
    pairs = np.unique(words[same] * vocabulary + words[same + 1], return_inverse=True)[1]
    windows = (pairs * vocabulary + words[same + 2]) * n_docs + doc[same]
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[same[counts[back] > 1] + shift] = True
    return np.bincount(doc[covered], minlength=n_docs)


def _entropy(doc: np.ndarray, token: np.ndarray, n_docs: int) -> np.ndarray:
    """Bits per token of each text's own token counts."""
    keys, counts = np.unique(doc * (1 << 32) + token, return_counts=True)
    own = keys >> 32
    total = np.bincount(doc, minlength=n_docs).astype(float)
    inner = np.bincount(own, weights=counts * np.log2(counts), minlength=n_docs)
    safe = np.maximum(total, 1)
    return np.maximum(np.where(total > 0, np.log2(safe) - inner / safe, 0.0), 0.0)


def measure_texts(texts: list[bytes], vocabulary: str) -> dict[str, np.ndarray]:
    """All measures but the id and the language, one value per text."""
    model, is_byte = _vocabulary(vocabulary)
    n = len(texts)
    lists = [t.split() for t in texts]  # bytes split at exactly the six blanks
    n_words = np.array([len(x) for x in lists], np.int64)
    ids: dict[bytes, int] = {}
    words = np.fromiter((ids.setdefault(w, len(ids)) for w in chain.from_iterable(lists)), np.int64, int(n_words.sum()))
    doc = owners(n_words)

    pieces = model.encode([w.decode() for w in ids], num_threads=1) if ids else []
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = np.fromiter(chain.from_iterable(pieces), np.int64, int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    tokens = flat[ranges(starts[words], lengths[words])]
    token_doc = np.repeat(doc, lengths[words])

    n_tokens = np.bincount(token_doc, minlength=n)
    n_bytes = np.bincount(token_doc, weights=is_byte[tokens], minlength=n).astype(np.int64)
    solid = [t.translate(None, BLANKS + CONTINUATION) for t in texts]
    word_chars = np.array([len(t) for t in solid], np.int64)
    safe = np.maximum(n_tokens, 1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated_words(words, doc, n),
        "n_tokens": n_tokens.astype(np.int64),
        "n_byte_tokens": n_bytes,
        "chars_per_token": word_chars / safe,
        "byte_share": n_bytes / safe,
        "token_entropy": _entropy(token_doc, tokens, n),
    }


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of measures per text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = measure_texts(raw_texts(part), rules.vocabulary)
            columns = [part.column("doc_id"), part.column("lang"), *[pa.array(values[c]) for c in FIELDS[2:]]]
            yield pa.RecordBatch.from_arrays(columns, list(FIELDS))

    return docs.mapInArrow(task, MEASURES)


def _entropy_share() -> Column:
    """Entropy against that of as many different tokens, so that short and long texts compare."""
    n = F.col("n_tokens")
    return F.when(n > 1, F.col("token_entropy") / F.log2(n)).otherwise(F.lit(1.0))


def _with_entropy_gap(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add how far a text's entropy share lies from that of texts of its language with as many tokens.

    The share falls as texts grow: a line over the logarithm of the length, fitted by one aggregation.
    """
    sound = ~F.col("base_failed") & (F.col("n_tokens") > 1)
    y, x = F.when(sound, F.col("entropy_share")), F.when(sound, F.log2("n_tokens"))
    mean = F.avg(y)
    slope = F.coalesce(F.regr_slope(y, x), F.lit(0.0))
    fit = [slope.alias("fit_slope"), (mean - slope * F.avg(x)).alias("fit_start")]
    fitted = _with_language(rows, stored(_per_language(rows, rules, *fit), "entropy-fit"), ["fit_slope", "fit_start"])
    expected = F.col("fit_start") + F.col("fit_slope") * F.log2(F.greatest("n_tokens", F.lit(1)))
    return fitted.withColumn("entropy_gap", F.col("entropy_share") - expected).drop("fit_slope", "fit_start")


def _quartiles(column: Column) -> Column:
    return F.percentile_approx(column, F.array(*map(F.lit, (0.25, 0.5, 0.75))), 1000)


def _deviation(measure: str, middle: Column) -> Column:
    """Distance from the middle; a share of n tokens scatters with the root of n, so it counts by that."""
    gap = F.col(measure) - middle
    return gap * F.sqrt("n_tokens") if measure in SCALED else gap


def _per_language(rows: DataFrame, rules: Rules, *values: Column) -> DataFrame:
    """Summaries per language with enough texts, and for all texts (``overall``): one row per language and task moves."""
    own = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), *values).where(F.col("texts") >= rules.min_texts)
    every = rows.agg(F.lit(None).cast("string").alias("lang"), F.count(F.lit(1)).alias("texts"), *values)
    return own.withColumn("overall", F.lit(False)).unionByName(every.withColumn("overall", F.lit(True))).drop("texts")


def _with_language(rows: DataFrame, summary: DataFrame, columns: list[str]) -> DataFrame:
    """Join a stored summary: the row's language, or all texts where the language has too few."""
    own = summary.where(~F.col("overall")).select(F.col("lang").alias("_lang"), F.struct(*columns).alias("_own"))
    every = summary.where("overall").select(F.struct(*columns)).scalar()
    joined = rows.join(bounded(own), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    joined = joined.withColumn("_own", F.coalesce("_own", every))
    return joined.select(*rows.columns, *[F.col(f"_own.{c}").alias(c) for c in columns])


def with_bands(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add the lowest and highest accepted value of each measure for each text.

    Middle and spread are quartiles over all texts that pass the base rules, from mergeable summaries.
    """
    measured = _with_entropy_gap(measured, rules)
    sound = ~F.col("base_failed")
    middles = [f"{c}_middle" for c in BANDED]
    values = [_quartiles(F.when(sound, F.col(c)))[1].alias(m) for c, m in zip(BANDED, middles)]
    rows = _with_language(measured, stored(_per_language(measured, rules, *values), "middles"), middles)
    spreads = [f"{c}_spread" for c in BANDED]
    values = [
        _quartiles(F.when(sound, _deviation(c, F.col(m)))).alias(s) for c, m, s in zip(BANDED, middles, spreads)
    ]
    summary = _per_language(rows, rules, *values)
    for s, least in zip(spreads, rules.least_spread):
        summary = summary.withColumn(s, rules.width * F.greatest(F.col(s)[2] - F.col(s)[0], F.lit(least)))
    rows = _with_language(rows, stored(summary, "spreads"), spreads)
    for c, m, s in zip(BANDED, middles, spreads):
        reach = F.col(s) / F.sqrt(F.greatest(F.col("n_tokens"), F.lit(1))) if c in SCALED else F.col(s)
        rows = rows.withColumn(f"{c}_low", F.col(m) - reach).withColumn(f"{c}_high", F.col(m) + reach)
    return rows.drop(*middles, *spreads)


def quality_rules(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "?lang") -> DataFrame:
    """Measures, the band each text is held against, and the verdict, for every row of ``docs``."""
    measured = measure(columns_of(docs, doc_id=id_col, lang=lang_col, text=text_col), rules)
    n = F.col("n_words")
    failed = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    measured = measured.withColumn("base_failed", failed).withColumn("entropy_share", _entropy_share())
    banded = with_bands(stored(measured, "fertility"), rules)
    within = F.lit(True)
    for c in BANDED:
        within = within & F.coalesce(F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")), F.lit(True))
    return banded.withColumn("kept", ~F.col("base_failed") & within)
