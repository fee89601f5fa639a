"""Toxicity by multiple-instance learning: documents carry the labels, sentences carry the scores.

A sentence's probability is the logistic function of the summed weights of its words, a document's
is the noisy-or of its sentences: it is toxic if at least one sentence is. Only document labels are
needed to train, and the model then names the sentences that made the score.

A word's weight is the sum of the weights of its features (the word, its beginnings and its end),
hashed into a table of fixed size. Weights are not negative and rare evidence weighs nothing, so a
long harmless sentence can neither hide an offending word nor add up to one. The fit takes a bounded sample of labelled rows, drawn by a hash; scoring is
one pass over all texts without a shuffle. The table of weights is the only thing that travels.

Defined results: NULL, empty and blank texts have no sentence and score 0; NULL labels teach
nothing; a document labelled twice counts as toxic if one label says so; a NULL id is not held out;
without a toxic and a clean label every score is 0; repeated rows are scored each; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.common import KEY, columns_of, ranges, raw_texts, slices, stored, text_key

SENTENCE = re.compile(rb"[.!?\n]+")
EDGES = b"\"'()[]{}<>,;:*#$%&|-_/"


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit."""

    #: At most so many labelled documents are fitted on; beyond, those with the smallest hashes.
    max_documents: int = 12_000
    #: And of those as many whole texts, in the order of their hashes, as have at most so many bytes together.
    max_bytes: int = 64 << 20
    bits: int = 18
    rounds: int = 150
    rate: float = 0.2
    #: Documents' worth of evidence that a feature has to bring before it weighs anything.
    evidence: float = 0.5
    decay: float = 0.05
    #: Features seen in fewer documents teach nothing.
    min_documents: int = 4
    folds: int = 5
    seed: int = 42


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def word_features(word: bytes, bits: int) -> list[int]:
    word = word.strip(EDGES)
    mask = (1 << bits) - 1
    found = [zlib.crc32(b"=" + word) & mask]
    text = word.decode()
    for n in (4, 5, 6, 7):
        if len(text) > n:
            found.append(zlib.crc32(f"^{text[:n]}".encode()) & mask)
    if len(text) > 4:
        found.append(zlib.crc32(f"{text[-4:]}$".encode()) & mask)
    return found


@dataclass
class Bags:
    """Texts as sentences of words of features; every level as flat arrays."""

    n_docs: int
    doc_of_sentence: np.ndarray
    sentence_of_word: np.ndarray
    word: np.ndarray
    feature_of: np.ndarray  # (word, feature) pairs
    word_of_feature: np.ndarray
    sentences: list[list[bytes]]

    @property
    def n_words(self) -> int:
        return max((int(x.max()) + 1 for x in (self.word, self.word_of_feature) if len(x)), default=0)


def bags(texts: list[bytes], bits: int, keep: bool = True) -> Bags:
    """One text after the other; its sentences are kept or dropped, its words stay as 32-bit numbers."""
    ids: dict[bytes, int] = {}
    kept, per_text, lengths, word = [], [], array("i"), array("i")
    for raw in texts:
        sentences = [s for s in SENTENCE.split(raw) if s.strip()]
        for s in sentences:
            words = s.lower().split()
            lengths.append(len(words))
            word.extend([ids.setdefault(w, len(ids)) for w in words])
        kept.append(sentences if keep else [])
        per_text.append(len(sentences))
    features, sizes = array("i"), array("i")
    for w in ids:
        found = word_features(w, bits)
        features.extend(found)
        sizes.append(len(found))
    own = [np.repeat(np.arange(len(n), dtype=np.int32), n) for n in (np.array(per_text, np.int32), _ints(lengths), _ints(sizes))]
    return Bags(len(texts), own[0], own[1], _ints(word), _ints(features), own[2], kept)


def _ints(values: array) -> np.ndarray:
    return np.frombuffer(values, np.int32) if len(values) else np.zeros(0, np.int32)


def sentence_logits(b: Bags, model: Model) -> np.ndarray:
    weight = np.bincount(b.word_of_feature, weights=model.weights[b.feature_of], minlength=b.n_words)
    return model.bias + np.bincount(b.sentence_of_word, weights=weight[b.word], minlength=len(b.doc_of_sentence))


def noisy_or(b: Bags, logits: np.ndarray) -> np.ndarray:
    """1 - product of (1 - p) over each document's sentences."""
    return -np.expm1(-np.bincount(b.doc_of_sentence, weights=np.logaddexp(0, logits), minlength=b.n_docs))


def _only(b: Bags, active: np.ndarray) -> Bags:
    """The same texts without the features that are not active and the words that lose all of theirs."""
    pair = active[b.feature_of]
    word_of, feature_of = b.word_of_feature[pair], b.feature_of[pair]
    keep = np.isin(b.word, word_of)
    return Bags(b.n_docs, b.doc_of_sentence, b.sentence_of_word[keep], b.word[keep], feature_of, word_of, b.sentences)


def documents_of_features(b: Bags, size: int) -> np.ndarray:
    """In how many documents each feature is, some documents at a time."""
    doc_of_word = b.doc_of_sentence[b.sentence_of_word]
    counts = np.bincount(b.word_of_feature, minlength=b.n_words)
    starts = np.cumsum(counts) - counts
    found = np.zeros(size, np.int64)
    at, step = 0, 1 << 19
    while at < len(doc_of_word):
        to = int(np.searchsorted(doc_of_word, doc_of_word[min(at + step, len(doc_of_word)) - 1], "right"))
        pairs = np.unique(doc_of_word[at:to].astype(np.int64) * b.n_words + b.word[at:to])
        own = pairs % b.n_words
        seen = np.unique(np.repeat(pairs // b.n_words, counts[own]) * size + b.feature_of[ranges(starts[own], counts[own])])
        found += np.bincount(seen % size, minlength=size)
        at = to
    return found


def fit(texts: list[bytes], toxic: np.ndarray, how: Training = Training()) -> Model:
    """Gradient descent (Adam) on the likelihood of the document labels."""
    size = 1 << how.bits
    model = Model(np.zeros(size), -6.0)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(np.zeros(size), -np.inf)
    b = bags(texts, how.bits, keep=False)
    y = toxic.astype(bool)
    b = _only(b, documents_of_features(b, size) >= how.min_documents)

    weights, bias = model.weights, model.bias
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, how.rounds + 1):
        z = sentence_logits(b, Model(weights, bias))
        p = np.exp(-np.logaddexp(0, -z))
        whole = np.maximum(noisy_or(b, z), 1e-12)
        scale = np.where(y, -(1 - whole) / whole, 1.0)
        g = p * scale[b.doc_of_sentence] / b.n_docs
        by_word = np.bincount(b.word, weights=g[b.sentence_of_word], minlength=b.n_words)
        by_feature = np.bincount(b.feature_of, weights=by_word[b.word_of_feature], minlength=size)
        grad = np.append(by_feature + (how.evidence + how.decay * weights) / b.n_docs, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = how.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = np.maximum(weights - move[:-1], 0.0), bias - move[-1]
    return Model(weights.astype(np.float32).astype(float), float(bias))


def held_out(doc_id: str, folds: int = 5) -> Column:
    """The fold that teaches nothing: crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """(text, toxic) of at most ``max_documents`` labelled ids that are not held out, and at most ``max_bytes`` of text.

    Those with the smallest hashes; of the rows with one id, the one with the smallest text hash.
    """
    taught = labels.select(F.col("doc_id").alias("_id"), "toxic").where("toxic is not null")
    taught = taught.where(~held_out("_id", how.folds)).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(how.seed), "_id")
    taught = stored(taught.orderBy(order, "_id").limit(how.max_documents), "taught")
    keyed = docs.select("doc_id", text_key(), "text")
    sizes = keyed.select("doc_id", KEY, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    one = sizes.join(F.broadcast(taught), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(F.min(F.struct(KEY, "size")).alias("row"))
    # At most max_documents rows of fixed width.
    so_far = F.sum("row.size").over(Window.orderBy(order, "_id"))
    chosen = one.withColumn("so_far", so_far).where(F.col("so_far") <= how.max_bytes)
    chosen = stored(chosen.join(taught, "_id").select("_id", F.col(f"row.{KEY}").alias("_key"), "toxic"), "chosen")
    rows = keyed.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col(KEY) == F.col("_key")))
    return rows.dropDuplicates(["_id"]).select("text", F.col("toxic").cast("int").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Fit on the bounded sample; its texts are the only rows that reach the driver."""
    rows = training_rows(docs, labels, how).toArrow().sort_by([("toxic", "ascending"), ("text", "ascending")])
    texts, toxic = [x or b"" for x in rows.column("text").cast(pa.binary()).to_pylist()], rows.column("toxic").to_numpy()
    del rows
    return fit(texts, toxic, how)


RESULT = "doc_id long, score double, n_sentences long, n_offending long, worst_score double, worst_sentence string"


def score(docs: DataFrame, model: Model, bits: int = Training.bits, threshold: float = 0.5) -> DataFrame:
    """The score of every row, and its offending sentences: how many, and the worst one with its own score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.bias))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(shared.value.weights.astype(float), shared.value.bias)
        names = [c.split()[0] for c in RESULT.split(", ")]
        for part in slices(batches):
            b = bags(raw_texts(part), bits)
            z = sentence_logits(b, known)
            p = np.exp(-np.logaddexp(0, -z))
            counts = np.bincount(b.doc_of_sentence, minlength=b.n_docs)
            first = np.cumsum(counts) - counts
            order = np.lexsort((np.arange(len(z)), -z, b.doc_of_sentence))
            worst = [int(order[f]) if n else None for f, n in zip(first, counts)]
            text = [
                None if w is None else b.sentences[d][w - int(first[d])].decode(errors="replace").strip()
                for d, w in enumerate(worst)
            ]
            columns = [
                part.column("doc_id"),
                pa.array(np.clip(noisy_or(b, z), 0.0, 1.0)),
                pa.array(counts.astype(np.int64)),
                pa.array(np.bincount(b.doc_of_sentence, weights=p >= threshold, minlength=b.n_docs).astype(np.int64)),
                pa.array([None if w is None else float(p[w]) for w in worst], pa.float64()),
                pa.array(text, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(task, RESULT)


def toxicity(docs: DataFrame, labels: DataFrame, how: Training = Training(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences for every row of ``docs``."""
    named = columns_of(docs, doc_id=id_col, text=text_col)
    found = score(named, train(named, labels, how), how.bits)
    return found.select(
        "doc_id", held_out("doc_id", how.folds).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences", "n_offending", "worst_score", "worst_sentence",
    )
