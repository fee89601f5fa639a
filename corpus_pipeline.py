"""A training corpus in five stages, each one operator of the library over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.llm import exact_dedup, mixing, quality_classifier, sentence_pieces, simhash
from claimsieve.sources import tables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose perplexity under a model of trusted text is no higher than their language's limit."""
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all texts that agree but for blanks: the longest, then the smallest id."""
    return exact_dedup.without_copies(docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all texts that links of near fingerprints join: the smallest id."""
    return simhash.without_near_duplicates(docs).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as often as the mixture takes it."""
    return mixing.mix(docs).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every text, and whether they decode to it."""
    hashed = docs.select("doc_id", "lang", "source", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    # Written in between: encoding and decoding at once would hold two Python workers a task.
    pieces = tables.stage(sentence_pieces.encode(hashed, drop_text=True, rule=sentence_pieces.MERGES), "pieces")
    back = sentence_pieces.decode(pieces)
    return back.select(
        "doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens",
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing to target weights", mixed),
    ("SentencePiece encoding", encoded),
]

# Model fits, linked components and segmentation have no SQL form; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
