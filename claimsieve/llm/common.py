"""What the corpus operators share: narrow inputs, stored tables, bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.sources.tables import stage

#: Bytes of text that a task turns into Python or numpy objects at a time.
SLICE_BYTES = 2 << 20
#: Largest table, in rows, that a plan may ask Spark to broadcast (a few tens of MB).
BROADCAST_ROWS = 500_000

#: A word is a run of anything but these: the blank and the five ASCII control characters for white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: no recomputation after a lost executor."""
    return stage(df, label)


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast of a stored table if it has at most ``limit`` rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def columns_of(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names, whatever else the table has.

    A missing column named with a leading ``?`` becomes NULL.
    """
    have = set(docs.columns)
    picked: list[Column] = []
    for name, source in columns.items():
        optional = source.startswith("?")
        source = source.removeprefix("?")
        if optional and source not in have:
            picked.append(F.lit(None).cast("string").alias(name))
        else:
            picked.append(docs[source].alias(name))
    return docs.select(*picked)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def raw_texts(part: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; NULL counts as empty."""
    return [x or b"" for x in part.column(column).cast(pa.binary()).to_pylist()]


def cut_at_blanks(line: bytes, limit: int) -> Iterator[bytes]:
    """Parts of about ``limit`` bytes that end at a blank; a longer word stays whole."""
    at = 0
    while at < len(line):
        end = line.find(b" ", at + limit)
        end = len(line) if end < 0 else end
        yield line[at:end]
        at = end


def owners(counts: list[int] | np.ndarray) -> np.ndarray:
    """Row numbers, each as often as its count says."""
    return np.repeat(np.arange(len(counts)), counts)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions start, start + 1, ... of every range, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift


#: Tells rows with one id apart; rows that agree in id and text are one row to the operators that drop rows.
KEY = "_text_hash"


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias(KEY)


def unused(columns: list[str], *wanted: str) -> list[str]:
    """Names that none of the columns has, whatever the case of its letters."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def keep_rows(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              once: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose verdict (doc_id, text hash, kept) says so.

    What goes is looked up, for it is the smaller part. Of several rows with one id and text, one
    row stays if their verdicts differ, or always with ``once``.
    """
    own, other_id, other_key = unused(docs.columns, KEY, "_id", "_key")
    per_row = verdicts.groupBy("doc_id", KEY).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("kept_rows")
    )
    several = F.col("rows") > (1 if once else F.col("kept_rows"))
    per_row = stored(per_row.where(~F.col("kept") | several), "verdicts")
    names = [F.col("doc_id").alias(other_id), F.col(KEY).alias(other_key)]
    keyed = docs.withColumn(own, text_key(text_col))
    same = [keyed[id_col].eqNullSafe(F.col(other_id)), keyed[own] == F.col(other_key)]
    left = keyed.join(bounded(per_row.where("not kept").select(*names)), same, "left_anti")
    repeated = per_row.where("kept").select(*names)
    if not repeated.isEmpty():
        first = left.join(bounded(repeated), same, "left_semi").dropDuplicates([id_col, own])
        left = left.join(bounded(repeated), same, "left_anti").unionByName(first)
    return left.drop(own)
