"""Files laid out along several columns at once, so that a filter on any of them skips most row groups.

Every column is cut at approximate quantiles into 2^bits ranges in its own order; the bits of the
ranges are interleaved to one key (a Z-order), and rows are sorted by it over all files. Rows that are near
in all columns lie together, and the smallest and largest values of a row group are near each other in every column.

The cuts come from a bounded sample: they decide where a row lies, and nothing else.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5
SAMPLE_ROWS = 50_000


def cuts(df: DataFrame, columns: tuple[str, ...], bits: int = BITS, sample_rows: int = SAMPLE_ROWS, seed: int = 42) -> dict[str, list]:
    """At most 2^bits - 1 rising values of each column that split a sample of about ``sample_rows`` rows evenly."""
    n = df.count()
    share = min(1.0, 1.2 * sample_rows / n) if n else 1.0
    sample = df.select(*columns).sample(share, seed).limit(sample_rows).collect()  # sample_rows at most
    found = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        at = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        found[c] = sorted(set(at))
    return found


def place(column: str, at: list) -> Column:
    """The number of cuts that a value has reached; 0 for NULL."""
    reached = [F.coalesce(F.col(column) >= F.lit(v), F.lit(False)).cast("int") for v in at]
    return reduce(add, reached) if reached else F.lit(0)


def z_key(at: dict[str, list], bits: int = BITS) -> Column:
    """The bits of all places in turn, the highest first."""
    n = len(at)
    parts = [
        F.shiftleft(F.shiftright(place(c, values), b).bitwiseAND(F.lit(1)).cast("long"), b * n + n - 1 - i)
        for i, (c, values) in enumerate(at.items())
        for b in range(bits)
    ]
    return reduce(add, parts)


def write_clustered(
    df: DataFrame, folder: str, columns: tuple[str, ...], files: int, group_bytes: int = 16 << 20, bits: int = BITS
) -> None:
    """Write ``files`` parquet files, sorted by the interleaved key and then by the columns, in row groups of ``group_bytes``.

    Equal keys may lie in one range of the sort only, so a value that all columns share is one task's:
    choose columns of which one at least has many values.
    """
    key = "_z"
    while key in df.columns:
        key += "_"
    keyed = df.withColumn(key, z_key(cuts(df, columns, bits), bits))
    laid = keyed.repartitionByRange(files, key, *columns).sortWithinPartitions(key, *columns).drop(key)
    laid.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(folder)
