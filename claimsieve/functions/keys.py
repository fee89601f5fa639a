"""Text keys and hashed draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed_id(prefix: str, *parts: Column) -> Column:
    """prefix-part-part-..."""
    return F.concat_ws("-", F.lit(prefix), *[p.cast("string") for p in parts])


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """prefix-000042; numbers longer than the width are kept whole."""
    text = number.cast("string")
    return F.concat(F.lit(prefix + "-"), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def hashed_draw(n: int, seed: int, *keys: Column) -> Column:
    """A repeatable draw from 0..n-1 per row: the same keys and seed give the same value on any cluster."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(n))
