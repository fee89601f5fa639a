"""Money as whole minor units, so that sums do not depend on their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100


def minor_units(amount: Column, scale: int = CENTS) -> Column:
    """12.34 -> 1234 (bigint), to the nearest unit."""
    return F.rint(amount * F.lit(float(scale))).cast("bigint")


def from_minor_units(units: Column, scale: int = CENTS) -> Column:
    """1234 -> 12.34 (double)."""
    return units.cast("double") / F.lit(float(scale))
