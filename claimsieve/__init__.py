"""claimsieve: find unusual records in very large fact tables with Spark.

Layers (each a DataFrame, each stored as a table by :mod:`claimsieve.plans`):

    bronze records -> silver records -> provider features -> k-means -> gold scores
"""

from claimsieve.params import CLAIMS, Columns, Params

__all__ = ["CLAIMS", "Columns", "Params"]
