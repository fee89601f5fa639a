"""The typed claims source, defect injection and the adapters over other fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsieve.functions.keys import hashed_draw, padded_id, prefixed_id
from claimsieve.functions.money import from_minor_units, minor_units
from claimsieve.params import BAD_CODES, CLAIMS, DIAGNOSIS_CODES, Columns

CLAIM_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType(), False),
        T.StructField("patient_id", T.StringType(), False),
        T.StructField("hospital_id", T.StringType(), True),
        T.StructField("diagnosis_code", T.StringType(), True),
        T.StructField("billed_amount", T.DoubleType(), True),
        T.StructField("claim_status", T.StringType(), True),
    ]
)

# Kinds of a defective row; any other number is a clean row.
NEGATIVE, EXTREME, ZERO = 0, 1, 2
_KINDS = 3


def conform(df: DataFrame, schema: T.StructType = CLAIM_SCHEMA, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select and cast to the declared schema; a missing column is an analysis error, extras are named."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def keyed_kind(key: Column, cycle: int) -> Column:
    """Defect kind from an integer key: three in every ``cycle`` keys are defective."""
    return F.pmod(key, F.lit(cycle))


def hashed_kind(ratio: float, seed: int, *keys: Column) -> Column:
    """Defect kind by hash: a ``ratio`` share of the rows is defective, evenly over the kinds."""
    grain = 1_000_000
    dirty = hashed_draw(grain, seed, *keys) < F.lit(round(ratio * grain))
    return F.when(dirty, hashed_draw(_KINDS, seed + 1, *keys)).otherwise(F.lit(_KINDS))


def inject_defects(
    df: DataFrame,
    kind: Column,
    bad_code: Column,
    code: str = CLAIMS.code,
    amount: str = CLAIMS.amount,
) -> DataFrame:
    """Give defective rows a bad code and a negative, hundredfold or zero amount.

    ``kind`` and ``bad_code`` are expressions over ``df``, so any key of any table can
    decide which rows are hit. One projection: no shuffle, repeatable after a task is lost.
    """
    units = minor_units(F.col(amount))
    broken = F.when(kind == NEGATIVE, -units).when(kind == EXTREME, units * 100).when(kind == ZERO, F.lit(0))
    return df.withColumns(
        {
            code: F.when(kind < _KINDS, bad_code).otherwise(F.col(code)),
            amount: F.when(kind < _KINDS, from_minor_units(broken)).otherwise(F.col(amount)),
        }
    )


def claims_from_line_items(line_items: DataFrame, orders: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    """Bronze claims over order lines: supplier = hospital, customer = patient, price / 20 = bill.

    About a tenth of the rows gets a defect and one order in fifty is delivered twice. The
    second delivery is an ``explode`` of the joined row, so both tables are read and joined
    once instead of once per copy.
    """
    dirty = inject_defects(clean_claims_from_line_items(line_items, orders, cols), F.col("_kind"), F.col("_bad"), cols.code, cols.amount)
    copies = F.when(F.col("_order") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conform(dirty.withColumn("_copy", F.explode(copies)), extra=(cols.event_time,))


def clean_claims_from_line_items(line_items: DataFrame, orders: DataFrame, cols: Columns = CLAIMS) -> DataFrame:
    """The same claims before injection, with the helper columns that decide it."""
    key, line, part, supplier = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    codes = F.array(*[F.lit(c) for c in DIAGNOSIS_CODES])
    bad = [F.when(key % 4 == i, F.lit(c)) for i, c in enumerate(BAD_CODES)]
    joined = line_items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        prefixed_id("CLM", key, line, part, supplier).alias(cols.record),
        prefixed_id("PAT", F.col("o_custkey")).alias(cols.subject),
        padded_id("HOSP", supplier, 6).alias(cols.provider),
        F.element_at(codes, (part % len(DIAGNOSIS_CODES) + 1).cast("int")).alias(cols.code),
        from_minor_units(F.floor(F.col("l_extendedprice") * 5 + 0.5)).alias(cols.amount),
        F.when(F.col("l_returnflag") == "A", "APPROVED")
        .when(F.col("l_returnflag") == "N", "PENDING")
        .when(F.col("l_returnflag") == "R", "DENIED")
        .alias(cols.status),
        F.col("l_shipdate").alias(cols.event_time),
        keyed_kind(key * 31 + line * 7 + part, 30).alias("_kind"),
        F.coalesce(*bad).alias("_bad"),
        key.alias("_order"),
    )
