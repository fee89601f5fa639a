"""Mixing sources to target weights by capped water-filling.

Every source has a size in words and a weight. The target total is shared in proportion to the
weights; a source that would be read more than ``max_epochs`` times is clamped there and the rest is
shared again among the others, until no source is above its cap. A source's epochs (target / size)
are a whole number of repetitions for all of its rows and one more repetition for a seeded draw:

* rows larger than a small share of the words still to be drawn are drawn one by one by their hash;
* the other rows are taken in hash order until the source's target is met to within half a row.

The draw needs no ordering of a whole source. Rows fall into buckets by their hash; sums per bucket
tell which one holds the end of the draw, and only that bucket's rows are ordered.

Defined results: NULL and empty texts have size 0; NULL is a source of its own, last in order; an id
of NULL is drawn by its text; equal rows (same id, text and source) are drawn together; sources
without words or weight have target 0; an empty table gives an empty result; further columns are
kept by ``mix``, whatever their names, and ignored by ``plan``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.common import WORD, bounded, columns_of, stored

#: Bits of a row's draw, and how many of them name its bucket.
DRAW_BITS = 53
BUCKET_BITS = 12
SIZE, SOURCE, DRAW = "_size", "_source", "_draw"


@dataclass(frozen=True)
class Mix:
    """The mixture: weights by rank of the source, the total as a share of all sizes, the most epochs, the seed."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    total_share: float = 1.5
    max_epochs: float = 2.0
    seed: int = 42
    #: Rows above this share of the words to be drawn from their source are drawn one by one.
    single_share: float = 0.2


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked_weights(totals: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights dealt out in turn over the sources in code-point order, NULL last: one row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(order) - 1) % len(weights)
    return totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")))


def water_fill(totals: DataFrame, how: Mix = Mix()) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): clamp, reshare, repeat until none is above its cap.

    Each turn is one aggregate over the sources and clamps at least one more; only the two sums of
    the sources that are not clamped reach the driver.
    """
    cap = F.col("source_size") * F.lit(how.max_epochs)
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    wanted = min(how.total_share, how.max_epochs) * whole
    level = None
    while True:
        above = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        clamped, weight = totals.where((F.col("weight") > 0) & (F.col("source_size") > 0)).agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))
        ).first()
        new = (wanted - clamped) / weight if weight else level
        if new is None or new == level:
            break
        level = new
    share = F.least(cap, F.col("weight") * F.lit(level if level is not None else 0.0))
    return totals.withColumn("target", F.when(F.col("source_size") > 0, share).otherwise(F.lit(0.0)).cast("double"))


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Add the size, the source under a fixed name and the draw, a whole number below 2^53."""
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(text_col, F.lit("")))
    return docs.withColumns(
        {SIZE: word_count(text_col), SOURCE: F.col(source_col), DRAW: F.shiftrightunsigned(draw, 64 - DRAW_BITS)}
    )


def _cuts(small: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cut): the small rows with a draw of at most ``cut`` bring their source nearest to its quota."""
    shift = DRAW_BITS - BUCKET_BITS
    dealt = small.withColumn("bucket", F.shiftright(DRAW, shift))
    sums = dealt.groupBy(SOURCE, "bucket").agg(F.sum(SIZE).alias("words"))
    before = Window.partitionBy(SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ends = _by_source(sums, sources.select("source", "quota")).where(
        (F.col("before") < F.col("quota")) & (F.col("before") + F.col("words") >= F.col("quota"))
    )
    ends = stored(ends.select(F.col(SOURCE).alias("source"), F.col("bucket").alias("end"), "before", "quota"), "ends")
    near = _by_source(dealt, ends).where(F.col("bucket") == F.col("end"))
    near = near.groupBy(SOURCE, "end", "before", "quota", DRAW).agg(F.sum(SIZE).alias("words"))
    running = Window.partitionBy(SOURCE).orderBy(DRAW)
    middle = F.col("before") + F.sum("words").over(running) - F.col("words") / 2
    taken = near.withColumn("taken", middle <= F.col("quota"))
    cut = F.coalesce(F.max(F.when(F.col("taken"), F.col(DRAW))), F.shiftleft(F.min("end"), shift) - 1)
    return taken.groupBy(F.col(SOURCE).alias("source")).agg(cut.alias("cut"))


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join a stored table of sources; NULL is a source."""
    renamed = sources.withColumnRenamed("source", "_of")
    return rows.join(bounded(renamed), F.col(SOURCE).eqNullSafe(F.col("_of"))).drop("_of")


def targets(docs: DataFrame, how: Mix = Mix(), weights: DataFrame | None = None, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The measured rows (id, size, source, draw) and one row per source: its size, target, epochs and cut.

    ``weights`` (source, weight) replaces the weights by rank; sources it lacks weigh nothing.
    """
    named = columns_of(docs, doc_id=id_col, source=source_col, text=text_col)
    rows = stored(_measured(named, "doc_id", "text", "source", how.seed).select("doc_id", SIZE, SOURCE, DRAW), "sizes")
    totals = rows.groupBy(F.col(SOURCE).alias("source")).agg(F.sum(SIZE).alias("source_size"))
    if weights is None:
        totals = ranked_weights(totals, how.weights)
    else:
        given = weights.select(F.col("source").alias("_of"), F.col("weight").cast("double").alias("weight"))
        totals = totals.join(given, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of").fillna(0.0, ["weight"])
    filled = water_fill(stored(totals, "sources"), how)
    epochs = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    filled = filled.withColumn("whole", F.floor(epochs)).withColumn("part", epochs - F.floor(epochs))
    filled = filled.withColumn("words", F.col("part") * F.col("source_size"))
    filled = stored(filled.withColumn("single_above", F.col("words") * how.single_share), "targets")

    drawn = _by_source(rows, filled.select("source", "part", "single_above"))
    alone = F.when(_single() & _lucky(), F.col(SIZE))
    got = drawn.groupBy(F.col(SOURCE).alias("_of")).agg(F.coalesce(F.sum(alone), F.lit(0)).alias("got"))
    quotas = filled.join(got, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    quotas = stored(quotas.withColumn("quota", F.col("words") - F.col("got")).drop("got", "words"), "quotas")
    cuts = _cuts(drawn.where(~_single()), quotas).withColumnRenamed("source", "_of")
    cut = F.when(F.col("quota") <= 0, F.lit(-1)).otherwise(F.coalesce("cut", F.lit(1 << DRAW_BITS)))
    ends = quotas.join(cuts, F.col("source").eqNullSafe(F.col("_of")), "left").withColumn("cut", cut)
    return rows, stored(ends.drop("_of", "quota", "weight"), "cuts")


def _single() -> Column:
    return F.col(SIZE) > F.col("single_above")


def _lucky() -> Column:
    return F.col(DRAW) < F.col("part") * float(1 << DRAW_BITS)


def _repeats(rows: DataFrame, sources: DataFrame) -> DataFrame:
    extra = F.when(_single(), _lucky()).otherwise(F.col(DRAW) <= F.col("cut"))
    return _by_source(rows, sources).withColumn("repeats", F.col("whole") + extra.cast("long"))


def plan(docs: DataFrame, how: Mix = Mix(), weights: DataFrame | None = None, **columns: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, repeats, taken."""
    rows, sources = targets(docs, how, weights, **columns)
    return _repeats(rows, sources).select(
        "doc_id", F.col(SOURCE).alias("source"), F.col(SIZE).alias("size"), "source_size", "target", "repeats",
        (F.col("repeats") * F.col(SIZE)).alias("taken"),
    )


def mix(docs: DataFrame, how: Mix = Mix(), weights: DataFrame | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mixture takes it."""
    _, sources = targets(docs, how, weights, id_col=id_col, text_col=text_col, source_col=source_col)
    values = sources.select("source", F.struct("whole", "part", "single_above", "cut").alias("_mix"))
    # The table's columns go by their places meanwhile, so that none can have a name that is used here.
    place = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    held = docs.toDF(*place.values())
    used = [place[c.lower()] for c in (id_col, text_col, source_col)]
    rows = _by_source(_measured(held, *used, how.seed), values)
    extra = F.when(F.col(SIZE) > F.col("_mix.single_above"), F.col(DRAW) < F.col("_mix.part") * float(1 << DRAW_BITS))
    times = F.col("_mix.whole") + extra.otherwise(F.col(DRAW) <= F.col("_mix.cut")).cast("long")
    copies = F.when(times > 0, F.sequence(F.lit(1), times.cast("int")))
    return rows.withColumn("_copy", F.explode(copies)).select(*held.columns).toDF(*docs.columns)
