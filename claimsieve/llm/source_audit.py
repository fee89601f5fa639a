"""How far the wording of each source is from that of the other sources of its language, in exact counts.

A term is a run of letters and of whatever lies beyond ASCII, with A-Z lower-cased. A language keeps
the terms of at least ``least_docs`` of its documents. Every (language, source) group and every
language as a whole gives a kept term the share p = 1 + floor(1000 ** steps * (count + add) / (N + add * V)) of
its N kept words, in whole numbers, and groups are compared by sums of differences of p.

Strings come late. Tasks count exact strings and pass on fixed-width digests; only those are shuffled
to their totals. A term's text lies beside its counts in a written table and is fetched for kept
digests alone. There its smallest and largest string say whether a digest stands for several terms:
such a digest is split by counting its strings themselves.

Counts are pre-aggregated in the tasks, digests spread a frequent term's source over all partitions,
and a source of a third of all rows is but one count per term and task.

Defined results: NULL text, language and source are empty strings, which are values like others; a
group without terms gives every kept term its share of a count of 0; a language without kept terms
has pairs of value 0 and no terms; repeated rows count as documents of their own; ties go by the
UTF-8 order of the item; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsieve.llm.common import SLICE_BYTES, bounded, columns_of, cut_at_blanks, raw_texts, slices, stored

#: Bytes as terms are read: A-Z lower-cased, letters and what lies beyond ASCII kept, blanks for the rest.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lid long, digest long, docs long, gids array<long>, counts array<long>, word string"
#: Terms of a batch that a task hands over.
BATCH = 50_000


@dataclass(frozen=True)
class Audit:
    """Documents of a kept term, what is added to a count, thousandfold steps of a share, terms listed, entries a task holds."""

    least_docs: int = 30
    add: int = 5
    steps: int = 3
    top: int = 50
    entries: int = 400_000
    digest_bits: int = 64


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _number(name: str, salt: str) -> int:
    """A fixed-width number for a language or a source, as Spark's own hash gives it."""
    return _signed(xxhash.xxh64_intdigest((salt + name).encode(), 42))


def _counted(named: DataFrame, how: Audit, salt: str) -> DataFrame:
    """COUNTS: for every term that a task saw between two hand-overs its documents and its count in each source."""

    def hand_over(counts: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for lang, seen in docs.items():
            if not seen:
                continue
            words = list(seen)
            place = {word: i for i, word in enumerate(words)}
            mine = [(_number(source, salt), found) for (other, source), found in counts.items() if other == lang]
            term = np.concatenate([np.fromiter(map(place.__getitem__, found), np.int64, len(found)) for _, found in mine])
            count = np.concatenate([np.fromiter(found.values(), np.int64, len(found)) for _, found in mine])
            group = np.repeat(np.array([gid for gid, _ in mine], np.int64), [len(found) for _, found in mine])
            order = np.argsort(term, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(term, minlength=len(words))))
            group, count = group[order], count[order]
            digests = [_signed(xxhash.xxh64_intdigest(word) >> (64 - how.digest_bits)) for word in words]
            for at in range(0, len(words), BATCH):
                to = min(at + BATCH, len(words))
                offsets = pa.array(ends[at : to + 1] - ends[at], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v[ends[at] : ends[to]], pa.int64())) for v in (group, count)]
                columns = [
                    pa.array(np.full(to - at, _number(lang, salt)), pa.int64()),
                    pa.array(digests[at:to], pa.int64()),
                    pa.array([seen[word] for word in words[at:to]], pa.int64()),
                    *lists,
                    pa.array(words[at:to], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COUNTS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs = defaultdict(Counter), defaultdict(Counter)
        for part in slices(batches):
            groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            for group, text in zip(groups, raw_texts(part)):
                different: set[bytes] = set()
                for piece in cut_at_blanks(text.translate(LETTERS), SLICE_BYTES):
                    words = piece.split()
                    counts[group].update(words)
                    different.update(words)
                docs[group[0]].update(different)
            if sum(map(len, counts.values())) > how.entries:
                yield from hand_over(counts, docs)
                counts, docs = defaultdict(Counter), defaultdict(Counter)
        yield from hand_over(counts, docs)

    return named.select("lang", "source", "text").mapInArrow(task, COUNTS)


def share(n: Column, whole: Column, terms: Column, how: Audit) -> Column:
    """1 + floor(1000 ** steps * (n + add) / (whole + add * terms)), by long division: exact up to 9e15 words."""
    over = whole + terms * how.add
    rest, found = n + F.lit(how.add), F.lit(0).cast("long")
    for _ in range(how.steps):
        rest = rest * F.lit(1000)
        found, rest = found * F.lit(1000) + F.call_function("div", rest, over), rest % over
    return found + F.lit(1)


def _groups(named: DataFrame) -> tuple[DataFrame, str]:
    """(lang, source, lid, gid): a number for every language, and for every source in it; the salt that keeps them apart."""
    found, turn = stored(named.select("lang", "source").distinct(), "groups"), 0
    while True:
        salt = "" if not turn else f"{turn}:"
        lid, gid = (F.xxhash64(F.concat(F.lit(salt), F.col(c))).alias(n) for c, n in (("lang", "lid"), ("source", "gid")))
        numbered = found.select("lang", "source", lid, gid)
        per_lang = numbered.groupBy("lid").agg(
            F.min("lang").alias("a"), F.max("lang").alias("b"), F.count(F.lit(1)).alias("n"), F.count_distinct("gid").alias("m")
        )
        if per_lang.where("a <> b OR n <> m").isEmpty():
            return stored(numbered, "group-numbers"), salt
        turn += 1


KEY = ["lid", "digest"]


def _entries(counts: DataFrame, *keys: str) -> DataFrame:
    """(keys, entries): the count of every group that has the term, added up."""
    each = counts.select(*keys, F.explode(F.arrays_zip("gids", "counts")).alias("e"))
    per_group = each.groupBy(*keys, F.col("e.gids").alias("gid")).agg(F.sum("e.counts").alias("n"))
    return per_group.groupBy(*keys).agg(F.collect_list(F.struct("gid", "n")).alias("entries"))


def _kept(counts: DataFrame, *keys: str, how: Audit) -> DataFrame:
    """The keys of enough documents."""
    return counts.groupBy(*keys).agg(F.sum("docs").alias("docs")).where(F.col("docs") >= how.least_docs).select(*keys)


def _terms(named: DataFrame, salt: str, how: Audit) -> tuple[DataFrame, DataFrame]:
    """Kept terms as (lid, digest, part, entries), and their texts as (lid, digest, part, word)."""
    counts = stored(_counted(named, how, salt), "term-counts")
    kept = stored(_kept(counts, *KEY, how=how), "kept-digests")
    of_kept = counts.join(bounded(kept), KEY, "left_semi")
    texts = of_kept.groupBy(*KEY).agg(F.min("word").alias("word"), F.max("word").alias("other"))
    texts = stored(texts, "kept-texts")
    shared = texts.where("word <> other").select(*KEY)
    first = F.lit(0).alias("part")
    if shared.isEmpty():
        terms = stored(_entries(of_kept, *KEY).select(*KEY, first, "entries"), "kept-terms")
        return terms, texts.select(*KEY, first, "word")
    # A digest of several terms: its strings are counted themselves.
    strings = counts.join(bounded(shared), KEY, "left_semi")
    by_word = Window.partitionBy(*KEY).orderBy("word")
    enough = stored(_kept(strings, *KEY, "word", how=how).withColumn("part", F.row_number().over(by_word)), "split-texts")
    split = _entries(strings.join(bounded(enough), [*KEY, "word"]), *KEY, "part")
    alone = _entries(of_kept.join(bounded(shared), KEY, "left_anti"), *KEY)
    terms = alone.select(*KEY, first, "entries").unionByName(split)
    words = texts.where("word = other").select(*KEY, first, "word").unionByName(enough.select(*KEY, "part", "word"))
    return stored(terms, "kept-terms"), words


def _distances(dense: DataFrame) -> DataFrame:
    """(lid, a, b, value): sums over the terms of the difference of the shares of groups a < b of a language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in batches:
            lids = part.column("lid").to_numpy()
            for lid in np.unique(lids).tolist():
                mine = part.column("shares").filter(pa.array(lids == lid))
                rows = mine.flatten().to_numpy().reshape(len(mine), -1)
                total = sums.setdefault(lid, np.zeros((rows.shape[1],) * 2, np.int64))
                for a in range(rows.shape[1] - 1):
                    total[a, a + 1 :] += np.abs(rows[:, a + 1 :] - rows[:, a : a + 1]).sum(axis=0)
        for lid, total in sums.items():
            a, b = np.triu_indices(len(total), 1)
            columns = [np.full(len(a), lid), a.astype(np.int32), b.astype(np.int32), total[a, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lid", "a", "b", "value"])

    sums = dense.mapInArrow(task, "lid long, a int, b int, value long")
    return sums.groupBy("lid", "a", "b").agg(F.sum("value").alias("value"))


def _pairs(terms: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """(lid, gid, item, value) of every group against each other source of its language."""
    sides = groups.groupBy("lid", "terms").agg(F.array_sort(F.collect_list(F.struct("gid", "whole"))).alias("side"))
    counts = F.map_from_entries("entries")
    shares = F.transform(
        "side", lambda g: share(F.coalesce(F.try_element_at(F.col("counts"), g["gid"]), F.lit(0)), g["whole"], F.col("terms"), how)
    )
    dense = terms.withColumn("counts", counts).join(bounded(stored(sides, "sides")), "lid").select("lid", shares.alias("shares"))
    place = groups.select("lid", "gid", "source", (F.row_number().over(Window.partitionBy("lid").orderBy("gid")) - 1).alias("at"))
    found = _distances(dense)
    both = found.unionByName(found.select("lid", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    every = place.alias("x").join(place.alias("y"), (F.col("x.lid") == F.col("y.lid")) & (F.col("x.at") != F.col("y.at")))
    every = every.select("x.lid", "x.gid", F.col("x.at").alias("a"), F.col("y.at").alias("b"), F.col("y.source").alias("item"))
    return every.join(both, ["lid", "a", "b"], "left").select("lid", "gid", "item", F.coalesce("value", F.lit(0)).alias("value"))


def _listed(terms: DataFrame, texts: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """(lid, gid, item, value) of the terms a group uses more than its language does, as many as are listed, ties included."""
    total = F.aggregate("entries", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    each = terms.select("lid", "digest", "part", total.alias("all_n"), F.explode("entries").alias("e"))
    each = each.select("lid", "digest", "part", "all_n", "e.gid", "e.n")
    known = each.join(bounded(groups.select("lid", "gid", "whole", "terms", "lang_whole")), ["lid", "gid"])
    more = share(F.col("n"), F.col("whole"), F.col("terms"), how) - share(F.col("all_n"), F.col("lang_whole"), F.col("terms"), how)
    valued = known.select("lid", "digest", "part", "gid", more.alias("value")).where("value > 0")
    first = valued.withColumn("place", F.rank().over(Window.partitionBy("lid", "gid").orderBy(F.desc("value"))))
    first = stored(first.where(F.col("place") <= how.top), "listed")
    return texts.join(bounded(first), [*KEY, "part"]).select("lid", "gid", F.col("word").alias("item"), "value")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               how: Audit = Audit()) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank of every group."""
    named = columns_of(docs, lang=lang_col, source=source_col, text=text_col)
    named = named.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    groups, salt = _groups(named)
    terms, texts = _terms(named, salt, how)
    wholes = terms.select("lid", F.explode("entries").alias("e")).groupBy("lid", "e.gid").agg(F.sum("e.n").alias("whole"))
    kept = terms.groupBy("lid").agg(F.count(F.lit(1)).alias("terms"))
    sized = groups.join(wholes, ["lid", "gid"], "left").join(kept, "lid", "left").fillna(0, ["whole", "terms"])
    sized = stored(sized.join(sized.groupBy("lid").agg(F.sum("whole").alias("lang_whole")), "lid"), "sized-groups")
    pairs = _pairs(terms, sized, how).withColumn("kind", F.lit("pair"))
    listed = _listed(terms, texts, sized, how).withColumn("kind", F.lit("term"))
    by_value = Window.partitionBy("lid", "gid", "kind").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(listed).withColumn("rank", F.row_number().over(by_value))
    ranked = ranked.where((F.col("kind") == "pair") | (F.col("rank") <= how.top))
    return ranked.join(bounded(groups), ["lid", "gid"]).select(
        "lang", "source", F.col("kind").alias("part"), "item", "value", "rank"
    )
