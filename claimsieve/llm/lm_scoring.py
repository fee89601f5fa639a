"""Stupid-backoff scores of every text against the rest of the corpus.

The model is counted from the scored corpus itself, and a text is scored without its own counts, so
that copies and common phrases score high and a text's own rare words do not. The score of a word is
count(n-gram) / count(context) for the longest n-gram found elsewhere, times ``backoff`` for every
shorter step; a text's score is the sum of the logarithms.

The joins are sharded. Texts are dealt into slots of a bounded size. Each slot sends the n-grams it
holds, each once, to the shard of their hash, as packed arrays with counts: a shard is a range of
hashes, so what a slot sends it is sorted, and the steps between neighbours have fewer bits than the
hashes. A shard adds up the counts of all slots and returns to each slot, in the order it sent them,
how often the others hold its n-grams, which is zero for most; there every text sums its own words. Words travel as 64-bit hashes, whose collisions are not resolved.
No table of the corpus is ever in one place, a frequent n-gram is one entry per slot, and the
texts move once, a task's texts for a slot as one compressed block: both uses of the slots read the same shuffle.

Defined results: NULL, empty and blank texts have no words, score 0 and a mean of NULL; repeated
rows count as texts of their own; a word found nowhere else counts 1 against all words; a NULL id is
a value like others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import WORD, columns_of, owners, raw_texts

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Backoff:
    """Order of the model, the factor of every step back, and what a slot, a task that packs and a shard may hold."""

    order: int = 3
    backoff: float = 0.4
    slot_bytes: int = 12 << 20
    pack_bytes: int = 32 << 20
    pack_level: int = 6
    shard_entries: int = 2_000_000
    seed: int = 42


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def ngrams(texts: list[bytes], how: Backoff) -> tuple[np.ndarray, list[np.ndarray]]:
    """The text of every word, and per order the key of the n-gram that ends at it (0 where the text is too short)."""
    n_words = []

    def split(text: bytes) -> list[bytes]:  # the words of one text at a time are objects
        words = text.split()
        n_words.append(len(words))
        return words

    words = chain.from_iterable(map(split, texts))
    word = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(how.seed)), np.uint64)
    doc = owners(n_words)
    keys = [np.maximum(word, np.uint64(1))]
    for n in range(2, how.order + 1):
        longer = np.zeros(len(word), np.uint64)
        inside = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1]) + n - 1 if len(doc) >= n else np.zeros(0, np.int64)
        longer[inside] = np.maximum(_mixed(keys[-1][inside - 1] + np.uint64(n)) + word[inside], np.uint64(1))
        keys.append(longer)
    return doc, keys


def _sorted_keys(keys: list[np.ndarray]) -> np.ndarray:
    """The keys of all orders, as often as they occur, without the 0 of words that have no such n-gram."""
    every, at = np.empty(sum(int(np.count_nonzero(k)) for k in keys), np.uint64), 0
    for k in keys:
        some = k[k > 0]
        every[at : at + len(some)] = some
        at += len(some)
    every.sort()
    return every


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(value: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(value, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as steps, the first byte of all steps first, and so on: the high bytes are mostly zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _packed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unpacked_keys(value: bytes, n: int) -> np.ndarray:
    planes = _unpacked(value, 8 * n, np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of hashes: sorted keys lie in ascending shards."""
    return (((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _pack(how: Backoff):
    """Texts of (doc_id, text, slot) as blocks: per slot the ids, and the lengths and texts compressed together."""

    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        codec = pa.Codec("zstd", how.pack_level)
        rows = pa.Table.from_batches(held)
        slot, texts = rows.column("slot").to_numpy(), raw_texts(rows)
        order = np.argsort(slot, kind="stable")
        at = np.flatnonzero(np.diff(slot[order], prepend=-1))
        cuts, sizes, packed = [*at.tolist(), len(slot)], [], []
        for a, b in zip(cuts, cuts[1:]):
            own = [texts[i] for i in order[a:b].tolist()]
            raw = np.fromiter(map(len, own), np.int32, b - a).tobytes() + b"".join(own)
            sizes.append(len(raw))
            packed.append(codec.compress(raw, asbytes=True))
        ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows.column("doc_id").combine_chunks().take(order))
        columns = [pa.array(slot[order[at]], pa.int32()), ids, pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["slot", "ids", "size", "packed"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= how.pack_bytes:
                yield blocks(held)
                held, size = [], 0
        if held:
            yield blocks(held)

    return task


def _texts(blocks: pa.Table) -> list[bytes]:
    """The texts of a slot's blocks, in the order of their ids."""
    found = []
    for ids, size, packed in zip(*(blocks.column(c) for c in ("ids", "size", "packed"))):
        raw = pa.decompress(packed.as_py(), size.as_py(), codec="zstd", asbytes=True)
        lengths = np.frombuffer(raw, np.int32, len(ids))
        ends = (np.cumsum(lengths, dtype=np.int64) + lengths.nbytes).tolist()
        found += [raw[a:b] for a, b in zip([lengths.nbytes, *ends], ends)]
    return found


def _send(shards: int, how: Backoff):
    names = ["slot", "shard", "n", "keys", "counts"]

    def task(table: pa.Table) -> pa.Table:
        every = _sorted_keys(ngrams(_texts(table), how)[1])
        first = _starts(every)
        key, count = every[first], np.diff(first, append=len(every))
        del every, first
        shard = _shard_of(key, shards)
        at = np.flatnonzero(np.diff(shard, prepend=-1))
        ends = np.append(at[1:], len(key))
        columns = [
            pa.array([table.column("slot")[0].as_py()] * len(at), pa.int32()),
            pa.array(shard[at], pa.int32()),
            pa.array(ends[: len(at)] - at, pa.int32()),
            pa.array([_packed_keys(key[a:b]) for a, b in zip(at, ends)], pa.binary()),
            pa.array([_packed(count[a:b].astype(np.int32)) for a, b in zip(at, ends)], pa.binary()),
        ]
        return pa.table(columns, names)

    return task, "slot int, shard int, n int, keys binary, counts binary"


def _add_up(table: pa.Table) -> pa.Table:
    """How often the other slots hold every key that a slot sent to this shard, in the order it was sent."""
    sizes = table.column("n").to_pylist()
    keys = [_unpacked_keys(x.as_py(), n) for x, n in zip(table.column("keys"), sizes)]
    counts = [_unpacked(x.as_py(), n, np.int32) for x, n in zip(table.column("counts"), sizes)]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.diff(every[order], prepend=np.uint64(0)))  # no key is 0
    totals = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first)
    others = np.empty(len(every), np.int64)
    others[order] = np.repeat(totals, np.diff(first, append=len(every)))
    others -= np.concatenate(counts)
    sent = [_packed(x) for x in np.split(others, np.cumsum(sizes)[:-1])]
    return pa.table(
        [table.column("slot"), table.column("shard"), table.column("n"), pa.array(sent, pa.binary())],
        ["slot", "shard", "n", "others"],
    )


def _order(keys: np.ndarray) -> np.ndarray:
    """Positions by key, then position: sorted as numbers of a key's high bits and the position, the rest mended after."""
    bits = np.uint64(len(keys).bit_length())
    joint = ((keys >> bits) << bits) | np.arange(len(keys), dtype=np.uint64)
    joint.sort()
    order = (joint & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    in_order, high = keys[order], joint >> bits
    mixed = np.flatnonzero((high[1:] == high[:-1]) & (in_order[1:] != in_order[:-1]))
    for one in np.unique(high[mixed]):
        start, end = np.searchsorted(high, one), np.searchsorted(high, one, "right")
        order[start:end] = order[start:end][np.argsort(in_order[start:end], kind="stable")]
    return order


def _elsewhere(doc: np.ndarray, keys: list[np.ndarray], in_others: np.ndarray) -> list[np.ndarray]:
    """Per order, how often the n-gram that ends at a word stands in other texts.

    ``in_others`` holds, for the slot's different keys in ascending order, the count of the other slots.
    """
    every = _sorted_keys(keys)
    every = every[_starts(every)]
    found = []
    for k in keys:
        if not len(k):
            found.append(np.zeros(0, np.int64))
            continue
        order = _order(k)
        in_order = k[order]
        start = _starts(in_order)
        there = in_others[np.searchsorted(every, in_order[start])]  # that of 0 is not used
        total = np.repeat(there + np.diff(start, append=len(k)), np.diff(start, append=len(k)))
        del in_order, there
        text = doc[order]  # ascending within a key, as the sort is stable
        new = np.append(True, text[1:] != text[:-1])
        new[start] = True
        run = np.flatnonzero(new)
        length = np.diff(run, append=len(k))
        count = np.empty(len(k), np.int64)
        count[order] = total - np.repeat(length, length)
        found.append(np.where(k > 0, count, 0))
    return found


def score_texts(doc: np.ndarray, keys: list[np.ndarray], n_docs: int, in_others: np.ndarray, all_words: int,
                how: Backoff) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, log score, words that had to go back to single words) of every text."""
    n_words = np.bincount(doc, minlength=n_docs)
    rest = (all_words - n_words)[doc]
    others = _elsewhere(doc, keys, in_others)
    value = np.maximum(others[0], 1) / np.maximum(rest, 1)
    level = np.ones(len(doc), np.int64)
    for n in range(2, how.order + 1):
        context = np.concatenate([[1], others[n - 2][:-1]])
        found = (keys[n - 1] > 0) & (others[n - 1] > 0)
        value = np.where(found, others[n - 1] / np.maximum(context, 1), np.where(keys[n - 1] > 0, how.backoff * value, value))
        level = np.where(found, n, level)
    alone = np.bincount(doc, weights=level == 1, minlength=n_docs)
    return n_words, np.bincount(doc, weights=np.log(value), minlength=n_docs), alone


def _score(all_words: int, how: Backoff):
    schema = "doc_id long, n_words long, log_score double, n_single long"

    def task(texts: pa.Table, returned: pa.Table) -> pa.Table:
        listed = _texts(texts)
        doc, keys = ngrams(listed, how)
        returned = returned.sort_by("shard")
        sizes = returned.column("n").to_pylist()
        parts = [_unpacked(x.as_py(), n, np.int64) for x, n in zip(returned.column("others"), sizes)]
        in_others = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        del parts
        found = score_texts(doc, keys, len(listed), in_others, all_words, how)
        columns = [pc.list_flatten(texts.column("ids")), pa.array(found[0].astype(np.int64)), pa.array(found[1]), pa.array(found[2].astype(np.int64))]
        return pa.table(columns, [c.split()[0] for c in schema.split(", ")])

    return task, schema


def backoff_scores(docs: DataFrame, how: Backoff = Backoff(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_score, mean_log_score, n_single (words scored alone) for every row of ``docs``."""
    named = columns_of(docs, doc_id=id_col, text=text_col)
    size = named.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.regexp_count("text", F.lit(WORD))).alias("words")
    ).first()
    all_words = int(size["words"] or 0)
    slots = -(-int(size["bytes"] or 0) // how.slot_bytes) or 1
    shards = -(-all_words * how.order // how.shard_entries) or 1
    slot = F.pmod(F.xxhash64(F.lit(how.seed), "doc_id", "text"), F.lit(slots)).cast("int")
    kind = named.schema["doc_id"].dataType.simpleString()
    blocks = named.withColumn("slot", slot).mapInArrow(_pack(how), f"slot int, ids array<{kind}>, size long, packed binary")
    dealt = blocks.repartition(slots, "slot")
    sent = dealt.groupBy("slot").applyInArrow(*_send(shards, how))
    totals = sent.repartition(shards, "shard").groupBy("shard").applyInArrow(
        _add_up, "slot int, shard int, n int, others binary"
    )
    scored = dealt.groupBy("slot").cogroup(totals.groupBy("slot")).applyInArrow(*_score(all_words, how))
    return scored.select(
        "doc_id", "n_words", "log_score", F.try_divide("log_score", "n_words").alias("mean_log_score"), "n_single"
    )
