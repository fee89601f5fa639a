"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set if more than half of the hashes of a text's word shingles have it set.
Texts are linked if their fingerprints differ in at most ``radius`` bits, and each row gets the
smallest id that links reach.

Covering masks find every link. Each of the 64 positions carries a code, a nonzero vector of
``radius + 1`` bits; mask v keeps the positions whose code has an odd product with v. For up to
``radius`` differing positions some nonzero v is orthogonal to all their codes, so that mask drops
them all and both fingerprints fall into one bucket of its table: 31 tables for radius 4, without
a chance of a miss.

Equal fingerprints are one node, so copies cost nothing. Inside a bucket a task joins what is
within the radius and passes on a spanning forest, fewer links than members. A bucket with more
than ``bucket_limit`` members is dealt into further covering tables over the bits it does not
share yet; with every round the members agree in more bits, until few enough different
fingerprints remain possible. Nothing is capped.

Defined results: NULL, empty and blank texts have no shingle and fingerprint 0, and are linked as
any other fingerprint; NULL ids never name a component unless no row of it has an id; repeated
rows are returned each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import KEY, bounded, columns_of, keep_rows, raw_texts, slices, stored, text_key
from claimsieve.llm.components import components

BITS = 64
SEED = 42
#: Members of a bucket that one task compares with each other.
BUCKET_LIMIT = 256


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 of every word shingle of one text, repeats included."""
    words = raw.lower().split()  # bytes: lower-cases A-Z only and splits at the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = (digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()))
    return np.fromiter(hashes, np.uint64, len(words) - size + 1)


def fingerprint(raw: bytes, size: int) -> int:
    """Bit by bit a majority vote; long texts vote in blocks, so memory stays bounded."""
    hashes = shingle_hashes(raw, size)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        block = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """(doc_id, text hash, f) for every row: the fingerprint as a signed 64-bit integer."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(raw, shingle_words) for raw in raw_texts(part)]
            columns = [part.column("doc_id"), part.column(KEY), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", KEY, "f"])

    return docs.select("doc_id", text_key(), "text").mapInArrow(task, f"doc_id long, {KEY} long, f long")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(radius: int, turn: int = 0) -> list[int]:
    """The 2^(radius+1) - 1 masks as signed integers. ``turn`` deals the codes to other positions."""
    codes = (1 << (radius + 1)) - 1
    order = np.random.default_rng(turn).permutation(BITS) if turn else np.arange(BITS)
    code = {int(position): 1 + i % codes for i, position in enumerate(order)}
    return [
        _signed(sum(1 << p for p in range(BITS) if (code[p] & v).bit_count() % 2)) for v in range(1, codes + 1)
    ]


def _tables(members: DataFrame, radius: int, turn: int) -> DataFrame:
    """Every member in each table of this round: its bucket, the bits the bucket shares, the masked fingerprint."""
    masks = F.explode(F.array(*[F.lit(m) for m in covering_masks(radius, turn)]))
    dealt = members.withColumn("mask", masks)
    shares = F.col("shared").bitwiseOR(F.col("mask"))
    return dealt.select(shares.alias("shared"), F.col("f").bitwiseAND(shares).alias("key"), "f", "path", "mask").select(
        "shared", "key", F.xxhash64("path", "mask").alias("path"), "f"
    )


def _forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever chains of close members join, fewer than there are members."""
    n = len(members)
    bits = members.view(np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius, 1))
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = find(i), find(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((i, j))
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return members[pairs[:, 0]], members[pairs[:, 1]]


def _links_within(buckets: DataFrame, radius: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_forest(np.array(m, np.int64), radius) for m in batch.column("members").to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[side] for x in found])) for side in (0, 1)], ["a", "b"]
                )

    return buckets.select("members").mapInArrow(task, "a long, b long").where("a <> b").distinct()


def links(nodes: DataFrame, radius: int = 4, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b) fingerprints within the radius, enough of them to join every chain; ``nodes`` has different ``f``."""
    bucket = ["shared", "key", "path"]
    members = nodes.select("f", F.lit(0).cast("long").alias("shared"), F.lit(0).cast("long").alias("path"))
    found, turn = None, 0
    while True:
        dealt = _tables(members, radius, turn)
        sizes = stored(dealt.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
        small = stored(dealt.join(sizes.where(F.col("n") <= bucket_limit), bucket), "members")
        new = _links_within(small.groupBy(*bucket).agg(F.collect_set("f").alias("members")), radius)
        found = new if found is None else found.unionAll(new)
        large = sizes.where(F.col("n") > bucket_limit)
        if large.isEmpty():
            return found.distinct()
        members = stored(dealt.join(bounded(large), bucket).select("f", "shared", "path"), "hot")
        turn += 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                    radius: int = 4, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, f (signed), fingerprint (hex), component_id and the text's hash for every row of ``docs``."""
    rows = fingerprints(columns_of(docs, doc_id=id_col, text=text_col), shingle_words)
    rows = stored(rows, "fingerprints")
    nodes = stored(rows.groupBy("f").agg(F.min("doc_id").alias("least")), "nodes")
    roots = stored(components(links(nodes, radius, bucket_limit), "a", "b"), "roots")
    placed = nodes.join(roots, nodes["f"] == roots["node"], "left").select(
        "f", "least", F.coalesce("root", "f").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(placed.join(named, "root").select("f", "component_id"), "classes")
    return rows.join(classes, "f").select("doc_id", "f", hex_of("f").alias("fingerprint"), "component_id", KEY)


def hex_of(column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """One row of ``docs`` per component, with all its columns: the smallest id, and of its texts the smallest hash."""
    found = stored(near_duplicates(docs, id_col, text_col, **settings), "near")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy(F.col("component_id").alias("_component")).agg(F.min(KEY).alias("_first"))
    joined = found.join(first, F.col("component_id").eqNullSafe(F.col("_component")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col(KEY) == F.col("_first"))
    return keep_rows(docs, joined.select("doc_id", KEY, kept.alias("kept")), id_col, text_col, once=True)
