import hashlib
import re

import numpy as np
import pytest
import xxhash

from claimsieve.llm import components, exact_dedup, simhash
from tests.llm.helpers import SCHEMA, frame, rows, widened

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def grouped(data):
    """(doc_id, text) -> expected row, by comparing texts."""
    found = {}
    for r in data:
        found.setdefault(BLANKS.sub("", r[1] or ""), []).append(r)
    out = []
    for solid, members in found.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        for r in members:
            out.append((r[0], keep[0], len(members), hashlib.sha256(solid.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_groups_match_brute_force(spark, block):
    data = rows(80)
    got = exact_dedup.exact_groups(widened(frame(spark, data)), block=block).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == grouped(data)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.keep_id == r.doc_id for r in got if r.kept)


def test_names_hold_without_a_good_hash(spark, monkeypatch):
    """Blocks are told apart by their contents even where all hashes are equal."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "block_hash", lambda block: F.length(block).cast("long") % 2)
    data = rows(30)
    got = exact_dedup.exact_groups(frame(spark, data), block=20).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == grouped(data)


def test_without_copies_keeps_one_row_of_each(spark):
    data = rows(80)
    left = exact_dedup.without_copies(frame(spark, data))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = [BLANKS.sub("", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({BLANKS.sub("", r[1] or "") for r in data})


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(nothing).collect() == []
    assert simhash.near_duplicates(nothing).collect() == []
    assert exact_dedup.without_copies(nothing).collect() == simhash.without_near_duplicates(nothing).collect() == []


def plain_fingerprint(text, size=4):
    words = [w for w in BLANKS.split((text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, ids, radius):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprints_and_components_match_brute_force(spark):
    data = rows(70) + [(900, "Élan ÀB c d one two", "fr", "a", 1), (901, "A b C", "en", "a", 1)]
    prints = [plain_fingerprint(r[1]) for r in data]
    want = plain_components(prints, [r[0] for r in data], 4)
    got = simhash.near_duplicates(widened(frame(spark, data))).collect()
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=repr) == sorted(
        [(r[0], f"{p:016x}", c) for r, p, c in zip(data, prints, want)], key=repr
    )


def test_every_pair_within_the_radius_meets_in_a_table():
    rng = np.random.default_rng(5)
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    assert len(masks) == 31
    for _ in range(3000):
        gap = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any(gap & m == 0 for m in masks)


@pytest.mark.parametrize("limit", [256, 16])
def test_links_of_a_dense_cluster_join_what_brute_force_joins(spark, limit):
    """A ball of fingerprints around one centre, and chains out of it: buckets overflow and are dealt again."""
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 62))
    found = {centre}
    for _ in range(150):
        found.add(centre ^ sum(1 << int(b) for b in rng.choice(14, 3, replace=False)))
    at = centre
    for step in range(12):
        at ^= sum(1 << (20 + 3 * step + k) for k in range(3))
        found.add(at)
    found |= {int(x) for x in rng.integers(0, 1 << 63, 80)}
    values = sorted(found)
    nodes = spark.createDataFrame([(v,) for v in values], "f long")
    roots = {r.node: r.root for r in components.components(simhash.links(nodes, 4, limit), "a", "b").collect()}
    want = plain_components(values, values, 4)
    assert [roots.get(v, v) for v in values] == want


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {x: 100 for x in range(100, 160)}


def test_one_row_of_every_component_stays(spark):
    data = rows(70)
    all_of = simhash.near_duplicates(frame(spark, data)).collect()
    left = simhash.without_near_duplicates(frame(spark, data)).collect()
    assert len(left) == len({r.component_id for r in all_of})
    assert sorted((r.doc_id for r in left), key=repr) == sorted({r.component_id for r in all_of}, key=repr)


def test_columns_of_any_name_are_kept(spark):
    """Names that the operators use inside, some in capitals."""
    from pyspark.sql import functions as F

    from claimsieve.llm import mixing

    names = ("_id", "_KEY", "_text_hash", "_size", "_source", "_mix", "_copy", "_of", "_draw", "_first", "_component", "C0", "bucket", "kept")
    data = rows(40)
    docs = frame(spark, data).select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for act in (exact_dedup.without_copies, simhash.without_near_duplicates, mixing.mix):
        left = act(docs)
        assert left.columns == docs.columns
        got = left.where("doc_id IS NOT NULL").collect()
        assert got and all(r[n] == f"{n}{r.doc_id}" for r in got for n in names), act.__name__


def test_texts_longer_than_a_slice(spark):
    long = "alpha beta gamma delta epsilon " * 100_000
    data = [(1, long, "en", "a", 1), (2, long.replace(" ", "  "), "en", "a", 1), (3, long[:-8] + "other end.", "en", "b", 1), (4, "short", "en", "b", 1)]
    docs = frame(spark, data)
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()} == {1: 2, 2: 2, 3: 3, 4: 4}
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {d: f for d, (f, _) in got.items()} == {r[0]: plain_fingerprint(r[1]) for r in data}
    assert got[3][1] == got[2][1] == 1
