import random

import pytest

from claimsieve.llm import mixing
from tests.llm.helpers import SCHEMA, frame, rows, widened


def filled(sizes, weights, share=1.5, most=2.0):
    """Clamp one source after the other until none is above its cap."""
    total = share * sum(sizes.values())
    clamped = {}
    while True:
        free = {s: weights[s] for s in sizes if s not in clamped and sizes[s] > 0}
        if not free:
            return {s: clamped.get(s, 0.0) for s in sizes}
        rest = total - sum(clamped.values())
        share_of = {s: rest * w / sum(free.values()) for s, w in free.items()}
        above = [s for s in free if share_of[s] > most * sizes[s]]
        if not above:
            return {s: clamped.get(s, share_of.get(s, 0.0)) for s in sizes}
        clamped |= {s: most * sizes[s] for s in above}


def many(seed=3, n=900):
    rng = random.Random(seed)
    return [
        (i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice((5, 30, 80, 400)))), "en",
         rng.choice(("hot", "hot", "hot", "a", "b", "c", "d", None)), 1)
        for i in range(n)
    ]


def test_targets_follow_the_water_filling(spark):
    data = many()
    got = mixing.plan(widened(frame(spark, data))).collect()
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    order = sorted(s for s in sizes if s is not None) + [None]
    want = filled(sizes, {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)})
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sizes[s] and mine[0].target == pytest.approx(want[s])
        taken = sum(r.taken for r in mine)
        assert abs(taken - want[s]) <= 200, s  # half of the largest row
    assert all(r.taken <= 2 * r.size and r.taken == r.repeats * r.size for r in got)
    assert len(got) == len(data)


def test_reruns_and_layouts_agree_and_seeds_differ(spark):
    data = many(4, 400)
    one = sorted((r.doc_id, r.taken) for r in mixing.plan(frame(spark, data)).collect())
    two = sorted((r.doc_id, r.taken) for r in mixing.plan(frame(spark, data).repartition(7)).collect())
    other = sorted((r.doc_id, r.taken) for r in mixing.plan(frame(spark, data), mixing.Mix(seed=9)).collect())
    assert one == two != other


def test_mix_repeats_rows_as_planned(spark):
    data = many(5, 300)
    planned = {r.doc_id: r.repeats for r in mixing.plan(frame(spark, data)).collect()}
    mixed = mixing.mix(widened(frame(spark, data)))
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {i: n for i, n in planned.items() if n} == counts
    assert "size" in mixed.columns and "_size" not in mixed.columns


def test_given_weights_and_odd_rows(spark):
    data = rows()
    weights = spark.createDataFrame([("a", 1.0), (None, 3.0)], "source string, weight double")
    got = mixing.plan(frame(spark, data), weights=weights).collect()
    assert len(got) == len(data) and {r.taken for r in got if r.source in ("b", "c")} == {0}
    assert all(r.size == len((r_text or "").split()) for r, r_text in [(r, dict((x[0], x[1]) for x in data)[r.doc_id]) for r in got])


def test_empty_and_wordless_tables(spark):
    assert mixing.plan(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.plan(frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 1)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
