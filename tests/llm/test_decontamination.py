import random
import re

import pytest

from claimsieve.llm import decontamination
from claimsieve.llm.common import SLICE_BYTES
from claimsieve.llm.decontamination import Search
from tests.llm.helpers import WORDS, frame, prose, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(data, items, width=10):
    """(doc_id, text) -> what is found by comparing every window with every run of words."""
    windows = []
    for item, text in items:
        words = words_of(text)
        size = min(width, len(words))
        windows += [(item, tuple(words[i : i + size])) for i in range(len(words) - size + 1) if words]
    out = []
    for r in data:
        words, hit, found = words_of(r[1]), set(), set()
        for item, window in set(windows):
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(item)} - {"None"}
        out.append((r[0], len(words), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    assert all(r.n_hit == sum(s.last_word - s.first_word + 1 for s in r.spans) for r in rows)
    assert all(b.first_word > a.last_word + 1 for r in rows for a, b in zip(r.spans, r.spans[1:]))
    return sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows], key=repr)


def planted(seed=3):
    """Texts with whole items, overlapping parts of two items, and runs one word too short."""
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice((10, 14, 30)))) for i in range(12)]
    items += [(12, "Solo"), (13, "two words"), (14, "ärger über é"), (15, None), (16, " .,- "), (None, prose(rng, 15))]
    items += [items[3], (17, items[3][1]), (18, items[4][1].upper() + " " + prose(rng, 4))]
    data = rows(40)
    for i, (_, text) in enumerate(items[:12]):
        part = words_of(text)
        inside = [rng.choice(WORDS) for _ in range(20)]
        whole = inside[:9] + part + inside[9:]
        data.append((100 + i, " - ".join(whole).title(), "en", "a", 1))
        data.append((200 + i, " ".join(inside + part[:9] + ["zz"] + part[:10] + part[1:10]), "en", "a", 1))
    data += [(300, "a solo; two\twords, two; words. Ärger über é", "de", "b", 1), data[-1], data[45]]
    return data, items


@pytest.mark.parametrize("how", [Search(), Search(pass_bytes=300), Search(block=1, lane=3), Search(width=4, block=2)])
def test_hits_match_brute_force(spark, how):
    data, items = planted()
    bench = spark.createDataFrame(items, ITEMS)
    expected = plain(data, items, how.width)
    assert found(decontamination.contamination(frame(spark, data), bench, how=how)) == expected
    assert sum(x[4] for x in expected) > 20


def test_a_text_longer_than_a_slice_is_searched_over_its_cuts(spark, monkeypatch):
    """A window lies wherever a cut may fall."""
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 40)
    data, items = planted()
    windows = decontamination.tables([(None if i is None else str(i), t) for i, t in items], Search())
    for r in data:
        counts, hits = decontamination.search([(r[1] or "").encode()], windows, Search())
        runs, named = hits.get(0, ([], []))
        got = (r[0], counts[0], sum(b - a + 1 for a, b in runs), named, bool(runs))
        assert got == plain([r], items)[0]
    assert SLICE_BYTES > 40


def test_long_text_through_spark(spark):
    rng = random.Random(5)
    item = prose(rng, 40)
    filler = "x " * (SLICE_BYTES + 10)
    data = [(1, filler + item + " " + filler + " ".join(item.split()[5:20]), "en", "a", 1), (2, filler, "en", "a", 1)]
    bench = spark.createDataFrame([(7, item)], ITEMS)
    got = {r.doc_id: r for r in decontamination.contamination(frame(spark, data), bench).collect()}
    assert (got[1].n_hit, got[1]["items"], got[2].contaminated) == (55, ["7"], False)


def test_clean_rows_stay_with_all_columns_and_empty_tables(spark):
    from pyspark.sql import functions as F

    data, items = planted()
    bench = spark.createDataFrame(items, ITEMS)
    extra = ("_id", "_key", "_text_hash", "n_words", "items", "spans", "copy", "item")
    docs = frame(spark, data).select("*", *[F.lit(c).alias(c) for c in extra])
    left = decontamination.decontaminated(docs, bench)
    assert left.columns == docs.columns
    clean = sorted(x[0] or -1 for x in plain(data, items) if not x[4])
    assert sorted(r.doc_id or -1 for r in left.collect()) == clean
    assert left.select("_text_hash", "_id").distinct().collect() == [("_text_hash", "_id")]
    nothing = frame(spark, data).limit(0)
    assert decontamination.contamination(nothing, bench).collect() == []
    none = decontamination.contamination(frame(spark, data), bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(data)
