import random
import re
from collections import Counter, defaultdict

import pytest

from claimsieve.llm import source_audit
from claimsieve.llm.source_audit import Audit
from tests.llm.helpers import frame, prose, rows, widened

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(data, how):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for r in data:
        lang, source = r[2] or "", r[3] or ""
        words = TERM.findall((r[1] or "").translate({c: c + 32 for c in range(65, 91)}))
        groups[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {k[0] for k in groups}:
        kept = [w for w, n in docs[lang].items() if n >= how.least_docs]
        mine = {s: c for (g, s), c in groups.items() if g == lang}

        def shares(count):
            whole = sum(count[w] for w in kept)
            return {w: 1 + 1000**how.steps * (count[w] + how.add) // (whole + how.add * len(kept)) for w in kept}

        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        for s in mine:
            far = [(-sum(abs(p[s][w] - p[t][w]) for w in kept), t.encode()) for t in mine if t != s]
            more = [(q[w] - p[s][w], w.encode()) for w in kept if mine[s][w] and p[s][w] > q[w]]
            for part, listed in (("pair", sorted(far)), ("term", sorted(more)[: how.top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(listed)]
    return sorted(out)


def corpus():
    rng = random.Random(9)
    data = rows(60)
    for i in range(60):
        text = prose(rng, 30) + " Überall été naïve42STRASSE ẞ" * (i % 3)
        data.append((500 + i, text, rng.choice(("en", "de", "fr")), rng.choice(("a", "b", "ä", "")), 1))
    return data + [(600, "einsam 123", "zz", "only", 1), (601, None, "zz", "other", 0), (602, "x", None, "lone", 1)]


@pytest.mark.parametrize(
    "how",
    [Audit(least_docs=4, top=7), Audit(least_docs=4, top=7, entries=20), Audit(least_docs=6, digest_bits=3), Audit(least_docs=1, digest_bits=5)],
)
def test_audit_matches_brute_force_also_where_digests_collide(spark, how):
    data = corpus()
    got = source_audit.divergence(widened(frame(spark, data)), how=how).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got) == plain(data, how)


def test_shares_are_exact_for_counts_beyond_a_product_of_64_bits(spark):
    from pyspark.sql import functions as F

    cases = [(4_000_000_000_000, 9_000_000_000_000, 3), (0, 7, 1), (7, 7, 1), (123_456_789_012, 123_456_789_013, 11)]
    df = spark.createDataFrame(cases, "n long, whole long, terms long")
    how = Audit()
    got = [r[0] for r in df.select(source_audit.share(F.col("n"), F.col("whole"), F.col("terms"), how)).collect()]
    assert got == [1 + 10**9 * (n + 5) // (w + 5 * t) for n, w, t in cases]


def test_long_text_and_empty_table(spark, monkeypatch):
    data = [(1, "ab cd " * 700_000, "en", "a", 1), (2, "ab", "en", "b", 1)]
    how = Audit(least_docs=1)
    got = source_audit.divergence(frame(spark, data), how=how).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got) == plain(data, how)
    assert source_audit.divergence(frame(spark, data).limit(0)).collect() == []
