import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsieve.llm import license_scan, quality_classifier, toxicity
from tests.llm.helpers import SCHEMA, frame, prose, rows, widened

LABELS = "doc_id long, quality int, toxic int"


# --- Kneser-Ney ---------------------------------------------------------------------------


class PlainKneserNey:
    """The interpolated modified model from its definition, over dictionaries."""

    def __init__(self, texts, order=4):
        self.order, self.counts = order, {order: Counter()}
        for t in texts:
            padded = "\0" * (order - 1) + " ".join(t.split())
            self.counts[order].update(padded[i : i + order] for i in range(len(padded) - order + 1))
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut, self.total, self.rest = {}, {}, {}
        for n, counts in self.counts.items():
            of = Counter(counts.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
            raw = [k - (k + 1) * y * of[k + 1] / of[k] if of[k] and of[1] else None for k in (1, 2, 3)]
            d = [x if x is not None and 0 < x <= k else s for x, k, s in zip(raw, (1, 2, 3), (0.5, 1.0, 1.5))]
            self.cut[n] = {g: min(d[min(c, 3) - 1], c) for g, c in counts.items()}
            self.total[n], left = defaultdict(float), defaultdict(float)
            for g, c in counts.items():
                self.total[n][g[:-1]] += c
                left[g[:-1]] += self.cut[n][g]
            self.rest[n] = {h: left[h] / self.total[n][h] for h in left}

    def p(self, g):
        n = len(g)
        if n == 0:
            return 1 / (len(self.counts[1]) + 1)
        lower = self.p(g[1:])
        if g[:-1] not in self.rest[n]:
            return lower
        top = (self.counts[n][g] - self.cut[n][g]) / self.total[n][g[:-1]] if g in self.counts[n] else 0.0
        return top + self.rest[n][g[:-1]] * lower

    def perplexity(self, text):
        padded = "\0" * (self.order - 1) + " ".join(text.split())
        grams = [padded[i : i + self.order] for i in range(len(padded) - self.order + 1)]
        return math.exp(-sum(math.log(self.p(g)) for g in grams) / len(grams)) if grams else None


@pytest.fixture(scope="module")
def labelled(spark):
    data = rows(60)
    good = [(r[0], 1 if r[0] % 3 else 0, 0) for r in data if r[0] is not None and r[0] < 45]
    labels = good + [(5, None, None), (7, 0, 0), (10_000, 1, 0), (None, 1, 0)]
    return data, labels, spark.createDataFrame(labels, LABELS)


def test_perplexity_matches_the_definition(spark, labelled):
    data, labels, table = labelled
    trusted = {i for i, q, _ in labels if q == 1 and i is not None}
    plain = PlainKneserNey([r[1] or "" for r in data if r[0] in trusted])
    got = quality_classifier.classify(widened(frame(spark, data)).drop("n", "f"), table).collect()
    assert len(got) == len(data)
    text_of = {r[0]: r[1] or "" for r in data}
    for r in got:
        want = plain.perplexity(text_of[r.doc_id])
        assert (r.perplexity is None) == (want is None)
        if want is not None:
            assert r.perplexity == pytest.approx(want, rel=1e-9)
        assert r.trusted == (r.doc_id in trusted)
        assert r.kept == (r.perplexity is not None and (r.most is None or r.perplexity <= r.most))


def test_model_is_a_distribution(spark):
    texts = ["abab ba", "ab c", "cab"]
    plain = PlainKneserNey(texts)
    # Of a known context all known characters and the unknown one sum to one.
    assert sum(plain.p("\0\0\0" + c) for c in "abc ") + plain.p("\0\0\0?") == pytest.approx(1.0)


def test_shuffled_letters_are_rejected_and_prose_is_kept(spark):
    rng = random.Random(3)
    data = [(i, prose(rng, 200), "xx", "a", 1) for i in range(60)]
    noise = [(1000 + i, "".join(rng.sample(r[1], len(r[1]))), "xx", "a", 1) for i, r in enumerate(data[:6])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], LABELS)
    docs = frame(spark, data + noise)
    left = {r.doc_id for r in quality_classifier.accepted(docs, labels).collect()}
    assert left == set(range(60))


def test_without_trusted_text_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality_classifier.classify(frame(spark, rows(12)), none).collect()
    assert all(r.kept == bool((r.n_scored or 0) > 0) for r in got) and len(got) == 14
    assert quality_classifier.classify(spark.createDataFrame([], SCHEMA), none).collect() == []


def test_limits_come_from_trusted_texts_without_their_own_counts(spark):
    rng = random.Random(9)
    data = [(i, prose(rng, 60), "xx", "a", 1) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], LABELS)
    docs = frame(spark, data)
    tables = quality_classifier.train(docs.select("text"))
    text_of = {r[0]: r[1] for r in data}
    scored = quality_classifier.perplexity(docs.select("doc_id", "lang", "text"), tables).collect()
    fold = lambda r: r[quality_classifier.KEY] % quality_classifier.FOLDS
    models = {
        k: PlainKneserNey([text_of[r.doc_id] for r in scored if fold(r) != k]) for k in range(quality_classifier.FOLDS)
    }
    for r in scored:
        assert r.held_out == pytest.approx(models[fold(r)].perplexity(text_of[r.doc_id]), rel=1e-9)
    got = quality_classifier.classify(docs, labels, quality_classifier.Limits(quantile=1.0)).collect()
    assert sum(r.held_out > r.perplexity for r in scored) > 0.8 * len(scored)
    reached = sorted(r.held_out / math.exp(2 / math.sqrt(r.n_scored)) for r in scored)
    limit = reached[-1] + (reached[-1] - reached[39]) * 2 / math.sqrt(80)
    assert all(r.most == pytest.approx(limit * math.exp(2 / math.sqrt(r.n_scored)), rel=1e-9) for r in got)


@pytest.mark.parametrize("few", [True, False])
def test_every_labelled_id_is_trusted(spark, monkeypatch, few):
    """More good labels than once were trusted, and the texts those whose ids hash highest; also where they are joined by shuffles."""
    if not few:
        monkeypatch.setattr(quality_classifier, "bounded", lambda df: df)
    labels = spark.range(400_100).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    last = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id").desc()).limit(40).collect()]
    rng = random.Random(3)
    data = [(i, prose(rng, 30), "en", "a", 0) for i in last] + [(-1, prose(rng, 30), "en", "a", 0)]
    got = quality_classifier.classify(spark.createDataFrame(data, SCHEMA), labels).collect()
    assert {r.doc_id for r in got if r.trusted} == set(last) and len(got) == 41


def test_given_labels_junk_is_rejected_and_clean_texts_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_classifier.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    shares = got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in shares.collect()}
    assert kept[0] <= 0.05 and kept[1] >= 0.99


# --- Toxicity -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(11)
    data, labels = [], []
    for i in range(500):
        lines = [prose(rng, 10) for _ in range(rng.randint(1, 6))]
        toxic = i % 4 == 0
        if toxic:
            lines.insert(rng.randint(0, len(lines)), f"{rng.choice(('you', 'that'))} {rng.choice(('blockhead', 'dimwit'))} again.")
        data.append((i, "\n".join(lines), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return data, labels, spark.createDataFrame(labels + [(0, 1, None), (9999, 1, 1)], LABELS)


def test_held_out_documents_and_offending_sentences(spark, insults):
    data, labels, table = insults
    extra = [(None, None, None, None, None), (2000, "", "en", "a", 0), (2001, " \n.", "en", "a", 3)]
    got = {r.doc_id: r for r in toxicity.toxicity(widened(frame(spark, data + extra)), table).collect()}
    assert len(got) == len(data) + 3
    truth = {i: t for i, _, t in labels}
    for i in truth:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [i for i in truth if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    for i in truth:
        if truth[i] and got[i].predicted:
            assert "blockhead" in got[i].worst_sentence or "dimwit" in got[i].worst_sentence
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[None].score == got[2000].score == got[2001].score == 0.0 and got[2000].worst_sentence is None


def test_labels_of_held_out_rows_change_nothing(spark, insults):
    data, labels, table = insults
    turned = table.withColumn(
        "toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    docs = frame(spark, data)
    one = toxicity.train(docs, table, toxicity.Training(rounds=20))
    two = toxicity.train(docs.repartition(5), turned, toxicity.Training(rounds=20))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_noisy_or_matches_brute_force():
    bags = toxicity.bags([b"a b. c\nd", b"", b"a"], 10)
    model = toxicity.Model(np.random.default_rng(1).random(1 << 10), -1.0)
    p = 1 / (1 + np.exp(-toxicity.sentence_logits(bags, model)))
    assert bags.doc_of_sentence.tolist() == [0, 0, 0, 2]
    want = [1 - np.prod(1 - p[:3]), 0.0, p[3]]
    assert np.allclose(toxicity.noisy_or(bags, toxicity.sentence_logits(bags, model)), want)


def test_without_labels_every_score_is_zero(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.toxicity(frame(spark, rows(12)), none).collect()} == {0.0}
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), none).collect() == []


# --- Licences -----------------------------------------------------------------------------


def plain_matches(data, how=license_scan.Scan()):
    out = []
    for doc_id, text, *_ in data:
        words = [w for w in license_scan.re.split(r"[\W_]+", (text or "").lower()) if w]
        parts = license_scan.shingles(words)
        for name, notice, template in license_scan.TEMPLATES:
            wanted = set(license_scan.shingles(license_scan.plain_words(template)))
            kind = license_scan.window_class(len(wanted), how)
            shares = [
                (len(wanted & set(parts[s : s + kind.width])) / len(wanted), -s) for s in range(0, len(parts), kind.stride)
            ]
            found = [x for x in shares if x[0] >= how.containment - 1e-9]
            if found:
                out.append((doc_id, name, notice, round(max(found)[0], 9), -max(found)[1], len(found)))
    return sorted(out, key=repr)


def test_matches_are_those_of_all_windows(spark):
    rng = random.Random(8)
    data = rows(20)
    for i, (name, notice, text) in enumerate(license_scan.TEMPLATES * 3):
        words = text.split()
        if i >= len(license_scan.TEMPLATES):  # a word less, a word changed
            words[rng.randrange(len(words))] = "" if i % 2 else "else"
        data.append((100 + i, f"{prose(rng, rng.randint(0, 60))} {' '.join(words).upper()}\n{prose(rng, 30)}", "en", "a", 1))
    data.append((300, f"{license_scan.TEMPLATES[0][2]} {license_scan.TEMPLATES[0][2]} and {license_scan.TEMPLATES[2][2]}", "en", "a", 1))
    data += [data[-1], (301, "license licensed released", "en", "a", 1)]
    got = license_scan.license_matches(widened(frame(spark, data))).collect()
    got = sorted([(r.doc_id, r.license, r.notice, round(r.containment, 9), r.first_word, r.n_windows) for r in got], key=repr)
    assert got == plain_matches(data) and len(got) > 15


def test_license_scan_of_nothing_and_its_templates(spark):
    assert license_scan.license_matches(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="words"):
        license_scan.license_matches(spark.createDataFrame([], SCHEMA), (("X", "short", "all rights reserved"),))


def test_no_match_does_without_the_telling_words():
    how = license_scan.Scan()
    words = set(license_scan.telling_words(license_scan.TEMPLATES, how))
    for _, _, text in license_scan.TEMPLATES:
        parts = set(license_scan.shingles(license_scan.plain_words(text)))
        assert sum(not (words & set(p.split())) for p in parts) < how.containment * len(parts)


def test_license_plan_runs_no_python(spark):
    plan = license_scan.license_matches(frame(spark, rows(12)))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_license_scan_reads_texts_and_hashes_shingles_once(spark):
    plan = license_scan.license_matches(frame(spark, rows(12)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 + 2  # the texts, the templates for their bands and for the comparison


def test_the_chance_of_a_miss_is_that_of_random_hashes():
    rng = random.Random(5)
    for shared, others, bands in ((1, 3, 4), (3, 9, 2), (5, 20, 8)):
        missed, trials = 0, 20_000
        for _ in range(trials):
            least = {}
            for i in range(shared + others):
                at, value = rng.randrange(bands), rng.random()
                least[at] = min(least.get(at, (2.0, 0)), (value, i))
            missed += all(i >= shared for _, i in least.values())
        assert abs(missed / trials - license_scan.chance_of_miss(shared, others, bands)) < 0.015


def gnu_header(name, version):
    return (
        f"foo.c -- part of Foo\n\nThis program is free software; you can redistribute it and/or\n * modify it under the terms of the"
        f" GNU {name} Public License\n * as published by the Free Software Foundation; either version {version}\n * of the License, or"
        " (at your option) any later version.\n"
    )


BSD_TEXT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions"
    " and the following disclaimer in the documentation and/or other materials provided with the distribution. {third}THIS SOFTWARE"
    " IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
)
THIRD = (
    "3. Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission. "
)


def test_licences_and_versions_are_told_apart(spark):
    cases = [
        (gnu_header("General", "2"), {"GPL-2.0"}),
        (gnu_header("General", "3"), {"GPL-3.0"}),
        (gnu_header("Lesser General", "2.1"), {"LGPL-2.1"}),
        (gnu_header("Lesser General", "3"), {"LGPL-3.0"}),
        (gnu_header("Affero General", "3"), {"AGPL-3.0"}),
        (BSD_TEXT.format(third=""), {"BSD", "BSD-2-Clause"}),
        (BSD_TEXT.format(third=THIRD), {"BSD", "BSD-3-Clause"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("The text is licensed under CC BY-SA 4.0, see below", {"CC-BY-SA-4.0"}),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", {"CC-BY-NC-SA-4.0"}),
        ("A license is a permission; conditions of distribution are released without restriction by contributors.", set()),
    ]
    cases += [(text, {name}) for name, _, text in license_scan.TEMPLATES if name not in ("MIT", "BSD", "Apache-2.0")]
    cases += [(f"# {text.replace(' ', chr(10) + '# ', 3)}", {name}) for name, _, text in license_scan.TEMPLATES]
    docs = frame(spark, [(i, text, "en", "a", 1) for i, (text, _) in enumerate(cases)])
    found = {i: set() for i in range(len(cases))}
    for row in license_scan.license_matches(docs).collect():
        found[row.doc_id].add(row.license)
    assert [found[i] for i in range(len(cases))] == [wanted for _, wanted in cases]
