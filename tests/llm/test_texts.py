import math
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from claimsieve.llm import lm_scoring, pieces, quality_rules, sentence_pieces, token_counts
from tests.llm.helpers import SCHEMA, frame, rows, widened

ODD = [
    "", " ", "a", "  x  y ", "\n\n\t", "日本語テキスト 🙂🙂 x", "\x00\x01", "no blank" * 40, "ab" * 900,
    "Ünïcödé straße", "The quick brown fox, 12.5% #1!", " leading", "trailing ", "x" * 70,
]


def plain_tokens(text):
    """Every chunk of the prepared text by the plain rule."""
    line, out, start = pieces.prepared(text), [], 0
    for i in range(1, len(line) + 1):
        if i == len(line) or (line[i] == "▁" and line[i - 1] != "▁"):
            out += sentence_pieces.plain_viterbi(line[start:i])
            start = i
    return out


@pytest.fixture(scope="module")
def texts():
    return ODD + [r[1] or "" for r in rows(25)]


def test_batched_viterbi_matches_the_plain_one(texts):
    ids, counts = sentence_pieces.encode_texts(texts)
    ends = np.cumsum(counts)
    got = [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]
    assert got == [plain_tokens(t) for t in texts]
    assert sentence_pieces.decode_ids(ids, counts) == texts


def test_no_worse_than_the_public_library():
    """Its sums are single-precision: it may miss the best one by what those lose, and never beats it."""
    raw = open(pieces.VOCABULARY, "rb").read()
    kind = b"tok_v0\x18\x02"  # the field that names the kind of model; 1 is unigram
    assert raw.count(kind) == 1
    library = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(kind, kind[:-1] + b"\x01"))
    scores = pieces.read_pieces().scores
    words = sorted({w for r in rows(30) for w in (r[1] or "").split()} | {"the", "and", "hesting", "unbelievable"})
    for w in words:
        mine, theirs = sentence_pieces.plain_viterbi("▁" + w), library.encode(w)
        gain = scores[mine].sum() - scores[theirs].sum()
        assert 0 <= gain < 128, w


def test_merges_give_the_ids_of_the_unpatched_library(texts, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    more = texts + ["The unbelievable hesting of 1234 aaaaaaa straße, l'été 🙂."]
    want = [library.encode(t) for t in more]
    for longest in (sentence_pieces.LONGEST_BATCHED, 3):  # batched, and by the heap
        monkeypatch.setattr(sentence_pieces, "LONGEST_BATCHED", longest)
        ids, counts = sentence_pieces.encode_texts(more, rule=sentence_pieces.MERGES)
        ends = np.cumsum(counts)
        assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends)] == want
        assert sentence_pieces.decode_ids(ids, counts) == more
    assert token_counts.count_tokens(more, rule=sentence_pieces.MERGES)[1].tolist() == [len(x) for x in want]


def test_false_hash_matches_are_noticed(texts, monkeypatch):
    """Where two strings share a hash the round trip fails, and strings are compared instead."""
    want = sentence_pieces.encode_texts(texts[:8])
    monkeypatch.setattr(sentence_pieces, "_probe", lambda h, p, seen: (np.arange(len(h)), np.full(len(h), 300)))
    got = sentence_pieces.encode_texts(texts[:8])
    assert all(np.array_equal(a, b) for a, b in zip(got, want))


def test_encode_and_decode_tables(spark):
    data = rows(30)
    encoded = sentence_pieces.encode(widened(frame(spark, data)))
    back = sentence_pieces.decode(encoded).collect()
    assert sorted([(r.doc_id, r.decoded) for r in back], key=repr) == sorted([(r[0], r[1] or "") for r in data], key=repr)
    assert {"row", "text", "tokens"} <= set(encoded.columns)
    assert sentence_pieces.decode(sentence_pieces.encode(spark.createDataFrame([], SCHEMA))).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [-5, 10**6, 0, None]), (3, [])], "doc_id int, tokens array<int>")
    assert [r.decoded for r in sentence_pieces.decode(odd).collect()] == ["", "", ""]


def test_the_mark_in_a_text_becomes_a_blank():
    ids, counts = sentence_pieces.encode_texts(["▁▁ab ▁"])
    assert sentence_pieces.decode_ids(ids, counts) == ["  ab  "]


def test_trie_counts_match_the_plain_segmentation(texts):
    pre, tokens = token_counts.count_tokens(texts)
    assert tokens.tolist() == [len(plain_tokens(t)) for t in texts]
    assert pre[:3].tolist() == [0, 1, 1]


def test_token_counts_table(spark):
    data = rows(30)
    got = token_counts.token_counts(widened(frame(spark, data))).collect()
    want = [(r[0], len(r[1] or ""), len(plain_tokens(r[1] or ""))) for r in data]
    assert sorted([(r.doc_id, r.n_chars, r.n_tokens) for r in got], key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_measures(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_measures_match_brute_force(spark):
    noisy = [
        (500, "a b c a b c d a b c\nx # | <b>\nx # | <b>\n \n \n", "en", "a", 1),
        (501, "same " * 90, "en", "a", 1),
        (502, "é ü 日本 " * 30 + "\nq\nq\x0bq\nq", "de", "b", 1),
    ]
    data = rows(40) + noisy
    got = quality_rules.quality_rules(widened(frame(spark, data))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = [(r[0], *plain_measures(r[1])) for r in data]
    assert sorted([(r.doc_id, *[r[c] for c in names]) for r in got], key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fertility_measures_match_the_vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_file=quality_rules.Rules().vocabulary)
    texts = ["the cat sat on the mat", "日本語 x", ""]
    got = quality_rules.measure_texts([t.encode() for t in texts], quality_rules.Rules().vocabulary)
    for i, t in enumerate(texts):
        ids = [x for w in t.split() for x in model.encode(w)]
        counts = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()) if ids else 0.0
        assert got["n_tokens"][i] == len(ids)
        assert got["n_byte_tokens"][i] == sum(map(model.is_byte, ids))
        assert got["token_entropy"][i] == pytest.approx(entropy)


def test_shouting_and_noise_fall_out_of_their_band(spark):
    rng = random.Random(5)
    vocabulary = "the of and to in that was for with house water people garden morning letter answer little every".split()
    good = [(i, " ".join(rng.choice(vocabulary) for _ in range(160)), "en", "a", 1) for i in range(80)]
    bad = [(1000 + i, r[1].upper().replace(" ", "!! "), "en", "a", 1) for i, r in enumerate(good[:4])]
    bad += [(2000 + i, r[1].replace(" ", "$%# "), "en", "a", 1) for i, r in enumerate(good[:4])]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(frame(spark, good + bad)).collect()}
    assert not any(got[r[0]] for r in bad)
    assert sum(got[r[0]] for r in good) >= 78


def test_each_band_rejects_planted_junk(spark):
    rng = random.Random(6)
    vocabulary = "the of and to in that was for with house water people garden morning letter answer little every".split()
    good = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(80, 600))), "en", "a", 1) for i in range(80)]
    words = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(4)]
    odd = [(1000 + i, " ".join(w + " \U0001fae0" for w in words), "en", "a", 1) for i in range(3)]
    shout = [(2000 + i, r[1].upper(), "en", "a", 1) for i, r in enumerate(good[:3])]
    # Many different words where texts of the language use few.
    flat = [(3000 + i, " ".join(f"{a}{b}" for a in vocabulary for b in vocabulary[:9]), "en", "a", 1) for i in range(3)]
    rows_ = quality_rules.quality_rules(frame(spark, good + odd + shout + flat)).collect()
    out = {c: {r.doc_id for r in rows_ if not r[f"{c}_low"] <= r[c] <= r[f"{c}_high"]} for c in quality_rules.BANDED}
    assert {r[0] for r in odd} <= out["byte_share"]
    assert {r[0] for r in shout} <= out["chars_per_token"]
    assert {r[0] for r in flat} <= out["entropy_gap"]
    assert sum(r.kept for r in rows_ if r.doc_id < 1000) >= 76 and not any(r.kept for r in rows_ if r.doc_id >= 1000)


def test_given_labels_fertility_rejects_junk_and_keeps_clean_texts(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_rules.quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).where("not base_failed")
    verdicts = [(r.quality, r.kept) for r in got.join(labels, "doc_id").collect()]
    junk, clean = ([k for q, k in verdicts if q == x] for x in (0, 1))
    assert sum(junk) <= 0.2 * len(junk) and sum(clean) >= 0.98 * len(clean)


def plain_backoff(texts, order, backoff=0.4):
    """Scores from dictionaries of counts, each text without its own."""
    lists = [t.encode().split() for t in texts]
    grams = [[tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w))] for w in lists]
    every = Counter(g for x in grams for g in x)
    out = []
    for w, own in zip(lists, map(Counter, grams)):
        others = lambda g: every[g] - own[g]
        rest = sum(map(len, lists)) - len(w)
        total = 0.0
        for i in range(len(w)):
            factor, n = 1.0, min(order, i + 1)
            while n > 1 and others(tuple(w[i - n + 1 : i + 1])) == 0:
                factor, n = factor * backoff, n - 1
            found = others(tuple(w[i - n + 1 : i + 1]))
            value = found / others(tuple(w[i - n + 1 : i])) if n > 1 else max(found, 1) / max(rest, 1)
            total += math.log(factor * value)
        out.append((len(w), total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores_match_brute_force(spark, order):
    data = rows(40)
    how = lm_scoring.Backoff(order=order, slot_bytes=3000, shard_entries=500)
    got = lm_scoring.backoff_scores(widened(frame(spark, data)), how).collect()
    want = plain_backoff([r[1] or "" for r in data], order)
    assert sorted([(r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in got], key=repr) == sorted(
        [(r[0], n, round(s, 6) + 0.0) for r, (n, s) in zip(data, want)], key=repr
    )
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_backoff_of_nothing_and_of_one_text(spark):
    assert lm_scoring.backoff_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    got = lm_scoring.backoff_scores(frame(spark, [(1, "a b", "en", "a", 3), (2, None, "en", "a", 0)])).collect()
    assert {r.doc_id: r.n_words for r in got} == {1: 2, 2: 0}


def test_backoff_moves_texts_as_compressed_blocks(spark):
    """One block per slot and task, and both uses of the slots read one exchange; ids of any kind, also NULL."""
    data = [(i if i % 9 else None, " ".join(f"w{j * i % 50}" for j in range(400)), "en", "a", 0) for i in range(60)] + [(77, None, "en", "a", 0)]
    docs = frame(spark, data).coalesce(1)
    how = lm_scoring.Backoff(slot_bytes=20_000, pack_bytes=30_000)
    kind = "slot int, ids array<bigint>, size long, packed binary"
    with_slot = docs.withColumn("slot", (F.coalesce("doc_id", F.lit(0)) % 3).cast("int")).select("doc_id", "text", "slot")
    blocks = with_slot.mapInArrow(lm_scoring._pack(how), kind).collect()
    assert len(blocks) == 3 and sum(len(b.packed) for b in blocks) < 0.5 * sum(len(r[1] or "") for r in data)
    got = lm_scoring.backoff_scores(docs, how)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "packed" in plan
    want = plain_backoff([r[1] or "" for r in data], 3)
    assert sorted([(r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in got.collect()], key=repr) == sorted(
        [(r[0], n, round(s, 6) + 0.0) for r, (n, s) in zip(data, want)], key=repr
    )
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("ReusedExchange") == 1


def test_order_of_keys_that_share_their_high_bits():
    some = np.random.default_rng(5).integers(0, 1 << 62, 20_000).astype(np.uint64)
    for keys in (some, some & np.uint64(0xFFF), some & np.uint64(0xFF0000000000000F), some[:1], some[:0]):
        assert (lm_scoring._order(keys) == np.argsort(keys, kind="stable")).all()
