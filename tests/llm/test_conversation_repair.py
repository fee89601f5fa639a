import hashlib
import heapq
import random
import re
import zlib
from collections import Counter
from itertools import product

import pytest

from claimsieve.llm import conversation_repair as repair
from claimsieve.llm.queries import op11_conversation_repair

CONVS = "conv_id long, turn long, role string, text string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def broken(rows):
    """The dealt damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2 and text is not None:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def fault_of(seen, role, text):
    solid = (text or "").strip(BLANKS)
    if not solid:
        return "blank"
    return "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"


def search(rows, faults):
    """(cost, audit, turns) of the cheapest repair: a search by cost, then audit, over rows done and roles so far."""
    ready = [(0, "", 0, "", ())]
    done = set()
    while ready:
        cost, audit, at, last, turns = heapq.heappop(ready)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, turns

        def reached(role, text, edit, more, step):
            if {"s": last == "", "u": last in ("", "s", "a"), "a": last == "u"}.get(role[0], False):
                heapq.heappush(ready, (cost + more, audit + edit, at + step, role[0], (*turns, (role, text))))

        for role in ("user", "assistant"):
            reached(role, "", "I", 3, 0)
        if at < len(rows):
            heapq.heappush(ready, (cost + 4, audit + "D", at + 1, last, turns))
            if faults[at] not in ("blank", "duplicate"):
                extra = 3 * (faults[at] == "truncated")
                if rows[at][2]:
                    reached(rows[at][2], rows[at][3], "K", extra, 1)
                for role in ("user", "assistant"):
                    reached(role, rows[at][3], "R", 3 + extra, 1)
    raise AssertionError("no repair")


def plain(original, after):
    out = {}
    for conv in {r[0] for r in original}:
        order = lambda r: tuple((x is not None, x) if x is not None else (False,) for x in (r[1], r[2], r[3]))
        rows = sorted((r for r in after if r[0] == conv), key=order)
        seen, faults = set(), []
        for r in rows:
            faults.append(fault_of(seen, r[2], r[3]))
            seen.add((r[2], r[3]))
        turns = [r[1] for r in rows if r[1] is not None]
        initials = [(r[2] or "")[:1] for r in rows]
        count = Counter(faults)
        cost, audit, kept = search(rows, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest(),
        )
    return out


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def sample(seed=4, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for i in range(rng.choice((1, 2, 3, 5, 8, 9))):
            words = rng.choice(["Yes.", "No!", "Why?", "Well", "", " \t", "It is so. ", None])
            text = words if words is None or rng.random() < 0.3 else f"{i} {words}"
            role = ("user", "assistant")[i % 2] if rng.random() < 0.8 else rng.choice(["user", "assistant", "system", "tool", None, "", "agent"])
            rows.append((conv, i if rng.random() < 0.9 else rng.choice([None, 0, 50]), role, text))
    rows += rows[5:9] + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 2, "assistant", "Ho.")]
    long = [(900, i, ("user", "assistant")[(i // 1) % 2 if i % 7 else 0], f"Turn {i % 37}{'.' if i % 5 else ''}") for i in range(90)]
    return rows + long


@pytest.mark.parametrize("chunk", [2000, 3])
@pytest.mark.parametrize("parts", [1, 9])
def test_repair_matches_a_search_over_all_edits(spark, monkeypatch, chunk, parts):
    rows = sample()
    monkeypatch.setattr(repair, "CHUNK", chunk)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, CONVS).repartition(3)
        assert found(repair.repair(df)) == plain(rows, rows)
        damaged = repair.damage(df)
        assert found(repair.repair(damaged, copies_col="copies")) == plain(rows, broken(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_triangle_over_all_rows_gives_the_cell_of_the_blocks():
    """All spans and all splits of 40 rows, against blocks of 16."""
    rng = random.Random(1)
    for _ in range(4):
        symbols = "".join(rng.choice("suaUA-x") for _ in range(40))
        assert repair.chart([repair.row_cell(x) for x in symbols]) == repair.parse(symbols)


def test_short_runs_against_every_sequence_of_edits():
    """Up to three rows with up to two insertions at any place, tried one by one."""
    letters = "suaUx-"
    for n in range(4):
        for symbols in map("".join, product(letters, repeat=n)):
            best = min(_tried(symbols))
            got = repair.cheapest(repair.parse(symbols))
            assert got <= best and (got == best or got[1].count("I") > 2)


def _tried(symbols):
    options = [["D"] if x == "-" else ["K", "R", "D"] for x in symbols]
    for edits in product(*options):
        for i in range(3):
            for places in product(range(len(symbols) + 1), repeat=i):
                if list(places) != sorted(places):
                    continue
                audit, cost, out, rows = "", 0, [], list(zip(symbols, edits))
                for at in range(len(symbols) + 1):
                    new = places.count(at)
                    audit, cost, out = audit + "I" * new, cost + 3 * new, out + ["ua"] * new
                    if at < len(rows):
                        letter, edit = rows[at]
                        audit += edit
                        cost += {"K": 0, "R": 3, "D": 4}[edit] + (3 if letter.isupper() and edit != "D" else 0)
                        out += [] if edit == "D" else [letter.lower()] if edit == "K" else ["ua"]
                if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in product(*out)):
                    yield cost, audit


def test_many_equal_rows_and_conversations_without_rows(spark):
    rows = [(1, 5, "user", "Again.")] * 50 + [(1, 6, "assistant", "So."), (2, None, None, None)]
    df = spark.createDataFrame(rows, CONVS)
    assert found(repair.repair(df)) == plain(rows, rows)
    none = df.selectExpr("*", "0 AS n")
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(repair.repair(none, copies_col="n")) == {c: (0, 0, 0, 0, 0, 0, "", nothing) for c in (1, 2)}
    assert repair.repair(df.limit(0)).collect() == []


def test_long_texts_and_clashing_columns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "x" * 1_500_000 + ".") for i in range(4)]
    rows = [(*r[:3], f"{r[1]}{r[3]}") for r in rows]
    df = spark.createDataFrame(rows, CONVS).selectExpr("*", "'c' AS copies", "1 AS n", "2 AS fault", "3 AS chunk", "4 AS _id")
    assert found(repair.repair(df)) == plain(rows, rows)
    damaged = repair.damage(df)
    assert damaged.columns[-1] == "copies_"
    assert found(repair.repair(damaged, copies_col="copies_")) == plain(rows, broken(rows))


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_conversation_repair(spark, folder)) == plain(rows, broken(rows))
