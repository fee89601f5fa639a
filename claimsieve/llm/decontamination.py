"""Benchmark decontamination by Wu-Manber search for many test strings at once.

A window is a run of ``width`` words of a benchmark item; an item with fewer words is one window. A
document word is hit if it lies in an occurrence of any window. Words are runs of digits, letters and
whatever lies beyond ASCII, with A-Z lower-cased.

The alphabet of the search is words. Windows of one length share three tables: the shift table says
for a block of words how far the search may move on, because no window has that block nearer to its
end; a block that ends some window moves it by nothing, and the bucket of that block and of the
first block selects the windows to look at; direct comparison of the bytes confirms an occurrence. A slice of
texts is searched in lanes that move together, each by its own shift.

Texts never move: the benchmark's tables travel to them. They are built from at most ``pass_bytes``
of items at a time; a larger benchmark takes several passes over the documents, whose hits are
merged, so what the driver and a task hold of it does not grow.

Defined results: NULL, empty and blank texts have no words and are clean; an item without words has
no window; repeated documents are returned each; repeated items and items with one id count once; an
item whose id is NULL hits words but is not listed; a text longer than a slice is searched in
pieces that overlap; empty tables and further columns of any name are fine.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import KEY, SLICE_BYTES, columns_of, cut_at_blanks, keep_rows, owners, ranges, raw_texts, slices, text_key

#: Bytes as the search reads them: A-Z lower-cased, digits, letters and what lies beyond ASCII kept, blanks for the rest.
READ = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SPAN = "struct<first_word:long,last_word:long>"


@dataclass(frozen=True)
class Search:
    """Words of a window, words of a block, lanes' length, and bytes of items whose tables are made at a time."""

    width: int = 10
    block: int = 3
    lane: int = 256
    pass_bytes: int = 4 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Line:
    """Words on one line with single blanks between them, their places and a code for each.

    The code mixes the first and last eight bytes and the length: equal words have equal codes, and
    what else has one is told apart by the direct comparison.
    """

    def __init__(self, words: list[bytes]):
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.text = b" ".join(words)
        self.end = np.cumsum(length + 1) - 1
        self.start = self.end - length
        padded = bytes(8) + self.text + bytes(8)
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        short = np.minimum(length, 8)
        first = eight[self.start + 8] & _SHORT[short]
        last = eight[self.end] >> (8 * (8 - short)).astype(np.uint64)
        self.code = _mixed(_mixed(first + length.astype(np.uint64)) + last)

    def blocks(self, ends: np.ndarray, size: int) -> np.ndarray:
        """The code of the block of ``size`` words that ends at each place."""
        code = self.code[ends]
        for back in range(1, size):
            code = _mixed(code) + self.code[ends - back]
        return _mixed(code)


@dataclass(frozen=True)
class Windows:
    """The tables of the windows of one length."""

    width: int
    block: int
    shift: np.ndarray
    keys: np.ndarray
    texts: list[bytes]
    items: list[list[str]]

    @classmethod
    def of(cls, found: dict[tuple[bytes, ...], list[str]], width: int, block: int) -> Windows:
        block = min(block, width)
        windows = list(found)
        line = Line([w for window in windows for w in window])
        first = np.arange(len(windows)) * width
        bits = max(12, int(np.ceil(np.log2(16 * width * len(windows)))))
        shift = np.full(1 << bits, width - block + 1, np.int32)
        for place in range(block - 1, width):
            at = line.blocks(first + place, block) & np.uint64(len(shift) - 1)
            np.minimum.at(shift, at.astype(np.int64), width - 1 - place)
        keys = _bucket(line, first + width - 1, width, block)
        order = np.argsort(keys, kind="stable")
        return cls(width, block, shift, keys[order], [b" ".join(windows[i]) for i in order], [found[windows[i]] for i in order])

    def possible(self, line: Line, lane: int) -> np.ndarray:
        """Where the shift table doesn't exclude that a window ends."""
        n = len(line.code)
        at = np.arange(self.width - 1, n, lane)
        stop = np.minimum(at + lane, n)
        mask = np.uint64(len(self.shift) - 1)
        found = []
        while len(at):
            step = self.shift[(line.blocks(at, self.block) & mask).astype(np.int64)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def occurrences(self, line: Line, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, last word, window) of every occurrence."""
        ends = self.possible(line, lane)
        bucket = _bucket(line, ends, self.width, self.block)
        low = np.searchsorted(self.keys, bucket, "left")
        count = np.searchsorted(self.keys, bucket, "right") - low
        ends, window = ends[owners(count)], ranges(low, count)
        starts = ends - self.width + 1
        sides = zip(line.start[starts].tolist(), line.end[ends].tolist(), window.tolist())
        same = np.fromiter((line.text[a:b] == self.texts[w] for a, b, w in sides), bool, len(ends))
        return starts[same], ends[same], window[same]


def _bucket(line: Line, ends: np.ndarray, width: int, block: int) -> np.ndarray:
    """The code of the last and the first block of the windows that end at these places."""
    return _mixed(line.blocks(ends, block)) + line.blocks(ends - width + block, block)


def tables(items: Iterable[tuple[str | None, str | None]], how: Search) -> list[Windows]:
    """The tables of all windows of these items, by window length."""
    found: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(dict)
    for item, text in items:
        words = (text or "").encode().translate(READ).split()
        width = min(how.width, len(words))
        for at in range(len(words) - width + 1 if words else 0):
            known = found[width].setdefault(tuple(words[at : at + width]), [])
            if item is not None and item not in known[-1:]:
                known.append(item)
    return [Windows.of(found[width], width, how.block) for width in sorted(found)]


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of words that these spans cover together."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > reach[:-1] + 1) if len(first) else np.zeros(0, bool)
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)] if len(first) else reach


def search(texts: list[bytes], windows: list[Windows], how: Search) -> tuple[list[int], dict[int, tuple[list, list]]]:
    """Words of every text, and for the texts with an occurrence the runs of hit words and the items."""
    counts, found = [], {}
    if sum(map(len, texts)) <= 2 * SLICE_BYTES:
        lists = [t.translate(READ).split() for t in texts]
        counts = [len(words) for words in lists]
        doc = owners(counts)
        begins = np.cumsum(counts) - counts
        line = Line([w for words in lists for w in words])
        spans, items = defaultdict(list), defaultdict(set)
        for table in windows:
            first, last, window = table.occurrences(line, how.lane)
            inside = doc[first] == doc[last]
            for d, a, b, w in zip(doc[first][inside].tolist(), first[inside].tolist(), last[inside].tolist(), window[inside].tolist()):
                spans[d].append((a - begins[d], b - begins[d]))
                items[d].update(table.items[w])
        for d, runs in spans.items():
            a, b = _merged(*np.array(runs, np.int64).T)
            found[d] = list(zip(a.tolist(), b.tolist())), sorted(items[d])
        return counts, found
    for d, text in enumerate(texts):
        n, runs, items, carried = 0, [], set(), []
        for piece in cut_at_blanks(text.translate(READ), SLICE_BYTES):
            words = piece.split()
            base, n = n - len(carried), n + len(words)
            words = carried + words
            line = Line(words)
            for table in windows:
                first, last, window = table.occurrences(line, how.lane)
                runs += zip((first + base).tolist(), (last + base).tolist())
                items.update(i for w in set(window.tolist()) for i in table.items[w])
            carried = words[max(0, len(words) - how.width + 1) :]
        counts.append(n)
        if runs:
            a, b = _merged(*np.array(runs, np.int64).T)
            found[d] = list(zip(a.tolist(), b.tolist())), sorted(items)
    return counts, found


def _one_pass(docs: DataFrame, windows: list[Windows], how: Search) -> DataFrame:
    """(doc_id, text hash, n_words, items, spans) of every row, for the windows of one pass."""
    carried = docs.sparkSession.sparkContext.broadcast(windows)
    names = ["doc_id", KEY, "n_words", "items", "spans"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())]))]
        for part in slices(batches):
            counts, found = search(raw_texts(part), carried.value, how)
            none = ([], [])
            hits = [found.get(i, none) for i in range(part.num_rows)]
            spans = [[{"first_word": a, "last_word": b} for a, b in runs] for runs, _ in hits]
            values = [pa.array(v, kind) for v, kind in zip((counts, [items for _, items in hits], spans), kinds)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column(KEY), *values], names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(task, f"doc_id {id_type}, {KEY} long, n_words long, items array<string>, spans array<{SPAN}>")


def _join_spans(spans: Column) -> Column:
    """Sorted spans of several passes as runs."""

    def add(runs: Column, x: Column) -> Column:
        last = F.element_at(runs, -1)
        joins = (F.size(runs) > 0) & (x["first_word"] <= F.try_element_at(runs, F.lit(-1))["last_word"] + 1)
        longer = F.struct(last["first_word"].alias("first_word"), F.greatest(last["last_word"], x["last_word"]).alias("last_word"))
        return F.when(joins, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.expr(f"CAST(array() AS array<{SPAN}>)"), add)


def _merge(passes: list[DataFrame]) -> DataFrame:
    """The rows of several passes: words and copies from the first, hits from all."""
    later = [p.where(F.size("spans") > 0).withColumn("copy", F.lit(0)) for p in passes[1:]]
    every = reduce(DataFrame.unionAll, later, passes[0].withColumn("copy", F.lit(1)))
    whole = every.groupBy("doc_id", KEY).agg(
        F.max("n_words").alias("n_words"),
        F.sum("copy").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.flatten(F.collect_set("spans")).alias("spans"),
    )
    each = whole.withColumn("spans", _join_spans(F.col("spans"))).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*passes[0].columns)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", how: Search = Search()) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spans (runs of hit words), contaminated and the text's hash for every row of ``docs``."""
    named = columns_of(docs, doc_id=id_col, text=text_col).select("doc_id", text_key(), "text")
    items = columns_of(benchmark, item=item_col, text=item_text_col).select(F.col("item").cast("string"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_passes = -(-size // how.pass_bytes) or 1
    share = F.pmod(F.xxhash64("text"), F.lit(n_passes))
    passes = []
    for i in range(n_passes):
        rows = items.where(F.col("text").isNotNull() & (share == i)).collect()  # about pass_bytes of text
        passes.append(_one_pass(named, tables(rows, how), how))
    found = passes[0] if n_passes == 1 else _merge(passes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last_word"] - x["first_word"] + 1)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans", (F.size("spans") > 0).alias("contaminated"), KEY)


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns kept."""
    found = contamination(docs, benchmark, id_col, text_col, **settings)
    return keep_rows(docs, found.select("doc_id", KEY, (~F.col("contaminated")).alias("kept")), id_col, text_col)
