"""Encoding with a public piece vocabulary by batched merges or Viterbi, and decoding.

The vocabulary at hand is a BPE model: its scores are merge ranks. By the rule ``MERGES`` a chunk's
characters are joined pair by pair, the best-ranked pair first and the leftmost of equal ones, which gives
the ids of the public library. The default rule is the unigram search, whose ids are not those of a BPE model:

a text's best segmentation maximises the sum of the piece scores, as the public library does for a
unigram model: of equal sums the longer last piece wins, and a character outside the vocabulary becomes
its UTF-8 bytes. Chunks of equal length advance together: for every end position and piece length
one rolling hash per chunk is looked up among the sorted hashes of the pieces, and the maximum and
its backpointer are kept. Every slice is decoded and compared with its texts; a hash that stood for
two strings would show there, and the slice is then segmented by comparing strings.

Work is one pass over the texts without a shuffle; a slice of bounded size is in memory at a time.

Defined results: NULL and empty texts have no tokens; the mark ``▁`` inside a text decodes to a
blank; ids NULL decode to an empty text, ids outside the vocabulary to nothing; repeated rows are
encoded each; an empty table gives an empty result; further columns of the input are kept
(a column named ``tokens`` or ``decoded`` is replaced).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType

from claimsieve.llm.common import ranges, slices
from claimsieve.llm.pieces import VOCABULARY, Chunks, Pieces, chunks, prepared, read_pieces

FILTER_BITS = 20
UNIGRAM, MERGES = "unigram", "merges"
#: Longer chunks are merged one by one with a heap.
LONGEST_BATCHED = 2048
#: Bytes of text encoded at a time; each takes some 50 bytes of arrays.
ENCODE_BYTES = 512 << 10
MARK_BYTES = "▁".encode()


@lru_cache(maxsize=2)
def _filter(path: str) -> np.ndarray:
    """Which leading bits any piece's hash has; spares most look-ups."""
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(read_pieces(path).hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return seen


def _probe(h: np.ndarray, pieces: Pieces, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, piece ids) of the hashes that are a piece's."""
    rows = np.flatnonzero(seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(pieces.hashes, h[rows]), len(pieces.hashes) - 1)
    hit = pieces.hashes[at] == h[rows]
    return rows[hit], pieces.by_hash[at[hit]]


def _viterbi(c: Chunks, starts: np.ndarray, length: int, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(piece, step) that end best at every position of chunks of one length; piece -1 is an unknown character."""
    pieces, seen = read_pieces(path), _filter(path)
    n = len(starts)
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0.0
    piece = np.full((length + 1, n), -1, np.int32)
    step = np.ones((length + 1, n), np.int32)
    for end in range(1, length + 1):
        for k in range(min(end, pieces.longest), 0, -1):
            rows, ids = _probe(c.hashes(starts + (end - k), starts + end), pieces, seen)
            value = best[end - k][rows] + pieces.scores[ids]
            if k == 1:
                lone = np.ones(n, bool)
                lone[rows] = False
                rows = np.concatenate([rows, np.flatnonzero(lone)])
                ids = np.concatenate([ids, np.full(int(lone.sum()), -1)])
                value = np.concatenate([value, best[end - 1][lone] + pieces.unknown_score])
            better = value > best[end][rows]
            rows, ids = rows[better], ids[better]
            best[end][rows], piece[end][rows], step[end][rows] = value[better], ids, k
    return piece, step


def _follow(piece: np.ndarray, step: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backpointers as (chunk, end, piece), ends falling."""
    at = np.full(piece.shape[1], length)
    alive = np.arange(len(at))
    found = []
    while len(alive):
        ends = at[alive]
        found.append((alive, ends, piece[ends, alive]))
        at[alive] = ends - step[ends, alive]
        alive = alive[at[alive] > 0]
    return tuple(np.concatenate(x) for x in zip(*found))


def _merge(c: Chunks, starts: np.ndarray, length: int, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk, end, piece) of chunks of one length: in every round each chunk joins its best pair."""
    pieces, seen = read_pieces(path), _filter(path)
    n = len(starts)
    after = np.tile(np.arange(1, length + 1), (n, 1))  # where the symbol that starts here ends
    before = np.tile(np.arange(-1, length - 1), (n, 1))
    whole = np.ones((n, length), bool)
    rank = np.full((n, length), -np.inf)  # of the symbol that starts here and the next, joined

    def look(rows: np.ndarray, at: np.ndarray) -> None:
        rank[rows, at] = -np.inf
        inner = after[rows, at] < length
        rows, at = rows[inner], at[inner]
        end = after[rows, after[rows, at]]
        hit, ids = _probe(c.hashes(starts[rows] + at, starts[rows] + end), pieces, seen)
        rank[rows[hit], at[hit]] = pieces.scores[ids]

    look(*(x.ravel() for x in np.indices((n, length))))
    alive = np.arange(n)
    while len(alive):
        best = rank[alive].argmax(axis=1)
        more = np.isfinite(rank[alive, best])
        alive, best = alive[more], best[more]
        gone = after[alive, best]
        end = after[alive, gone]
        after[alive, best] = end
        whole[alive, gone] = False
        rank[alive, gone] = -np.inf
        inner = end < length
        before[alive[inner], end[inner]] = best[inner]
        look(alive, best)
        left = best > 0
        look(alive[left], before[alive[left], best[left]])
    rows, at = np.nonzero(whole)
    end = after[rows, at]
    ids = np.full(len(rows), -1)
    hit, found = _probe(c.hashes(starts[rows] + at, starts[rows] + end), pieces, seen)
    ids[hit] = found
    return rows, end, ids


def _merged_spans(chunk: str, path: str) -> list[tuple[int, int]]:
    """(end, piece) of one chunk by a heap of pairs; piece -1 is an unknown character."""
    scores, ids, n = read_pieces(path).scores, _ids(path), len(chunk)
    after, before, whole = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int]] = []

    def look(at: int) -> None:
        if after[at] < n:
            end = after[after[at]]
            i = ids.get(chunk[at:end])
            if i is not None:
                heapq.heappush(heap, (-scores[i], at, end))

    for at in range(n):
        look(at)
    while heap:
        _, at, end = heapq.heappop(heap)
        if not whole[at] or after[at] >= n or after[after[at]] != end:
            continue
        whole[after[at]] = False
        after[at] = end
        if end < n:
            before[end] = at
        look(at)
        if at:
            look(before[at])
    return [(after[at], ids.get(chunk[at : after[at]], -1)) for at in range(n) if whole[at]]


def plain_merges(chunk: str, path: str = VOCABULARY) -> list[int]:
    """One chunk by merges, comparing strings."""
    byte_ids, out = read_pieces(path).byte_ids, []
    for end, i in _merged_spans(chunk, path):
        out += [i] if i >= 0 else [int(byte_ids[x]) for x in chunk[end - 1].encode("utf-8", "surrogatepass")]
    return out


def _long(c: Chunks, starts: np.ndarray, length: int, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    spans = [_merged_spans("".join(map(chr, c.points[a : a + length].tolist())), path) for a in starts.tolist()]
    owner = np.repeat(np.arange(len(spans)), [len(x) for x in spans])
    flat = np.array([pair for x in spans for pair in x], np.int64).reshape(-1, 2)
    return owner, flat[:, 0], flat[:, 1]


def _segment(c: Chunks, path: str, rule: str = UNIGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all different chunks one after the other, and how many each has."""
    pieces = read_pieces(path)
    n = len(c.starts)
    owner, place, token = [], [], []
    order = np.argsort(c.lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(c.lengths[order])) + 1
    for group in np.split(order, cuts) if n else []:
        length = int(c.lengths[group[0]])
        for part in np.array_split(group, max(1, len(group) * length >> 20)):
            if rule == MERGES:
                chunk, end, ids = (_merge if length <= LONGEST_BATCHED else _long)(c, c.starts[part], length, path)
            else:
                chunk, end, ids = _follow(*_viterbi(c, c.starts[part], length, path), length)
            owner.append(part[chunk])
            place.append(end * 4)
            token.append(ids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, place, token = np.concatenate(owner), np.concatenate(place), np.concatenate(token).astype(np.int64)
    unknown = np.flatnonzero(token < 0)
    if len(unknown):
        chars = c.points[c.starts[owner[unknown]] + place[unknown] // 4 - 1]
        coded = [chr(x).encode("utf-8", "surrogatepass") for x in chars.tolist()]
        many = np.array([len(x) for x in coded])
        extra = np.repeat(unknown, many)
        shift = np.concatenate([np.arange(m) for m in many])
        keep = np.flatnonzero(token >= 0)
        token = np.concatenate([token[keep], pieces.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]])
        place = np.concatenate([place[keep], place[extra] + shift])
        owner = np.concatenate([owner[keep], owner[extra]])
    ordered = np.lexsort((place, owner))
    return token[ordered], np.bincount(owner, minlength=n)


def _segment_by_strings(c: Chunks, path: str, rule: str = UNIGRAM) -> tuple[np.ndarray, np.ndarray]:
    """The same result from comparing strings, piece by piece."""
    plain = plain_merges if rule == MERGES else plain_viterbi
    found = [plain("".join(map(chr, c.points[a : a + n].tolist())), path) for a, n in zip(c.starts, c.lengths)]
    return np.array([i for x in found for i in x], np.int64), np.array([len(x) for x in found], np.int64)


def plain_viterbi(chunk: str, path: str = VOCABULARY) -> list[int]:
    """One chunk, one string comparison at a time: the rule that the batched form has to match."""
    pieces = read_pieces(path)
    ids = _ids(path)
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(chunk) + 1):
        top = (-np.inf, 0, 0)
        for start in range(max(0, end - pieces.longest), end):
            i = ids.get(chunk[start:end])
            if i is None and start < end - 1:
                continue
            value = best[start][0] + (pieces.unknown_score if i is None else pieces.scores[i])
            if value > top[0]:
                top = (value, start, -1 if i is None else i)
        best.append(top)
    out, end = [], len(chunk)
    while end:
        _, start, i = best[end]
        coded = chunk[start:end].encode("utf-8", "surrogatepass")
        out.append([i] if i >= 0 else [int(pieces.byte_ids[x]) for x in coded])
        end = start
    return [i for group in reversed(out) for i in group]


@lru_cache(maxsize=2)
def _ids(path: str) -> dict[str, int]:
    pieces = read_pieces(path)
    return {pieces.names[i]: int(i) for i in pieces.by_hash}


@lru_cache(maxsize=2)
def _piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces, one after the other: flat, starts, lengths. Control pieces have none."""
    pieces = read_pieces(path)
    known = set(pieces.by_hash.tolist())
    coded = [
        name.encode() if i in known else bytes([pieces.byte_of[i]]) if i in pieces.byte_of else b""
        for i, name in enumerate(pieces.names)
    ]
    lengths = np.array([len(x) for x in coded])
    return np.frombuffer(b"".join(coded), np.uint8), np.cumsum(lengths) - lengths, lengths


def joined_bytes(ids: np.ndarray, path: str) -> np.ndarray:
    flat, starts, lengths = _piece_bytes(path)
    return flat[ranges(starts[ids], lengths[ids])]


def encode_texts(texts: list[str], path: str = VOCABULARY, rule: str = UNIGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after the other, and how many each text has."""
    c = chunks(texts)
    whole = np.frombuffer("".join(map(prepared, texts)).encode(), np.uint8)
    for segment in (_segment, _segment_by_strings):
        flat, counts = segment(c, path, rule)
        starts = np.cumsum(counts) - counts
        tokens = flat[ranges(starts[c.which], counts[c.which])]
        if np.array_equal(joined_bytes(tokens, path), whole):
            break
    return tokens, np.bincount(c.text, weights=counts[c.which], minlength=len(texts)).astype(np.int64)


def decode_ids(ids: np.ndarray, counts: np.ndarray, path: str = VOCABULARY) -> list[str]:
    """The texts of token ids; the blank that encoding puts in front is taken off again."""
    _, _, lengths = _piece_bytes(path)
    valid = (ids >= 0) & (ids < len(lengths))
    ids = np.where(valid, ids, 0)  # piece 0 is the unknown piece, which has no bytes
    flat = joined_bytes(ids, path).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
    lines = (flat[a:b].replace(MARK_BYTES, b" ") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
    return [line[line.startswith(b" ") :].decode(errors="replace") for line in lines]


def _kept(docs: DataFrame, *dropped: str) -> list[str]:
    return [c for c in docs.columns if c not in dropped]


def encode(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY, drop_text: bool = False,
           rule: str = UNIGRAM) -> DataFrame:
    """All columns of ``docs`` and ``tokens``, the piece ids of the whole text."""
    keep = _kept(docs, "tokens", *([text_col] if drop_text else []))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, ENCODE_BYTES):
            texts = [t or "" for t in part.column(text_col).to_pylist()]
            ids, counts = encode_texts(texts, path, rule)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], lists], [*keep, "tokens"])

    narrow = docs.select(*_kept(docs, "tokens"))
    schema = narrow.select(*keep).schema.add("tokens", ArrayType(IntegerType()))
    return narrow.mapInArrow(task, schema)


def decode(encoded: DataFrame, path: str = VOCABULARY, drop_tokens: bool = False) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text of its ``tokens``."""
    keep = _kept(encoded, "decoded", *(["tokens"] if drop_tokens else []))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column("tokens")
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pa.array(decode_ids(ids, counts, path), pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], texts], [*keep, "decoded"])

    narrow = encoded.select(*_kept(encoded, "decoded"))
    schema = narrow.select(*keep).schema.add("decoded", StringType())
    return narrow.mapInArrow(task, schema)
