"""A public piece vocabulary as arrays: sorted hashes of its pieces, and a trie of them.

Texts are prepared as the vocabulary asks: blanks become ``▁`` and one is put in front. A text is cut in front of
every ``▁`` that follows another character. No piece reaches over such a cut (checked when the
vocabulary is read), so the best segmentation of a text is that of its chunks, one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece

from claimsieve.llm.common import ranges

MARK = 0x2581
#: What a character outside the vocabulary costs beyond the worst piece, as in the public library.
UNKNOWN_PENALTY = 10.0
#: Odd factor of the rolling hash, whose inverse modulo 2^64 exists.
FACTOR = 0x9E3779B97F4A7C15 | 1
SPREAD = np.uint64(0xD6E8FEB86659FD93)

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Pieces:
    names: list[str]
    scores: np.ndarray
    #: Piece ids and lengths in the order of their hashes.
    hashes: np.ndarray
    by_hash: np.ndarray
    longest: int
    unknown_score: float
    byte_ids: np.ndarray  # of the bytes 0 to 255
    byte_of: dict[int, int]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR^0..n and its inverses, modulo 2^64."""
    inverse = pow(FACTOR, -1, 1 << 64)
    up, down = np.full(n + 1, FACTOR, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def spread(points: np.ndarray) -> np.ndarray:
    """Code points as 64-bit values that do not lie close together."""
    x = (points.astype(np.uint64) + np.uint64(1)) * SPREAD
    return x ^ (x >> np.uint64(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hash_of(points: np.ndarray) -> int:
    up, _ = powers(len(points))
    return int((spread(points) * up[: len(points)]).sum(dtype=np.uint64))


@lru_cache(maxsize=2)
def read_pieces(path: str = VOCABULARY) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    scores = np.array([model.get_score(i) for i in range(size)])
    special = np.array([model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(size)])
    normal = [i for i in range(size) if not special[i] and names[i]]
    if any("▁" in names[i].lstrip("▁") for i in normal):
        raise ValueError("a piece reaches over the start of a word")
    points = {i: code_points(names[i]) for i in normal}
    hashes = np.array([hash_of(points[i]) for i in normal], np.uint64)
    if len(np.unique(hashes)) != len(normal):
        raise ValueError("two pieces have one hash")
    order = np.argsort(hashes)
    byte_of = {i: int(names[i][3:5], 16) for i in range(size) if model.is_byte(i)}
    if len(byte_of) != 256:
        raise ValueError("the vocabulary has no byte fallback")
    byte_ids = np.zeros(256, np.int64)
    for i, value in byte_of.items():
        byte_ids[value] = i
    return Pieces(
        names, scores, hashes[order], np.array(normal, np.int64)[order], max(map(len, points.values())),
        float(scores[normal].min()) - UNKNOWN_PENALTY, byte_ids, byte_of,
    )


def prepared(text: str) -> str:
    """Blanks as marks, with one in front; the empty text stays empty."""
    return "▁" + text.replace(" ", "▁") if text else ""


def chunk_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where chunks begin in joined prepared texts: at each text, and at each mark after another character."""
    mark = points == MARK
    begins = np.zeros(len(points), bool)
    begins[1:] = mark[1:] & ~mark[:-1]
    begins[text_starts[text_starts < len(points)]] = True
    return np.flatnonzero(begins)


@dataclass(frozen=True)
class Chunks:
    """The chunks of a few texts, equal ones once."""

    points: np.ndarray
    #: Start and length of each different chunk's first occurrence in ``points``.
    starts: np.ndarray
    lengths: np.ndarray
    #: For every chunk in turn: which of the different ones it is, and its text.
    which: np.ndarray
    text: np.ndarray
    #: Rolling sums: the hash of points[a:b] is (sums[b] - sums[a]) * down[a].
    sums: np.ndarray
    down: np.ndarray

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def chunks(texts: list[str]) -> Chunks:
    """Prepare texts and cut them. Equal chunks are found by hash and then compared, character by character."""
    lines = [prepared(t) for t in texts]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    points = code_points("".join(lines))
    begins = np.cumsum(sizes) - sizes
    starts = chunk_starts(points, begins[sizes > 0])
    lengths = np.diff(np.append(starts, len(points)))
    up, down = powers(len(points))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread(points) * up[:-1], dtype=np.uint64)])
    text = np.repeat(np.arange(len(lines)), np.diff(np.searchsorted(starts, np.append(begins, len(points)))))
    keys = (sums[starts + lengths] - sums[starts]) * down[starts]
    first, which = np.unique(keys, return_index=True, return_inverse=True)[1:]
    same = np.array_equal(lengths, lengths[first][which]) and np.array_equal(
        points, points[ranges(starts[first][which], lengths)]
    )
    if not same:
        whole = "".join(lines)
        ids: dict[str, int] = {}
        which = np.array([ids.setdefault(whole[a : a + n], len(ids)) for a, n in zip(starts, lengths)])
        first = np.unique(which, return_index=True)[1]
    return Chunks(points, starts[first], lengths[first], which, text, sums, down)
