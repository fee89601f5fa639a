"""Token counts by dynamic programming over a trie of pre-tokens.

The different pre-tokens of a slice (chunks that start at a blank) form a trie. A unigram forward score,
the best sum of piece scores up to a node, depends only on the path to the node, so it is computed
once for all pre-tokens that share the prefix. Level by level all nodes of a depth advance together:
each node inherits from its parent the pieces still being spelled, as states of a trie of the
vocabulary, and the pieces that end in the node compete for its score. The number of tokens on the
best path is kept beside the score; where a pre-token ends it is stored, and texts sum over theirs.

A transition of the vocabulary's trie is found by its state and character, without hashing strings.
Work is one pass without a shuffle; a slice of bounded size is in memory at a time.

Defined results: NULL and empty texts have no tokens; a character outside the vocabulary counts its
UTF-8 bytes, as its byte fallback does; of equal scores the longer last piece wins; repeated rows
are counted each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimsieve.llm.common import columns_of, ranges, slices
from claimsieve.llm.pieces import VOCABULARY, Chunks, chunks, code_points, read_pieces
from claimsieve.llm.sentence_pieces import MERGES, UNIGRAM, encode_texts

CHAR_BITS = 21


@dataclass(frozen=True)
class Automaton:
    """The vocabulary as a trie: sorted (state, character) keys, the state each leads to, the score a state ends with."""

    keys: np.ndarray
    to: np.ndarray
    score: np.ndarray  # -inf where no piece ends
    unknown_score: float

    def follow(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next state, or -1."""
        wanted = (state << CHAR_BITS) | char
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], -1)


@lru_cache(maxsize=2)
def automaton(path: str = VOCABULARY) -> Automaton:
    pieces = read_pieces(path)
    next_of: dict[int, int] = {}
    ends: dict[int, float] = {}
    for i in pieces.by_hash.tolist():
        state = 0
        for char in code_points(pieces.names[i]).tolist():
            state = next_of.setdefault((state << CHAR_BITS) | char, len(next_of) + 1)
        ends[state] = pieces.scores[i]
    keys = np.array(sorted(next_of), np.int64)
    score = np.full(len(next_of) + 1, -np.inf)
    score[list(ends)] = list(ends.values())
    return Automaton(keys, np.array([next_of[k] for k in keys.tolist()], np.int64), score, pieces.unknown_score)


def _utf8_length(char: np.ndarray) -> np.ndarray:
    return 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)


def terminal_counts(c: Chunks, path: str = VOCABULARY) -> np.ndarray:
    """Tokens of every different pre-token."""
    a = automaton(path)
    out = np.zeros(len(c.starts), np.int64)
    alive = np.flatnonzero(c.lengths > 0)
    node = np.zeros(len(alive), np.int64)  # trie node of each pre-token, numbered within its level
    # Spellings in progress, sorted by the node they have reached: state, and score and tokens at their start.
    owner, state = np.zeros(0, np.int64), np.zeros(0, np.int64)
    from_score, from_count = np.zeros(0), np.zeros(0, np.int64)
    score, count = np.zeros(1), np.zeros(1, np.int64)
    depth = 0
    while len(alive):
        char = c.points[c.starts[alive] + depth].astype(np.int64)
        keys, child = np.unique((node << CHAR_BITS) | char, return_inverse=True)
        parent, char = keys >> CHAR_BITS, keys & ((1 << CHAR_BITS) - 1)
        n = len(keys)

        # A child takes over its parent's spellings and starts one of its own, the shortest, last.
        sizes = np.bincount(owner, minlength=len(score))
        first = np.cumsum(sizes) - sizes
        taken = ranges(first[parent], sizes[parent])
        heir = np.concatenate([np.repeat(np.arange(n), sizes[parent]), np.arange(n)])
        state = np.concatenate([state[taken], np.zeros(n, np.int64)])
        from_score = np.concatenate([from_score[taken], score[parent]])
        from_count = np.concatenate([from_count[taken], count[parent]])
        fresh = np.concatenate([np.zeros(len(taken), bool), np.ones(n, bool)])
        state = a.follow(state, char[heir])
        lone = np.flatnonzero(fresh & ((state < 0) | ~np.isfinite(a.score[state])))  # no piece of this one character

        live = np.flatnonzero(state >= 0)
        live = live[np.argsort(heir[live], kind="stable")]
        owner, state, from_score, from_count = heir[live], state[live], from_score[live], from_count[live]
        ends = np.flatnonzero(np.isfinite(a.score[state]))
        to = np.concatenate([owner[ends], heir[lone]])
        value = np.concatenate([from_score[ends] + a.score[state[ends]], score[parent][heir[lone]] + a.unknown_score])
        tokens = np.concatenate([from_count[ends] + 1, count[parent][heir[lone]] + _utf8_length(char[heir[lone]])])
        order = np.lexsort((np.arange(len(to)), -value, to))
        best = order[np.unique(to[order], return_index=True)[1]]
        score, count = value[best], tokens[best]

        depth += 1
        done = c.lengths[alive] == depth
        out[alive[done]] = count[child[done]]
        alive, node = alive[~done], child[~done]
    return out


def count_tokens(texts: list[str], path: str = VOCABULARY, rule: str = UNIGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(pre-tokens, tokens) of every text; merge ranks have no forward score, so by ``MERGES`` chunks are encoded."""
    c = chunks(texts)
    n_chunks = np.bincount(c.text, minlength=len(texts))
    if rule == MERGES:
        return n_chunks, encode_texts(texts, path, rule)[1]
    own = terminal_counts(c, path)
    return n_chunks, np.bincount(c.text, weights=own[c.which], minlength=len(texts)).astype(np.int64)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                 rule: str = UNIGRAM) -> DataFrame:
    """doc_id, n_chars, n_pretokens, n_tokens for every row of ``docs``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            pre, tokens = count_tokens(texts, path, rule)
            chars = np.fromiter(map(len, texts), np.int64, len(texts))
            columns = [part.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in (chars, pre, tokens)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "n_pretokens", "n_tokens"])

    named = columns_of(docs, doc_id=id_col, text=text_col)
    return named.mapInArrow(task, "doc_id long, n_chars long, n_pretokens long, n_tokens long")
