"""Token counts under a unigram vocabulary, with a trie over distinct pre-tokens.

The best segmentation of a string depends on its prefix only through the score reached there, so forward scores are
computed once per trie node, for all pre-tokens that begin with its prefix. The node that ends a pre-token holds its number
of tokens, and a text's count is the sum over its pre-tokens. The trie is built and scored level by level in arrays.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelake.llm.base import fresh, others, process_value, text_bytes

#: Marks the beginning of a pre-token, as in the vocabulary file.
MARK = "▁"
#: A character without a piece costs this much more than the rarest piece, and a token per byte.
UNKNOWN_PENALTY = 10.0
#: Pre-tokens whose counts a worker keeps; beyond it they are counted anew, which changes no count.
KEPT = 300_000
#: Cells (pre-tokens by levels) of one trie; more pre-tokens make several tries.
CELLS = 1_000_000
_CHARACTERS = 21


def zipf_scores(path: str) -> dict[str, float]:
    """The pieces of a vocabulary file with a log probability by rank, ln(1 / (rank + 2.7)) less the log of the sum.

    The file ranks its pieces but has no probabilities; control, unknown and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    vocabulary = SentencePieceProcessor(model_file=path)
    pieces = [
        vocabulary.id_to_piece(i) for i in range(vocabulary.vocab_size())
        if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i) or vocabulary.is_unused(i))
    ]
    total = math.log(sum(1 / (rank + 2.7) for rank in range(len(pieces))))
    return {piece: -math.log(rank + 2.7) - total for rank, piece in enumerate(pieces)}


@dataclass
class Pieces:
    """Pieces read from their last character back: sorted (state, character) keys, next states, and scores of states."""

    keys: np.ndarray
    following: np.ndarray
    score: np.ndarray
    unknown: float

    @classmethod
    def of(cls, scores: dict[str, float]) -> Pieces:
        states: list[dict[int, int]] = [{}]
        score = [math.nan]
        for piece, value in scores.items():
            at = 0
            for character in map(ord, reversed(piece)):
                if character not in states[at]:
                    states[at][character] = len(states)
                    states.append({})
                    score.append(math.nan)
                at = states[at][character]
            score[at] = value
        edges = sorted((state << _CHARACTERS | c, to) for state, out in enumerate(states) for c, to in out.items())
        keys, following = np.array(edges, np.int64).reshape(-1, 2).T
        return cls(keys.copy(), following.copy(), np.array(score), min(scores.values(), default=0.0) - UNKNOWN_PENALTY)

    @cached_property
    def plain(self) -> tuple[dict[int, int], list[float]]:
        """Following states and scores, for one lookup at a time."""
        return dict(zip(self.keys.tolist(), self.following.tolist())), self.score.tolist()

    def step(self, state: np.ndarray, character: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each state goes on a character, and which of them go anywhere."""
        wanted = state << _CHARACTERS | character
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)
        return self.following[at[known]], known


def trie_counts(pre_tokens: list[str], pieces: Pieces) -> np.ndarray:
    """Tokens of each distinct pre-token: the segmentation of highest score, of equal scores that with fewer tokens.

    All prefixes of one length are a level. A level's new nodes get their best score from the levels before, once,
    however many pre-tokens go on from them.
    """
    order = sorted(range(len(pre_tokens)), key=lambda i: -len(pre_tokens[i]))
    lengths = np.array([len(pre_tokens[i]) for i in order], np.int64)
    codes = np.frombuffer("".join(pre_tokens[i] for i in order).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    begin = np.cumsum(lengths) - lengths
    levels = int(lengths[0]) if len(lengths) else 0
    node = np.zeros((len(order), levels + 1), np.int64)
    best, tokens = np.zeros(lengths.sum() + 1), np.zeros(lengths.sum() + 1, np.int64)
    size, counts = 1, np.zeros(len(order), np.int64)
    for level in range(1, levels + 1):
        alive = int(np.searchsorted(-lengths, -level, side="right"))
        character = codes[begin[:alive] + level - 1]
        _, first, own = np.unique(node[:alive, level - 1] << _CHARACTERS | character, return_index=True, return_inverse=True)
        node[:alive, level] = size + own
        new = slice(size, size + len(first))
        size += len(first)
        c = character[first]
        best[new] = best[node[first, level - 1]] + pieces.unknown
        tokens[new] = tokens[node[first, level - 1]] + 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        # Read back from the level's character; a state is left when no piece ends like this.
        open_, state = np.arange(len(first)), np.zeros(len(first), np.int64)
        for back in range(1, level + 1):
            state, known = pieces.step(state, codes[begin[first[open_]] + level - back])
            open_ = open_[known]
            if not len(open_):
                break
            value = pieces.score[state]
            ends = ~np.isnan(value)
            at, before = new.start + open_[ends], node[first[open_[ends]], level - back]
            score, n = best[before] + value[ends], tokens[before] + 1
            better = (score > best[at]) | (score == best[at]) & (n < tokens[at])
            best[at[better]], tokens[at[better]] = score[better], n[better]
        ended = np.flatnonzero(lengths[:alive] == level)
        counts[ended] = tokens[node[ended, level]]
    out = np.zeros(len(order), np.int64)
    out[order] = counts
    return out


def long_count(pre_token: str, pieces: Pieces) -> int:
    """The same count for one very long pre-token, position by position."""
    codes = list(map(ord, pre_token))
    edges, value = pieces.plain
    best, tokens = [0.0], [0]
    for end, c in enumerate(codes, 1):
        score, n = best[-1] + pieces.unknown, tokens[-1] + 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        state = 0
        for start in range(end - 1, -1, -1):
            state = edges.get(state << _CHARACTERS | codes[start])
            if state is None:
                break
            if not math.isnan(value[state]):
                there, m = best[start] + value[state], tokens[start] + 1
                if there > score or there == score and m < n:
                    score, n = there, m
        best.append(score)
        tokens.append(n)
    return tokens[-1]


class TerminalCounts(dict):
    """Token counts of words met so far; new words are counted together, in tries."""

    def add(self, words: set[str], pieces: Pieces) -> None:
        if len(self) + len(words) > KEPT:
            self.clear()
        self.update({w: long_count(MARK + w, pieces) for w in words if len(w) >= 64})
        short = [w for w in words if len(w) < 64]
        at = 0
        while at < len(short):
            longest = max(map(len, short[at : at + CELLS // 65])) + 2
            part = short[at : at + CELLS // longest]
            self.update(zip(part, trie_counts([MARK + w for w in part], pieces).tolist()))
            at += len(part)


def count_tokens(docs: DataFrame, scores: dict[str, float], text: str = "text") -> DataFrame:
    """``docs`` with n_pretokens and n_tokens; a narrow step without a shuffle, every row is kept.

    Pre-tokens are what white space separates, each with the word mark in front. Null and empty texts have none, and no
    tokens. A character without a piece counts as its UTF-8 bytes. Whole texts count, however long. Columns of these
    names are replaced. Workers keep the counts of up to ``KEPT`` pre-tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.of(scores))
    key = f"trie-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = shared.value, process_value(key, TerminalCounts)
        for batch in batches:
            pre_tokens, tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            split = [v.decode("utf-8", "replace").split() if v else [] for v in batch.column(batch.num_columns - 1).to_pylist()]
            at = 0
            while at < len(split):
                end, size = at, 0
                while end < len(split) and (size < 200_000 or end == at):
                    size += len(split[end])
                    end += 1
                words = set().union(*split[at:end])
                missing = words - counts.keys()
                if missing:
                    counts.add(missing if len(counts) + len(missing) <= KEPT else words, pieces)
                for i in range(at, end):
                    pre_tokens[i], tokens[i] = len(split[i]), sum(map(counts.__getitem__, split[i]))
                at = end
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pre_tokens), pa.array(tokens)], names)

    added = T.StructType.fromDDL("n_pretokens long, n_tokens long")
    kept = others(docs, added.names)
    bare = docs.select(*kept, text_bytes(text).alias(fresh(docs, "_bytes")[0]))
    names = [*kept, *added.names]
    return bare.mapInArrow(run, T.StructType(bare.schema.fields[:-1] + added.fields))
