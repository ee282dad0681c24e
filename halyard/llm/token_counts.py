"""Token counts of whole texts by rank-synchronous array merging.

Texts are cut into pre-tokens at places no vocabulary piece crosses. The
distinct pre-tokens of a batch are held together as ragged numpy arrays
(symbol ids beside the index of the pre-token that owns them). Every round
finds the lowest-rank adjacent pair of each pre-token and merges all its
places at once; pre-tokens without a pair left leave the arrays. What
survives is counted: one for a piece, the UTF-8 length for a character that
falls back to bytes.

A very long pre-token would pass through the arrays once for every rank it has.
Its places are kept by rank instead, in arrays linked to their neighbours: each
round takes the lowest rank's places alone and merges them all at once.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from halyard.llm.common import per_batch, texts, with_columns

#: Distinct pre-tokens a worker remembers before it starts over, and that are merged together.
CACHE_WORDS, MERGE_WORDS = 300_000, 50_000
SPACE = "▁"
#: Characters of a pre-token that is merged by itself.
LONG_WORD = 2_000


class PieceTable:
    """Pieces, pair ranks and character ids of a piece-BPE vocabulary with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            (model.get_score(i), i, model.id_to_piece(i))
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        ]
        pieces.sort(key=lambda p: (-p[0], p[1]))
        self.rank = {p: r for r, (_, _, p) in enumerate(pieces)}  # a piece's id here is its rank
        n = len(pieces)
        pairs = {}
        for word, r in self.rank.items():
            for cut in range(1, len(word)):
                a, b = self.rank.get(word[:cut]), self.rank.get(word[cut:])
                if a is not None and b is not None:
                    pairs[a * n + b] = r
        self.n = n
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys], np.int64)
        # a line break inside no piece separates pre-tokens, as a space after another character does
        apart = "\n" if not any("\n" in p for p in self.rank) else ""
        assert not any(SPACE in p.lstrip(SPACE) for p in self.rank), "a piece crosses a space"
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|{apart}" if apart else ""))

    def pre_tokens(self, text: str) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of pairs of symbols; n where they are no pair."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_keys[at] == key), self.pair_ranks[at], self.n)

    def count_long(self, word: str) -> int:
        """Tokens of one word, by rounds over the places of the lowest rank."""
        chars, back = np.unique(np.frombuffer(word.encode("utf-32-le"), np.uint32), return_inverse=True)
        sym = np.array([self.rank.get(chr(c), -len(chr(c).encode())) for c in chars.tolist()], np.int64)[back]
        size = len(sym)
        after, before, there = np.arange(1, size + 1), np.arange(-1, size - 1), np.ones(size + 1, bool)  # place size: none
        there[size] = False
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def ranked(at: np.ndarray) -> np.ndarray:
            at_end = after[at] == size
            return np.where(at_end, self.n, self.ranks(sym[at], sym[np.where(at_end, at, after[at])]))

        def wait(at: np.ndarray) -> None:
            rank = ranked(at)
            at, rank = at[rank < self.n], rank[rank < self.n]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            first = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            for a, b, r in zip(first.tolist(), [*first[1:].tolist(), len(at)], rank[first].tolist(), strict=True):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(at[a:b])

        wait(np.arange(size))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[there[at]]
            at = at[ranked(at) == r]
            if not len(at):
                continue
            # overlapping places of one pair (aaa): every second of a run, from its left end
            joined = np.r_[False, after[at[:-1]] == at[1:]]
            index = np.arange(len(at))
            left = at[(index - np.maximum.accumulate(np.where(joined, 0, index))) % 2 == 0]
            right = after[left]
            beyond = after[right]
            sym[left], there[right], after[left] = r, False, beyond
            inner = beyond < size
            before[beyond[inner]] = left[inner]
            wait(np.unique(np.concatenate([left, before[left][before[left] >= 0]])))
        rest = sym[there[:size]]
        return int(np.where(rest >= 0, 1, -rest).sum())

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        long = np.array([len(w) > LONG_WORD for w in words], bool)
        if long.any():
            out = np.zeros(len(words), np.int64)
            out[long] = [self.count_long(w) for w in words if len(w) > LONG_WORD]
            out[~long] = self.counts([w for w in words if len(w) <= LONG_WORD])
            return out
        sizes = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        distinct, back = np.unique(chars, return_inverse=True)
        #: a character without a piece is minus its UTF-8 length
        ids = np.array([self.rank.get(chr(c), -len(chr(c).encode())) for c in distinct.tolist()], np.int64)
        sym = ids[back] if len(distinct) else np.zeros(0, np.int64)
        own = np.repeat(np.arange(len(words)), sizes)
        out = np.zeros(len(words), np.int64)
        none = self.n
        while len(sym):
            rank = np.full(len(sym), none, np.int64)
            near = np.flatnonzero((own[:-1] == own[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0))
            key = sym[near] * self.n + sym[near + 1]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == key
            rank[near[hit]] = self.pair_ranks[at[hit]]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(sym)])
            ended = np.repeat(least == none, lengths)
            if ended.any():
                np.add.at(out, own[ended], np.where(sym[ended] >= 0, 1, -sym[ended]))
            chosen = (rank == np.repeat(least, lengths)) & (rank < none)
            # overlapping places of one pair (aaa): every second of a run, from its left end
            index = np.arange(len(sym))
            run_start = chosen & ~np.r_[False, chosen[:-1]]
            first = np.maximum.accumulate(np.where(run_start, index, 0))
            chosen &= (index - first) % 2 == 0
            sym = np.where(chosen, rank, sym)
            keep = ~ended & ~np.r_[False, chosen[:-1]]
            sym, own = sym[keep], own[keep]
        return out


@lru_cache(maxsize=4)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


class Counter:
    """Counts texts, remembering the pre-tokens it has seen."""

    def __init__(self, path: str):
        self.table, self.known = piece_table(path), {}

    def __call__(self, text_list: list[str]) -> list[int]:
        cut = [self.table.pre_tokens(t) for t in text_list]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list({w for words in cut for w in words if w not in self.known})
        for i in range(0, len(new), MERGE_WORDS):
            part = new[i : i + MERGE_WORDS]
            self.known.update(zip(part, self.table.counts(part).tolist(), strict=True))
        known = self.known
        return [sum(map(known.__getitem__, words)) for words in cut]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit.

    vocabulary: path of a sentencepiece BPE model, the same on every node.
    Null and empty texts count as 0 tokens and 0 bytes; whole texts of any
    length are counted; repeated rows give repeated rows; a null id stays
    null; an empty table gives no rows; other columns are ignored, whatever
    their names.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def make():
        count = counter(vocabulary)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = texts(batch)
            n = np.concatenate([np.zeros(0, np.int64)] + [np.array(count(values[i : i + 500]), np.int64) for i in range(0, len(values), 500)])
            size = pa.array([len(v.encode()) for v in values], pa.int64())
            return with_columns(batch, ["id"], n_bytes=size, n_tokens=pa.array(n), over_limit=pa.array(n > limit))

        return one

    kind = slim.schema["id"].dataType.simpleString()
    out = per_batch(slim, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", make)
    return out.withColumnRenamed("id", id_col)
