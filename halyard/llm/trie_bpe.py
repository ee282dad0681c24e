"""BPE encoding and decoding by traversal of a trie of distinct words.

The last token of a prefix's encoding is the one suffix of it that is
compatible with the last token of what stands before that suffix. So a walk
down a trie of words, depth first, finds each prefix's last token from those
above it, once for all words that share the prefix; a word's encoding is read
back from the end of its branch, token by token.

The trie is held as its words in order: what a word shares with the one before
it is the part of the branch that stays. At each step the tokens that end
there are those of a state of the vocabulary's automaton, which moves on with
each byte.

Two tokens are compatible if merging never joins across their seam: undoing
their merges from the latest to the earliest, no pair at the seam may have a
rank below that of the merge undone last (on equal ranks the left place
merges first).
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from halyard.llm.common import Remembered, per_batch, texts, with_columns

#: Seams of two tokens that a worker remembers before it starts over; bytes of words it remembers, about.
CACHE_SEAMS, CACHE_BYTES = 400_000, 32 << 20
#: White space of Unicode, as the vocabulary's normaliser sees it.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NEVER = 1 << 60


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in shown)}
    return [chr(hidden.get(b, b)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and seams of a byte-level BPE vocabulary with a word-end mark, and its automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end, ids = model["end_of_word_suffix"], model["vocab"]
        self.bytes = byte_characters()
        self.token = {i: t for t, i in ids.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.many = max(self.token) + 1
        #: rank of each pair; rank and parts of what each merge makes
        self.pair_rank: dict[int, int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, z = ids[a], ids[b], ids[a + b]
            self.pair_rank.setdefault(x * self.many + y, r)
            self.made.setdefault(z, (r, x, y))
        self.seams: dict[int, bool] = {}
        sound = dict.fromkeys(set(ids.values()) - self.made.keys(), True)
        for t, (r, a, b) in self.made.items():  # in order of rank: parts come before what they make
            sound[t] = sound.get(a, False) and sound.get(b, False) and self._seam(a, b, r)
        back = {c: b for b, c in enumerate(self.bytes)}
        whole = {t: i for t, i in ids.items() if sound[i]}
        spelt = lambda t: bytes(back[c] for c in t)
        self.inner = {spelt(t): i for t, i in whole.items() if not t.endswith(end) and all(c in back for c in t)}
        self.final = {spelt(t.removesuffix(end)): i for t, i in whole.items() if t.endswith(end)}
        self.size = {i: len(t) for t, i in (*self.inner.items(), *self.final.items())}
        self._automaton()

    def _automaton(self) -> None:
        """States are what tokens begin with. Of each: the tokens that end there, longest first, inner and final."""
        child: list[dict[int, int]] = [{}]
        own: dict[int, list] = {}
        for kind, tokens in enumerate((self.inner, self.final)):
            for t, i in tokens.items():
                v = 0
                for b in t:
                    if b not in child[v]:
                        child.append({})
                        child[v][b] = len(child) - 1
                    v = child[v][b]
                own.setdefault(v, [None, None])[kind] = (len(t), i)
        self.child, self.fail, self.steps = child, [0] * len(child), {}
        self.inner_ends: list[tuple] = [()] * len(child)
        self.final_ends: list[tuple] = [()] * len(child)
        queue = deque([0])
        while queue:
            v = queue.popleft()
            for b, u in child[v].items():
                if v:
                    w = self.fail[v]
                    while w and b not in child[w]:
                        w = self.fail[w]
                    self.fail[u] = child[w].get(b, 0)
                for ends, x in zip((self.inner_ends, self.final_ends), own.get(u, (None, None)), strict=True):
                    shorter = ends[self.fail[u]]
                    ends[u] = (x, *shorter) if x else shorter
                queue.append(u)

    def _seam(self, a: int, b: int, limit: int) -> bool:
        made, rank, many = self.made, self.pair_rank, self.many
        while True:
            if rank.get(a * many + b, NEVER) < limit:
                return False
            (ra, _, right), (rb, left, _) = made.get(a, (-1, 0, 0)), made.get(b, (-1, 0, 0))
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, right
            else:
                limit, b = rb + 1, left

    def _fits(self, key: int) -> bool:
        """Whether a token and one after it are compatible, remembered."""
        if len(self.seams) > CACHE_SEAMS:
            self.seams.clear()
        fits = self.seams[key] = self._seam(*divmod(key, self.many), NEVER)
        return fits

    def _step(self, v: int, b: int) -> int:
        """The state after one more byte, remembered."""
        u = v
        while u and b not in self.child[u]:
            u = self.fail[u]
        u = self.steps[v << 8 | b] = self.child[u].get(b, 0)
        return u

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of the distinct, sorted words as 32-bit numbers: a depth-first walk of their trie."""
        steps, inner, final, size, seams, many = self.steps, self.inner_ends, self.final_ends, self.size, self.seams, self.many
        out: list[bytes] = []
        #: of the branch, by length of prefix: state, and last token of its encoding as the beginning of a longer word
        states, lasts, above = [0], [0], b""
        for w in words:
            n, same = len(w), 0
            most = min(n, len(lasts)) - 1
            if w[:most] == above[:most]:
                same = most
            else:
                while w[same] == above[same]:
                    same += 1
            del states[same + 1 :], lasts[same + 1 :]
            v = states[same]
            for at in range(same + 1, n):
                b = w[at - 1]
                u = steps.get(v << 8 | b)
                v = self._step(v, b) if u is None else u
                states.append(v)
                # of the tokens that end here, longest first, the one that is compatible with what stands before it
                for k, t in inner[v]:
                    if k == at:
                        break
                    key = lasts[at - k] * many + t
                    fits = seams.get(key)
                    if fits or (fits is None and self._fits(key)):
                        break
                lasts.append(t)
            b = w[-1]
            u = steps.get(v << 8 | b)
            for k, t in final[self._step(v, b) if u is None else u]:
                if k == n:
                    break
                key = lasts[n - k] * many + t
                fits = seams.get(key)
                if fits or (fits is None and self._fits(key)):
                    break
            ids, at = [t], n - k
            while at:
                t = lasts[at]
                ids.append(t)
                at -= size[t]
            ids.reverse()
            out.append(array("i", ids).tobytes())
            above = w
        return out


# the letters' and digits' classes of re differ from Unicode's in numbers that are no decimal digits
ASCII_WORDS = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9a-z]+", re.ASCII)
PLAIN_WORDS = re.compile(rf"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^{BLANK}\w]+|_+)+")
ALL_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")


class Words:
    """Lower-case, composed words of a text, as the vocabulary's normaliser and pre-tokeniser give them."""

    def __init__(self, path: str, byte_chars: list[str]):
        self.path, self.back, self.settled, self.numbers = path, {c: b for b, c in enumerate(byte_chars)}, set(), set()
        self.library = None

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        chars = set(text)
        new = chars - self.settled
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self.settled |= new - odd
        self.numbers |= {c for c in new if unicodedata.category(c) in ("Nl", "No")}
        if odd:
            return self.by_library(text)
        # a capital sigma is lower-cased without regard to its place in the word
        plain = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return (PLAIN_WORDS if chars.isdisjoint(self.numbers) else ALL_WORDS).findall(plain)

    def by_library(self, text: str) -> list[str]:
        """Characters that Unicode versions class differently: the tokenizer library's own rules decide."""
        from tokenizers import Tokenizer

        self.library = t = self.library or Tokenizer.from_file(self.path)
        cut = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return [bytes(self.back[c] for c in w).decode() for w, _ in cut]


class Codec:
    def __init__(self, path: str):
        self.v = v = Vocabulary(path)
        self.words = Words(path, v.bytes)
        self.known = Remembered(CACHE_BYTES)
        #: special tokens as they stand in a list of words
        self.special = {t: np.array([i], np.int32).tobytes() for t, i in v.special.items()}
        self.tokens = pa.array([v.token.get(i, "") for i in range(v.many)], pa.string())

    def cut(self, text: str) -> list[str]:
        if "<|" not in text:
            return self.words(text)
        row: list[str] = []
        for part in self.v.cut_special.split(text):
            row.extend([part] if part in self.special else self.words(part))
        return row

    def flat(self, text_list: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of each."""
        rows = [self.cut(t) for t in text_list]
        found, new = self.known.find(set().union(*rows))
        fresh = sorted((w.encode(), w) for w in new if w not in self.special)
        coded = dict(zip([w for _, w in fresh], self.v.encode_words([b for b, _ in fresh]), strict=True))
        self.known.add(coded)
        found.update(coded)
        found.update(self.special)
        joined = [b"".join(map(found.__getitem__, row)) for row in rows]
        return np.frombuffer(b"".join(joined), np.int32), np.fromiter((len(j) // 4 for j in joined), np.int64, len(joined))

    def spelt(self, ids: pa.ListArray) -> pa.Array:
        """Tokens joined by spaces: the vocabulary names no decoder, and special tokens stay."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")

    def encode(self, text_list: list[str]) -> list[list[int]]:
        ids, sizes = self.flat(text_list)
        return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if text_list else []

    def decode(self, id_lists: list[list[int]]) -> list[str]:
        return self.spelt(pa.array(id_lists, pa.list_(pa.int32()))).to_pylist()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", batch: int = 1000) -> DataFrame:
    """One row per row of docs: id, ids array<int>, decoded string.

    vocabulary: path of a byte-level BPE vocabulary with a word-end mark, the
    same on every node. No special tokens are added; those that stand in a text
    are taken as themselves. Null and empty texts, and texts of white space
    only, give no ids and an empty decoded text. Words of any length take memory
    in proportion. An empty table gives no rows. Repeated rows give repeated
    rows; null ids stay null; other columns are ignored, whatever their names.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def make():
        c = codec(vocabulary)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            flat, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            values = texts(b)
            for i in range(0, len(values), batch):
                ids, n = c.flat(values[i : i + batch])
                flat.append(ids)
                sizes.append(n)
            offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))
            return with_columns(b, ["id"], ids=lists, decoded=c.spelt(lists))

        return one

    kind = slim.schema["id"].dataType.simpleString()
    return per_batch(slim, f"id {kind}, ids array<int>, decoded string", make).withColumnRenamed("id", id_col)
