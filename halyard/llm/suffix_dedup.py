"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Which windows of ``length`` bytes also start elsewhere is found exactly:

1. Each text's windows are grouped into segments: runs of window starts that
   share their anchor, the least-hashed k-gram inside the window. Equal windows
   have equal anchors, so only segments whose anchor occurs twice go on.
2. Segments equal as a whole (by a hash of 128 bits) are counted; all their
   windows repeat. One of each kind is left to be compared with the other kinds
   under its anchor.
3. Where an anchor has very many kinds, these are cut again, by the anchor's
   place in the window: windows with it in the farther half of the places have
   the bytes before it in common, those of the nearer half the bytes after it.
   A hash of what the windows of a half must share is their new key, so equal
   windows still meet, and each segment becomes two rows at most. Equal pieces
   are counted as in 2, and crowded keys are cut again; after eight cuts at most
   a piece is one window, all of it in the key.
4. The bytes of what is left go, by key, to tasks that keep a logarithmic family
   of suffix arrays. Of each arriving batch the suffix array is built by prefix
   doubling, as deep as a window is long, and merge-scanned against the existing
   levels: the level's suffixes that share a prefix with a suffix of the batch are
   narrowed down by its next eight bytes, until none is left or the match is as
   long as a window. What is new becomes the lowest level, and levels of about
   equal size are merged at the places that the scan gives, so they grow
   geometrically.

Of a run of one repeated byte, or of a few, the segments that follow each other
are equal; they are one row that tells how many.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, discard, durable, slices, texts

#: Bytes of an anchor's k-gram; bytes hashed at once; kinds under one key before it is cut again.
GRAM, BLOCK, KINDS = 32, 1 << 20, 512
#: Window starts that one task's index family is to hold, about.
TASK_WINDOWS = 1_000_000
POSITION_BITS = 22  # of a place in a block with its overlap
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def byte_table() -> np.ndarray:
    """A 64-bit number for each byte."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)


class Rolling:
    """Hashes of all runs of n bytes of a buffer, from prefix sums modulo 2^64."""

    table = byte_table()
    up = down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            size = max(n, 1 << 16)
            for name, step in (("up", BASE), ("down", inverse)):
                powers = np.full(size, step, np.uint64)
                powers[0] = 1
                setattr(Rolling, name, np.cumprod(powers, dtype=np.uint64))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(Rolling.table[data] * Rolling.down[: n - 1], out=self.sums[1:])

    def all(self, n: int) -> np.ndarray:
        """Of every run of n bytes, by its start."""
        return self.at(slice(0, len(self.sums) - n), slice(n, None))

    def at(self, first, end) -> np.ndarray:
        h = (self.sums[end] - self.sums[first]) * Rolling.up[: len(self.sums)][first]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) for every i, from running minima of blocks of w, forwards and backwards."""
    n = len(x)
    wide = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    wide[:n] = x
    blocks = wide.reshape(-1, w)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - w + 1], forward[w - 1 : n])


def contents(data: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of 128 bits of the runs of data from first to end, as rows of two numbers."""
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    each = b"".join(digest(view[a:b]) for a, b in zip(first.tolist(), end.tolist(), strict=True))
    return np.frombuffer(each, np.int64).reshape(-1, 2)


def block_segments(data: bytes, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie one after another in data.

    bounds: the texts' ends, from 0. Returns each segment's text, first window
    start in it, number of windows, how often it stands there in a row, anchor
    hash and content hash.
    """
    x = np.frombuffer(data, np.uint8)
    empty = np.zeros(0, np.int64)
    if len(x) < length:
        return empty, empty, empty, empty, empty, empty.reshape(0, 2)
    roll = Rolling(x)
    grams = roll.all(GRAM)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    keyed = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(keyed, length - GRAM + 1) & mask).astype(np.int64)
    starts = np.arange(len(x) - length + 1)
    own = np.searchsorted(bounds, starts, side="right") - 1
    inside = starts + length <= bounds[own + 1]
    starts, own, anchor = starts[inside], own[inside], anchor[inside]
    if not len(starts):
        return empty, empty, empty, empty, empty, empty.reshape(0, 2)
    cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])])
    last = np.r_[cut[1:], len(starts)] - 1
    first, count = starts[cut], last - cut + 1
    kind, own = contents(data, first, first + count + length - 1), own[cut]
    again = np.r_[False, (kind[1:] == kind[:-1]).all(axis=1) & (own[1:] == own[:-1]) & (count[1:] == count[:-1]) & (first[1:] == first[:-1] + count[:-1])]
    one = np.flatnonzero(~again)
    times = np.diff(np.r_[one, len(first)])
    return own[one], (first - bounds[own])[one], count[one], times, grams[anchor[cut[one]]].view(np.int64), kind[one]


def blocks(values: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """Pieces of texts put together to about BLOCK bytes: the texts' numbers, the pieces' places in them, data, bounds.

    A text longer than a block is cut so that every window lies whole in one piece.
    """
    who, at, parts, size = [], [], [], 0
    for i, v in enumerate(values):
        for a in range(0, max(1, len(v) - length + 1), BLOCK):
            piece = v[a : a + BLOCK + length - 1]
            if size and size + len(piece) > BLOCK:
                yield who, at, b"".join(parts), np.cumsum([0, *map(len, parts)])
                who, at, parts, size = [], [], [], 0
            who.append(i)
            at.append(a)
            parts.append(piece)
            size += len(piece)
    if parts:
        yield who, at, b"".join(parts), np.cumsum([0, *map(len, parts)])


def text_hash(data: bytes) -> bytes:
    """128 bits of a text: its key where ids are null or repeat."""
    return xxhash.xxh3_128_digest(data)


SEGMENT = "th binary, at int, n int, times int, anchor long, kind long, more long"
#: A kind's name under its anchor.
KIND = ["anchor", "kind", "more"]


def segment_rows(slim: DataFrame, length: int) -> DataFrame:
    """(id, th, at, n, times, anchor, kind, more): the segments of every text, equal ones in a row once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            values = [t.encode() for t in texts(b)]
            hashes = pa.array([text_hash(v) for v in values], pa.binary())
            for who, places, data, bounds in blocks(values, length):
                own, at, n, times, anchor, kind = block_segments(data, bounds, length)
                if len(own):
                    row = np.array(who)[own]
                    cols = [b.column("id").take(pa.array(row)), hashes.take(pa.array(row)), *map(pa.array, ((at + np.array(places)[own]).astype(np.int32), n.astype(np.int32), times.astype(np.int32), anchor, kind[:, 0], kind[:, 1]))]
                    yield pa.RecordBatch.from_arrays(cols, names=["id", "th", "at", "n", "times", *KIND])

    return arrow_task(slim, task, f"id {slim.schema['id'].dataType.simpleString()}, {SEGMENT}")


def packed_texts(slim: DataFrame) -> DataFrame:
    """(id, th, z): texts compressed for their way to the rows that need them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            values = [t.encode() for t in texts(b)]
            cols = [b.column("id"), pa.array([text_hash(v) for v in values], pa.binary()), pa.array([pack.compress(v) for v in values], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "th", "z"])

    return arrow_task(slim, task, f"id {slim.schema['id'].dataType.simpleString()}, th binary, z binary")


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of data as deep as depth bytes, 8 or more, by prefix doubling; and the rank at each place, equal where those bytes are.

    Holds for suffixes of depth bytes or more; shorter ones stand among them
    somewhere. Only suffixes that tie are sorted again.
    """
    n = len(data)
    wide = np.r_[data, np.zeros(8, np.uint8)]
    head = words_at(wide, np.arange(n))
    order = np.argsort(head)
    ranks = np.zeros(n + depth, np.int64)  # from 1; 0 beyond the end
    sorted_head = head[order]
    same = np.r_[False, sorted_head[1:] == sorted_head[:-1]]
    rank = np.maximum.accumulate(np.where(same, 0, np.arange(n)))  # by place in order: the first of its like
    ranks[order] = rank + 1
    reach = 8
    while reach < depth:
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        step = min(reach, depth - reach)
        at = order[tied]
        key = (rank[tied].astype(np.uint64) << np.uint64(32)) | ranks[at + step].astype(np.uint64)
        by = np.argsort(key)
        key, order[tied] = key[by], at[by]
        same[tied] = np.r_[False, key[1:] == key[:-1]]
        rank[tied] = np.maximum.accumulate(np.where(same[tied], 0, tied))
        ranks[order[tied]] = rank[tied] + 1
        reach += step
    return order, ranks[:n]


def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that orders like them."""
    view = np.ndarray(max(0, len(data) - 7), ">u8", data, strides=(1,))
    return view[at].astype(np.uint64)


class Level:
    """A suffix array: window starts in the order of their bytes, no two equal, and their first eight bytes."""

    def __init__(self, where: np.ndarray, head: np.ndarray):
        self.where, self.head = where, head

    def __len__(self) -> int:
        return len(self.where)

    def kept(self, keep: np.ndarray) -> Level:
        return Level(self.where[keep], self.head[keep])

    def merged(self, other: Level, at: np.ndarray) -> Level:
        """With other's suffixes, each before the one of this level at its place."""
        return Level(np.insert(self.where, at, other.where), np.insert(self.head, at, other.head))


class IndexFamily:
    """Suffix arrays of batches of segments, in levels that grow geometrically."""

    def __init__(self, length: int):
        self.length, self.levels = length, []
        self.data = np.zeros(0, np.uint8)  # all bytes
        self.again = np.zeros(0, bool)  # by place in data: a window that also starts elsewhere
        #: Where the words of eight bytes lie that make up a window; the last may overlap the one before.
        self.depths = [*range(0, length - 8, 8), length - 8]

    def add(self, parts: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Index the first counts[i] window starts of each part; returns the parts' places in data."""
        base = len(self.data)
        new = np.frombuffer(b"".join(parts), np.uint8)
        places = base + np.cumsum([0, *map(len, parts)])[:-1]
        self.data = np.concatenate([self.data, new])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        where = np.repeat(places - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        asked = np.zeros(len(new), bool)
        asked[where - base] = True
        order, rank = suffix_order(new, self.length)
        order = order[asked[order]]  # the rest of a part is no window's start
        batch = self._within(order + base, rank[order])
        for level in self.levels:
            at, found = self._scan(batch, level)
            self.again[batch.where[found]] = True
            self.again[level.where[at[found]]] = True
            batch = batch.kept(~found)
        if len(batch):
            self.levels.append(batch)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            top = self.levels.pop()
            self.levels[-1] = self.levels[-1].merged(top, self._scan(top, self.levels[-1])[0])
        return places

    def _within(self, where: np.ndarray, rank: np.ndarray) -> Level:
        """Marks repeats inside a batch's suffix array; keeps one of each."""
        same = np.r_[False, rank[1:] == rank[:-1]]
        self.again[where[same | np.r_[same[1:], False]]] = True
        where = where[~same]
        return Level(where, words_at(self.data, where))

    def _scan(self, batch: Level, level: Level) -> tuple[np.ndarray, np.ndarray]:
        """The place in level before which each suffix of batch belongs, and whether the one there has the same window.

        low to high are the level's suffixes with the bytes compared so far in common.
        """
        low = np.searchsorted(level.head, batch.head, side="left")
        high = np.searchsorted(level.head, batch.head, side="right")
        found = np.zeros(len(batch), bool)
        going = np.flatnonzero(low < high)
        for depth in self.depths[1:]:
            alone = high[going] - low[going] == 1
            self._compare(batch, level, going[alone], low, found)
            going = going[~alone]
            if not len(going):
                break
            want = words_at(self.data, batch.where[going] + depth)
            left = self._bisect(want, low[going], high[going], level, depth, np.less)
            right = self._bisect(want, left, high[going], level, depth, np.less_equal)
            low[going], high[going] = left, right
            going = going[left < right]
        found[going] = True  # compared to the last byte
        return low, found

    def _compare(self, batch: Level, level: Level, rows: np.ndarray, low: np.ndarray, found: np.ndarray) -> None:
        """Settles the rows that only one suffix of the level, that at low, may equal."""
        depths = np.array(self.depths)
        for i in range(0, len(rows), 1 << 14):
            own = rows[i : i + (1 << 14)]
            mine = words_at(self.data, batch.where[own][:, None] + depths)
            its = words_at(self.data, level.where[low[own]][:, None] + depths)
            unlike = mine != its
            first = unlike.argmax(axis=1)
            each = np.arange(len(own))
            found[own] = ~unlike[each, first]
            low[own] += mine[each, first] > its[each, first]

    def _bisect(self, want: np.ndarray, low: np.ndarray, high: np.ndarray, level: Level, depth: int, before) -> np.ndarray:
        """In each range of level, the first place whose word at depth is not before the one wanted."""
        low, high = low.copy(), high.copy()
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            less = before(words_at(self.data, level.where[middle] + depth), want[going])
            low[going[less]] = middle[less] + 1
            high[going[~less]] = middle[~less]
            going = going[low[going] < high[going]]
        return low


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


FOUND = "anchor long, kind long, more long, first int, last int"
SLICE = "anchor long, kind long, more long, n int, data binary"


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """rows: SLICE, all of an anchor in one task. Returns the runs (first, last) of window starts that repeat."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = IndexFamily(length)
        meta: list[np.ndarray] = []
        for b in slices(batches, 4000):
            if b.num_rows:
                n = b.column("n").to_numpy()
                places = family.add(b.column("data").to_pylist(), n)
                meta.append(np.stack([places, n, *(b.column(c).to_numpy() for c in KIND)]))
        if not meta:
            return
        place, n, *kind = np.concatenate(meta, axis=1)
        who, first, last = [], [], []
        for i in range(len(place)):
            for a, z in runs(family.again[place[i] : place[i] + n[i]]):
                who.append(i)
                first.append(a)
                last.append(z)
        yield pa.RecordBatch.from_arrays([*(pa.array(k[who]) for k in kind), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=[*KIND, "first", "last"])

    return arrow_task(rows, task, FOUND)


def cut_again(rows: DataFrame, length: int) -> DataFrame:
    """Pieces of crowded segments: of each, the windows with the anchor in the nearer and in the farther half of its places.

    rows: SLICE with least, most (the places their anchors may have in a window)
    and off (that in the first window; null: to be found). Returns the piece's
    own SLICE, least, most and off, the segment it is from, and which of its
    windows is the piece's first.
    """
    names = [x.split()[0] for x in CUT.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in CUT.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[tuple] = []
            for r in b.to_pylist():
                data, n, off = r["data"], r["n"], r["off"]
                if off is None:
                    grams = Rolling(np.frombuffer(data[:length], np.uint8)).all(GRAM)
                    off = int(np.flatnonzero(grams.view(np.int64) == r["anchor"])[0])
                middle = (r["least"] + r["most"] + 1) // 2
                far = min(n, max(0, off - middle + 1))  # windows before this one have the anchor in the farther half
                for first, end, least, most in ((0, far, middle, r["most"]), (far, n, r["least"], middle - 1)):
                    if first < end:
                        piece = data[first : end + length - 1]
                        shared = data[off - least : off + length - most]
                        key = xxhash.xxh3_64_intdigest(shared, least * length + most) - (1 << 63)
                        kind, more = np.frombuffer(xxhash.xxh3_128_digest(piece), np.int64).tolist()
                        out.append((key, kind, more, end - first, piece, least, most, off - first, r["anchor"], r["kind"], r["more"], first))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return arrow_task(rows, task, CUT)


CUT = SLICE + ", least int, most int, off int, of_anchor long, of_kind long, of_more long, start int"


def _windows_of(sized: DataFrame, length: int) -> tuple[DataFrame, list[str]]:
    """Repeated windows of kinds (SLICE, size: kinds of the anchor) as FOUND, those of pieces told as their segments'; and the paths it reads."""
    spark = sized.sparkSession
    sized = sized.withColumns({"least": F.lit(0), "most": F.lit(length - GRAM), "off": F.lit(None).cast("int")})
    calm, cuts, alike, paths = [], [], [], []
    while True:
        final = (F.col("size") <= KINDS) | (F.col("least") == F.col("most"))
        calm.append(sized.where(final).select(*KIND, "n", "data"))
        crowded = sized.where(~final)
        if crowded.isEmpty():
            break
        pieces, pieces_path = durable(cut_again(crowded.drop("size"), length), "repeats-pieces")
        cuts.append(pieces.select(*KIND, "of_anchor", "of_kind", "of_more", "start"))
        one = [F.first(c).alias(c) for c in ("n", "data", "least", "most", "off")]
        now, now_path = durable(pieces.groupBy(*KIND).agg(F.count("*").alias("copies"), *one), "repeats-alike")
        alike.append(now.where("copies > 1").select(*KIND, F.lit(0).alias("first"), (F.col("n") - 1).alias("last")))
        # written first, so that a crowded anchor's side of the join can be split
        sizes, sizes_path = durable(now.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1"), "repeats-sizes")
        sized, sized_path = durable(now.drop("copies").join(sizes, "anchor"), "repeats-sized")
        paths += [pieces_path, now_path, sizes_path, sized_path]
    sought = reduce(DataFrame.union, calm)
    windows = sought.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(windows / TASK_WINDOWS))
    found, found_path = durable(repeated_windows(sought.repartition(tasks, "anchor"), length), "repeats-found")
    up = found.limit(0)
    for equal, cut in zip(reversed(alike), reversed(cuts), strict=True):
        here = found.union(equal).union(up).join(cut, KIND)
        up = here.select(F.col("of_anchor").alias("anchor"), F.col("of_kind").alias("kind"), F.col("of_more").alias("more"), F.col("start") + F.col("first"), F.col("start") + F.col("last"))
    return found.union(up), [*paths, found_path]


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, spans array<struct<first,end>>, kept binary.

    spans: the maximal runs of bytes, end excluded, covered by a string of
    length bytes that also starts anywhere else in the table, the same text
    included; kept: the other bytes. Texts are UTF-8, null as empty; those
    shorter than length have no spans. A repeated row is a copy like any other,
    and gives a repeated row. A null id stays null. Other columns are ignored.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    segments, segments_path = durable(segment_rows(slim, length), "repeats-segments")
    shared, shared_path = durable(segments.groupBy("anchor").agg(F.sum("times").alias("count")).where("count > 1").select("anchor"), "repeats-anchors")
    met, met_path = durable(segments.join(shared, "anchor", "left_semi"), "repeats-met")
    discard(spark, segments_path)
    kinds, kinds_path = durable(met.groupBy(*KIND).agg(F.sum("times").alias("copies"), F.min(F.struct("id", "th", "at", "n")).alias("one")), "repeats-kinds")
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    many, many_path = durable(many, "repeats-many")
    sought = kinds.join(many, "anchor").select("one.*", F.struct(*KIND, "kinds", "one.at", "one.n").alias("s"))
    by_text = sought.groupBy("id", "th").agg(F.collect_list("s").alias("sought"))
    cut, cut_path = durable(_slices(_with_text(slim, by_text, "inner"), length), "repeats-slices")
    found, found_paths = _windows_of(cut, length)
    whole = kinds.where("copies > 1").select(*KIND, F.lit(0).alias("first"), (F.col("one.n") - 1).alias("last"))
    decided, decided_path = durable(found.union(whole).groupBy(*KIND).agg(F.collect_list(F.struct("first", "last")).alias("runs")), "repeats-decided")
    discard(spark, cut_path, shared_path, *found_paths)
    placed = met.join(decided, KIND).select("id", "th", F.transform("runs", lambda r: F.struct((F.col("at") + r["first"]).alias("first"), (F.col("at") + r["last"] + (F.col("times") - 1) * F.col("n")).alias("last"))).alias("runs"))
    per_text, _ = durable(placed.groupBy("id", "th").agg(F.flatten(F.collect_list("runs")).alias("runs")), "repeats-runs")
    discard(spark, met_path, kinds_path, many_path, decided_path)
    return _removed(_with_text(slim, per_text, "left"), length).withColumnRenamed("id", id_col)


def _with_text(slim: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    z, w = packed_texts(slim), wanted.withColumnsRenamed({"id": "w_id", "th": "w_th"})
    return z.join(w, z["id"].eqNullSafe(w["w_id"]) & (z["th"] == w["w_th"]), how).drop("w_id", "w_th", "th")


def _slices(rows: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments sought in each text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in slices(batches):
            out: list[tuple] = []
            for z, sought in zip(b.column("z"), b.column("sought").to_pylist(), strict=True):
                data = unpack.decompress(z.as_py())
                out += [(s["anchor"], s["kind"], s["more"], s["kinds"], s["n"], data[s["at"] : s["at"] + s["n"] + length - 1]) for s in sought]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[*KIND, "size", "n", "data"])

    return arrow_task(rows, task, "anchor long, kind long, more long, size long, n int, data binary")


def _removed(rows: DataFrame, length: int) -> DataFrame:
    """Spans and kept bytes of each text, from its repeated window starts."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in slices(batches):
            sizes, spans, kept = [], [], []
            for z, found in zip(b.column("z"), b.column("runs").to_pylist(), strict=True):
                data = unpack.decompress(z.as_py())
                merged: list[list[int]] = []
                for r in sorted((r["first"], r["last"] + length) for r in found or ()):
                    if merged and r[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r[1])
                    else:
                        merged.append(list(r))
                sizes.append(len(data))
                spans.append([{"first": a, "end": e} for a, e in merged])
                kept.append(b"".join(data[a:e] for a, e in zip([0, *(m[1] for m in merged)], [*(m[0] for m in merged), len(data)], strict=True)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return arrow_task(rows, task, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, spans array<struct<first:long,end:long>>, kept binary")
