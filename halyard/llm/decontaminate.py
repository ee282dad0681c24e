"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents long, so what counts is the share of an item's
shingles that a document contains. Items are partitioned by their number of
shingles; each partition has its own sketch size, one more than the shingles an
item of its largest size may miss. An item's sketch is that many of its least
shingle hashes: a document that contains enough of the item must hold some of
them, so no partition loses a pair. Documents are probed with the sketches;
pairs with enough hits for their partition are verified by exact containment
of the shingles themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, discard, durable, per_batch, slices, texts
from halyard.llm.license_scan import words_of

#: Characters of item texts up to which the items go to every task; beyond it the search is a join.
BROADCAST_CHARS = 20_000_000
CACHE_WORDS = 150_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[str], size: int) -> list[str]:
    """Distinct runs of size words; the whole sequence if it has fewer; none without words."""
    if not words:
        return []
    return list({" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))})


class Hashes:
    """64-bit hashes of the runs of words of a text, made from hashes of the words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w, 11)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    @staticmethod
    def runs(h: np.ndarray, size: int) -> np.ndarray:
        """Of every run of size words, by its first."""
        if len(h) < size:
            return np.zeros(0, np.uint64)
        out = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            out = out * STEP + h[k : len(h) - size + 1 + k]
            out ^= out >> np.uint64(29)
        return out


def missable(n: int, threshold: float) -> int:
    """Shingles an item of n may miss and still be contained."""
    return n - math.ceil(threshold * n - 1e-9)


class Item:
    def __init__(self, key, text: str, size: int, threshold: float, hashes: Hashes):
        self.key, words = key, words_of(text)
        self.shingles = set(shingles(words, size))
        n = len(self.shingles)
        self.width = min(size, len(words))
        self.need = n - missable(n, threshold)
        largest = 2 ** n.bit_length() - 1  # of the item's partition: sizes from a power of two to below the next
        sketch = min(n, missable(largest, threshold) + 1)
        self.hits = sketch - missable(n, threshold)
        runs = np.unique(Hashes.runs(hashes.words(words), self.width)) if n else np.zeros(0, np.uint64)
        self.sketch = runs[:sketch]


class Search:
    """Sketches of all items, probed by texts."""

    def __init__(self, items: list[tuple[object, str]], size: int, threshold: float):
        self.size, self.threshold, self.hashes = size, threshold, Hashes()
        self.items = [x for x in (Item(k, t, size, threshold, self.hashes) for k, t in items) if x.shingles]
        self.tables = self._tables()

    def _tables(self) -> list[tuple[int, np.ndarray, dict[int, list[int]]]]:
        """For each width of shingles: sorted sketch hashes, and the items of each."""
        out = []
        for width in sorted({x.width for x in self.items}):
            owners: dict[int, list[int]] = {}
            for i, x in enumerate(self.items):
                if x.width == width:
                    for h in x.sketch.tolist():
                        owners.setdefault(h, []).append(i)
            out.append((width, np.array(sorted(owners), np.uint64), owners))
        return out

    def matches(self, text: str) -> list[tuple[object, int, int]]:
        """(item, its shingles, those the text contains) of the items it contains enough of."""
        words = words_of(text)
        h, found = self.hashes.words(words), []
        for width, probes, owners in self.tables:
            runs = self.hashes.runs(h, width)
            if not len(runs):
                continue
            at = np.minimum(np.searchsorted(probes, runs), len(probes) - 1)
            hit = np.unique(runs[probes[at] == runs])
            counts: dict[int, int] = {}
            for v in hit.tolist():
                for i in owners[v]:
                    counts[i] = counts.get(i, 0) + 1
            candidates = [self.items[i] for i, c in counts.items() if c >= self.items[i].hits]
            if candidates:
                own = {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
                for x in candidates:
                    shared = len(x.shingles & own)
                    if shared >= x.need:
                        found.append((x.key, len(x.shingles), shared))
        return found


def fits(items: DataFrame) -> bool:
    return (items.agg(F.sum(F.length("text") + 16)).first()[0] or 0) <= BROADCAST_CHARS


def sent_search(items: DataFrame, size: int, threshold: float):
    rows = [(r[0], r[1]) for r in items.select("item_id", "text").where("text is not null").collect()]
    return items.sparkSession.sparkContext.broadcast((rows, size, threshold))


_open: dict = {}


def search_of(sent) -> Search:
    """A worker's search for what was sent; one is kept."""
    if sent.value is not _open.get("sent"):
        _open.update(sent=sent.value, search=Search(*sent.value))
    return _open["search"]


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): items contained by the share threshold or more.

    docs: doc_id, text; items: item_id, text; other columns are ignored. One
    row for each pair of ids, the largest share if an id repeats. Items of fewer
    than size words are one shingle of all their words; items and documents
    without words (null, empty) are in no pair; documents of any length are
    searched whole. No items or documents, no rows.
    """
    if fits(items):
        found = _by_broadcast(docs, items, size, threshold)
    else:
        found = _by_join(docs, items, size, threshold)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shingles", "n_shared")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_shingles", "m.n_shared", (F.col("m.n_shared") / F.col("m.n_shingles")).alias("containment"))


def _pair_schema(docs: DataFrame, items: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, n_shingles long, n_shared long"


def _by_broadcast(docs: DataFrame, items: DataFrame, size: int, threshold: float) -> DataFrame:
    sent, kind = sent_search(items, size, threshold), _arrow(items, "item_id")

    def make():
        search = search_of(sent)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, key, n, shared = [], [], [], []
            for i, t in enumerate(texts(batch)):
                for k, a, b in search.matches(t):
                    row.append(i)
                    key.append(k)
                    n.append(a)
                    shared.append(b)
            cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(key, kind), pa.array(n, pa.int64()), pa.array(shared, pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "n_shingles", "n_shared"])

        return one

    return per_batch(docs.select("doc_id", "text"), _pair_schema(docs, items), make)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _probes(asked: DataFrame, size: int, threshold: float) -> DataFrame:
    """(item, width, hits, probe): the sketch of each item (item, text), and how many of it a document must hold."""
    kind = asked.schema["item"].dataType.simpleString()

    def make():
        hashes = Hashes()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [(i, x.width, x.hits, x.sketch) for i, x in enumerate(Item(None, t, size, threshold, hashes) for t in texts(batch)) if x.shingles]
            n = [len(f[3]) for f in found]
            each = lambda k, t: pa.array(np.repeat(np.array([f[k] for f in found], t), n))
            probe = np.concatenate([np.zeros(0, np.uint64), *(f[3] for f in found)]).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column("item").take(each(0, np.int64)), each(1, np.int32), each(2, np.int64), pa.array(probe)], names=["item", "width", "hits", "probe"])

        return one

    return per_batch(asked, f"item {kind}, width int, hits long, probe long", make)


def _probed(keyed: DataFrame, widths: list[int], bits: np.ndarray) -> DataFrame:
    """(doc, width, probe): the hashes of each text's runs of these widths that some sketch may hold, by a filter of fixed size."""
    kind, sent = keyed.schema["doc"].dataType.simpleString(), keyed.sparkSession.sparkContext.broadcast(bits)

    def make():
        hashes = Hashes()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, width, probe = [], [], []
            for i, t in enumerate(texts(batch)):
                h = hashes.words(words_of(t))
                for w in widths:
                    runs = hashes.runs(h, w)
                    at = (runs & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                    own = np.unique(runs[sent.value[at >> 6] >> (at & 63) & 1 == 1])
                    row.append(np.full(len(own), i))
                    width.append(np.full(len(own), w, np.int32))
                    probe.append(own.view(np.int64))
            joined = lambda parts, t: pa.array(np.concatenate([np.zeros(0, t), *parts]).astype(t))
            return pa.RecordBatch.from_arrays([batch.column("doc").take(joined(row, np.int64)), joined(width, np.int32), joined(probe, np.int64)], names=["doc", "width", "probe"])

        return one

    return per_batch(keyed, f"doc {kind}, width int, probe long", make)


def _verified(rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """rows: (doc, text, items: array of item, text). Pairs of which the text has enough of the item's shingles, word by word."""
    kinds = {"doc": rows.schema["doc"].dataType, "item": rows.schema["items"].dataType.elementType["item"].dataType}

    def work(batches):
        for b in slices(batches, 100):
            docs, item, n, shared = [], [], [], []
            for i, (t, asked) in enumerate(zip(texts(b), b.column("items").to_pylist(), strict=True)):
                words, own = words_of(t), {}
                for x in asked:
                    wanted = set(shingles(words_of(x["text"]), size))
                    width = len(next(iter(wanted)).split(" "))
                    if width not in own:
                        own[width] = {" ".join(words[k : k + width]) for k in range(len(words) - width + 1)}
                    held = len(wanted & own[width])
                    if held >= len(wanted) - missable(len(wanted), threshold):
                        docs.append(i)
                        item.append(x["item"])
                        n.append(len(wanted))
                        shared.append(held)
            item_type = b.schema.field("items").type.value_type.field("item").type
            yield pa.RecordBatch.from_arrays([b.column("doc").take(pa.array(docs, pa.int64())), pa.array(item, item_type), pa.array(n, pa.int64()), pa.array(shared, pa.int64())], names=["doc", "item", "n_shingles", "n_shared"])

    return arrow_task(rows, work, f"doc {kinds['doc'].simpleString()}, item {kinds['item'].simpleString()}, n_shingles long, n_shared long")


#: Bits of the filter of sketch hashes; parts into which the candidates of one document are dealt.
FILTER_BITS, PARTS = 1 << 25, 64


def _by_join(docs: DataFrame, items: DataFrame, size: int, threshold: float) -> DataFrame:
    """The same search where the items are too many for every task: sketches meet documents by a join on 64-bit hashes.

    Of the documents only hashes that a filter of the sketches lets through are
    shuffled; texts go to the pairs that have enough hits, where the shingles
    themselves are compared. Each text is known by doc_id and its hash, each
    item by item_id and its.
    """
    keyed = docs.where("text is not null").select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc"), "text").dropDuplicates(["doc"])
    asked = items.where("text is not null").select(F.struct("item_id", F.xxhash64("text").alias("h")).alias("item"), "text").dropDuplicates(["item"])
    spark = docs.sparkSession
    probes, probes_path = durable(_probes(asked, size, threshold), "items-probes")
    at = F.col("probe").bitwiseAND(FILTER_BITS - 1)
    ones = probes.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, int((probe & {FILTER_BITS - 1}) % 64))")).alias("ones"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in ones.toLocalIterator():
        table[r["word"]] = r["ones"]
    widths = sorted(r["width"] for r in probes.select("width").distinct().collect())  # size of them at most
    hits = _probed(keyed, widths, table).join(probes, ["width", "probe"]).groupBy("doc", "item", "hits").count().where(F.col("count") >= F.col("hits"))
    part = F.pmod(F.xxhash64("item"), F.lit(PARTS)).alias("part")
    with_text = hits.select("doc", "item").join(asked.withColumnRenamed("text", "said"), "item").select("doc", part, F.struct("item", F.col("said").alias("text")).alias("x"))
    grouped = with_text.groupBy("doc", "part").agg(F.collect_list("x").alias("items")).drop("part")
    shared = _verified(grouped.join(keyed, "doc"), size, threshold)
    out, _ = durable(shared.select("doc.doc_id", "item.item_id", "n_shingles", "n_shared"), "contained")
    discard(spark, probes_path)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of docs, with all their columns, that contain no item.

    Null and empty texts contain none and stay; a null doc_id is judged by its
    own text; repeated rows go or stay together; without items all stay; an
    empty table gives no rows.
    """
    if not fits(items):
        rows = docs.select(F.struct(*docs.columns).alias("row"), F.struct("doc_id", F.xxhash64("text").alias("h")).alias("key"))
        bad = _by_join(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), items, size, threshold).select(F.col("doc_id").alias("key")).distinct()
        left = rows.join(bad, rows["key"].eqNullSafe(bad["key"]), "left_anti")
        return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    sent = sent_search(items, size, threshold)

    def task(batches):
        for b in slices(batches):
            search = search_of(sent)
            yield b.filter(pa.array([not search.matches(t) for t in texts(b)], pa.bool_()))

    return arrow_task(docs, task, docs.schema)
