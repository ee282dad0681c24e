"""SimHash fingerprints and near-duplicate groups by pigeonring filtering.

Fingerprints within ``radius`` bits are linked. The 64 bits lie in a ring of
``2 j + 1`` segments. If two fingerprints differ in at most r bits, some
segment starts a chain in which, for every length l, the first l segments
differ in at most floor(l r / m) bits. With r = 2 that budget is 0 for the
first j segments, so candidates meet on j consecutive equal segments, and the
budgets of the longer chains prune them before the full Hamming check.

Where a meeting place is crowded no pairs are listed. Its members go through
the exact other way instead: each is written with all fingerprints one bit
away, and those that share one of these are within two bits of each other by
it, and every two within two bits share one. That is 65 rows a member
whatever the crowd, and it makes the same components.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import discard, durable, per_batch, texts, with_columns
from halyard.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SEED, BITS = 42, 64
#: Words hashed together; bounds a task's memory, not the texts.
BLOCK_WORDS = 200_000


def shingle_hashes(text: str, size: int = 3) -> list[int]:
    """XXH64 of every shingle of size words, repeats included; of the whole sequence if it has fewer words."""
    words = WORD.findall(text.encode().lower())
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def fingerprints(text_list: list[str], size: int = 3) -> np.ndarray:
    """A bit is 1 if it is set in over half the hashes; no word gives zero."""
    out = np.zeros(len(text_list), np.uint64)
    for i, t in enumerate(text_list):
        h = np.array(shingle_hashes(t, size), np.uint64)
        if not len(h):
            continue
        ones = np.zeros(BITS, np.int64)
        for at in range(0, len(h), BLOCK_WORDS):
            part = h[at : at + BLOCK_WORDS].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > len(h)).view(">u8")[0]
    return out


def with_fingerprint(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, fp): a hash of the text, and the fingerprint as a signed long."""
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("h"))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return with_columns(batch, ["id", "h"], fp=pa.array(fingerprints(texts(batch), size).view(np.int64)))

        return one

    return per_batch(slim, f"id {slim.schema['id'].dataType.simpleString()}, h long, fp long", make)


def segments(m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each of m segments of 64 bits."""
    cuts = [i * BITS // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def segment_value(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND((1 << bits) - 1)


def chain_budgets(start: int, m: int, radius: int, x: Column) -> Column:
    """Whether every chain from segment start, of 1 to m segments, keeps its budget in the differences x."""
    spans = segments(m)
    ok, mask = F.lit(True), 0
    for length in range(1, m + 1):
        first, bits = spans[(start + length - 1) % m]
        mask |= ((1 << bits) - 1) << first
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        ok = ok & (F.bit_count(x.bitwiseAND(F.lit(signed).cast("long"))) <= length * radius // m)
    return ok


def near_links(fps: DataFrame, radius: int = 2, crowd: int = 32) -> DataFrame:
    """(a, b) links between distinct fingerprints, whose components are those of all pairs within radius bits.

    fps: one column fp, distinct.
    """
    if radius not in (1, 2):
        raise ValueError("meeting places of one-bit neighbours make radius 1 or 2")
    m = 5
    j = next(n for n in range(m, 0, -1) if n * radius // m == 0)
    spans = segments(m)
    rings = []
    for start in range(m):
        used = [spans[(start + k) % m] for k in range(j)]
        rings.append(F.struct(F.lit(start).alias("ring"), F.concat_ws("/", *[segment_value(F.col("fp"), *s).cast("string") for s in used]).alias("place")))
    met = fps.select("fp", F.explode(F.array(*rings)).alias("at")).select("fp", "at.ring", "at.place")
    sizes = met.groupBy("ring", "place").count().where("count > 1")
    few, crowded = sizes.where(F.col("count") <= crowd).drop("count"), sizes.where(F.col("count") > crowd).drop("count")
    left = met.join(few, ["ring", "place"])
    pairs = left.alias("p").join(left.alias("q"), ["ring", "place"]).where("p.fp < q.fp").select("ring", F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    kept = F.lit(False)
    for start in range(m):
        kept = kept | ((F.col("ring") == start) & chain_budgets(start, m, radius, x))
    listed = pairs.where(kept).where(F.bit_count(x) <= radius).select("a", "b")
    # the exact way of crowded places
    members = met.join(crowded, ["ring", "place"], "left_semi").select("fp").distinct()
    flips = [F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(BITS)]]
    if radius == 1:  # one bit away means: one's place is the other
        flips_of = members.select("fp", F.explode(F.array(*flips[1:])).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("b"))
        star = flips_of.join(members.select(F.col("fp").alias("b")), "b").select(F.col("fp").alias("a"), "b")
    else:
        around = members.select("fp", F.explode(F.array(*flips)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
        hubs = around.groupBy("at").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("others")).where(F.size("others") > 1)
        star = hubs.select("a", F.explode("others").alias("b")).where("a <> b")
    return listed.union(star).distinct()


def near_groups(docs: DataFrame, radius: int = 2, size: int = 3, id_col: str = "doc_id", text_col: str = "text", crowd: int = 32) -> DataFrame:
    """One row per row of docs: id, h (hash of the text), fp long, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most radius
    differing bits, the row's own included. Equal fingerprints are linked,
    those of texts without words (null, empty, white space: zero) like any
    other. Repeated rows give repeated rows. A null id gets the component of its
    group, null if the group has no other. Texts of any length count whole. An
    empty table gives no rows. Other columns are ignored.
    """
    prints, _ = durable(with_fingerprint(docs, size, id_col, text_col), "simhash-prints")
    distinct, distinct_path = durable(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    links, links_path = durable(near_links(distinct.select("fp"), radius, crowd), "simhash-links")
    label = connected_components(links, "a", "b", "simhash-components")
    by_fp = distinct.join(label, distinct["fp"] == label["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = by_fp.groupBy("component").agg(F.min("least").alias("component_id"))
    named, _ = durable(by_fp.join(smallest, "component").select("fp", "component_id"), "simhash-named")
    discard(docs.sparkSession, distinct_path, links_path)
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), "h", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, radius: int = 2, size: int = 3) -> DataFrame:
    """docs, with all their columns, with one row of each group: that of the smallest doc_id; of its exact repeats, one.

    Null, empty and blank texts have fingerprint zero and are a group like any
    other. A null doc_id stays only where its group has no other id. An empty
    table gives no rows.
    """
    groups = near_groups(docs, radius, size)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key(F.col("doc_id")).alias("k"), "h").distinct()
    # by one key through both steps and at every size: the texts are shuffled once
    rows = docs.select(F.struct(*docs.columns).alias("row"), id_key(F.col("doc_id")).alias("k"), F.xxhash64("text").alias("h"))
    kept = rows.join(first.hint("merge"), ["k", "h"], "left_semi").dropDuplicates(["k", "h"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def id_key(c: Column) -> Column:
    """An id as a key that null has too."""
    return F.coalesce(c.cast("string"), F.lit("null"))
