"""Exact top-k by inner product through a pivot-distance index.

Score and distance. Vectors are whole numbers w = floor(64 * x). Each indexed
vector gets one more component, sqrt(M - |w|^2) with M the largest squared
norm, and each query a zero. Then |q - w|^2 = |q|^2 + M - 2 * score: the
nearest vectors are those of the highest scores, and the triangle inequality
holds.

Index. Pivots are the centres of a bounded sample. Every vector is keyed by its
nearest pivot and its distance from it; a pivot's vectors are cut into rings by
distance, at quantiles of all of them. Ring sizes are not bounded: a ring is
stored as pages of some hundred vectors, and pages are dealt by (ring, salt) so
that a ring of a third of all vectors lies in many tasks. The directory has a
line for each ring, at most PIVOTS * RINGS of them, whatever the table's size.

Search. A query q at distance d from a ring's pivot is at least d - high and
low - d away from all its vectors, which bounds their scores from above.
Queries, packed by the block, take their rings by falling bound in three
strides: the first RINGS_FIRST, then up to RINGS_NEXT, then all that are left. After
each stride a query knows its k-th best score, and a ring whose bound lies
below it is never read. Scores are exact integers; bounds are given what
rounding may cost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, discard, durable
from halyard.llm.vectors import as_longs, longest, matrix, products, whole_vectors

#: Sample the pivots are fitted on, pivots, rings of a pivot at most.
SAMPLE, PIVOTS, RINGS = 4096, 64, 64
#: Vectors that make a ring worth its line, vectors of a page, pages of a ring that go by one key.
RING_ROWS, PAGE_ROWS, SALT_PAGES = 512, 512, 16
#: Rings a query reads in its first stride and in its first two, and queries of a block.
RINGS_FIRST, RINGS_NEXT, BLOCK = 2, 12, 1024
NO_SCORE = -(1 << 63)


@dataclass(frozen=True)
class Directory:
    """Of the vectors: components, and the largest squared norm. pivots: a row each, with the added component. Of each ring: its number (pivot * RINGS and place), least and largest distance, rows."""

    width: int
    most: float
    pivots: np.ndarray
    ring: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    @property
    def slack(self) -> float:
        """More than rounding makes of a distance."""
        return 1e-6 * (np.sqrt(self.most) + np.sqrt((self.pivots * self.pivots).sum(1).max(initial=0)) + 1)


@dataclass(frozen=True)
class Index:
    """pages: ring, salt, ids, vectors."""

    directory: Directory
    pages: DataFrame


def lifted(w: np.ndarray, most: float) -> np.ndarray:
    """Indexed vectors with the component that makes all equally long."""
    w = w.astype(np.float64)
    return np.concatenate([w, np.sqrt(np.maximum(most - (w * w).sum(1), 0))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of a sample: the first vectors that lie farthest from all before them, moved to the middle of what is nearest."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    gap = distances(sample, sample[:1])[:, 0]
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, distances(sample, sample[chosen[-1:]])[:, 0])
    at = sample[chosen]
    for _ in range(rounds):
        nearest = np.argmin(distances(sample, at), axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, nearest, sample)
        n = np.bincount(nearest, minlength=len(at))[:, None]
        at = np.where(n > 0, sums / np.maximum(n, 1), at)
    return at


def packed(a: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where they fit, else in eight."""
    small = not a.size or (a.min() >= -(1 << 15) and a.max() < 1 << 15)
    return (b"2" if small else b"8") + a.astype("<i2" if small else "<i8").tobytes()


def unpacked(b: bytes, width: int) -> np.ndarray:
    flat = np.frombuffer(b, "<i2" if b[:1] == b"2" else "<i8", offset=1).astype(np.int64)
    return flat.reshape(-1, width) if width else flat.reshape(0, 0)


def build(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """The index of every usable vector; its tables lie in the shared checkpoint folder.

    Pivots are fitted on SAMPLE vectors, those of the least hash; all else is
    of all vectors.
    """
    spark = embeddings.sparkSession
    whole = whole_vectors(embeddings, id_col, vector_col)
    width = longest(whole)
    square = F.aggregate("whole", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = float(whole.agg(F.max(square)).first()[0] or 0.0)
    sample = whole.select("whole", F.xxhash64("vec_id", "whole").alias("hash")).orderBy("hash", "whole").limit(SAMPLE).collect()
    fitted = np.zeros((len(sample), width), np.int64)
    for i, r in enumerate(sample):
        fitted[i, : len(r["whole"])] = r["whole"]
    pivots = centres(lifted(fitted, most), PIVOTS)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = matrix(b.column("whole"), width)
            d = distances(lifted(w, most), pivots)
            near = np.argmin(d, axis=1)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([packed(v) for v in w], pa.binary()), pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near], pa.float64())], names=["vec_id", "vector", "pivot", "distance"])

    keyed, keyed_path = durable(arrow_task(whole, key, "vec_id long, vector binary, pivot int, distance double"), "pivot-keyed")
    steps = F.percentile_approx("distance", [i / RINGS for i in range(1, RINGS)], 10_000)
    sizes = {r["pivot"]: (r["n"], r["steps"]) for r in keyed.groupBy("pivot").agg(F.count("*").alias("n"), steps.alias("steps")).collect()}
    cuts = {}
    for p, (n, marks) in sizes.items():
        rings = max(1, min(RINGS, n // RING_ROWS))
        cuts[p] = np.unique([marks[i * RINGS // rings - 1] for i in range(1, rings)])

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pivot, distance = b.column("pivot").to_numpy(), b.column("distance").to_numpy()
            at = np.zeros(len(pivot), np.int64)
            for p in np.unique(pivot):
                at[pivot == p] = np.searchsorted(cuts[p], distance[pivot == p], side="right")
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), pa.array(pivot * RINGS + at, pa.int64()), b.column("distance"), pa.array(np.arange(b.num_rows), pa.int64())], names=["vec_id", "vector", "ring", "distance", "nth"])

    ringed, ringed_path = durable(arrow_task(keyed, ring, "vec_id long, vector binary, ring long, distance double, nth long"), "pivot-ringed")
    lines = ringed.groupBy("ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")).orderBy("ring").collect()
    salts = spark.createDataFrame([(r["ring"], max(1, r["n"] // (PAGE_ROWS * SALT_PAGES))) for r in lines], "of_ring long, salts long")
    salt = F.pmod(F.xxhash64("vec_id", "vector", "nth"), F.col("salts"))  # of copies of a row too
    dealt = ringed.join(F.broadcast(salts), F.col("ring") == F.col("of_ring")).select("ring", salt.alias("salt"), "vec_id", "vector", "distance")

    def page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def full() -> pa.RecordBatch:
            ids = [r[0] for r in held]
            whole_page = packed(np.concatenate([unpacked(r[1], width) for r in held]) if width else np.zeros((0, 0), np.int64))
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([whole_page], pa.binary())], names=["ring", "salt", "ids", "vectors"])

        for b in batches:
            for r, s, i, v in zip(*[b.column(c).to_pylist() for c in ("ring", "salt", "vec_id", "vector")]):
                if held and (at != (r, s) or len(held) >= PAGE_ROWS):
                    yield full()
                    held.clear()
                at = (r, s)
                held.append((i, v))
        if held:
            yield full()

    expanded = dealt.repartition("ring", "salt").sortWithinPartitions("ring", "salt", "distance").select("ring", "salt", "vec_id", "vector")
    pages, _ = durable(arrow_task(expanded, page, "ring long, salt long, ids array<long>, vectors binary"), "pivot-pages")
    discard(spark, keyed_path, ringed_path)
    column = lambda c: np.array([r[c] for r in lines], np.float64)
    numbers = np.array([r["ring"] for r in lines], np.int64)
    return Index(Directory(width, most, pivots, numbers, column("low"), column("high"), column("n")), pages)


def bounds(index: Directory, queries: np.ndarray) -> np.ndarray:
    """The highest score each query (rows) may have in each ring (columns)."""
    q = queries.astype(np.float64)
    away = distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), index.pivots)[:, index.ring // RINGS]
    slack = 1e-6 * np.sqrt((q * q).sum(1))[:, None] + index.slack
    least = np.maximum(np.maximum(away - index.high, index.low - away) - slack, 0)
    square = (q * q).sum(1)[:, None] + index.most
    return (square - least * least) / 2 + 1e-9 * square + 1


def best_of(scores: np.ndarray, ids: list, own: int | None, least: int, k: int) -> list[tuple[int, int | None]]:
    """The k best (score, id) of at least a score, ties to smaller ids, null ids last; rows of the query's own id don't count."""
    at = np.flatnonzero(scores >= least)
    if len(at) > 4 * k:  # what is below the k-th best, own rows set aside, can't come in
        foreign = at[[ids[i] != own for i in at]]
        if len(foreign) > k:
            at = foreign[scores[foreign] >= np.partition(scores[foreign], len(foreign) - k)[len(foreign) - k]]
    found = [(int(scores[i]), ids[i]) for i in at if ids[i] != own]
    return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]


def search(index: Index, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest scores of every usable query among the indexed rows but those of its own id; all, if fewer.

    Ties go to the smaller vec_id, null ids last. A query row that repeats (id
    and vector) counts once, indexed rows count each; a null id is an id like
    any other. Query vectors longer than the index's are cut to its
    length, as zeros stand there. Scores stop at the ends of a long. Without
    queries or without indexed rows there are no rows. Other columns are not
    read.
    """
    spark, directory = queries.sparkSession, index.directory
    width, bare = directory.width, whole_vectors(queries, id_col, vector_col).distinct()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = pa.array([v[:width] for v in b.column("whole").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("query"), b.column("vec_id"), pa.array([packed(v) for v in matrix(cut, width)], pa.binary())], names=["query", "query_id", "vector"])

    # numbers are given by the task that writes the table, and read back from it
    asked, asked_path = durable(arrow_task(bare.withColumn("query", F.monotonically_increasing_id()), number, "query long, query_id long, vector binary"), "pivot-queries")
    salts = np.maximum(1, directory.rows // (PAGE_ROWS * SALT_PAGES)).astype(int)
    block = "ring long, salt long, queries array<long>, query_ids array<long>, least array<long>, vectors binary"

    def requests(first: int, last: int | None):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole_batch in batches:
                for start in range(0, whole_batch.num_rows, BLOCK):
                    b = whole_batch.slice(start, BLOCK)
                    q = np.concatenate([unpacked(v, width) for v in b.column("vector").to_pylist()]) if width else np.zeros((b.num_rows, 0), np.int64)
                    numbers, ids, least = (b.column(c).to_pylist() for c in ("query", "query_id", "least"))
                    bound = bounds(directory, q)
                    order = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1, kind="stable")
                    floor = np.array([float(x) for x in least])[:, None]
                    wanted = (order >= first) & (order < (len(directory.rows) if last is None else last)) & (bound >= floor)
                    for r in np.flatnonzero(wanted.any(axis=0)):
                        at = np.flatnonzero(wanted[:, r])
                        row = [[numbers[i] for i in at], [ids[i] for i in at], [least[i] for i in at], packed(q[at])]
                        for s in range(salts[r]):
                            yield pa.RecordBatch.from_arrays([pa.array([directory.ring[r]], pa.int64()), pa.array([s], pa.int64()), *[pa.array([x], pa.list_(pa.int64())) for x in row[:3]], pa.array([row[3]], pa.binary())], names=["ring", "salt", "queries", "query_ids", "least", "vectors"])

        return work

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for numbers, own, least, q, ids, vectors in zip(*[b.column(c).to_pylist() for c in ("queries", "query_ids", "least", "vectors", "ids", "page")]):
                rows = unpacked(vectors, width) if width else np.zeros((len(ids), 0), np.int64)
                asking = unpacked(q, width) if width else np.zeros((len(numbers), 0), np.int64)
                scores = as_longs(products(asking, rows.T))
                some = np.flatnonzero((scores >= np.array(least, np.int64)[:, None]).any(axis=1))
                found = [(numbers[n], own[n], i, s) for n in some for s, i in best_of(scores[n], ids, own[n], least[n], k)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found)], names=["query", "query_id", "vec_id", "score"])

    pages = index.pages.select(F.col("ring").alias("of_ring"), F.col("salt").alias("of_salt"), "ids", F.col("vectors").alias("page"))
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best, best_path = None, None
    for first, last in ((0, RINGS_FIRST), (RINGS_FIRST, RINGS_NEXT), (RINGS_NEXT, None)):
        if first >= len(directory.rows) and best is not None:
            break
        if best is None:
            state = asked.withColumn("least", F.lit(NO_SCORE).cast("long"))
        else:
            reached = best.groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k)
            state = asked.join(reached, "query", "left").select("query", "query_id", "vector", F.coalesce("kth", F.lit(NO_SCORE)).alias("least"))
        blocks = arrow_task(state, requests(first, last), block)
        met = blocks.hint("merge").join(pages, (F.col("ring") == F.col("of_ring")) & (F.col("salt") == F.col("of_salt")))
        new = arrow_task(met.select("queries", "query_ids", "least", "vectors", "ids", "page"), hits, "query long, query_id long, vec_id long, score long")
        ranked = (new if best is None else best.select(*new.columns).union(new)).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        now, path = durable(ranked, "pivot-best")
        if best_path:
            discard(spark, best_path)
        best, best_path = now, path
    discard(spark, asked_path)
    return best.select("query_id", "rank", "vec_id", "score")
