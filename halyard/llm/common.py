"""Shared helpers of the corpus operators: tables, durable intermediate results, Arrow tasks."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Bytes of a batch of rows on its way to a Python worker, unless the session asks for less.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is named, a folder of our own in local mode, as in tests, else an error."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all machines share")
        conf = "file://" + tempfile.mkdtemp(prefix="halyard-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


#: Paths this driver has written and not deleted.
_written: list[str] = []


def durable(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df to the shared checkpoint folder and read it back: lineage ends there, and a lost executor costs no recomputation.

    Returns the table and its path, for ``discard`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete written intermediate tables through Hadoop's file system API, whatever store holds them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
        if p in _written:
            _written.remove(p)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[set[str]]:
    """Delete the intermediate tables written inside, but for those whose paths are put in the set it gives."""
    before, kept = len(_written), set()
    try:
        yield kept
    finally:
        discard(spark, *[p for p in _written[before:] if p not in kept])


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this driver, once no result of the operators is read any more."""
    discard(spark, *list(_written))


@contextmanager
def memory_returned():
    """Give memory back when a task is over: workers live on between tasks and stages, beside whatever runs next."""
    try:
        yield
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def per_batch(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with a function that each task makes once, on pieces of a thousand rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for b in slices(batches):
            fn = fn or make()
            yield fn(b)

    return arrow_task(df, work, schema)


def arrow_task(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow on batches of bounded bytes, whatever the length of texts, that gives memory back at each task's end.

    Lowers the session's Arrow batch limit to BATCH_BYTES for later queries too:
    Spark reads it when a plan runs, not when it is made.
    """
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not conf.get(limit).removesuffix("b").isdigit() or int(conf.get(limit).removesuffix("b")) > BATCH_BYTES:
        conf.set(limit, str(BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            yield from work(batches)

    return df.mapInArrow(task, schema)


class Remembered:
    """What a worker knows of keys it has met, in two generations bounded by bytes: the older goes when the younger is full."""

    #: Bytes of an entry beside its text, about.
    ENTRY = 160

    def __init__(self, limit: int):
        self.half, self.young, self.old, self.size = limit // 2, {}, {}, 0

    def find(self, keys: Collection[str]) -> tuple[dict, list[str]]:
        """What is known of these keys, and those of which nothing is."""
        young, old, found, new, again = self.young, self.old, {}, [], {}
        for k in keys:
            v = young.get(k)
            if v is None:
                v = old.get(k)
                if v is None:
                    new.append(k)
                    continue
                again[k] = v
            found[k] = v
        self.add(again)
        return found, new

    def add(self, entries: dict) -> None:
        for k, v in entries.items():
            if self.size > self.half:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[k] = v
            self.size += len(k) + (len(v) if isinstance(v, bytes) else 0) + self.ENTRY


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The strings of a column, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows, for what a row becomes in Python."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def with_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new.values()], names=[*keep, *new])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128-bit key of a row's id and text, as hex. Exact repeats of a row share it, and what is found for one holds for all."""
    part = F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit("")))
    return F.md5(part.cast("binary"))
