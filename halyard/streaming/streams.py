"""Structured Streaming forms of landing, consolidation, upsert and alert de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from halyard.functions.numbers import circular_mean
from halyard.operators.consolidate import known
from halyard.registry import CIRCULAR, COLUMN
from halyard.schemas import SOURCE_VALUES
from halyard.streaming import versions


def landed_stream(spark: SparkSession, path: str, schema: str = SOURCE_VALUES, fmt: str = "json", files_per_batch: int = 100) -> DataFrame:
    """New run files as they land, each once, so many a batch."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that has landed to a table, then stop; a restart goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_stream(values: DataFrame, metrics: tuple[str, ...], late: str = "6 hours", width: str = "1 hour") -> DataFrame:
    """One wide row per spot and hour, final once no row of that hour can still arrive within late.

    Rows later than that are dropped by the watermark.
    """
    def reduced(m: str) -> Column:
        v = F.when(F.col("metric") == m, F.col("value"))
        return (circular_mean(v) if m in CIRCULAR else F.avg(v)).alias(COLUMN[m])

    rows = known(values, metrics).withWatermark("valid_time", late)
    wide = rows.groupBy(F.window("valid_time", width), "spot_id").agg(*[reduced(m) for m in metrics], F.array_sort(F.collect_set("source_code")).alias("sources"))
    return wide.select("spot_id", F.col("window.start").alias("valid_time"), *[COLUMN[m] for m in metrics], "sources", F.size("sources").alias("source_count"))


def upsert_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str, seq: str) -> StreamingQuery:
    """Each batch's last row of a key replaces the table's.

    A batch is written as a folder of the keys it has and then published in the
    table's manifest; readers take a key's last version (``current_rows``). A
    batch that runs again publishes its new folder in place of its old one, and
    no table is rewritten as a whole.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), seq).alias("r")).select("r.*")
        folder = versions.folder(batch_id)
        last.withColumn("_batch", F.lit(batch_id).cast("long")).write.parquet(f"{path}/{folder}")
        versions.publish(spark, path, lambda live: [f for f in live if versions.batches_of(f) != (batch_id, batch_id)] + [folder])

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _latest(rows: DataFrame, keys: list[str], seq: str | None) -> DataFrame:
    last = F.struct(*([seq] if seq else []), "_batch")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), last).alias("r")).select(*keys, "r.*")


def current_rows(spark: SparkSession, path: str, keys: list[str], seq: str | None = None) -> DataFrame:
    """The table's rows as the manifest stands now, one a key: of the highest seq, and of the last batch among these or without seq.

    What is published or put together later doesn't change a table read before.
    """
    folders = versions.live(spark, path)
    return _latest(spark.read.parquet(*[f"{path}/{f}" for f in folders]), keys, seq).drop("_batch")


def compact_rows(spark: SparkSession, path: str, keys: list[str], upto: int, seq: str | None = None) -> None:
    """Put the versions up to batch upto together as one folder, which holds each key's current row among them.

    The folder is written beside the others and takes their place in the
    manifest in one step. Nothing is deleted, so readers that have begun go on;
    ``versions.vacuum`` deletes what no manifest names any more. A run that is
    cut off leaves a folder nobody reads, and is done again.
    """
    old = [f for f in versions.live(spark, path) if versions.batches_of(f)[1] <= upto]
    if len(old) < 2:
        return
    folder = versions.folder(min(versions.batches_of(f)[0] for f in old), max(versions.batches_of(f)[1] for f in old))
    _latest(spark.read.parquet(*[f"{path}/{f}" for f in old]), keys, seq).write.parquet(f"{path}/{folder}")

    def swapped(live: list[str]) -> list[str]:
        if not set(old) <= set(live):
            raise RuntimeError("another run has put these versions together")
        return [f for f in live if f not in old] + [folder]

    versions.publish(spark, path, swapped)


def once_a_day(alerts: DataFrame, key: str = "alert_id", time: str = "valid_time", late: str = "1 day") -> DataFrame:
    """The first alert of each key and UTC day, state kept no longer than late."""
    return alerts.withColumn("day", F.to_date(time)).withWatermark(time, late).dropDuplicatesWithinWatermark([key, "day"])
