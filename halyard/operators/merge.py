"""Upserts, cumulative merges and retention."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard import staging
from halyard.functions.text import strip_spaces
from halyard.sources.landing import is_missing


def keep_last(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of each key with the largest seq."""
    w = W.partitionBy(*keys).orderBy(F.desc(seq))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def fallback_key(key: Column, parts: list[Column]) -> Column:
    """key if it is there, else its parts joined; separators stay where parts lack, so it is never empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.coalesce(F.when(key != "", key), joined)


def last_of_key(rows: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """One row a key: of the largest seq, then, as without seq, the largest row by its columns in order."""
    others = [F.col(c) for c, f in zip(rows.columns, rows.schema) if c not in keys and c != seq and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    w = W.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in [*([F.col(seq)] if seq else []), *(others or [F.lit(1)])]])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], insert_only: tuple[str, ...] = (), seq: str | None = None) -> DataFrame:
    """old with new's rows in place of those of the same key; new rows without a whole key are left out.

    Of new rows that share a key one counts (``last_of_key``). insert_only
    columns keep the old row's value.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    fresh = last_of_key(new.where(whole), keys, seq)
    if insert_only:
        kept = old.select(*keys, *[F.col(c).alias(f"_{c}") for c in insert_only])
        fresh = fresh.join(kept, keys, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in insert_only else F.col(c) for c in new.columns])
    return old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*old.columns))


def rewrite_partitions(spark: SparkSession, path: str, by: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
    """Put change(rows) in place of the rows of the partitions that touched names in its column by; returns how many these are.

    The table lies under path in folders of by. Only touched partitions are
    read, as their values prune the scan, and only they are written; files of
    all others stay as they are. The new rows are stored in the shared folder
    first, so a job that fails has changed nothing. A partition left without
    rows goes. One writer at a time. Only the values of by come to the driver.
    """
    values = [r[0] for r in touched.select(by).distinct().collect()]
    kind = touched.schema[by].dataType
    try:
        table = spark.read.parquet(path)
        if table.schema[by].dataType != kind:  # the folders' names read as what they are, "01" as a text
            table = spark.read.schema(T.StructType([T.StructField(f.name, kind if f.name == by else f.dataType) for f in table.schema])).parquet(path)
    except AnalysisException as fault:
        if not is_missing(fault):
            raise
        change(touched.limit(0)).write.partitionBy(by).parquet(path)
        return len(values)
    some = [v for v in values if v is not None]
    wanted = F.col(by).isin(*some) if some else F.lit(False)
    old = table.where(wanted | F.col(by).isNull() if None in values else wanted)
    folders = old.select(by, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct().collect()
    new = staging.stored(change(old), "rewritten")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    left = {r[0] for r in new.select(by).distinct().collect()}
    for value, folder in folders:
        if value not in left:
            staging.delete(spark, folder)
    return len(values)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], by: str, insert_only: tuple[str, ...] = (), seq: str | None = None) -> int:
    """``upsert`` into the table under path, partitioned by one of its columns; only partitions that new has rows of are read and written.

    by has to follow from the key, so that a key's rows are in one partition.
    """
    whole = new.where(" and ".join(f"`{k}` is not null" for k in keys))

    def change(old: DataFrame) -> DataFrame:
        return upsert(old.select(*new.columns), whole, keys, insert_only, seq)

    return rewrite_partitions(spark, path, by, whole, change)


def cumulative_merge(before: DataFrame, after: DataFrame, known: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(latest, delta): snapshots taken before and after a publication, united into what is known, and by themselves.

    Of equal keys the later wins: after, before, known.
    """
    both = before.withColumn("_seq", F.lit(1)).unionByName(after.withColumn("_seq", F.lit(2)))
    delta = keep_last(both, keys, "_seq")
    latest = keep_last(known.withColumn("_seq", F.lit(0)).unionByName(delta), keys, "_seq").drop("_seq")
    return latest, delta.drop("_seq")


def expire_rows(rows: DataFrame, cutoff: Column, time: str = "valid_time") -> DataFrame:
    return rows.where(F.col(time) >= cutoff)


def expire_table(spark: SparkSession, path: str, by: str, cutoff: Column, time: str = "valid_time") -> int:
    """Drop rows before cutoff from a table in folders by day; returns the partitions touched.

    A day wholly before the cutoff's goes as a folder, the cutoff's own day is
    written again without its earlier rows, later days are not touched. Days
    are those of the session's time zone.
    """
    table = spark.read.parquet(path)
    day = F.to_date(cutoff)
    touched = table.where(F.col(by) <= day).select(by)
    return rewrite_partitions(spark, path, by, touched, lambda rows: expire_rows(rows, cutoff, time))


def expired_runs(parts: DataFrame, cutoff: Column, prefix: str) -> DataFrame:
    """(path) of the run partitions under prefix whose hour lies before cutoff; other files stay."""
    date = F.regexp_extract("path", r"run_date=(\d{4}-\d{2}-\d{2})/", 1)
    hour = F.regexp_extract("path", r"/run_hour=(\d{2})/", 1)
    run = F.try_to_timestamp(F.concat(date, F.lit(" "), hour, F.lit(":00:00")))
    return parts.where(F.col("path").startswith(prefix) & run.isNotNull() & (run < cutoff))


def replace_children(children: DataFrame, new: DataFrame, parent: str, needed: tuple[str, ...] = ("quote", "source_url")) -> DataFrame:
    """children with new's in place of those of the same parent. New ones that lack a needed text, or have but white space there, don't count; a parent that has no others keeps its old children."""
    whole = [strip_spaces(F.col(c)) != "" for c in needed]
    fit = new
    for w in whole:
        fit = fit.where(w)
    return children.join(fit.select(parent).distinct(), parent, "left_anti").unionByName(fit.select(*children.columns))


def drop_orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return rows.join(parents.select(key).distinct(), key, "left_semi")
