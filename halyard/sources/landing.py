"""Reading and writing of landed files: source values, catalogues, reports, raw documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.schemas import SOURCE_VALUES

PARTITION = ["run_date", "run_hour", "source_code"]


def is_missing(fault: AnalysisException) -> bool:
    """Whether a read failed for want of the path, or of any file in it, and for nothing else."""
    return fault.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_source_values(spark: SparkSession, path: str, schema: str = SOURCE_VALUES) -> DataFrame:
    """Gzipped JSON lines under run_date=/run_hour=/source_code=; blank lines and lines that are no record are skipped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.where("spot_id is not null and metric is not null and valid_time is not null")


def write_source_values(values: DataFrame, path: str, run_time: Column, fmt: str = "json") -> None:
    """Append values to their run's partitions; nothing is written for no rows."""
    keyed = values.withColumn("run_date", F.date_format(run_time, "yyyy-MM-dd")).withColumn("run_hour", F.date_format(run_time, "HH"))
    writer = keyed.write.mode("append").partitionBy(*PARTITION)
    (writer.option("compression", "gzip").json(path) if fmt == "json" else writer.parquet(path))


def run_instant() -> Column:
    """The hour a row's partition columns name."""
    hour = F.lpad(F.col("run_hour").cast("string"), 2, "0")
    return F.try_to_timestamp(F.concat(F.col("run_date").cast("string"), F.lit(" "), hour, F.lit(":00:00")))


def latest_run(values: DataFrame, now: Column, lookback_hours: int = 12, sources: list[str] | None = None) -> DataFrame:
    """values of the newest run hour, not after now and at most so many hours before it, that has rows of the sources."""
    rows = values if sources is None else values.where(F.col("source_code").isin(*sources))
    hour = F.date_trunc("hour", now)
    within = rows.where((run_instant() <= hour) & (run_instant() >= hour - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))))
    newest = within.agg(F.max(F.struct("run_date", "run_hour")).alias("r")).select("r.run_date", "r.run_hour")
    return within.join(F.broadcast(newest), ["run_date", "run_hour"], "left_semi")


def pick_run(values: DataFrame, run_date: str | None, run_hour: str | None) -> DataFrame:
    """values of a named run; date and hour come together or not at all."""
    if (run_date is None) != (run_hour is None):
        raise ValueError("a run is named by date and hour together")
    if run_date is None:
        return values
    return values.where((F.col("run_date").cast("string") == run_date) & (F.lpad(F.col("run_hour").cast("string"), 2, "0") == run_hour.zfill(2)))


def choose_sources(sources: DataFrame, allowed: list[str] | None, denied: list[str], key: str = "source_code") -> tuple[DataFrame, DataFrame]:
    """(chosen, unknown): sources on the allow-list, if there is one, and not on the deny-list; names that are no source."""
    spark = sources.sparkSession
    names = lambda xs: spark.createDataFrame([(x,) for x in sorted(set(xs))], f"{key} string")
    chosen = sources if allowed is None else sources.join(F.broadcast(names(allowed)), key, "left_semi")
    chosen = chosen.join(F.broadcast(names(denied)), key, "left_anti")
    unknown = names([*(allowed or []), *denied]).join(sources.select(key), key, "left_anti")
    return chosen, unknown


SPOT_COLUMNS = ("id", "name", "latitude_min", "latitude_max", "longitude_min", "longitude_max")


def spot_catalogue(rows: DataFrame) -> DataFrame:
    """(spot_id, name, box, latitude, longitude) by name, nulls last: rows with an id and four numbers; the centre is mid-box."""
    lacking = [c for c in SPOT_COLUMNS if c not in rows.columns]
    if lacking:
        raise ValueError(f"the spot table lacks {', '.join(lacking)}")
    box = [F.col(c).cast("string").try_cast("double").alias(c) for c in SPOT_COLUMNS[2:]]
    clean = rows.select(F.col("id").cast("string").alias("spot_id"), "name", *box).na.drop(subset=["spot_id", *SPOT_COLUMNS[2:]])
    for c in SPOT_COLUMNS[2:]:
        clean = clean.where(~F.isnan(c))
    mid = [((F.col(f"{a}_min") + F.col(f"{a}_max")) / 2).alias(a) for a in ("latitude", "longitude")]
    return clean.select("*", *mid).orderBy(F.col("name").asc_nulls_last())


def select_rows(table: DataFrame, columns: list[str], equal: dict | None = None, among: dict | None = None, between: dict | None = None, order: list[str] | None = None) -> DataFrame:
    """Columns of the rows that meet equality, membership and range filters, in order. A DataFrame given for membership is semi-joined."""
    rows = table
    for c, v in (equal or {}).items():
        rows = rows.where(F.col(c) == v)
    for c, vs in (among or {}).items():
        rows = rows.join(vs.select(F.col(vs.columns[0]).alias(c)), c, "left_semi") if isinstance(vs, DataFrame) else rows.where(F.col(c).isin(*vs))
    for c, (low, high) in (between or {}).items():
        rows = rows.where(F.col(c).between(low, high))
    rows = rows.select(*columns)
    return rows.orderBy(*order) if order else rows


def grid_points(values: DataFrame) -> DataFrame:
    """(source_code, spot_id, model, grid_lat, grid_lon, last_seen): the distinct grid points, to eight decimals."""
    at = [F.round(c, 8).alias(c) for c in ("grid_lat", "grid_lon")]
    seen = values.where("grid_lat is not null and grid_lon is not null").select("source_code", "spot_id", F.coalesce("model", F.lit("")).alias("model"), *at, "fetched_at")
    return seen.groupBy("source_code", "spot_id", "model", "grid_lat", "grid_lon").agg(F.max("fetched_at").alias("last_seen"))


def run_log(values: DataFrame, started: Column) -> DataFrame:
    """(source_code, started_at, finished_at, rows, status, error): one line per source and run."""
    done = values.groupBy("source_code").agg(F.max("fetched_at").alias("finished_at"), F.count("value").alias("rows"), F.count("*").alias("_all"))
    status = F.when(F.col("rows") > 0, "success").otherwise("failed")
    return done.select("source_code", started.alias("started_at"), "finished_at", "rows", status.alias("status"), F.when(F.col("rows") == 0, "no values").alias("error"))


def read_catalogue(spark: SparkSession, path: str, schema: str, required: bool = False) -> DataFrame:
    """JSON files, each a list of objects or one object; entries that are none are dropped; a missing file is an empty table unless required."""
    try:
        files = spark.read.option("wholetext", True).text(path)
    except AnalysisException as fault:
        if required or not is_missing(fault):
            raise
        return spark.createDataFrame([], schema)
    said = F.trim("value")
    entries = F.when(said.startswith("["), F.from_json(said, "array<string>")).otherwise(F.array(said))
    rows = files.select(F.explode(entries).alias("e")).where(F.ltrim("e").startswith("{")).select(F.from_json("e", schema).alias("r")).select("r.*")
    return rows.where(F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in rows.columns], F.lit(False)))


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def store_raw(documents: DataFrame, path: str) -> DataFrame:
    """Write each distinct content once, under shard=; returns (url, content_hash, raw_storage_path) of all documents.

    documents: url, content_type, content (binary). The shard is the hash's first
    two digits; the extension comes from the url, else the type. What is stored
    already is not written again.
    """
    spark = documents.sparkSession
    path_part = F.lower(F.regexp_replace("url", r"[?#].*$", ""))
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    ext = F.when(path_part.endswith(".pdf") | kind.contains("pdf"), "pdf").when(path_part.rlike(r"\.html?$") | kind.contains("html"), "html").otherwise("bin")
    hashed = documents.select("url", "content", F.sha2("content", 256).alias("content_hash"), ext.alias("ext"))
    once = hashed.groupBy("content_hash").agg(F.min("ext").alias("ext"), F.first("content").alias("content")).withColumn("shard", F.substring("content_hash", 1, 2))
    try:
        once = once.join(spark.read.parquet(path).select("content_hash"), "content_hash", "left_anti")
    except AnalysisException as fault:
        if not is_missing(fault):
            raise
    once.write.mode("append").partitionBy("shard").parquet(path)
    place = F.concat(F.lit("shard="), F.substring("content_hash", 1, 2), F.lit("/"), "content_hash", F.lit("."), "ext")
    return hashed.select("url", "content_hash", place.alias("raw_storage_path"))
