"""The driver's test tables as the library's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Plans:
    """Queries of a module by name, with their SQL where there is one."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                spark.conf.set("spark.sql.session.timeZone", "UTC")
                return plain_times(fn(spark, sf_dir))

            self.queries[fn.__name__] = run
            if sql:
                self.sql[fn.__name__] = sql
            return fn

        return register


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall times, as the oracle has them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"})


#: Each event type's metric, its unit as delivered, and the value in terms of the event's.
KINDS = {
    "click": ("wind_speed", "km/h", "value"),
    "view": ("wind_direction", "deg", "value * 7.2"),
    "purchase": ("sea_level_height", "m", "value / 97"),
    "error": ("precipitation", "mm", "value"),
    "signup": ("water_temperature", "degC", "value"),
}


def source_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as long measurements in bins of six hours, from a spot for every two users, and four sources."""
    e = table(spark, sf_dir, "events")
    case = {k: F.lit(m) for k, (m, _, _) in KINDS.items()}
    metric = unit = value = None
    for k, (m, u, v) in KINDS.items():
        is_kind = F.col("event_type") == k
        metric = F.when(is_kind, case[k]) if metric is None else metric.when(is_kind, case[k])
        unit = F.when(is_kind, F.lit(u)) if unit is None else unit.when(is_kind, F.lit(u))
        value = F.when(is_kind, F.expr(v)) if value is None else value.when(is_kind, F.expr(v))
    return e.select(
        "event_id",
        F.concat(F.lit("spot"), F.floor(F.col("user_id") / 2).cast("string")).alias("spot_id"),
        F.concat(F.lit("src"), (F.get_json_object("props", "$.k").cast("long") % 4).cast("string")).alias("source_code"),
        F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 21600) * 21600).alias("valid_time"),
        metric.alias("metric"),
        value.alias("value"),
        unit.alias("unit"),
        F.col("ts").alias("fetched_at"),
    )


_CASE = lambda i: "CASE event_type " + " ".join(f"WHEN '{k}' THEN {x[i] if i == 2 else repr(x[i])}" for k, x in KINDS.items()) + " END"

#: source_values in SQL: sv as delivered; nv with units converted.
SV = f"""
sv AS (
  SELECT event_id, 'spot' || (user_id // 2) AS spot_id, 'src' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 4) AS source_code,
    time_bucket(INTERVAL '6 hours', ts) AS valid_time, {_CASE(0)} AS metric, {_CASE(2)} AS value, {_CASE(1)} AS unit, ts AS fetched_at FROM events
), nv AS (
  SELECT event_id, spot_id, source_code, valid_time, metric, fetched_at,
    CASE metric WHEN 'wind_speed' THEN value / 3.6 WHEN 'wind_direction' THEN fmod(value, 360) ELSE value END AS value FROM sv
)"""

RUN_TIME = "2024-01-15 06:30:00"


def run_time():
    return F.to_timestamp(F.lit(RUN_TIME))


METRICS = ("wind_speed", "wind_direction", "sea_level_height", "precipitation", "water_temperature")

#: Wide rows in SQL, from nv.
WIDE = """
wide AS (
  SELECT spot_id, valid_time,
    avg(value) FILTER (metric = 'wind_speed') AS wind_speed_ms,
    fmod(degrees(atan2(avg(sin(radians(value))) FILTER (metric = 'wind_direction'), avg(cos(radians(value))) FILTER (metric = 'wind_direction'))) + 360, 360) AS wind_direction_deg,
    avg(value) FILTER (metric = 'sea_level_height') AS sea_level_height_m,
    avg(value) FILTER (metric = 'precipitation') AS precipitation_mm,
    avg(value) FILTER (metric = 'water_temperature') AS water_temperature_c,
    count(DISTINCT source_code) AS source_count,
    string_agg(DISTINCT source_code, ',' ORDER BY source_code) AS sources,
    CAST((valid_time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE) AS target_date,
    CAST(floor(epoch(valid_time - TIMESTAMP '2024-01-15 06:30:00') / 3600) AS INTEGER) AS forecast_horizon_hours
  FROM nv GROUP BY spot_id, valid_time
)"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for sums taken in another order."""
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema if f.dataType.typeName() == "double"})
