"""Landed JSON payloads of forecast providers as long rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.numbers import clean_number, metric_unit, metric_value

HOURLY = "struct<hourly:map<string,array<string>>,hourly_units:map<string,string>>"
SERIES = """struct<properties:struct<timeseries:array<struct<time:string,data:struct<
instant:struct<details:map<string,string>>,next_1_hours:struct<details:map<string,string>>>>>>>"""


def instant(c: Column) -> Column:
    """A time with or without zone, UTC unless it says otherwise; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})$", "$1:00"))


def _mapped(rows: DataFrame, variables: dict[str, str]) -> DataFrame:
    """raw_variable to metric, value and unit normalised, nulls dropped."""
    names = F.create_map(*[F.lit(x) for kv in variables.items() for x in kv])
    long = rows.withColumn("metric", names[F.col("raw_variable")]).where("metric is not null")
    value = metric_value(F.col("metric"), F.col("value"), F.col("unit"))
    return long.withColumn("value", value).withColumn("unit", metric_unit(F.col("metric"), F.col("unit"))).where("value is not null")


def flatten_hourly(payloads: DataFrame, variables: dict[str, str], keep: tuple[str, ...] = ("spot_id",), order: str | None = None) -> DataFrame:
    """payload {hourly: {time: [], variable: []}, hourly_units: {}} to (keep, valid_time, raw_variable, metric, value, unit).

    Bad times are skipped, short arrays give nulls, nulls are dropped, times go
    to their hour. With order, payloads of a spot fetched one variable at a time
    are merged: of a time and variable delivered twice the last payload's stays.
    """
    extra = [order] if order else []
    p = payloads.select(*keep, *extra, F.from_json("payload", HOURLY).alias("p"))
    times = p.select(*keep, *extra, "p", F.posexplode(F.try_element_at("p.hourly", F.lit("time"))).alias("i", "time"))
    cells = times.select(*keep, *extra, F.date_trunc("hour", instant(F.col("time"))).alias("valid_time"), "i", F.col("p.hourly_units").alias("units"), F.explode(F.map_filter("p.hourly", lambda k, _: k.isin(*variables))).alias("raw_variable", "values"))
    long = cells.select(*keep, *extra, "valid_time", "raw_variable", F.get("values", F.col("i")).alias("value"), F.try_element_at("units", F.col("raw_variable")).alias("unit")).where("valid_time is not null")
    if order:
        last = W.partitionBy(*keep, "valid_time", "raw_variable").orderBy(F.desc(order))
        long = long.where(clean_number(F.col("value")).isNotNull()).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", order)
    return _mapped(long, variables)


def zip_batch(payloads: DataFrame, spots: DataFrame) -> DataFrame:
    """(batch_id, spot_id, payload) from batches (batch_id, payload: a JSON list or one object) and spots (batch_id, position, spot_id).

    A batch whose payloads are not as many as its spots is an error.
    """
    text = F.trim("payload")
    items = F.when(text.startswith("["), F.from_json("payload", "array<string>")).otherwise(F.array("payload"))
    asked = spots.groupBy("batch_id").agg(F.count("*").alias("n"))
    checked = payloads.select("batch_id", items.alias("items")).join(asked, "batch_id")
    wrong = F.raise_error(F.concat(F.lit("payloads and spots differ in number in batch "), F.col("batch_id").cast("string")))
    sure = checked.select("batch_id", F.when(F.size("items") == F.col("n"), F.col("items")).otherwise(wrong.cast("array<string>")).alias("items"))
    each = sure.select("batch_id", F.posexplode("items").alias("position", "payload"))
    return each.join(spots, ["batch_id", "position"]).select("batch_id", "spot_id", "payload")


def flatten_series(payloads: DataFrame, variables: dict[str, str], run_time: Column, days: int, units: dict[str, str] | None = None) -> DataFrame:
    """payload {properties: {timeseries: [{time, data}]}} to long rows in [run_time, run_time + days)."""
    p = payloads.select("spot_id", F.explode(F.from_json("payload", SERIES).getField("properties").getField("timeseries")).alias("t"))
    at = F.date_trunc("hour", instant(F.col("t.time")))
    both = F.array(F.col("t.data.instant.details"), F.col("t.data.next_1_hours.details"))
    cells = p.select("spot_id", at.alias("valid_time"), F.explode(both).alias("details")).where("details is not null").select("spot_id", "valid_time", F.explode("details").alias("raw_variable", "value"))
    known = F.create_map(*[F.lit(x) for kv in (units or {"": ""}).items() for x in kv])
    start = F.date_trunc("hour", run_time)
    inside = cells.where((F.col("valid_time") >= start) & (F.col("valid_time") < run_time + F.make_dt_interval(F.lit(days))))
    return _mapped(inside.withColumn("unit", known[F.col("raw_variable")]), variables)


def _coefficient(c: Column) -> Column:
    whole = F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("int"))
    return F.when(whole.between(20, 120), whole)


def flatten_matrix(payloads: DataFrame, anchor: Column) -> DataFrame:
    """payload [month][day][...] of coefficients, the first month anchor's, to (date, position, coefficient).

    Days a month does not have are dropped, and what is no whole number of 20 to 120.
    """
    months = payloads.select(F.posexplode(F.from_json("payload", "array<array<array<string>>>")).alias("m", "days"))
    days = months.select("m", F.posexplode("days").alias("d", "values"))
    first = F.add_months(F.trunc(anchor, "month"), F.col("m"))
    date = F.try_to_date(F.format_string("%s-%02d", F.date_format(first, "yyyy-MM"), F.col("d") + 1), "yyyy-MM-dd")
    each = days.select(date.alias("date"), F.posexplode("values").alias("position", "v"))
    return each.where("date is not null").select("date", "position", _coefficient(F.col("v")).alias("coefficient")).where("coefficient is not null")


DATE_FIELDS = ("date", "datetime", "time", "timestamp", "valid_time", "utc", "t")
COEFFICIENT_FIELDS = ("coefficient", "coefficients", "coeff", "coeffs", "coef", "tidal_coefficient", "tide_coefficient")


def flatten_keyed(payloads: DataFrame) -> DataFrame:
    """payload of objects to (date, coefficient): date-named keys, or a date field beside coefficient fields.

    Objects are sought at the top, in its lists, and in lists one field deep.
    """
    one = payloads.select(F.from_json("payload", "map<string,string>").alias("o"))
    listed = payloads.select(F.explode(F.from_json("payload", "array<map<string,string>>")).alias("o"))
    deep = one.select(F.explode(F.map_values("o")).alias("v")).where("v like '[%'").select(F.explode(F.from_json("v", "array<map<string,string>>")).alias("o"))
    found = one.union(listed).union(deep).where("o is not null")
    values = lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(v))
    day = lambda c: F.try_to_date(F.regexp_extract(F.trim(c), r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    entries = found.select(F.explode("o").alias("k", "v"))
    named = entries.select(day(F.col("k")).alias("date"), F.explode(values(F.col("v"))).alias("c")).where("date is not null")
    dated = found.select(
        F.coalesce(*[day(F.try_element_at("o", F.lit(k))) for k in DATE_FIELDS]).alias("date"),
        F.explode(F.flatten(F.array(*[F.coalesce(values(F.try_element_at("o", F.lit(k))), F.array().cast("array<string>")) for k in COEFFICIENT_FIELDS]))).alias("c"),
    ).where("date is not null")
    return named.union(dated).select("date", _coefficient(F.col("c")).alias("coefficient")).where("coefficient is not null")


def daily_coefficients(coefficients: DataFrame, reducer: str = "max") -> DataFrame:
    """(date, value): each day's largest, least or mean coefficient."""
    how = {"max": F.max, "min": F.min, "mean": F.avg}[reducer]
    return coefficients.groupBy("date").agg(how("coefficient").cast("double").alias("value"))


def fan_out_days(daily: DataFrame, spots: DataFrame, run_time: Column, days: int, zone: str = "Europe/Paris") -> DataFrame:
    """(spot_id, valid_time, metric, value): a day's value at each of its local hours in [run_time, + days), for each spot.

    The hours are so many a run; spots are broadcast by Spark only if they are small.
    """
    start = F.date_trunc("hour", run_time)
    hours = daily.sparkSession.range(1).select(F.explode(F.sequence(start, start + F.make_dt_interval(F.lit(days)) - F.expr("interval 1 hour"), F.expr("interval 1 hour"))).alias("valid_time"))
    dated = hours.withColumn("date", F.to_date(F.from_utc_timestamp("valid_time", zone))).join(daily, "date")
    return spots.select("spot_id").join(dated, how="cross").select("spot_id", "valid_time", F.lit("tide_coefficient").alias("metric"), "value")


def expand_days(values: DataFrame, run_time: Column, days: int) -> DataFrame:
    """values with rows of a day or more repeated at each hour of their period inside [hour of run_time, run_time + days).

    Finer rows, and those without resolution_minutes, stay as they are.
    """
    end = F.least(F.col("valid_time") + F.make_dt_interval(mins=F.col("resolution_minutes")), run_time + F.make_dt_interval(F.lit(days)))
    first = F.greatest(F.col("valid_time"), F.date_trunc("hour", run_time))
    coarse = F.coalesce(F.col("resolution_minutes") >= 1440, F.lit(False))
    hours = F.when(coarse & (first < end), F.sequence(first, end - F.expr("interval 1 microsecond"), F.expr("interval 1 hour"))).when(coarse, F.array().cast("array<timestamp>")).otherwise(F.array("valid_time"))
    return values.withColumn("valid_time", F.explode(hours))
