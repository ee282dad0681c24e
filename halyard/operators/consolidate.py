"""Long measurements to one wide row per place and hour, with lineage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.functions.numbers import circular_mean, horizon_hours, local_date, metric_unit, metric_value
from halyard.registry import CIRCULAR, COLUMN, METRICS


def normalize(values: DataFrame) -> DataFrame:
    """values with cleaned, unit-converted value, canonical unit and hour of valid_time."""
    m, u = F.col("metric"), F.col("unit")
    return values.select(*[
        metric_value(m, F.col("value"), u).alias("value") if c == "value"
        else metric_unit(m, u).alias("unit") if c == "unit"
        else F.date_trunc("hour", "valid_time").alias("valid_time") if c == "valid_time"
        else F.col(c)
        for c in values.columns
    ])


def known(values: DataFrame, metrics: Iterable[str] = METRICS) -> DataFrame:
    """Rows of registered metrics that have a value."""
    return values.where(F.col("metric").isin(*metrics) & F.col("value").isNotNull())


def _reduced(metric: str, still: float | None) -> Column:
    v = F.when(F.col("metric") == metric, F.col("value"))
    return circular_mean(v, still) if metric in CIRCULAR else F.avg(v)


def wide_hours(values: DataFrame, run_time: Column, zone: str = "Europe/Paris", metrics: Iterable[str] = METRICS, still: float | None = None) -> DataFrame:
    """One row per spot_id and valid_time: a column per metric, sources, source_count, target_date, horizon.

    Means, on the circle for directions, in one aggregation with partial sums.
    still: the mean of directions that cancel out.
    """
    metrics = tuple(metrics)
    rows = known(values, metrics).groupBy("spot_id", "valid_time").agg(
        *[_reduced(m, still).alias(COLUMN[m]) for m in metrics],
        F.array_sort(F.collect_set("source_code")).alias("sources"),
    )
    return rows.select(
        "spot_id", "valid_time",
        run_time.alias("forecast_run_at"),
        local_date(F.col("valid_time"), zone).alias("target_date"),
        horizon_hours(F.col("valid_time"), run_time).alias("forecast_horizon_hours"),
        F.size("sources").alias("source_count"), "sources",
        *[COLUMN[m] for m in metrics],
    )


def long_means(values: DataFrame, still: float | None = None) -> DataFrame:
    """One row per spot_id, valid_time and metric: the mean proper to the metric; still of directions that cancel out."""
    v = F.col("value")
    both = known(values).groupBy("spot_id", "valid_time", "metric").agg(F.avg(v).alias("plain"), circular_mean(v, still).alias("round"))
    return both.select("spot_id", "valid_time", "metric", F.when(F.col("metric").isin(*CIRCULAR), F.col("round")).otherwise(F.col("plain")).alias("value"))


TRACE = ("source_code", "value", "unit", "raw_variable", "model", "resolution_minutes", "grid_lat", "grid_lon", "run_id")


def provenance(values: DataFrame, mode: str = "compact") -> DataFrame:
    """(spot_id, valid_time, provenance): a map from metric to its lineage.

    compact: method, unit, number of values, distinct sources, least and largest
    value; full: every value's trace as well; none: an empty map.
    """
    fields = [
        F.when(F.col("metric").isin(*CIRCULAR), "circular_mean").otherwise("mean").alias("method"),
        metric_unit(F.col("metric"), F.lit("")).alias("unit"),
        "source_count", "sources", "min", "max",
    ]
    aggs = [
        F.count("*").alias("source_count"),
        F.array_sort(F.collect_set("source_code")).alias("sources"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    if mode == "full":
        present = [c for c in TRACE if c in values.columns]
        aggs.append(F.array_sort(F.collect_list(F.struct(*present))).alias("values"))
        fields.append("values")
    per_metric = known(values).groupBy("spot_id", "valid_time", "metric").agg(*aggs).select("spot_id", "valid_time", "metric", F.struct(*fields).alias("p"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "p"))))
    if mode == "none":
        entries = F.create_map().cast("map<string,string>")
        return known(values).select("spot_id", "valid_time").distinct().withColumn("provenance", entries)
    return per_metric.groupBy("spot_id", "valid_time").agg(entries.alias("provenance"))


def column_coverage(wide: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, n_present, ratio): rows with a value, of all rows."""
    columns = list(columns)
    counted = wide.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in columns])
    long = counted.unpivot(["rows"], columns, "column_name", "n_present")
    return long.select("column_name", "n_present", F.when(F.col("rows") > 0, F.col("n_present") / F.col("rows")).otherwise(0.0).alias("ratio"))


def metric_counts(values: DataFrame) -> DataFrame:
    """(source_code, metric, n) of rows with a value; metric null: the source's total; both null: of all."""
    return values.where("value is not null").rollup("source_code", "metric").agg(F.count("*").alias("n"))
