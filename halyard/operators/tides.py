"""Tide features of sea-level series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.numbers import local_date
from halyard.staging import stored

LEVEL = "sea_level_height_m"


def derived_coefficients(values: DataFrame, run_time, unit_m: float = 6.10, least_samples: int = 6, zone: str = "Europe/Paris") -> DataFrame:
    """Long rows of tide_coefficient from each local day's sea-level range.

    Counts values of all sources. Days with a direct coefficient have none, nor
    days whose coefficient lies outside 20 to 120. A row stands at every time
    of any metric on that day, whether or not that metric has a value.
    """
    if unit_m <= 0:
        return values.limit(0).select("spot_id", F.lit("").alias("source_code"), "valid_time", F.lit("").alias("metric"), "value", F.lit("").alias("unit"))
    days = values.withColumn("day", local_date(F.col("valid_time"), zone))
    level = F.when(F.col("metric") == "sea_level_height", F.col("value"))
    direct = F.count(F.when(F.col("metric") == "tide_coefficient", F.col("value")))
    ranges = (
        days.groupBy("spot_id", "day")
        .agg(F.count(level).alias("n"), (F.max(level) - F.min(level)).alias("range"), direct.alias("direct"))
        .where((F.col("direct") == 0) & (F.col("n") >= least_samples))
        .select("spot_id", "day", (F.col("range") / unit_m * 100.0).alias("value"))
        .where(F.col("value").between(20.0, 120.0))
    )
    times = days.select("spot_id", "day", "valid_time").distinct()
    return times.join(ranges, ["spot_id", "day"]).select(
        "spot_id", F.lit("derived_tide_range").alias("source_code"), "valid_time", F.lit("tide_coefficient").alias("metric"), "value", F.lit("coef").alias("unit")
    )


def daily_range(wide: DataFrame, range_100_m: float = 6.10) -> DataFrame:
    """wide with the least, largest and range of each spot's levels on each target_date, and a coefficient of 20 to 120 from it.

    Days with fewer than two levels, and rows without one, have none.
    """
    day = W.partitionBy("spot_id", "target_date")
    has = F.col(LEVEL).isNotNull() & (F.count(LEVEL).over(day) >= 2)
    low, high = F.min(LEVEL).over(day), F.max(LEVEL).over(day)
    near = F.bround((high - low) / range_100_m * 100.0, 0)
    return wide.select(
        "*",
        F.when(has, low).alias("tide_min_height_m"),
        F.when(has, high).alias("tide_max_height_m"),
        F.when(has, high - low).alias("tide_range_m"),
        F.when(has, F.greatest(F.lit(20.0), F.least(F.lit(120.0), near))).alias("tide_coefficient_approx"),
    )


#: Days of a block: what one task has of a place at once.
BLOCK_DAYS = 30


def events(wide: DataFrame) -> DataFrame:
    """wide with tide_event (high, low), tide_phase and the next event at or after each row.

    Neighbours are rows with a level, whatever their distance in time; the first
    and last of a spot are no event, the last has no phase.

    A spot's series is cut into blocks of days, which are worked on apart. The
    levels at a block's ends, and then its first event, come from one line a
    spot and block; where neighbour or next event lie beyond a block's end,
    these lines have them. So no task holds a spot's whole series.
    """
    cur, block = F.col(LEVEL), F.floor(F.unix_seconds("valid_time") / (BLOCK_DAYS * 86_400)).alias("_block")
    levels = wide.where(cur.isNotNull()).select("*", block)
    own, of_spot = W.partitionBy("spot_id", "_block").orderBy("valid_time"), W.partitionBy("spot_id").orderBy("_block")
    ends = levels.groupBy("spot_id", "_block").agg(F.min_by(LEVEL, "valid_time").alias("_first"), F.max_by(LEVEL, "valid_time").alias("_last"))
    beyond = ends.select("spot_id", "_block", F.lag("_last").over(of_spot).alias("_before"), F.lead("_first").over(of_spot).alias("_after"))
    b, a = F.coalesce(F.col("_lag"), F.col("_before")), F.coalesce(F.col("_lead"), F.col("_after"))
    kind = F.when((cur >= b) & (cur > a), "high").when((cur <= b) & (cur < a), "low")
    phase = F.when(a > cur, "rising").when(a < cur, "falling").when(a == cur, "slack")
    beside = levels.withColumns({"_lag": F.lag(LEVEL).over(own), "_lead": F.lead(LEVEL).over(own)}).join(beyond, ["spot_id", "_block"])
    marked = stored(beside.select(*wide.columns, "_block", kind.alias("tide_event"), phase.alias("tide_phase")), "tide-events")
    event = F.when(F.col("tide_event").isNotNull(), F.struct("tide_event", "valid_time", cur))
    firsts = marked.groupBy("spot_id", "_block").agg(F.min_by(event, F.when(F.col("tide_event").isNotNull(), F.col("valid_time"))).alias("_event"))
    # read backwards, so that each row takes over what the one after it has
    back, own_back = W.partitionBy("spot_id").orderBy(F.desc("_block")), W.partitionBy("spot_id", "_block").orderBy(F.desc("valid_time"))
    later = firsts.select("spot_id", "_block", F.last("_event", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1)).alias("_later"))
    within = F.last(event, ignorenulls=True).over(own_back.rowsBetween(W.unboundedPreceding, 0))
    done = marked.withColumn("_next", within).join(later, ["spot_id", "_block"]).withColumn("_next", F.coalesce("_next", "_later"))
    done = done.select(
        *wide.columns, "tide_event", "tide_phase",
        F.col("_next.tide_event").alias("next_tide_event_type"),
        F.col("_next.valid_time").alias("next_tide_event_time"),
        F.col(f"_next.{LEVEL}").alias("next_tide_event_height_m"),
    )
    return done.unionByName(wide.where(cur.isNull()), allowMissingColumns=True)
