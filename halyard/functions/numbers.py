"""Number, unit and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halyard.registry import CIRCULAR, METRICS, OWN_UNIT, TO_MS, VELOCITIES


def clean_number(c: Column) -> Column:
    """A double; text that is none, and NaN, are null; infinities stay."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def wrap_degrees(c: Column) -> Column:
    return F.pmod(c, F.lit(360.0))


def metric_value(metric: Column, value: Column, unit: Column) -> Column:
    """Velocities in m/s, directions in [0, 360), others as they are; unknown units change nothing."""
    label = F.lower(F.replace(F.coalesce(unit, F.lit("")), F.lit(" "), F.lit("")))
    factor = F.lit(1.0)
    for name, f in TO_MS.items():
        factor = F.when(label == name, F.lit(f)).otherwise(factor)
    v = clean_number(value)
    return F.when(metric.isin(*VELOCITIES), v * factor).when(metric.isin(*CIRCULAR), wrap_degrees(v)).otherwise(v)


def metric_unit(metric: Column, unit: Column) -> Column:
    out = None
    for m, (_, u) in METRICS.items():
        if m not in OWN_UNIT:
            out = F.when(metric == m, u) if out is None else out.when(metric == m, u)
    return out.otherwise(F.coalesce(unit, F.lit("")))


def vector_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def vector_direction(u: Column, v: Column) -> Column:
    """Where a current flows to, in degrees from north."""
    return F.when(u.isNotNull() & v.isNotNull(), wrap_degrees(F.degrees(F.atan2(u, v)) + 360.0))


def risk_ramp(c: Column, low: float = 3.0, high: float = 10.0) -> Column:
    """0 up to low, 1 from high, linear between; null if high is not above low."""
    if high <= low:
        return F.lit(None).cast("double")
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c - low) / (high - low))))


def horizon_hours(valid: Column, run: Column) -> Column:
    """Whole hours from run to valid, downwards for times before it."""
    return F.floor((F.unix_micros(valid) - F.unix_micros(run)) / 3.6e9).cast("int")


def local_date(ts: Column, zone: str = "Europe/Paris") -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def circular_mean(degrees: Column, still: float | None = None) -> Column:
    """Aggregate: mean direction; still if both components are exactly 0, null without directions."""
    s, c = F.avg(F.sin(F.radians(degrees))), F.avg(F.cos(F.radians(degrees)))
    return F.when((s != 0) | (c != 0), wrap_degrees(F.degrees(F.atan2(s, c)) + 360.0)).when(s.isNotNull(), F.lit(still).cast("double"))
