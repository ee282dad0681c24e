"""User alert conditions over forecast windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.functions.text import normalize_label
from halyard.registry import CONDITION_COLUMNS, DERIVED_CONDITIONS, LABEL_COLUMNS, SCORE_PENALTIES, UNFORECASTABLE_CONDITIONS

KELVIN_FREE = ("air_temperature", "water_temperature", "dew_point")
HEIGHTS = ("wave_height", "swell_height", "secondary_swell_height")
WINDS = ("wind_speed", "wind_gusts")


def _lookup(c: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c]


def condition_field(type_id: Column, label: Column) -> Column:
    """The forecast column of a condition: by its type, itself if derived, none if unforecastable, else by its label."""
    return (
        F.when(type_id.isin(*CONDITION_COLUMNS), _lookup(type_id, CONDITION_COLUMNS))
        .when(type_id.isin(*DERIVED_CONDITIONS), type_id)
        .when(type_id.isin(*UNFORECASTABLE_CONDITIONS), None)
        .otherwise(_lookup(normalize_label(F.coalesce(label, F.lit(""))), LABEL_COLUMNS))
    )


def stored_threshold(threshold: Column, type_id: Column, units: Column) -> Column:
    """A threshold typed in metric or imperial units, in the units forecasts are stored in. Others stay as typed."""
    t = threshold.cast("double")
    imperial = F.coalesce(units, F.lit("metric")) == "imperial"
    return (
        F.when(imperial & type_id.isin(*KELVIN_FREE), (t - 32.0) * 5.0 / 9.0)
        .when(imperial & type_id.isin(*WINDS), t * 0.44704)
        .when(imperial & type_id.isin(*HEIGHTS), t * 0.3048)
        .when(imperial & (type_id == "weather_visibility"), t * 1609.344)
        .when(imperial & (type_id == "precipitation"), t * 25.4)
        .when(type_id.isin(*WINDS), t / 3.6)
        .when(type_id == "weather_visibility", t * 1000.0)
        .otherwise(t)
    )


def holds(value: Column, operator: Column, threshold: Column) -> Column:
    """Whether a value meets a threshold; null for a null value or an unknown operator."""
    return (
        F.when(operator == ">", value > threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "<", value < threshold)
        .when(operator == "<=", value <= threshold)
        .when(operator.isin("=", "=="), value == threshold)
        .when(operator == "!=", value != threshold)
    )


def marine_score(columns: list[str]) -> Column:
    """100 less the penalties of the columns at hand, in tenths; null if all are null."""
    used = [c for c in SCORE_PENALTIES if c in columns]
    score = F.lit(100.0)
    for c in used:
        full, most = SCORE_PENALTIES[c]
        score = score - F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(most), F.col(c) / full * most)), F.lit(0.0))
    any_value = F.coalesce(*[F.col(c) for c in used]).isNotNull() if used else F.lit(False)
    return F.when(any_value, F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 1))


def published_window(forecasts: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (id, from_date, to_date) cut to the published target dates; those outside are left out."""
    span = forecasts.agg(F.min("target_date").alias("_a"), F.max("target_date").alias("_b"))
    cut = asked.crossJoin(F.broadcast(span))
    cut = cut.withColumn("from_date", F.greatest("from_date", "_a")).withColumn("to_date", F.least("to_date", "_b"))
    return cut.where("from_date <= to_date").drop("_a", "_b")


def conditions(alerts: DataFrame, types: DataFrame) -> DataFrame:
    """(alert_id, condition_id, type_id, field, operator, threshold): one row per condition of each alert, as it is evaluated.

    field is null where the type is unknown or has no forecast.
    """
    one = alerts.select(F.col("id").alias("alert_id"), "unit_system", F.explode("alert_conditions").alias("c"))
    flat = one.select("alert_id", "unit_system", F.col("c.id").alias("condition_id"), F.col("c.condition_type_id").alias("type_id"), "c.operator", "c.threshold_value")
    with_type = flat.join(types.select(F.col("id").alias("type_id"), "label", F.lit(True).alias("_known")), "type_id", "left")
    field = F.when(F.col("_known"), condition_field(F.col("type_id"), F.col("label")))
    return with_type.select("alert_id", "condition_id", "type_id", field.alias("field"), "operator", stored_threshold(F.col("threshold_value"), F.col("type_id"), F.col("unit_system")).alias("threshold"))


def first_hits(alerts: DataFrame, types: DataFrame, forecasts: DataFrame, window: DataFrame) -> DataFrame:
    """(alert_id, spot_id, valid_time): the first hour in each alert's window at which all its conditions hold, per spot.

    A condition without a value does not hold; an alert without conditions never
    fires. Alerts and hours meet by spot and day, each window written out as its
    days; of the forecasts only the columns that some condition asks for go
    along (their names, bounded by the registry, are looked up first).
    """
    asked = conditions(alerts, types)
    known = {*CONDITION_COLUMNS.values(), *LABEL_COLUMNS.values()} & set(forecasts.columns)
    used = {r["field"] for r in asked.select("field").distinct().collect()}
    parts = [x for f in sorted(known & used) for x in (F.lit(f), F.col(f).cast("double"))]
    if "condition_score" in used:
        parts += [F.lit("condition_score"), marine_score(forecasts.columns)]
    values = F.create_map(*parts).cast("map<string,double>")
    hours = forecasts.select("spot_id", "target_date", "valid_time", values.alias("values"))
    wanted = alerts.select(F.col("id").alias("alert_id"), F.explode("alert_spots").alias("s")).select("alert_id", F.col("s.spot_id").alias("spot_id"))
    of_alert = asked.groupBy("alert_id").agg(F.collect_list(F.struct("field", "operator", "threshold")).alias("conditions"))
    days = window.select(F.col("id").alias("alert_id"), F.explode(F.sequence("from_date", "to_date")).alias("target_date"))
    met = F.forall("conditions", lambda c: F.coalesce(holds(F.try_element_at("values", F.coalesce(c["field"], F.lit(""))), c["operator"], c["threshold"]), F.lit(False)))
    pairs = wanted.join(of_alert, "alert_id").join(days, "alert_id").join(hours, ["spot_id", "target_date"])
    return pairs.where(met).groupBy("alert_id", "spot_id").agg(F.min("valid_time").alias("valid_time"))


def not_notified(alerts: DataFrame, notifications: DataFrame, day_start: Column) -> DataFrame:
    """Alerts without an e-mail sent since day_start."""
    sent = notifications.where((F.col("notification_type") == "email") & (F.col("status") == "sent") & (F.col("sent_at") >= day_start))
    return alerts.join(sent.select(F.col("alert_id").alias("id")).distinct(), "id", "left_anti")


def recipients(user_ids: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(user_id, email): from the first table, else the second, else null."""
    a = first.select(F.col("id").alias("user_id"), F.col("email").alias("_a"))
    b = second.select(F.col("id").alias("user_id"), F.col("email").alias("_b"))
    return user_ids.join(a, "user_id", "left").join(b, "user_id", "left").select("user_id", F.coalesce(F.nullif("_a", F.lit("")), F.nullif("_b", F.lit(""))).alias("email"))


def digests(hits: DataFrame, forecasts: DataFrame, numbers: list[str]) -> DataFrame:
    """(alert_id, n_spots, spots): one row per alert, its spots in order with formatted numbers, N/A where there is none.

    Numbers are shown as decimals of ten places are, so what the order of a sum
    leaves in a mean's last digits decides no tenth.
    """
    tenths = lambda c: F.coalesce(F.round(F.col(c).try_cast("decimal(20,10)"), 1).cast("string"), F.format_string("%.1f", F.col(c)))
    shown = [F.when(F.col(c).isNull(), "N/A").otherwise(tenths(c)).alias(c) for c in numbers]
    rows = hits.join(forecasts.select("spot_id", "valid_time", *shown), ["spot_id", "valid_time"])
    return rows.groupBy("alert_id").agg(F.count("*").alias("n_spots"), F.array_sort(F.collect_list(F.struct("spot_id", "valid_time", *numbers))).alias("spots"))


def notification_log(digest: DataFrame, emails: DataFrame, now: Column) -> DataFrame:
    """(alert_id, notification_type, status, sent_at): sent where there is an address, else failed."""
    return digest.join(emails, "alert_id", "left").select("alert_id", F.lit("email").alias("notification_type"), F.when(F.col("email").isNotNull(), "sent").otherwise("failed").alias("status"), now.alias("sent_at"))


def run_report(alerts: DataFrame, notified: DataFrame, windows: DataFrame, hits: DataFrame) -> DataFrame:
    """(outcome, n): what became of each alert: already_notified, no_spots, no_window, triggered or quiet."""
    def flag(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(F.col(key).alias("id")).distinct().withColumn(name, F.lit(True))

    rows = alerts.select("id", (F.size("alert_spots") > 0).alias("_spots"))
    for df, key, name in ((notified, "alert_id", "_sent"), (windows, "id", "_window"), (hits, "alert_id", "_hit")):
        rows = rows.join(flag(df, key, name), "id", "left")
    outcome = F.when(F.col("_sent"), "already_notified").when(~F.col("_spots"), "no_spots").when(F.col("_window").isNull(), "no_window").when(F.col("_hit"), "triggered").otherwise("quiet")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def run_counters(alerts: DataFrame, notified: DataFrame, windows: DataFrame, hits: DataFrame, log: DataFrame, forecasts: DataFrame) -> DataFrame:
    """A run in one row: alerts active and triggered, e-mails sent and failed, alerts skipped and why, and the days forecasts reach over.

    log: the run's notifications (alert_id, notification_type, status). An
    alert already notified counts as that and as nothing else.
    """
    became = run_report(alerts, notified, windows, hits)
    n = lambda outcome: F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("n"))), F.lit(0).cast("long"))
    outcomes = became.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("alerts_active"), n("triggered").alias("alerts_triggered"), n("already_notified").alias("skipped_already_sent"),
        n("no_spots").alias("skipped_no_spots"), n("no_window").alias("skipped_no_forecast_overlap"),
    )
    fired = log.where("notification_type = 'email'").join(notified.select("alert_id").distinct(), "alert_id", "left_anti")
    mails = fired.agg(F.count_if(F.col("status") == "sent").alias("emails_sent"), F.count_if(F.col("status") != "sent").alias("emails_failed"))
    days = forecasts.agg(F.min("target_date").alias("min_target_date"), F.max("target_date").alias("max_target_date"))
    return outcomes.join(mails, how="cross").join(days, how="cross")
