import calendar
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from halyard.functions import numbers
from halyard.operators import alerts, consolidate, merge, tides, training
from halyard.plans import environment
from halyard.plans import landing as plans
from halyard.sources import grid, landing, payloads
from halyard.streaming import streams

SF = "/root/testdata/sf0.001"
ROW = "spot_id string, source_code string, valid_time string, metric string, value double, unit string"
def run():
    return F.to_timestamp(F.lit("2026-05-19 16:29:00"))



def values(spark, rows):
    return spark.createDataFrame(rows, ROW).withColumn("valid_time", F.to_timestamp("valid_time"))


def at(hour, metric, value, source="a", unit="m", spot="s", day=1):
    return (spot, source, f"2026-05-{day:02d} {hour:02d}:00:00", metric, value, unit)


def test_mean_lineage_and_sources(spark):
    v = values(spark, [at(8, "wind_speed", 4.0, "source-a", "m/s"), at(8, "wind_speed", 6.0, "source-b", "m/s"), at(8, "unknown", 1.0), at(8, "precipitation", None)])
    r = consolidate.wide_hours(v, run()).first()
    assert (r["wind_speed_ms"], r["source_count"], r["sources"], r["precipitation_mm"]) == (5.0, 2, ["source-a", "source-b"], None)
    compact = consolidate.provenance(v).first()["provenance"]["wind_speed"]
    assert (compact["method"], compact["source_count"], compact["min"], compact["max"]) == ("mean", 2, 4.0, 6.0)
    assert len(consolidate.provenance(v, "full").first()["provenance"]["wind_speed"]["values"]) == 2
    assert consolidate.provenance(v, "none").first()["provenance"] == {}
    assert consolidate.wide_hours(v.limit(0), run()).count() == 0


@pytest.mark.parametrize(("degrees", "near"), [([350.0, 10.0], 0.0), ([-10.0], 350.0), ([90.0, 180.0], 135.0)])
def test_circular_mean(spark, degrees, near):
    got = spark.createDataFrame([(d,) for d in degrees], "d double").agg(numbers.circular_mean(F.col("d"))).first()[0]
    assert math.cos(math.radians(got - near)) > 1 - 1e-9


@pytest.mark.parametrize(("metric", "value", "unit", "want"), [("wind_speed", 36.0, "km/h", 10.0), ("wind_speed", 10.0, "K n", 5.14444), ("wind_gusts", 5.0, "furlong", 5.0), ("wave_direction", -10.0, "deg", 350.0), ("salinity", float("nan"), "psu", None)])
def test_units(spark, metric, value, unit, want):
    got = spark.createDataFrame([(metric, value, unit)], "m string, v double, u string").select(numbers.metric_value(F.col("m"), F.col("v"), F.col("u"))).first()[0]
    assert got == (want if want is None else pytest.approx(want))


def test_scalars(spark):
    one = spark.range(1)
    ts = lambda s: F.to_timestamp(F.lit(s))
    r = one.select(
        numbers.horizon_hours(ts("2026-05-01 07:30:00"), ts("2026-05-01 08:00:00")).alias("before"),
        numbers.risk_ramp(F.lit(6.5)).alias("risk"),
        numbers.risk_ramp(F.lit(6.5), 5, 5).alias("none"),
        numbers.local_date(ts("2026-05-01 22:30:00")).alias("day"),
        numbers.clean_number(F.lit("inf")).alias("inf"),
        numbers.vector_direction(F.lit(1.0), F.lit(0.0)).alias("east"),
    ).first()
    assert (r["before"], r["risk"], r["none"], r["day"], r["inf"], r["east"]) == (-1, 0.5, None, dt.date(2026, 5, 2), math.inf, 90.0)


def test_derived_tide(spark):
    levels = [at(h, "sea_level_height", x) for h, x in enumerate([0.0, 1.2, 2.4, 3.66, 2.2, 1.0])]
    got = tides.derived_coefficients(values(spark, [*levels, at(7, "precipitation", None)]), run()).collect()
    assert len(got) == 7 and {round(r["value"], 6) for r in got} == {60.0} and {r["source_code"] for r in got} == {"derived_tide_range"}
    assert tides.derived_coefficients(values(spark, [*levels, at(3, "tide_coefficient", 77.0)]), run()).count() == 0
    assert tides.derived_coefficients(values(spark, levels[:5]), run()).count() == 0


def test_tide_fields(spark):
    v = values(spark, [at(h, "sea_level_height", x) for h, x in ((0, -1.0), (6, 2.0), (12, -1.0), (18, 1.0))] + [at(3, "wind_speed", 1.0)])
    wide = consolidate.wide_hours(v, run())
    first = {r["valid_time"].hour: r for r in tides.events(tides.daily_range(wide)).collect()}
    r = first[0]
    assert (r["tide_min_height_m"], r["tide_max_height_m"], r["tide_range_m"], r["tide_coefficient_approx"]) == (-1.0, 2.0, 3.0, 49.0)
    assert (r["tide_phase"], r["next_tide_event_type"], r["next_tide_event_height_m"], r["next_tide_event_time"].hour) == ("rising", "high", 2.0, 6)
    assert (first[12]["tide_event"], first[18]["tide_event"], first[18]["tide_phase"], first[18]["next_tide_event_type"]) == ("low", None, None, None)
    assert first[3]["tide_range_m"] is None and first[3]["tide_phase"] is None


def test_tides_of_one_place_over_many_blocks(spark):
    """Blocks meet as if there were none: series longer than one, with gaps of blocks, levels that stay, and blocks without an event."""
    import random

    rng, rows = random.Random(4), []
    for spot, hours in (("year", range(0, 9000, 3)), ("gaps", [h for h in range(0, 40_000, 5) if h % 7000 < 900]), ("few", [10, 900, 5000, 5001]), ("one", [77])):
        level = 0.0
        for h in hours:
            level = rng.choice((level, level, level + 1, level - 1)) if spot != "gaps" else float(h)
            rows.append((spot, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), level if rng.random() < 0.9 else None, h))
    wide = spark.createDataFrame(rows, "spot_id string, valid_time timestamp, sea_level_height_m double, n int")
    want = {}
    for spot in {r[0] for r in rows}:
        s = sorted((t, v, n) for p, t, v, n in rows if p == spot and v is not None)
        kinds = []
        for i, (_, v, _) in enumerate(s):
            b, a = s[i - 1][1] if i else None, s[i + 1][1] if i + 1 < len(s) else None
            kinds.append(None if b is None or a is None else "high" if v >= b and v > a else "low" if v <= b and v < a else None)
        following = None
        for i in reversed(range(len(s))):
            following = (kinds[i], s[i][0], s[i][1]) if kinds[i] else following
            a = s[i + 1][1] if i + 1 < len(s) else None
            want[spot, s[i][2]] = (kinds[i], None if a is None else "rising" if a > s[i][1] else "falling" if a < s[i][1] else "slack", *(following or (None, None, None)))
    got = tides.events(wide).collect()
    fields = ("tide_event", "tide_phase", "next_tide_event_type", "next_tide_event_time", "next_tide_event_height_m")
    assert len(got) == len(rows)
    assert {(r["spot_id"], r["n"]): tuple(r[f] for f in fields) for r in got if r["sea_level_height_m"] is not None} == want
    assert all(r[f] is None for r in got if r["sea_level_height_m"] is None for f in fields)


FORECAST = {"wind_gusts_ms": 11.0, "weather_visibility_m": 9000.0, "swell_wave_height_m": 1.8, "secondary_swell_wave_height_m": 0.7}


@pytest.mark.parametrize(
    ("kind", "operator", "threshold", "units", "fires"),
    [
        ("wind_gusts", ">=", 38.0, "metric", True),
        ("weather_visibility", ">=", 8.0, "metric", True),
        ("swell_height", ">", 1.5, "metric", True),
        ("secondary_swell_height", ">", 0.5, None, True),
        ("wind_gusts", ">=", 24.0, "imperial", True),
        ("visibility", ">", 1.0, "metric", False),
        ("wind_gusts", "~", 1.0, "metric", False),
        ("no such type", ">", 1.0, "metric", False),
    ],
)
def test_alert_conditions(spark, kind, operator, threshold, units, fires):
    forecast = spark.createDataFrame([("s", dt.date(2026, 5, 22), dt.datetime(2026, 5, 22, 8), *FORECAST.values())], "spot_id string, target_date date, valid_time timestamp, " + ", ".join(f"{c} double" for c in FORECAST))
    schema = "id string, user_id string, unit_system string, alert_conditions array<struct<id:string,condition_type_id:string,operator:string,threshold_value:double>>, alert_spots array<struct<spot_id:string>>"
    a = spark.createDataFrame([("a", "u", units, [("1", kind, operator, threshold)], [("s",), ("t",)]), ("none", "u", units, [], [("s",)])], schema)
    types = spark.createDataFrame([(k, k) for k in ("wind_gusts", "weather_visibility", "swell_height", "secondary_swell_height", "visibility")], "id string, label string")
    asked = a.select("id", F.lit("2026-05-22").cast("date").alias("from_date"), F.lit("2026-05-27").cast("date").alias("to_date"))
    hits = alerts.first_hits(a, types, forecast, alerts.published_window(forecast, asked)).collect()
    assert [(r["alert_id"], r["spot_id"]) for r in hits] == ([("a", "s")] if fires else [])


def test_score_and_window(spark):
    f = spark.createDataFrame([(0.4, 2.0, 4.0, 0.1, 0.0), (None,) * 5], "wave_height_m double, wind_speed_ms double, wind_gusts_ms double, current_speed_ms double, precipitation_mm double")
    good, none = (r[0] for r in f.select(alerts.marine_score(f.columns)).collect())
    assert good >= 70 and none is None
    days = spark.createDataFrame([(dt.date(2026, 5, 22),), (dt.date(2026, 5, 25),)], "target_date date")
    asked = spark.createDataFrame([("in", dt.date(2026, 5, 22), dt.date(2026, 5, 27)), ("out", dt.date(2026, 5, 27), dt.date(2026, 5, 28))], "id string, from_date date, to_date date")
    assert [(r["id"], r["to_date"]) for r in alerts.published_window(days, asked).collect()] == [("in", dt.date(2026, 5, 25))]


def test_labels_resolve(spark):
    got = spark.createDataFrame([("x", "Température de l'eau"), ("y", "Coef de Marée "), ("z", "?")], "t string, l string").select(alerts.condition_field(F.col("t"), F.col("l"))).collect()
    assert [r[0] for r in got] == ["water_temperature_c", "tide_coefficient", None]


def test_training_row(spark):
    visit = dt.datetime(2026, 5, 14, 8, 30)
    obs = spark.createDataFrame([("o", "d", None, 8.0, None, None, visit, visit), ("p", None, None, 8.0, None, None, visit, visit)], "id string, dive_id string, spot_id string, estimated_visibility double, latitude double, longitude double, visited_at timestamp, created_at timestamp")
    dives = spark.createDataFrame([("d", "s", "cover", None, "shore")], "id string, spot_id string, cover_image_url string, cover_image_path string, dive_type string")
    spots = spark.createDataFrame([("s", "Spot", 48.0, 48.2, -4.6, -4.4)], "id string, name string, latitude_min double, latitude_max double, longitude_min double, longitude_max double")
    images = spark.createDataFrame([("o", "late", None, 2, True, visit), ("o", "", "best", 1, True, visit), ("o", "plain", None, 0, False, visit)], "dive_spot_id string, image_url string, image_path string, position int, use_for_visibility boolean, created_at timestamp")
    forecasts = spark.createDataFrame([("s", dt.datetime(2026, 5, 14, 8), 1.0), ("s", dt.datetime(2026, 5, 14, 8, 45), 2.0), ("s", dt.datetime(2026, 5, 14, 9), 3.0)], "spot_id string, valid_time timestamp, x double")
    rows = training.training_rows(obs, dives, spots, images, forecasts).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (round(r["latitude"], 6), round(r["longitude"], 6), r["image"], r["x"], r["estimated_visibility"]) == (48.1, -4.5, "best", 2.0, 8.0)


def test_merges(spark):
    old = spark.createDataFrame([("a", 8, "t0"), ("b", 1, "t0")], "k string, v int, created string")
    new = spark.createDataFrame([("a", 12, "t1"), (None, 5, "t1"), ("c", 3, "t1")], "k string, v int, created string")
    assert sorted(map(tuple, merge.upsert(old, new, ["k"], ("created",)).collect())) == [("a", 12, "t0"), ("b", 1, "t0"), ("c", 3, "t1")]
    latest, delta = merge.cumulative_merge(old, new.where("k is not null"), old.limit(0), ["k"])
    assert {r["k"]: r["v"] for r in latest.collect()} == {"a": 12, "b": 1, "c": 3} and delta.count() == 3


RUNS = [("2026-05-14", "08", "a"), ("2026-05-14", "09", "b"), ("2026-05-13", "20", "a")]


def test_runs(spark):
    v = spark.createDataFrame(RUNS, "run_date string, run_hour string, source_code string")
    now = F.to_timestamp(F.lit("2026-05-14 10:00:00"))
    assert [tuple(r) for r in landing.latest_run(v, now, 2, ["a"]).select("run_hour", "source_code").collect()] == [("08", "a")]
    assert landing.latest_run(v, now, 1, ["a"]).count() == 0
    with pytest.raises(ValueError):
        landing.pick_run(v, "2026-05-14", None)


def test_hours_of_a_daily_row(spark):
    v = spark.createDataFrame([("s", dt.datetime(2026, 5, 19), 1440), ("s", dt.datetime(2026, 5, 1), 60), ("s", dt.datetime(2026, 5, 2), None), ("s", dt.datetime(2026, 5, 2), 1440)], "spot_id string, valid_time timestamp, resolution_minutes int")
    got = payloads.expand_days(v, run(), 2).collect()
    assert sorted(r["valid_time"].hour for r in got if r["valid_time"].day == 19) == list(range(16, 24)) and len(got) == 10


def test_coefficients(spark):
    one = lambda s: spark.createDataFrame([(s,)], "payload string")
    keyed = payloads.flatten_keyed(one('{"data":[{"date":"2026-05-01","coefficients":[82,83]},{"datetime":"2026-05-02T00:00:00","coefficient":"91"},{"date":"2026-05-03","coef":"200"}]}'))
    assert sorted((str(r["date"]), r["coefficient"]) for r in keyed.collect()) == [("2026-05-01", 82), ("2026-05-01", 83), ("2026-05-02", 91)]
    matrix = payloads.flatten_matrix(one('[[["69","74"],["79","84"]],[["84","89"]]]'), F.lit("2026-01-01").cast("date"))
    assert sorted((str(r["date"]), r["coefficient"]) for r in matrix.collect()) == [("2026-01-01", 69), ("2026-01-01", 74), ("2026-01-02", 79), ("2026-01-02", 84), ("2026-02-01", 84), ("2026-02-01", 89)]
    spots = spark.createDataFrame([("s",)], "spot_id string")
    day = spark.createDataFrame([(dt.date(2026, 5, 1), 82), (dt.date(2026, 5, 1), 84)], "date date, coefficient int")
    hours = payloads.fan_out_days(payloads.daily_coefficients(day), spots, F.to_timestamp(F.lit("2026-04-30 22:00:00")), 1).collect()
    assert len(hours) == 24 and {r["value"] for r in hours} == {84.0}


def test_a_matrix_comes_in_many_payloads(spark, monkeypatch):
    seen, flatten = [], payloads.flatten_matrix
    monkeypatch.setattr(payloads, "flatten_matrix", lambda p, anchor: seen.append(p) or flatten(p, anchor))
    sf = "/root/testdata/sf0.01"
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet")
    months = [r[0] for r in suppliers.where("s_suppkey % 130 between 20 and 120").select("s_nationkey").distinct().collect()]
    days = sum(calendar.monthrange(2026 + m // 12, m % 12 + 1)[1] for m in months)  # the first nation is January 2026
    assert plans.matrix_flatten(spark, sf).count() == days > 0
    assert seen[0].count() == suppliers.count() > 1 and seen[0].select(F.max(F.length("payload"))).first()[0] < 1000


def test_nearest_of_a_long_axis(spark):
    """An axis of a hundred thousand values, and points between, on, before and after them."""
    import bisect
    import random

    rng = random.Random(6)
    axis = sorted({round(rng.uniform(-500, 500), 3) for _ in range(100_000)})
    points = [rng.uniform(-600, 600) for _ in range(300)] + rng.sample(axis, 20) + [(axis[5] + axis[6]) / 2, -1e9, 1e9]
    values = spark.createDataFrame([(x,) for x in axis], "lat double").union(spark.createDataFrame([(None,), (float("nan"),)], "lat double"))
    got = {r["c"]: r["lat"] for r in grid.nearest_values(spark.createDataFrame([(x,) for x in [*points, points[0], None]], "c double"), "c", values, "lat").collect()}

    def nearest(x):
        i = bisect.bisect_left(axis, x)
        return min(axis[max(i - 1, 0) : i + 1], key=lambda v: (abs(v - x), v))

    assert got == {x: nearest(x) for x in points}
    assert grid.nearest_values(spark.createDataFrame([(1.0,)], "c double"), "c", values.limit(0), "lat").count() == 0


def put(spark, path, batches):
    from halyard.streaming import versions

    for batch, rows in enumerate(batches):
        folder = versions.folder(batch)
        spark.createDataFrame(rows, "k string, n int, v string").coalesce(1).withColumn("_batch", F.lit(batch).cast("long")).write.parquet(f"{path}/{folder}")
        versions.publish(spark, path, lambda live: [*live, folder])


def test_current_rows_go_by_sequence(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    put(spark, path, [[("a", 5, "new"), ("b", 1, "x")], [("a", 3, "late"), ("b", 2, "y")]])
    assert sorted(tuple(r) for r in streams.current_rows(spark, path, ["k"], "n").collect()) == [("a", 5, "new"), ("b", 2, "y")]
    assert sorted(r["n"] for r in streams.current_rows(spark, path, ["k"]).collect()) == [2, 3]


def test_upsert_query_reads_the_table(spark, monkeypatch):
    from halyard.streaming import versions

    seen, current = [], streams.current_rows
    monkeypatch.setattr(streams, "current_rows", lambda s, path, *a: seen.append((path, a)) or current(s, path, *a))
    got = {r["user_id"]: r["event_id"] for r in plans.stream_upsert(spark, SF).collect()}
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert got == {r[0]: r[1] for r in events.groupBy("user_id").agg(F.max("event_id")).collect()}
    path, how = seen[0]
    table = spark.read.parquet(*[f"{path}/{f}" for f in versions.live(spark, path)])
    assert how == (["user_id"], "event_id") and table.select("_batch").distinct().count() == 3
    assert table.groupBy("_batch", "user_id").count().where("count > 1").count() == 0


def test_column_arrays(spark):
    p = spark.createDataFrame([("s", '{"hourly":{"time":["2026-05-01T00:00","bad","2026-05-01T02:00"],"w":[36,1,null],"r":[1.5]},"hourly_units":{"w":"km/h"}}'), ("t", "no json")], "spot_id string, payload string")
    got = sorted((r["valid_time"].hour, r["metric"], r["value"]) for r in payloads.flatten_hourly(p, {"w": "wind_speed", "r": "precipitation"}).collect())
    assert got == [(0, "precipitation", 1.5), (0, "wind_speed", 10.0)]


def test_a_batch_of_another_size_is_an_error(spark):
    batch = spark.createDataFrame([(1, "[{}]")], "batch_id int, payload string")
    spots = spark.createDataFrame([(1, 0, "s"), (1, 1, "t")], "batch_id int, position int, spot_id string")
    with pytest.raises(Exception, match="differ in number"):
        payloads.zip_batch(batch, spots).collect()


def test_grid(spark):
    g = spark.createDataFrame([(float(a), float(o), d, a * 10 + o + d) for a in range(3) for o in range(3) for d in (0.0, 5.0)], "lat double, lon double, depth double, value double")
    spots = spark.createDataFrame([("s", 1.4, 0.6)], "spot_id string, latitude double, longitude double")
    near = grid.surface(grid.nearest_cells(g, spots), ["spot_id"]).first()
    assert (near["lat"], near["lon"], near["value"]) == (1.0, 1.0, 11.0)
    assert grid.inside_box(g, spots.limit(0)).count() == 0 and grid.inside_box(g, spots, 0.5).count() == 2
    assert grid.first_available(["b"], {"x": ("a", "b"), "y": ("c",)}) == {"x": "b"}


BATCHES = [[("1", 5, "a"), ("2", 1, "b")], [("1", 3, "old"), ("3", 1, "c")], [("2", 2, "d")], [("3", 0, "late")]]


def test_versions_are_put_together_without_loss(spark, tmp_path):
    from halyard.streaming import versions

    path = f"file://{tmp_path}/t"
    put(spark, path, BATCHES)
    read = lambda seq: sorted(tuple(r) for r in streams.current_rows(spark, path, ["k"], seq).select("k", "v").collect())
    by_seq, by_batch = read("n"), read(None)
    assert by_seq == [("1", "a"), ("2", "d"), ("3", "c")] and by_batch == [("1", "old"), ("2", "d"), ("3", "late")]
    streams.compact_rows(spark, path, ["k"], 2, "n")
    streams.compact_rows(spark, path, ["k"], 2, "n")
    assert read("n") == by_seq and sorted(versions.batches_of(f) for f in versions.live(spark, path)) == [(0, 2), (3, 3)]
    streams.compact_rows(spark, path, ["k"], 3, "n")
    assert read("n") == by_seq and [versions.batches_of(f) for f in versions.live(spark, path)] == [(0, 3)]


def test_a_read_begun_before_compaction_ends_with_its_rows(spark, tmp_path):
    from halyard.streaming import versions

    path = f"file://{tmp_path}/t"
    put(spark, path, BATCHES)
    before = streams.current_rows(spark, path, ["k"], "n")
    want = [("1", 5, "a"), ("2", 2, "d"), ("3", 1, "c")]
    rows = before.orderBy("k").toLocalIterator()
    first = tuple(next(rows))
    streams.compact_rows(spark, path, ["k"], 3, "n")
    assert versions.vacuum(spark, path, 1.0) == []  # folders named within the hour stay
    assert [first, *map(tuple, rows)] == want and sorted(map(tuple, before.collect())) == want
    gone = versions.vacuum(spark, path, -1.0)
    assert len(gone) == 4 and [x.name for x in (tmp_path / "t" / "_manifests").iterdir() if not x.name.startswith(".")] == ["5"]
    assert sorted(map(tuple, streams.current_rows(spark, path, ["k"], "n").collect())) == want


def test_writers_of_manifests_do_not_lose_each_other(spark, tmp_path):
    from halyard.streaming import versions

    path = f"file://{tmp_path}/t"
    versions.publish(spark, path, lambda live: ["v0-0-a"])

    def slow(live):
        if live == ["v0-0-a"]:  # another writer comes first
            versions.publish(spark, path, lambda live: [*live, "v1-1-b"])
        return [*live, "v2-2-c"]

    versions.publish(spark, path, slow)
    assert versions.live(spark, path) == ["v0-0-a", "v1-1-b", "v2-2-c"]
    (tmp_path / "t" / "_manifests" / "9").write_text("v9-9-z\n")  # cut off while it was written
    assert versions.live(spark, path) == ["v0-0-a", "v1-1-b", "v2-2-c"]
    versions.publish(spark, path, lambda live: live[:1])
    assert versions.live(spark, path) == ["v0-0-a"]


def test_a_batch_that_runs_again_takes_its_own_place(spark, tmp_path):
    from halyard.streaming import versions

    path = f"file://{tmp_path}/t"
    put(spark, path, BATCHES)
    spark.createDataFrame(BATCHES[3], "k string, n int, v string").write.parquet(f"{tmp_path}/in")
    stream = streams.landed_stream(spark, f"{tmp_path}/in", "k string, n int, v string", "parquet")
    streams.upsert_stream(stream, path, ["k"], f"{tmp_path}/marks", "n").awaitTermination()
    assert sorted(versions.batches_of(f) for f in versions.live(spark, path)) == [(n, n) for n in range(4)]
    assert {r["k"]: r["v"] for r in streams.current_rows(spark, path, ["k"]).collect()} == {"1": "old", "2": "d", "3": "late"}


def files(folder):
    return {str(f.relative_to(folder)): (f.stat().st_mtime_ns, f.stat().st_ino) for f in folder.rglob("*.parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path, schema = f"file://{tmp_path}/t", "day date, k string, v int, made string"
    day = lambda n: dt.date(2026, 5, n)
    new = spark.createDataFrame([(day(1), "a", 1, "first"), (day(2), "b", 2, "first"), (day(3), "c", 3, "first"), (None, "n", 4, "first")], schema)
    assert merge.upsert_table(spark, path, new, ["k"], "day") == 4
    before = files(tmp_path / "t")
    more = spark.createDataFrame([(day(2), "b", 7, "second"), (day(2), "b", 9, "second"), (day(2), "d", 5, "second"), (day(4), "e", 6, "second"), (day(1), None, 8, "second"), (None, "n", 1, "second")], schema)
    assert merge.upsert_table(spark, path, more, ["k"], "day", ("made",), "v") == 3
    after = files(tmp_path / "t")
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in same} == {"day=2026-05-01", "day=2026-05-03"} and len(after) == 5
    got = sorted((r["k"], r["v"], r["made"], r["day"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, "first", day(1)), ("b", 9, "first", day(2)), ("c", 3, "first", day(3)), ("d", 5, "second", day(2)), ("e", 6, "second", day(4)), ("n", 1, "first", None)]
    # folders whose names read as numbers are told as texts if the rows have texts
    texts = f"file://{tmp_path}/s"
    for v in (1, 2):
        assert merge.upsert_table(spark, texts, spark.createDataFrame([("01", "a", v), ("1", "b", v)][: 3 - v], "part string, k string, v int"), ["k"], "part") == 3 - v
    kept = spark.read.schema("k string, v int, part string").parquet(texts)
    assert sorted(map(tuple, kept.collect())) == [("a", 2, "01"), ("b", 1, "1")]
    # a partition left without rows goes
    assert merge.rewrite_partitions(spark, path, "day", spark.createDataFrame([(day(3),)], "day date"), lambda rows: rows.limit(0)) == 1
    assert not (tmp_path / "t" / "day=2026-05-03").exists() and spark.read.parquet(path).count() == 5


def test_retention_drops_days_and_writes_one(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [(h, dt.datetime(2026, 5, 1 + h // 24, h % 24), dt.date(2026, 5, 1 + h // 24)) for h in range(96)]
    spark.createDataFrame(rows, "n int, valid_time timestamp, day date").repartition("day").write.partitionBy("day").parquet(path)
    before = files(tmp_path / "t")
    merge.expire_table(spark, path, "day", F.to_timestamp(F.lit("2026-05-03 06:00:00")))
    after = files(tmp_path / "t")
    assert {f for f in before if after.get(f) == before[f]} == {f for f in before if "day=2026-05-04" in f}
    assert {f.split("/")[0] for f in after} == {"day=2026-05-03", "day=2026-05-04"}
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == list(range(54, 96))


def test_new_rows_of_one_key_count_once(spark):
    old = spark.createDataFrame([("a", 1, "x")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 2, "b"), ("a", 2, "c"), ("a", 1, "z"), ("b", 5, None), ("b", None, "q")], "k string, v int, w string")
    assert sorted(map(tuple, merge.upsert(old, new, ["k"]).collect())) == [("a", 2, "c"), ("b", 5, None)]
    assert sorted(map(tuple, merge.upsert(old, new, ["k"], (), "w").collect())) == [("a", 1, "z"), ("b", None, "q")]


def test_children_are_replaced_only_by_whole_ones(spark):
    old = spark.createDataFrame([(p, "old", "u") for p in (1, 2, 3, 4)], "parent int, quote string, source_url string")
    new = spark.createDataFrame([(1, "new", "u"), (1, None, "u"), (2, " \u00a0", "u"), (3, "new", ""), (5, "new", "u")], "parent int, quote string, source_url string")
    got = sorted(tuple(r)[:2] for r in merge.replace_children(old, new, "parent").collect())
    assert got == [(1, "new"), (2, "old"), (3, "old"), (4, "old"), (5, "new")]


def test_a_history_is_written_by_bucket(spark, tmp_path):
    from halyard.operators import versions

    path, now = f"file://{tmp_path}/h", F.to_timestamp(F.lit("2026-03-01 00:00:00"))
    rules = spark.createDataFrame([(f"r{i}", f"f{i}") for i in range(40)], "rule_key string, rule_fingerprint string")
    assert versions.sync_table(spark, path, rules, "run0", now, 8) == 8
    before = files(tmp_path / "h")
    one = spark.createDataFrame([("r7", "other")], "rule_key string, rule_fingerprint string")
    assert versions.sync_table(spark, path, one, "run1", now, 8) == 1
    after = files(tmp_path / "h")
    assert len({f.split("/")[0] for f in before if after.get(f) == before[f]}) == 7
    got = {(r["rule_fingerprint"], r["is_current"]) for r in spark.read.parquet(path).where("rule_key = 'r7'").collect()}
    assert got == {("f7", False), ("other", True)} and spark.read.parquet(path).count() == 41


def test_a_missing_catalogue_is_empty_and_other_faults_are_not(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    from halyard.sources import landing

    assert landing.read_catalogue(spark, f"{tmp_path}/none.json", "id string").count() == 0
    with pytest.raises(PySparkException):
        landing.read_catalogue(spark, f"{tmp_path}/none.json", "id string", required=True)
    with pytest.raises(Exception, match="nosuchscheme"):
        landing.read_catalogue(spark, "nosuchscheme://x/none.json", "id string")
    (tmp_path / "c.json").write_text('[{"id": "a"}, 7, "x", {"id": "b"}]')
    assert sorted(r[0] for r in landing.read_catalogue(spark, f"{tmp_path}/c.json", "id string").collect()) == ["a", "b"]


def test_directions_that_cancel_out(spark, tmp_path):
    """The operator gives null; the queries give 0, as their SQL, and count it."""
    assert spark.createDataFrame([(0.0,), (180.0,)], "d double").select(numbers.circular_mean(F.lit(None).cast("double"), 0.0)).first()[0] is None
    rows = [(2 * n + k, dt.datetime(2024, 1, 3, 1), 2 * n, "view", n / 100 + 25.0 * k, '{"k": 1}') for n in range(64) for k in (0, 1)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    values = environment.normal(spark, str(tmp_path))
    gone = {r["spot_id"] for r in consolidate.long_means(values).where("value is null").collect()}
    assert gone
    long = {r["spot_id"]: r["value"] for r in environment.QUERIES["consolidate_circular"](spark, str(tmp_path)).collect()}
    wide = {r["spot_id"]: r["wind_direction_deg"] for r in environment.QUERIES["consolidate_wide"](spark, str(tmp_path)).collect()}
    assert len(long) == len(wide) == 64 and all(long[s] == wide[s] == 0.0 for s in gone)
    shares = {r["column_name"]: r["n_present"] for r in environment.QUERIES["column_coverage"](spark, str(tmp_path)).collect()}
    assert shares["wind_direction_deg"] == 64


def test_digest_shows_a_half_way_mean_whatever_the_sums_order(spark):
    """15.65 as the sum of its parts in either order, some of it just below; numbers beyond decimals, and none."""
    mean = (15.62 + 15.68) / 2
    hours = [("a", 1, mean), ("b", 1, 15.65), ("c", 1, -0.04), ("d", 1, 1e12), ("e", 1, None), ("f", 1, 9.64)]
    forecasts = spark.createDataFrame(hours, "spot_id string, valid_time int, t double")
    hits = forecasts.select(F.lit(1).alias("alert_id"), "spot_id", "valid_time")
    got = alerts.digests(hits, forecasts, ["t"]).first()
    assert mean != 15.65 and [s["t"] for s in got["spots"]] == ["15.7", "15.7", "0.0", "1000000000000.0", "N/A", "9.6"]


def test_nearest_surface_is_the_surface_of_nearest_cells(spark):
    """Cells with several depths, spots that share a cell: a row a spot, made of one row a cell."""
    cells = [(float(a), float(o), float(z), a * 100 + o * 10 + z) for a in (0, 2) for o in (0, 3) for z in (5, 1, 3)]
    g = spark.createDataFrame(cells, "lat double, lon double, depth double, value long")
    spots = spark.createDataFrame([("a", 0.4, 2.0), ("b", 0.4, 2.0), ("c", 1.0, 1.5), ("d", 9.0, -9.0), ("e", None, 1.0)], "spot_id string, latitude double, longitude double")
    want = sorted(r[:] for r in grid.surface(grid.nearest_cells(g, spots), ["spot_id"]).select("spot_id", "lat", "lon", "depth", "value").collect())
    got = sorted(r[:] for r in grid.nearest_surface(g, spots).select("spot_id", "lat", "lon", "depth", "value").collect())
    assert got == want and [r[3] for r in got] == [1.0] * 4
