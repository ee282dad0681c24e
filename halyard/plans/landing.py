"""Driver queries of sources and streams: landed files, payloads, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from halyard.operators import consolidate, merge
from halyard.plans.adapters import SV, WIDE, Plans, rounded, run_time, source_values, table
from halyard.sources import grid, landing, payloads
from halyard.staging import scratch
from halyard.streaming import streams

plans = Plans()


def _parts(spark, d):
    """source_values under the partition columns of the hour they were fetched in."""
    v = source_values(spark, d)
    return v.withColumn("run_date", F.date_format("fetched_at", "yyyy-MM-dd")).withColumn("run_hour", F.date_format("fetched_at", "HH"))


@plans.add(f"""WITH {SV}, p AS (SELECT *, date_trunc('hour', fetched_at) AS h FROM sv WHERE source_code IN ('src0', 'src1')), n AS (SELECT max(h) AS h FROM p WHERE h <= TIMESTAMP '2024-01-15 06:00:00' AND h >= TIMESTAMP '2024-01-14 18:00:00')
SELECT event_id, source_code, metric FROM p WHERE h = (SELECT h FROM n)""")
def latest_run(spark, d):
    return landing.latest_run(_parts(spark, d), run_time(), 12, ["src0", "src1"]).select("event_id", "source_code", "metric")


@plans.add(f"WITH {SV} SELECT event_id, metric FROM sv WHERE date_trunc('hour', fetched_at) = TIMESTAMP '2024-01-09 08:00:00'")
def pick_run(spark, d):
    return landing.pick_run(_parts(spark, d), "2024-01-09", "8").select("event_id", "metric")


@plans.add(f"""WITH {SV}, s AS (SELECT DISTINCT source_code FROM sv) SELECT source_code, true AS known FROM s WHERE source_code IN ('src0', 'src2') UNION ALL SELECT 'srcX', false""")
def source_allowlist(spark, d):
    chosen, unknown = landing.choose_sources(source_values(spark, d).select("source_code").distinct(), ["src0", "src1", "src2", "srcX"], ["src1"])
    return chosen.withColumn("known", F.lit(True)).union(unknown.withColumn("known", F.lit(False)))


@plans.add(f"WITH {SV} SELECT event_id, spot_id, source_code, valid_time, metric, round(value, 6) AS value FROM sv")
def land_and_read(spark, d):
    """Written as gzipped JSON lines under the run's partitions and read back."""
    v = source_values(spark, d)
    path = scratch(spark, "landed")
    landing.write_source_values(v, path, F.col("fetched_at").cast("date").cast("timestamp"))
    back = landing.read_source_values(spark, path, "event_id long, spot_id string, valid_time timestamp, metric string, value double, unit string, source_code string")
    return rounded(back.select("event_id", "spot_id", "source_code", "valid_time", "metric", "value"))


@plans.add(f"""WITH {SV}, p AS (SELECT DISTINCT 'forecasts/run_date=' || strftime(fetched_at, '%Y-%m-%d') || '/run_hour=' || strftime(fetched_at, '%H') || '/source_code=' || source_code || '/part.gz' AS path, date_trunc('hour', fetched_at) AS h FROM sv)
SELECT path FROM p WHERE h < TIMESTAMP '2024-01-08 06:30:00'""")
def retention_runs(spark, d):
    parts = _parts(spark, d).select(F.concat(F.lit("forecasts/run_date="), "run_date", F.lit("/run_hour="), "run_hour", F.lit("/source_code="), "source_code", F.lit("/part.gz")).alias("path")).distinct()
    others = parts.select(F.concat(F.lit("other/"), "path").alias("path"))
    return merge.expired_runs(parts.union(others), run_time() - F.expr("interval 7 days"), "forecasts/")


@plans.add("""SELECT 'spot' || s_suppkey AS spot_id, s_name AS name, (s_suppkey + 0.5)::DOUBLE AS latitude, (s_nationkey + 1.0)::DOUBLE AS longitude FROM supplier WHERE s_suppkey % 9 > 0 AND s_suppkey % 5 > 0""")
def spot_catalogue(spark, d):
    s, key = table(spark, d, "supplier"), F.col("s_suppkey")
    raw = s.select(
        F.when(key % 9 > 0, F.concat(F.lit("spot"), key.cast("string"))).alias("id"), F.col("s_name").alias("name"),
        F.when(key % 5 > 0, key.cast("string")).otherwise("n/a").alias("latitude_min"), (key + 1).cast("string").alias("latitude_max"),
        F.col("s_nationkey").alias("longitude_min"), (F.col("s_nationkey") + 2).alias("longitude_max"),
    )
    return landing.spot_catalogue(raw).select("spot_id", "name", "latitude", "longitude")


@plans.add("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice BETWEEN 1000 AND 200000 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def filtered_read(spark, d):
    ids = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    return landing.select_rows(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], {"o_orderstatus": "F"}, {"o_orderpriority": ["1-URGENT", "5-LOW"], "o_custkey": ids}, {"o_totalprice": (1000, 200000)}, ["o_orderkey"])


@plans.add("""SELECT sha256(html) AS content_hash, count(*) AS n, 'shard=' || sha256(html)[1:2] || '/' || sha256(html) || '.html' AS raw_storage_path FROM pages GROUP BY html""")
def raw_store(spark, d):
    docs = table(spark, d, "pages").select("url", F.lit("text/html").alias("content_type"), F.encode("html", "utf-8").alias("content"))
    stored = landing.store_raw(docs, scratch(spark, "raw"))
    return stored.groupBy("content_hash", "raw_storage_path").agg(F.count("*").alias("n"))


@plans.add(f"""WITH {SV} SELECT source_code, TIMESTAMP '2024-01-15 06:30:00' AS started_at, max(fetched_at) AS finished_at, count(*) AS rows, 'success' AS status, NULL::VARCHAR AS error FROM sv GROUP BY source_code""")
def run_log(spark, d):
    return landing.run_log(source_values(spark, d), run_time())


@plans.add("""SELECT 'src' || (user_id % 3) AS source_code, 'spot' || (user_id // 2) AS spot_id, '' AS model, round((user_id // 2) / 8.0, 8)::DOUBLE AS grid_lat, round((user_id % 7) / 3.0, 8)::DOUBLE AS grid_lon, max(ts) AS last_seen FROM events GROUP BY ALL""")
def grid_points(spark, d):
    e, u = table(spark, d, "events"), F.col("user_id")
    v = e.select(F.concat(F.lit("src"), (u % 3).cast("string")).alias("source_code"), F.concat(F.lit("spot"), F.floor(u / 2).cast("string")).alias("spot_id"), F.lit(None).cast("string").alias("model"), (F.floor(u / 2) / 8.0).alias("grid_lat"), ((u % 7) / 3.0).alias("grid_lon"), F.col("ts").alias("fetched_at"))
    return landing.grid_points(v)


# Payloads

VARIABLES = {"wind": "wind_speed", "dir": "wind_direction", "rain": "precipitation"}


def _payload_rows(spark, d):
    """Of each user the day's events as one column-array payload: times, and one array a variable, the last one short."""
    e = table(spark, d, "events")
    each = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("r"))
    time = F.transform("r", lambda x: F.when(x["event_id"] % 10 == 0, "soon").otherwise(F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")))
    wind = F.transform("r", lambda x: F.when(x["event_id"] % 4 > 0, x["value"]))
    rain = F.slice(F.transform("r", lambda x: x["value"]), 1, 3)
    hourly = F.struct(time.alias("time"), wind.alias("wind"), rain.alias("rain"), wind.alias("other"))
    units = F.struct(F.lit("km/h").alias("wind"), F.lit("mm").alias("rain"))
    return each.select(F.col("user_id").alias("spot_id"), F.to_json(F.struct(hourly.alias("hourly"), units.alias("hourly_units"))).alias("payload"))


PAYLOAD_SQL = """WITH r AS (SELECT user_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
c AS (SELECT user_id AS spot_id, date_trunc('hour', ts) AS valid_time, 'wind' AS raw_variable, 'wind_speed' AS metric, round(value / 3.6, 6) AS value, 'm/s' AS unit FROM r WHERE event_id % 10 > 0 AND event_id % 4 > 0
  UNION ALL SELECT user_id, date_trunc('hour', ts), 'rain', 'precipitation', round(value, 6), 'mm' FROM r WHERE event_id % 10 > 0 AND n <= 3)"""


@plans.add(PAYLOAD_SQL + " SELECT * FROM c")
def payload_flatten(spark, d):
    return rounded(payloads.flatten_hourly(_payload_rows(spark, d), VARIABLES))


@plans.add(PAYLOAD_SQL + """, m AS (SELECT spot_id, valid_time, raw_variable, metric, unit, value, 0 AS o FROM c WHERE raw_variable = 'rain' UNION ALL SELECT spot_id, valid_time, raw_variable, metric, unit, value, 0 FROM c WHERE raw_variable = 'wind')
SELECT spot_id, valid_time, raw_variable, metric, unit, count(*) AS n FROM (SELECT DISTINCT spot_id, valid_time, raw_variable, metric, unit FROM m) GROUP BY ALL""")
def payload_merge(spark, d):
    p = _payload_rows(spark, d)
    both = p.withColumn("o", F.lit(1)).union(p.withColumn("o", F.lit(2)))
    merged = payloads.flatten_hourly(both, VARIABLES, order="o")
    return merged.groupBy("spot_id", "valid_time", "raw_variable", "metric", "unit").agg(F.count("*").alias("n"))


@plans.add("""SELECT o_custkey AS batch_id, 'spot' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS spot_id, o_orderkey AS k FROM orders""")
def payload_zip(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("batch_id")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("ks"))
    lists = o.select("batch_id", F.to_json(F.transform("ks", lambda k: F.struct(k.alias("k")))).alias("payload"))
    spots = o.select("batch_id", F.posexplode("ks").alias("position", "_")).select("batch_id", "position", F.concat(F.lit("spot"), (F.col("position") + 1).cast("string")).alias("spot_id"))
    return payloads.zip_batch(lists, spots).select("batch_id", "spot_id", F.get_json_object("payload", "$.k").cast("long").alias("k"))


@plans.add("""SELECT user_id AS spot_id, date_trunc('hour', ts) AS valid_time, 'air_temperature' AS raw_variable, 'air_temperature' AS metric, value, 'degC' AS unit FROM events WHERE date_trunc('hour', ts) >= TIMESTAMP '2024-01-15 06:00:00' AND date_trunc('hour', ts) < TIMESTAMP '2024-01-18 06:30:00'
UNION ALL SELECT user_id, date_trunc('hour', ts), 'rain', 'precipitation', event_id::DOUBLE, 'mm' FROM events WHERE event_id % 3 = 0 AND date_trunc('hour', ts) >= TIMESTAMP '2024-01-15 06:00:00' AND date_trunc('hour', ts) < TIMESTAMP '2024-01-18 06:30:00'""")
def series_flatten(spark, d):
    e = table(spark, d, "events")
    step = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        F.struct(
            F.struct(F.struct(F.col("value").alias("air_temperature"), F.lit(1).alias("unknown")).alias("details")).alias("instant"),
            F.when(F.col("event_id") % 3 == 0, F.struct(F.struct(F.col("event_id").alias("rain")).alias("details"))).alias("next_1_hours"),
        ).alias("data"),
    )
    p = e.groupBy(F.col("user_id").alias("spot_id")).agg(F.collect_list(step).alias("t")).select("spot_id", F.to_json(F.struct(F.struct(F.col("t").alias("timeseries")).alias("properties"))).alias("payload"))
    return payloads.flatten_series(p, {"air_temperature": "air_temperature", "rain": "precipitation"}, run_time(), 3)


@plans.add("""WITH m AS (SELECT s_suppkey, s_nationkey, unnest(range(31)) AS dd FROM supplier), c AS (SELECT try_cast(strftime(DATE '2026-01-01' + to_months(CAST(s_nationkey AS INTEGER)), '%Y-%m-') || lpad((dd + 1)::VARCHAR, 2, '0') AS DATE) AS date, s_suppkey % 130 AS c FROM m)
SELECT date, max(c)::DOUBLE AS value, count(*) AS n FROM c WHERE date IS NOT NULL AND c BETWEEN 20 AND 120 GROUP BY date""")
def matrix_flatten(spark, d):
    """Coefficients of some years from suppliers: the nation is the month from the first on, each day has all its suppliers' numbers.

    A payload is one supplier's month at its place in the matrix, so no row grows with the table.
    """
    s = table(spark, d, "supplier")
    before = F.array_repeat(F.array().cast("array<array<string>>"), F.col("s_nationkey").cast("int"))
    days = F.array_repeat(F.array((F.col("s_suppkey") % 130).cast("string")), 31)
    each = s.select(F.to_json(F.concat(before, F.array(days))).alias("payload"))
    c = payloads.flatten_matrix(each, F.lit("2026-01-01").cast("date"))
    return payloads.daily_coefficients(c).join(c.groupBy("date").agg(F.count("*").alias("n")), "date")


@plans.add("""WITH c AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey % 150 AS c FROM orders) SELECT date, c::INTEGER AS coefficient, count(*) AS n FROM c WHERE c BETWEEN 20 AND 120 GROUP BY ALL""")
def keyed_flatten(spark, d):
    o = table(spark, d, "orders")
    day, c = F.date_format("o_orderdate", "yyyy-MM-dd"), (F.col("o_orderkey") % 150).cast("string")
    dated = o.where("o_orderkey % 3 = 0").select(F.to_json(F.struct(day.alias("date"), F.array(c).alias("coefficients"))).alias("payload"))
    named = o.where("o_orderkey % 3 = 1").select(F.to_json(F.create_map(day, F.array(c, F.lit("high")))).alias("payload"))
    deep = o.where("o_orderkey % 3 = 2").select(F.to_json(F.struct(F.array(F.struct(day.alias("datetime"), c.alias("coef"))).alias("data"))).alias("payload"))
    found = payloads.flatten_keyed(dated.union(named).union(deep))
    return found.groupBy("date", "coefficient").agg(F.count("*").alias("n"))


@plans.add("""WITH day AS (SELECT CAST(ts AS DATE) AS date, max(value)::DOUBLE AS value FROM events GROUP BY 1), h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-18 05:00:00', INTERVAL 1 hour)) AS valid_time)
SELECT 'spot' || s_suppkey AS spot_id, valid_time, 'tide_coefficient' AS metric, value FROM h JOIN day ON date = CAST((valid_time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE), supplier""")
def daily_fan_out(spark, d):
    daily = table(spark, d, "events").groupBy(F.to_date("ts").alias("date")).agg(F.max("value").alias("value"))
    spots = table(spark, d, "supplier").select(F.concat(F.lit("spot"), F.col("s_suppkey").cast("string")).alias("spot_id"))
    return payloads.fan_out_days(daily, spots, run_time(), 3)


@plans.add("""WITH v AS (SELECT event_id, ts AS t, CASE WHEN event_id % 3 = 0 THEN 1440 WHEN event_id % 3 = 1 THEN 60 END AS m FROM events)
SELECT event_id, t AS valid_time FROM v WHERE m IS NULL OR m < 1440 UNION ALL
SELECT event_id, unnest(generate_series(greatest(t, TIMESTAMP '2024-01-15 06:00:00'), least(t + INTERVAL 1440 minute, TIMESTAMP '2024-01-17 06:30:00') - INTERVAL 1 microsecond, INTERVAL 1 hour)) FROM v WHERE m = 1440 AND greatest(t, TIMESTAMP '2024-01-15 06:00:00') < least(t + INTERVAL 1440 minute, TIMESTAMP '2024-01-17 06:30:00')""")
def hourly_expand(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id") % 3
    v = e.select("event_id", F.col("ts").alias("valid_time"), F.when(k == 0, 1440).when(k == 1, 60).alias("resolution_minutes"))
    return payloads.expand_days(v, run_time(), 2).select("event_id", "valid_time")


# Grids


def _grid(spark, d):
    """part as a grid of 40 latitudes and 25 longitudes, one or more depths a cell."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    return p.select(((k % 40) * 1.5).alias("lat"), (F.floor(k / 40) % 25 * 0.5).alias("lon"), F.col("p_size").cast("double").alias("depth"), F.col("p_partkey"), F.col("p_retailprice").alias("value"))


GRID_SQL = "g AS (SELECT (p_partkey % 40) * 1.5::DOUBLE AS lat, (p_partkey // 40 % 25) * 0.5::DOUBLE AS lon, p_size::DOUBLE AS depth, p_partkey, p_retailprice AS value FROM part)"


def _spots(spark, d):
    s = table(spark, d, "supplier")
    return s.select(F.concat(F.lit("spot"), F.col("s_suppkey").cast("string")).alias("spot_id"), (F.col("s_suppkey") % 53 + 0.4).cast("double").alias("latitude"), (F.col("s_nationkey") * 0.45 + 0.1).cast("double").alias("longitude"))


@plans.add(f"""WITH {GRID_SQL}, s AS (SELECT 'spot' || s_suppkey AS spot_id, (s_suppkey % 53 + 0.4)::DOUBLE AS latitude, (s_nationkey * 0.45 + 0.1)::DOUBLE AS longitude FROM supplier),
la AS (SELECT spot_id, arg_min(lat, (abs(lat - latitude), lat)) AS lat FROM s, (SELECT DISTINCT lat FROM g) GROUP BY 1), lo AS (SELECT spot_id, arg_min(lon, (abs(lon - longitude), lon)) AS lon FROM s, (SELECT DISTINCT lon FROM g) GROUP BY 1)
SELECT spot_id, lat, lon, arg_min(value, (depth, p_partkey)) AS value FROM la JOIN lo USING (spot_id) JOIN g USING (lat, lon) GROUP BY ALL""")
def grid_nearest(spark, d):
    cells = _grid(spark, d).withColumn("depth", F.struct("depth", "p_partkey"))
    return grid.nearest_surface(cells, _spots(spark, d)).select("spot_id", "lat", "lon", "value")


@plans.add(f"WITH {GRID_SQL}, s AS (SELECT min(s_suppkey % 53 + 0.4) - 0.25 AS a, max(s_suppkey % 53 + 0.4) + 0.25 AS b, min(s_nationkey * 0.45 + 0.1) - 0.25 AS c, max(s_nationkey * 0.45 + 0.1) + 0.25 AS e FROM supplier) SELECT lat, lon, count(*) AS n FROM g, s WHERE lat BETWEEN a AND b AND lon BETWEEN c AND e GROUP BY ALL")
def grid_box(spark, d):
    return grid.inside_box(_grid(spark, d), _spots(spark, d)).groupBy("lat", "lon").agg(F.count("*").alias("n"))


@plans.add(f"WITH {GRID_SQL} SELECT lat, lon, min(depth) AS depth FROM g GROUP BY ALL")
def grid_surface(spark, d):
    g = _grid(spark, d)
    picked = grid.first_available(g.columns, {"depth": ("deptho", "depth", "z"), "value": ("thetao", "value")})
    return grid.surface(g.select("lat", "lon", picked["depth"]), ["lat", "lon"])


@plans.add("""WITH s AS (SELECT user_id, ts, epoch(date_trunc('second', ts)) - lag(epoch(date_trunc('second', ts))) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM (SELECT DISTINCT user_id, ts FROM events))
SELECT user_id, CAST(floor(median(step) / 60) AS INTEGER) AS resolution_minutes FROM s GROUP BY user_id""")
def resolution(spark, d):
    return grid.resolution_minutes(table(spark, d, "events").select("user_id", F.col("ts").alias("valid_time")), ["user_id"])


# Streams


@plans.add(f"""WITH {SV}, {WIDE} SELECT spot_id, valid_time, round(wind_speed_ms, 6) AS wind_speed_ms, round(precipitation_mm, 6) AS precipitation_mm, CAST(source_count AS INTEGER) AS source_count FROM (
  SELECT spot_id, valid_time, avg(value) FILTER (metric = 'wind_speed') AS wind_speed_ms, avg(value) FILTER (metric = 'precipitation') AS precipitation_mm, count(DISTINCT source_code) AS source_count FROM nv WHERE metric IN ('wind_speed', 'precipitation') GROUP BY ALL)""")
def stream_consolidate(spark, d):
    """events landed as files, streamed into hourly rows, upserted, and read back."""
    landed, out, marks = (scratch(spark, x) for x in ("stream-in", "stream-out", "stream-marks"))
    v = consolidate.normalize(source_values(spark, d)).select("spot_id", "source_code", "valid_time", "metric", "value")
    v.repartition(8).write.parquet(landed)
    stream = streams.landed_stream(spark, landed, v.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), "parquet")
    wide = streams.hourly_stream(stream, ("wind_speed", "precipitation"), late="400 days", width="6 hours")
    query = wide.writeStream.outputMode("update").foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{out}/part={i}")).option("checkpointLocation", marks).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(out)
    last = rows.groupBy("spot_id", "valid_time").agg(F.max_by(F.struct("wind_speed_ms", "precipitation_mm", "source_count"), "batch").alias("r"))
    return rounded(last.select("spot_id", "valid_time", "r.*"))


#: Files of each step of the stream below, so many a batch.
FILES = 4


@plans.add(f"""WITH {SV}, k AS (SELECT * FROM nv WHERE metric IN ('wind_speed', 'precipitation') AND (event_id % 10 > 0 OR valid_time + INTERVAL 6 hour > TIMESTAMP '2024-01-19 18:00:00'))
SELECT spot_id, valid_time, round(avg(value) FILTER (metric = 'wind_speed'), 6) AS wind_speed_ms, round(avg(value) FILTER (metric = 'precipitation'), 6) AS precipitation_mm, CAST(count(DISTINCT source_code) AS INTEGER) AS source_count FROM k GROUP BY ALL""")
def stream_late_rows(spark, d):
    """Every tenth event lands late: after time has come to the 20th, what belongs to windows closed six hours before is dropped."""
    landed, out, marks = (scratch(spark, x) for x in ("late-in", "late-out", "late-marks"))
    v = consolidate.normalize(source_values(spark, d)).select("event_id", "spot_id", "source_code", "valid_time", "metric", "value")

    def mark(day: str):
        """Rows that tell the time, one a file."""
        return spark.range(0, FILES, 1, FILES).select(F.lit(-1).cast("long"), F.lit("mark"), F.lit("src"), F.lit(day).cast("timestamp"), F.lit("wind_speed"), F.lit(0.0))

    early = (F.col("event_id") % 10 > 0) & (F.col("valid_time") < "2024-01-20")
    for rows in (v.where(early).repartition(FILES), mark("2024-01-20"), mark("2024-01-20"), v.where(~early).repartition(FILES), mark("2030-01-01"), mark("2030-01-01")):
        rows.toDF(*v.columns).write.mode("append").parquet(landed)
    schema = "event_id long, spot_id string, source_code string, valid_time timestamp, metric string, value double"
    stream = streams.landed_stream(spark, landed, schema, "parquet", FILES)
    streams.drain(streams.hourly_stream(stream, ("wind_speed", "precipitation"), late="6 hours", width="6 hours"), out, marks).awaitTermination()
    done = spark.read.parquet(out).where("spot_id <> 'mark'")
    return rounded(done.select("spot_id", "valid_time", "wind_speed_ms", "precipitation_mm", "source_count"))


def _upserted(spark, d):
    """Events upserted by user in three batches, the highest first; the table's path."""
    landed, out, marks = (scratch(spark, x) for x in ("upsert-in", "upsert-out", "upsert-marks"))
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    for k in range(3):
        e.where(F.col("event_id") % 3 == 2 - k).repartition("user_id").write.mode("append").parquet(landed)
    # three batches at every size
    files = len(spark.read.parquet(landed).inputFiles())
    stream = streams.landed_stream(spark, landed, "event_id long, user_id long, event_type string", "parquet", -(-files // 3))
    streams.upsert_stream(stream, out, ["user_id"], marks, "event_id").awaitTermination()
    return out


LAST_EVENT = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id"


@plans.add(LAST_EVENT)
def stream_upsert(spark, d):
    """Versions arrive in no order of event_id, so the sequence decides and not the batch."""
    return streams.current_rows(spark, _upserted(spark, d), ["user_id"], "event_id").select("user_id", "event_id", "event_type")


@plans.add(LAST_EVENT)
def stream_compact(spark, d):
    """The same, after the first two versions were put together."""
    out = _upserted(spark, d)
    streams.compact_rows(spark, out, ["user_id"], 1, "event_id")
    return streams.current_rows(spark, out, ["user_id"], "event_id").select("user_id", "event_id", "event_type")


@plans.add("SELECT user_id, CAST(ts AS DATE) AS day, count(*) > 0 AS fired FROM events GROUP BY ALL")
def stream_alert_once(spark, d):
    landed, out, marks = (scratch(spark, x) for x in ("alert-in", "alert-out", "alert-marks"))
    table(spark, d, "events").select(F.col("user_id").alias("alert_id"), F.col("ts").alias("valid_time")).repartition(4).write.parquet(landed)
    stream = streams.landed_stream(spark, landed, "alert_id long, valid_time timestamp", "parquet")
    streams.drain(streams.once_a_day(stream, late="40 days"), out, marks).awaitTermination()
    return spark.read.parquet(out).select(F.col("alert_id").alias("user_id"), "day", F.lit(True).alias("fired"))


# Catalogues and reports


@plans.add("SELECT 's' || s_suppkey AS id, s_name AS title, s_suppkey % 4 AS priority FROM supplier UNION ALL SELECT 'report', n_name, n_nationkey FROM nation")
def catalogue_read(spark, d):
    """Lists of suppliers, one file a nation, read as catalogues; nations, written as a report and read back; and a catalogue that is not there."""
    lists, report = scratch(spark, "lists"), scratch(spark, "report")
    s = table(spark, d, "supplier")
    entry = F.struct(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title"), (F.col("s_suppkey") % 4).alias("priority"))
    files = s.groupBy((F.col("s_suppkey") % 97).alias("file"), F.col("s_nationkey").alias("nation")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    files.write.partitionBy("nation", "file").text(lists)
    schema = "id string, title string, priority long"
    read = landing.read_catalogue(spark, f"{lists}/*/*", schema).select("id", "title", "priority")
    landing.write_report(table(spark, d, "nation").select(F.lit("report").alias("id"), F.col("n_name").alias("title"), F.col("n_nationkey").cast("long").alias("priority")), report)
    return read.union(spark.read.schema(schema).json(report)).union(landing.read_catalogue(spark, f"{lists}-none", schema))


QUERIES, ORACLE_SQL = plans.queries, plans.sql
