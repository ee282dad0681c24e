"""Boxes: from columns and geometry texts, envelopes, overlap, zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.staging import stored

SIDES = ("lat_min", "lat_max", "lon_min", "lon_max")
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"


def box(lat_min: Column, lat_max: Column, lon_min: Column, lon_max: Column) -> Column:
    """A box with its sides in order; null if one lacks."""
    whole = lat_min.isNotNull() & lat_max.isNotNull() & lon_min.isNotNull() & lon_max.isNotNull()
    return F.when(whole, F.struct(F.least(lat_min, lat_max).alias("lat_min"), F.greatest(lat_min, lat_max).alias("lat_max"), F.least(lon_min, lon_max).alias("lon_min"), F.greatest(lon_min, lon_max).alias("lon_max")))


def _spread(lons: Column, lats: Column) -> Column:
    return F.when(F.size(lons) > 0, box(F.array_min(lats), F.array_max(lats), F.array_min(lons), F.array_max(lons)))


def geojson_box(c: Column) -> Column:
    """Of a GeoJSON text, its bbox if it names one, else all its positions (longitude first), of features too."""
    stated = F.regexp_extract(c, r'"bbox"\s*:\s*\[([^\]]*)\]', 1)
    sides = F.transform(F.regexp_extract_all(stated, F.lit(NUMBER), F.lit(0)), lambda x: x.cast("double"))
    pair = rf"\[\s*({NUMBER})\s*,\s*({NUMBER})\s*(?:,\s*{NUMBER}\s*)?\]"
    doubles = lambda i: F.transform(F.regexp_extract_all(c, F.lit(pair), F.lit(i)), lambda x: x.cast("double"))
    return F.when(F.size(sides) == 4, box(F.get(sides, F.lit(1)), F.get(sides, F.lit(3)), F.get(sides, F.lit(0)), F.get(sides, F.lit(2)))).otherwise(_spread(doubles(1), doubles(2)))


def wkt_box(c: Column) -> Column:
    """Of a WKT text of longitude and latitude pairs; null if its numbers are odd."""
    n = F.transform(F.regexp_extract_all(c, F.lit(NUMBER), F.lit(0)), lambda x: x.cast("double"))
    every = lambda k: F.filter(n, lambda _, i: i % 2 == k)
    return F.when((F.size(n) > 0) & (F.size(n) % 2 == 0), _spread(every(0), every(1)))


def entity_box(numbers: list[Column], geometry: Column, latitude: Column, longitude: Column, margin: float = 0.01) -> Column:
    """From four numbers (lat_min, lat_max, lon_min, lon_max), else the geometry text, else round the centre."""
    text = F.trim(geometry)
    shape = F.when(text.startswith("{") | text.startswith("["), geojson_box(text)).otherwise(wkt_box(text))
    return F.coalesce(box(*numbers), shape, box(latitude - margin, latitude + margin, longitude - margin, longitude + margin))


def envelope(items: DataFrame) -> DataFrame:
    """One row: the box round all items' boxes; an error if there are none."""
    e = items.agg(F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), F.min("lon_min").alias("lon_min"), F.max("lon_max").alias("lon_max"))
    some = F.assert_true(F.col("lat_min").isNotNull(), F.lit("no boxes to envelop"))
    return e.where(some.isNull())


#: Side of a cell of level 0 in degrees, and how many times as long a cell's side is a level up.
CELL, STEP = 0.01, 4
#: Rows of a table in one cell that meet those of the other's in one group; a cell with more is dealt into blocks of about as many.
BLOCK = 2_000
#: Pairs that share a cell in one task, about; and most tasks.
TASK_PAIRS, MOST_TASKS = 16_000_000, 4_096


def _levels(df: DataFrame) -> list[int]:
    """The levels of a table's boxes: few, whatever their number."""
    return sorted(r[0] for r in df.select("level").distinct().collect())


def _met(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cells: list[str]) -> DataFrame:
    """a and b joined by cell; a crowded cell's rows are dealt into blocks by id, and each block of one table meets each of the other's in a group of its own.

    Both tables must carry their id. Only cells of more than BLOCK rows have
    several blocks. The number of tasks goes by the pairs to be looked at: the
    tables themselves are small beside them.
    """
    count = lambda df, n: df.groupBy(*cells).agg(F.count("*").alias(n))
    sized = count(a, "na").join(count(b, "nb"), cells)
    parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    blocks = stored(sized.select(*cells, parts("na").alias("na"), parts("nb").alias("nb"), (F.col("na").cast("double") * F.col("nb")).alias("pairs")), "box-blocks")
    pairs = blocks.agg(F.sum("pairs")).first()[0] or 0
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, int(pairs // TASK_PAIRS) + 1))
    blocks = blocks.drop("pairs")
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_a = a.join(blocks, cells).withColumn("pa", part(a_id, "na")).withColumn("pb", every("nb")).drop("na", "nb")
    dealt_b = b.join(blocks, cells).withColumn("pb", part(b_id, "nb")).withColumn("pa", every("na")).drop("na", "nb")
    keys = [*cells, "pa", "pb"]
    return dealt_a.repartition(tasks, *keys).hint("shuffle_hash").join(dealt_b.repartition(tasks, *keys), keys)


def overlapping(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cell: float = CELL) -> DataFrame:
    """(a_id, b_id) of boxes that overlap, edges included; boxes without a side are left out.

    There is a grid of cells for each level of size; a box's level is the first
    whose cells are as long as its longer side, so it touches four of them at
    most. A box is written to the cells of its own level, and to those of the
    higher levels the other table has. Two boxes meet at the higher one of their
    levels, where one of them is at home: a box of the first table with those of
    its own level or lower ones, a box of the second with lower ones alone. A
    pair is taken in the first cell both touch, so it comes once without a
    distinct.
    """
    def sized(df: DataFrame, key: str, p: str) -> DataFrame:
        longer = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
        level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest(longer, F.lit(cell)) / cell) / F.log(F.lit(float(STEP))))).cast("int")
        whole = df.where(" and ".join(f"{s} is not null and not isnan({s})" for s in SIDES))
        return whole.select(F.col(key).alias(key), level.alias("level"), *[F.col(s).alias(f"{p}{s}") for s in SIDES])

    def celled(df: DataFrame, p: str, at: Column) -> DataFrame:
        rows = df.withColumn("at", at).drop("level").withColumn("side", cell * F.pow(F.lit(float(STEP)), F.col("at")))
        span = lambda s: F.sequence(F.floor(F.col(f"{p}{s}_min") / F.col("side")), F.floor(F.col(f"{p}{s}_max") / F.col("side")))
        return rows.withColumn("cy", F.explode(span("lat"))).withColumn("cx", F.explode(span("lon")))

    def home(df: DataFrame, p: str) -> DataFrame:
        return celled(df, p, F.col("level"))

    def above(df: DataFrame, p: str, levels: list[int], own: bool) -> DataFrame:
        return celled(df, p, F.explode(F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda n: n >= F.col("level") if own else n > F.col("level"))))

    a_rows, b_rows = sized(a, a_id, "a_"), sized(b, b_id, "b_")
    cells = ["at", "cy", "cx"]
    larger_a = _met(home(a_rows, "a_"), above(b_rows, "b_", _levels(a_rows), True).drop("side"), a_id, b_id, cells)
    larger_b = _met(above(a_rows, "a_", _levels(b_rows), False), home(b_rows, "b_").drop("side"), a_id, b_id, cells)
    met = larger_a.unionByName(larger_b)
    first = lambda s: F.floor(F.greatest(f"a_{s}", f"b_{s}") / F.col("side"))
    met = met.where((F.col("cy") == first("lat_min")) & (F.col("cx") == first("lon_min")))
    return met.where("a_lat_min <= b_lat_max and b_lat_min <= a_lat_max and a_lon_min <= b_lon_max and b_lon_min <= a_lon_max").select(a_id, b_id)


def resolve_zones(rules: DataFrame, profiles: DataFrame, default: str) -> DataFrame:
    """rules (scope, source_scope) with the zone of their scope, else of their source's, else the default."""
    one = lambda key: profiles.select(F.col("scope").alias(key), F.col("zone_code").alias(f"_{key}"))
    both = rules.join(one("scope"), "scope", "left").join(one("source_scope"), "source_scope", "left")
    return both.withColumn("zone_code", F.coalesce("_scope", "_source_scope", F.lit(default))).drop("_scope", "_source_scope")


def zone_boxes(zones: DataFrame, spots: DataFrame, areas: DataFrame) -> DataFrame:
    """zones with the box of their strategy: spots', zones' (spots' if there are none), or their own; others are flagged as errors.

    The two envelopes are one row each.
    """
    side = lambda df, p: df.agg(*[(F.min if s.endswith("min") else F.max)(s).alias(f"{p}{s}") for s in SIDES])
    rows = zones.join(side(spots, "s_"), how="cross").join(side(areas, "z_"), how="cross")
    sides = []
    for s in SIDES:
        by = F.when(F.col("strategy") == "spots", F.col(f"s_{s}")).when(F.col("strategy") == "zones", F.coalesce(f"z_{s}", f"s_{s}")).when(F.col("strategy") == "custom", F.col(s))
        sides.append(by.alias(s))
    lacking = F.coalesce(*[F.when(x.isNull(), F.lit(True)) for x in sides], F.lit(False))
    return rows.select("zone_code", "strategy", *sides, lacking.alias("error"))
