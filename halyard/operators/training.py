"""Observations joined to forecasts as a training table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def filled(*columns: Column) -> Column:
    """The first of columns that is not null or empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def uuid_or_null(c: Column) -> Column:
    return F.when(c.rlike(UUID), c)


def usable(observations: DataFrame) -> DataFrame:
    """Observations with ids, a label and a time."""
    return observations.where("id is not null and dive_id is not null and estimated_visibility is not null and coalesce(visited_at, created_at) is not null")


def best_images(images: DataFrame, url: str = "image_url", path: str = "image_path") -> DataFrame:
    """(dive_spot_id, image): of each observation's images the flagged first, then by position, then by age; its url, else its path."""
    with_one = images.withColumn("image", filled(F.col(url), F.col(path))).where("image is not null")
    rank = F.struct((~F.coalesce("use_for_visibility", F.lit(False))).alias("a"), F.coalesce("position", F.lit(1 << 30)).alias("b"), "created_at", "image")
    return with_one.groupBy("dive_spot_id").agg(F.min_by("image", rank).alias("image"))


def last_of_hour(forecasts: DataFrame) -> DataFrame:
    """Of each spot_id and hour the forecast of the latest valid_time."""
    w = W.partitionBy("spot_id", "hour").orderBy(F.desc("valid_time"))
    hours = forecasts.withColumn("hour", F.date_trunc("hour", "valid_time"))
    return hours.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def training_rows(observations: DataFrame, dives: DataFrame, spots: DataFrame, images: DataFrame, forecasts: DataFrame, strict: bool = False) -> DataFrame:
    """One row per usable observation that has a forecast at its spot and hour.

    Spots come from the observation, else its dive; coordinates from the
    observation, else the centre of the spot's box, and rows with neither are
    left out; the image is the observation's best, else the dive's cover. strict
    asks for a dive and a spot, as a view over the tables would; else they may lack.
    """
    how = "inner" if strict else "left"
    d = dives.select(F.col("id").alias("dive_id"), F.col("spot_id").alias("_dive_spot"), "cover_image_url", "cover_image_path", "dive_type")
    s = spots.select(
        F.col("id").alias("spot_id"), F.col("name").alias("spot_name"),
        ((F.col("latitude_min") + F.col("latitude_max")) / 2).alias("_lat"),
        ((F.col("longitude_min") + F.col("longitude_max")) / 2).alias("_lon"),
    )
    rows = usable(observations).join(d, "dive_id", how).withColumn("spot_id", filled(F.col("spot_id"), F.col("_dive_spot")))
    rows = rows.join(s, "spot_id", how).join(best_images(images).withColumnRenamed("dive_spot_id", "id"), "id", "left")
    rows = rows.select(
        F.col("id").alias("outing_id"), "dive_id", "spot_id", "spot_name", "dive_type", "estimated_visibility",
        F.coalesce("visited_at", "created_at").alias("visited_at"),
        F.coalesce("latitude", "_lat").alias("latitude"), F.coalesce("longitude", "_lon").alias("longitude"),
        filled(F.col("image"), F.col("cover_image_url"), F.col("cover_image_path")).alias("image"),
        F.date_trunc("hour", F.coalesce("visited_at", "created_at")).alias("hour"),
    ).where("latitude is not null and longitude is not null")
    return rows.join(last_of_hour(forecasts), ["spot_id", "hour"])


def sector_view(observations: DataFrame, spots: DataFrame, sectors: DataFrame, forecasts: DataFrame) -> DataFrame:
    """The older view: observation, its spot and sector where known, its forecast; coordinates from the first that has them."""
    s = spots.select(F.col("id").alias("spot_id"), "sector_id", F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"))
    z = sectors.select(F.col("id").alias("sector_id"), F.col("name").alias("sector_name"), F.col("latitude").alias("_zlat"), F.col("longitude").alias("_zlon"))
    rows = observations.join(s, "spot_id", "left").join(z, "sector_id", "left")
    rows = rows.withColumn("latitude", F.coalesce("latitude", "_slat", "_zlat")).withColumn("longitude", F.coalesce("longitude", "_slon", "_zlon"))
    rows = rows.drop("_slat", "_slon", "_zlat", "_zlon").withColumn("hour", F.date_trunc("hour", "visited_at"))
    return rows.join(last_of_hour(forecasts), ["spot_id", "hour"])
