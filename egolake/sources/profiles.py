"""Camera profiles: the catalogue, and which profile a stream has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..work import hinted, materialize

DOCUMENT = "profile_id string, camera_make_model string, aliases array<string>, video struct<width: int, height: int, nominal_fps: double>"
FPS_TOLERANCE = 0.1


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of a folder of JSON documents; ``profile`` orders them by file name."""
    docs = spark.read.schema(DOCUMENT).json(folder, multiLine=True).withColumn("profile", F.col("_metadata.file_name"))
    names = F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array(F.coalesce("camera_make_model", F.lit(""))))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return docs.select("profile", "profile_id", names.alias("aliases"), zero("video.width").alias("width"), zero("video.height").alias("height"), zero("video.nominal_fps").cast("double").alias("fps"))


def match_profiles(streams: DataFrame, profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streams (keys, camera, width, height, fps) with the first profile that fits, or null.

    An alias must equal the camera's name (trimmed, in lower case), the size must be equal, and
    known rates must agree to 0.1. Profiles are first reduced to a row a name and size, with the
    first profile of each rate, so a stream meets one row, however many profiles it fits.
    """
    name = lambda c: F.lower(F.trim(c))
    known = profiles.select("profile", F.explode(F.array_distinct(F.transform("aliases", name))).alias("_alias"), F.col("width").alias("_w"), F.col("height").alias("_h"), F.col("fps").alias("_f"))
    rates = known.groupBy("_alias", "_w", "_h", "_f").agg(F.min("profile").alias("_p"))
    kinds = materialize(rates.groupBy("_alias", "_w", "_h").agg(F.collect_list(F.struct("_f", "_p")).alias("_rates")), "profiles")
    kinds = hinted(kinds, F.lit(96) + F.coalesce(F.length("_alias"), F.lit(0)) + 64 * F.size("_rates"))
    found = streams.join(kinds, (name(F.col("camera")) == F.col("_alias")) & (F.col("width") == F.col("_w")) & (F.col("height") == F.col("_h")), "left")
    near = lambda r: (F.coalesce("fps", F.lit(0.0)) == 0) | (r["_f"] == 0) | (F.abs(F.col("fps") - r["_f"]) <= FPS_TOLERANCE)
    first = F.array_min(F.transform(F.filter("_rates", near), lambda r: r["_p"]))
    return found.select(*keys, *(c for c in streams.columns if c not in keys), first.alias("profile"))
