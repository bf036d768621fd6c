"""Views of the test tables as frames, boxes, tracks and candidates.

Each adapter has the same rows in SQL (``*_SQL``), which the oracles build upon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str):
    return F.unix_micros(F.col(column).cast("timestamp")) / 1e6


def user_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as the frames of a track: track, frame_index, timestamp_s, value, event_type, event_id."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("track"), (F.row_number().over(w) - 1).cast("long").alias("frame_index"), seconds("ts").alias("timestamp_s"), "value", "event_type", "event_id"
    )


USER_FRAMES_SQL = """uf AS (SELECT user_id AS track, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS frame_index,
 epoch_us(ts) / 1e6 AS timestamp_s, value, event_type, event_id FROM events)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes: frame_index (the order), ordinal, box_xyxy, detector_score, sam2_mask_score, label."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    x, y = (F.col("l_partkey") % 97).cast("double"), (F.col("l_suppkey") % 53).cast("double")
    box = F.array(x, y, x + F.col("l_quantity"), y + 10.0 + F.col("l_linenumber"))
    return li.select(
        F.col("l_orderkey").alias("frame_index"), F.row_number().over(w).cast("long").alias("ordinal"), box.alias("box_xyxy"), (1.0 - F.col("l_discount")).alias("detector_score"),
        (1.0 - F.col("l_tax")).alias("sam2_mask_score"), F.concat("l_returnflag", "l_linestatus").alias("label"), F.col("l_quantity").alias("quantity"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
    )


BOXES_SQL = """bx AS (SELECT l_orderkey AS frame_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::BIGINT AS ordinal,
 (l_partkey % 97)::DOUBLE AS x0, (l_suppkey % 53)::DOUBLE AS y0, (l_partkey % 97)::DOUBLE + l_quantity AS x1, (l_suppkey % 53)::DOUBLE + 10.0::DOUBLE + l_linenumber AS y1,
 1.0::DOUBLE - l_discount AS detector_score, 1.0::DOUBLE - l_tax AS sam2_mask_score, l_returnflag || l_linestatus AS label, l_quantity AS quantity, l_partkey AS part, l_suppkey AS supplier FROM lineitem)"""


def iou_sql(a: str, b: str) -> str:
    """Intersection over union of boxes (x0, y0, x1, y1) of two aliases."""
    both = f"(greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0) * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0))"
    size = lambda t: f"(greatest({t}.x1 - {t}.x0, 0) * greatest({t}.y1 - {t}.y0, 0))"
    return f"({both} / greatest({size(a)} + {size(b)} - {both}, 1e-9::DOUBLE))"
