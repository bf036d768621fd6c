"""Depth frames: scene changes, stabilised depth, reasons and confidence."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import fold
from .images import grey, optical_flow
from .kernels import bilateral, frame_statistics, normalised_depth, stabilised, thumbnail

# Mean difference of thumbnails at a scene change, and what stored depth means.
ACCEPT, SCENE_CHANGE, SCENE_SCALE = 0.5, 45.0, {"units": "normalized_relative_inverse_depth", "near_value": 1.0, "far_value": 0.0}


def _differences(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y))


def scene_changes(df: DataFrame, keys: Sequence[str], thumb: str = "thumbnail", index: str = "frame_index", limit: float = SCENE_CHANGE) -> DataFrame:
    """Adds scene_change: the mean difference of a frame's thumbnail (an array of numbers) to that of
    the row before exceeds ``limit``. A first row is none."""
    last = F.lag(thumb).over(Window.partitionBy(*keys).orderBy(index))
    total = F.aggregate(_differences(F.col(thumb), F.col("_last")), F.lit(0.0), lambda s, x: s + x)
    out = df.withColumn("_last", last)
    return out.withColumn("scene_change", F.coalesce(total / F.size(thumb) > limit, F.lit(False))).drop("_last")


def temporal_deltas(df: DataFrame, keys: Sequence[str], thumb: str = "depth_thumbnail", index: str = "frame_index") -> DataFrame:
    """Adds temporal_delta: the median difference of a frame's depth thumbnail to that of the row before;
    0 on a first row and where ``scene_change`` holds."""
    last = F.lag(thumb).over(Window.partitionBy(*keys).orderBy(index))
    s, n = F.array_sort(_differences(F.col(thumb), F.col("_last"))), F.size(thumb)
    middle = (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
    out = df.withColumn("_last", last)
    delta = F.when(F.col("scene_change"), 0.0).otherwise(F.coalesce(F.when(n > 0, middle), F.lit(0.0)))
    return out.withColumn("temporal_delta", delta).drop("_last")


DEPTH = (
    "normalization_low double, normalization_high double, temporal_delta double, flow_valid_fraction double, stabilization_blend_fraction double, photometric_residual double, "
    "sharpness double, glare_fraction double, invalid_fraction double, scene_change boolean, height int, width int, depth binary, invalid binary"
)


def depth_frames(frames: DataFrame, keys: Sequence[str], backend, every: int = 1, flow=optical_flow) -> DataFrame:
    """The depth stage: every ``every``th frame (keys, frame_index, timestamp_s, content) with its depth and measures.

    Depth is normalised between running percentiles, smoothed, and drawn towards the last
    frame's stabilised depth; a scene change resets all three. A video's frames stream through
    one task in order. ``depth`` is float16, row by row, ``invalid`` packed bits.
    """

    def step(last, row):
        image = backend.decode(row[0])
        light = grey(image)
        thumb = thumbnail(light)
        cut = last is not None and float(np.abs(thumb - last["thumb"]).mean()) > SCENE_CHANGE
        raw = backend.depth(image)
        fresh = last is None or cut
        depth, low, high = normalised_depth(raw, None if fresh else last["bounds"])
        depth, measures, small, small_light = stabilised(bilateral(depth), light, None if fresh else last["small"], flow)
        depth_thumb = thumbnail(depth)
        delta = 0.0 if fresh else float(np.median(np.abs(depth_thumb - last["depth_thumb"])))
        s = frame_statistics(image, raw)
        state = {"thumb": thumb, "bounds": (low, high), "small": (small, small_light), "depth_thumb": depth_thumb}
        out = (low, high, delta, measures["flow_valid_fraction"], measures["stabilization_blend_fraction"], measures["photometric_residual"], s["sharpness"], s["glare_fraction"], s["invalid_fraction"], cut)
        return state, (*out, *raw.shape, depth.astype(np.float16).tobytes(), np.packbits(~np.isfinite(raw)).tobytes())

    some = frames.where(F.col("content").isNotNull() & (F.col("frame_index") % every == 0))
    done = fold(some, keys, ["frame_index", "timestamp_s"], ["content"], step, DEPTH).drop("content")
    return depth_quality(done).withColumns({k: F.lit(v) for k, v in SCENE_SCALE.items()})


def depth_quality(df: DataFrame) -> DataFrame:
    """Adds confidence, status and reasons from (invalid_fraction, temporal_delta, glare_fraction, sharpness, scene_change)."""
    delta, glare, sharp = F.col("temporal_delta"), F.col("glare_fraction"), F.col("sharpness")
    factors = (
        F.when(delta > 0.28, 0.65).when(delta != 0, F.greatest(F.lit(0.65), 1.0 - delta / 0.35)).otherwise(1.0),
        F.when(glare > 0.03, 0.65).when(glare > 0.008, 0.82).otherwise(1.0),
        F.when(sharp < 12, 0.75).when(sharp < 35, 0.9).otherwise(1.0),
    )
    confidence = F.greatest(F.lit(0.0), 1.0 - F.col("invalid_fraction") * 4.0)
    for f in factors:
        confidence = confidence * f
    reasons = F.array_compact(F.array(
        F.when(delta > 0.28, "large_relative_depth_change"),
        F.when(glare > 0.03, "severe_glare_or_clipping").when(glare > 0.008, "glare_or_clipping"),
        F.when(sharp < 12, "motion_blur_or_low_texture"),
        F.when(F.col("scene_change"), "scene_cut_normalization_reset"),
    ))
    df = df.withColumn("confidence", confidence).withColumn("reasons", reasons)
    return df.withColumn("status", F.when(F.col("confidence") >= ACCEPT, "accepted").otherwise("rejected"))


def interval_reasons(status: Column, reasons: Column) -> Column:
    """Reasons of a rejected frame in intervals; one without any is of low confidence."""
    return F.when((status == "rejected") & (F.size(reasons) == 0), F.array(F.lit("low_relative_depth_confidence"))).otherwise(reasons)
