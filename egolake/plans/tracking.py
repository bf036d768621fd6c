"""The tracking stage: trusted anchors of objects to dense tracks of every frame."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..models import ModelBackend, tracked
from ..operators import kernels, tracks
from ..operators.folds import fold
from ..operators.images import grey, optical_flow, resized
from ..operators.mask_columns import by_row, fused_masks

KEYS = ("episode", "object_id")
#: How rows of one frame and object give way to each other, from the least.
BETWEEN, ANCHOR = 1, 2


def intervals(anchors: DataFrame, frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stretches of frames between neighbouring anchors (keys, start_frame, end_frame, left, right).

    left and right are the structs (counts, area) of the anchors at either end; before a first
    anchor there is no left one, after a last no right one. A frame of an anchor ends the
    stretch before it and starts the next.
    """
    w = Window.partitionBy(*keys).orderBy("frame_index")
    end = F.struct("counts", "area")
    pairs = anchors.select(*keys, "frame_index", end.alias("left"), F.lead("frame_index").over(w).alias("to"), F.lead(end).over(w).alias("right"), F.row_number().over(w).alias("n"))
    last = frames.groupBy("episode").agg(F.max("frame_index").alias("last"))
    pairs = pairs.join(last, "episode")
    kind = F.lit(None).cast(pairs.schema["left"].dataType)
    after = pairs.select(*keys, F.col("frame_index").alias("start_frame"), F.coalesce("to", "last").alias("end_frame"), "left", "right").where("start_frame < end_frame")
    before = pairs.where("n = 1 and frame_index > 0").select(*keys, F.lit(0).cast("long").alias("start_frame"), F.col("frame_index").alias("end_frame"), kind.alias("left"), F.col("left").alias("right"))
    return before.unionByName(after)


def segments(spans: DataFrame, frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The frames of every stretch in each direction that an anchor starts (keys, start_frame, direction, offset, content, seed)."""
    ways = F.array_compact(F.array(
        F.when(F.col("left").isNotNull(), F.struct(F.lit("forward").alias("direction"), F.col("left.counts").alias("seed"))),
        F.when(F.col("right").isNotNull(), F.struct(F.lit("backward").alias("direction"), F.col("right.counts").alias("seed"))),
    ))
    rows = spans.withColumn("_w", F.explode(ways)).withColumn("frame_index", F.explode(F.sequence("start_frame", "end_frame")))
    offset = F.when(F.col("_w.direction") == "forward", F.col("frame_index") - F.col("start_frame")).otherwise(F.col("end_frame") - F.col("frame_index"))
    rows = rows.select(*keys, "start_frame", "end_frame", F.col("_w.direction").alias("direction"), F.col("_w.seed").alias("seed"), "frame_index", offset.alias("offset"))
    return rows.join(frames.select("episode", "frame_index", "content"), ["episode", "frame_index"])


def motion_scores(rows: DataFrame, keys: Sequence[str], backend: ModelBackend, flow=optical_flow) -> DataFrame:
    """(keys, frame_index, motion): how far an object's pixels (counts) moved since the frame before, without the
    camera's median motion; 0 for a first frame and where there is no mask. Rows have the frame's content."""

    def step(last, row):
        image = backend.decode(row[0])
        light = resized(grey(image), *kernels.FLOW_SIZE)
        mask = None if row[1] is None else kernels.decode_rle(row[1], *image.shape[:2])
        return light, (0.0 if last is None else kernels.object_motion(last, light, mask, flow),)

    return fold(rows, keys, ["frame_index"], ["content", "counts"], step, "motion double").select(*keys, "frame_index", "motion")


def _both(done: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each frame of a stretch: what each direction has, where its mask is plausible."""
    k = [*keys, "start_frame"]
    way = lambda name, end: (
        done.where(F.col("direction") == name)
        .join(spans.select(*k, "end_frame", F.col(f"{end}.area").alias("_a")), k)
        .withColumn("frame_index", F.col("start_frame") + F.col("offset") if name == "forward" else F.col("end_frame") - F.col("offset"))
        .select(*k, "frame_index", "area", F.when(tracks.plausible(F.col("area"), F.col("_a")), F.col("counts")).alias("counts"), "confidence")
    )
    return tracks.joined_directions(way("forward", "left"), way("backward", "right"), [*k, "frame_index"])


def object_tracks(anchors: DataFrame, frames: DataFrame, backend: ModelBackend, height: int, width: int, fps: float = 30.0, flow=optical_flow) -> DataFrame:
    """Dense tracks of every frame (episode, frame_index, timestamp_s, content) and object.

    ``anchors`` are the trusted ones: episode, object_id, label, frame_index, counts, area and
    score. Every stretch between anchors is followed from both ends; masks of both directions
    are joined, and where an object is replaced by another one inside a stretch it is split
    and the frames in doubt have no mask.
    """
    keys = list(KEYS)
    spans = intervals(anchors, frames)
    done = tracked(segments(spans, frames), backend, [*keys, "start_frame", "direction"])
    both = _both(done, spans, keys).withColumns({"height": F.lit(height), "width": F.lit(width)})
    fused = fused_masks(both)
    k = [*keys, "start_frame"]

    # splits: signals of stretches that have both ends
    inner = spans.where("left is not null and right is not null").select(*k, "end_frame", F.col("left.area").alias("left_area"), F.col("right.area").alias("right_area"))
    signals = fused.join(inner, k)
    moved = motion_scores(signals.select(*k, "frame_index", F.col("forward_counts").alias("counts")).join(frames.select("episode", "frame_index", "content"), ["episode", "frame_index"]), k, backend, flow)
    signals = signals.join(moved, [*k, "frame_index"]).withColumn("offset", F.col("frame_index") - F.col("start_frame")).withColumn("iou", F.col("directional_iou"))
    splits = tracks.lifecycle_splits(signals, k, fps).select(*k, "old_end", "new_start", "split_reason")
    numbered = tracks.instance_ids(spans.select(*k, "end_frame").join(splits, k, "left"), keys, F.col("old_end").isNotNull())

    rows = fused.join(numbered, k).withColumn("offset", F.col("frame_index") - F.col("start_frame"))
    zone = tracks.zone(F.col("offset"), F.col("old_end"), F.col("new_start"), F.col("offset") == 0, F.col("frame_index") == F.col("end_frame"), F.col("instance_id"))
    rows = rows.withColumn("_z", F.when(F.col("old_end").isNotNull(), zone))
    own = F.when(F.col("_z.direction") == "forward", F.col("forward_counts")).when(F.col("_z.direction") == "backward", F.col("backward_counts"))
    split = F.col("_z").isNotNull()
    source = F.when(split, F.col("_z.source")).otherwise(tracks.fused_source(F.col("forward_counts"), F.col("backward_counts"), F.col("counts").isNotNull()))
    best = F.coalesce(F.greatest("forward_confidence", "backward_confidence"), F.lit(0.0))
    rows = rows.select(
        *keys, "frame_index", F.lit(BETWEEN).alias("priority"), F.when(split, F.col("_z.instance_id")).otherwise(F.col("instance_id")).alias("instance_id"), source.alias("source"),
        F.when(split, own).otherwise(F.col("counts")).alias("counts"), best.alias("confidence"), "directional_iou", F.col("component_fraction").alias("primary_component_fraction"),
    )
    opened = numbered.groupBy(*keys, "start_frame").agg(F.max("instance_id").alias("instance_id")).withColumnRenamed("start_frame", "frame_index")
    fixed = anchors.join(opened, [*keys, "frame_index"], "left").select(
        *keys, "frame_index", F.lit(ANCHOR).alias("priority"), F.coalesce("instance_id", F.lit(1)).alias("instance_id"), F.lit("object_anchor").alias("source"), "counts", F.col("score").alias("confidence"),
        F.lit(1.0).alias("directional_iou"), F.lit(1.0).alias("primary_component_fraction"),
    )
    state = tracks.last_write(rows.unionByName(fixed), [*keys, "frame_index"], "priority", "counts")
    return dense(state, anchors, frames, height, width)


def dense(state: DataFrame, anchors: DataFrame, frames: DataFrame, height: int, width: int) -> DataFrame:
    """Every frame with every object of its episode: box, area and visibility of the state's masks."""

    def measure(counts):
        if counts is None:
            return None, None
        mask = kernels.decode_rle(counts, height, width)
        return int(np.count_nonzero(mask)), list(kernels.mask_box(mask))

    seen = by_row(state, ["counts"], "mask_area_px bigint, box array<bigint>", measure)
    objects = anchors.groupBy("episode", "object_id").agg(F.max(F.struct("frame_index", "label")).alias("_l"), F.min("frame_index").alias("first_anchor")).select("episode", "object_id", F.col("_l.label").alias("label"), "first_anchor")
    rows = tracks.dense_tracks(frames.select("episode", "frame_index", "timestamp_s"), objects, seen)
    held = F.when(~F.col("source").isin("cutie_incoherent", "lifecycle_quarantine", "untracked"), F.col("mask_area_px"))
    rows = rows.withColumn("visibility", tracks.visibility(held, F.col("box"), F.col("frame_index"), F.col("first_anchor"), width, height))
    boxes = [F.coalesce(F.col("box")[i], F.lit(0)).alias(f"bbox_{n}") for i, n in enumerate(("x", "y", "width", "height"))]
    return rows.select(
        "episode", "frame_index", "timestamp_s", "object_id", F.coalesce("instance_id", F.lit(1)).cast("long").alias("instance_id"), "label", *boxes, "mask_area_px", "visibility", "confidence", "source", "directional_iou", "primary_component_fraction", "counts"
    )


def label_details(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The labels of each track (label, score) from the best on, of equals the later label first (keys, scores, label, clip_score)."""
    ranked = F.reverse(F.array_sort(F.collect_list(F.struct("score", "label"))))
    out = scores.groupBy(*keys).agg(ranked.alias("scores"))
    return out.withColumn("label", F.col("scores")[0]["label"]).withColumn("clip_score", F.col("scores")[0]["score"])


def updated_summary(selected: DataFrame, details: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Selected objects (label, ...) with the label, score and acceptance that their track was given, where it was.

    pre_clip_label keeps the first label an object had.
    """
    new = details.select(*keys, F.col("label").alias("_label"), F.col("clip_score").alias("_score"), F.col("accepted").alias("_ok"))
    out = selected.join(new, list(keys), "left")
    have = lambda c, kind: F.col(c) if c in selected.columns else F.lit(None).cast(kind)
    out = out.withColumn("pre_clip_label", F.coalesce(have("pre_clip_label", "string"), F.when(F.col("_label").isNotNull(), F.col("label"))))
    out = out.withColumn("label", F.coalesce("_label", "label"))
    out = out.withColumn("clip_score", F.coalesce("_score", have("clip_score", "double"))).withColumn("clip_accepted", F.coalesce("_ok", have("clip_accepted", "boolean")))
    return out.drop("_label", "_score", "_ok")
