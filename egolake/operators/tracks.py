"""Object tracks: lifecycle splits, assembly from directions, visibility and frame quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Gates of propagated masks and of lifecycle signals.
VIABLE_RATIO, DISAGREE_IOU, ANCHOR_IOU, PLAUSIBLE_RATIO, COMPONENT_FRACTION = 0.10, 0.30, 0.20, 0.20, 0.65
COLLAPSE_RUN, SIGNAL_RUN, ANCHOR_REACH, STABLE_SECONDS, LEAST_MOTION = 5, 3, 60, 0.8, 1.25


def viable(area: Column, anchor_area: Column, ratio: float = VIABLE_RATIO) -> Column:
    return F.coalesce(area >= ratio * anchor_area, F.lit(False))


def plausible(area: Column, anchor_area: Column) -> Column:
    """Whether a propagated mask keeps enough of its anchor's area."""
    return F.coalesce((area > 0) & (area >= PLAUSIBLE_RATIO * F.greatest(anchor_area, F.lit(1))), F.lit(False))


def anchor_reasons(previous_ok: Column, next_ok: Column, previous_iou: Column, next_iou: Column) -> Column:
    """Why an inner anchor is inconsistent with the tracks that reach it from both sides."""
    p, n = F.when(previous_ok, previous_iou).otherwise(0.0), F.when(next_ok, next_iou).otherwise(0.0)
    name = (
        F.when(previous_ok & next_ok & (F.greatest(p, n) < ANCHOR_IOU), "adjacent_tracks_disagree")
        .when(~previous_ok & next_ok & (n < ANCHOR_IOU), "previous_track_collapsed_next_track_disagrees")
        .when(previous_ok & ~next_ok & (p < ANCHOR_IOU), "next_track_collapsed_previous_track_disagrees")
    )
    return F.array_compact(F.array(name))


def adjacent(df: DataFrame, keys: Sequence[str], columns: Sequence[str], index: str = "frame_index") -> DataFrame:
    """Columns previous_x and next_x of the neighbouring anchors of a track."""
    w = Window.partitionBy(*keys).orderBy(index)
    for c in columns:
        df = df.withColumn(f"previous_{c}", F.lag(c).over(w)).withColumn(f"next_{c}", F.lead(c).over(w))
    return df


def motion_threshold(keys: Sequence[str], motion: str = "motion") -> tuple[Column, Column]:
    """Two window columns: the median of positive motion, and from a column ``_mid`` of it the
    threshold max(1.25, median + 1.5 MAD), infinite where there is no positive motion."""
    whole = Window.partitionBy(*keys)
    positive = F.when(F.col(motion) > 0, F.col(motion))
    spread = F.median(F.when(F.col(motion) > 0, F.abs(F.col(motion) - F.col("_mid")))).over(whole)
    limit = F.greatest(F.lit(LEAST_MOTION), F.col("_mid") + 1.5 * spread)
    return F.median(positive).over(whole), F.when(F.col("_mid").isNull(), float("inf")).otherwise(limit)


def lifecycle_splits(df: DataFrame, keys: Sequence[str], fps: float = 30.0) -> DataFrame:
    """Intervals that change their object: keys, old_end, new_start, split_reason and the signals' frames.

    ``df`` has an interval's rows: offset (0, 1, ...), forward_area, backward_area, left_area,
    right_area, iou and motion. Of forward collapse, disagreement of directions and
    independent motion two must hold, the collapse among them. All signals are windows over
    one partitioning by the keys, so an interval's rows are shuffled once.
    """
    k, whole = list(keys), Window.partitionBy(*keys)
    mid, limit = motion_threshold(keys)
    fwd, bwd = viable(F.col("forward_area"), F.col("left_area")), viable(F.col("backward_area"), F.col("right_area"))
    rows = df.withColumn("_mid", mid).withColumn("motion_threshold", limit)
    rows = rows.select(*k, "offset", "motion_threshold", fwd.alias("f"), bwd.alias("b"), (fwd & bwd & F.coalesce(F.col("iou") < DISAGREE_IOU, F.lit(False))).alias("d"), (F.coalesce("motion", F.lit(0.0)) >= F.col("motion_threshold")).alias("m"))

    def starts(flag: Column, run: int) -> Column:
        """Where a run of ``run`` true rows that ends here has begun."""
        span = whole.orderBy("offset").rowsBetween(1 - run, 0)
        return F.when((F.sum(flag.cast("int")).over(span) == run) & (F.count("*").over(span) == run), F.col("offset") - (run - 1))

    signals = {"collapse": (~F.col("f"), COLLAPSE_RUN), "disagreement": (F.col("d"), SIGNAL_RUN), "motion_at": (F.col("m"), SIGNAL_RUN), "back": (F.col("b"), SIGNAL_RUN)}
    for name, (flag, run) in signals.items():
        rows = rows.withColumn(f"_{name}", starts(flag, run))
    steady = max(1, round(fps * STABLE_SECONDS))
    rows = rows.withColumn("last", F.max("offset").over(whole)).withColumn("_cand", F.least(F.col("last"), F.min("_motion_at").over(whole) + steady))
    first = lambda c: F.min(f"_{c}").alias(c)
    out = rows.groupBy(*k, "last", "motion_threshold").agg(first("collapse"), first("disagreement"), first("motion_at"), F.min(F.when(F.col("_back") >= F.col("_cand"), F.col("_back"))).alias("stable_at"))
    out = out.where("collapse is not null and (disagreement is not null or motion_at is not null)").withColumn("old_end", F.greatest(F.col("collapse") - 1, F.lit(0)))
    near = F.col("last") - ANCHOR_REACH
    begin = F.when(F.col("disagreement").isNotNull(), F.col("old_end") + 1).otherwise(F.greatest(F.col("old_end") + 1, F.coalesce("stable_at", near)))
    why = F.when(F.col("disagreement").isNotNull(), "directional_disagreement").when(F.col("stable_at").isNotNull(), "post_motion_backward_stability").otherwise("anchor_proximity_fallback")
    return out.select(*k, "old_end", begin.alias("new_start"), why.alias("split_reason"), F.col("collapse").alias("collapse_frame"), F.col("disagreement").alias("disagreement_frame"), F.col("motion_at").alias("motion_frame"), "motion_threshold")


def instance_ids(intervals: DataFrame, keys: Sequence[str], split: Column, index: str = "start_frame") -> DataFrame:
    """The instance an interval starts with: 1, and one more after each split before it."""
    w = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    return intervals.withColumn("instance_id", F.coalesce(F.sum(split.cast("long")).over(w), F.lit(0)) + 1)


def zone(offset: Column, old_end: Column, new_start: Column, at_start: Column, at_end: Column, instance: Column) -> Column:
    """Struct (direction, source, instance) of a frame of an interval that splits."""
    return (
        F.when(offset <= old_end, F.struct(F.lit("forward").alias("direction"), F.when(at_start, "object_anchor").otherwise("cutie_lifecycle_forward").alias("source"), instance.alias("instance_id")))
        .when(offset >= new_start, F.struct(F.lit("backward").alias("direction"), F.when(at_end, "object_anchor").otherwise("cutie_lifecycle_backward").alias("source"), (instance + 1).alias("instance_id")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("direction"), F.lit("lifecycle_quarantine").alias("source"), F.lit(None).cast("bigint").alias("instance_id")))
    )


def joined_directions(forward: DataFrame, backward: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All frames that either direction has; columns forward_x and backward_x."""
    k = list(keys)
    side = lambda d, p: d.select(*k, *(F.col(c).alias(f"{p}_{c}") for c in d.columns if c not in k))
    return side(forward, "forward").join(side(backward, "backward"), k, "full")


def fused_source(forward: Column, backward: Column, kept: Column) -> Column:
    """Where the mask of an inner frame comes from."""
    both = forward.isNotNull() & backward.isNotNull()
    return F.when(~kept, "cutie_incoherent").when(both, "cutie_bidirectional").when(forward.isNotNull(), "cutie_forward_only").otherwise("cutie_backward_only")


def last_write(rows: DataFrame, keys: Sequence[str], priority: str, mask: str) -> DataFrame:
    """One row for each key: that of highest priority, but the mask is the last that isn't null."""
    k = list(keys)
    other = [c for c in rows.columns if c not in (*k, priority, mask)]
    top = F.max(F.struct(priority, *other)).alias("_t")
    held = F.max(F.when(F.col(mask).isNotNull(), F.struct(priority, mask))).alias("_m")
    return rows.groupBy(*k).agg(top, held).select(*k, *(F.col(f"_t.{c}").alias(c) for c in other), F.col(f"_m.{mask}").alias(mask))


def visibility(area: Column, box: Column, frame: Column, first_anchor: Column, width, height) -> Column:
    """How an object is seen: ``area`` is null without a mask, ``box`` is x, y, width, height."""
    w, h = (F.lit(v) if not isinstance(v, Column) else v for v in (width, height))
    edge = (box[0] <= 1) | (box[1] <= 1) | (box[0] + box[2] >= w - 1) | (box[1] + box[3] >= h - 1)
    return (
        F.when(area.isNull(), F.when(frame < first_anchor, "out_of_frame").otherwise("rejected"))
        .when(area == 0, "fully_occluded")
        .when(edge, "partially_occluded")
        .otherwise("visible")
    )


def dense_tracks(frames: DataFrame, objects: DataFrame, state: DataFrame) -> DataFrame:
    """Every frame of an episode with every object of it, with the state where there is one.

    ``frames`` and ``objects`` share ``episode``; ``state`` is keyed by episode, frame_index and
    object_id. An object's rows are made by joining on the episode, so an episode's frames
    times its objects are the rows of the result.
    """
    spine = frames.join(objects, "episode")
    out = spine.join(state, ["episode", "frame_index", "object_id"], "left")
    fill = {"confidence": 0.0, "source": "untracked", "directional_iou": 0.0, "primary_component_fraction": 0.0}
    return out.fillna({c: v for c, v in fill.items() if c in state.columns})


def object_reason(object_id: Column, seen: Column, source: Column) -> Column:
    """The reason of a rejected object; null for others."""
    name = F.when(source == "lifecycle_quarantine", "lifecycle_ambiguous").otherwise("missing_track")
    return F.when(seen == "rejected", F.concat(F.lit("object_"), object_id.cast("string"), F.lit("_"), name))


def object_frame_quality(tracks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frames with confidence (least of what is seen, else 0 with reasons and 0.75 without), status, reasons."""
    counts = F.col("mask_area_px").isNotNull() & ~F.col("visibility").isin("fully_occluded", "out_of_frame", "rejected")
    why = F.when(F.col("visibility") == "rejected", F.struct("object_id", object_reason(F.col("object_id"), F.col("visibility"), F.col("source")).alias("r")))
    out = tracks.groupBy(*keys).agg(F.min(F.when(counts, F.col("confidence"))).alias("_c"), F.transform(F.array_sort(F.collect_list(why)), lambda x: x["r"]).alias("reasons"))
    bad = F.size("reasons") > 0
    return out.select(*keys, F.coalesce("_c", F.when(bad, 0.0).otherwise(0.75)).alias("confidence"), F.when(bad, "rejected").otherwise("accepted").alias("status"), "reasons")
