"""Ordered folds: operators whose next step depends on what they decided before.

The rows of a key stream through one task in order, batch by batch, with the state of the last
row carried along; keys run in parallel. Time is in proportion to rows and memory to a batch,
however long a key is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# Gates of trusted anchors.
LOW_ANCHOR, LOW_SEMANTIC, COLLAPSE_RATIO, COLLAPSE_SCORE, HISTORY = 0.40, 0.50, 0.15, 0.72, 5


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], step: Callable, result: str) -> DataFrame:
    """(keys, order, values) of every row with the columns ``result`` (DDL) that ``step`` gives it.

    step(state, values) returns the next state and the result as a tuple; the state is None
    before a key's first row. Equal rows by ``order`` come in no order of their own.
    """
    columns = [*keys, *order, *values]
    rows = df.select(*columns).repartition(*keys).sortWithinPartitions(*keys, *order)
    added = StructType.fromDDL(result)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    names = [*columns, *added.fieldNames()]
    n, first = len(keys), len(keys) + len(order)

    def run(batches):
        now, state = None, None
        for b in batches:
            lists = [c.to_pylist() for c in b.columns]
            got = []
            for key, row in zip(zip(*lists[:n], strict=True), zip(*lists[first:], strict=True), strict=True):
                if key != now:
                    now, state = key, None
                state, out = step(state, row)
                got.append(out)
            more = list(zip(*got, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(more, kinds, strict=True))], names=names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *added.fields]))


def increasing_times(df: DataFrame, keys: Sequence[str], time: str = "timestamp_s", index: str = "frame_index", fallback: float = 1 / 30) -> DataFrame:
    """Strictly increasing times: one that doesn't exceed the last is the last plus the median step."""
    whole = Window.partitionBy(*keys)
    gap = F.col(time) - F.lag(time).over(whole.orderBy(index))
    stepped = df.withColumn("_g", gap)
    step = F.coalesce(F.median(F.when(F.col("_g") > 0, F.col("_g"))).over(whole), F.lit(fallback))
    rows = stepped.withColumn("_step", step).select(*keys, index, F.col(time).alias("_t"), "_step")

    def later(last, row):
        t, width = row
        if last is not None and t is not None:
            t = t if t > last else last + width
        elif last is not None:
            t = last + width
        return t, (t,)

    out = fold(rows, keys, [index], ["_t", "_step"], later, "time double")
    return out.select(*keys, index, F.col("_t").alias(time), "time")


def smoothed_bounds(df: DataFrame, keys: Sequence[str], index: str = "frame_index", alpha: float = 0.15) -> DataFrame:
    """Running bounds of rows (low, high, reset): fresh on the first row and on a reset, else
    1 - alpha of the last and alpha of the row's. A high not above its low is low + 1e-6; rows
    without values (null low) are 0 and 1."""
    low = F.coalesce("low", F.lit(0.0))
    high = F.when(F.col("low").isNull(), F.lit(1.0)).when(F.col("high") <= F.col("low"), F.col("low") + 1e-6).otherwise(F.col("high"))
    rows = df.withColumn("fresh", F.col("low").isNull() | F.coalesce("reset", F.lit(False))).withColumn("high", high).withColumn("low", low)

    def mix(last, row):
        *now, fresh = row
        if last is not None and not fresh:
            now = [(1 - alpha) * a + alpha * b for a, b in zip(last, now, strict=True)]
        return now, tuple(now)

    out = fold(rows, keys, [index], ["low", "high", "fresh"], mix, "normalization_low double, normalization_high double")
    return out.select(*keys, index, "normalization_low", "normalization_high")


def trusted_anchors(df: DataFrame, keys: Sequence[str], index: str = "frame_index") -> DataFrame:
    """Rows (area, score, manual, has_confidence) with recent_area, reasons and accepted.

    A row is rejected for a low score (gate 0.40 with an anchor confidence, else 0.50), or for an
    area below 0.15 of the median of the last five accepted ones while its score is below 0.72.
    Manual rows never are. Rejected rows don't enter the history.
    """
    gate = F.when(F.col("has_confidence"), LOW_ANCHOR).otherwise(LOW_SEMANTIC)
    rows = df.withColumn("low", ~F.col("manual") & (F.col("score") < gate)).withColumn("area", F.col("area").cast("double"))

    def judge(history, row):
        area, score, manual, low = row
        history = history or ()
        recent = median(history) if history else area
        fragment = bool(history) and not manual and area < COLLAPSE_RATIO * recent and score < COLLAPSE_SCORE
        return (history if low or fragment else (*history, area)[-HISTORY:]), (recent, fragment)

    out = fold(rows, keys, [index], ["area", "score", "manual", "low", "has_confidence"], lambda s, r: judge(s, r[:4]), "recent_area double, fragment boolean")
    name = F.when(F.col("has_confidence"), "low_anchor_confidence").otherwise("low_semantic_score")
    reasons = F.array_compact(F.array(F.when(F.col("low"), name), F.when(F.col("fragment"), F.lit("fragment_area_collapse"))))
    out = out.select(*keys, index, "area", "score", "recent_area", reasons.alias("reasons"))
    return out.withColumn("accepted", F.size("reasons") == 0)


def best_detection(boxes: np.ndarray, confidence: np.ndarray, last: np.ndarray | None, diagonal: float) -> int:
    """The place of the most confident box; with a last box, of the best of 0.55 confidence + 0.30 overlap
    + 0.15 nearness of centres. Of equals the first."""
    score = confidence
    if last is not None:
        both = np.maximum(np.minimum(boxes[:, 2:], last[2:]) - np.maximum(boxes[:, :2], last[:2]), 0).prod(1)
        union = np.maximum(boxes[:, 2:] - boxes[:, :2], 0).prod(1) + np.maximum(last[2:] - last[:2], 0).prod() - both
        iou = np.divide(both, union, out=np.zeros_like(both), where=union > 0)
        away = np.linalg.norm((boxes[:, :2] + boxes[:, 2:] - last[:2] - last[2:]) / 2, axis=1)
        score = 0.55 * confidence + 0.30 * iou + 0.15 * np.maximum(0.0, 1 - away / diagonal)
    return int(np.argmax(score))


def temporal_selection(df: DataFrame, keys: Sequence[str], width: int, height: int, reach: int = 12, index: str = "frame_index") -> DataFrame:
    """Of the detections (box, confidence, ordinal) of each frame the one that goes on from before.

    Without a chosen box in the ``reach`` frames before, the most confident; else the best by
    ``best_detection``. A frame's detections are gathered; frames are folded in order.
    """
    diagonal = max(float(np.hypot(width, height)), 1.0)
    other = [c for c in df.columns if c not in (*keys, index, "ordinal")]
    frames = df.groupBy(*keys, index).agg(F.array_sort(F.collect_list(F.struct("ordinal", *other))).alias("_rows"))
    frames = frames.withColumn("_boxes", F.col("_rows.box")).withColumn("_conf", F.col("_rows.confidence")).withColumn("_at", F.col(index))

    def choose(last, row):
        boxes, confidence, frame = np.array(row[0], float), np.array(row[1], float), row[2]
        near = last[1] if last is not None and frame - last[0] <= reach else None
        i = best_detection(boxes, confidence, near, diagonal)
        return ((frame, boxes[i]) if np.isfinite(boxes[i]).all() else last), (i,)

    chosen = fold(frames, keys, [index], ["_boxes", "_conf", "_at", "_rows"], choose, "_i int")
    row = F.element_at("_rows", F.col("_i") + 1)
    return chosen.select(*keys, index, row.alias("_r")).select(*(F.col(c) if c in (*keys, index) else F.col(f"_r.{c}").alias(c) for c in df.columns))
