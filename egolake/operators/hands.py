"""Hand trajectories: plausibility, states and frame quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import camera_translation, dot, finite, projected
from .folds import best_detection, fold, increasing_times
from .sequence import derivatives, interpolated, smoothed, suppress_short_runs

# Bounds of plausible hands, and joints of the finger tips.
DEPTH, SPEED, ACCELERATION, ACCEPT, INFERRED_CONFIDENCE = (0.15, 3.0), 5.0, 100.0, 0.3, 0.35
FINGERTIPS = (4, 8, 12, 16, 20)
SIDES = ("left", "right")
# Padding of the second detection (least pixels and share of the side), least side of a hand, scale of its crop, frames that a hand is looked back for.
PAD_X, PAD_Y, LEAST_SIDE, CROP_SCALE, REACH = (96, 0.16), (72, 0.14), 8.0, 2.0, 12


def padding(width: Column, height: Column) -> tuple[Column, Column]:
    """Pixels that an image is padded by for a second detection, across and down."""
    return F.greatest(F.lit(PAD_X[0]), F.bround(width * PAD_X[1]).cast("int")), F.greatest(F.lit(PAD_Y[0]), F.bround(height * PAD_Y[1]).cast("int"))


def shifted_detections(df: DataFrame, offset_x: Column, offset_y: Column, width: Column, height: Column) -> DataFrame:
    """Detections (box) moved back by a padding and cut to the image; those of less than eight pixels a side go."""
    cut = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top - 1.0)
    b = F.col("box")
    out = df.withColumn("box", F.array(cut(b[0] - offset_x, width), cut(b[1] - offset_y, height), cut(b[2] - offset_x, width), cut(b[3] - offset_y, height)))
    return out.where((F.col("box")[2] - F.col("box")[0] >= LEAST_SIDE) & (F.col("box")[3] - F.col("box")[1] >= LEAST_SIDE))


def with_padded(primary: DataFrame, padded: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Detections (handedness, ...) and, for frames that have none or lack an expected side, also those of the padded image.

    ``expected`` has the sides (keys, handedness) that a frame should have.
    """
    lacking = expected.join(primary.select(*keys, "handedness").distinct(), [*keys, "handedness"], "left_anti").select(*keys)
    empty = padded.select(*keys).distinct().join(primary.select(*keys).distinct(), list(keys), "left_anti")
    again = padded.join(lacking.unionByName(empty).distinct(), list(keys), "left_semi")
    return primary.unionByName(again)


HAND = "struct<handedness: string, box: array<double>, confidence: double, keypoints: array<array<double>>, joints: array<array<double>>, camera: array<double>>"


def _found(hands: list[dict], dx: int, dy: int, shape: tuple[int, int]) -> list[dict]:
    out = []
    for hand in hands:
        box = np.asarray(hand["box"], float) - [dx, dy, dx, dy]
        box = np.clip(box, 0, [shape[1] - 1, shape[0] - 1] * 2)
        if min(box[2] - box[0], box[3] - box[1]) >= LEAST_SIDE:
            points = np.asarray(hand.get("keypoints") or np.full((21, 3), np.nan), float) - [dx, dy, 0]
            out.append(hand | {"box": box, "keypoints": points})
    return out


def detected_hands(frames: DataFrame, keys: Sequence[str], backend) -> DataFrame:
    """The hand stage's models on frames (keys, frame_index, timestamp_s, content), in order: one row for each
    frame and hand chosen, with its box, keypoints, joints and weak-perspective camera.

    Where no hand is found, or a side that was seen in the REACH frames before is missing, the
    image is mirrored outwards and looked at again. Of a side's detections the one that goes
    on from before is taken.
    """

    def step(last, row):
        at, image = row[1], backend.decode(row[0])
        h, w = image.shape[:2]
        before = {side: box for side, (i, box) in (last or {}).items() if at - i <= REACH}
        hands = _found(backend.hands(image), 0, 0, (h, w))
        if not hands or set(before) - {x["handedness"] for x in hands}:
            px, py = max(PAD_X[0], round(w * PAD_X[1])), max(PAD_Y[0], round(h * PAD_Y[1]))
            mode = "reflect" if min(h - py, w - px) > 0 else "symmetric"
            hands += _found(backend.hands(np.pad(image, ((py, py), (px, px), (0, 0)), mode=mode)), px, py, (h, w))
        out, state = [], dict(last or {})
        for side in sorted({x["handedness"] for x in hands}):
            own = [x for x in hands if x["handedness"] == side]
            pick = own[best_detection(np.stack([x["box"] for x in own]), np.array([x["confidence"] for x in own]), before.get(side), max(float(np.hypot(w, h)), 1.0))]
            pose = backend.reconstruct(image, pick["box"].tolist(), side == "right")
            state[side] = (at, pick["box"])
            out.append({"handedness": side, "box": pick["box"].tolist(), "confidence": float(pick["confidence"]), "keypoints": pick["keypoints"].tolist(), "joints": [list(map(float, j)) for j in pose["joints"]], "camera": list(map(float, pose["camera"]))})
        return state, (out, w, h)

    rows = frames.where(F.col("content").isNotNull()).withColumn("_at", F.col("frame_index"))
    done = fold(rows, keys, ["frame_index", "timestamp_s"], ["content", "_at"], step, f"hands array<{HAND}>, width int, height int")
    return done.select(*keys, "frame_index", "timestamp_s", "width", "height", F.explode("hands").alias("_h")).select(*keys, "frame_index", "timestamp_s", "width", "height", "_h.*")


def placed_hands(found: DataFrame, focal: Column) -> DataFrame:
    """Detected hands with translation, joints_camera (in the full camera), points (their pixels), projection_ok and landmarks_ok."""
    b = F.col("box")
    size = CROP_SCALE * F.greatest(b[2] - b[0], b[3] - b[1])
    camera = F.col("camera")
    move = camera_translation(camera[0], camera[1], camera[2], b, size, focal, F.col("width"), F.col("height"))
    out = found.withColumn("translation", move)
    out = out.withColumn("joints_camera", F.transform("joints", lambda j: F.zip_with(j, F.col("translation"), lambda x, y: x + y)))
    out = out.withColumn("points", projected(F.col("joints_camera"), focal, F.col("width"), F.col("height")))
    out = out.withColumn("projection_ok", projection_fits(F.col("points"), b, F.col("width"), F.col("height")))
    return out.withColumn("landmarks_ok", landmarks_fit(F.col("points"), F.col("keypoints"), b))


def hand_stage(frames: DataFrame, placed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Trajectories of both hands, and the quality of every frame (keys, frame_index, timestamp_s), from ``placed_hands``."""
    spine = frames.select(*keys, "frame_index", "timestamp_s").withColumn("handedness", F.explode(F.array(*map(F.lit, SIDES))))
    side = [*keys, "handedness"]
    plausible = F.col("projection_ok") & F.col("landmarks_ok") & F.col("translation")[2].between(*DEPTH)
    joints = placed.select(*side, "frame_index", "confidence", F.when(plausible, F.flatten("joints_camera")).alias("joints"))
    paths = trajectories(spine.join(joints, [*side, "frame_index"], "left"), side)
    moving = paths.select(*side, "frame_index", length(F.col("wrist_velocity_mps")).alias("speed"), length(F.col("wrist_acceleration_mps2")).alias("acceleration"))
    judged = placed.join(moving, [*side, "frame_index"], "left")
    why = hand_reasons(F.col("handedness"), F.col("translation")[2], F.col("projection_ok"), F.col("landmarks_ok"), F.col("speed"), F.col("acceleration"))
    judged = spine.join(judged.select(*side, "frame_index", "confidence", why.alias("reasons")), [*side, "frame_index"], "left")
    return paths, hand_frame_quality(judged, [*keys, "frame_index"])


def projection_fits(points: Column, box: Column, width, height) -> Column:
    """Enough projected points lie in the detection (with a margin) and the image, and they spread."""
    mx, my = F.greatest(F.lit(8.0), (box[2] - box[0]) * 0.2), F.greatest(F.lit(8.0), (box[3] - box[1]) * 0.2)
    n = F.size(points).cast("double")
    inside = F.filter(points, lambda p: (p[0] >= box[0] - mx) & (p[0] <= box[2] + mx) & (p[1] >= box[1] - my) & (p[1] <= box[3] + my))
    shown = F.filter(points, lambda p: (p[0] >= 0) & (p[0] < width) & (p[1] >= 0) & (p[1] < height))
    span = lambda i: F.array_max(F.transform(points, lambda p: p[i])) - F.array_min(F.transform(points, lambda p: p[i]))
    ok = (F.size(inside) / n >= 0.7) & (F.size(shown) / n >= 0.8) & (F.greatest(span(0), span(1)) >= 20)
    return F.coalesce(F.forall(points, finite) & ok, F.lit(False))


def _percentile(values: Column, q: float) -> Column:
    """Linear between the sorted values, as numpy does."""
    s = F.array_sort(values)
    at = (F.size(s) - 1) * F.lit(q)
    lo = F.floor(at)
    a, b = F.element_at(s, (lo + 1).cast("int")), F.element_at(s, F.least(lo + 2, F.size(s).cast("long")).cast("int"))
    return a + (b - a) * (at - lo)


def landmarks_fit(points: Column, keypoints: Column, box: Column) -> Column:
    """At least 12 confident keypoints, and projected joints near them for the size of the box."""
    both = F.filter(F.arrays_zip(points.alias("p"), keypoints.alias("k")), lambda x: finite(x["p"]) & finite(x["k"]) & (x["k"][2] >= 0.5))
    error = F.transform(both, lambda x: F.hypot(x["p"][0] - x["k"][0], x["p"][1] - x["k"][1]))
    size = F.greatest(F.hypot(box[2] - box[0], box[3] - box[1]), F.lit(1.0))
    ok = (_percentile(error, 0.5) / size <= 0.16) & (_percentile(error, 0.9) / size <= 0.25)
    return F.coalesce(F.when(F.size(both) >= 12, ok), F.lit(False))


def length(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def hand_reasons(side: Column, depth: Column, projection_ok: Column, landmarks_ok: Column, speed: Column, acceleration: Column) -> Column:
    """Why a hand of a frame isn't plausible; speeds that are unknown or not finite don't count."""
    known = lambda v: v.isNotNull() & ~F.isnan(v) & (v < float("inf"))
    named = lambda bad, name: F.when(bad, F.concat(side, F.lit(f"_{name}")))
    return F.array_compact(F.array(
        named(~F.coalesce(depth.between(*DEPTH), F.lit(False)), "invalid_camera_depth"),
        named(~projection_ok, "reprojection_mismatch"),
        named(~landmarks_ok, "landmark_mismatch"),
        named(known(speed) & (speed > SPEED), "implausible_velocity"),
        named(known(acceleration) & (acceleration > ACCELERATION), "implausible_acceleration"),
    ))


def hand_frame_quality(hands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frames from rows (handedness, confidence, reasons, null reasons for a hand that is not there).

    The best plausible hand is the frame's confidence; an accepted frame has no reasons.
    """
    good = F.col("reasons").isNotNull() & (F.size("reasons") == 0)
    best = F.coalesce(F.max(F.when(good, F.col("confidence"))), F.lit(0.0))
    all_ = F.array_sort(F.collect_list(F.when(~good & F.col("reasons").isNotNull(), F.struct("handedness", "reasons"))))
    out = hands.groupBy(*keys).agg(best.alias("confidence"), F.flatten(F.transform(all_, lambda x: x["reasons"])).alias("_r"))
    ok = F.col("confidence") >= ACCEPT
    none = F.array().cast("array<string>")
    reasons = F.when(ok, none).when(F.size("_r") > 0, F.col("_r")).otherwise(F.array(F.lit("no_reliable_hand")))
    return out.select(*keys, "confidence", F.when(ok, "accepted").otherwise("rejected").alias("status"), reasons.alias("reasons"))


def missing_sides(frames: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sides of each frame that no detection has."""
    every = frames.select(*keys).withColumn("handedness", F.explode(F.array(*map(F.lit, SIDES))))
    return every.join(found.select(*keys, "handedness").distinct(), [*keys, "handedness"], "left_anti")


def trajectories(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dense hand rows (frame_index, timestamp_s, joints, confidence; null joints: none) to trajectories.

    Gaps are filled, runs smoothed, states set, short runs rejected, times made increasing, and
    velocity and acceleration taken of the wrist. Joints are a flat array of x, y, z.
    """
    seen = F.col("joints").isNotNull() & F.coalesce(finite(F.col("joints")), F.lit(False))
    df = interpolated(df, keys, "joints", seen).withColumn("_seen", F.coalesce(seen & ~F.col("inferred"), F.lit(False)))
    df = smoothed(df, keys, "joints", F.col("_seen") | F.col("inferred"))
    state = F.when(F.col("_seen"), "observed").when(F.col("inferred"), "inferred").otherwise("rejected")
    df = df.withColumn("state", state).withColumn("confidence", F.when(F.col("inferred"), INFERRED_CONFIDENCE).when(F.col("_seen"), F.col("confidence")).otherwise(0.0))
    df = suppress_short_runs(df, keys)
    times = increasing_times(df, keys).select(*keys, "frame_index", "time")
    df = df.join(times, [*keys, "frame_index"]).withColumn("wrist_xyz_m", F.slice("joints", 1, 3))
    df = derivatives(df, keys, "wrist_xyz_m", "time", F.col("state") != "rejected")
    tips = F.flatten(F.array(*(F.slice("joints", 3 * j + 1, 3) for j in FINGERTIPS)))
    return df.select(*keys, "frame_index", "timestamp_s", "state", "confidence", "wrist_xyz_m", F.col("velocity").alias("wrist_velocity_mps"), F.col("acceleration").alias("wrist_acceleration_mps2"), tips.alias("fingertips_xyz_m"))
