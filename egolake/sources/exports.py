"""Sinks: nested payloads, dataset layouts, reports and atomic files."""

from __future__ import annotations

import html
import json
import os
import shutil
import tempfile
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import frame_file
from ..operators.sequence import step_flags

SCHEMA_VERSION = "1.0.0"
#: Intervals that the report's page shows; its JSON has all.
REPORT_ROWS = 500


# nested rows ---------------------------------------------------------------


def frame_payloads(frames: DataFrame, objects: DataFrame, hands: DataFrame, depth: DataFrame, keys: Sequence[str] = ("episode",)) -> DataFrame:
    """Frames with their objects (array), hands (map by side, the last in order of its columns) and depth.

    What a frame lacks is an empty array, an empty map or null. All sides are gathered by frame
    in one shuffle; rows of frames that aren't there are dropped.
    """
    k = [*keys, "frame_index"]
    rest = lambda df, *drop: [c for c in df.columns if c not in (*k, *drop)]
    parts = {
        "_f": frames.select(*k, F.struct("timestamp_s").alias("_f")),
        "_o": objects.select(*k, F.struct("object_id", *rest(objects, "object_id")).alias("_o")),
        "_h": hands.select(*k, F.struct("handedness", F.struct(*rest(hands, "handedness")).alias("h")).alias("_h")),
        "_d": depth.select(*k, F.struct(*rest(depth)).alias("_d")),
    }
    kinds = {c: df.schema[c].dataType for c, df in parts.items()}
    rows = reduce(DataFrame.unionByName, (df.select(*k, *(F.col(c) if c == own else F.lit(None).cast(kinds[c]).alias(c) for c in parts)) for own, df in parts.items()))
    out = rows.groupBy(*k).agg(F.max("_f").alias("_f"), F.array_sort(F.collect_list("_o")).alias("objects"), F.array_sort(F.collect_list("_h")).alias("_h"), F.max("_d").alias("depth")).where("_f is not null")
    last = F.filter("_h", lambda x, i: F.coalesce(F.get(F.col("_h"), i + 1)["handedness"] != x["handedness"], F.lit(True)))
    index = F.col("frame_index")
    return out.select(
        *k, F.col("_f.timestamp_s").alias("timestamp"), "objects", F.map_from_entries(last).alias("hands"), "depth",
        frame_file(index, "source/frames", "jpg").alias("rgb_frame"), F.when(F.col("depth").isNotNull(), frame_file(index, "depth/frames", "npz")).alias("depth_frame"),
    )


def as_json(payloads: DataFrame) -> DataFrame:
    """Nested columns as JSON text, with null fields written; a missing depth is {}."""
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    nested = {"objects_json": text("objects"), "hands_json": text("hands"), "depth_metadata_json": F.coalesce(text("depth"), F.lit("{}"))}
    plain = [c for c in payloads.columns if c not in ("objects", "hands", "depth")]
    return payloads.select(*plain, *(v.alias(c) for c, v in nested.items()))


def coco_annotations(tracks: DataFrame, masks: DataFrame, episode: Sequence[str], order: Sequence[str], on: Sequence[str]) -> DataFrame:
    """Tracks that have a mask, with ids by their place among all tracks of the episode."""
    numbered = tracks.withColumn("id", F.row_number().over(Window.partitionBy(*episode).orderBy(*order)).cast("long"))
    out = numbered.join(masks.select(*on, F.col("rle").alias("segmentation")), list(on))
    return out.withColumn("image_id", F.col("frame_index") + 1).withColumn("category_id", F.col("object_id")).withColumn("instance_id", F.col("object_id")).withColumn("iscrowd", F.lit(0))


def coco_categories(tracks: DataFrame, episode: Sequence[str], order: str) -> DataFrame:
    """The last label of each object."""
    return tracks.groupBy(*episode, "object_id").agg(F.max(F.struct(order, "label")).alias("_l")).select(*episode, "object_id", F.col("_l.label").alias("label"))


# files ---------------------------------------------------------------------


def save_json(data, path: str) -> None:
    """Write a document beside its place and move it there."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, part = tempfile.mkstemp(dir=folder, suffix=".tmp")
    try:
        with os.fdopen(fd, "w") as f:
            json.dump(data, f, indent=2)
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise


def save_table(rows: DataFrame, path: str) -> None:
    """Write a table in place of the one there; a table without rows keeps its schema."""
    rows.write.mode("overwrite").parquet(path)


def save_arrays(path: str, compressed: bool = False, **arrays: np.ndarray) -> None:
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, part = tempfile.mkstemp(dir=folder, suffix=".tmp")
    try:
        with os.fdopen(fd, "wb") as f:
            (np.savez_compressed if compressed else np.savez)(f, **arrays)
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise


def link_or_copy(source: str, target: str) -> None:
    """A hard link, or a copy where files can't be linked; what is there is replaced."""
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    if os.path.lexists(target):
        os.unlink(target)
    try:
        os.link(source, target)
    except OSError:
        shutil.copy2(source, target)


def stream_json(rows: DataFrame, path: str, name: str, head: Mapping | None = None) -> None:
    """A document with the rows as a list under ``name``, written as they stream in, in their order."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path + ".tmp", "w") as f:
        begin = json.dumps(dict(head or {}))[:-1]
        f.write(begin + (", " if head else "") + json.dumps(name) + ": [")
        _stream(rows, f)
        f.write("]}")
    os.replace(path + ".tmp", path)


def _stream(rows: DataFrame, f) -> int:
    n = 0
    for row in rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
        f.write((", " if n else "") + row.j)
        n += 1
    return n


def quality_document(frames: DataFrame, intervals: DataFrame, path: str) -> None:
    """A stage's quality: its frames and its quarantined intervals, in the order given."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write('{"frames": [')
        _stream(frames, f)
        f.write('], "quarantined_intervals": [')
        _stream(intervals, f)
        f.write("]}")
    os.replace(path + ".tmp", path)


def single_file(rows: DataFrame, path: str) -> None:
    """One Parquet file, as other readers of a layout expect, of rows in their order; an empty table has its schema.

    The rows are written by tasks into a folder beside it, and their row groups are copied one by one.
    """
    part = f"{path}.parts"
    rows.write.mode("overwrite").parquet(part)
    files = sorted(f"{part}/{f}" for f in os.listdir(part) if f.endswith(".parquet"))
    if os.path.isdir(path):
        shutil.rmtree(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with pq.ParquetWriter(path + ".tmp", pq.read_schema(files[0])) as out:
        for f in files:
            with pq.ParquetFile(f) as one:
                for g in range(one.num_row_groups):
                    out.write_table(one.read_row_group(g))
    os.replace(path + ".tmp", path)
    shutil.rmtree(part)


# Paths, names and texts of the dataset layouts.
LAYOUT = {
    "coco_description": "Model-derived egocentric object tracks", "lerobot_version": "v3.0", "robot": "human_egocentric", "task": "egocentric demonstration",
    "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video_path": "videos/{video_key}/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.mp4",
    "video": "videos/observation.images.egocentric/chunk-000/episode_000000.mp4", "rlds": "RLDS episode/steps interchange", "episode": "episode_000000",
}


# datasets ------------------------------------------------------------------


def export_coco(tracks: DataFrame, masks: DataFrame, metadata: Mapping, path: str) -> None:
    """One video's annotations as a COCO document; the annotations are written as they stream in."""
    one = tracks.withColumn("episode", F.lit(0))
    rows = coco_annotations(one, masks.withColumn("episode", F.lit(0)), ["episode"], ["frame_index", "object_id"], ["episode", "frame_index", "object_id"])
    fields = F.struct(
        "id", "image_id", F.lit(1).alias("video_id"), "category_id", "instance_id", F.array("bbox_x", "bbox_y", "bbox_width", "bbox_height").alias("bbox"), F.col("mask_area_px").alias("area"), "segmentation", "iscrowd", "visibility", "confidence"
    )
    names = sorted((r.object_id, r.label) for r in coco_categories(one.withColumn("_o", F.struct("frame_index", "object_id")), ["episode"], "_o").collect())
    head = {
        "info": {"description": LAYOUT["coco_description"], "schema_version": SCHEMA_VERSION}, "videos": [{"id": 1, "file_name": os.path.basename(metadata["input_video"])}], "categories": [{"id": i, "name": n} for i, n in names],
    }
    size = {"width": metadata["decoded_width"], "height": metadata["decoded_height"]}
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write(json.dumps(head)[:-1] + ', "images": [')
        for i in range(metadata["frame_count"]):
            f.write((", " if i else "") + json.dumps({"id": i + 1, "video_id": 1, "frame_id": i, "file_name": f"{i:08d}.jpg", **size}))
        f.write('], "annotations": [')
        _stream(rows.orderBy("id").select(fields.alias("a")).select("a.*"), f)
        f.write("]}")
    os.replace(path + ".tmp", path)


def export_lerobot(payloads: DataFrame, metadata: Mapping, folder: str) -> None:
    """Episode data, info, episodes and tasks; the rate is frames over the duration, else 30."""
    spark = payloads.sparkSession
    rows = as_json(payloads).withColumnRenamed("episode", "episode_index").orderBy("frame_index")
    single_file(rows, f"{folder}/data/chunk-000/{LAYOUT['episode']}.parquet")
    n = payloads.count()
    duration = metadata.get("duration_s") or 0
    kinds = {"timestamp": "float64", "frame_index": "int64", "episode_index": "int64", "objects_json": "string", "hands_json": "string", "depth_metadata_json": "string"}
    save_json({
        "codebase_version": LAYOUT["lerobot_version"], "robot_type": LAYOUT["robot"], "total_episodes": 1, "total_frames": n, "total_tasks": 1, "fps": n / duration if duration > 0 else 30.0, "chunks_size": 1000,
        "data_path": LAYOUT["data_path"], "video_path": LAYOUT["video_path"],
        "features": {k: {"dtype": v, "shape": [1]} for k, v in kinds.items()},
    }, f"{folder}/meta/info.json")
    single_file(spark.createDataFrame([(0, n, 0)], "episode_index long, length long, task_index long"), f"{folder}/meta/episodes.parquet")
    single_file(spark.createDataFrame([(0, LAYOUT["task"])], "task_index long, task string"), f"{folder}/meta/tasks.parquet")
    video = metadata.get("input_video")
    if video and os.path.exists(video):
        link_or_copy(video, f"{folder}/{LAYOUT['video']}")


def export_rlds(payloads: DataFrame, folder: str) -> None:
    """Steps with their flags, and the episode's document."""
    steps = step_flags(as_json(payloads), ["episode"]).withColumnRenamed("episode", "episode_index")
    single_file(steps.orderBy("frame_index"), f"{folder}/steps.parquet")
    save_json({"episode_id": LAYOUT["episode"], "num_steps": steps.count(), "logical_schema": LAYOUT["rlds"]}, f"{folder}/episode_metadata.json")


def quality_report(rows: DataFrame, intervals: DataFrame, folder: str) -> None:
    """Scores as Parquet (if there are any), intervals as JSON, and a page with both in short."""
    scores = rows.withColumn("reasons", F.to_json("reasons"))
    if not rows.isEmpty():
        scores.write.mode("overwrite").parquet(f"{folder}/frame_scores.parquet")
    shown = [json.loads(r.j) for r in intervals.orderBy("stage", "start_frame").limit(REPORT_ROWS).select(F.to_json(F.struct("stage", "start_frame", "end_frame", "reasons")).alias("j")).collect()]
    total = intervals.count()
    with open(f"{folder}/quarantined_intervals.json.tmp", "w") as f:
        f.write("[")
        _stream(intervals.orderBy("stage", "start_frame").select("stage", "start_frame", "end_frame", "reasons"), f)
        f.write("]")
    os.replace(f"{folder}/quarantined_intervals.json.tmp", f"{folder}/quarantined_intervals.json")
    counts: dict[str, dict[str, int]] = {}
    for r in rows.groupBy("stage", "status").count().orderBy("stage", "status").collect():
        counts.setdefault(r["stage"], {})[r["status"]] = r["count"]
    show = lambda x: html.escape(json.dumps(x, indent=2))
    page = f"<!doctype html><meta charset=utf-8><title>Quality report</title><h1>Quality report</h1><p>All results are predictions of models. Depth is relative.</p><h2>Frames by status</h2><pre>{show(counts)}</pre><h2>Quarantined intervals</h2><p>{total} in all; the first {len(shown)}:</p><pre>{show(shown)}</pre>"
    with open(f"{folder}/report.html", "w") as f:
        f.write(page)
