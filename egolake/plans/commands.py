"""Commands on a job's folder: process, probe, status, seeds and partial rebuilds."""

from __future__ import annotations

import argparse
import hashlib
import importlib
import json
import os
import shutil
from collections.abc import Callable, Mapping, Sequence
from importlib.metadata import PackageNotFoundError, version

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import masks
from ..functions.values import BROAD_PROMPTS, PALETTE, frame_file
from ..models import ModelBackend, candidates
from ..operators import anchors, calibration, folds, kernels, quality, selection, sequence
from ..operators import depth as depth_ops
from ..operators import hands as hand_ops
from ..operators.images import contact_sheet, overlay, png
from ..operators.mask_columns import by_row, depth_previews, overlays
from ..operators.tracks import object_frame_quality
from ..schemas import DEPTH_METADATA, TRACKS
from ..sources import exports, media, tables
from . import tracking
from .stages import ProcessConfig, Stages, run_plan, status_report

STAGES = ("objects", "hands", "depth")


def select_anchors(found: DataFrame, config: ProcessConfig, keyframes: int) -> DataFrame:
    """Objects by the job's mode: prompts, label chains, or any objects."""
    if config.object_mode:
        return anchors.prompted_objects(found, config.target_labels)
    if config.target_labels:
        return anchors.label_chains(found, config.target_labels, keyframes)
    return anchors.agnostic_objects(found, keyframes, config.max_auto_objects)


def discover(spark: SparkSession, config: ProcessConfig, backend: ModelBackend, frames: DataFrame | None = None) -> DataFrame:
    """Candidates of the key frames of a job, and the objects chosen of them."""
    frames = frames if frames is not None else tables.frame_images(spark, f"{config.output}/source/frames")
    return select_anchors(job_candidates(frames, config, backend), config, sequence.keyframes(frames, config.anchor_stride).count())


def probe_objects(frames: DataFrame, backend: ModelBackend, prompts: Sequence[str], indexes: Sequence[int], k: int = 8) -> DataFrame:
    """The k best candidates of each frame and prompt, of the frames named."""
    from ..operators.selection import suppress_overlaps, top_k

    if len({p.casefold() for p in prompts}) < len(prompts) or any(i < 0 for i in indexes):
        raise ValueError("prompts must differ and frames not be negative")
    last = frames.agg(F.max("frame_index")).first()[0]
    indexes = [i for i in indexes if last is not None and i <= last]
    if not indexes:
        raise ValueError("none of the frames is in the video")
    found = candidates(frames.where(F.col("frame_index").isin(*indexes)), backend, prompts).drop("clip_logits", "mask_rle", "embedding")
    found = suppress_overlaps(found, ["frame_index", "prompt"], ["ordinal"], [False], 0.88)
    return top_k(found, ["frame_index", "prompt"], F.col("detector_score"), ["ordinal"], k)


def probe_report(frames: DataFrame, backend: ModelBackend, found: DataFrame, prompts: Sequence[str], folder: str, side: int = 480) -> None:
    """The candidates of a probe without their masks, and a sheet of the frames with their boxes.

    A probe names its frames and keeps a few candidates of each, so both are small.
    """
    rows = found.orderBy("frame_index", "prompt", F.desc("detector_score")).collect()
    exports.save_json({"prompts": list(prompts), "candidates": [r.asDict(recursive=True) for r in rows]}, f"{folder}/summary.json")
    shown = []
    indexes = sorted({r.frame_index for r in rows})
    for f in frames.where(F.col("frame_index").isin(*indexes)).orderBy("frame_index").collect() if indexes else []:
        image = backend.decode(f.content)
        for r in rows:
            if r.frame_index == f.frame_index:
                x0, y0, x1, y1 = (round(v) for v in r.box_xyxy)
                box = np.zeros(image.shape[:2], bool)
                box[y0:y1, x0:x1] = True
                image = overlay(image, box, PALETTE[prompts.index(r.prompt) % len(PALETTE)], 0.0)
        shown.append(image)
    with open(f"{folder}/contact_sheet.png", "wb") as out:
        out.write(png(contact_sheet(shown, 4, side)))


def build_quality(spark: SparkSession, job: str) -> None:
    """The report of the stages that are there."""
    frames = tables.stored(spark, job, "frame_timestamps", "source/frame_timestamps.parquet")
    rows = {s: tables.quality_frames(spark, f"{job}/{s}/quality.json") for s in STAGES}
    gaps = {s: tables.quarantined_intervals(spark, f"{job}/{s}/quality.json") for s in STAGES}
    all_rows = quality.stage_rows(rows)
    missing = quality.unmatched_frames(all_rows, frames).count()
    if missing:
        raise ValueError(f"{missing} quality rows have no frame")
    os.makedirs(f"{job}/quality", exist_ok=True)
    exports.quality_report(quality.with_timestamps(all_rows, frames), quality.stage_rows(gaps), f"{job}/quality")


def build_exports(spark: SparkSession, job: str) -> None:
    """All dataset layouts of a job."""
    one = lambda name, path: tables.stored(spark, job, name, path).withColumn("episode", F.lit(0))
    with open(f"{job}/source/video_metadata.json") as f:
        metadata = json.load(f)
    tracks = one("tracks", "objects/tracks.parquet")
    payloads = exports.frame_payloads(one("frame_timestamps", "source/frame_timestamps.parquet"), tracks, one("hand_trajectories", "hands/trajectories.parquet"), one("depth_metadata", "depth/depth_metadata.parquet")).cache()
    exports.export_coco(tracks.drop("episode"), tables.masks(spark, f"{job}/objects/masks.json"), metadata, f"{job}/exports/coco_video/annotations.json")
    exports.export_lerobot(payloads, metadata, f"{job}/exports/lerobot")
    exports.export_rlds(payloads, f"{job}/exports/rlds")
    payloads.unpersist()


def process(spark: SparkSession, config: ProcessConfig, steps: Sequence[tuple[str, Callable[[], object]]], start: str | None = None) -> list[str]:
    """Run a job's steps that aren't done (from ``start`` on, all), then its report and exports."""
    os.makedirs(config.output, exist_ok=True)
    exports.save_json({"schema_version": exports.SCHEMA_VERSION, "config_hash": config.signature(), "config": vars(config) | {"target_labels": list(config.target_labels)}}, f"{config.output}/manifest.json")
    ran = run_plan(Stages(config.output, config.signature(), config.resume), steps, start)
    build_quality(spark, config.output)
    build_exports(spark, config.output)
    return ran


class Job:
    """A job's folder with the stages that a backend's models run; each stage reads the tables of those before."""

    def __init__(self, spark: SparkSession, config: ProcessConfig, backend: ModelBackend, **programs: str):
        """``programs`` are the paths of ffprobe and ffmpeg, where workers don't find them by name."""
        self.spark, self.config, self.backend, self.programs = spark, config, backend, programs
        self.folder = os.path.abspath(config.output)

    @classmethod
    def opened(cls, spark: SparkSession, folder: str, backend: ModelBackend) -> Job:
        """A job that was run before, with the configuration of its manifest."""
        path = f"{folder}/manifest.json"
        if not os.path.exists(path):
            raise ValueError(f"{folder} has no manifest; run process first")
        with open(path) as f:
            config = json.load(f)["config"]
        return cls(spark, ProcessConfig(**config | {"target_labels": tuple(config["target_labels"]), "output": os.path.abspath(folder)}), backend)

    def _table(self, name: str) -> str:
        return f"{self.folder}/.work/tables/{name}"

    def frames(self) -> DataFrame:
        """Decoded frames: episode, frame_index, timestamp_s, content."""
        path = self._table("frames")
        if os.path.isdir(path):
            return self.spark.read.parquet(path)
        times = tables.stored(self.spark, self.folder, "frame_timestamps", "source/frame_timestamps.parquet").select("frame_index", "timestamp_s")
        images = tables.frame_images(self.spark, f"{self.folder}/source/frames").drop("path")
        return images.join(times, "frame_index").withColumn("episode", F.lit(0).cast("long"))

    def size(self) -> tuple[int, int]:
        with open(f"{self.folder}/source/video_metadata.json") as f:
            doc = json.load(f)
        return doc["decoded_height"], doc["decoded_width"]

    def decode(self) -> None:
        """The video's frames, their times and its metadata."""
        media.register(self.spark)
        stream = media.probe(self.config.video, self.programs.get("ffprobe", "ffprobe"))
        frames = self.spark.read.format("video_frames").options(**self.programs).load(self.config.video)
        frames.withColumn("episode", F.lit(0).cast("long")).write.mode("overwrite").parquet(self._table("frames"))
        frames = self.frames()
        timed = sequence.durations(frames.select("episode", "frame_index", "timestamp_s"), ["episode"], media.stream_rate(stream) or media.FALLBACK_FPS)
        timed = timed.withColumn("file", frame_file(F.col("frame_index"), "source/frames", "jpg"))
        timed.select("frame_index", "timestamp_s", "duration_s", "file").write.mode("overwrite").parquet(f"{self.folder}/source/frame_timestamps.parquet")
        count, duration = timed.agg(F.count("*"), F.sum("duration_s")).first()
        first = self.backend.decode(frames.orderBy("frame_index").first().content)
        exports.save_json({
            "schema_version": exports.SCHEMA_VERSION, "input_video": os.path.abspath(self.config.video), "camera_model": self.config.camera, "frame_count": count, "duration_s": duration, "decoded_height": first.shape[0], "decoded_width": first.shape[1],
            "average_fps": media.stream_rate(stream), "codec": stream.get("codec_name"),
        }, f"{self.folder}/source/video_metadata.json")

    def anchors(self) -> None:
        """Objects of the key frames (and manual seeds), and the anchors of them that can be trusted."""
        frames = self.frames()
        found = job_candidates(frames, self.config, self.backend)
        found.write.mode("overwrite").parquet(self._table("candidates"))
        found = self.spark.read.parquet(self._table("candidates"))
        keyframes = sequence.keyframes(frames, self.config.anchor_stride).count()
        chosen = select_anchors(found, self.config, keyframes)
        rows = object_anchors(found, chosen, keyframes)
        seeds = f"{self.folder}/objects/manual_seeds.json"
        if os.path.exists(seeds):
            with open(seeds) as f:
                rows = with_seeds(rows, json.load(f), self.spark, *self.size())
        judged = folds.trusted_anchors(rows.withColumn("has_confidence", F.lit(True)), ["episode", "object_id"]).where("accepted").select("episode", "object_id", "frame_index")
        rows.join(judged, ["episode", "object_id", "frame_index"]).write.mode("overwrite").parquet(self._table("anchors"))
        self._save_summary(rows)

    def _save_summary(self, rows: DataFrame) -> None:
        names = rows.groupBy("object_id").agg(F.max(F.struct("frame_index", "label")).alias("l"), F.max("score").alias("score"), F.count("*").alias("n")).orderBy("object_id").collect()
        exports.save_json({"selected_objects": [{"object_id": r.object_id, "label": r.l.label, "score": r.score, "anchors": r.n} for r in names], "anchor_stride": self.config.anchor_stride}, f"{self.folder}/objects/discovery_summary.json")

    def tracks(self) -> None:
        """Dense tracks, masks and the quality of the object stage."""
        path = self._table("anchors")
        if not os.path.isdir(path):
            raise ValueError("object anchors are missing; rebuild the objects first")
        height, width = self.size()
        timed = tables.stored(self.spark, self.folder, "frame_timestamps", "source/frame_timestamps.parquet").withColumn("episode", F.lit(0))
        fps = sequence.source_fps(timed, ["episode"]).first()
        done = tracking.object_tracks(self.spark.read.parquet(path), self.frames(), self.backend, height, width, fps.fps if fps else sequence.FALLBACK_FPS)
        done.write.mode("overwrite").parquet(self._table("tracks"))
        done = self.spark.read.parquet(self._table("tracks"))
        done.select(*(c.split()[0] for c in TRACKS.split(", "))).write.mode("overwrite").parquet(f"{self.folder}/objects/tracks.parquet")
        rle = F.struct(F.array(F.lit(height), F.lit(width)).alias("size"), "counts")
        exports.stream_json(done.where("counts is not null").orderBy("frame_index", "object_id").select("frame_index", "object_id", "instance_id", rle.alias("rle")), f"{self.folder}/objects/masks.json", "annotations")
        self._save_quality("objects", object_frame_quality(done, ["frame_index"]))

    def hands(self) -> None:
        """Hand trajectories, poses and the quality of the hand stage."""
        height, width = self.size()
        focal = self.config.focal_length_px or 0.8 * max(height, width)
        placed = hand_ops.placed_hands(hand_ops.detected_hands(self.frames(), ["episode"], self.backend), F.lit(float(focal)))
        exports.save_table(placed, f"{self.folder}/hands/poses.parquet")
        paths, judged = hand_ops.hand_stage(self.frames(), self.spark.read.parquet(f"{self.folder}/hands/poses.parquet"), ["episode"])
        paths.drop("episode").write.mode("overwrite").parquet(f"{self.folder}/hands/trajectories.parquet")
        self._save_quality("hands", judged.drop("episode"))
        exports.save_json({"schema_version": exports.SCHEMA_VERSION, "focal_length_px": focal, "hands": list(hand_ops.SIDES), "units": "metres"}, f"{self.folder}/hands/metadata.json")

    def depth(self, every: int | None = None) -> None:
        """Depth maps and measures, and the quality of the depth stage."""
        every = every or self.config.depth_every
        depth_ops.depth_frames(self.frames(), ["episode"], self.backend, every).write.mode("overwrite").parquet(self._table("depth"))
        done = self.spark.read.parquet(self._table("depth"))
        done.select(*(c.split()[0] for c in DEPTH_METADATA.split(", "))).write.mode("overwrite").parquet(f"{self.folder}/depth/depth_metadata.parquet")
        self._save_quality("depth", done, depth_ops.interval_reasons(F.col("status"), F.col("reasons")))
        exports.save_json({"schema_version": exports.SCHEMA_VERSION, "source_stride": every, "model": self.config.depth_backend, "relative": True, **depth_ops.SCENE_SCALE}, f"{self.folder}/depth/metadata.json")

    def previews(self) -> None:
        """PNG images of every frame's masks and depth, as tables."""
        masks_of = self.spark.read.parquet(self._table("tracks")).where("counts is not null").groupBy("frame_index").agg(F.array_sort(F.collect_list(F.struct("object_id", "counts"))).alias("masks"))
        drawn = overlays(self.frames().join(masks_of, "frame_index", "left"), self.backend)
        exports.save_table(drawn.select("frame_index", "preview"), f"{self.folder}/previews/objects.parquet")
        shown = depth_previews(self.spark.read.parquet(self._table("depth")))
        exports.save_table(shown.select("frame_index", "preview"), f"{self.folder}/previews/depth.parquet")

    def _save_quality(self, stage: str, rows: DataFrame, interval_reasons=None) -> None:
        rows = rows.select("frame_index", "confidence", "status", "reasons", (F.col("reasons") if interval_reasons is None else interval_reasons).alias("_why"))
        gaps = quality.quarantined(rows.where("status = 'rejected'").withColumn("stage", F.lit(stage)).drop("reasons").withColumnRenamed("_why", "reasons"))
        exports.quality_document(rows.drop("_why").orderBy("frame_index"), gaps.drop("stage").orderBy("start_frame"), f"{self.folder}/{stage}/quality.json")

    def steps(self) -> list[tuple[str, Callable[[], object]]]:
        return [("preprocess", self.decode), ("anchors", self.anchors), ("tracks", self.tracks), ("hands", self.hands), ("depth", self.depth)]

    def rebuild(self, *names: str, **options) -> list[str]:
        """Run these stages again, and then the report and the exports, as all others are."""
        known, stages = dict(self.steps()), Stages(self.folder, self.config.signature())
        for name in names:
            stages.run(name, lambda n=name: known[n](**options), force=True)
        build_quality(self.spark, self.folder)
        build_exports(self.spark, self.folder)
        return list(names)


def job_candidates(frames: DataFrame, config: ProcessConfig, backend: ModelBackend) -> DataFrame:
    """Candidates of a job's key frames, with the nodes that selectors know them by."""
    keys = sequence.keyframes(frames, config.anchor_stride)
    found = candidates(keys, backend, config.target_labels or BROAD_PROMPTS, config.target_labels, longest=config.max_inference_side)
    return found.withColumn("episode", F.lit(0).cast("long")).withColumn("node", F.col("frame_index") * 100_000 + F.col("ordinal"))


def object_anchors(found: DataFrame, chosen: DataFrame, keyframes: int) -> DataFrame:
    """The candidates of the chosen objects (episode, object_id, label, frame_index, counts, area, score, manual).

    Of several candidates of one frame and object the one of best quality.
    """
    area = masks.rle_area(F.col("mask_rle.counts"))
    some = found.select("episode", "frame_index", "node", "embedding", "clip_logits", "area_fraction", F.col("mask_rle.counts").alias("counts"), area.alias("area"), selection.quality().alias("score"))
    if "node" in chosen.columns:
        picked = chosen.select("episode", "object_id", "label", "node")
    else:
        grouped = anchors.clusters(some, keyframes).select("episode", "cluster", "node")
        picked = grouped.join(chosen.select("episode", "object_id", "label", "cluster"), ["episode", "cluster"]).drop("cluster")
    rows = picked.join(some.drop("embedding", "clip_logits", "area_fraction"), ["episode", "node"]).where("area > 0")
    rows = selection.best_per_group(rows, ["episode", "object_id", "frame_index"], F.col("score"), ["node"])
    return rows.drop("node").withColumn("manual", F.lit(False))


def with_seeds(rows: DataFrame, seeds: Sequence[dict], spark: SparkSession, height: int, width: int) -> DataFrame:
    """Anchors with manual seeds: a box is the mask of the object of its label, a new one for a label that none has."""
    if not seeds:
        return rows
    known = {r.label.strip().casefold(): r.object_id for r in rows.select("label", "object_id").distinct().orderBy("object_id").collect()}
    made = []
    for s in seeds:
        name = s["label"].strip().casefold()
        known.setdefault(name, max(known.values(), default=0) + 1)
        mask = np.zeros((height, width), bool)
        x0, y0, x1, y1 = (round(v) for v in s["box_xyxy"])
        mask[y0:y1, x0:x1] = True
        made.append((0, int(known[name]), s["label"], int(s["frame_index"]), kernels.encode_rle(mask), int(mask.sum()), 1.0, True))
    new = spark.createDataFrame(made, "episode long, object_id long, label string, frame_index long, counts array<int>, area long, score double, manual boolean")
    kept = rows.join(new.select("episode", "object_id", "frame_index"), ["episode", "object_id", "frame_index"], "left_anti")
    return kept.unionByName(new)


def calibrate(frames: DataFrame, backend: ModelBackend, columns: int, rows: int, square_mm: float, every: int = 10, video: str = "") -> dict:
    """The calibration document of a video of a checkerboard, from every ``every``th frame (frame_index, content).

    Corners are found where the frames are; the driver gets those of the views that have a board.
    """
    if columns < 2 or rows < 2 or square_mm < 0.1 or every < 1:
        raise ValueError("a board has two corners a side or more, and squares of a tenth of a millimetre or more")
    some = sequence.keyframes(frames, every)

    def corners(content):
        image = backend.decode(content)
        got = backend.board(image, columns, rows)
        return (None if got is None else np.asarray(got, float).tolist()), image.shape[0], image.shape[1]

    found = by_row(some.select("frame_index", "content"), ["content"], "corners array<array<double>>, height int, width int", corners).drop("content")
    got = found.orderBy("frame_index").collect()
    views = [np.array(r.corners) for r in got if r.corners is not None]
    inner, error = calibration.calibrated(views, calibration.board_points(columns, rows, square_mm / 1000))
    return calibration.calibration_document(inner, error, video, got[0].width, got[0].height, columns, rows, square_mm, len(got), len(views))


def doctor() -> dict[str, dict]:
    """What the engine needs and finds: programs, libraries and a session."""
    found = {name: {"ok": bool(path := shutil.which(name)), "output": path or "not found"} for name in ("java", "ffmpeg", "ffprobe")}
    for name in ("pyspark", "pyarrow", "pandas", "numpy"):
        try:
            found[name] = {"ok": True, "output": version(name)}
        except PackageNotFoundError:
            found[name] = {"ok": False, "output": "not found"}
    return found


def provenance(models: Mapping[str, str]) -> dict[str, dict]:
    """Size and SHA-256 of model files by name; what isn't there has neither."""
    out: dict[str, dict] = {}
    for name, path in sorted(models.items()):
        if not os.path.exists(path):
            out[name] = {"path": path, "bytes": None, "sha256": None}
            continue
        with open(path, "rb") as f:
            out[name] = {"path": path, "bytes": os.path.getsize(path), "sha256": hashlib.file_digest(f, "sha256").hexdigest()}
    return out


def seed_object(job: str, label: str, frame_index: int, box: Sequence[float], width: int, height: int) -> list[dict]:
    """Add a manual seed, in place of one of the same label and frame."""
    x0, y0, x1, y1 = box
    if not label.strip() or frame_index < 0 or not (0 <= x0 < x1 <= width and 0 <= y0 < y1 <= height):
        raise ValueError("a seed needs a label, a frame and a box inside the image")
    path = f"{job}/objects/manual_seeds.json"
    seeds = json.load(open(path)) if os.path.exists(path) else []
    same = lambda s: s["label"].strip().casefold() == label.strip().casefold() and s["frame_index"] == frame_index
    seeds = [s for s in seeds if not same(s)] + [{"label": label, "frame_index": frame_index, "box_xyxy": list(box), "source": "user_visual_initialization"}]
    exports.save_json(seeds, path)
    return seeds


def status(job: str) -> dict[str, str]:
    """The signature each stage was done with."""
    folder = f"{job}/.work"
    found = {}
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if name.endswith(".done.json"):
            with open(f"{folder}/{name}") as f:
                found[name.removesuffix(".done.json")] = json.load(f)["config_hash"]
    return found


def _backend(name: str) -> ModelBackend:
    """What ``module:attribute`` names, called."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="egolake")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("doctor")
    for name in ("status", "quality", "export"):
        sub.add_parser(name).add_argument("job")
    for name in ("rebuild-objects", "rebuild-tracks", "rebuild-hands", "add-depth", "previews"):
        p = sub.add_parser(name)
        p.add_argument("job")
        p.add_argument("--backend", required=True)
        if name == "add-depth":
            p.add_argument("--every", type=int, default=1)
    p = sub.add_parser("process")
    p.add_argument("video")
    p.add_argument("--camera", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--backend", required=True)
    p.add_argument("--objects", default="")
    p.add_argument("--target-labels", default="")
    p.add_argument("--focal-length-px", type=float)
    p.add_argument("--max-auto-objects", type=int, default=8)
    p.add_argument("--anchor-stride", type=int, default=90)
    p.add_argument("--depth-every", type=int, default=1)
    p.add_argument("--no-resume", action="store_true")
    p = sub.add_parser("probe-objects")
    p.add_argument("video")
    p.add_argument("--prompts", required=True)
    p.add_argument("--frames", required=True)
    p.add_argument("--backend", required=True)
    p.add_argument("--output", required=True)
    p = sub.add_parser("calibrate-camera")
    p.add_argument("video")
    p.add_argument("--square-size-mm", type=float, required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--backend", required=True)
    p.add_argument("--columns", type=int, default=9)
    p.add_argument("--rows", type=int, default=6)
    p.add_argument("--sample-every", type=int, default=10)
    seed = sub.add_parser("seed-object")
    seed.add_argument("job")
    seed.add_argument("label")
    seed.add_argument("frame", type=int)
    seed.add_argument("box", type=float, nargs=4)
    seed.add_argument("--size", type=int, nargs=2, required=True)
    return parser


#: Stages that a command runs again.
REBUILDS = {"rebuild-objects": ("anchors", "tracks"), "rebuild-tracks": ("tracks",), "rebuild-hands": ("hands",), "add-depth": ("depth",)}


def main(args: Sequence[str] | None = None) -> int:
    a = _parser().parse_args(args)
    if a.command == "doctor":
        found = doctor()
        print(json.dumps(found, indent=2))
        return 0 if all(x["ok"] for x in found.values()) else 1
    if a.command == "status":
        print(json.dumps(status_report(os.path.abspath(a.job)), indent=2))
        return 0
    if a.command == "seed-object":
        seed_object(a.job, a.label, a.frame, a.box, *a.size)
        return 0
    from ..session import session

    spark = session()
    comma = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    if a.command in ("quality", "export"):
        (build_quality if a.command == "quality" else build_exports)(spark, os.path.abspath(a.job))
    elif a.command in REBUILDS:
        options = {"every": a.every} if a.command == "add-depth" else {}
        Job.opened(spark, os.path.abspath(a.job), _backend(a.backend)).rebuild(*REBUILDS[a.command], **options)
    elif a.command == "previews":
        Job.opened(spark, os.path.abspath(a.job), _backend(a.backend)).previews()
    elif a.command == "process":
        config = ProcessConfig.of(a.video, a.output, a.camera, comma(a.objects), comma(a.target_labels), focal_length_px=a.focal_length_px, max_auto_objects=a.max_auto_objects, anchor_stride=a.anchor_stride, depth_every=a.depth_every, resume=not a.no_resume)
        process(spark, config, Job(spark, config, _backend(a.backend)).steps())
    else:
        media.register(spark)
        frames = spark.read.format("video_frames").load(a.video)
        if a.command == "probe-objects":
            found = probe_objects(frames, _backend(a.backend), comma(a.prompts), [int(i) for i in comma(a.frames)])
            probe_report(frames, _backend(a.backend), found, comma(a.prompts), a.output)
        else:
            exports.save_json(calibrate(frames, _backend(a.backend), a.columns, a.rows, a.square_size_mm, a.sample_every, os.path.abspath(a.video)), a.output)
    return 0
