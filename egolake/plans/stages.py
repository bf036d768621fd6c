"""Stages with checkpoints: what is done is skipped, by signature."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import stable_hash
from ..sources.exports import save_json


@dataclass(frozen=True)
class ProcessConfig:
    """What a job is run with; ``signature`` names its results."""

    video: str
    output: str
    camera: str
    focal_length_px: float | None = None
    target_labels: tuple[str, ...] = ()
    object_mode: bool = False
    max_auto_objects: int = 8
    exemplars: Mapping[str, str] = field(default_factory=dict)
    anchor_stride: int = 90
    anchor_backend: str = "grounding_dino_sam2_dinov2"
    anchor_device: str = "auto"
    max_inference_side: int = 960
    depth_backend: str = "depth_anything_v2_small_relative"
    depth_input_size: int = 756
    depth_every: int = 1
    resume: bool = True

    def __post_init__(self):
        if self.anchor_stride < 1 or self.depth_every < 1 or self.max_auto_objects < 1:
            raise ValueError("strides and limits must be positive")
        if self.object_mode and not self.target_labels:
            raise ValueError("object mode needs labels")
        if self.anchor_device not in ("auto", "cpu", "mps", "cuda"):
            raise ValueError(f"unknown device {self.anchor_device}")

    @classmethod
    def of(cls, video: str, output: str, camera: str, objects: Sequence[str] = (), labels: Sequence[str] = (), **rest) -> ProcessConfig:
        """As from the command line: objects or labels, without repeats; there are no more objects than labels."""
        if objects and labels:
            raise ValueError("give objects or target labels, not both")
        chosen = [x.strip() for x in (objects or labels) if x.strip()]
        if len({x.casefold() for x in chosen}) < len(chosen):
            raise ValueError("a label is given twice")
        if camera is None or not str(camera).strip():
            raise ValueError("a camera is needed")
        focal = rest.get("focal_length_px")
        if focal is not None and not focal > 0:
            raise ValueError("a focal length must be positive")
        limit = rest.pop("max_auto_objects", 8)
        return cls(video, output, camera, target_labels=tuple(chosen), object_mode=bool(objects), max_auto_objects=min(limit, len(chosen)) if chosen else limit, **rest)

    def signature(self) -> str:
        payload = asdict(self) | {"target_labels": list(self.target_labels), "video": os.path.abspath(self.video), "output": os.path.abspath(self.output)}
        return stable_hash(payload)


class Stages:
    """Named steps of a job in its folder; a marker keeps the signature each was done with."""

    def __init__(self, folder: str, signature: str, resume: bool = True):
        self.folder, self.signature, self.resume = folder, signature, resume

    def _marker(self, name: str) -> str:
        return f"{self.folder}/.work/{name}.done.json"

    def done(self, name: str) -> bool:
        if not self.resume:
            return False
        try:
            with open(self._marker(name)) as f:
                return json.load(f).get("config_hash") == self.signature
        except (OSError, ValueError):
            return False

    def run(self, name: str, step: Callable[[], object], force: bool = False) -> bool:
        """Run a step unless it is done; True if it ran."""
        if not force and self.done(name):
            return False
        step()
        save_json({"stage": name, "config_hash": self.signature}, self._marker(name))
        return True

    def table(self, spark: SparkSession, name: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
        """A step's table: built and written, or read if it is done."""
        path = f"{self.folder}/.work/tables/{name}"
        self.run(name, lambda: build().write.mode("overwrite").parquet(path), force)
        return spark.read.parquet(path)


def run_plan(stages: Stages, steps: Sequence[tuple[str, Callable[[], object]]], start: str | None = None) -> list[str]:
    """Run steps in order; those from ``start`` on, and those after one that ran, are run again."""
    ran, force = [], False
    for name, step in steps:
        force = force or name == start
        if stages.run(name, step, force):
            ran.append(name)
            force = True
    return ran


def remaining(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that a checkpoint doesn't have yet."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resumed(rows: DataFrame, checkpoint: str, signature: str, keys: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Work on what a checkpoint of the same signature lacks, add it there, and return all of it."""
    spark, path = rows.sparkSession, f"{checkpoint}/{signature}"
    try:
        done = spark.read.parquet(path)
        todo = remaining(rows, done, keys)
    except Exception as missing:  # no checkpoint of this signature yet
        if getattr(missing, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
            raise
        todo = rows
    work(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def progress(rows: DataFrame, every: int, frame_count: int) -> DataFrame:
    """completed and total frames of a checkpoint with a stride."""
    total = -(-frame_count // every)
    return rows.agg(F.count_distinct("frame_index").alias("completed")).withColumn("total", F.lit(total).cast("long"))


def _document(path: str) -> dict:
    try:
        with open(path) as f:
            found = json.load(f)
    except (OSError, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def status_report(job: str) -> dict:
    """The stages of a job's folder that are done with its present configuration, and what others have so far.

    Partial work of a stage is a table of checkpoints (``resumed``) beside a document that says
    how many there are to be, or one document with its rows.
    """
    work, config_hash = f"{job}/.work", str(_document(f"{job}/manifest.json").get("config_hash", ""))
    names = sorted(os.listdir(work)) if os.path.isdir(work) else []
    done = {n.removesuffix(".done.json"): str(_document(f"{work}/{n}").get("config_hash", "")) == config_hash for n in names if n.endswith(".done.json")}
    partial: dict[str, dict] = {}
    # The names under which progress is reported.
    for stage, unit in (("anchors", "keyframes"), ("tracks", "anchor_intervals"), ("depth", "frames"), ("hands", "frames")):
        doc = _document(f"{work}/{stage}_progress.json")
        table = f"{work}/{stage}_progress"
        signature = doc.get("signature", {})
        if not doc and not os.path.isdir(table):
            continue
        rows = doc["rows"] if "rows" in doc else _checkpointed(table, str(signature.get("config_hash", config_hash)))
        found = {f"completed_{unit}": len(rows) if isinstance(rows, list) else rows}
        every = max(int(signature.get("every", 1)), 1)
        if "frame_count" in signature:
            found[f"total_{unit}"] = -(-int(signature["frame_count"]) // every)
        if stage == "depth":
            found["source_stride"] = every
        partial[stage] = found
    return {"result": job, "config_hash": config_hash or None, "completed_stages": done, "partial_checkpoints": partial, "resume": "run process again with the same arguments"}


def _checkpointed(table: str, signature: str) -> int:
    """Rows of a checkpoint, from the footers of its files."""
    folder = f"{table}/{signature}"
    files = [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")] if os.path.isdir(folder) else []
    return sum(pq.read_metadata(f).num_rows for f in files)


def upsert_seeds(seeds: DataFrame, new: DataFrame) -> DataFrame:
    """Seeds with those of the same label (trimmed, in lower case) and frame replaced."""
    name = lambda d: F.lower(F.trim(d["label"]))
    keys = new.select(name(new).alias("_l"), F.col("frame_index").alias("_f")).distinct()
    kept = seeds.join(keys, (name(seeds) == F.col("_l")) & (seeds["frame_index"] == F.col("_f")), "left_anti")
    return kept.unionByName(new)


def reusable_frames(config: ProcessConfig, metadata: Mapping, images: int) -> bool:
    """Whether decoded frames are those of the same video and camera, all of them."""
    return os.path.abspath(str(metadata.get("input_video", ""))) == os.path.abspath(config.video) and metadata.get("camera_model") == config.camera and 0 < images == metadata.get("frame_count")
