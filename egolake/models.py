"""Model inference as Arrow-batched columns. Weights are not part of the engine: a backend brings them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.images import nearest, resized
from .operators.kernels import encode_rle, mask_box


class ModelBackend(Protocol):
    """What the stages ask of models; images are height x width x 3 arrays. Instances travel to workers."""

    def decode(self, content: bytes) -> np.ndarray: ...
    def detect(self, image: np.ndarray, prompt: str) -> list[tuple[list[float], float]]: ...
    def segment(self, image: np.ndarray, box: list[float]) -> list[tuple[np.ndarray, float]]: ...
    def embed(self, crop: np.ndarray) -> np.ndarray: ...
    def logits(self, crop: np.ndarray, labels: Sequence[str]) -> list[float]: ...
    def depth(self, image: np.ndarray) -> np.ndarray: ...
    def track(self, images: Sequence[np.ndarray], seed: np.ndarray) -> list[tuple[np.ndarray, float]]: ...
    def hands(self, image: np.ndarray) -> list[dict]: ...
    def reconstruct(self, image: np.ndarray, box: Sequence[float], right: bool) -> dict: ...
    def board(self, image: np.ndarray, columns: int, rows: int) -> np.ndarray | None: ...


class StubBackend:
    """A backend without weights: everything follows from hashes of its input, for tests and dry runs."""

    def __init__(self, height: int = 48, width: int = 64):
        self.height, self.width = height, width

    def _rng(self, *parts) -> np.random.Generator:
        return np.random.default_rng(int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8], "little"))

    def decode(self, content: bytes) -> np.ndarray:
        return self._rng(content).integers(0, 256, (self.height, self.width, 3), dtype=np.uint8)

    def detect(self, image, prompt):
        r = self._rng(prompt, image[0, 0].tolist())
        out = []
        for _ in range(int(r.integers(0, 4))):
            x, y = r.uniform(0, self.width - 12), r.uniform(0, self.height - 12)
            out.append(([x, y, x + float(r.uniform(4, 12)), y + float(r.uniform(4, 12))], float(r.uniform(0.2, 1))))
        return out

    def segment(self, image, box):
        mask = np.zeros(image.shape[:2], bool)
        x0, y0, x1, y1 = (int(v) for v in box)
        mask[y0:y1, x0:x1] = True
        return [(mask, 0.9)]

    def embed(self, crop):
        v = self._rng(crop.shape, int(crop.sum())).normal(size=16)
        return v / np.linalg.norm(v)

    def logits(self, crop, labels):
        return [float(self._rng(label, crop.shape).uniform(10, 30)) for label in labels]

    def depth(self, image):
        return image.mean(axis=2) / 25.5

    def track(self, images, seed):
        return [(seed, 1.0) for _ in images]

    def hands(self, image):
        return [{"handedness": "left", "box": [4.0, 4.0, 30.0, 30.0], "confidence": 0.9, "keypoints": [[17.0, 17.0, 0.9]] * 21}]

    def reconstruct(self, image, box, right):
        r = self._rng([round(float(v)) for v in box], right)
        return {"joints": r.normal(scale=0.04, size=(21, 3)).tolist(), "camera": [4.0, 0.0, 0.0]}

    def board(self, image, columns, rows):
        return None


CANDIDATE = "frame_index bigint, ordinal bigint, prompt string, detector_score double, sam2_mask_score double, box_xyxy array<double>, mask_rle struct<size: array<int>, counts: array<int>>, clip_logits map<string,double>, area_fraction double, aspect_ratio double, embedding array<double>"
#: Devices that a model may run on, the best first.
DEVICES = ("cuda", "mps", "cpu")


def chosen_device(name: str, available: Sequence[str]) -> str:
    """The device named, or with "auto" the best that is there; cpu always is."""
    have = {*available, "cpu"}
    if name == "auto":
        return next(d for d in DEVICES if d in have)
    if name not in have:
        raise ValueError(f"device {name} is not available")
    return name


def with_fallback(call: Callable[[str], object], device: str) -> tuple[object, str]:
    """What ``call`` gives on the device, or on the cpu where the device fails; and where it ran."""
    try:
        return call(device), device
    except RuntimeError:
        if device == "cpu":
            raise
        return call("cpu"), "cpu"


def with_label_scores(df: DataFrame, logits: str = "clip_logits") -> DataFrame:
    """Adds clip_scores (the softmax of the logits of each label) and clip_best_prompt (the first label of the greatest logit).

    ``logits`` is a map in the order of labels; empty maps give an empty map and null.
    """
    keys, values = F.map_keys(logits), F.map_values(logits)
    top = F.array_max(values)
    powers = F.transform(values, lambda v: F.exp(v - top))
    total = F.aggregate(powers, F.lit(0.0), lambda s, v: s + v)
    scores = F.map_from_arrays(keys, F.transform(powers, lambda v: v / total))
    best = F.element_at(keys, F.array_position(values, top).cast("int"))
    return df.withColumn("clip_scores", scores).withColumn("clip_best_prompt", F.when(F.size(logits) > 0, best))


def candidates(frames: DataFrame, backend: ModelBackend, prompts: Sequence[str], labels: Sequence[str] = (), least_side: float = 3.0, longest: int | None = None) -> DataFrame:
    """Candidates of frames (frame_index, content): every prompt's boxes, their masks, embeddings and logits.

    Frames are batched to workers; the stride filter belongs before this, as nothing is pushed
    through it. ordinal is the order within a frame: by prompt, box and mask. Models see
    images whose longer side is at most ``longest``; boxes and masks are brought back to the
    size of the frame.
    """

    def run(batches):
        for b in batches:
            rows = []
            for index, content in zip(b["frame_index"], b["content"], strict=True):
                image, n = backend.decode(content), 0
                full = image.shape[:2]
                scale = min(1.0, longest / max(full)) if longest else 1.0
                if scale < 1:
                    image = np.stack([np.rint(resized(image[..., k], round(full[0] * scale), round(full[1] * scale))) for k in range(3)], -1).astype(np.uint8)
                h, w = image.shape[:2]
                for prompt in prompts:
                    for box, score in backend.detect(image, prompt):
                        box = [min(max(v, lo), hi) for v, lo, hi in zip(box, (0.0, 0.0, 1.0, 1.0), (w - 1.0, h - 1.0, float(w), float(h)), strict=True)]
                        if min(box[2] - box[0], box[3] - box[1]) <= least_side:
                            continue
                        for mask, mask_score in backend.segment(image, box):
                            x, y, bw, bh = mask_box(mask)
                            crop = image[y : y + bh, x : x + bw] if bw else image
                            wide, tall = max(bw, 1), max(bh, 1)
                            whole = mask if scale == 1 else nearest(mask, *full)
                            rows.append((
                                index, n, prompt, score, mask_score, [v / scale for v in (x, y, x + bw, y + bh)], {"size": list(full), "counts": encode_rle(whole)},
                                dict(zip(labels, backend.logits(crop, labels), strict=True)), float(mask.mean()), max(wide / tall, tall / wide), [float(v) for v in backend.embed(crop)],
                            ))
                            n += 1
            yield pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in ("frame_index", "ordinal", "prompt", "detector_score", "sam2_mask_score", "box_xyxy", "mask_rle", "clip_logits", "area_fraction", "aspect_ratio", "embedding")])

    return frames.select("frame_index", "content").mapInPandas(run, CANDIDATE)


def tracked(segments: DataFrame, backend: ModelBackend, keys: Sequence[str]) -> DataFrame:
    """Masks of each interval and direction (keys, offset, content, seed as a run-length mask at offset 0).

    Intervals don't depend on each other; each is one group.
    """
    schema = ", ".join(f"`{c}` {t}" for c, t in segments.select(*keys).dtypes) + ", offset bigint, area bigint, counts array<int>, confidence double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        from .operators.kernels import decode_rle

        rows = rows.sort_values("offset")
        images = [backend.decode(c) for c in rows["content"]]
        seed = decode_rle(rows["seed"].iloc[0], *images[0].shape[:2])
        got = backend.track(images, seed)
        out = rows[[*keys, "offset"]].copy()
        out["area"] = [int(m.sum()) for m, _ in got]
        out["counts"] = [encode_rle(m) for m, _ in got]
        out["confidence"] = [float(c) for _, c in got]
        return out

    return segments.groupBy(*keys).applyInPandas(run, schema)


def depth_rows(frames: DataFrame, backend: ModelBackend) -> DataFrame:
    """Depth statistics of frames: 2nd and 98th percentiles, invalid and glare fractions, sharpness."""
    from .operators.kernels import frame_statistics

    schema = "frame_index bigint, low double, high double, invalid_fraction double, glare_fraction double, sharpness double"

    def run(batches):
        for b in batches:
            rows = []
            for index, content in zip(b["frame_index"], b["content"], strict=True):
                image = backend.decode(content)
                raw = backend.depth(image)
                ok = raw[np.isfinite(raw)]
                low, high = np.percentile(ok, [2, 98]) if ok.size else (None, None)
                s = frame_statistics(image, raw)
                rows.append((index, low, high, s["invalid_fraction"], s["glare_fraction"], s["sharpness"]))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")])

    return frames.select("frame_index", "content").where(F.col("content").isNotNull()).mapInPandas(run, schema)
