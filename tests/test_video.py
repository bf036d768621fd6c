"""Video, images, depth, hands, tracks, cameras and commands, with stub programs and a stub backend."""

import json
import os
import shutil
import stat
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from egolake.models import StubBackend, candidates, chosen_device, with_fallback
from egolake.operators import calibration, depth, folds, hands, images, kernels, mask_columns
from egolake.plans import commands, tracking
from egolake.plans.stages import ProcessConfig, status_report
from egolake.sources import exports, media

PROBE = """#!/usr/bin/env python3
import json, os, sys
video = json.load(open(sys.argv[-1]))
if "-show_streams" in sys.argv:
    print(json.dumps({"streams": [video["stream"]], "format": {"duration": "1.0"}}))
else:
    print("\\n".join(f"{t},{'K__' if i in video['keys'] else '___'}" for i, t in enumerate(video["times"])))
"""
DECODE = """#!/usr/bin/env python3
import json, re, sys
args = sys.argv[1:]
video = json.load(open(args[args.index("-i") + 1]))
start = 0
if "-ss" in args:
    at = float(args[args.index("-ss") + 1])
    start = max(i for i in video["keys"] if video["times"][i] <= at)
wanted = [tuple(map(int, m)) for m in re.findall(r"between\\(n\\\\,(\\d+)\\\\,(\\d+)\\)", " ".join(args))]
with open(args[args.index("-i") + 1] + ".log", "a") as log:
    log.write(json.dumps([start, wanted]) + "\\n")
for i in range(start, video["decoded"]):
    if any(a <= i - start <= b for a, b in wanted):
        sys.stdout.buffer.write(b"\\xff\\xd8frame %d" % i + b"x" * 70000 + b"\\xff\\xd9")
"""


@pytest.fixture
def programs(tmp_path, monkeypatch):
    folder = tmp_path / "bin"
    folder.mkdir()
    for name, text in (("ffprobe", PROBE), ("ffmpeg", DECODE)):
        (folder / name).write_text(text)
        os.chmod(folder / name, stat.S_IRWXU)
    monkeypatch.setenv("PATH", f"{folder}:{os.environ['PATH']}")

    def video(frames=10, times=None, keys=(0, 4, 8), decoded=None, **stream):
        path = tmp_path / f"v{len(os.listdir(tmp_path))}.json"
        times = [round(0.04 * i + 0.001 * (i % 3), 6) for i in range(frames)] if times is None else times
        path.write_text(json.dumps({"stream": {"avg_frame_rate": "25/1", **stream}, "times": times, "keys": list(keys), "decoded": frames if decoded is None else decoded}))
        return str(path)

    return video


def read(path, per=500, wanted=None):
    reader = media.FrameReader({"path": path, "frames_per_partition": str(per)})
    reader.wanted = wanted
    return [[r for r in reader.read(p)] for p in reader.partitions()]


def log(path):
    with open(path + ".log") as f:
        return [json.loads(x) for x in f]


def test_frames_with_and_without_a_stated_count(programs):
    for stream in ({"nb_frames": "10"}, {}, {"nb_frames": "N/A"}):
        got = [r for part in read(programs(**stream), 4) for r in part]
        assert [r[0] for r in got] == list(range(10))
        assert [r[1] for r in got] == [round(0.04 * i + 0.001 * (i % 3), 6) for i in range(10)]
        assert all(r[2].startswith(b"\xff\xd8frame %dx" % r[0]) and r[2].endswith(b"\xff\xd9") for r in got)


def test_ranges_start_at_key_frames_and_wanted_frames_share_a_range(programs):
    path = programs(nb_frames="10")
    assert [[r[0] for r in p] for p in read(path, 4)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert log(path) == [[0, [[0, 3]]], [4, [[0, 3]]], [8, [[0, 1]]]]
    path = programs(nb_frames="10")
    assert [[r[0] for r in p] for p in read(path, 500, {1, 6, 7, 99, -1})] == [[1, 6, 7]]
    assert log(path) == [[0, [[1, 1], [6, 7]]]]
    path = programs(nb_frames="10")
    assert [[r[0] for r in p] for p in read(path, 3, {5, 9})] == [[5], [9]]
    assert log(path) == [[4, [[1, 1]]], [8, [[1, 1]]]]


def test_times_are_made_up_for_the_whole_video(programs):
    path = programs(nb_frames="10", times=[0.0, 0.1])
    assert [r[1] for p in read(path, 4) for r in p] == [i / 25 for i in range(10)]
    path = programs(times=[], duration="0.4")
    got = [r for p in read(path, 4) for r in p]
    assert [r[:2] for r in got] == [(i, i / 25) for i in range(10)]


def test_a_count_mismatch_in_a_later_range_is_an_error(programs):
    path = programs(nb_frames="10", decoded=9)
    reader = media.FrameReader({"path": path, "frames_per_partition": "4"})
    parts = reader.partitions()
    assert len(list(reader.read(parts[0]))) == 4
    with pytest.raises(ValueError, match="decoded 1 of 2"):
        list(reader.read(parts[2]))


def test_stream_rates_and_counts():
    assert media.stream_rate({"avg_frame_rate": "0/0", "r_frame_rate": "30000/1001"}) == 30000 / 1001
    assert media.stated_frames({"nb_frames": "7"}) == 7 and media.stated_frames({"duration": "0.5", "avg_frame_rate": "25/1"}) == 12
    assert media.stated_frames({}) == 1


# images ----------------------------------------------------------------------


def test_resizing_warping_and_edges():
    image = np.arange(48.0).reshape(6, 8)
    small = images.resized(image, 3, 4)
    assert np.allclose(small, image.reshape(3, 2, 4, 2).mean((1, 3))) and np.isclose(images.resized(image, 4, 5).mean(), image.mean())
    assert np.allclose(images.resized(np.full((5, 7), 3.0), 11, 13), 3)
    y, x = np.mgrid[:6, :8].astype(float)
    assert np.allclose(images.warped(image, x, y, np.nan), image)
    assert np.allclose(images.warped(image, x + 0.5, y, np.nan)[:, :-1], image[:, :-1] + 0.5) and np.isnan(images.warped(image, x + 1.5, y, np.nan)[:, -1]).all()
    step = np.zeros((20, 20))
    step[:, 10:] = 200
    found = images.edges(step, 70, 150)
    assert found.any(1).all() and not found[:, :8].any() and not found[:, 12:].any()
    grown = images.grown(np.eye(7, dtype=bool), 3)
    assert (grown == (np.abs(np.subtract.outer(np.arange(7), np.arange(7))) <= 2)).all()


def test_flow_follows_a_shift():
    rng = np.random.default_rng(0)
    field = images.resized(rng.uniform(0, 255, (20, 30)), 120, 160, False)
    first, second = field[10:90, 10:130], field[8:88, 13:133]  # what is at (x, y) moves to (x - 3, y + 2)
    flow = images.optical_flow(first, second)
    assert np.abs(np.median(flow[10:-10, 10:-10].reshape(-1, 2), axis=0) - [-3, 2]).max() < 0.3
    mask = np.zeros((160, 240), bool)
    mask[40:80, 60:120] = True
    assert kernels.object_motion(first, second, mask) < 0.5 and kernels.object_motion(first, second, None) == 0


def test_drawing_and_png():
    image = np.zeros((20, 30, 3), np.uint8)
    mask = np.zeros((20, 30), bool)
    mask[5:15, 5:20] = True
    out = images.overlay(image, mask, (200, 100, 50))
    assert tuple(out[5, 5]) == (200, 100, 50) and tuple(out[10, 10]) == (90, 45, 22) and not out[0].any()
    data = images.png(out)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and zlib.decompress(data[data.index(b"IDAT") + 4 : data.index(b"IEND") - 8])[1:91] == out[0].tobytes()
    assert images.colourised(np.array([[0.0, 1.0, np.nan]]), (48, 18, 59), (249, 231, 33)).tolist() == [[[48, 18, 59], [249, 231, 33], [48, 18, 59]]]
    assert images.contact_sheet([image, image, image], 2, 10).shape == (20, 20, 3)
    vertices = np.array([[0, 0, 1.0], [9, 0, 1], [0, 9, 1], [0, 0, 2], [9, 0, 2], [0, 9, 2]])
    faces = np.array([[0, 1, 2], [3, 4, 5]])
    assert images.painters_order(vertices, faces).tolist() == [1, 0]
    drawn = images.drawn_mesh(image, vertices, vertices[:, :2], faces, (100, 100, 100), 1.0)
    assert drawn[1, 1, 0] == 100 and drawn[15, 15, 0] == 0


# depth -----------------------------------------------------------------------


class Scene(StubBackend):
    """Frames are a grey level and a shift in their content's two bytes."""

    def decode(self, content):
        level, shift = content
        y, x = np.mgrid[:90, :160]
        return np.clip(level + 8 * np.sin((x + shift) / 9.0)[..., None] + np.zeros(3), 0, 255).astype(np.uint8)

    def depth(self, image):
        out = image.mean(axis=2) / 25.5 + np.linspace(0, 3, image.shape[1])
        out[:3] = np.nan
        return out


def test_depth_frames_reset_at_scene_changes(spark):
    rows = [(0, i, i / 30, bytes([60 if i < 4 else 180, i])) for i in range(8)] + [(0, 9, 0.3, None)]
    frames = spark.createDataFrame(rows, "episode long, frame_index long, timestamp_s double, content binary")
    out = depth.depth_frames(frames, ["episode"], Scene()).orderBy("frame_index").collect()
    assert [r.frame_index for r in out] == list(range(8)) and [r.scene_change for r in out] == [i == 4 for i in range(8)]
    assert [r.temporal_delta == 0 for r in out] == [i in (0, 4) for i in range(8)] and [r.flow_valid_fraction > 0 for r in out] == [i not in (0, 4) for i in range(8)]
    assert "scene_cut_normalization_reset" in out[4].reasons and all(abs(r.invalid_fraction - 3 / 90) < 1e-9 for r in out)
    maps = [np.frombuffer(r.depth, np.float16).reshape(r.height, r.width) for r in out]
    assert all(m.shape == (90, 160) and m.min() >= 0 and m.max() <= 1 for m in maps)
    assert [r.frame_index for r in depth.depth_frames(frames, ["episode"], Scene(), every=3).orderBy("frame_index").collect()] == [0, 3, 6]
    bounds = [r.normalization_low for r in out]
    fresh = folds.smoothed_bounds(spark.createDataFrame([(0, i, b, b + 1, i == 4) for i, b in enumerate(bounds)], "k long, frame_index long, low double, high double, reset boolean"), ["k"])
    assert fresh.count() == 8


def test_stabilising_draws_towards_the_last_depth():
    light = images.resized(np.random.default_rng(1).uniform(100, 110, (10, 16)), 90, 160, False)
    first, second = np.full((90, 160), 0.5, np.float32), np.full((90, 160), 0.6, np.float32)
    out, measures, small, small_light = kernels.stabilised(first, light, None, size=(45, 80))
    assert (out == first).all() and measures["flow_valid_fraction"] == 0
    out, measures, *_ = kernels.stabilised(second, light, (small, small_light), size=(45, 80))
    assert np.allclose(out[20:70, 20:140], 0.6 - 0.28 * 0.1, atol=1e-3) and measures["flow_valid_fraction"] > 0.9
    far, measures, *_ = kernels.stabilised(np.full((90, 160), 0.9, np.float32), light, (small, small_light), size=(45, 80))
    assert np.allclose(far, 0.9) and measures["stabilization_blend_fraction"] == 0


def test_folds_are_linear_and_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    rows = spark.range(30_000).selectExpr("id % 2 as k", "id div 2 as frame_index", "cast(1 as double) as v")
    count = lambda s, r: ((s or 0) + r[0], ((s or 0) + r[0],))
    out = folds.fold(rows, ["k"], ["frame_index"], ["v"], count, "total double")
    assert out.where("total <> frame_index + 1").count() == 0 and out.count() == 30_000
    empty = folds.fold(rows.limit(0), ["k"], ["frame_index"], ["v"], count, "total double")
    assert empty.count() == 0 and empty.columns == ["k", "frame_index", "v", "total"]


# hands -----------------------------------------------------------------------


class Hands(StubBackend):
    """A left hand in plain images of an even first byte; a right one only in padded images."""

    def decode(self, content):
        image = np.zeros((200, 300, 3), np.uint8)
        image[0, 0] = content[0]
        return image

    def hands(self, image):
        padded = image.shape[0] > 200
        keypoints = [[150.0 + (96 if padded else 0), 100.0 + (72 if padded else 0), 0.9]] * 21
        if padded:
            return [{"handedness": "right", "box": [96 + 100.0, 72 + 60.0, 96 + 200.0, 72 + 140.0], "confidence": 0.7, "keypoints": keypoints}]
        return [{"handedness": "left", "box": [100.0, 60.0, 200.0, 140.0], "confidence": 0.9, "keypoints": keypoints}] if image[0, 0, 0] % 2 == 0 else []


def test_hands_are_looked_for_again_in_padded_images(spark):
    frames = spark.createDataFrame([(0, i, i / 30, bytes([i])) for i in range(4)], "episode long, frame_index long, timestamp_s double, content binary")
    out = hands.detected_hands(frames, ["episode"], Hands()).orderBy("frame_index", "handedness").collect()
    # frame 1 has none and frame 2 lacks the side that frame 1 had
    assert [(r.frame_index, r.handedness) for r in out] == [(0, "left"), (1, "right"), (2, "left"), (2, "right"), (3, "right")]
    assert all(list(r.box) == [100, 60, 200, 140] and list(r.keypoints[0][:2]) == [150, 100] for r in out)
    paths, judged = hands.hand_stage(frames, hands.placed_hands(hands.detected_hands(frames, ["episode"], Hands()), F.lit(240.0)), ["episode"])
    assert paths.count() == 8 and judged.count() == 4
    assert {r.status for r in judged.collect()} <= {"accepted", "rejected"}


# tracks ----------------------------------------------------------------------


class Follow(StubBackend):
    """Masks stay where they are; the images of frames from 12 on lose the object on the way forward."""

    def decode(self, content):
        image = np.zeros((24, 32, 3), np.uint8)
        image[..., 0] = content[0]
        return image

    def track(self, images_, seed):
        return [(seed if not 12 <= im[0, 0, 0] < 18 else np.zeros_like(seed), 0.8) for im in images_]


def mask(x, y, side=6):
    out = np.zeros((24, 32), bool)
    out[y : y + side, x : x + side] = True
    return kernels.encode_rle(out)


def test_tracks_between_anchors(spark):
    frames = spark.createDataFrame([(0, i, i / 10, bytes([i])) for i in range(30)], "episode long, frame_index long, timestamp_s double, content binary")
    rows = [(0, 1, "cup", 5, mask(4, 4), 36, 0.9), (0, 1, "cup", 10, mask(4, 4), 36, 0.9), (0, 2, "lid", 10, mask(20, 10), 36, 0.8), (0, 2, "lid", 20, mask(20, 10), 36, 0.8)]
    anchors = spark.createDataFrame(rows, "episode long, object_id long, label string, frame_index long, counts array<int>, area long, score double")
    spans = {(r.object_id, r.start_frame, r.end_frame, r.left is None, r.right is None) for r in tracking.intervals(anchors, frames).collect()}
    assert spans == {(1, 0, 5, True, False), (1, 5, 10, False, False), (1, 10, 29, False, True), (2, 0, 10, True, False), (2, 10, 20, False, False), (2, 20, 29, False, True)}
    out = tracking.object_tracks(anchors, frames, Follow(), 24, 32, flow=lambda a, b: np.zeros((*a.shape, 2)))
    got = {(r.object_id, r.frame_index): r for r in out.collect()}
    assert len(got) == 60
    assert {got[1, i].source for i in (5, 10)} == {"object_anchor"} == {got[2, 20].source}
    assert got[1, 7].source == "cutie_bidirectional" and got[1, 2].source == "cutie_backward_only" and got[1, 25].source == "cutie_forward_only"
    assert (got[1, 7].bbox_x, got[1, 7].bbox_y, got[1, 7].bbox_width, got[1, 7].mask_area_px, got[1, 7].visibility) == (4, 4, 6, 36, "visible")
    assert got[2, 14].mask_area_px is None and got[2, 14].visibility == "rejected" and got[1, 7].label == "cup" and got[1, 3].visibility == "visible"


def test_label_ranking_and_summary_edges(spark):
    scores = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5), (1, "c", 0.1)], "object_id long, label string, score double")
    r = tracking.label_details(scores, ["object_id"]).first()
    assert r.label == "b" and [s.label for s in r.scores] == ["b", "a", "c"]
    chosen = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "object_id long, label string, pre_clip_label string")
    given = spark.createDataFrame([(1, "b", 0.5, True), (2, "q", 0.2, False)], "object_id long, label string, clip_score double, accepted boolean")
    got = {r.object_id: r for r in tracking.updated_summary(chosen, given, ["object_id"]).collect()}
    assert (got[1].label, got[1].pre_clip_label, got[2].label, got[2].pre_clip_label) == ("b", "x", "q", "z")


def test_mask_columns_take_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(1, mask(2, 2), None, 24, 32), (2, None, None, 24, 32), (3, mask(1, 1), mask(20, 15), 24, 32)], "id int, forward_counts array<int>, backward_counts array<int>, height int, width int")
    out = {r.id: r for r in mask_columns.fused_masks(df.withColumn("area", F.lit("x"))).collect()}
    assert out[1].area == 36 and out[2].area is None and out[3].area is None and out[3].component_fraction == 0.5
    assert mask_columns.primary_components(df.withColumnRenamed("forward_counts", "counts")).where("counts is null").count() == 1
    assert mask_columns.fused_masks(df.limit(0)).count() == 0
    crop = mask_columns.crops(spark.createDataFrame([(bytes([3]), mask(2, 2)), (None, None)], "content binary, counts array<int>"), Follow()).collect()
    assert crop[0].crop_height == crop[0].crop_width == 8 and crop[1].crop is None


def test_candidates_of_smaller_images_are_brought_back(spark):
    frames = spark.createDataFrame([(i, bytes([i])) for i in range(3)], "frame_index long, content binary")
    out = candidates(frames, Whole(), ["cup"], longest=64).collect()
    assert out and all(list(r.mask_rle.size) == [96, 128] and sum(r.mask_rle.counts) == 96 * 128 for r in out)
    for r in out:
        x, y, w, h = kernels.mask_box(kernels.decode_rle(r.mask_rle.counts, 96, 128))
        assert np.abs(np.array([x, y, x + w, y + h]) - r.box_xyxy).max() <= 2


def test_probe_report_and_mesh_previews(spark, tmp_path):
    frames = spark.createDataFrame([(i, bytes([i])) for i in range(3)], "frame_index long, content binary")
    found = commands.probe_objects(frames, Whole(), ["cup", "lid"], [0, 2, 9])
    commands.probe_report(frames, Whole(), found, ["cup", "lid"], str(tmp_path))
    with open(tmp_path / "summary.json") as f:
        assert len(json.load(f)["candidates"]) == 4
    assert (tmp_path / "contact_sheet.png").read_bytes().startswith(b"\x89PNG")
    with pytest.raises(ValueError, match="none"):
        commands.probe_objects(frames, Whole(), ["cup"], [9])
    mesh = spark.createDataFrame([(bytes([1]), [[0.0, 0.0, 1.0], [1.0, 0.0, 1.0], [0.0, 1.0, 1.0]], [[1.0, 1.0], [9.0, 1.0], [1.0, 9.0]]), (bytes([1]), None, None), (None, None, None)], "content binary, joints_camera array<array<double>>, points array<array<double>>")
    got = [r.preview for r in mask_columns.mesh_previews(mesh, Whole(), [[0, 1, 2]]).collect()]
    assert got[0] != got[1] and got[2] is None


def test_devices():
    assert chosen_device("auto", ["mps"]) == "mps" and chosen_device("auto", []) == "cpu" and chosen_device("cpu", ["cuda"]) == "cpu"
    with pytest.raises(ValueError, match="cuda"):
        chosen_device("cuda", [])

    def call(device):
        if device != "cpu":
            raise RuntimeError("no memory")
        return 7

    assert with_fallback(call, "mps") == (7, "cpu")
    with pytest.raises(RuntimeError):
        with_fallback(lambda d: call("x"), "cpu")


# cameras ---------------------------------------------------------------------


def views(n, noise=0.0):
    rng = np.random.default_rng(3)
    plane = calibration.board_points(9, 6, 0.025)
    inner = np.array([900.0, 880.0, 640.0, 360.0, -0.12, 0.05, 0.001, -0.0005, 0.0])
    out = []
    for _ in range(n):
        pose = np.concatenate([rng.uniform(-0.5, 0.5, 3), [rng.uniform(-0.15, 0), rng.uniform(-0.1, 0), rng.uniform(0.4, 0.8)]])
        out.append(calibration.projected(plane, inner, pose) + rng.normal(0, noise, (54, 2)))
    return plane, inner, out


def test_calibration_finds_the_camera():
    plane, inner, found = views(14)
    got, error = calibration.calibrated(found, plane)
    assert error < 1e-3 and np.abs(got[:4] - inner[:4]).max() < 0.1 and np.abs(got[4:6] - inner[4:6]).max() < 0.01
    _, _, noisy = views(14, 0.3)
    got, error = calibration.calibrated(noisy, plane)
    assert 0.2 < error < 0.6 and np.abs(got[:4] - inner[:4]).max() < 15
    with pytest.raises(ValueError, match="10"):
        calibration.calibrated(found[:9], plane)


def test_rotations():
    v = np.array([0.3, -0.7, 0.2])
    r = calibration.rotation(v)
    assert np.allclose(r @ r.T, np.eye(3)) and np.allclose(calibration.rotation_vector(r), v) and np.allclose(calibration.rotation(np.zeros(3)), np.eye(3))


def test_calibrating_a_video(spark):
    plane, inner, found = views(12)

    class Board(StubBackend):
        def decode(self, content):
            image = np.zeros((720, 1280, 3), np.uint8)
            image[0, 0] = content[0]
            return image

        def board(self, image, columns, rows):
            i = int(image[0, 0, 0])
            return found[i // 10] if i // 10 < 12 else None

    frames = spark.createDataFrame([(i, bytes([i])) for i in range(135)], "frame_index long, content binary")
    doc = commands.calibrate(frames, Board(), 9, 6, 25.0, 10, "v.mp4")
    assert doc["usable_views"] == 12 and doc["sampled_frames"] == 14 and abs(doc["fx_px"] - 900) < 1 and doc["image_width"] == 1280
    with pytest.raises(ValueError, match="views"):
        commands.calibrate(frames.where("frame_index < 40"), Board(), 9, 6, 25.0)


# jobs ------------------------------------------------------------------------


def test_status_reports_completed_and_partial_work(spark, tmp_path):
    job = str(tmp_path)
    exports.save_json({"config_hash": "same"}, f"{job}/manifest.json")
    exports.save_json({"config_hash": "same"}, f"{job}/.work/preprocess.done.json")
    exports.save_json({"config_hash": "other"}, f"{job}/.work/hands.done.json")
    exports.save_json({"signature": {"frame_count": 10, "every": 3}, "rows": [{"frame_index": 0}, {"frame_index": 3}]}, f"{job}/.work/depth_progress.json")
    spark.range(5).write.parquet(f"file://{job}/.work/tracks_progress/same")
    report = status_report(job)
    assert report["completed_stages"] == {"preprocess": True, "hands": False} and report["config_hash"] == "same"
    assert report["partial_checkpoints"]["depth"] == {"completed_frames": 2, "total_frames": 4, "source_stride": 3}
    assert report["partial_checkpoints"]["tracks"] == {"completed_anchor_intervals": 5}
    assert commands.main(["status", job]) == 0 and status_report(f"{job}/none")["completed_stages"] == {}


class Whole(StubBackend):
    """Deterministic images of a size by content; a box in every key frame."""

    def decode(self, content):
        return np.random.default_rng(len(content)).integers(0, 255, (96, 128, 3), dtype=np.uint8)

    def detect(self, image, prompt):
        return [([10.0, 10.0, 40.0, 50.0], 0.9)]

    def embed(self, crop):
        return np.ones(4) / 2


@pytest.mark.parametrize("objects", [["cup"], []])
def test_a_job_from_video_to_exports(spark, programs, tmp_path, objects):
    job = f"{tmp_path}/job"
    video = programs(12, keys=(0, 6), nb_frames="12")
    config = ProcessConfig.of(video, job, "cam", objects=objects, labels=[] if objects else ["cup"], anchor_stride=4)
    work = commands.Job(spark, config, Whole(), **{name: shutil.which(name) for name in ("ffprobe", "ffmpeg")})
    assert commands.process(spark, config, work.steps()) == ["preprocess", "anchors", "tracks", "hands", "depth"]
    assert commands.process(spark, config, work.steps()) == []
    tracks = spark.read.parquet(f"file://{job}/objects/tracks.parquet")
    assert tracks.select("frame_index").distinct().count() == 12 and tracks.where("label = 'cup' and visibility = 'visible'").count() > 0
    for stage in ("objects", "hands", "depth"):
        with open(f"{job}/{stage}/quality.json") as f:
            assert len(json.load(f)["frames"]) == 12
    with open(f"{job}/exports/coco_video/annotations.json") as f:
        coco = json.load(f)
    assert len(coco["images"]) == 12 and coco["annotations"] and coco["annotations"][0]["segmentation"]["size"] == [96, 128]
    assert os.path.isfile(f"{job}/exports/lerobot/data/chunk-000/episode_000000.parquet") and os.path.isfile(f"{job}/exports/rlds/steps.parquet")
    assert spark.read.parquet(f"file://{job}/quality/frame_scores.parquet").count() == 36
    assert all(status_report(job)["completed_stages"].values())
    work.previews()
    previews = [spark.read.parquet(f"file://{job}/previews/{n}.parquet") for n in ("objects", "depth")]
    assert [p.where("preview is not null").count() for p in previews] == [12, 12] and spark.read.parquet(f"file://{job}/hands/poses.parquet").count() > 0
    commands.seed_object(job, "lid", 5, (60, 60, 80, 80), 128, 96)
    again = commands.Job.opened(spark, job, Whole())
    assert again.rebuild("anchors", "tracks") == ["anchors", "tracks"]
    labels = {r.label for r in spark.read.parquet(f"file://{job}/objects/tracks.parquet").select("label").distinct().collect()}
    assert labels == {"cup", "lid"} or labels == {"lid", "unknown object 1"}
    again.rebuild("depth", every=3)
    assert spark.read.parquet(f"file://{job}/depth/depth_metadata.parquet").count() == 4


def test_commands_refuse_what_is_missing(spark, tmp_path):
    with pytest.raises(ValueError, match="manifest"):
        commands.Job.opened(spark, str(tmp_path), Whole())
    config = ProcessConfig.of("v", str(tmp_path), "cam")
    with pytest.raises(ValueError, match="anchors"):
        commands.Job(spark, config, Whole()).tracks()
    for bad in ({"camera": " "}, {"focal_length_px": 0.0}, {"anchor_device": "tpu"}):
        with pytest.raises(ValueError):
            ProcessConfig.of(**({"video": "v", "output": "o", "camera": "c"} | bad))
    assert set(commands.doctor()) >= {"ffmpeg", "pyspark"}
    path = tmp_path / "m"
    path.write_bytes(b"abc")
    got = commands.provenance({"a": str(path), "b": "/none"})
    assert got["a"]["bytes"] == 3 and got["a"]["sha256"].startswith("ba7816bf") and got["b"]["sha256"] is None
