"""Operators on small fixtures with known results."""

import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from egolake.functions import geometry as G
from egolake.functions import masks as M
from egolake.functions import values as V
from egolake.models import StubBackend, candidates, depth_rows, tracked
from egolake.operators import anchors, depth, folds, hands, kernels, mask_columns, quality, selection, sequence, tracks
from egolake.plans import commands
from egolake.plans.stages import ProcessConfig, Stages, progress, resumed, reusable_frames, run_plan
from egolake.sources import exports, media, profiles, tables
from egolake.streaming import live


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_intervals_merge_and_repeats_start_anew(spark):
    df = spark.createDataFrame([(0, 2, ["a"]), (0, 3, ["b"]), (0, 7, ["c"]), (1, 2, ["x"]), (1, 2, ["y"]), (1, 4, [])], "k int, frame_index long, reasons array<string>")
    got = rows(sequence.merge_intervals(df, ["k"]).orderBy("k", "start_frame", "reasons"), "k", "start_frame", "end_frame", "reasons")
    assert got == [(0, 2, 3, ["a", "b"]), (0, 7, 7, ["c"]), (1, 2, 2, ["x"]), (1, 2, 2, ["y"]), (1, 4, 4, [])]


def test_ranges_and_samples(spark):
    df = spark.createDataFrame([(500,), (10,), (1,)], "n long")
    got = df.select(sequence.chunk_ranges(F.col("n"), 180, 16).alias("r"), sequence.sample_frames(F.col("n"), 4).alias("s"), sequence.sample_frames(F.col("n"), 1).alias("m")).collect()
    assert [tuple(x) for x in got[0].r] == [(0, 180), (164, 344), (328, 500)] and got[0].s == [0, 166, 333, 499] and got[0].m == [250]
    assert got[2].s == [0] and [tuple(x) for x in got[1].r] == [(0, 10)]
    with pytest.raises(ValueError):
        sequence.chunk_ranges(F.col("n"), 5, 5)


def test_derivatives_stop_at_gaps(spark):
    df = spark.createDataFrame([(0, i, float(i), [x], ok) for i, (x, ok) in enumerate([(0.0, True), (1.0, True), (float("nan"), False), (10.0, True), (11.0, True)])], "k int, frame_index long, t double, xyz array<double>, ok boolean")
    got = [v and v[0] for (v,) in rows(sequence.derivatives(df, ["k"], "xyz", "t", F.col("ok")).orderBy("frame_index"), "velocity")]
    assert got == [1.0, 1.0, None, 1.0, 1.0]


def test_slopes_equal_numpy(spark):
    rng = np.random.default_rng(0)
    t, x = np.cumsum(rng.uniform(0.1, 1, 30)), rng.normal(size=30)
    df = spark.createDataFrame([(0, i, float(a), [float(b)]) for i, (a, b) in enumerate(zip(t, x, strict=True))], "k int, frame_index long, t double, xyz array<double>")
    got = sequence.derivatives(df, ["k"], "xyz", "t", F.lit(True)).orderBy("frame_index").collect()
    v = np.gradient(x, t)
    assert np.allclose([r.velocity[0] for r in got], v) and np.allclose([r.acceleration[0] for r in got], np.gradient(v, t))


@pytest.mark.parametrize("n", [3, 5, 6, 8, 9, 20])
def test_smoothing_equals_local_fits(spark, n):
    x = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([(0, i, [float(v)]) for i, v in enumerate(x)], "k int, frame_index long, v array<double>")
    got = [r.v[0] for r in sequence.smoothed(df, ["k"], "v", F.lit(True)).orderBy("frame_index").collect()]
    want = x.copy()
    if n >= 5:
        w = min(9, n if n % 2 else n - 1)
        for i in range(n):
            a = min(max(i - w // 2, 0), n - w)
            want[i] = np.polyval(np.polyfit(np.arange(w), x[a : a + w], 2), i - a)
    assert np.allclose(got, want)


def test_short_runs_and_gaps(spark):
    states = ["rejected"] + ["observed"] * 11 + ["rejected"] + ["observed"] * 12
    df = spark.createDataFrame([(0, i, s, 0.72 if s == "observed" else 0.0) for i, s in enumerate(states)], "k int, frame_index long, state string, confidence double")
    got = rows(sequence.suppress_short_runs(df, ["k"]).orderBy("frame_index"), "state", "confidence")
    assert got == [("rejected", 0.0)] * 13 + [("observed", 0.72)] * 12
    df = spark.createDataFrame([(0, i, [float(i * i)], i in (0, 3, 12)) for i in range(14)], "k int, frame_index long, v array<double>, ok boolean")
    got = rows(sequence.interpolated(df, ["k"], "v", F.col("ok"), 5).orderBy("frame_index"), "v", "inferred")
    assert got[1] == ([3.0], True) and got[2] == ([6.0], True) and got[5] == ([25.0], False) and got[13][1] is False


def test_boxes_and_masks(spark):
    df = spark.range(1).select(G.xyxy(-5, 3, 200, 0.5).alias("a"), G.xyxy(0, 0, 10, 10).alias("b"), G.xyxy(5, 5, 15, 15).alias("c"))
    got = df.select(G.clamp_box(F.col("a"), 100, 50).alias("x"), G.box_iou(F.col("b"), F.col("c")).alias("y"), G.box_iou(G.xyxy(1, 1, 1, 1), G.xyxy(1, 1, 1, 1)).alias("z")).first()
    assert got.x == [0.0, 3.0, 100.0, 1.0] and abs(got.y - 25 / 175) < 1e-12 and got.z == 0
    gate = lambda area, x0, y0, x1, y1: spark.range(1).select(G.mask_gate(F.lit(area), G.xyxy(x0, y0, x1, y1), 100, 100).alias("g")).first().g
    assert gate(750, 20, 20, 45, 50) and not gate(10_000, 0, 0, 100, 100) and not gate(700, 0, 40, 100, 47)
    rng = np.random.default_rng(1)
    for h, w in ((5, 7), (1, 1), (6, 4), (9, 3)):
        mask = rng.random((h, w)) < 0.5
        counts = kernels.encode_rle(mask)
        assert (kernels.decode_rle(counts, h, w) == mask).all() and (kernels.unpacked(kernels.packed(mask), h, w) == mask).all()
        one = spark.createDataFrame([(counts, mask.ravel(order="F").astype(int).tolist())], "c array<int>, p array<int>")
        r = one.select(M.rle_area(F.col("c")).alias("a"), M.rle_decode(F.col("c")).alias("d"), M.rle_encode(F.col("p")).alias("e"), M.rle_box(F.col("c"), h).alias("b"), "c", "p").first()
        assert r.a == mask.sum() and r.d == r.p and r.e == r.c and tuple(r.b) == kernels.mask_box(mask)


def test_components_and_fusion():
    mask = np.zeros((30, 40), bool)
    mask[10:25, 5:30] = True
    mask[2:5, 8:20] = True
    kept, share = kernels.primary_component(mask)
    assert kept.sum() == 375 and abs(share - 375 / 411) < 1e-9
    a, b = np.zeros((20, 30), bool), np.zeros((20, 30), bool)
    a[5:15, 4:17] = True
    b[5:15, 13:26] = True
    fused, agreement, share = kernels.fused(a, b)
    assert (fused == (a | b)).all() and 0 < agreement < 1 and share == 1.0
    assert kernels.fused(None, None) == (None, 0.0, 0.0) and kernels.mask_iou(a & ~a, a & ~a) == 1.0
    spiral = np.zeros((9, 9), bool)
    spiral[::2] = True
    assert kernels.labelled(spiral)[1] == 5
    spiral[:, 8] = True
    assert kernels.labelled(spiral)[1] == 1


def test_depth_normalising_and_quality(spark):
    raw = np.linspace(1, 10, 100).reshape(10, 10)
    one, low, high = kernels.normalised_depth(raw, None)
    _, low2, high2 = kernels.normalised_depth(raw * 2, (low, high))
    assert one.min() >= 0 and one.max() <= 1 and low < low2 < 2 * low and high < high2 < 2 * high
    assert kernels.normalised_depth(raw * np.nan, (1, 2))[1:] == (0.0, 1.0)
    step = np.where(np.arange(12) < 6, 0.0, 1.0) * np.ones((8, 1))
    smooth = kernels.bilateral(step)
    assert smooth[:, :5].mean() < 0.1 and smooth[:, 7:].mean() > 0.9
    df = spark.createDataFrame([(0.0, 0.3, 0.04, 5.0, True), (0.3, 0.0, 0.0, 50.0, False)], "invalid_fraction double, temporal_delta double, glare_fraction double, sharpness double, scene_change boolean")
    got = depth.depth_quality(df).collect()
    assert abs(got[0].confidence - 0.65 * 0.65 * 0.75) < 1e-12 and len(got[0].reasons) == 4 and got[1].status == "rejected" and got[1].confidence == 0


def test_anchor_gates(spark):
    large = [(0, 0, 6400.0, 0.8), (0, 90, 4400.0, 0.7), (0, 180, 640.0, 0.6), (0, 270, 4800.0, 0.4), (1, 0, 6400.0, 0.8), (1, 90, 800.0, 0.9)]
    df = spark.createDataFrame([(*r, False, False) for r in large], "k int, frame_index long, area double, score double, manual boolean, has_confidence boolean")
    got = rows(folds.trusted_anchors(df, ["k"]).orderBy("k", "frame_index"), "accepted", "reasons")
    assert [g[0] for g in got] == [True, True, False, False, True, True]
    assert got[2][1] == ["fragment_area_collapse"] and got[3][1] == ["low_semantic_score"]


def _lifecycle(spark, n, collapse, back, motion):
    data = [(0, i, 0.0 if i >= collapse else 100.0, 100.0 if i >= back else 0.0, 100.0, 100.0, 0.0, 2.5 if motion[0] <= i <= motion[1] else 0.3) for i in range(n)]
    return spark.createDataFrame(data, "k int, offset long, forward_area double, backward_area double, left_area double, right_area double, iou double, motion double")


def test_lifecycle_splits(spark):
    a = tracks.lifecycle_splits(_lifecycle(spark, 20, 7, 0, (10, 14)), ["k"]).first()
    assert (a.old_end, a.new_start, a.split_reason) == (6, 7, "directional_disagreement")
    b = tracks.lifecycle_splits(_lifecycle(spark, 120, 40, 84, (60, 64)), ["k"], 30.0).first()
    assert (b.old_end, b.new_start, b.split_reason) == (39, 84, "post_motion_backward_stability")
    c = tracks.lifecycle_splits(_lifecycle(spark, 120, 40, 500, (60, 64)), ["k"], 30.0).first()
    assert (c.new_start, c.split_reason) == (59, "anchor_proximity_fallback")
    assert tracks.lifecycle_splits(_lifecycle(spark, 20, 500, 0, (900, 900)), ["k"]).count() == 0
    z = spark.createDataFrame([(i,) for i in range(6)], "o long").select("o", tracks.zone(F.col("o"), F.lit(1), F.lit(4), F.col("o") == 0, F.col("o") == 5, F.lit(3).cast("long")).alias("z")).orderBy("o").collect()
    assert [(r.z.source, r.z.instance_id) for r in z] == [("object_anchor", 3), ("cutie_lifecycle_forward", 3), ("lifecycle_quarantine", None), ("lifecycle_quarantine", None), ("cutie_lifecycle_backward", 4), ("object_anchor", 4)]


def test_anchor_consistency(spark):
    r = spark.range(1).select(tracks.anchor_reasons(F.lit(False), F.lit(True), F.lit(0.0), F.lit(0.0)).alias("r")).first().r
    assert r == ["previous_track_collapsed_next_track_disagrees"]


def test_selection(spark):
    df = spark.createDataFrame([(0, 0.9, [10.0, 10.0, 50.0, 50.0]), (0, 0.8, [12.0, 12.0, 48.0, 48.0]), (0, 0.7, [80.0, 80.0, 120.0, 120.0])], "k int, score double, box_xyxy array<double>")
    assert sorted(x for (x,) in rows(selection.suppress_overlaps(df, ["k"], ["score"], [True], 0.7), "score")) == [0.7, 0.9]
    assert rows(selection.suppress_overlaps(df, ["k"], ["score"], [True], 0.7, limit=1), "score") == [(0.9,)]
    det = spark.createDataFrame([(0, 0, 0, [100.0, 100.0, 200.0, 220.0], 0.9), (0, 1, 0, [104.0, 104.0, 204.0, 224.0], 0.72), (0, 1, 1, [600.0, 400.0, 700.0, 520.0], 0.82), (0, 40, 0, [104.0, 104.0, 204.0, 224.0], 0.72), (0, 40, 1, [600.0, 400.0, 700.0, 520.0], 0.82)], "k int, frame_index long, ordinal int, box array<double>, confidence double")
    got = rows(folds.temporal_selection(det, ["k"], 1920, 1080).orderBy("frame_index"), "frame_index", "ordinal")
    assert got == [(0, 0), (1, 0), (40, 1)]


def _candidates(spark, rows_):
    return spark.createDataFrame([(0, i, f, e, a, 1.0, d, 0.9, b, p, lg) for i, (f, e, a, d, b, p, lg) in enumerate(rows_)], "episode int, node long, frame_index long, embedding array<float>, area_fraction double, aspect_ratio double, detector_score double, sam2_mask_score double, box_xyxy array<double>, prompt string, clip_logits map<string,double>")


def test_selectors(spark):
    far, near = [0.0, 0.0, 10.0, 10.0], [50.0, 50.0, 60.0, 60.0]
    c = _candidates(spark, [(0, [1.0, 0.0], 0.1, 0.9, far, "hammer", {"hammer": 30.0, "chisel": 1.0}), (90, [0.99, 0.05], 0.1, 0.9, far, "hammer", {"hammer": 31.0, "chisel": 1.0}), (0, [0.0, 1.0], 0.1, 0.8, near, "chisel", {"hammer": 18.0, "chisel": 25.0}), (90, [0.1, 0.99], 0.1, 0.8, near, "chisel", {"hammer": 18.0, "chisel": 26.0})])
    grouped = anchors.clusters(c, 2, 0.95)
    assert sorted(rows(grouped, "node", "cluster")) == [(0, 0), (1, 0), (2, 2), (3, 2)]
    found = rows(anchors.agnostic_objects(c, 2, 8, 0.95).orderBy("object_id"), "object_id", "label", "cluster")
    assert found == [(1, "unknown object 1", 0), (2, "unknown object 2", 2)]
    chains = rows(anchors.label_chains(c, ["hammer", "chisel"], 2, 0.95).orderBy("object_id"), "object_id", "label", "cluster")
    assert chains == [(1, "hammer", 0), (2, "chisel", 2)]
    objects = anchors.prompted_objects(c, ["Hammer", "saw", "chisel"])
    assert sorted(set(rows(objects, "object_id", "label"))) == [(1, "Hammer"), (2, "chisel")] and objects.count() == 4


def test_hand_gates(spark):
    pts = lambda d: [[100.0 + d, 100.0], [120.0 + d, 125.0], [145.0 + d, 150.0]]
    df = spark.createDataFrame([(pts(0), [80.0, 80.0, 170.0, 180.0]), (pts(500), [80.0, 80.0, 170.0, 180.0])], "p array<array<double>>, b array<double>")
    assert rows(df.select(hands.projection_fits(F.col("p"), F.col("b"), 1920, 1080).alias("x")), "x") == [(True,), (False,)]
    line = [[100.0 + 5 * i, 100.0 + 5 * i] for i in range(21)]
    df = spark.createDataFrame([(line, [[x + d, y, 1.0] for x, y in line], [90.0, 90.0, 210.0, 210.0]) for d in (0, 150)] + [(line, [[x, y, 0.1] for x, y in line], [90.0, 90.0, 210.0, 210.0])], "p array<array<double>>, k array<array<double>>, b array<double>")
    assert rows(df.select(hands.landmarks_fit(F.col("p"), F.col("k"), F.col("b")).alias("x")), "x") == [(True,), (False,), (False,)]


def test_trajectories(spark):
    joints = [None if i in (5, 6) else [float(i + j) for j in range(63)] for i in range(30)]
    df = spark.createDataFrame([("left", i, i / 10, j, 0.9) for i, j in enumerate(joints)], "handedness string, frame_index long, timestamp_s double, joints array<double>, confidence double")
    got = hands.trajectories(df, ["handedness"]).orderBy("frame_index").collect()
    assert [r.state for r in got] == ["inferred" if i in (5, 6) else "observed" for i in range(30)]
    assert all(abs(r.wrist_velocity_mps[0] - 10) < 1e-6 for r in got) and got[5].confidence == 0.35 and len(got[0].fingertips_xyz_m) == 15


def test_values(spark):
    df = spark.createDataFrame([("a=b=c", " x, ,y ,x", "30000/1001", 1920, 1080, "N/A", 10.02), ("=b", "", "1/0", 0, 0, "12", 1.0)], "kv string, l string, r string, w int, h int, n string, d double")
    r = df.select(V.key_value(F.col("kv")).alias("kv"), V.comma_list(F.col("l")).alias("l"), V.rate(F.col("r")).alias("r"), V.aspect_text(F.col("w"), F.col("h")).alias("a"), V.frame_count(F.col("n"), F.col("d"), V.rate(F.col("r"))).alias("n"), V.colour(F.lit(7)).alias("c")).collect()
    assert tuple(r[0].kv) == ("a", "b=c") and r[1].kv is None and r[0].l == ["x", "y", "x"] and r[1].l == [] and abs(r[0].r - 30000 / 1001) < 1e-9 and r[1].r == 0
    assert r[0].a == "16:9" and r[0].n == 300 and r[1].n == 12 and r[0].c == [255, 80, 110]
    assert V.stable_hash({"b": 1, "a": 2}) == V.stable_hash({"a": 2, "b": 1}) and len(V.stable_hash({})) == 16
    key = lambda **k: V.segment_key(**({"object_id": 1, "start": 0, "end": 90, "size": 480, "direction": "forward", "mem_every": 10, "max_mem": 3, "mask_rle": {"size": [1], "counts": [1]}} | k))
    assert key() == key() and len({key(), key(end=91), key(direction="backward"), key(max_mem=4), key(mask_rle={"size": [2]})}) == 5


def test_files_and_stages(spark, tmp_path):
    exports.save_json({"a": 1}, f"{tmp_path}/x/doc.json")
    exports.save_arrays(f"{tmp_path}/x/a.npz", v=np.arange(3))
    assert json.load(open(f"{tmp_path}/x/doc.json")) == {"a": 1} and not [f for f in os.listdir(tmp_path / "x") if f.endswith(".tmp")]
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/x/a.npz")
    assert rows(tables.tensors(files, "v"), "shape", "values") == [([3], [0.0, 1.0, 2.0])]
    exports.link_or_copy(f"{tmp_path}/x/doc.json", f"{tmp_path}/y/doc.json")
    config = ProcessConfig.of("v.mp4", str(tmp_path), "cam", objects=["cup"])
    assert config.max_auto_objects == 1 and config.object_mode and config.anchor_stride == 90 and config.depth_input_size == 756
    with pytest.raises(ValueError):
        ProcessConfig.of("v", "o", "c", objects=["a"], labels=["b"])
    ran = []
    steps = [(n, lambda n=n: ran.append(n)) for n in ("decode", "anchors", "tracks")]
    stages = Stages(str(tmp_path), config.signature())
    assert run_plan(stages, steps) == ["decode", "anchors", "tracks"] and run_plan(stages, steps) == [] and run_plan(stages, steps, "anchors") == ["anchors", "tracks"]
    assert commands.status(str(tmp_path)).keys() == {"decode", "anchors", "tracks"}
    assert reusable_frames(config, {"input_video": "v.mp4", "camera_model": "cam", "frame_count": 1}, 1)
    done = spark.createDataFrame([(0,), (3,)], "frame_index long")
    assert tuple(progress(done, 3, 10).first()) == (2, 4)
    frames = spark.range(6).withColumnRenamed("id", "frame_index")
    worked = []
    step = lambda df: (worked.append(df.count()), df)[1]
    resumed(frames.where("frame_index < 4"), f"file://{tmp_path}/c", "s1", ["frame_index"], step)
    assert resumed(frames, f"file://{tmp_path}/c", "s1", ["frame_index"], step).count() == 6 and worked == [4, 2]
    assert len(commands.seed_object(str(tmp_path), "Cup", 3, (0, 0, 5, 5), 10, 10)) == 1 and len(commands.seed_object(str(tmp_path), "cup ", 3, (1, 1, 5, 5), 10, 10)) == 1
    with pytest.raises(ValueError):
        commands.seed_object(str(tmp_path), "cup", 3, (0, 0, 50, 5), 10, 10)


def test_profiles(spark, tmp_path):
    doc = {"profile_id": "p", "camera_make_model": "Big Cam", "aliases": ["big"], "video": {"width": 1920, "height": 1080, "nominal_fps": 29.97}}
    exports.save_json(doc, f"{tmp_path}/a.json")
    streams = spark.createDataFrame([(0, " BIG cam", 1920, 1080, 30000 / 1001), (1, "big", 1920, 1080, 25.0), (2, "small", 1920, 1080, 0.0)], "s int, camera string, width int, height int, fps double")
    got = profiles.match_profiles(streams, profiles.catalogue(spark, f"file://{tmp_path}"), ["s"]).orderBy("s")
    assert rows(got, "profile") == [("a.json",), (None,), (None,)]


def test_a_stream_meets_one_row_of_the_profiles_that_it_fits(spark):
    known = spark.range(300).select(F.col("id").alias("profile"), F.array(F.lit("Cam"), F.lit("cam "), F.lit(None).cast("string")).alias("aliases"), F.lit(4).alias("width"), F.lit(3).alias("height"), F.when(F.col("id") > 9, F.when(F.col("id") % 7 != 0, 20 + F.col("id") % 7 / 20.0)).alias("fps"))
    known = known.union(known.where("profile in (11, 16)").selectExpr("profile + 290", "array('other')", "width", "height", "if(profile = 11, 0.0D, 25.0D)"))
    rates = [0.0, None, 20.05, 20.2, 20.4, 20.41, 25.05, 26.0]
    data = [(k % 3, name, 4, 3, f) for k, (name, f) in enumerate((n, f) for n in (" CAM", "Other", "none", None) for f in rates)] + [(None, "cam", 4, 3, 20.3), (1, "cam", 5, 3, 0.0)]
    streams = spark.createDataFrame(data * 30, "s int, camera string, width int, height int, fps double")
    facts = [(r.profile, {n.strip().lower() for n in r.aliases if n}, r.width, r.height, r.fps) for r in known.collect()]
    want = []
    for s, camera, w, h, f in data * 30:
        fits = [p for p, names, pw, ph, pf in facts if camera and camera.strip().lower() in names and (pw, ph) == (w, h) and (not f or (pf is not None and (pf == 0 or abs(f - pf) <= 0.1)))]
        want.append((s, camera, w, h, f, min(fits, default=None)))
    out = profiles.match_profiles(streams, known, ["s"])
    assert out.columns == ["s", "camera", "width", "height", "fps", "profile"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)  # rows that repeat their keys have profiles of their own


def test_runs_take_time_by_the_pixels(spark):
    pixels = F.transform(F.sequence(F.lit(0), F.lit(599)), lambda i: (i % 3 == 0).cast("int"))
    began = time.time()
    got = spark.range(1).select(M.rle_encode(pixels).alias("r")).first().r
    assert got == [0] + [1, 2] * 200 and time.time() - began < 20


def test_runs_from_places(spark):
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 35):
        data = []
        for share in (0, 0.1, 0.5, 0.9, 1):
            mask = rng.random(size) < share
            places = rng.permutation(np.flatnonzero(mask)).tolist()
            data.append((places + places[:2] + [-1, size, size + 3], kernels.encode_rle(mask.reshape(-1, 1))))
        got = spark.createDataFrame(data, "places array<long>, counts array<int>").select("counts", M.rle_from_places(F.col("places"), size).alias("r")).collect()
        assert [r.r for r in got] == [r.counts for r in got]
    one = spark.range(1).select(M.rle_from_places(F.array(F.lit(7), F.lit(10**8), F.lit(8)), 10**9).alias("r"), M.rle_from_places(F.lit(None).cast("array<int>"), 4).alias("n")).first()
    assert one.r == [7, 2, 10**8 - 9, 1, 9 * 10**8 - 1] and one.n is None


@pytest.mark.parametrize("name", ["mask_corners", "mask_fuse", "mask_logic", "mask_union", "packed_masks"])
def test_mask_queries_on_sparse_and_full_masks(spark, tmp_path, name):
    import duckdb

    con, path = duckdb.connect(), str(tmp_path / "events.parquet")
    con.execute("CREATE VIEW events AS SELECT u * 1000 + e AS event_id, u AS user_id, 95.0::DOUBLE AS value FROM range(64) a(u), range(192) b(e) WHERE e < 3 * (u + 1) UNION ALL SELECT 0, 0, 95.0 UNION ALL SELECT 5, 99, 90.0")
    con.execute(f"COPY events TO '{path}' (FORMAT parquet)")
    got = __spark_entry__.queries()[name](spark, str(tmp_path))
    found, began = {r.track: r.asDict() for r in got.collect()}, time.time()
    assert len(got.collect()) == 64 and time.time() - began < 20  # code is compiled by now
    want = con.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert found == {r["track"]: r for r in (dict(zip(names, r, strict=True)) for r in want.fetchall())} and len(found) == 64


def spread(height, width, n, shift):
    """Counts of a mask of n runs of 5 pixels."""
    step = height * width // n
    return [shift, 5] + [step - 5, 5] * (n - 1) + [step - 5 - shift + height * width % n]


SOME = [None, [0, 6], [6], [1, 2, 3], [0, 1, 0, 2, 1, 0, 0, 1, 1], [2, 0, 0, 4]]


def drawn(counts, height, width):
    return np.zeros((height, width), bool) if counts is None else kernels.decode_rle(counts, height, width)


def test_masks_are_combined_by_their_runs(spark):
    data = [(a, b, 2, 3) for a in SOME for b in SOME] + [([], None, 0, 4), ([7, 1], [0, 8], 8, 1)]
    got = mask_columns.combined_masks(spark.createDataFrame(data, "a array<int>, b array<int>, h int, w int").coalesce(1), "a", "b", "h", "w").collect()
    for a, b, h, w, *found in got:
        x, y = drawn(a, h, w), drawn(b, h, w)
        assert found == [kernels.encode_rle(m) for m in (x & y, x | y, x & ~y, ~(x | y))]
    assert len(got) == len(data)
    with pytest.raises(Exception, match="ValueError"):
        mask_columns.combined_masks(spark.createDataFrame([([5], [6], 2, 3)], "a array<int>, b array<int>, h int, w int"), "a", "b", "h", "w").collect()
    h, w = 20_000, 10_000
    large = spark.createDataFrame([(i, spread(h, w, 1000, 0), spread(h, w, 1000, 3), h, w) for i in range(40)], "id int, a array<int>, b array<int>, h int, w int").coalesce(1)
    began = time.time()
    out = mask_columns.combined_masks(large, "a", "b", "h", "w").select("id", *(M.rle_area(F.col(c)) for c in ("both", "either", "only_first", "neither"))).collect()
    assert sorted(map(tuple, out)) == [(i, 2000, 8000, 3000, h * w - 8000) for i in range(40)] and time.time() - began < 20


def test_unions_are_made_by_runs(spark):
    data = [(m, 2, 3) for m in (None, [], [None], SOME, SOME[2:4], SOME[3:6], [[0, 6], [0, 6]])] + [([[7, 1], [1, 1, 6]], 8, 1), ([[]], 0, 4)]
    got = mask_columns.union_masks(spark.createDataFrame(data, "masks array<array<int>>, height int, width int").coalesce(1)).collect()
    for masks, h, w, counts, area in got:
        mask = np.logical_or.reduce([np.zeros((h, w), bool), *(drawn(m, h, w) for m in masks or ())])
        assert (counts, area) == (kernels.encode_rle(mask), int(mask.sum()))
    assert len(got) == len(data)
    h, w = 20_000, 10_000
    large = spark.createDataFrame([(i, [spread(h, w, 1000, k) for k in (0, 3, 5, 40)], h, w) for i in range(60)], "id int, masks array<array<int>>, height int, width int").coalesce(1)
    began = time.time()
    out = mask_columns.union_masks(large).select("id", "area", F.size("counts").alias("n")).collect()
    assert sorted(map(tuple, out)) == [(i, 15_000, 4001) for i in range(60)] and time.time() - began < 20


def test_masks_are_packed_a_batch_at_once(spark, monkeypatch):
    data = [(m, 2, 3) for m in SOME] + [([1, 2, 33], 4, 9), ([0, 40], 4, 10), (None, 7, 7), ([7, 1], 8, 1), ([35, 1], 4, 9), (None, None, None)]
    df = spark.createDataFrame(data, "counts array<int>, height int, width int").coalesce(1)
    for most in (1 << 24, 40):
        monkeypatch.setattr(mask_columns, "DRAWN", most, raising=False)
        got = mask_columns.packed_masks(df).collect()
        assert [tuple(r[:3]) for r in got] == data and [r.packed and bytes(r.packed) for r in got] == [c and kernels.packed(drawn(c, h, w)) for c, h, w in data]
        back = mask_columns.unpacked_masks(mask_columns.packed_masks(df)).collect()
        assert [r.counts for r in back] == [c and kernels.encode_rle(drawn(c, h, w)) for c, h, w in data]
    counts = kernels.encode_rle(np.random.default_rng(3).random((12, 16)) < 0.06)
    many = spark.range(0, 300_000, 1, 1).select(F.array(*map(F.lit, counts)).alias("counts"), F.lit(12).alias("height"), F.lit(16).alias("width"))

    def taken(out):
        began = time.time()
        assert out.where("counts = before").count() == 300_000
        return time.time() - began

    many = many.withColumn("before", F.col("counts"))
    singly = mask_columns.by_row(many, ["counts", "height", "width"], "packed binary", lambda c, h, w: (kernels.packed(kernels.decode_rle(c, h, w)),))
    singly = mask_columns.by_row(singly, ["packed", "height", "width"], "counts array<int>", lambda p, h, w: (kernels.encode_rle(kernels.unpacked(p, h, w)),))
    assert taken(mask_columns.unpacked_masks(mask_columns.packed_masks(many))) < 0.7 * taken(singly)


def test_report_and_exports(spark, tmp_path):
    job = str(tmp_path)
    frames = [(i, i / 10, 0.1, f"{i:08d}.jpg") for i in range(4)]
    spark.createDataFrame(frames, "frame_index long, timestamp_s double, duration_s double, file string").write.parquet(f"file://{job}/source/frame_timestamps.parquet")
    exports.save_json({"decoded_width": 64, "decoded_height": 48, "frame_count": 4, "duration_s": 0.4, "input_video": "/none.mp4"}, f"{job}/source/video_metadata.json")
    q = {"frames": [{"frame_index": i, "confidence": 0.5, "status": "rejected" if i in (1, 2) else "accepted", "reasons": ["bad"] if i in (1, 2) else []} for i in range(4)], "quarantined_intervals": [{"start_frame": 1, "end_frame": 2, "reasons": ["bad"]}]}
    exports.save_json(q, f"{job}/objects/quality.json")
    exports.save_json({"annotations": [{"frame_index": 1, "object_id": 1, "instance_id": 1, "rle": {"size": [2, 2], "counts": [0, 4]}}]}, f"{job}/objects/masks.json")
    track = [(i, i / 10, 1, 1, "cup", 0, 0, 2, 2, 4, "visible", 0.9, "object_anchor", 1.0, 1.0) for i in range(2)]
    from egolake import schemas

    spark.createDataFrame(track, schemas.TRACKS).write.parquet(f"file://{job}/objects/tracks.parquet")
    commands.build_quality(spark, job)
    commands.build_exports(spark, job)
    assert spark.read.parquet(f"file://{job}/quality/frame_scores.parquet").count() == 4
    assert json.load(open(f"{job}/quality/quarantined_intervals.json"))[0] == {"stage": "objects", "start_frame": 1, "end_frame": 2, "reasons": ["bad"]}
    coco = json.load(open(f"{job}/exports/coco_video/annotations.json"))
    assert [a["id"] for a in coco["annotations"]] == [2] and coco["categories"] == [{"id": 1, "name": "cup"}] and len(coco["images"]) == 4
    steps = spark.read.parquet(f"file://{job}/exports/rlds/steps.parquet").orderBy("frame_index").collect()
    assert [r.is_first for r in steps] == [True, False, False, False] and steps[3].is_last and steps[3].objects_json == "[]" and steps[0].depth_frame is None
    assert json.load(open(f"{job}/exports/lerobot/meta/info.json"))["fps"] == 10.0
    assert tables.read_table(spark, f"file://{job}/nowhere", schemas.MASKS).count() == 0


def test_model_columns(spark):
    frames = spark.createDataFrame([(i, bytes([i])) for i in range(4)], "frame_index long, content binary")
    backend = StubBackend()
    found = candidates(frames, backend, ["cup", "tool"], ["cup"])
    assert found.count() > 0 and found.where("size(embedding) <> 16").count() == 0
    assert depth_rows(frames, backend).count() == 4
    seg = frames.select(F.lit(1).alias("object_id"), F.col("frame_index").alias("offset"), "content", F.array(F.lit(0), F.lit(10), F.lit(48 * 64 - 10)).alias("seed"))
    assert rows(tracked(seg, backend, ["object_id"]), "area") == [(10,)] * 4
    objects = commands.discover(spark, ProcessConfig("v", "o", "c", anchor_stride=1), backend, frames)
    assert objects.columns == ["episode", "object_id", "label", "cluster", "score"]
    assert commands.probe_objects(frames, backend, ["cup"], [0, 2]).where("frame_index in (1, 3)").count() == 0


def test_media_parsing(spark):
    lines = spark.createDataFrame([("n:0 pts_time:0.033 x",), ("pts_time:nan?",), ("none",)], "value string")
    assert rows(media.log_times(lines), "timestamp_s") == [(0.033,)]
    assert media.usable_times([1.0, 2.0], 2, 30) == [1.0, 2.0] and media.usable_times([1.0], 2, 10) == [0.0, 0.1]
    media.register(spark)
    with pytest.raises(Exception, match="ffprobe|path|needed"):
        spark.read.format("video_frames").load("/none.mp4").collect()


def test_live_report(spark, tmp_path):
    data = spark.createDataFrame([("2024-01-01 00:00:01", "objects", "accepted", 0, 1, ["a"]), ("2024-01-01 00:00:02", "objects", "rejected", 0, 2, ["b"]), ("2024-01-01 00:00:03", "objects", "rejected", 0, 5, ["c"])], "t string, stage string, status string, track long, frame_index long, reasons array<string>")
    data = data.withColumn("ts", F.to_timestamp("t")).drop("t")
    data.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(data.schema).parquet(f"file://{tmp_path}/in")
    q = live.status_counts(stream).writeStream.outputMode("complete").format("memory").queryName("live_counts").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted(rows(spark.table("live_counts"), "status", "frames")) == [("accepted", 1), ("rejected", 2)]


def test_live_intervals_close_by_time(spark, tmp_path):
    """Shuffled frames join their interval, and a track's last interval comes out without a later frame of it."""
    at = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    files = [[(at(3), 0, 3, ["c"]), (at(1), 0, 1, ["a"])], [(at(2), 0, 2, ["b"]), (at(9), 0, 9, ["d"])], [(at(50), 1, 0, ["x"])], [(at(400), 2, 0, ["y"])]]
    for n, rows_ in enumerate(files):
        df = spark.createDataFrame(rows_, "t string, track long, frame_index long, reasons array<string>").withColumn("ts", F.to_timestamp("t")).drop("t")
        df.coalesce(1).write.parquet(f"file://{tmp_path}/in/{n}")
        schema = df.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(f"file://{tmp_path}/in")
    q = live.closed_intervals(stream, "30 seconds", 2.0).writeStream.outputMode("append").format("memory").queryName("live_gaps").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(rows(spark.table("live_gaps"), "track", "start_frame", "end_frame", "reasons")) == [(0, 1, 3, ["a", "b", "c"]), (0, 9, 9, ["d"]), (1, 0, 0, ["x"])]


def test_matching_in_rounds_equals_one_group(spark):
    rng = np.random.default_rng(5)
    data = [(int(i % 2), int(a), int(b), float(s)) for i, (a, b, s) in enumerate(zip(rng.integers(0, 40, 600), rng.integers(40, 80, 600), rng.integers(0, 30, 600) / 10, strict=True))]
    edges = spark.createDataFrame(data, "episode long, i long, j long, similarity double").dropDuplicates(["episode", "i", "j"])
    edges = spark.createDataFrame(edges.collect(), edges.schema)
    for same in (False, True):
        whole = sorted(map(tuple, selection.greedy_matching(edges, ["episode"], "i", "j", "similarity", same).collect()))
        assert whole and sorted(map(tuple, selection.greedy_matching(edges, ["episode"], "i", "j", "similarity", same, limit=5).collect())) == whole
    assert selection.greedy_matching(edges.limit(0), ["episode"], "i", "j", "similarity").count() == 0


def test_quality_rows_need_frames(spark):
    frames = spark.createDataFrame([(0, 0.0)], "frame_index long, timestamp_s double")
    q = spark.createDataFrame([(0, "accepted"), (9, "rejected")], "frame_index long, status string")
    assert quality.unmatched_frames(q, frames).count() == 1
    with pytest.raises(ValueError):
        quality.stage_rows({"a": None})
