"""More queries over the test tables: masks, frames, labels and cameras, each with its SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .adapters import BOXES_SQL, USER_FRAMES_SQL, boxes, iou_sql, table, user_frames
from .catalog import T, query
from .functions import geometry as G
from .functions import masks as M
from .functions import values as V
from .models import with_label_scores
from .operators import depth, hands, kernels, mask_columns, scoring, selection, sequence, tracks
from .plans import stages, tracking
from .sources import exports, media, tables

# masks on a grid of 12 rows and 16 columns -----------------------------------

HEIGHT, WIDTH = 12, 16
_CELLS_SQL = f"ce AS (SELECT DISTINCT user_id AS track, ((event_id * 7 % {HEIGHT * WIDTH}) // {WIDTH})::INT AS y, ((event_id * 7 % {HEIGHT * WIDTH}) % {WIDTH})::INT AS x FROM events WHERE value > 90)"


def _components_sql(cells: str) -> str:
    """Parts of masks whose pixels, grown by one, touch by sides; the largest grown part is kept, of equals the first."""
    return f"""ed AS (SELECT a.track, a.x, a.y, b.x AS u, b.y AS v FROM {cells} a JOIN {cells} b ON a.track = b.track AND abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3 AND abs(a.x - b.x) + abs(a.y - b.y) < 6 AND NOT (abs(a.x - b.x) = 3 AND abs(a.y - b.y) = 3)),
re(track, x, y, r) AS (SELECT track, x, y, y * {WIDTH} + x FROM {cells} UNION SELECT ed.track, ed.u, ed.v, re.r FROM re JOIN ed ON ed.track = re.track AND ed.x = re.x AND ed.y = re.y),
ro AS (SELECT track, x, y, min(r) AS root FROM re GROUP BY track, x, y),
gr AS (SELECT DISTINCT track, root, x + dx AS x, y + dy AS y FROM ro, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy) WHERE x + dx BETWEEN 0 AND {WIDTH - 1} AND y + dy BETWEEN 0 AND {HEIGHT - 1}),
pi AS (SELECT track, root, row_number() OVER (PARTITION BY track ORDER BY count(*) DESC, min(y * {WIDTH} + x)) AS n FROM gr GROUP BY track, root),
co AS (SELECT ro.track, count(*) FILTER (n = 1) AS kept, count(*) AS area FROM ro JOIN pi ON pi.track = ro.track AND pi.root = ro.root GROUP BY ro.track)"""


def _grids(spark, sf_dir):
    """A mask for each user, from the hours of events, and the same upside down: counts, flipped."""
    rows = table(spark, sf_dir, "events").where("value > 90")
    cells = rows.groupBy(F.col("user_id").alias("track")).agg(F.collect_set((F.col("event_id") * 7 % (HEIGHT * WIDTH)).cast("int")).alias("cells"))

    def counts(flip: bool):
        row = lambda c: F.floor(c / WIDTH)
        places = F.transform(F.filter("cells", lambda c: c >= 0), lambda c: (c % WIDTH * HEIGHT + (HEIGHT - 1 - row(c) if flip else row(c))).cast("int"))
        return M.rle_from_places(places, HEIGHT * WIDTH)

    return cells.select("track", counts(False).alias("counts"), counts(True).alias("flipped"), F.lit(HEIGHT).alias("height"), F.lit(WIDTH).alias("width"))


@query(f"WITH RECURSIVE {_CELLS_SQL}, {_components_sql('ce')} SELECT track, kept AS area, round(kept / co.area, 9) AS fraction FROM co")
def primary_component(spark, sf_dir):
    out = mask_columns.primary_components(_grids(spark, sf_dir))
    return out.select("track", M.rle_area(F.col("counts")).alias("area"), F.round("component_fraction", 9).alias("fraction"))


@query(f"""WITH RECURSIVE {_CELLS_SQL}, un AS (SELECT * FROM ce UNION SELECT track, {HEIGHT - 1} - y, x FROM ce), {_components_sql('un')},
ag AS (SELECT a.track, count(b.x) AS hits FROM ce a LEFT JOIN ce b ON a.track = b.track AND a.x = b.x AND a.y = {HEIGHT - 1} - b.y GROUP BY 1)
SELECT track, CASE WHEN kept / co.area >= 0.65::DOUBLE THEN kept END AS area, round(hits / co.area, 9) AS agreement, round(kept / co.area, 9) AS fraction FROM co JOIN ag USING (track)""")
def mask_fuse(spark, sf_dir):
    out = mask_columns.fused_masks(_grids(spark, sf_dir), "counts", "flipped")
    return out.select("track", "area", F.round("directional_iou", 9).alias("agreement"), F.round("component_fraction", 9).alias("fraction"))


@query(f"WITH {_CELLS_SQL}, un AS (SELECT * FROM ce UNION SELECT track, {HEIGHT - 1} - y, x FROM ce) SELECT track, count(*) AS area FROM un GROUP BY 1")
def mask_union(spark, sf_dir):
    rows = _grids(spark, sf_dir).select("track", F.array("counts", "flipped", F.lit(None).cast("array<int>")).alias("masks"), "height", "width")
    return mask_columns.union_masks(rows).select("track", "area")


@query(f"WITH {_CELLS_SQL} SELECT track, [min(x), min(y), max(x) - min(x) + 1, max(y) - min(y) + 1]::BIGINT[] AS box FROM ce GROUP BY 1")
def mask_box(spark, sf_dir):
    return _grids(spark, sf_dir).select("track", M.rle_box(F.col("counts"), HEIGHT).alias("box"))


@query(f"WITH {_CELLS_SQL} SELECT track, count(*) AS area FROM ce, range(0, 18) a(i), range(0, 40) b(j) WHERE i * {HEIGHT} // 18 = y AND j * {WIDTH} // 40 = x GROUP BY 1")
def mask_rescale(spark, sf_dir):
    rows = _grids(spark, sf_dir).withColumns({"to_height": F.lit(18), "to_width": F.lit(40)})
    return mask_columns.rescaled_masks(rows, "to_height", "to_width").select("track", M.rle_area(F.col("counts")).alias("area"))


_DEPTH_SQL = "de AS (SELECT n_nationkey AS track, y, x, (((n_nationkey * 7 + y * 13 + x * 29) % 100) / 100.0)::FLOAT::DOUBLE AS v FROM nation, range(0, 8) a(y), range(0, 10) b(x))"


@query(f"""WITH {_DEPTH_SQL}, o AS (SELECT dy, dx FROM (SELECT unnest(range(-2, 3)) AS dy), (SELECT unnest(range(-2, 3)) AS dx) WHERE dy * dy + dx * dx <= 4),
w AS (SELECT d.track, d.y, d.x, n.v, exp(-(dy * dy + dx * dx) / (2 * 9.0::DOUBLE) - power(n.v - d.v, 2) / (2 * power(0.035::DOUBLE, 2))) AS w FROM de d, o JOIN de n ON n.track = d.track AND n.y = 7 - abs(7 - abs(d.y + dy)) AND n.x = 9 - abs(9 - abs(d.x + dx)))
SELECT track, round(sum(s), 3) AS total FROM (SELECT track, y, x, sum(w * v) / sum(w) AS s FROM w GROUP BY ALL) GROUP BY 1""")
def depth_smoothing(spark, sf_dir):
    y, x = np.mgrid[:8, :10]

    def grid(track):
        return (((track * 7 + y * 13 + x * 29) % 100 / 100).astype(np.float32).tobytes(),)

    def total(data):
        return (float(np.frombuffer(data, np.float32).astype(float).sum()),)

    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("track"), F.lit(8).alias("height"), F.lit(10).alias("width"))
    out = mask_columns.smoothed_depth(mask_columns.by_row(rows, ["track"], "depth binary", grid))
    return mask_columns.by_row(out, ["depth"], "total double", total).select("track", F.round("total", 3).alias("total"))


# frames ----------------------------------------------------------------------

_THUMBS_SQL = f"{USER_FRAMES_SQL}, th AS (SELECT track, frame_index, [value, value * 0.5::DOUBLE, frame_index % 5 * 20.0::DOUBLE, 100 - value] AS t FROM uf)"


def _thumbnails(spark, sf_dir):
    v, i = F.col("value"), F.col("frame_index")
    return user_frames(spark, sf_dir).select("track", "frame_index", F.array(v, v * 0.5, (i % 5 * 20).cast("double"), 100 - v).alias("thumbnail"))


@query(f"""WITH {_THUMBS_SQL}, l AS (SELECT *, lag(t) OVER (PARTITION BY track ORDER BY frame_index) AS p FROM th)
SELECT track, frame_index, coalesce(list_avg(list_transform(range(1, 5), lambda k: abs(t[k] - p[k]))) > 45, false) AS scene_change FROM l""")
def scene_changes(spark, sf_dir):
    return depth.scene_changes(_thumbnails(spark, sf_dir), T).select("track", "frame_index", "scene_change")


@query(f"""WITH {_THUMBS_SQL}, l AS (SELECT *, lag(t) OVER (PARTITION BY track ORDER BY frame_index) AS p FROM th)
SELECT track, frame_index, round(CASE WHEN p IS NULL OR frame_index % 11 = 0 THEN 0 ELSE list_median(list_transform(range(1, 5), lambda k: abs(t[k] - p[k]))) END, 6) AS temporal_delta FROM l""")
def temporal_deltas(spark, sf_dir):
    rows = _thumbnails(spark, sf_dir).withColumn("scene_change", F.col("frame_index") % 11 == 0)
    return depth.temporal_deltas(rows, T, "thumbnail").select("track", "frame_index", F.round("temporal_delta", 6).alias("temporal_delta"))


@query("SELECT count(DISTINCT l_orderkey)::BIGINT AS completed, ((SELECT count(*) FROM orders) + 2) // 3 AS total FROM lineitem WHERE l_orderkey % 3 = 0")
def checkpoint_progress(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 = 0").select(F.col("l_orderkey").alias("frame_index"))
    return stages.progress(done, 3, table(spark, sf_dir, "orders").count())


@query("SELECT o_orderkey AS frame_index FROM orders WHERE o_orderkey - 50 >= 0 AND o_orderkey - 50 < 700")
def frames_in_range(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") - 50).alias("frame_index"))
    return sequence.in_range(rows, F.lit(700)).select((F.col("frame_index") + 50).alias("frame_index"))


@query("""SELECT p_partkey AS part, round(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 30000.0::DOUBLE / (1000 + p_partkey % 7) END, 9) AS fps,
 CASE WHEN p_partkey % 3 = 0 THEN p_partkey ELSE greatest(round_even(p_retailprice / 1000 * CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 30000.0::DOUBLE / (1000 + p_partkey % 7) END, 0)::BIGINT, 1) END AS frames FROM part""")
def stream_values(spark, sf_dir):
    key = F.col("p_partkey")
    rate = F.when(key % 7 == 0, F.lit("0/0")).otherwise(F.concat(F.lit("30000/"), (1000 + key % 7).cast("string")))
    stated = F.when(key % 3 == 0, key.cast("string")).otherwise("N/A")
    stream = F.struct(stated.alias("nb_frames"), (F.col("p_retailprice") / 1000).cast("string").alias("duration"), rate.alias("avg_frame_rate"), rate.alias("r_frame_rate"))
    got = table(spark, sf_dir, "part").select(key.alias("part"), media.stream_values(stream).alias("s"))
    return got.select("part", F.round("s.fps", 9).alias("fps"), "s.frames")


# anchors, tracks and labels --------------------------------------------------


@query(f"""WITH {BOXES_SQL} SELECT part, label, arg_max(ordinal, (frame_index, ordinal)) AS ordinal, max(frame_index) AS frame_index FROM (SELECT *, row_number() OVER (PARTITION BY part, frame_index ORDER BY ordinal DESC) AS n FROM bx WHERE quantity >= 10) WHERE n = 1 GROUP BY part, label""")
def latest_anchors(spark, sf_dir):
    found = boxes(spark, sf_dir).withColumn("found", F.col("quantity") >= 10).withColumn("area", F.col("quantity"))
    rows = scoring.latest_anchors(scoring.usable_anchors(found), ["part"], "ordinal")
    return rows.groupBy("part", "label").agg(F.max(F.struct("frame_index", "ordinal")).alias("m")).select("part", "label", "m.ordinal", "m.frame_index")


@query(f"""WITH {BOXES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY detector_score * sqrt(greatest(quantity, 1)) DESC, frame_index, ordinal) AS n FROM bx) SELECT part, frame_index, ordinal FROM r WHERE n = 1""")
def representative_by_confidence(spark, sf_dir):
    rows = boxes(spark, sf_dir).withColumn("confidence", F.col("detector_score")).withColumn("area", F.col("quantity"))
    return scoring.representative_by_confidence(rows, ["part"], ["frame_index", "ordinal"]).select("part", "frame_index", "ordinal")


@query(f"WITH {BOXES_SQL} SELECT frame_index, ordinal, quantity > 0 AND quantity >= 0.2::DOUBLE * greatest(part % 250, 1) AS plausible FROM bx")
def plausible_masks(spark, sf_dir):
    return boxes(spark, sf_dir).select("frame_index", "ordinal", tracks.plausible(F.col("quantity"), F.col("part") % 250).alias("plausible"))


@query("""WITH l AS (SELECT c_nationkey AS track, c_mktsegment AS label, round(avg(c_acctbal) / 10000, 3) AS score FROM customer GROUP BY ALL)
SELECT track, list(label ORDER BY score DESC, label DESC) AS labels, arg_max(label, (score, label)) AS label, max(score) AS clip_score FROM l GROUP BY 1""")
def label_ranking(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("track"), F.col("c_mktsegment").alias("label")).agg(F.round(F.avg("c_acctbal") / 10000, 3).alias("score"))
    return tracking.label_details(rows, ["track"]).select("track", F.col("scores.label").alias("labels"), "label", "clip_score")


@query("""SELECT n_regionkey AS episode, n_nationkey AS object_id, coalesce(l, n_name) AS label, CASE WHEN l IS NOT NULL THEN n_name END AS pre_clip_label, s AS clip_score, l <> 'AUTOMOBILE' AS clip_accepted
FROM nation LEFT JOIN (SELECT c_nationkey AS k, max(c_mktsegment) AS l, count(*)::DOUBLE AS s FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY 1) ON k = n_nationkey""")
def discovery_summary(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("episode"), F.col("n_nationkey").alias("object_id"), F.col("n_name").alias("label"))
    given = table(spark, sf_dir, "customer").where("c_nationkey % 3 <> 0").groupBy(F.col("c_nationkey").alias("object_id")).agg(F.max("c_mktsegment").alias("label"), F.count("*").cast("double").alias("clip_score"))
    given = given.join(nation.select("episode", "object_id"), "object_id").withColumn("accepted", F.col("label") != "AUTOMOBILE")
    return tracking.updated_summary(nation, given).select("episode", "object_id", "label", "pre_clip_label", "clip_score", "clip_accepted")


@query("""WITH e AS (SELECT p_partkey AS part, [p_size / 5.0::DOUBLE, p_partkey % 7, p_retailprice / 200] AS l FROM part), p AS (SELECT part, l, list_transform(l, lambda v: exp(v - list_max(l))) AS x FROM e)
SELECT part, list_transform(x, lambda v: round(v / list_sum(x), 9)) AS scores, ['small', 'odd', 'dear'][list_position(l, list_max(l))] AS best FROM p""")
def label_softmax(spark, sf_dir):
    logits = F.create_map(F.lit("small"), F.col("p_size") / 5.0, F.lit("odd"), (F.col("p_partkey") % 7).cast("double"), F.lit("dear"), F.col("p_retailprice") / 200)
    rows = with_label_scores(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), logits.alias("clip_logits")))
    return rows.select("part", F.transform(F.map_values("clip_scores"), lambda v: F.round(v, 9)).alias("scores"), F.col("clip_best_prompt").alias("best"))


# hands and cameras -----------------------------------------------------------


@query(f"""WITH {BOXES_SQL}, d AS (SELECT frame_index, ordinal, CASE WHEN part % 2 = 0 THEN 'left' ELSE 'right' END AS handedness, x0, y0, x1, y1 FROM bx),
a AS (SELECT * FROM d WHERE ordinal % 3 <> 0), q AS (SELECT frame_index, ordinal, handedness, least(greatest(x0 - 12, 0), 79) AS x0, least(greatest(y0 - 7, 0), 59) AS y0, least(greatest(x1 - 12, 0), 79) AS x1, least(greatest(y1 - 7, 0), 59) AS y1 FROM d),
b AS (SELECT * FROM q WHERE x1 - x0 >= 8 AND y1 - y0 >= 8), s AS (SELECT DISTINCT frame_index FROM a WHERE handedness = 'left'), z AS (SELECT DISTINCT frame_index FROM a)
SELECT frame_index, ordinal, handedness, x0, y0, x1, y1, 'primary' AS origin FROM a UNION ALL
SELECT *, 'padded' FROM b WHERE (frame_index % 4 = 0 AND frame_index NOT IN (SELECT frame_index FROM s)) OR frame_index NOT IN (SELECT frame_index FROM z)""")
def padded_detections(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", F.when(F.col("part") % 2 == 0, "left").otherwise("right").alias("handedness"), F.col("box_xyxy").alias("box"))
    primary = rows.where("ordinal % 3 <> 0").withColumn("origin", F.lit("primary"))
    padded = hands.shifted_detections(rows, F.lit(12), F.lit(7), F.lit(80), F.lit(60)).withColumn("origin", F.lit("padded"))
    expected = rows.where("frame_index % 4 = 0").select("frame_index", F.lit("left").alias("handedness")).distinct()
    out = hands.with_padded(primary, padded, expected, ["frame_index"])
    return out.select("frame_index", "ordinal", "handedness", *(F.col("box")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))), "origin")


@query("""SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 0 THEN 900 + p_size WHEN p_partkey % 3 = 1 THEN 500 + p_size ELSE 0.8::DOUBLE * greatest(p_size * 12, 300) END AS focal,
 CASE WHEN p_partkey % 3 = 0 THEN 'user-supplied calibrated effective focal length' WHEN p_partkey % 3 = 1 THEN 'camera profile ' || p_brand || ' (profile policy)' ELSE 'image-size heuristic' END AS provenance FROM part""")
def focal_lengths(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    got = G.focal_length(F.when(key % 3 == 0, 900 + size), F.when(key % 3 == 1, 500 + size), F.col("p_brand"), F.lit(None).cast("string"), F.col("p_size") * 12, F.lit(300))
    return table(spark, sf_dir, "part").select(key.alias("part"), got.alias("f")).select("part", "f.focal", "f.provenance")


@query(f"""WITH {BOXES_SQL} SELECT frame_index, ordinal, round(0.1::DOUBLE + 2 * ((x0 + x1) / 2 - 48) / (2 * quantity + 1e-9::DOUBLE) / 1.5::DOUBLE, 6) AS x, round(-0.2::DOUBLE + 2 * ((y0 + y1) / 2 - 27) / (2 * quantity + 1e-9::DOUBLE) / 1.5::DOUBLE, 6) AS y,
 round(2 * 700 / (2 * quantity * 1.5::DOUBLE + 1e-9::DOUBLE), 6) AS z FROM bx""")
def camera_translations(spark, sf_dir):
    move = G.camera_translation(F.lit(1.5), F.lit(0.1), F.lit(-0.2), F.col("box_xyxy"), 2.0 * F.col("quantity"), F.lit(700.0), F.lit(96), F.lit(54))
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", move.alias("t"))
    return rows.select("frame_index", "ordinal", *(F.round(F.col("t")[i], 6).alias(c) for i, c in enumerate(("x", "y", "z"))))


@query("SELECT p_partkey AS part, least(1.0::DOUBLE, 300 / greatest(p_size * 12, 200)::DOUBLE) AS scale, left(replace(p_brand || '/' || p_type || '/' || p_name || '/' || p_type || '/' || p_name, '/', '_'), 60) AS file FROM part")
def file_names_and_scales(spark, sf_dir):
    name = F.concat_ws("/", "p_brand", "p_type", "p_name", "p_type", "p_name")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), G.scaled_side(F.col("p_size") * 12, F.lit(200), 300).alias("scale"), V.file_safe(name).alias("file"))


# values, documents and sinks ---------------------------------------------------


@query("""WITH t AS (SELECT p_partkey AS part, CASE p_partkey % 4 WHEN 0 THEN ' ' || p_brand || ' = /' || p_type || '=x ' WHEN 1 THEN p_brand WHEN 2 THEN '=' || p_brand ELSE p_brand || '= ' END AS t FROM part)
SELECT part, CASE WHEN part % 4 = 0 THEN trim(string_split(t, '=')[1]) END AS key, CASE WHEN part % 4 = 0 THEN trim(substr(t, strpos(t, '=') + 1)) END AS value FROM t""")
def key_values(spark, sf_dir):
    key, b = F.col("p_partkey") % 4, F.col("p_brand")
    text = F.when(key == 0, F.concat(F.lit(" "), b, F.lit(" = /"), F.col("p_type"), F.lit("=x "))).when(key == 1, b).when(key == 2, F.concat(F.lit("="), b)).otherwise(F.concat(b, F.lit("= ")))
    got = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), V.key_value(text).alias("kv"))
    return got.select("part", "kv.key", "kv.value")


@query("SELECT n_nationkey AS object_id, [[0, 210, 255], [255, 80, 110], [100, 230, 120], [190, 110, 255], [255, 190, 50], [40, 150, 255]][n_nationkey % 6 + 1] AS colour, n_nationkey || '_lost' AS reason FROM nation")
def object_colours(spark, sf_dir):
    i = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(i.alias("object_id"), V.colour(i).alias("colour"), V.reason(i, "lost").alias("reason"))


@query("SELECT r_regionkey AS region, CASE WHEN r_regionkey % 2 = 0 THEN [lower(r_name), 'cup'] ELSE NULL END AS own, CASE WHEN r_regionkey % 2 = 0 THEN 2 ELSE 22 END AS n FROM region")
def chosen_prompts(spark, sf_dir):
    own = F.when(F.col("r_regionkey") % 2 == 0, F.array(F.concat(F.lit(" "), F.lower("r_name")), F.lit("cup "), F.lit(" "))).otherwise(F.array().cast("array<string>"))
    got = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region"), own.alias("o"), V.chosen_prompts(own).alias("p"))
    return got.select("region", F.when(F.size("o") > 0, F.col("p")).alias("own"), F.size("p").alias("n"))


@query("SELECT p_partkey AS part, CASE WHEN p_partkey % 5 <> 0 THEN sha256(p_name || p_brand) END AS hash FROM part")
def content_hashes(spark, sf_dir):
    content = F.when(F.col("p_partkey") % 5 != 0, F.concat("p_name", "p_brand").cast("binary"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), V.file_sha256(content).alias("hash"))


@query("SELECT n_regionkey AS region, list(n_name ORDER BY n_nationkey)[1 : 1 + n_regionkey] AS labels FROM nation GROUP BY 1")
def capped_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))
    return rows.select("region", selection.capped_labels(F.col("n.n_name"), (F.col("region") + 1).cast("int")).alias("labels"))


@query("SELECT c_mktsegment AS label, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS cluster, max(c_acctbal) AS score FROM customer GROUP BY 1")
def best_cluster_per_label(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("cluster"), F.col("c_acctbal").alias("score"))
    return selection.best_per_group(rows, ["label"], F.col("score"), ["cluster"])


@query(f"""WITH RECURSIVE {BOXES_SQL}, o AS (SELECT frame_index, ordinal, x0, y0, x1, y1, detector_score AS s, row_number() OVER (PARTITION BY frame_index ORDER BY detector_score DESC, ordinal) AS n FROM bx),
r(frame_index, n, kept) AS (SELECT DISTINCT frame_index, 0::BIGINT, []::BIGINT[] FROM bx UNION ALL
 SELECT r.frame_index, o.n, CASE WHEN len(r.kept) >= 3 OR EXISTS (SELECT 1 FROM o k WHERE k.frame_index = o.frame_index AND list_contains(r.kept, k.ordinal) AND {iou_sql("k", "o")} > 0.2::DOUBLE) THEN r.kept ELSE list_append(r.kept, o.ordinal) END
 FROM r JOIN o ON o.frame_index = r.frame_index AND o.n = r.n + 1)
SELECT frame_index, unnest(arg_max(kept, n)) AS cluster FROM r GROUP BY 1""")
def diverse_clusters(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", F.col("ordinal").alias("cluster"), F.col("detector_score").alias("score"), "box_xyxy")
    return scoring.diverse_clusters(rows, ["frame_index"], 3, 0.2).select("frame_index", "cluster")


@query(f"""WITH {_CELLS_SQL}, f AS (SELECT track, {HEIGHT - 1} - y AS y, x FROM ce), u AS (SELECT track, y, x, bool_or(a) AS a, bool_or(b) AS b FROM (SELECT track, y, x, true AS a, false AS b FROM ce UNION ALL SELECT track, y, x, false, true FROM f) GROUP BY ALL)
SELECT track, count(*) FILTER (a AND b) AS both, count(*) AS either, count(*) FILTER (a AND NOT b) AS only_first, {HEIGHT * WIDTH} - count(*) AS neither FROM u GROUP BY 1""".replace("AS both", 'AS "both"'))
def mask_logic(spark, sf_dir):
    out = mask_columns.combined_masks(_grids(spark, sf_dir), "counts", "flipped")
    return out.select("track", *(M.rle_area(F.col(c)).alias(c) for c in ("both", "either", "only_first", "neither")))


@query(f"""WITH {_CELLS_SQL}, b AS (SELECT track, y, sum(1::BIGINT << (15 - x)) AS v FROM ce GROUP BY ALL), a AS (SELECT track, i AS y FROM (SELECT DISTINCT track FROM ce), range(0, {HEIGHT}) r(i))
SELECT a.track, string_agg(lpad(lower(to_hex(coalesce(v, 0)::BIGINT)), 4, '0'), '' ORDER BY a.y) AS packed, count(*) > 0 AS same FROM a LEFT JOIN b ON b.track = a.track AND b.y = a.y GROUP BY 1""")
def packed_masks(spark, sf_dir):
    rows = mask_columns.packed_masks(_grids(spark, sf_dir)).withColumnRenamed("counts", "before")
    return mask_columns.unpacked_masks(rows).select("track", F.lower(F.hex("packed")).alias("packed"), (F.col("counts") == F.col("before")).alias("same"))


@query(f"WITH {_CELLS_SQL} SELECT track, [min(x), min(y), max(x) + 1, max(y) + 1]::BIGINT[] AS corners FROM ce GROUP BY 1")
def mask_corners(spark, sf_dir):
    return _grids(spark, sf_dir).select("track", M.rle_corners(F.col("counts"), HEIGHT).alias("corners"))


class _Plain:
    """Images of the grid's size."""

    def decode(self, content):
        return np.zeros((HEIGHT, WIDTH, 3), np.uint8)


@query(f"""WITH {_CELLS_SQL}, b AS (SELECT track, min(x) AS x, min(y) AS y, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h FROM ce GROUP BY 1), k AS (SELECT *, (greatest(w, h) * 0.18::DOUBLE)::DOUBLE AS p FROM b), q AS (SELECT *, floor(p)::BIGINT AS k FROM k)
SELECT track, greatest(1, round_even(greatest(w, h) * 1.3::DOUBLE, 0))::BIGINT AS side, least({HEIGHT}, y + h + k) - greatest(0, y - k) AS high, least({WIDTH}, x + w + k) - greatest(0, x - k) AS wide FROM q""")
def crop_sizes(spark, sf_dir):
    rows = _grids(spark, sf_dir).withColumn("content", F.lit(b"x"))
    square = mask_columns.crops(rows, _Plain()).select("track", F.col("crop_height").cast("long").alias("side"))
    padded = mask_columns.crops(rows, _Plain(), square=False).select("track", F.col("crop_height").cast("long").alias("high"), F.col("crop_width").cast("long").alias("wide"))
    return square.join(padded, "track")


@query("SELECT user_id AS track, round(quantile_cont(value, 0.02), 6) AS low, round(quantile_cont(value, 0.98), 6) AS high FROM events WHERE value < 400 GROUP BY 1")
def depth_bounds(spark, sf_dir):
    v = F.col("value")
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("track")).agg(F.collect_list(F.when(v < 400, v).otherwise(float("nan"))).alias("raw"))
    out = mask_columns.by_row(rows, ["raw"], "low double, high double", lambda raw: kernels.normalised_depth(np.array(raw), None)[1:])
    some = table(spark, sf_dir, "events").where("value < 400").select(F.col("user_id").alias("track")).distinct()
    return out.join(some, "track", "left_semi").select("track", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("""WITH p AS (SELECT n_nationkey AS track, y, x, (n_nationkey * 7 + y * 13 + x * 29) % 64 + 192 AS r, (n_nationkey * 7 + y * 13 + x * 29 + 41) % 64 + 192 AS g, (n_nationkey * 7 + y * 13 + x * 29 + 82) % 64 + 192 AS b FROM nation, range(0, 6) a(y), range(0, 8) c(x))
SELECT track, round(avg(((track + y + x) % 9 = 0)::INT), 9) AS invalid_fraction, round(avg((greatest(r, g, b) >= 252 AND (r + g + b) / 3.0::DOUBLE >= 210)::INT), 9) AS glare_fraction FROM p GROUP BY 1""")
def frame_fractions(spark, sf_dir):
    y, x = np.mgrid[:6, :8]

    def measure(track):
        base = track * 7 + y * 13 + x * 29
        image = np.stack([(base + 41 * c) % 64 + 192 for c in range(3)], -1).astype(np.uint8)
        s = kernels.frame_statistics(image, np.where((track + y + x) % 9 == 0, np.nan, 1.0))
        return s["invalid_fraction"], s["glare_fraction"]

    out = mask_columns.by_row(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("track")), ["track"], "invalid_fraction double, glare_fraction double", measure)
    return out.select("track", F.round("invalid_fraction", 9).alias("invalid_fraction"), F.round("glare_fraction", 9).alias("glare_fraction"))


@query("""SELECT o_orderkey AS frame_index, '[{"object_id":' || o_custkey || ',"label":"' || o_orderstatus || '","box":null}]' AS objects_json, '{"left":{"n":' || (o_custkey % 5) || '}}' AS hands_json, CASE WHEN o_custkey % 3 = 0 THEN '{}' ELSE '{"status":"' || o_orderpriority || '"}' END AS depth_metadata_json FROM orders""")
def json_columns(spark, sf_dir):
    one = F.struct(F.col("o_custkey").alias("object_id"), F.col("o_orderstatus").alias("label"), F.lit(None).cast("int").alias("box"))
    depth_of = F.when(F.col("o_custkey") % 3 != 0, F.struct(F.col("o_orderpriority").alias("status")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_index"), F.array(one).alias("objects"), F.create_map(F.lit("left"), F.struct((F.col("o_custkey") % 5).alias("n"))).alias("hands"), depth_of.alias("depth"))
    return exports.as_json(rows)


@query("SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def stored_tables(spark, sf_dir):
    """A table read with a schema, and one that isn't there."""
    here = tables.read_table(spark, f"{sf_dir}/region.parquet", spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name").schema)
    gone = tables.read_table(spark, f"{sf_dir}/nowhere.parquet", here.schema)
    return here.unionByName(gone).select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name")
