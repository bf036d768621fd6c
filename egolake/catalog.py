"""Queries over the test tables for the operators of the engine, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .adapters import BOXES_SQL, USER_FRAMES_SQL, boxes, iou_sql, seconds, table, user_frames
from .functions import geometry as G
from .functions import masks as M
from .functions import values as V
from .operators import depth, folds, hands, quality, scoring, selection, sequence, tracks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
T = ["track"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# quality -------------------------------------------------------------------


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, od, li = (table(spark, sf_dir, t) for t in ("events", "orders", "lineitem"))
    status = lambda ok: F.when(ok, "accepted").otherwise("rejected").alias("status")
    return quality.stage_rows({
        "objects": ev.select(F.col("event_id").alias("frame_index"), status(F.col("value") >= 100)),
        "hands": od.select(F.col("o_orderkey").alias("frame_index"), status(F.col("o_totalprice") >= 150000)),
        "depth": li.select(F.col("l_orderkey").alias("frame_index"), status(F.col("l_discount") < 0.05)),
        "missing": None,
    })


@query("""SELECT 'objects' AS stage, CASE WHEN value >= 100 THEN 'accepted' ELSE 'rejected' END AS status, count(*) AS frames FROM events GROUP BY ALL
UNION ALL SELECT 'hands', CASE WHEN o_totalprice >= 150000 THEN 'accepted' ELSE 'rejected' END, count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'depth', CASE WHEN l_discount < 0.05::DOUBLE THEN 'accepted' ELSE 'rejected' END, count(*) FROM lineitem GROUP BY ALL""")
def quality_status_counts(spark, sf_dir):
    return quality.status_counts(_stages(spark, sf_dir))


@query(f"""WITH {USER_FRAMES_SQL}, r AS (SELECT track, frame_index, CASE WHEN value < 30 THEN ['low', event_type] ELSE [event_type] END AS reasons,
 frame_index - row_number() OVER (PARTITION BY track ORDER BY frame_index) AS g FROM uf WHERE value < 100)
SELECT track, min(frame_index) AS start_frame, max(frame_index) AS end_frame, list_sort(list_distinct(flatten(list(reasons)))) AS reasons FROM r GROUP BY track, g""")
def quarantine_intervals(spark, sf_dir):
    rows = user_frames(spark, sf_dir)
    reasons = F.when(F.col("value") < 30, F.array(F.lit("low"), "event_type")).otherwise(F.array("event_type"))
    status = F.when(F.col("value") < 100, "rejected").otherwise("accepted")
    return quality.quarantined(rows.select("track", "frame_index", reasons.alias("reasons"), status.alias("status")), T)


@query(f"""WITH {USER_FRAMES_SQL} SELECT 'objects' AS stage, track, frame_index, timestamp_s, value / 500 AS confidence FROM uf WHERE value >= 100
UNION ALL SELECT 'depth', track, frame_index, timestamp_s, 1 - value / 500 FROM uf WHERE frame_index % 3 = 0""")
def quality_with_timestamps(spark, sf_dir):
    frames = user_frames(spark, sf_dir)
    objects = frames.where("value >= 100").select("track", "frame_index", (F.col("value") / 500).alias("confidence"))
    every = sequence.keyframes(frames, 3).select("track", "frame_index", (1 - F.col("value") / 500).alias("confidence"))
    rows = quality.stage_rows({"objects": objects, "depth": every})
    return quality.with_timestamps(rows, frames, T).select("stage", "track", "frame_index", "timestamp_s", "confidence")


# exports -------------------------------------------------------------------


@query("""WITH o AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
h AS (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey AS frame_index, coalesce(o.n, 0) AS objects, round(coalesce(o.q, 0), 6) AS total, coalesce(h.n, 0) AS hands,
 CASE WHEN o_orderkey % 3 = 0 THEN 'depth/frames/' || lpad(o_orderkey::VARCHAR, 8, '0') || '.npz' END AS depth_frame
FROM orders LEFT JOIN o ON o.l_orderkey = o_orderkey LEFT JOIN h ON h.l_orderkey = o_orderkey""")
def frame_payload(spark, sf_dir):
    from .sources.exports import frame_payloads

    li = table(spark, sf_dir, "lineitem")
    frames = table(spark, sf_dir, "orders").select(F.lit(0).alias("episode"), F.col("o_orderkey").alias("frame_index"), seconds("o_orderdate").alias("timestamp_s"))
    objects = li.select(F.lit(0).alias("episode"), F.col("l_orderkey").alias("frame_index"), F.col("l_linenumber").cast("long").alias("object_id"), F.col("l_quantity").alias("area"))
    sides = li.where("l_linestatus = 'F'").select(F.lit(0).alias("episode"), F.col("l_orderkey").alias("frame_index"), F.col("l_returnflag").alias("handedness"), F.col("l_tax").alias("confidence"))
    deep = frames.where("frame_index % 3 = 0").select("episode", "frame_index", F.lit(1.0).alias("confidence"))
    out = frame_payloads(frames, objects, sides, deep)
    total = F.aggregate("objects", F.lit(0.0), lambda s, x: s + x["area"])
    return out.select("frame_index", F.size("objects").cast("long").alias("objects"), F.round(total, 6).alias("total"), F.size("hands").cast("long").alias("hands"), "depth_frame")


@query(f"""WITH {BOXES_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY frame_index, ordinal)::BIGINT AS id FROM bx)
SELECT t.part AS episode, t.id, t.frame_index + 1 AS image_id, t.supplier AS category_id, t.quantity AS area FROM t WHERE t.quantity > 25""")
def coco_annotations(spark, sf_dir):
    from .sources.exports import coco_annotations as annotations

    rows = boxes(spark, sf_dir).select(F.col("part").alias("episode"), "frame_index", "ordinal", F.col("supplier").alias("object_id"), F.col("quantity").alias("mask_area_px"))
    masks = rows.where("mask_area_px > 25").select("episode", "frame_index", "ordinal", F.array(F.lit(1)).alias("rle"))
    out = annotations(rows, masks, ["episode"], ["frame_index", "ordinal"], ["episode", "frame_index", "ordinal"])
    return out.select("episode", "id", "image_id", "category_id", F.col("mask_area_px").alias("area"))


@query("""SELECT c_nationkey AS episode, c_custkey % 7 AS object_id, arg_max(c_name, c_custkey) AS label FROM customer GROUP BY ALL""")
def coco_categories(spark, sf_dir):
    from .sources.exports import coco_categories as categories

    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("episode"), (F.col("c_custkey") % 7).alias("object_id"), F.col("c_name").alias("label"), F.col("c_custkey").alias("ordinal"))
    return categories(rows, ["episode"], "ordinal")


@query(f"""WITH {USER_FRAMES_SQL}, d AS (SELECT *, lead(timestamp_s) OVER w - timestamp_s AS d FROM uf WINDOW w AS (PARTITION BY track ORDER BY frame_index))
SELECT track, frame_index, round(coalesce(d, lag(d) OVER (PARTITION BY track ORDER BY frame_index), 1 / 30.0::DOUBLE), 6) AS duration_s FROM d""")
def frame_durations(spark, sf_dir):
    return sequence.durations(user_frames(spark, sf_dir), T).select("track", "frame_index", F.round("duration_s", 6).alias("duration_s"))


@query(f"""WITH {USER_FRAMES_SQL} SELECT track, frame_index, frame_index = 0 AS is_first, frame_index = max(frame_index) OVER (PARTITION BY track) AS is_last, false AS is_terminal FROM uf""")
def rlds_steps(spark, sf_dir):
    return sequence.step_flags(user_frames(spark, sf_dir), T).select("track", "frame_index", "is_first", "is_last", "is_terminal")


@query(f"""WITH {USER_FRAMES_SQL}, d AS (SELECT track, timestamp_s - lag(timestamp_s) OVER (PARTITION BY track ORDER BY frame_index) AS d FROM uf)
SELECT track, round(coalesce(1 / median(d) FILTER (d > 0), 30), 9) AS fps FROM d GROUP BY track""")
def source_fps(spark, sf_dir):
    return sequence.source_fps(user_frames(spark, sf_dir), T).select("track", F.round("fps", 9).alias("fps"))


# sampling and ranges -------------------------------------------------------


@query(f"WITH {USER_FRAMES_SQL} SELECT track, frame_index FROM uf WHERE frame_index % 9 = 0")
def keyframe_sample(spark, sf_dir):
    return sequence.keyframes(user_frames(spark, sf_dir), 9).select("track", "frame_index")


@query("""WITH c AS (SELECT user_id AS track, count(*) AS n FROM events GROUP BY 1), i AS (SELECT track, n, unnest(range(0, 5)) AS i FROM c)
SELECT DISTINCT track, round_even(i * (n - 1) / 4.0::DOUBLE, 0)::BIGINT AS frame_index FROM i""")
def probe_frames(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("track")).agg(F.count("*").alias("n"))
    return counts.select("track", F.explode(sequence.sample_frames(F.col("n"), 5)).alias("frame_index"))


@query("""WITH c AS (SELECT user_id AS track, count(*) AS n FROM events GROUP BY 1), s AS (SELECT track, n, unnest(range(0, n, 14)) AS s FROM c)
SELECT track, s::BIGINT AS start_frame, least(s + 18, n)::BIGINT AS end_frame FROM s WHERE s = 0 OR s - 14 + 18 < n""")
def chunk_ranges(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("track")).agg(F.count("*").alias("n"))
    return counts.select("track", F.explode(sequence.chunk_ranges(F.col("n"), 18, 4)).alias("r")).select("track", F.col("r.start").alias("start_frame"), F.col("r.end").alias("end_frame"))


@query("SELECT o_orderkey AS interval, unnest(range(o_orderkey % 11, o_orderkey % 11 + o_custkey % 5 + 1))::BIGINT AS frame_index FROM orders")
def interval_frames(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("interval"), (F.col("o_orderkey") % 11).alias("start_frame"), (F.col("o_orderkey") % 11 + F.col("o_custkey") % 5).alias("end_frame"))
    return sequence.expanded(rows).select("interval", "frame_index")


# boxes and masks -----------------------------------------------------------


@query(f"""WITH {BOXES_SQL}, c AS (SELECT frame_index, ordinal, greatest(0, least(x0, 79))::DOUBLE AS x0, greatest(0, least(y0, 44))::DOUBLE AS y0, greatest(1, least(x1, 80))::DOUBLE AS x1, greatest(1, least(y1, 45))::DOUBLE AS y1 FROM bx)
SELECT * FROM c WHERE x1 - x0 > 3 AND y1 - y0 > 3""")
def clamp_boxes(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", G.clamp_box(F.col("box_xyxy"), 80, 45).alias("b"))
    rows = rows.where(G.large_enough(F.col("b")))
    return rows.select("frame_index", "ordinal", *(F.col("b")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


@query(f"""WITH {BOXES_SQL} SELECT a.frame_index, a.ordinal AS i, b.ordinal AS j, round({iou_sql("a", "b")}, 9) AS iou FROM bx a JOIN bx b ON a.frame_index = b.frame_index AND a.ordinal < b.ordinal""")
def box_iou_pairs(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", "box_xyxy")
    both = rows.alias("a").join(rows.alias("b"), (F.col("a.frame_index") == F.col("b.frame_index")) & (F.col("a.ordinal") < F.col("b.ordinal")))
    return both.select("a.frame_index", F.col("a.ordinal").alias("i"), F.col("b.ordinal").alias("j"), F.round(G.box_iou(F.col("a.box_xyxy"), F.col("b.box_xyxy")), 9).alias("iou"))


@query(f"""WITH {BOXES_SQL}, g AS (SELECT *, quantity * 40 / (200 * 100.0::DOUBLE) AS part_of, greatest(x1 - x0, 1) AS w, greatest(y1 - y0, 1) AS h FROM bx)
SELECT frame_index, ordinal, part_of > 0.0004::DOUBLE AND part_of <= 0.4::DOUBLE AND greatest(w / h, h / w) <= 6 AND (x0 <= 1)::INT + (y0 <= 1)::INT + (x1 >= 199)::INT + (y1 >= 99)::INT < 3 AS passes FROM g""")
def mask_geometry_gate(spark, sf_dir):
    return boxes(spark, sf_dir).select("frame_index", "ordinal", G.mask_gate(F.col("quantity") * 40, F.col("box_xyxy"), 200, 100).alias("passes"))


@query("""SELECT l_orderkey AS row, l_linenumber AS line, l_partkey AS p, l_suppkey AS s, round(1536 * (l_quantity - 25) / greatest(l_tax, 1e-4::DOUBLE) + 960, 6) AS u, round(1536 * (l_discount - 0.05::DOUBLE) / greatest(l_tax, 1e-4::DOUBLE) + 540, 6) AS v FROM lineitem""")
def pinhole_projection(spark, sf_dir):
    point = F.array(F.col("l_quantity") - 25, F.col("l_discount") - 0.05, F.col("l_tax"))
    p = G.project(point, F.lit(1536.0), 1920, 1080)
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.round(p[0], 6).alias("u"), F.round(p[1], 6).alias("v"))


_RUNS_SQL = """runs AS (SELECT l_orderkey AS mask, list(l_quantity::INT ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS counts FROM lineitem GROUP BY 1)"""


def _runs(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("mask"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("n"))))
    return rows.agg(F.transform(ordered, lambda x: x["n"]).alias("counts"))


@query(f"WITH {_RUNS_SQL} SELECT mask, coalesce(list_sum(list_filter(counts, lambda c, i: i % 2 = 0)), 0)::BIGINT AS area FROM runs")
def rle_area(spark, sf_dir):
    return _runs(spark, sf_dir).select("mask", M.rle_area(F.col("counts")).alias("area"))


@query(f"WITH {_RUNS_SQL} SELECT mask, array_to_string(flatten(list_transform(counts, lambda c, i: list_transform(range(c), lambda z: (i + 1) % 2))), '') AS pixels FROM runs")
def rle_decode(spark, sf_dir):
    return _runs(spark, sf_dir).select("mask", F.array_join(M.rle_decode(F.col("counts")).cast("array<string>"), "").alias("pixels"))


@query(f"WITH {_RUNS_SQL} SELECT mask, counts FROM runs")
def rle_encode(spark, sf_dir):
    """Encoding what was decoded gives the runs back."""
    return _runs(spark, sf_dir).select("mask", M.rle_encode(M.rle_decode(F.col("counts"))).alias("counts"))


# selection -----------------------------------------------------------------

_BEST_SQL = f"""WITH {BOXES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY frame_index ORDER BY detector_score * sam2_mask_score DESC, ordinal) AS r FROM bx)"""


@query(f"{_BEST_SQL} SELECT frame_index, ordinal, label FROM r WHERE r = 1")
def best_item_per_frame(spark, sf_dir):
    return selection.best_per_group(boxes(spark, sf_dir), ["frame_index"], selection.quality(), ["ordinal"]).select("frame_index", "ordinal", "label")


@query(f"{_BEST_SQL} SELECT frame_index, ordinal FROM r WHERE r <= 2")
def topk_per_frame(spark, sf_dir):
    return selection.top_k(boxes(spark, sf_dir), ["frame_index"], selection.quality(), ["ordinal"], 2).select("frame_index", "ordinal")


@query(f"""WITH {BOXES_SQL}, r AS (SELECT *, quantity / 5000 AS area_fraction, row_number() OVER (PARTITION BY frame_index ORDER BY part % 31 DESC, ordinal) AS r FROM bx WHERE quantity / 5000 >= 0.0008::DOUBLE)
SELECT frame_index, ordinal FROM r WHERE r <= 3""")
def label_candidates(spark, sf_dir):
    rows = boxes(spark, sf_dir).withColumn("area_fraction", F.col("quantity") / 5000)
    return scoring.label_candidates(rows, [], F.col("part") % 31, ["ordinal"], 3).select("frame_index", "ordinal")


@query(f"""WITH {BOXES_SQL}, b AS (SELECT *, detector_score * sam2_mask_score AS q, row_number() OVER (PARTITION BY supplier, label, frame_index ORDER BY detector_score * sam2_mask_score DESC, ordinal) AS r FROM bx),
f AS (SELECT *, median(q) OVER (PARTITION BY supplier, label) AS score, row_number() OVER (PARTITION BY supplier, label ORDER BY q DESC, frame_index) AS k FROM b WHERE r = 1)
SELECT supplier, label, frame_index, ordinal, k = 1 AS representative, round(score, 9) AS score FROM f""")
def object_prompt_anchors(spark, sf_dir):
    out = scoring.object_prompt_anchors(boxes(spark, sf_dir), ["supplier", "label"], ["ordinal"])
    return out.select("supplier", "label", "frame_index", "ordinal", "representative", F.round("score", 9).alias("score"))


_CLUSTER_SQL = """0.45::DOUBLE * count(DISTINCT frame_index) / 40.0::DOUBLE + 0.25::DOUBLE / (1 + stddev_pop(area_fraction) / greatest(avg(area_fraction), 1e-6::DOUBLE))
 + 0.20::DOUBLE / (1 + stddev_pop(aspect_ratio) / greatest(avg(aspect_ratio), 1e-6::DOUBLE)) + 0.10::DOUBLE * median(detector_score)"""
_SHAPES_SQL = f"""{BOXES_SQL}, sh AS (SELECT *, quantity / 100 AS area_fraction, greatest(greatest(x1 - x0, 1) / greatest(y1 - y0, 1), greatest(y1 - y0, 1) / greatest(x1 - x0, 1)) AS aspect_ratio, (part % 31)::DOUBLE AS logit FROM bx)"""


def _shapes(spark, sf_dir):
    rows = boxes(spark, sf_dir)
    return rows.withColumn("area_fraction", F.col("quantity") / 100).withColumn("aspect_ratio", G.aspect_ratio(F.col("box_xyxy"))).withColumn("logit", (F.col("part") % 31).cast("double"))


@query(f"WITH {_SHAPES_SQL} SELECT part, round({_CLUSTER_SQL}, 6) AS score, count(DISTINCT frame_index) AS keyframe_hits, count(*) AS cluster_size FROM sh GROUP BY part")
def cluster_score(spark, sf_dir):
    out = scoring.cluster_scores(_shapes(spark, sf_dir), ["part"], 40)
    return out.withColumn("score", F.round("score", 6))


@query(f"""WITH {_SHAPES_SQL}, b AS (SELECT label, min(logit) AS lo, max(logit) AS hi FROM sh GROUP BY 1),
n AS (SELECT sh.*, least(greatest((logit - lo) / greatest(hi - lo, 1e-6::DOUBLE), 0), 1) AS z FROM sh JOIN b ON sh.label = b.label)
SELECT label, supplier, round(0.5::DOUBLE * quantile_cont(z, 0.8) + 0.25::DOUBLE * median(z) + 0.25::DOUBLE * ({_CLUSTER_SQL}), 6) AS score FROM n GROUP BY label, supplier""")
def label_cluster_score(spark, sf_dir):
    out = scoring.label_scores(_shapes(spark, sf_dir), ["label", "supplier"], 40, F.col("logit"), ["label"])
    return out.withColumn("score", F.round("score", 6))


_UNIT_SQL = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), un AS (SELECT vec_id, label, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-9::DOUBLE)) AS u FROM e)"""


@query(f"""WITH {_UNIT_SQL}, d AS (SELECT label, i, avg(v[i]) AS m FROM e, range(1, 65) r(i) GROUP BY 1, 2), c AS (SELECT label, list(m ORDER BY i) AS c FROM d GROUP BY 1),
s AS (SELECT un.label, vec_id, round(list_dot_product(u, list_transform(c, lambda x: x / greatest(sqrt(list_dot_product(c, c)), 1e-9::DOUBLE))), 9) AS similarity FROM un JOIN c ON un.label = c.label),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS r FROM s) SELECT label, vec_id, round(similarity, 6) AS similarity FROM r WHERE r = 1""")
def representative_embedding(spark, sf_dir):
    out = scoring.representatives(table(spark, sf_dir, "embeddings"), ["label"], "vec_id")
    return out.withColumn("similarity", F.round("similarity", 6))


_EDGES_SQL = f"""{_UNIT_SQL}, p AS (SELECT a.vec_id AS i, b.vec_id AS j, round(list_dot_product(a.u, b.u), 9) AS s FROM un a JOIN un b ON a.label <> b.label),
q AS (SELECT i, j, s, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS r FROM p WHERE s > 0.25::DOUBLE), ed AS (SELECT i, j, s FROM q WHERE r = 1 AND i < j)"""


def _edges(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("episode", F.lit(0))
    return selection.similarity_edges(e, ["episode"], "vec_id", "label", "embedding", 0.25, decimals=9)


@query(f"WITH {_EDGES_SQL} SELECT i, j, round(s, 6) AS similarity FROM ed")
def similarity_best_pairs(spark, sf_dir):
    return _edges(spark, sf_dir).select("i", "j", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH RECURSIVE {_EDGES_SQL}, o AS (SELECT i, j, row_number() OVER (ORDER BY s DESC, i DESC, j DESC) AS n FROM ed),
g(n, used, i, j) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT UNION ALL
 SELECT o.n, CASE WHEN list_contains(g.used, o.i) OR list_contains(g.used, o.j) THEN g.used ELSE list_concat(g.used, [o.i, o.j]) END,
  CASE WHEN list_contains(g.used, o.i) OR list_contains(g.used, o.j) THEN NULL ELSE o.i END, o.j FROM g JOIN o ON o.n = g.n + 1)
SELECT v.vec_id, coalesce(m.i, v.vec_id) AS cluster FROM embeddings v LEFT JOIN (SELECT i, i AS x FROM g WHERE i IS NOT NULL UNION ALL SELECT i, j FROM g WHERE i IS NOT NULL) m ON m.x = v.vec_id""")
def greedy_pairs(spark, sf_dir):
    pairs = selection.greedy_matching(_edges(spark, sf_dir), ["episode"], "i", "j", "similarity", same_side=True)
    nodes = table(spark, sf_dir, "embeddings").select(F.lit(0).alias("episode"), "vec_id")
    return selection.pair_groups(nodes, ["episode"], "vec_id", pairs).select("vec_id", "cluster")


def _suppression_sql(order: str, threshold: float) -> str:
    """Greedy suppression by a recursion over the boxes of a frame, in order."""
    return f"""WITH RECURSIVE {BOXES_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY frame_index ORDER BY {order}) AS n FROM bx),
g(frame_index, n, kept, ordinal, ok) AS (SELECT frame_index, n, [ordinal], ordinal, true FROM o WHERE n = 1 UNION ALL
 SELECT o.frame_index, o.n, CASE WHEN x.bad THEN g.kept ELSE list_append(g.kept, o.ordinal) END, o.ordinal, NOT x.bad FROM g JOIN o ON o.frame_index = g.frame_index AND o.n = g.n + 1,
 LATERAL (SELECT coalesce(bool_or({iou_sql("k", "o")} > {threshold}::DOUBLE), false) AS bad FROM o k WHERE k.frame_index = o.frame_index AND list_contains(g.kept, k.ordinal)) x)
SELECT frame_index, ordinal FROM g WHERE ok"""


@query(_suppression_sql("detector_score DESC, ordinal", 0.30))
def greedy_nms(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", "box_xyxy", "detector_score")
    return selection.suppress_overlaps(rows, ["frame_index"], ["detector_score", "ordinal"], [True, False], 0.30).select("frame_index", "ordinal")


@query(_suppression_sql("ordinal", 0.20))
def dedup_boxes(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("frame_index", "ordinal", "box_xyxy")
    return selection.suppress_overlaps(rows, ["frame_index"], ["ordinal"], [False], 0.20).select("frame_index", "ordinal")


@query("""WITH RECURSIVE s AS (SELECT c_nationkey AS object_id, label_index, label, round(avg(c_acctbal) / 10000, 9) AS score FROM (SELECT *, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS label_index, c_mktsegment AS label FROM customer) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (ORDER BY score DESC, object_id DESC, label_index DESC) AS n FROM s WHERE score >= 0.36::DOUBLE),
g(n, a, b, object_id, label, score) AS (SELECT 0::BIGINT, []::INT[], []::BIGINT[], NULL::INT, NULL::VARCHAR, NULL::DOUBLE UNION ALL
 SELECT o.n, CASE WHEN u.no THEN g.a ELSE list_append(g.a, o.object_id) END, CASE WHEN u.no THEN g.b ELSE list_append(g.b, o.label_index) END, CASE WHEN u.no THEN NULL ELSE o.object_id END, o.label, o.score
 FROM g JOIN o ON o.n = g.n + 1, LATERAL (SELECT list_contains(g.a, o.object_id) OR list_contains(g.b, o.label_index) AS no) u)
SELECT t.object_id, coalesce(g.label, 'unknown object ' || t.object_id) AS label, g.label IS NOT NULL AS accepted, coalesce(g.score, t.top) AS clip_score
FROM (SELECT object_id, max(score) AS top FROM s GROUP BY 1) t LEFT JOIN g ON g.object_id = t.object_id""")
def label_assignment(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    every = c.agg(F.array_sort(F.collect_set("c_mktsegment")).alias("all"))  # the labels of a job, one row
    scores = c.groupBy(F.col("c_nationkey").alias("object_id"), "c_mktsegment").agg(F.round(F.avg("c_acctbal") / 10000, 9).alias("score"))
    scores = scores.crossJoin(F.broadcast(every)).select(F.lit(0).alias("episode"), "object_id", (F.array_position("all", F.col("c_mktsegment")) - 1).alias("label_index"), F.col("c_mktsegment").alias("label"), "score")
    return selection.assign_labels(scores, ["episode"]).drop("episode")


# sequences -----------------------------------------------------------------


@query(f"""WITH {USER_FRAMES_SQL}, s AS (SELECT track, frame_index, sum((value >= 60)::INT) OVER w AS s FROM uf WINDOW w AS (PARTITION BY track ORDER BY frame_index ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT track, min(frame_index - 4) FILTER (s = 5) AS start FROM s GROUP BY track""")
def sustained_run(spark, sf_dir):
    return sequence.first_sustained(user_frames(spark, sf_dir), T, F.col("value") >= 60, 5)


@query(f"""WITH {USER_FRAMES_SQL}, g AS (SELECT *, CASE WHEN value >= 80 THEN frame_index END AS ok FROM uf),
h AS (SELECT *, max(ok) OVER (PARTITION BY track ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, min(ok) OVER (PARTITION BY track ORDER BY frame_index ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM g)
SELECT h.track, h.frame_index, coalesce(h.ok IS NULL AND h.r - h.l - 1 <= 5, false) AS inferred,
 round(CASE WHEN coalesce(h.ok IS NULL AND h.r - h.l - 1 <= 5, false) THEN (1 - (h.frame_index - h.l) / (h.r - h.l)::DOUBLE) * a.value + (h.frame_index - h.l) / (h.r - h.l)::DOUBLE * b.value ELSE h.value END, 6) AS value
FROM h LEFT JOIN uf a ON a.track = h.track AND a.frame_index = h.l LEFT JOIN uf b ON b.track = h.track AND b.frame_index = h.r""")
def gap_interpolation(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", "frame_index", F.col("value").alias("v"), F.array("value").alias("value"))
    out = sequence.interpolated(rows, T, "value", F.col("v") >= 80)
    return out.select("track", "frame_index", "inferred", F.round(F.col("value")[0], 6).alias("value"))


@query(f"""WITH {USER_FRAMES_SQL}, a AS (SELECT track, frame_index, value >= 60 AS act, value / 500 AS confidence, frame_index - row_number() OVER (PARTITION BY track, value >= 60 ORDER BY frame_index) AS g FROM uf),
r AS (SELECT *, count(*) OVER w AS n, max(confidence) OVER w AS top FROM a WINDOW w AS (PARTITION BY track, act, g))
SELECT track, frame_index, CASE WHEN NOT act OR (n < 4 AND top < 0.6::DOUBLE) THEN 'rejected' ELSE 'observed' END AS state, CASE WHEN act AND n < 4 AND top < 0.6::DOUBLE THEN 0 ELSE confidence END AS confidence FROM r""")
def short_run_suppression(spark, sf_dir):
    state = F.when(F.col("value") >= 60, "observed").otherwise("rejected")
    rows = user_frames(spark, sf_dir).select("track", "frame_index", state.alias("state"), (F.col("value") / 500).alias("confidence"))
    return sequence.suppress_short_runs(rows, T, 4, 0.6)


def _slope_sql(value: str, source: str) -> str:
    return f"""CASE WHEN pt IS NOT NULL AND nt IS NOT NULL THEN ((t - pt) * (t - pt) * nv + ((nt - t) * (nt - t) - (t - pt) * (t - pt)) * {value} - (nt - t) * (nt - t) * pv) / ((t - pt) * (nt - t) * (nt - pt))
 WHEN nt IS NOT NULL THEN (nv - {value}) / (nt - t) WHEN pt IS NOT NULL THEN ({value} - pv) / (t - pt) END"""


@query(f"""WITH {USER_FRAMES_SQL}, a AS (SELECT track, frame_index, timestamp_s / 3600 AS t, value AS v, frame_index - row_number() OVER (PARTITION BY track, value >= 40 ORDER BY frame_index) AS g FROM uf WHERE value >= 40),
b AS (SELECT *, lag(t) OVER w AS pt, lead(t) OVER w AS nt, lag(v) OVER w AS pv, lead(v) OVER w AS nv FROM a WINDOW w AS (PARTITION BY track, g ORDER BY frame_index)),
c AS (SELECT track, frame_index, g, t, {_slope_sql("v", "b")} AS vel FROM b),
d AS (SELECT *, lag(t) OVER w AS pt, lead(t) OVER w AS nt, lag(vel) OVER w AS pv, lead(vel) OVER w AS nv FROM c WHERE vel IS NOT NULL WINDOW w AS (PARTITION BY track, g ORDER BY frame_index)),
f AS (SELECT track, frame_index, vel, {_slope_sql("vel", "d")} AS acc FROM d)
SELECT uf.track, uf.frame_index, round(f.vel, 4) + 0 AS velocity, round(f.acc, 2) + 0 AS acceleration FROM uf LEFT JOIN f ON f.track = uf.track AND f.frame_index = uf.frame_index""")
def velocity_acceleration(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", "frame_index", (F.col("timestamp_s") / 3600).alias("t"), F.col("value").alias("v"), F.array("value").alias("xyz"))
    out = sequence.derivatives(rows, T, "xyz", "t", F.col("v") >= 40)
    return out.select("track", "frame_index", F.round(F.col("velocity")[0], 4).alias("velocity"), F.round(F.col("acceleration")[0], 2).alias("acceleration"))


_TAPS = (-21, 14, 39, 54, 59, 54, 39, 14, -21)
_TAPS_SQL = " + ".join(f"{c} * lag(value, {-i}) OVER w" if i < 0 else f"{c} * lead(value, {i}) OVER w" if i else f"{c} * value" for c, i in zip(_TAPS, range(-4, 5), strict=True))


@query(f"""WITH {USER_FRAMES_SQL}, s AS (SELECT track, frame_index, ({_TAPS_SQL}) / 231 AS v FROM uf WINDOW w AS (PARTITION BY track ORDER BY frame_index)) SELECT track, frame_index, round(v, 6) AS value FROM s WHERE v IS NOT NULL""")
def savgol_interior(spark, sf_dir):
    """Smoothed values four or more frames from either end."""
    rows = user_frames(spark, sf_dir).select("track", "frame_index", F.array("value").alias("value"))
    n = F.count("*").over(Window.partitionBy("track"))
    out = sequence.smoothed(rows, T, "value", F.lit(True)).withColumn("_n", n)
    return out.where("frame_index >= 4 and frame_index < _n - 4").select("track", "frame_index", F.round(F.col("value")[0], 6).alias("value"))


def _savgol_sql() -> str:
    """Fits of every run of rows with a value of 40 or more: the window's place is held inside the run."""
    taps = {n: sequence.savgol_taps(n, 2) for n in (5, 7, 9)}
    case = " ".join(f"WHEN {n} THEN [{', '.join('[' + ', '.join(f'{v!r}::DOUBLE' for v in row.tolist()) + ']' for row in taps[n])}]" for n in taps)
    return f"""WITH {USER_FRAMES_SQL}, a AS (SELECT track, frame_index, value, value >= 40 AS ok FROM uf), b AS (SELECT *, sum((ok AND NOT coalesce(p, false))::INT) OVER (PARTITION BY track ORDER BY frame_index) AS run FROM (SELECT *, lag(ok) OVER (PARTITION BY track ORDER BY frame_index) AS p FROM a)),
g AS (SELECT track, run, list(value ORDER BY frame_index) AS v, min(frame_index) AS f0, count(*) AS n FROM b WHERE ok GROUP BY ALL HAVING count(*) >= 5),
h AS (SELECT track, v, f0, n, least(9, n - (n + 1) % 2)::INT AS w FROM g), i AS (SELECT *, unnest(range(0, n)) AS p FROM h), j AS (SELECT *, least(greatest(p - w // 2, 0), n - w) AS s, CASE w {case} END AS taps FROM i),
k AS (SELECT track, f0 + p AS frame_index, list_sum(list_transform(range(1, w + 1), lambda x: taps[(p - s + 1)::INT][x] * v[(s + x)::INT])) AS m FROM j)
SELECT a.track, a.frame_index, round(coalesce(k.m, a.value), 6) AS value FROM a LEFT JOIN k ON k.track = a.track AND k.frame_index = a.frame_index"""


@query(_savgol_sql())
def savgol_smoothing(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", "frame_index", F.col("value").alias("v"), F.array("value").alias("value"))
    return sequence.smoothed(rows, T, "value", F.col("v") >= 40).select("track", "frame_index", F.round(F.col("value")[0], 6).alias("value"))


@query(f"""WITH {USER_FRAMES_SQL} SELECT track, frame_index, last_value(CASE WHEN value >= 150 THEN value END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_index ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS previous FROM uf""")
def asof_lookback(spark, sf_dir):
    rows = user_frames(spark, sf_dir)
    return sequence.lookback(rows, T, F.when(F.col("value") >= 150, F.col("value")), "previous").select("track", "frame_index", "previous")


# folds ---------------------------------------------------------------------


@query(f"""WITH RECURSIVE {USER_FRAMES_SQL}, u AS (SELECT track, frame_index, floor(timestamp_s / 30000) AS t FROM uf), d AS (SELECT track, t - lag(t) OVER (PARTITION BY track ORDER BY frame_index) AS d FROM u),
m AS (SELECT track, coalesce(median(d) FILTER (d > 0), 1 / 30.0::DOUBLE) AS step FROM d GROUP BY 1),
r(track, frame_index, time) AS (SELECT track, frame_index, t::DOUBLE FROM u WHERE frame_index = 0 UNION ALL
 SELECT u.track, u.frame_index, CASE WHEN u.t > r.time THEN u.t ELSE r.time + m.step END FROM r JOIN u ON u.track = r.track AND u.frame_index = r.frame_index + 1 JOIN m ON m.track = u.track)
SELECT track, frame_index, round(time, 6) AS time FROM r""")
def monotonic_time(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", "frame_index", F.floor(F.col("timestamp_s") / 30000).cast("double").alias("timestamp_s"))
    return folds.increasing_times(rows, T).select("track", "frame_index", F.round("time", 6).alias("time"))


@query(f"""WITH RECURSIVE {USER_FRAMES_SQL}, u AS (SELECT track, frame_index, value AS low, value + 10 AS high, value > 300 AS cut FROM uf),
r(track, frame_index, low, high) AS (SELECT track, frame_index, low, high FROM u WHERE frame_index = 0 UNION ALL
 SELECT u.track, u.frame_index, CASE WHEN cut THEN u.low ELSE 0.85::DOUBLE * r.low + 0.15::DOUBLE * u.low END, CASE WHEN cut THEN u.high ELSE 0.85::DOUBLE * r.high + 0.15::DOUBLE * u.high END FROM r JOIN u ON u.track = r.track AND u.frame_index = r.frame_index + 1)
SELECT track, frame_index, round(low, 6) AS normalization_low, round(high, 6) AS normalization_high FROM r""")
def ema_normalise(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", "frame_index", F.col("value").alias("low"), (F.col("value") + 10).alias("high"), (F.col("value") > 300).alias("reset"))
    return folds.smoothed_bounds(rows, T).select("track", "frame_index", F.round("normalization_low", 6).alias("normalization_low"), F.round("normalization_high", 6).alias("normalization_high"))


@query(f"""WITH RECURSIVE {USER_FRAMES_SQL}, u AS (SELECT track, frame_index, value AS area, (event_id % 100) / 100.0::DOUBLE AS score, event_id % 17 = 0 AS manual, event_id % 2 = 0 AS conf FROM uf),
r(track, frame_index, h, recent, low, frag, conf) AS (SELECT track, frame_index, CASE WHEN manual OR score >= CASE WHEN conf THEN 0.4::DOUBLE ELSE 0.5::DOUBLE END THEN [area] ELSE []::DOUBLE[] END, area, NOT manual AND score < CASE WHEN conf THEN 0.4::DOUBLE ELSE 0.5::DOUBLE END, false, conf FROM u WHERE frame_index = 0
 UNION ALL SELECT u.track, u.frame_index, CASE WHEN x.low OR x.frag THEN r.h ELSE list_append(r.h, u.area)[-5:] END, x.recent, x.low, x.frag, u.conf FROM r JOIN u ON u.track = r.track AND u.frame_index = r.frame_index + 1,
 LATERAL (SELECT coalesce(list_aggregate(r.h, 'median'), u.area) AS recent, NOT u.manual AND u.score < CASE WHEN u.conf THEN 0.4::DOUBLE ELSE 0.5::DOUBLE END AS low,
  len(r.h) > 0 AND NOT u.manual AND u.area < 0.15::DOUBLE * coalesce(list_aggregate(r.h, 'median'), u.area) AND u.score < 0.72::DOUBLE AS frag) x)
SELECT track, frame_index, round(recent, 6) AS recent_area, list_filter([CASE WHEN low THEN CASE WHEN conf THEN 'low_anchor_confidence' ELSE 'low_semantic_score' END END, CASE WHEN frag THEN 'fragment_area_collapse' END], lambda x: x IS NOT NULL) AS reasons, NOT low AND NOT frag AS accepted FROM r""")
def trusted_anchors(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select(
        "track", "frame_index", F.col("value").alias("area"), ((F.col("event_id") % 100) / 100).alias("score"), (F.col("event_id") % 17 == 0).alias("manual"), (F.col("event_id") % 2 == 0).alias("has_confidence")
    )
    out = folds.trusted_anchors(rows, T)
    return out.select("track", "frame_index", F.round("recent_area", 6).alias("recent_area"), "reasons", "accepted")


@query(f"""WITH RECURSIVE {BOXES_SQL}, t AS (SELECT frame_index % 50 AS track, frame_index // 50 AS f, ordinal, x0, y0, x1, y1, detector_score AS c FROM bx),
u AS (SELECT *, dense_rank() OVER (PARTITION BY track ORDER BY f) AS n FROM t),
r(track, n, f, ordinal, c, x0, y0, x1, y1) AS (SELECT track, n, f, ordinal, c, x0, y0, x1, y1 FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY c DESC, ordinal) AS k FROM u WHERE n = 1) WHERE k = 1
 UNION ALL SELECT track, n, f, ordinal, c, x0, y0, x1, y1 FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY score DESC, ordinal) AS k FROM (SELECT u.*, CASE WHEN u.f - r.f > 12 THEN u.c ELSE
  0.55::DOUBLE * u.c + 0.30::DOUBLE * coalesce(o / nullif((u.x1 - u.x0) * (u.y1 - u.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) - o, 0), 0) + 0.15::DOUBLE * greatest(0, 1 - sqrt(power((u.x0 + u.x1 - r.x0 - r.x1) / 2, 2) + power((u.y0 + u.y1 - r.y0 - r.y1) / 2, 2)) / 170.0::DOUBLE) END AS score
  FROM r JOIN u ON u.track = r.track AND u.n = r.n + 1, LATERAL (SELECT greatest(least(u.x1, r.x1) - greatest(u.x0, r.x0), 0) * greatest(least(u.y1, r.y1) - greatest(u.y0, r.y0), 0) AS o))) WHERE k = 1)
SELECT track, f AS frame_index, ordinal, round(c, 6) AS confidence FROM r""")
def temporal_selection(spark, sf_dir):
    rows = boxes(spark, sf_dir).select((F.col("frame_index") % 50).alias("track"), (F.col("frame_index") / 50).cast("long").alias("frame_index"), "ordinal", F.col("box_xyxy").alias("box"), F.col("detector_score").alias("confidence"))
    return folds.temporal_selection(rows, T, 150, 80).select("track", "frame_index", "ordinal", F.round("confidence", 6).alias("confidence"))


# tracks --------------------------------------------------------------------


def _directions(spark, sf_dir):
    rows = user_frames(spark, sf_dir)
    late = F.col("frame_index") > 20 + F.col("track") % 9
    return rows.select(
        "track", F.col("frame_index").alias("offset"), F.when(late & (F.col("track") % 5 != 0), 2.0).otherwise(F.col("value") + 20).alias("forward_area"), F.when(F.col("frame_index") >= 15, F.col("value") + 15).otherwise(1.0).alias("backward_area"),
        F.lit(100.0).alias("left_area"), F.lit(120.0).alias("right_area"), F.when(F.col("track") % 3 == 0, (F.col("frame_index") % 4) / 10).otherwise(0.5).alias("iou"), F.when(F.col("frame_index").between(24, 30), 3.0).otherwise((F.col("event_id") % 10) / 20).alias("motion"),
    )


@query(f"""WITH {USER_FRAMES_SQL}, d AS (SELECT track, frame_index AS o, CASE WHEN frame_index > 20 + track % 9 AND track % 5 <> 0 THEN 2 ELSE value + 20 END >= 10 AS f, CASE WHEN frame_index >= 15 THEN value + 15 ELSE 1 END >= 12 AS b,
 CASE WHEN track % 3 = 0 THEN (frame_index % 4) / 10.0::DOUBLE ELSE 0.5::DOUBLE END AS iou, CASE WHEN frame_index BETWEEN 24 AND 30 THEN 3 ELSE (event_id % 10) / 20.0::DOUBLE END AS m FROM uf),
md AS (SELECT track, median(m) AS mid FROM d WHERE m > 0 GROUP BY 1), lim AS (SELECT d.track, greatest(1.25::DOUBLE, any_value(mid) + 1.5::DOUBLE * median(abs(m - mid))) AS lim FROM d JOIN md ON d.track = md.track WHERE m > 0 GROUP BY 1),
x AS (SELECT d.track, o, b, f, sum((NOT f)::INT) OVER w5 AS c, sum((f AND b AND iou < 0.3::DOUBLE)::INT) OVER w3 AS g, sum((m >= lim)::INT) OVER w3 AS v, lim FROM d JOIN lim ON lim.track = d.track
 WINDOW w5 AS (PARTITION BY d.track ORDER BY o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), w3 AS (PARTITION BY d.track ORDER BY o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
y AS (SELECT track, max(o) AS last, min(o - 4) FILTER (c = 5) AS collapse, min(o - 2) FILTER (g = 3) AS dis, min(o - 2) FILTER (v = 3) AS mo, any_value(lim) AS lim FROM x GROUP BY 1),
z AS (SELECT *, greatest(collapse - 1, 0) AS old_end, least(last, mo + 24) AS cand FROM y WHERE collapse IS NOT NULL AND (dis IS NOT NULL OR mo IS NOT NULL)),
s AS (SELECT z.track, o, sum(b::INT) OVER (PARTITION BY z.track ORDER BY o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k FROM x JOIN z ON z.track = x.track AND x.o >= z.cand), st AS (SELECT track, min(o - 2) FILTER (k = 3) AS st FROM s GROUP BY 1)
SELECT z.track, old_end, CASE WHEN dis IS NOT NULL THEN old_end + 1 ELSE greatest(old_end + 1, coalesce(st, last - 60)) END AS new_start,
 CASE WHEN dis IS NOT NULL THEN 'directional_disagreement' WHEN st IS NOT NULL THEN 'post_motion_backward_stability' ELSE 'anchor_proximity_fallback' END AS split_reason, round(lim, 6) AS motion_threshold FROM z LEFT JOIN st ON st.track = z.track""")
def lifecycle_split(spark, sf_dir):
    out = tracks.lifecycle_splits(_directions(spark, sf_dir), T)
    return out.select("track", "old_end", "new_start", "split_reason", F.round("motion_threshold", 6).alias("motion_threshold"))


@query(f"""WITH {USER_FRAMES_SQL} SELECT track, frame_index AS start_frame, (1 + coalesce(sum((value > 200)::INT) OVER (PARTITION BY track ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS instance_id FROM uf""")
def instance_ids(spark, sf_dir):
    rows = user_frames(spark, sf_dir).select("track", F.col("frame_index").alias("start_frame"), "value")
    return tracks.instance_ids(rows, T, F.col("value") > 200).select("track", "start_frame", "instance_id")


@query(f"""WITH {BOXES_SQL}, t AS (SELECT part, supplier, arg_max(label, (frame_index, ordinal)) AS source, arg_max(CASE WHEN quantity > 20 THEN quantity END, (frame_index, ordinal)) FILTER (quantity > 20) AS mask FROM bx GROUP BY 1, 2) SELECT * FROM t""")
def write_precedence(spark, sf_dir):
    rows = boxes(spark, sf_dir).select("part", "supplier", F.struct("frame_index", "ordinal").alias("priority"), F.col("label").alias("source"), F.when(F.col("quantity") > 20, F.col("quantity")).alias("mask"))
    return tracks.last_write(rows, ["part", "supplier"], "priority", "mask")


@query(f"""WITH {USER_FRAMES_SQL}, f AS (SELECT track, frame_index, value AS a FROM uf WHERE frame_index % 3 <> 0), b AS (SELECT track, frame_index, value / 2 AS a FROM uf WHERE frame_index % 2 = 0)
SELECT coalesce(f.track, b.track) AS track, coalesce(f.frame_index, b.frame_index) AS frame_index, f.a AS forward_area, b.a AS backward_area,
 CASE WHEN greatest(coalesce(f.a, 0), coalesce(b.a, 0)) < 20 THEN 'cutie_incoherent' WHEN f.a IS NOT NULL AND b.a IS NOT NULL THEN 'cutie_bidirectional' WHEN f.a IS NOT NULL THEN 'cutie_forward_only' ELSE 'cutie_backward_only' END AS source
FROM f FULL JOIN b ON f.track = b.track AND f.frame_index = b.frame_index""")
def directional_fusion(spark, sf_dir):
    rows = user_frames(spark, sf_dir)
    fwd = rows.where("frame_index % 3 <> 0").select("track", "frame_index", F.col("value").alias("area"))
    bwd = rows.where("frame_index % 2 = 0").select("track", "frame_index", (F.col("value") / 2).alias("area"))
    out = tracks.joined_directions(fwd, bwd, ["track", "frame_index"])
    kept = F.greatest(F.coalesce("forward_area", F.lit(0.0)), F.coalesce("backward_area", F.lit(0.0))) >= 20
    return out.withColumn("source", tracks.fused_source(F.col("forward_area"), F.col("backward_area"), kept))


_DENSE_SQL = """fr AS (SELECT n_nationkey AS episode, unnest(range(0, 12)) AS frame_index FROM nation), ob AS (SELECT s_nationkey AS episode, s_suppkey AS object_id, s_acctbal FROM supplier),
st AS (SELECT fr.episode, frame_index, object_id, (object_id * 7 + frame_index * 13) % 40 AS mask_area_px, (object_id * 3 + frame_index) % 30 AS bx, (object_id + frame_index * 5) % 20 AS byy, frame_index / 20.0::DOUBLE AS confidence, CASE WHEN frame_index % 5 = 0 THEN 'lifecycle_quarantine' ELSE 'cutie_bidirectional' END AS source
 FROM fr JOIN ob ON fr.episode = ob.episode WHERE (object_id + frame_index) % 4 <> 0),
de AS (SELECT fr.episode, fr.frame_index, ob.object_id, mask_area_px, coalesce(confidence, 0) AS confidence, coalesce(source, 'untracked') AS source,
 CASE WHEN mask_area_px IS NULL THEN CASE WHEN fr.frame_index < ob.object_id % 4 THEN 'out_of_frame' ELSE 'rejected' END WHEN mask_area_px = 0 THEN 'fully_occluded'
  WHEN bx <= 1 OR byy <= 1 OR bx + 8 >= 31 OR byy + 4 >= 23 THEN 'partially_occluded' ELSE 'visible' END AS visibility
 FROM fr JOIN ob ON fr.episode = ob.episode LEFT JOIN st ON st.episode = fr.episode AND st.frame_index = fr.frame_index AND st.object_id = ob.object_id)"""


def _dense(spark, sf_dir):
    frames = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("episode"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))).alias("frame_index"))
    objects = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("episode"), F.col("s_suppkey").alias("object_id"))
    o, f = F.col("object_id"), F.col("frame_index")
    state = frames.join(objects, "episode").where((o + f) % 4 != 0).select(
        "episode", "frame_index", "object_id", ((o * 7 + f * 13) % 40).alias("mask_area_px"), F.array((o * 3 + f) % 30, (o + f * 5) % 20, F.lit(8).cast("long"), F.lit(4).cast("long")).alias("bbox"),
        (f / 20).alias("confidence"), F.when(f % 5 == 0, "lifecycle_quarantine").otherwise("cutie_bidirectional").alias("source"),
    )
    out = tracks.dense_tracks(frames, objects, state)
    return out.withColumn("visibility", tracks.visibility(F.col("mask_area_px"), F.col("bbox"), F.col("frame_index"), F.col("object_id") % 4, 32, 24))


@query(f"WITH {_DENSE_SQL} SELECT episode, frame_index, object_id, confidence, source, visibility FROM de")
def track_visibility(spark, sf_dir):
    return _dense(spark, sf_dir).select("episode", "frame_index", "object_id", "confidence", "source", "visibility")


@query(f"""WITH {_DENSE_SQL}, q AS (SELECT episode, frame_index, min(confidence) FILTER (mask_area_px IS NOT NULL AND visibility NOT IN ('fully_occluded', 'out_of_frame', 'rejected')) AS c,
 coalesce(list('object_' || object_id || CASE WHEN source = 'lifecycle_quarantine' THEN '_lifecycle_ambiguous' ELSE '_missing_track' END ORDER BY object_id) FILTER (visibility = 'rejected'), []) AS reasons FROM de GROUP BY 1, 2)
SELECT episode, frame_index, coalesce(c, CASE WHEN len(reasons) > 0 THEN 0 ELSE 0.75::DOUBLE END) AS confidence, CASE WHEN len(reasons) > 0 THEN 'rejected' ELSE 'accepted' END AS status, reasons FROM q""")
def object_frame_quality(spark, sf_dir):
    return tracks.object_frame_quality(_dense(spark, sf_dir), ["episode", "frame_index"])


@query(f"""WITH {USER_FRAMES_SQL}, a AS (SELECT track, frame_index, value, lag(value) OVER w AS p, lead(value) OVER w AS n FROM uf WINDOW w AS (PARTITION BY track ORDER BY frame_index)),
v AS (SELECT *, value * 0.3::DOUBLE >= 0.1::DOUBLE * p AS pv, value * 0.2::DOUBLE >= 0.1::DOUBLE * n AS nv, (frame_index % 7) / 10.0::DOUBLE AS pi, (frame_index % 5) / 10.0::DOUBLE AS ni FROM a WHERE p IS NOT NULL AND n IS NOT NULL)
SELECT track, frame_index, CASE WHEN pv AND nv AND greatest(pi, ni) < 0.2::DOUBLE THEN ['adjacent_tracks_disagree'] WHEN NOT pv AND nv AND ni < 0.2::DOUBLE THEN ['previous_track_collapsed_next_track_disagrees']
 WHEN pv AND NOT nv AND pi < 0.2::DOUBLE THEN ['next_track_collapsed_previous_track_disagrees'] ELSE []::VARCHAR[] END AS reasons FROM v""")
def anchor_consistency(spark, sf_dir):
    rows = tracks.adjacent(user_frames(spark, sf_dir).select("track", "frame_index", "value"), T, ["value"]).where("previous_value is not null and next_value is not null")
    p, n = tracks.viable(F.col("value") * 0.3, F.col("previous_value")), tracks.viable(F.col("value") * 0.2, F.col("next_value"))
    return rows.select("track", "frame_index", tracks.anchor_reasons(p, n, (F.col("frame_index") % 7) / 10, (F.col("frame_index") % 5) / 10).alias("reasons"))


# hands and depth -----------------------------------------------------------

_SIDES_SQL = """hd AS (SELECT l_orderkey AS frame_index, CASE WHEN l_linenumber % 2 = 0 THEN 'left' ELSE 'right' END AS handedness, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_tax * 40 AS depth, l_discount < 0.09::DOUBLE AS pok, l_tax > 0.01::DOUBLE AS lok, l_quantity / 8 AS speed,
 CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity * 2.2::DOUBLE END AS acc, round(1 - l_discount * 8, 6) AS confidence FROM lineitem),
hr AS (SELECT *, list_filter([CASE WHEN depth < 0.15::DOUBLE OR depth > 3 THEN handedness || '_invalid_camera_depth' END, CASE WHEN NOT pok THEN handedness || '_reprojection_mismatch' END, CASE WHEN NOT lok THEN handedness || '_landmark_mismatch' END,
 CASE WHEN speed > 5 THEN handedness || '_implausible_velocity' END, CASE WHEN acc > 100 THEN handedness || '_implausible_acceleration' END], lambda x: x IS NOT NULL) AS reasons FROM hd)"""


def _hands(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    side = F.when(F.col("l_linenumber") % 2 == 0, "left").otherwise("right")
    acc = F.when(F.col("l_partkey") % 3 == 0, None).otherwise(F.col("l_quantity") * 2.2)
    why = hands.hand_reasons(side, F.col("l_tax") * 40, F.col("l_discount") < 0.09, F.col("l_tax") > 0.01, F.col("l_quantity") / 8, acc)
    return li.select(F.col("l_orderkey").alias("frame_index"), side.alias("handedness"), "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", F.round(1 - F.col("l_discount") * 8, 6).alias("confidence"), why.alias("reasons"))


@query(f"WITH {_SIDES_SQL} SELECT frame_index, l_linenumber, l_partkey, l_suppkey, l_extendedprice, reasons FROM hr")
def hand_reasons(spark, sf_dir):
    return _hands(spark, sf_dir).select("frame_index", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "reasons")


@query(f"""WITH {_SIDES_SQL}, q AS (SELECT frame_index, coalesce(max(confidence) FILTER (len(reasons) = 0), 0) AS confidence, list_sort(list_distinct(flatten(coalesce(list(reasons) FILTER (len(reasons) > 0), [])))) AS r FROM hr GROUP BY 1)
SELECT frame_index, confidence, CASE WHEN confidence >= 0.3::DOUBLE THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN confidence >= 0.3::DOUBLE THEN [] WHEN len(r) > 0 THEN r ELSE ['no_reliable_hand'] END AS reasons FROM q""")
def hand_frame_quality(spark, sf_dir):
    out = hands.hand_frame_quality(_hands(spark, sf_dir), ["frame_index"])
    return out.withColumn("reasons", F.array_sort(F.array_distinct("reasons")))


@query("""SELECT o_orderkey AS frame_index, s AS handedness FROM orders, (VALUES ('left'), ('right')) v(s)
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND CASE WHEN l_linenumber % 2 = 0 THEN 'left' ELSE 'right' END = s)""")
def missing_hands(spark, sf_dir):
    frames = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_index"))
    return hands.missing_sides(frames, _hands(spark, sf_dir), ["frame_index"])


def _points_sql(n: int) -> str:
    return f"""pt AS (SELECT frame_index, ordinal, x0, y0, x1, y1, list_transform(range(0, {n}), lambda i: x0 + i * (quantity / {n}.0::DOUBLE) * 1.3::DOUBLE) AS px, list_transform(range(0, {n}), lambda i: y0 + i * 2.0::DOUBLE) AS py, quantity FROM bx)"""


def _points(spark, sf_dir, n: int):
    rows = boxes(spark, sf_dir)
    b, q = F.col("box_xyxy"), F.col("quantity")
    at = F.sequence(F.lit(0), F.lit(n - 1))
    return rows.withColumn("points", F.transform(at, lambda i: F.array(b[0] + i * (q / F.lit(float(n))) * 1.3, b[1] + i * 2.0)))


@query(f"""WITH {BOXES_SQL}, {_points_sql(21)}, m AS (SELECT *, greatest(8, (x1 - x0) * 0.2::DOUBLE) AS mx, greatest(8, (y1 - y0) * 0.2::DOUBLE) AS my FROM pt)
SELECT frame_index, ordinal, len(list_filter(range(1, 22), lambda i: px[i] >= x0 - mx AND px[i] <= x1 + mx AND py[i] >= y0 - my AND py[i] <= y1 + my)) / 21.0::DOUBLE >= 0.7::DOUBLE
 AND len(list_filter(range(1, 22), lambda i: px[i] >= 0 AND px[i] < 120 AND py[i] >= 0 AND py[i] < 80)) / 21.0::DOUBLE >= 0.8::DOUBLE AND greatest(list_max(px) - list_min(px), list_max(py) - list_min(py)) >= 20 AS fits FROM m""")
def hand_projection(spark, sf_dir):
    return _points(spark, sf_dir, 21).select("frame_index", "ordinal", hands.projection_fits(F.col("points"), F.col("box_xyxy"), 120, 80).alias("fits"))


@query(f"""WITH {BOXES_SQL}, {_points_sql(21)}, e AS (SELECT frame_index, ordinal, x0, y0, x1, y1, list_transform(list_filter(range(1, 22), lambda i: (i + ordinal) % 5 <> 0), lambda i: sqrt(power(quantity / 9 * (i % 3), 2) + power(1.5::DOUBLE, 2))) AS er FROM pt)
SELECT frame_index, ordinal, len(er) >= 12 AND list_aggregate(er, 'quantile_cont', 0.5) / greatest(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)), 1) <= 0.16::DOUBLE AND list_aggregate(er, 'quantile_cont', 0.9) / greatest(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)), 1) <= 0.25::DOUBLE AS fits FROM e""")
def hand_landmarks(spark, sf_dir):
    rows = _points(spark, sf_dir, 21)
    q, o = F.col("quantity"), F.col("ordinal")
    keys = F.transform("points", lambda p, i: F.array(p[0] + q / 9 * ((i + 1) % 3), p[1] + 1.5, F.when((i + 1 + o) % 5 != 0, 0.9).otherwise(0.2)))
    return rows.select("frame_index", "ordinal", hands.landmarks_fit(F.col("points"), keys, F.col("box_xyxy")).alias("fits"))


@query("""WITH d AS (SELECT l_orderkey AS frame_index, l_linenumber, l_partkey, l_suppkey, l_tax AS inv, l_discount * 5 AS delta, l_tax / 2 AS glare, l_quantity AS sharp, l_linenumber = 3 AS cut, l_extendedprice FROM lineitem),
c AS (SELECT *, greatest(0, 1 - inv * 4) * CASE WHEN delta > 0.28::DOUBLE THEN 0.65::DOUBLE WHEN delta <> 0 THEN greatest(0.65::DOUBLE, 1 - delta / 0.35::DOUBLE) ELSE 1 END * CASE WHEN glare > 0.03::DOUBLE THEN 0.65::DOUBLE WHEN glare > 0.008::DOUBLE THEN 0.82::DOUBLE ELSE 1 END * CASE WHEN sharp < 12 THEN 0.75::DOUBLE WHEN sharp < 35 THEN 0.9::DOUBLE ELSE 1 END AS k FROM d)
SELECT frame_index, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(k, 6) AS confidence, CASE WHEN k >= 0.5::DOUBLE THEN 'accepted' ELSE 'rejected' END AS status,
 list_filter([CASE WHEN delta > 0.28::DOUBLE THEN 'large_relative_depth_change' END, CASE WHEN glare > 0.03::DOUBLE THEN 'severe_glare_or_clipping' WHEN glare > 0.008::DOUBLE THEN 'glare_or_clipping' END, CASE WHEN sharp < 12 THEN 'motion_blur_or_low_texture' END, CASE WHEN cut THEN 'scene_cut_normalization_reset' END], lambda x: x IS NOT NULL) AS reasons FROM c""")
def depth_reasons(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_index"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_tax").alias("invalid_fraction"), (F.col("l_discount") * 5).alias("temporal_delta"), (F.col("l_tax") / 2).alias("glare_fraction"),
        F.col("l_quantity").alias("sharpness"), (F.col("l_linenumber") == 3).alias("scene_change"),
    )
    out = depth.depth_quality(rows)
    return out.select("frame_index", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.round("confidence", 6).alias("confidence"), "status", "reasons")


# joins and lookups ---------------------------------------------------------


@query("SELECT o_orderkey AS frame_index FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_left_anti(spark, sf_dir):
    from .plans.stages import remaining

    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("frame_index"))
    return remaining(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_index")), done, ["frame_index"])


@query("""WITH n AS (SELECT r_name AS label, r_regionkey::BIGINT AS frame_index, 'new' AS source FROM region WHERE r_regionkey < 3 UNION ALL SELECT lower(n_name), n_nationkey, 'new' FROM nation WHERE n_nationkey % 4 = 0)
SELECT n_name AS label, n_nationkey::BIGINT AS frame_index, 'old' AS source FROM nation WHERE NOT EXISTS (SELECT 1 FROM n WHERE lower(trim(n.label)) = lower(trim(n_name)) AND n.frame_index = n_nationkey) UNION ALL SELECT * FROM n""")
def seed_upsert(spark, sf_dir):
    from .plans.stages import upsert_seeds

    nation = table(spark, sf_dir, "nation")
    seeds = nation.select(F.col("n_name").alias("label"), F.col("n_nationkey").cast("long").alias("frame_index"), F.lit("old").alias("source"))
    new = table(spark, sf_dir, "region").where("r_regionkey < 3").select(F.col("r_name").alias("label"), F.col("r_regionkey").cast("long").alias("frame_index"), F.lit("new").alias("source"))
    return upsert_seeds(seeds, new.unionByName(nation.where("n_nationkey % 4 = 0").select(F.lower("n_name").alias("label"), F.col("n_nationkey").cast("long").alias("frame_index"), F.lit("new").alias("source"))))


@query("""WITH c AS (SELECT p_partkey AS profile, lower(trim(p_brand)) AS alias, p_size AS width, p_size * 2 AS height, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 25 + p_partkey % 10 END::DOUBLE AS fps FROM part),
s AS (SELECT l_orderkey AS stream, l_linenumber AS n, l_partkey AS p, l_suppkey AS q, l_extendedprice AS e, lower(trim(p_brand)) AS camera, p_size AS width, p_size * 2 AS height, 25 + l_linenumber::DOUBLE AS fps FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT stream, n, p, q, e, (SELECT min(profile) FROM c WHERE alias = camera AND c.width = s.width AND c.height = s.height AND NOT (s.fps <> 0 AND c.fps <> 0 AND abs(s.fps - c.fps) > 0.1::DOUBLE)) AS profile FROM s""")
def camera_lookup(spark, sf_dir):
    from .sources.profiles import match_profiles

    part = table(spark, sf_dir, "part")
    profiles = part.select(F.col("p_partkey").alias("profile"), F.array("p_brand").alias("aliases"), F.col("p_size").alias("width"), (F.col("p_size") * 2).alias("height"), F.when(F.col("p_partkey") % 5 == 0, 0).otherwise(25 + F.col("p_partkey") % 10).cast("double").alias("fps"))
    li = table(spark, sf_dir, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    streams = li.select(
        F.col("l_orderkey").alias("stream"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("q"), F.col("l_extendedprice").alias("e"), F.concat(F.lit(" "), F.upper("p_brand")).alias("camera"),
        F.col("p_size").alias("width"), (F.col("p_size") * 2).alias("height"), (25 + F.col("l_linenumber").cast("double")).alias("fps"),
    )
    return match_profiles(streams, profiles, ["stream", "n", "p", "q", "e"]).select("stream", "n", "p", "q", "e", "profile")


@query("""SELECT p_partkey AS part, (p_size * 12)::BIGINT // gcd(p_size * 12, 30) || ':' || 30 // gcd(p_size * 12, 30) AS aspect, round(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 30000.0::DOUBLE / (1000 + p_partkey % 7) END, 9) AS fps,
 CASE WHEN p_partkey % 3 = 0 THEN p_partkey ELSE greatest(round_even(p_retailprice / 1000 * 30, 0)::BIGINT, 1) END AS frames, 'frames/' || lpad(p_partkey::VARCHAR, 8, '0') || '.jpg' AS file FROM part""")
def video_values(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    fps = F.when(F.col("p_partkey") % 7 == 0, F.lit("30/0")).otherwise(F.concat(F.lit("30000/"), (1000 + F.col("p_partkey") % 7).cast("string")))
    stated = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string")).otherwise("N/A")
    return part.select(
        F.col("p_partkey").alias("part"), V.aspect_text(F.col("p_size") * 12, F.lit(30)).alias("aspect"), F.round(V.rate(fps), 9).alias("fps"), V.frame_count(stated, F.col("p_retailprice") / 1000, F.lit(30.0)).alias("frames"),
        V.frame_file(F.col("p_partkey"), "frames", "jpg").alias("file"),
    )


@query("""SELECT c_custkey AS row, list_distinct(list_filter(list_transform(string_split(c_mktsegment || ', ,' || c_name || ',' || c_mktsegment, ','), lambda x: trim(x)), lambda x: x <> '')) AS prompts FROM customer""")
def distinct_prompts(spark, sf_dir):
    text = F.concat_ws(",", "c_mktsegment", F.lit(" "), "c_name", "c_mktsegment")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row"), F.array_sort(V.distinct_prompts(V.comma_list(text))).alias("prompts"))


ORACLE_SQL["distinct_prompts"] = ORACLE_SQL["distinct_prompts"].replace("list_distinct(", "list_sort(list_distinct(").replace("x <> '')) AS", "x <> ''))) AS")
