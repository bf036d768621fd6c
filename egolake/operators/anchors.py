"""Anchor selectors: objects from candidates of key frames, in three modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import box_iou
from .scoring import cluster_scores, diverse_clusters, label_candidates, label_scores, object_prompt_anchors, representatives
from .selection import greedy_matching, pair_groups, similarity_edges

SIMILAR, OVERLAP, LABEL_OVERLAP = 0.72, 0.70, 0.65


def clusters(candidates: DataFrame, keyframes: int, threshold: float = SIMILAR) -> DataFrame:
    """Candidates (episode, node, ...) with the cluster of each: matched pairs of different frames, or single ones.

    Clusters seen in one frame only are dropped if there are three key frames or more.
    """
    pairs = greedy_matching(similarity_edges(candidates, ["episode"], "node", "frame_index", "embedding", threshold), ["episode"], "i", "j", "similarity", same_side=True)
    out = pair_groups(candidates, ["episode"], "node", pairs)
    if keyframes >= 3:
        seen = out.groupBy("episode", "cluster").agg(F.count_distinct("frame_index").alias("_f")).where("_f >= 2").drop("_f")
        out = out.join(seen, ["episode", "cluster"], "left_semi")
    return out


def with_representatives(grouped: DataFrame) -> DataFrame:
    """Clusters with the box of their representative."""
    best = representatives(grouped, ["episode", "cluster"], "node").select("episode", "cluster", "node")
    return best.join(grouped.select("episode", "cluster", "node", "box_xyxy"), ["episode", "cluster", "node"])


def agnostic_objects(candidates: DataFrame, keyframes: int, limit: int, threshold: float = SIMILAR) -> DataFrame:
    """(episode, object_id, label, cluster, score): the best clusters that don't overlap each other."""
    grouped = clusters(candidates, keyframes, threshold)
    scored = cluster_scores(grouped, ["episode", "cluster"], keyframes).join(with_representatives(grouped), ["episode", "cluster"])
    kept = diverse_clusters(scored, ["episode"], limit, OVERLAP)
    number = F.row_number().over(Window.partitionBy("episode").orderBy(F.col("score").desc(), "cluster"))
    kept = kept.withColumn("object_id", number.cast("long"))
    return kept.select("episode", "object_id", F.format_string("unknown object %d", "object_id").alias("label"), "cluster", "score")


def label_chains(candidates: DataFrame, labels: Sequence[str], keyframes: int, threshold: float = SIMILAR) -> DataFrame:
    """(episode, object_id, label, cluster, score): for each label in turn the best chain whose
    representative doesn't overlap those of the labels before."""
    chosen: DataFrame | None = None
    for place, label in enumerate(labels):
        logit = F.col("clip_logits")[label]
        mine = label_candidates(candidates, ["episode"], logit, ["node"])
        grouped = clusters(mine, keyframes, threshold)
        scored = label_scores(grouped, ["episode", "cluster"], keyframes, logit, ["episode"], mine)
        scored = scored.join(with_representatives(grouped), ["episode", "cluster"])
        if chosen is not None:
            taken = chosen.select("episode", F.col("box_xyxy").alias("_box"))
            clash = scored.alias("s").join(taken.alias("t"), (F.col("s.episode") == F.col("t.episode")) & (box_iou(F.col("box_xyxy"), F.col("_box")) > LABEL_OVERLAP), "left_semi")
            scored = scored.join(clash.select("episode", "cluster").distinct(), ["episode", "cluster"], "left_anti")
        best = F.row_number().over(Window.partitionBy("episode").orderBy(F.col("score").desc(), "cluster"))
        one = scored.withColumn("_r", best).where("_r = 1").select("episode", F.lit(place).alias("place"), F.lit(label).alias("label"), "cluster", "score", "box_xyxy")
        chosen = one if chosen is None else chosen.unionByName(one)
    number = F.row_number().over(Window.partitionBy("episode").orderBy("place"))
    return chosen.withColumn("object_id", number.cast("long")).select("episode", "object_id", "label", "cluster", "score")


def prompted_objects(candidates: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(episode, object_id, label, frame_index, node, representative, score): one object for each label its prompts found."""
    table = F.create_map(*[x for i, label in enumerate(labels) for x in (F.lit(label.casefold()), F.lit(i))])
    known = candidates.withColumn("place", F.get(F.array(table[F.lower("prompt")]), F.lit(0))).where("place is not null")
    out = object_prompt_anchors(known.withColumn("label", F.element_at(F.array(*map(F.lit, labels)), F.col("place") + 1)), ["episode", "place", "label"], ["node"])
    number = F.dense_rank().over(Window.partitionBy("episode").orderBy("place"))
    return out.withColumn("object_id", number.cast("long")).select("episode", "object_id", "label", "frame_index", "node", "representative", "score")


