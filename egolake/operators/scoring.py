"""Scores of clusters and labels, and representatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import MIN_LABEL_AREA, dot, normalised
from .selection import best_per_group, last_per_group, quality, suppress_overlaps, top_k


def _steady(value: str) -> Column:
    """1 for values that don't vary, towards 0 as their spread exceeds their mean."""
    return 1.0 / (1.0 + F.stddev_pop(value) / F.greatest(F.avg(value), F.lit(1e-6)))


def seen_frames() -> Column:
    """An aggregate: the different frames of a cluster, which are key frames at most.

    A set beside the other aggregates, as a distinct count would send every row twice.
    """
    return F.size(F.collect_set("frame_index")).cast("long")


def cluster_score(keyframes: int) -> Column:
    """An aggregate over (frame_index, area_fraction, aspect_ratio, detector_score); the median holds a cluster's scores."""
    frames = seen_frames() / F.lit(float(max(keyframes, 1)))
    return 0.45 * frames + 0.25 * _steady("area_fraction") + 0.20 * _steady("aspect_ratio") + 0.10 * F.median("detector_score")


def cluster_scores(df: DataFrame, keys: Sequence[str], keyframes: int) -> DataFrame:
    hits = seen_frames().alias("keyframe_hits")
    return df.groupBy(*keys).agg(cluster_score(keyframes).alias("score"), hits, F.count("*").alias("cluster_size"))


def label_scores(df: DataFrame, keys: Sequence[str], keyframes: int, logit: Column, bound_keys: Sequence[str], bounds_of: DataFrame | None = None) -> DataFrame:
    """0.50 of the 80th percentile and 0.25 of the median of scaled logits, and 0.25 of the cluster score.

    Logits are scaled by their least and greatest within ``bound_keys``, of ``bounds_of`` if given.
    """
    every = bounds_of if bounds_of is not None else df
    df = df.withColumn("_logit", F.coalesce(logit, F.lit(0.0)))
    bounds = every.withColumn("_logit", F.coalesce(logit, F.lit(0.0))).groupBy(*bound_keys).agg(F.min("_logit").alias("_lo"), F.max("_logit").alias("_hi"))
    df = df.join(bounds, list(bound_keys))
    scaled = (F.col("_logit") - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-6))
    df = df.withColumn("_scaled", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
    score = 0.50 * F.percentile("_scaled", F.lit(0.8)) + 0.25 * F.median("_scaled") + 0.25 * cluster_score(keyframes)
    return df.groupBy(*keys).agg(score.alias("score"))


def representatives(df: DataFrame, keys: Sequence[str], node: str, vector: str = "embedding") -> DataFrame:
    """The node whose direction is nearest to the mean vector of its group; the first of equals."""
    df = df.withColumn("_v", F.col(vector).cast("array<double>"))
    dims = df.select(*keys, F.posexplode("_v").alias("_i", "_x")).groupBy(*keys, "_i").agg(F.avg("_x").alias("_x"))
    mean = dims.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_m"))
    mean = mean.select(*keys, F.transform("_m", lambda x: x["_x"]).alias("_m"))
    scored = df.join(mean, list(keys)).withColumn("similarity", F.round(dot(normalised(F.col("_v")), normalised(F.col("_m"))), 9))
    return best_per_group(scored, keys, F.col("similarity"), [node]).select(*keys, node, "similarity")


def object_prompt_anchors(df: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Of each group (episode and label) the best candidate of every frame, with the group's score.

    score is the median quality over frames, representative marks the frame of best quality.
    """
    best = best_per_group(df.withColumn("quality", quality()), [*keys, "frame_index"], F.col("quality"), tie)
    whole = Window.partitionBy(*keys)
    first = whole.orderBy(F.col("quality").desc(), "frame_index")
    return best.where("quality > -1").withColumn("representative", F.row_number().over(first) == 1).withColumn("score", F.median("quality").over(whole))


def label_candidates(df: DataFrame, keys: Sequence[str], logit: Column, tie: Sequence[str], k: int = 8) -> DataFrame:
    """The k candidates of each frame with the highest logit, of those large enough."""
    return top_k(df.where(F.col("area_fraction") >= MIN_LABEL_AREA), [*keys, "frame_index"], F.coalesce(logit, F.lit(0.0)), tie, k)


def representative_by_confidence(df: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The mask of a track with the highest confidence times the root of its area."""
    return best_per_group(df, keys, F.col("confidence") * F.sqrt(F.greatest(F.col("area"), F.lit(1))), tie)


def diverse_clusters(clusters: DataFrame, keys: Sequence[str], limit: int, threshold: float = 0.70) -> DataFrame:
    """Clusters by score, without those whose box overlaps that of a better one."""
    return suppress_overlaps(clusters, keys, ["score", "cluster"], [True, False], threshold, limit=limit)


def usable_anchors(df: DataFrame) -> DataFrame:
    """Anchors that were found and have a mask."""
    return df.where(F.col("found") & (F.col("area") > 0))


def latest_anchors(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Of anchors of the same object and frame the last one given."""
    return last_per_group(df, [*keys, "frame_index"], ordinal)
