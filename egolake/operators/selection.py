"""Choosing among candidates: best of a frame, top k, suppression, pairs and matchings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import box_iou
from ..work import materialize


def best_per_group(df: DataFrame, keys: Sequence[str], score: Column, tie: Sequence[str]) -> DataFrame:
    """The row of highest score of each group; of equals the first by ``tie``.

    Spark limits the groups of a ranking window before the shuffle (WindowGroupLimit), so a
    task sends one row of each of its groups.
    """
    return top_k(df, keys, score, tie, 1)


def top_k(df: DataFrame, keys: Sequence[str], score: Column, tie: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(score.desc(), *tie)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def quality(label: str | None = None) -> Column:
    """Detector score times mask score, times the label's logit (at least 1e-6) if one is given."""
    q = F.col("detector_score") * F.col("sam2_mask_score")
    if label is not None:
        q = q * F.greatest(F.coalesce(F.col("clip_logits")[label], F.lit(0.0)), F.lit(1e-6))
    return q


def last_per_group(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each group."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def capped_labels(labels: Column, limit: Column) -> Column:
    """The first labels, no more than ``limit``."""
    return F.slice(labels, 1, F.least(F.size(labels), limit))


def suppress_overlaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: Sequence[bool], threshold: float, box: str = "box_xyxy", limit: int | None = None) -> DataFrame:
    """Greedy suppression: in order, rows that overlap no kept row by more than ``threshold``.

    The rows of a group (the boxes of a frame, or the clusters of an episode) are folded in the
    JVM, in order; at most ``limit`` of them are kept. Descending order needs numbers; equal
    rows are told apart by their other columns, which must have an order (no maps).
    """
    ranks = [(-F.col(c) if d else F.col(c)).alias(f"_o{i}") for i, (c, d) in enumerate(zip(order, descending, strict=True))]
    row = F.struct(*ranks, *(c for c in df.columns if c not in keys))
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    none = F.filter("_rows", lambda _: F.lit(False))

    def step(kept: Column, r: Column) -> Column:
        out = F.exists(kept, lambda k: box_iou(k[box], r[box]) > threshold)
        if limit is not None:
            out = out | (F.size(kept) >= limit)
        return F.when(out, kept).otherwise(F.concat(kept, F.array(r)))

    kept = rows.select(*keys, F.explode(F.aggregate("_rows", none, step)).alias("_r"))
    return kept.select(*(F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


#: Edges of a group that one task matches; larger groups are first matched in rounds.
GROUP_EDGES = 500_000


def greedy_matching(edges: DataFrame, keys: Sequence[str], left: str, right: str, score: str, same_side: bool = False, limit: int = GROUP_EDGES) -> DataFrame:
    """Edges taken by (score, left, right) from high to low, each end once.

    ``same_side``: both ends are of one set. While a group of ``keys`` (an episode) has more
    than ``limit`` edges, rounds take every edge that is the best at both of its ends, which
    the order would take too, and drop the edges of their ends; what is left of a group is
    matched in one task. The edges are written once, so that they are not computed again.
    """
    k, rank = list(keys), F.struct(score, left, right)
    rows = materialize(edges, "edges")
    taken: DataFrame | None = None
    while (rows.groupBy(*k).count().agg(F.max("count")).first()[0] or 0) > limit:
        sides = [rows.select(*k, F.lit(0 if same_side else i).alias("_side"), F.col(c).alias("_end"), rank.alias("_rank")) for i, c in enumerate((left, right))]
        best = sides[0].unionByName(sides[1]).groupBy(*k, "_side", "_end").agg(F.max("_rank").alias("_rank"))
        agreed = best.groupBy(*k, "_rank").count().where("count = 2").select(*k, F.col(f"_rank.{score}").alias(score), F.col(f"_rank.{left}").alias(left), F.col(f"_rank.{right}").alias(right))
        won = materialize(rows.join(agreed, [*k, score, left, right], "left_semi").dropDuplicates([*k, left, right]), "matched")
        used = [won.select(*k, F.col(c).alias("_end")) for c in (left, right)]
        used = [used[0].unionByName(used[1])] * 2 if same_side else used
        for c, ends in zip((left, right), used, strict=True):
            rows = rows.join(ends.withColumnRenamed("_end", c), [*k, c], "left_anti").select(*edges.columns)
        rows = materialize(rows, "edges")
        taken = won if taken is None else taken.unionByName(won)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([score, left, right], ascending=False)
        a_used: set = set()
        b_used: set = a_used if same_side else set()
        kept = []
        for i, (a, b) in enumerate(zip(group[left], group[right], strict=True)):
            if a not in a_used and b not in b_used:
                a_used.add(a)
                b_used.add(b)
                kept.append(i)
        return group.iloc[kept]

    rest = rows.groupBy(*k).applyInPandas(run, edges.schema)
    return rest if taken is None else taken.select(*edges.columns).unionByName(rest)


def similarity_edges(df: DataFrame, keys: Sequence[str], node: str, frame: str, vector: str, threshold: float, block: int = 8192, decimals: int | None = None) -> DataFrame:
    """Of each node the most similar node of another frame above ``threshold``: (keys, i, j, similarity), i < j only.

    The nodes of a group are compared in blocks: every node goes once to each pair of blocks
    that its own block is in, and a task multiplies two blocks. Only the best of each node
    leaves a task, and the maximum over tasks is its best; of equals the smaller node. The
    work is that of all pairs of a group; a vector is sent to n / ``block`` tasks (eight, for
    groups of a few hundred nodes or more), and a task multiplies 1024 rows at a time.
    """
    blocks = F.expr(f"cast(greatest(ceil(_n / {block}), least(8, ceil(_n / 256))) as int)")
    size = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_blocks", blocks)
    nodes = df.select(*keys, F.col(node).alias("_node"), F.col(frame).alias("_frame"), F.col(vector).cast("array<double>").alias("_v")).join(F.broadcast(size) if not keys else size, list(keys))
    nodes = nodes.withColumn("_b", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(F.least("_b", o).alias("a"), F.greatest("_b", o).alias("b")))
    nodes = nodes.withColumn("_p", F.explode(pairs)).select(*keys, "_node", "_frame", "_v", "_b", F.col("_p.a").alias("_x"), F.col("_p.b").alias("_y"))
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*keys).dtypes) + ", i bigint, j bigint, similarity double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(rows["_v"].to_list())
        v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        ids, frames, b = rows["_node"].to_numpy(), rows["_frame"].to_numpy(), rows["_b"].to_numpy()
        x, y = int(rows["_x"].iloc[0]), int(rows["_y"].iloc[0])
        order = np.argsort(ids, kind="stable")
        v, ids, frames, b = v[order], ids[order], frames[order], b[order]
        out = []
        for p, q in {(x, y), (y, x)}:
            s, t = np.flatnonzero(b == p), np.flatnonzero(b == q)
            if not len(s) or not len(t):
                continue
            for at in range(0, len(s), 1024):
                r = s[at : at + 1024]
                sim = v[r] @ v[t].T
                if decimals is not None:
                    sim = np.round(sim, decimals)
                sim[frames[r][:, None] == frames[t][None, :]] = -np.inf
                best = sim.argmax(1)
                top = sim[np.arange(len(r)), best]
                ok = top > threshold
                out.append(pd.DataFrame({"i": ids[r][ok], "j": ids[t][best[ok]], "similarity": top[ok]}))
        got = pd.concat(out) if out else pd.DataFrame({"i": [], "j": [], "similarity": []})
        for c in keys:
            got[c] = rows[c].iloc[0]
        return got[[*keys, "i", "j", "similarity"]]

    each = nodes.groupBy(*keys, "_x", "_y").applyInPandas(run, schema)
    best = top_k(each, [*keys, "i"], F.col("similarity"), ["j"], 1)
    return best.where("i < j")


def pair_groups(df: DataFrame, keys: Sequence[str], node: str, pairs: DataFrame) -> DataFrame:
    """Every node with its cluster: the smaller node of its matched pair, or itself."""
    both = pairs.select(*keys, F.col("i").alias("_m"), F.col("i").alias("cluster")).unionByName(pairs.select(*keys, F.col("j").alias("_m"), F.col("i").alias("cluster")))
    out = df.join(both.withColumnRenamed("_m", node), [*keys, node], "left")
    return out.withColumn("cluster", F.coalesce("cluster", F.col(node)))


def assign_labels(scores: DataFrame, keys: Sequence[str], least: float = 0.36) -> DataFrame:
    """Rows (object_id, label_index, label, score) to one label for each object: greedy, score >= least.

    Objects without one are named ``unknown object N`` and carry their best score.
    """
    won = greedy_matching(scores.where(F.col("score") >= least), keys, "object_id", "label_index", "score")
    top = scores.groupBy(*keys, "object_id").agg(F.max("score").alias("_top"))
    out = top.join(won.select(*keys, "object_id", "label", "score"), [*keys, "object_id"], "left")
    name = F.coalesce("label", F.format_string("unknown object %d", F.col("object_id")))
    return out.select(*keys, "object_id", name.alias("label"), F.col("label").isNotNull().alias("accepted"), F.coalesce("score", "_top").alias("clip_score"))
