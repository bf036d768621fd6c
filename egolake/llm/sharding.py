"""Sharding by extendible hashing.

A document belongs to the shard of the leading bits of its hash. Only buckets over the byte
limit are split on a further bit, so a shard's depth is the least number of bits at which
its bucket fits. Bytes are summed once for cells of a few bits more than needed, and rolled
up from those; cells that still don't fit are looked at with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import hinted, keyed, materialize

LIMIT_BYTES, HASH_BITS, SPARE_BITS = 64 << 20, 60, 3


def _prefix(bits, h: str = "_h"):
    return F.expr(f"shiftrightunsigned({h}, {HASH_BITS} - {bits})")


def sharded(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The rows of ``docs`` with n_bytes, depth, shard (its bits as text) and shard_bytes.

    The hash is the first 60 bits of the MD5 of doc_id as text (of the empty text for null).
    n_bytes are the UTF-8 bytes of the text, 0 for null. A single document over the limit, or
    equal ids whose documents together are, can't be split and end in a shard of 60 bits over
    the limit. Columns of those names are replaced; others are kept; rows that repeat count
    each. No rows give no rows.
    """
    kept = [c for c in docs.columns if c not in ("n_bytes", "depth", "shard", "shard_bytes")]
    h = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    # the row itself travels as one struct, so its columns may have any names
    rows = docs.select(F.struct(*kept).alias("row"), h.alias("_h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    sized = rows.select("_h", "n_bytes")
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(HASH_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total / limit)))))
    low, found, todo = 0, None, sized
    while True:
        cells = todo.groupBy(_prefix(bits).alias("cell")).agg(F.sum("n_bytes").alias("b"))
        rolled = cells.select("cell", "b", F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth"))
        rolled = rolled.withColumn("p", F.expr(f"shiftrightunsigned(cell, {bits} - depth)")).withColumn("node", F.expr("shiftleft(1L, depth) + p"))
        # a node of few bits has very many cells
        sums = materialize(rolled.groupBy("node").agg(F.sum("b").alias("shard_bytes"), F.count("*").alias("rows")), "sums")
        fits = (F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS)
        best = F.min(F.when(fits, F.struct("depth", "p", "shard_bytes")))
        got = materialize(keyed(rolled.select("cell", "depth", "p", "node"), sums, "node", 64).groupBy("cell").agg(best.alias("s")), "cells")
        done = got.where("s is not null").select(F.lit(bits).alias("bits"), "cell", "s.*")
        found = done if found is None else found.unionByName(done)
        over = got.where("s is null").select("cell")
        if bits == HASH_BITS or over.isEmpty():
            break
        todo = todo.withColumn("cell", _prefix(bits)).join(hinted(over, F.lit(16)), "cell", "left_semi").select("_h", "n_bytes")
        low, bits = bits + 1, min(HASH_BITS, bits + 6)
    directory = found.select("bits", "cell", "depth", F.expr("lpad(bin(p), depth, '0')").alias("shard"), "shard_bytes")
    used = sorted(r.bits for r in directory.select("bits").distinct().collect())
    if not used:
        return rows.limit(0).select("row.*", "n_bytes", F.lit(0).alias("depth"), F.lit("").alias("shard"), F.lit(0).cast("long").alias("shard_bytes"))
    # one pass over the rows: the cells of each width are looked up in turn
    out = rows
    for b in used:
        part = directory.where(F.col("bits") == b).select(F.col("cell").alias(f"_c{b}"), F.struct("depth", "shard", "shard_bytes").alias(f"_s{b}"))
        out = out.join(hinted(part, F.lit(96)), _prefix(b) == F.col(f"_c{b}"), "left")
    out = out.withColumn("_s", F.coalesce(*(F.col(f"_s{b}") for b in used)))
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), "n_bytes", "_s.depth", "_s.shard", "_s.shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> None:
    """Write ``docs`` as Parquet, a folder for each shard (b and its bits); a shard's rows come from one task."""
    out = sharded(docs, limit).select(*docs.columns, F.concat(F.lit("b"), "shard").alias("shard"))
    out.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
u AS (SELECT d.*, k::INT AS k, h >> ({HASH_BITS} - k)::INT AS p FROM d, range(0, {HASH_BITS + 1}) r(k)),
s AS (SELECT k, p, sum(n_bytes)::BIGINT AS shard_bytes FROM u GROUP BY k, p),
f AS (SELECT u.doc_id, u.n_bytes, u.k AS depth, u.p, s.shard_bytes, row_number() OVER (PARTITION BY u.doc_id ORDER BY u.k) AS rn
      FROM u JOIN s ON u.k = s.k AND u.p = s.p WHERE s.shard_bytes <= {limit} OR u.k = {HASH_BITS})
SELECT doc_id, n_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth, '0') END AS shard, shard_bytes FROM f WHERE rn = 1
"""
