"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a hash, form blocks. Block j (from 1) of a source
of weight w (its share of the weights of all sources that are left) is released at slot
floor((j-1)/w) and due by slot ceil(j/w); in each slot the released block of earliest deadline
runs. No source is then ever a whole block ahead of or behind its weight. When a source ends,
a new phase starts with the weights of those that are left; no document is dropped or
repeated.

The schedule is simulated on the driver, slot by slot, from one row a source; a slot takes
time by the logarithm of their number. Blocks grow with the corpus, so that there are at most
SLOTS of them (and one more a source). Documents are ranked in groups of bounded size.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..work import BROADCAST_BYTES
from .work import hinted, materialize

#: Documents of a block at least, blocks of the schedule at most, sources beyond which ``scheduled`` pools them unless told otherwise, documents that a ranking group aims at, and ranking groups of a source at most.
BLOCK, SLOTS, MAX_SOURCES, GROUP, GROUPS = 64, 100_000, 2000, 2000, 50_000
#: With more sources: the largest that are scheduled singly, and pools that the others aim at.
SINGLE, POOLS = 200, 200
#: Weights are whole numbers, of which the greatest has this many bits after its first.
WHOLE_BITS = 40


def whole_weights(weights: list[float]) -> list[int]:
    """Weights as whole numbers of at least 1, scaled by a power of two, so that whole ones keep their proportions exactly. All zero: all equal."""
    top = max(weights)
    if top <= 0:
        return [1] * len(weights)
    bits = WHOLE_BITS + 1 - math.frexp(top)[1]
    return [max(1, math.floor(math.ldexp(w, bits))) for w in weights]


def schedule(blocks: list[int], weights: list[float]) -> list[tuple[int, int]]:
    """(source, block) of every slot, by earliest deadline first.

    Sources of weight 0 come when all others have ended, in equal shares.
    """
    return list(slots_of(blocks, weights))


def slots_of(blocks: Sequence[int], weights: Sequence[float]) -> Iterator[tuple[int, int]]:
    """What ``schedule`` returns, one slot at a time."""
    some = [i for i, n in enumerate(blocks) if n > 0]
    yield from _phases(blocks, weights, [i for i in some if weights[i] > 0])
    yield from _phases(blocks, weights, [i for i in some if not weights[i] > 0])


def _phases(blocks: Sequence[int], weights: Sequence[float], sources: list[int]) -> Iterator[tuple[int, int]]:
    """The slots of ``sources``, until all have ended.

    Sources that have not run in a phase stay in a tree over the order of weights, which has the
    least source below each node, so a phase costs only by the sources that run in it. Of these
    sources, those due first are the ones from some weight on, and the least of them runs.
    """
    by = sorted(sources, key=lambda i: weights[i])
    place, none = [0] * len(blocks), len(blocks)
    for p, i in enumerate(by):
        place[i] = p
    width = 1 << max(0, len(by) - 1).bit_length()
    tree = [none] * width + by + [none] * (width - len(by))
    for p in range(width - 1, 0, -1):
        tree[p] = min(tree[2 * p], tree[2 * p + 1])

    def put(p: int, i: int) -> None:
        p += width
        tree[p] = i
        while p > 1:
            p >>= 1
            tree[p] = min(tree[2 * p], tree[2 * p + 1])

    def fresh() -> tuple[int, int] | None:
        if tree[1] == none:
            return None
        p = 1
        while p < width:
            p = 2 * p + (tree[2 * p + 1] != none)
        due = -(-total // a[p - width])
        p = width + bisect_left(a, -(-total // due))
        least = tree[p]
        while p > 1:
            if not p & 1:
                least = min(least, tree[p + 1])
            p >>= 1
        return due, least

    done, ended, top, scale, a, total = [0] * len(blocks), bytearray(len(by)), len(by), None, [], 0
    while True:
        while top and ended[top - 1]:
            top -= 1
        if not top:
            return
        if scale != (scale := math.frexp(weights[by[top - 1]])[1]):
            a = whole_weights([weights[i] for i in by[:top]])
            total = sum(w for w, gone in zip(a, ended, strict=False) if not gone)
        got: dict[int, int] = {}  # blocks of this phase
        waiting: list[tuple[int, int]] = []  # release, source: its next block
        ready: list[tuple[int, int]] = []  # deadline, source
        slot, first = 0, fresh()
        while True:
            while waiting and waiting[0][0] <= slot:
                _, i = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(got[i] + 1) * total // a[place[i]]), i))
            new = first is not None and (not ready or first < ready[0])
            _, i = first if new else heapq.heappop(ready)
            if new:
                put(place[i], none)
            yield i, done[i]
            done[i] += 1
            slot += 1
            if done[i] == blocks[i]:
                break
            got[i] = got.get(i, 0) + 1
            heapq.heappush(waiting, (got[i] * total // a[place[i]], i))
            if new:
                first = fresh()
        ended[place[i]] = 1
        total -= a[place[i]]
        for k in got:
            if k != i:
                put(place[k], k)


def _least(weights: Mapping[str, float]) -> float:
    """The weight of sources that a mapping lacks."""
    return float(min((w for w in weights.values() if w > 0), default=1.0))


def _pooled(docs: DataFrame, weights: Mapping[str, float] | None) -> tuple[DataFrame, list[int], list[float]]:
    """(source, sid, groups, weight), and the rows and the weight of each sid, for very many sources.

    The SINGLE largest sources have sids of their own and a null weight. A pool holds sources
    that end at about the same time (rows / weight within a fourth of an octave), so its
    weight holds until it ends; larger bands are dealt into more pools by a hash.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.sqrt("n"))
    else:
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "of string, weight double")
        sizes = sizes.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("of")), "left").drop("of").fillna(_least(weights), ["weight"])
    sizes = materialize(sizes.withColumn("weight", F.greatest("weight", F.lit(1e-300))), "sizes")  # weights may be 0
    top = sizes.orderBy(F.desc("n"), "source").limit(SINGLE).collect()
    single = spark.createDataFrame([(r.source, i, _groups(r.n)) for i, r in enumerate(top)], "source string, sid int, groups long")
    tail = sizes.join(F.broadcast(single.select(F.col("source").alias("of"))), F.col("source").eqNullSafe(F.col("of")), "left_anti")
    tail = tail.withColumn("band", F.floor(4 * F.log2(F.col("n") / F.col("weight"))))
    bands = tail.groupBy("band").agg(F.sum("n").alias("n")).orderBy("band").collect()
    total, at, deal = sum(r.n for r in bands), len(top), []
    for r in bands:
        deal.append((r.band, at, -(-POOLS * r.n // total)))
        at += deal[-1][2]
    dealt = tail.join(F.broadcast(spark.createDataFrame(deal, "band long, at int, parts long")), "band")
    dealt = dealt.withColumn("sid", (F.col("at") + F.pmod(F.xxhash64("source"), F.col("parts"))).cast("int"))
    n, share = [r.n for r in top] + [0] * (at - len(top)), [r.weight for r in top] + [0.0] * (at - len(top))
    for r in dealt.groupBy("sid").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).collect():
        n[r.sid], share[r.sid] = r.n, r.weight
    out = single.withColumn("weight", F.lit(None).cast("double"))
    return out.unionByName(dealt.select("source", "sid", F.lit(1).cast("long").alias("groups"), "weight")), n, share


def _joined(rows: pa.Table, spark: SparkSession) -> DataFrame:
    """``rows`` as a frame with a broadcast hint if they are small."""
    df = spark.createDataFrame(rows)
    return F.broadcast(df) if rows.nbytes + 64 * len(rows) <= BROADCAST_BYTES else df


def _groups(n: int) -> int:
    return min(max(1, n // GROUP), GROUPS)


def scheduled(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, slots: int = SLOTS, most: int | None = MAX_SOURCES) -> DataFrame:
    """The rows of ``docs`` with block, phase_slot (the slot of the block) and position.

    ``weights`` gives the target weight of a source: sources it lacks get the least of those
    above 0 (1, where none is), those of 0 or less come last. None stands for the square root
    of a source's rows. Null sources are one source. A block has ``block`` documents, or more
    if there would be more than ``slots`` blocks. Rows are ranked within a source by 60 bits of
    the MD5 of doc_id (of a hash of the row, where it is null), then by doc_id and a hash of
    the row; rows that repeat take places of their own, in one ranking group. position orders
    the mixture: slot * documents of a block + place in the block. Columns of those names are
    replaced. No rows give no rows.

    With ``most`` None every source is scheduled singly, however many there are: the schedule of
    the SQL, which op4 and the pipeline have. There a phase begins whenever one of very many small
    sources ends, and the weightiest run first in each, beyond their weights. With more than
    ``most`` sources, the largest stay single and the others share pools, which are scheduled
    like sources with the sums of their members' weights, so weights hold while members end;
    ``block`` is then one of the pool. See ``_pooled``.
    """
    kept = [c for c in docs.columns if c not in ("block", "phase_slot", "position")]
    docs = docs.select(*kept)
    spark = docs.sparkSession
    counts = docs.groupBy("source").agg(F.count("*").alias("n")).orderBy("source")
    counts = (counts if most is None else counts.limit(most + 1)).toArrow()  # one row a source
    pooled = most is not None and len(counts) > most
    if pooled:
        sources, sizes, share = _pooled(docs, weights)
        sources = hinted(sources, F.lit(96) + F.coalesce(F.length("source"), F.lit(0)))
    else:
        names, sizes = counts["source"].to_pylist(), counts["n"].to_pylist()
        rest = 0.0 if weights is None else _least(weights)
        share = [math.sqrt(n) if weights is None else max(0.0, float(weights.get(s, rest))) for s, n in zip(names, sizes, strict=True)]
        sid = pa.array(np.arange(len(sizes), dtype=np.int32))
        sources = _joined(pa.table({"source": counts["source"], "sid": sid, "groups": pa.array(map(_groups, sizes), pa.int64())}), spark)
    block = max(block, -(-sum(sizes) // slots))
    plan = np.fromiter(slots_of([-(-n // block) for n in sizes], share), np.dtype((np.int64, 2))).reshape(-1, 2)
    slot_of = _joined(pa.table({"of": pa.array(plan[:, 0].astype(np.int32)), "b": pa.array(plan[:, 1]), "slot": pa.array(np.arange(len(plan)))}), spark)

    # The rank within a source: groups of like hashes, a sum of the groups before, and a rank in the
    # group. The row itself travels as one struct, so its columns may have any names.
    name = F.coalesce(F.col("doc_id").cast("string"), F.xxhash64(*kept).cast("string"))
    h = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")
    rows = docs.select(F.struct(*kept).alias("row"), F.col("source").alias("name"), h.alias("h"), F.col("doc_id").alias("id"), F.xxhash64(*kept).alias("tie"))
    named = rows.join(sources, F.col("name").eqNullSafe(F.col("source"))).drop("source")
    named = named.withColumn("g", F.expr(f"cast(floor((h / {1 << 60}D) * groups) as long)"))
    groups = materialize(named.groupBy("sid", "g").agg(F.count("*").alias("c")), "groups")
    before = F.sum("c").over(Window.partitionBy("sid").orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    base = groups.select("sid", "g", F.coalesce(before, F.lit(0)).alias("base"))
    order = Window.partitionBy("sid", "g").orderBy("h", "id", "tie")
    if pooled:  # in a pool, blocks of its members by their deadlines
        own = Window.partitionBy("sid", "g", "name").orderBy("h", "id", "tie")
        named = named.repartition("sid", "g").withColumn("k", F.row_number().over(own) - 1)
        named = named.withColumn("due", F.when(F.col("weight").isNull(), 0.0).otherwise(F.expr(f"(k div {block} + 1) / weight")))
        order = Window.partitionBy("sid", "g").orderBy("due", F.xxhash64("name"), "name", "k")
    ranked = named.withColumn("r", F.row_number().over(order) - 1).join(hinted(base, F.lit(64)), ["sid", "g"])
    ranked = ranked.withColumn("r", F.col("r") + F.col("base")).withColumn("block", F.expr(f"cast(r div {block} as long)"))
    out = ranked.join(slot_of, (F.col("sid") == F.col("of")) & (F.col("block") == F.col("b")))
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), "block", F.col("slot").alias("phase_slot"), (F.col("slot") * block + F.col("r") % block).alias("position"))


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, most: int | None = MAX_SOURCES) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture; see ``scheduled``."""
    return scheduled(docs, weights, block, most=most).orderBy("position").select(*docs.columns)


#: The schedule slot by slot: n blocks, done ones, done ones when the phase began, its first slot.
ORACLE = f"""
WITH RECURSIVE z AS (SELECT coalesce(max(s), 1)::BIGINT AS block FROM (SELECT greatest({BLOCK}, -(-count(*) // {SLOTS})) AS s FROM documents)),
c AS (SELECT source, count(*)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM documents GROUP BY source),
k AS (SELECT list((n + block - 1) // block ORDER BY i) AS n, list(sqrt(n::DOUBLE) ORDER BY i) AS w, count(*)::BIGINT AS s FROM c, z),
r(slot, pick, blk, done, begun, zero) AS (
  SELECT -1::BIGINT, 0::BIGINT, 0::BIGINT, list_transform(range(s), lambda x: 0::BIGINT), list_transform(range(s), lambda x: 0::BIGINT), 0::BIGINT FROM k
  UNION ALL
  SELECT slot, pick, done[pick], list_transform(range(1, s + 1), lambda x: done[x] + (x = pick)::BIGINT),
         CASE WHEN done[pick] + 1 = n[pick] THEN list_transform(range(1, s + 1), lambda x: done[x] + (x = pick)::BIGINT) ELSE begun END,
         CASE WHEN done[pick] + 1 = n[pick] THEN slot + 1 ELSE zero END
  FROM (SELECT slot, n, s, done, begun, zero,
               list_sort(list_transform(list_filter(live, lambda x: (done[x] - begun[x]) * total // a[x] <= slot - zero), lambda x: {{'due': ((done[x] - begun[x] + 1) * total + a[x] - 1) // a[x], 'i': x}}))[1].i AS pick
        FROM (SELECT *, list_sum(list_transform(live, lambda x: a[x]))::HUGEINT AS total
              FROM (SELECT *, list_transform(range(1, s + 1), lambda x: greatest(1, floor(w[x] * pow(2.0::DOUBLE, {WHOLE_BITS} - floor(log2(list_max(list_transform(live, lambda y: w[y]))))))::HUGEINT)) AS a
                    FROM (SELECT r.slot + 1 AS slot, n, w, s, done, begun, zero, list_filter(range(1, s + 1), lambda x: done[x] < n[x]) AS live FROM r, k) WHERE len(live) > 0)))),
d AS (SELECT doc_id, documents.source, c.i, row_number() OVER (PARTITION BY c.i ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, doc_id) - 1 AS rk
      FROM documents JOIN c ON documents.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, source, (rk // block)::BIGINT AS block, slot AS phase_slot, (slot * block + rk % block)::BIGINT AS position
FROM d, z, r WHERE r.pick = d.i AND r.blk = rk // block AND r.slot >= 0
"""
