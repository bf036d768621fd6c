"""Near-duplicate documents by b-bit MinHash.

Every distinct shingle set is one node. Its minima give band keys, which only find
candidates; of each minimum the low ``bits`` bits are kept and packed into longs, and the
similarity of a candidate pair is estimated from the count of equal bit groups, corrected
for chance collisions. What passes the estimate is confirmed on the full shingle sets.

Large groups: exact copies are one node. In a band bucket every member is first compared
with one pivot (the node with most copies). Then only members that are still in another
component than others of their bucket are compared with those, inside the join condition,
so no pair is emitted that the estimate rejects, or that cannot share enough because of
shingles that one of the two alone has; and no bucket is gathered in one task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import chunks, gram_starts, lower_ascii, mix, prefix_sums, spans_hash, word_hashes, word_spans
from .graph import components
from .work import hinted, materialize, python_ready

HASHES, BITS, BANDS, ROWS = 384, 4, 24, 4
PER_LONG = 64 // BITS
LONGS = HASHES // PER_LONG
#: Standard deviations of the estimate that a true pair may fall below the threshold.
SLACK = 4.5

_A = np.random.default_rng(85).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIGNED = "doc_id long, n_shingles long, node binary, bands array<long>, sig array<long>"


def shingle_sets(column, k: int):
    """(row, sorted distinct 64-bit shingles) for each row of a string column."""
    for at, to, raw, offs in chunks(column):
        raw = lower_ascii(raw)
        start, end, bounds = word_spans(raw, offs)
        prefix = prefix_sums(word_hashes(raw, start, end))
        begin, of = gram_starts(bounds, k)
        grams = spans_hash(prefix, begin, begin + k)
        for i in range(to - at):
            if of[i + 1] > of[i]:
                yield at + i, np.unique(grams[of[i] : of[i + 1]])
            elif bounds[i + 1] > bounds[i]:
                yield at + i, spans_hash(prefix, bounds[i : i + 1], bounds[i + 1 : i + 2])
            else:
                yield at + i, np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The HASHES minima of a non-empty set, in blocks of bounded memory."""
    out = None
    for i in range(0, len(shingles), 512):
        low = (shingles[i : i + 512, None] * _A).min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def pack(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, PER_LONG of them in a 64-bit word.

    Minima are mixed first: the low bits of a product depend on the low bits of its factors
    alone, so those of unequal shingles would agree in all minima or in none.
    """
    part = (mix(low) & np.uint64((1 << BITS) - 1)).reshape(LONGS, PER_LONG)
    return np.bitwise_or.reduce(part << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low[: BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, j])
    return key


def _longs(rows: list) -> pa.Array:
    flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.uint64)]).view(np.int64)
    size = [0 if r is None else len(r) for r in rows]
    offs = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), mask=np.array([r is None for r in rows] + [False]))
    return pa.ListArray.from_arrays(offs, pa.array(flat))


def _signer(k: int):
    def sign(batches):
        for batch in batches:
            n, node, bands, sig = [], [], [], []
            for _, s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                low = minima(s) if len(s) else None
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(None if low is None else band_keys(low))
                sig.append(None if low is None else pack(low))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), _longs(bands), _longs(sig)], names=["doc_id", "n_shingles", "node", "bands", "sig"])

    return sign


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed signatures: equal bit groups, less those equal by chance."""
    mask = int("1".rjust(BITS, "0") * PER_LONG, 2)
    low = F.lit(mask - (1 << 64) if mask >> 63 else mask)
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        step = 1
        while step < BITS:
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step *= 2
        differ = differ + F.bit_count(x.bitwiseAND(low))
    chance = 2.0**-BITS
    return (1 - differ / F.lit(float(HASHES)) - chance) / (1 - chance)


def least_estimate(num: int, den: int) -> float:
    j, c = num / den, 2.0**-BITS
    p = c + (1 - c) * j
    return j - SLACK * math.sqrt(p * (1 - p) / HASHES) / (1 - c)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, n_copies.

    Two documents are linked if den * |A & B| >= num * |A | B| over their distinct shingles
    of ``shingle`` words (A-Z lower-cased). With fewer words the whole sequence is one
    shingle; null, empty and blank texts have none, link with nothing and are their own
    component. component_id is the smallest id of the connected component, kept is
    doc_id = component_id, n_copies the rows with the very same set. Rows that repeat an id
    are separate rows; each is kept if it bears the component's smallest id. A row whose id
    is null is linked through its exact copies only and never kept. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    python_ready(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(texts.mapInArrow(_signer(shingle), SIGNED), "signed")
    nodes = materialize(
        signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first(F.struct("n_shingles", "bands", "sig")).alias("s")).select("node", "doc_id", "n", "s.*"),
        "nodes",
    )
    links = _links(texts, nodes, shingle, num, den)
    roots = components(links)
    labelled = nodes.select("node", "doc_id", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = labelled.join(least, "root").select("node", "component_id", F.col("n").alias("n_copies"))
    out = signed.select("doc_id", "n_shingles", "node").join(final, "node", "left")
    first = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", first.alias("component_id"), F.coalesce(F.col("doc_id") == first, F.lit(False)).alias("kept"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def _links(texts: DataFrame, nodes: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Confirmed links (a, b) between nodes, enough to connect all that are linked."""
    entries = nodes.select("node", "n", F.explode("bands").alias("band"))
    pivots = entries.groupBy("band").agg(F.count("*").alias("members"), F.max(F.struct("n", "node")).alias("p")).where("members > 1").select("band", F.col("p.node").alias("pivot"))
    members = materialize(entries.select("band", "node").join(pivots, "band"), "members")
    inside = materialize(members.select("node").distinct(), "inside")
    wanted = materialize(nodes.select("node", "doc_id").join(inside, "node").select("doc_id").distinct(), "wanted")
    again = texts.join(hinted(wanted, F.lit(24)), "doc_id", "left_semi").select(F.lit(0).alias("none"), "text")
    sets = materialize(
        again.mapInArrow(_keyed(shingle), "node binary, shingles array<long>").join(inside, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")),
        "sets",
    )
    sig = nodes.select("node", "n_shingles", "sig")
    least = least_estimate(num, den)

    def fits(x: str, y: str) -> Column:
        small, large = F.least(f"{x}.n_shingles", f"{y}.n_shingles"), F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
        return (small * den >= large * num) & (estimate(F.col(f"{x}.sig"), F.col(f"{y}.sig")) >= least)

    def confirm(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        whole = F.size("sa") + F.size("sb") - both
        return materialize(pairs.join(a, "a").join(b, "b").where(both * den >= whole * num).select("a", "b"), "links")

    star = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = star.join(sig.alias("x"), F.col("a") == F.col("x.node")).join(sig.alias("y"), (F.col("b") == F.col("y.node")) & fits("x", "y")).select("a", "b")
    links = confirm(star)

    # What the pivots left apart: members of a bucket in different components. Only those outside
    # the bucket's main component are compared, with all members of other components.
    roots = components(links)
    main = roots.select(F.col("node").alias("pivot"), F.col("root").alias("main"))
    state = members.join(roots, "node", "left").join(main, "pivot", "left")
    state = state.select("band", "node", "pivot", F.coalesce("root", "node").alias("root"), F.coalesce("main", "pivot").alias("main"))
    state = materialize(state.withColumn("in_main", F.expr("root = main")).drop("main"), "state")
    split = state.where("not in_main").select("band").distinct()
    state = materialize(state.join(split, "band", "left_semi"), "split")
    # Shingles that no other node of these has are in no intersection: they bound what a pair can share.
    open_ = state.select("node").distinct()
    alone = sets.join(open_, "node", "left_semi").select("node", F.explode("shingles").alias("s"))
    alone = alone.groupBy("s").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1").groupBy("node").agg(F.count("*").alias("alone"))
    shared_size = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    facts = nodes.join(open_, "node", "left_semi").join(alone, "node", "left").select("node", "n_shingles", shared_size.alias("common"), "sig", "bands")
    state = materialize(state.join(facts, "node"), "facts")
    most = F.least("x.common", "y.common")
    possible = most * den >= (F.col("x.n_shingles") + F.col("y.n_shingles") - most) * num
    once = F.col("y.in_main") | (F.col("x.node") < F.col("y.node"))
    shared = F.expr("x.band = element_at(array_intersect(x.bands, y.bands), 1)")  # a pair is emitted in one bucket only
    apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root")) & (F.col("y.node") != F.col("x.pivot")) & once & possible & fits("x", "y") & shared
    rest = state.where("not in_main").alias("x").join(state.alias("y"), apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return links.unionByName(confirm(rest.distinct()))


def _keyed(k: int):
    """Texts to (node, shingles): the node is found again from the set itself."""

    def sets(batches):
        for batch in batches:
            got = [s for _, s in shingle_sets(batch.column(1), k)]
            node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in got]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), _longs(got)], names=["node", "shingles"])

    return sets


def oracle(shingle: int, num: int, den: int) -> str:
    """The same components in SQL, by counting the shingles that documents share."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {shingle - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING {den} * count(*) >= {num} * (na.n + nb.n - count(*))),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id),
q AS (SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id),
x AS (SELECT doc_id, count(*) OVER (PARTITION BY k)::BIGINT AS n_copies FROM (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY doc_id))
SELECT q.doc_id, q.n_shingles, q.component_id, q.doc_id = q.component_id AS kept, coalesce(x.n_copies, 1) AS n_copies FROM q LEFT JOIN x ON x.doc_id = q.doc_id
"""
