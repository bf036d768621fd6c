"""Removal of passages that an earlier document has, by compressed FM-indexes of shards.

1. Texts that equal an earlier one are streamed past that one's stretches, whole.
2. Of every other text, fingerprints of word runs are taken by winnowing: of the runs that
   start in a window of WINDOW words one is always chosen, and by content only, so texts that
   share a window share a fingerprint. Runs that one document alone has end here.
3. The windows around shared fingerprints form stretches. Two stretches with a fingerprint
   that at most COLD places have are a route from the later document to the earlier one. Of a
   fingerprint that more places have (a licence line), the windows around it are grouped by a
   hash, and each is a route to the first stretch that has it.
4. Stretches that routes lead to are dealt to shards of bounded size. Each shard is indexed,
   and the whole stretches routed to it stream past: backward search takes their matching
   statistics and reports the intervals of at least WINDOW words that a smaller id has.
   Routes only say which shards a stretch is streamed past; what is removed is what the
   index finds. A stretch that very many others are routed to is indexed again for each
   bounded part of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import chunks, column_bytes, gram_starts, mix, prefix_sums, spans_hash, word_hashes, word_spans
from .fmindex import FMIndex
from .work import hinted, keyed, materialize, python_ready

#: Words of a window, words of a fingerprint, windows of a stretch.
WINDOW, RUN, STRETCH = 50, 16, 512
#: Places of a fingerprint up to which every stretch that has it is routed to the earlier ones.
COLD = 4
#: Words that a shard indexes, and words that look something up in it, at about.
SHARD_WORDS, QUERY_WORDS = 400_000, 1_000_000


def winnowed(keys: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Indexes of keys that are the rightmost least of ``width`` consecutive ones of a row."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    # the least of a span of ``width`` is the least of two spans of a power of two
    reach = np.arange(n)
    best = reach.copy()
    step = 1
    while step * 2 <= width:
        other = best[step:]
        take = keys[other] <= keys[best[: n - step]]
        best = np.concatenate([np.where(take, other, best[: n - step]), best[n - step :]])
        step *= 2
    starts, _ = gram_starts(bounds, width)  # rows of fewer keys can't share a window
    a, b = best[starts], best[starts + width - step]
    chosen = np.where(keys[b] <= keys[a], b, a)
    return np.unique(chosen)


def _fingerprints(batches):
    for batch in batches:
        for at, to, raw, offs in chunks(batch.column(2)):
            start, end, bounds = word_spans(raw, offs)
            prefix = prefix_sums(word_hashes(raw, start, end))
            begin, of = gram_starts(bounds, RUN)
            keys = spans_hash(prefix, begin, begin + RUN)
            chosen = winnowed(keys, of, WINDOW - RUN + 1)
            row = np.searchsorted(of, chosen, "right") - 1
            ids, th = (pc.take(batch.column(k), pa.array(at + row)) for k in (0, 1))
            place = (begin[chosen] - bounds[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(keys[chosen].view(np.int64)), ids, th, pa.array(place)], names=["fp", "doc_id", "th", "place"])


def region_id(doc_id: int, th: bytes, start: np.ndarray) -> np.ndarray:
    key = mix(np.array([doc_id], np.int64).view(np.uint64)) ^ np.frombuffer(th, np.uint64, 1)
    return (mix(mix(key) + start.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _covered(places: np.ndarray, n: int) -> np.ndarray:
    """Which of the first n windows hold a run that starts at one of the places."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, np.clip(places + RUN - WINDOW, 0, n), 1)
    np.add.at(mark, np.minimum(places + 1, n), -1)
    return np.cumsum(mark[:n]) > 0


def _ranges(on: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.concatenate([[0], on, [0]]))).tolist()


REGION = "rid long, doc_id long, th binary, start long, words array<long>, fps array<long>, hot array<int>, copy_rid long"
_REGION = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("th", pa.binary()), ("start", pa.int64()), ("words", pa.list_(pa.int64())), ("fps", pa.list_(pa.int64())), ("hot", pa.list_(pa.int32())), ("copy_rid", pa.int64())])


def _regions(batches):
    """Stretches of (doc_id, th, text, copy_of, whole, places, fps): whole texts, or around places.

    A stretch has the fingerprints with few places that its windows hold, and the ranges of its
    windows that hold others (those of no fps).
    """
    for batch in batches:
        ids, th, copy_of, whole = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
        for at, to, raw, offs in chunks(batch.column(2)):
            out: list[list] = [[] for _ in _REGION]
            start, end, bounds = word_spans(raw, offs)
            words = word_hashes(raw, start, end).view(np.int64)
            for i in range(at, to):
                w = words[bounds[i - at] : bounds[i - at + 1]]
                n = len(w) - WINDOW + 1
                if n <= 0:
                    continue
                p, fps, few = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
                if batch.column(5)[i].is_valid:
                    p = batch.column(5)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    marks = batch.column(6)[i].values
                    few = marks.is_valid().to_numpy(zero_copy_only=False)
                    fps = marks.fill_null(0).to_numpy(zero_copy_only=False)
                hot = _covered(p[~few], n)
                p, fps = p[few], fps[few]
                runs = [0, n] if whole[i] else _ranges(hot | _covered(p, n))
                for a, b in zip(runs[::2], runs[1::2], strict=True):
                    cuts = np.arange(a, b, STRETCH)
                    rids = region_id(ids[i], th[i], cuts).tolist()
                    copies = region_id(copy_of[i], th[i], cuts).tolist() if copy_of[i] is not None else [None] * len(cuts)
                    for s, rid, copy in zip(cuts.tolist(), rids, copies, strict=True):
                        t = min(s + STRETCH, b)
                        held = np.unique(fps[(p + RUN - WINDOW < t) & (p >= s)])
                        for c, v in zip(out, (rid, ids[i], th[i], s, w[s : t + WINDOW - 1], held, _ranges(hot[s:t]), copy), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _REGION, strict=True)], schema=_REGION)


def _windows(batches):
    """A row (h, doc_id, rid, n) for every window in the hot ranges of stretches (rid, doc_id, words, hot)."""
    for batch in batches:
        rid, ids, words, hot = batch.columns
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i in range(len(batch)):
            c = hot[i].values.to_numpy(zero_copy_only=False)
            w = words[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate([np.arange(a, b) for a, b in zip(c[::2], c[1::2], strict=True)])
            for o, v in zip(out, (spans_hash(prefix_sums(w), at, at + WINDOW).view(np.int64), np.full(len(at), ids[i].as_py()), np.full(len(at), rid[i].as_py()), np.full(len(at), len(w))), strict=True):
                o.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["h", "doc_id", "rid", "n"])


def _search(index: pa.Table, queries: pa.Table) -> pa.Table:
    """Intervals (doc_id, th, start, stop) of the streamed stretches that the index finds in smaller ids."""
    out: list[list] = [[], [], [], []]
    if len(index) and len(queries):
        flat = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in c.combine_chunks()]
        fm = FMIndex(flat(index["w"]), index["owner"].to_numpy())
        ids, th, begin = (queries[c].to_pylist() for c in ("doc_id", "th", "start"))
        for i, found in enumerate(fm.matches(flat(queries["words"]), queries["doc_id"].to_numpy(), WINDOW)):
            for a, b in found:
                for o, v in zip(out, (ids[i], th[i], begin[i] + a, begin[i] + b), strict=True):
                    o.append(v)
    return pa.table([pa.array(o, pa.binary() if k == 1 else pa.int64()) for k, o in enumerate(out)], names=["doc_id", "th", "start", "stop"])


def _stretches(docs: DataFrame) -> DataFrame:
    """The stretches of ``docs`` that a window may be shared by; see REGION."""
    groups = docs.groupBy("th").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("rows"))
    copies = materialize(groups.where("first_id < last_id").select("th", "first_id", "rows"), "copies")
    marked = keyed(docs, copies, "th", 96)
    own = marked.where("first_id is null or doc_id = first_id")
    prints = materialize(own.select("doc_id", "th", "text").mapInArrow(_fingerprints, "fp long, doc_id long, th binary, place int"), "prints")
    shared = prints.groupBy("fp").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("rows")).where("a < b")
    shared = materialize(shared.select("fp", "rows", (F.col("rows") <= COLD).alias("few")), "shared")
    held = keyed(prints, shared, "fp", 48).where("few is not null")
    places = held.groupBy("doc_id", "th").agg(F.collect_set(F.struct("place", F.when(F.col("few"), F.col("fp")).alias("fp"))).alias("places"))
    places = materialize(places.select("doc_id", "th", F.col("places.place").alias("places"), F.col("places.fp").alias("fps")), "places")
    wanted = marked.join(hinted(places, F.lit(128) + 12 * F.size("places")), ["doc_id", "th"], "left").where("first_id is not null or places is not null")
    copy_of = F.when(F.col("doc_id") > F.col("first_id"), F.col("first_id"))
    mine = lambda c: F.when(copy_of.isNull(), F.col(c)).alias(c)
    wanted = wanted.select("doc_id", "th", "text", copy_of.alias("copy_of"), F.col("first_id").isNotNull().alias("whole"), mine("places"), mine("fps"))
    regions = materialize(wanted.mapInArrow(_regions, REGION), "regions")
    if regions.groupBy("rid").count().where("count > 1").isEmpty():
        return regions
    return materialize(regions.dropDuplicates(["rid"]), "regions")  # of rows that repeat an id and its text


def _routes(regions: DataFrame) -> DataFrame:
    """(rid, n, to_rid, to_n): the stretch rid of n words is streamed past the index that to_rid, of to_n words, is in."""
    held = regions.select(F.explode("fps").alias("fp"), F.struct("doc_id", "rid", F.size("words").alias("n")).alias("x"))
    held = held.groupBy("fp").agg(F.collect_set("x").alias("xs"))  # of COLD places, with two stretches each at most
    few = held.select("xs", F.explode("xs").alias("x")).select("x", F.explode("xs").alias("y")).where("x.doc_id > y.doc_id")
    few = few.select("x.rid", F.col("x.n").cast("long").alias("n"), F.col("y.rid").alias("to_rid"), F.col("y.n").cast("long").alias("to_n"))

    windows = regions.where("size(hot) > 0").select("rid", "doc_id", "words", "hot").mapInArrow(_windows, "h long, doc_id long, rid long, n long")
    first = windows.groupBy("h").agg(F.min(F.struct("doc_id", "rid", "n")).alias("f"), F.max("doc_id").alias("last"), F.count("*").alias("rows")).where("f.doc_id < last")
    first = materialize(first.select("h", "rows", F.col("f.doc_id").alias("to_doc"), F.col("f.rid").alias("to_rid"), F.col("f.n").alias("to_n")), "first")
    many = keyed(windows, first, "h", 64).where("doc_id > to_doc").select("rid", "n", "to_rid", "to_n")
    whole = regions.where("copy_rid is not null").select("rid", F.size("words").cast("long").alias("n"), F.col("copy_rid").alias("to_rid"), F.size("words").cast("long").alias("to_n"))
    return materialize(few.unionByName(many).unionByName(whole).distinct(), "routes")


def repeated_intervals(docs: DataFrame) -> DataFrame:
    """(doc_id, th, intervals) of rows with words that an earlier document's windows cover.

    ``docs`` has doc_id (long), th (a 128-bit hash of the text) and text; null ids are left out.
    """
    regions = _stretches(docs.where("doc_id is not null and text is not null"))
    routes = _routes(regions)
    load = materialize(routes.groupBy("to_rid").agg(F.sum("n").alias("load"), F.max("to_n").alias("to_n"), F.count("*").alias("rows")), "load")
    total, indexed = load.agg(F.coalesce(F.sum("load"), F.lit(0)), F.coalesce(F.sum("to_n"), F.lit(0))).first()
    shards = max(1, -(-indexed // SHARD_WORDS), -(-total // QUERY_WORDS))
    load = load.select("to_rid", "rows", F.expr(f"1 + load div {QUERY_WORDS // 2}").alias("parts"), F.pmod(F.xxhash64("to_rid"), F.lit(shards)).alias("shard"))
    sent = keyed(routes, load, "to_rid", 64).select("rid", "shard", F.pmod(F.xxhash64("rid"), F.col("parts")).alias("part")).distinct()
    sent = sent.join(regions.select("rid", "doc_id", "th", "start", "words"), "rid")
    index = regions.select(F.col("rid").alias("to_rid"), F.col("doc_id").alias("owner"), F.col("words").alias("w")).join(hinted(load.drop("rows"), F.lit(64)), "to_rid")
    index = index.select(F.col("shard").alias("s"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p"), "owner", "w")
    found = index.groupBy("s", "p").cogroup(sent.groupBy("shard", "part")).applyInArrow(_search, "doc_id long, th binary, start long, stop long")
    return found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "stop")).alias("intervals"))


def _removed(batches):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    for batch in batches:
        raw, offs = column_bytes(batch.column(1))
        data = raw.tobytes()
        n, gone, sha = [], [], []
        for i, cover in enumerate(batch.column(2)):
            words = data[offs[i] : offs[i + 1]].split()  # on the six ASCII separators
            n.append(len(words))
            kept = words
            if cover.is_valid:
                mark = np.zeros(len(words) + 1, np.int64)
                for x in cover.values.to_pylist():
                    mark[min(x["start"], len(words))] += 1
                    mark[min(x["stop"], len(words))] -= 1
                on = np.cumsum(mark[:-1]) > 0
                kept = [w for w, g in zip(words, on.tolist(), strict=True) if not g]
            gone.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word is removed if a window of WINDOW consecutive words that covers it also starts in a
    document of smaller id. Texts of fewer words, null and empty ones lose nothing; rows of
    null ids lose nothing and take nothing from others. Rows that repeat an id are rows of
    their own and don't take from each other. Other columns are ignored.
    """
    python_ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("th", F.unhex(F.md5("text")))
    found = materialize(repeated_intervals(docs), "intervals")
    out = docs.join(hinted(found, F.lit(128) + 24 * F.size("intervals")), ["doc_id", "th"], "left")
    return out.select("doc_id", "text", "intervals").mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d WHERE len(w) >= {WINDOW}),
h AS (SELECT doc_id, i, md5(array_to_string(w[i : i + {WINDOW - 1}], ' ')) AS k FROM s),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first_id FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM f WHERE first_id < doc_id),
r AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
             CASE WHEN gone IS NULL THEN w ELSE list_filter(list_transform(range(1, len(w) + 1), lambda x: CASE WHEN list_contains(gone, x) THEN NULL ELSE w[x] END), lambda y: y IS NOT NULL) END AS kept
      FROM d LEFT JOIN r ON d.doc_id = r.doc_id)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
