import hashlib
import math
import os
import re
from fractions import Fraction
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from egolake.llm import mixing, queries, sharding, warc

from .common import TEXTS, documents


def key(rows):
    return sorted(rows, key=str)


# mixing --------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.floats(0.01, 100), st.sampled_from([1.0, 2.0, 5000.0])), min_size=1, max_size=12), st.integers(1, 40))
def test_no_source_is_a_block_away_from_its_target_weight(weights, least):
    total = sum(map(Fraction, weights))
    blocks = [int(least * w / min(weights)) % 3000 + 1 for w in weights]
    order = mixing.schedule(blocks, weights)
    assert sorted(order) == [(i, b) for i, n in enumerate(blocks) for b in range(n)]
    done = [0] * len(weights)
    for t, (i, b) in enumerate(order, 1):
        assert b == done[i]
        done[i] += 1
        # the schedule's weights are within 2**-40 of the target
        assert all(abs(d - t * Fraction(w) / total) < 1 + Fraction(t, 1 << 36) for d, w in zip(done, weights, strict=True))
        if done[i] == blocks[i]:
            break  # a phase ends


@pytest.mark.parametrize("n", [50, 500])
def test_a_heavy_source_among_many_light_ones_gets_its_weight(n):
    weights = [n - 1.0] + [1.0] * (n - 1)
    order = mixing.schedule([10**6] + [1000] * (n - 1), weights) if n < 100 else mixing.schedule([3000] + [1000] * (n - 1), weights)
    for t in (n, 1000, 2000):
        assert abs(sum(i == 0 for i, _ in order[:t]) - t / 2) < 1


def brute_schedule(blocks, weights):
    """Slot by slot, in fractions: the released block of earliest deadline among sources that are left."""
    done, order = [0] * len(blocks), []
    while any(d < n for d, n in zip(done, blocks, strict=True)):
        live = [i for i, n in enumerate(blocks) if done[i] < n]
        live = [i for i in live if weights[i] > 0] or live
        a = mixing.whole_weights([weights[i] for i in live])
        share = {i: Fraction(k, sum(a)) for i, k in zip(live, a, strict=True)}
        got = dict.fromkeys(live, 0)
        slot = 0
        while all(done[i] < blocks[i] for i in live):
            ready = [(math.ceil((got[i] + 1) / share[i]), i) for i in live if math.floor(got[i] / share[i]) <= slot]
            _, i = min(ready)
            order.append((i, done[i]))
            got[i], done[i], slot = got[i] + 1, done[i] + 1, slot + 1
    return order


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.one_of(st.floats(0, 50), st.just(0.0))), min_size=1, max_size=6))
def test_schedule_against_fractions(sources):
    blocks, weights = zip(*sources, strict=True)
    assert mixing.schedule(list(blocks), list(weights)) == brute_schedule(blocks, weights)


def test_schedule_against_simulation(spark):
    rows = [(i, f"text {i}") for i in range(2300)]
    docs = documents(spark, rows, ("block", "sid", "slot", "groups", "g", "b", "id", "of", "h", "row", "base", "tie"))
    n = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    names = sorted(n, key=lambda x: (x is not None, x))
    blocks = [-(-n[s] // 16) for s in names]
    want = brute_schedule(blocks, [math.sqrt(n[s]) for s in names])
    out = mixing.scheduled(docs, block=16).collect()
    assert len(out) == 2300 and len({r.position for r in out}) == 2300 and {r.doc_id for r in out} == set(range(2300))
    got = sorted({(r.phase_slot, r.source, r.block) for r in out}, key=lambda x: x[0])
    assert [(names.index(s), b) for _, s, b in got] == want
    assert [r.doc_id for r in mixing.mixed(docs, block=16).collect()] == [r.doc_id for r in sorted(mixing.scheduled(docs, block=16).collect(), key=lambda r: r.position)]
    few = mixing.scheduled(docs, block=16, slots=40).collect()  # blocks grow
    assert len({r.position for r in few}) == 2300 and 36 <= len({r.phase_slot for r in few}) <= 40 + len(names)


@pytest.mark.parametrize("weights", [{"src0": 3.0, "src1": 1.0}, {}, {"src0": 0.0}, {"src0": 0.0, "src1": -1.0, None: 2.0}, {"other": 1.0}])
def test_mixing_edge_cases(spark, weights):
    docs = documents(spark)
    out = mixing.scheduled(docs, weights, block=2).collect()
    assert key((r.doc_id, r.text) for r in out) == key(TEXTS) and len({r.position for r in out}) == len(TEXTS)
    assert mixing.scheduled(documents(spark, []), weights).count() == 0
    if weights.get(None):  # what has no weight comes last
        last = [r.source in ("src0", "src1") for r in sorted(out, key=lambda r: r.position)]
        assert last == sorted(last)


def test_rows_of_one_hash_and_of_null_ids_keep_places_of_their_own(spark):
    rows = [(None, f"t{i}") for i in range(30)] + [(7, "same")] * 20 + [(7, f"u{i}") for i in range(20)]
    out = mixing.scheduled(documents(spark, rows), block=4).collect()
    assert key((r.doc_id, r.text) for r in out) == key(rows) and len({r.position for r in out}) == len(rows)


def test_very_many_sources(spark):
    names = ["big"] * 400 + [None] * 300 + [f"host{i}" for i in range(2100) for _ in range(2)]
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "doc_id long, source string")
    for weights in (None, {"big": 20.0, "host1": 2**0.5}):
        out = sorted(mixing.scheduled(docs, weights, block=1).collect(), key=lambda r: r.position)
        assert sorted(r.doc_id for r in out) == list(range(len(names))) and len({r.position for r in out}) == len(out)
        share = 20 / (20 + (300**0.5 if weights is None else 2**0.5) + 2100 * 2**0.5)
        for k in (500, 1500, 3000):  # nothing has ended yet
            first = out[:k]
            assert abs(sum(r.source == "big" for r in first) - k * share) <= 0.2 * k * share + 4
        hosts = [r.source for r in out if r.source and r.source != "big"]
        assert len(set(hosts[:1500])) > 1400  # no host has its second turn long before others their first


def test_op4_schedules_every_source_of_very_many(spark, tmp_path):
    n = [1 + 64 * (i % 9 == 0) for i in range(2101)]  # two blocks or one
    docs = spark.createDataFrame([(k, f"host{i:04d}") for k, i in enumerate(i for i, m in enumerate(n) for _ in range(m))], "doc_id long, source string")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    out = queries.op4_mix_sources(spark, f"file://{tmp_path}").collect()
    want = mixing.schedule([-(-m // 64) for m in n], [m**0.5 for m in n])
    assert sorted({(r.phase_slot, r.source, r.block) for r in out}) == [(k, f"host{i:04d}", b) for k, (i, b) in enumerate(want)]
    assert len(out) == sum(n) == len({r.position for r in out})


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from([0.0, 1.0, 1.5, 2.0, 1e-9, 1e9])), min_size=20, max_size=40))
def test_schedule_of_many_short_sources_against_fractions(sources):
    blocks, weights = zip(*sources, strict=True)
    assert mixing.schedule(list(blocks), list(weights)) == brute_schedule(blocks, weights)


# sharding ------------------------------------------------------------------


def brute_shards(rows, limit):
    def bits(d):
        return int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16)

    sized = [(d, bits(d), len((t or "").encode())) for d, t in rows]
    out = []

    def split(part, depth, prefix):
        total = sum(b for _, _, b in part)
        if total <= limit or depth == 60:
            out.extend((d, b, depth, prefix, total) for d, _, b in part)
            return
        for bit in (0, 1):
            split([x for x in part if x[1] >> (59 - depth) & 1 == bit], depth + 1, prefix + str(bit))

    split(sized, 0, "")
    return key(out)


@pytest.mark.parametrize("limit", [1, 300, 2000, 100_000, 10**9])
def test_shards_against_splitting(spark, limit):
    rows = TEXTS + [(i, "x" * (i % 97)) for i in range(100, 400)] + [(500, "y" * 500)] * 5
    out = sharding.sharded(documents(spark, rows, ("cell", "bits", "p", "depth", "row", "_h")), limit).collect()
    assert key((r.doc_id, r.n_bytes, r.depth, r.shard, r.shard_bytes) for r in out) == brute_shards(rows, limit)


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    from egolake import work

    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: ""), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        work.work_root(remote)
    kept = work.materialize(spark.range(3), "x")
    folder = work.work_root(spark).removeprefix("file://")
    assert kept.count() == 3 and os.path.isdir(folder)
    work.clean()
    assert not os.path.isdir(folder)


def test_shard_files(spark, tmp_path):
    assert sharding.sharded(documents(spark, [])).count() == 0
    docs = documents(spark, [(i, "z" * 50) for i in range(64)])
    sharding.write_shards(docs, f"file://{tmp_path}/s", 400)
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert back.count() == 64 and max(r["count"] for r in back.groupBy("shard").count().collect()) <= 8


# WARC ----------------------------------------------------------------------

BIG = "é<p>" + "payload " * 40_000
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, None, BIG), (3, "x\r\ny: z", "s" * 999), (4, "u", "s" * 999), (5, "u", "t" * 1000), (6, "u", "t" * 1000), (7, "u", None), (8, "u", ""), (8, "u", ""), (None, "u", "t" * 1000),
    (10, "u", "WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: response"), (6, "u", "t" * 1000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, newest string")


def brute_records(rows):
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        newest = max((q for q, _, g in rows if (g or "").encode() == b and q is not None), default=None)
        to = newest if len(b) >= 1000 and p is not None and p < newest else None
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return key(out)


def test_records_against_brute_force(spark):
    out = warc.archived(pages(spark)).collect()
    assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == brute_records(PAGES)
    assert warc.archived(pages(spark, [])).count() == 0


def test_archive_bytes_and_damage(spark):
    rows = sorted(warc.write_archive(pages(spark)).collect(), key=lambda r: (r.record_id, r.chunk))
    assert max(len(r.data) for r in rows) <= warc.CHUNK + 2000 and max(r.chunk for r in rows) > 4
    data, at, found, heads = b"".join(bytes(r.data) for r in rows), 0, [], []
    while at < len(data):  # a plain reader of the format
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        heads.append(head.decode())
        size = int(re.search(rb"\nContent-Length: (\d+)", head)[1])
        block = data[at + len(head) + 4 :][:size]
        found.append((re.search(rb"WARC-Type: (\w+)", head)[1].decode(), block.partition(b"\r\n\r\n")[2]))
        at += len(head) + 4 + size
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
    ids = [re.search(r"WARC-Record-ID: <(.*?)>", h)[1] for h in heads]
    assert len(set(ids)) == len(ids) == len(PAGES)  # rows that repeat a page_id too
    by_page = {}
    for h, i in zip(heads, ids, strict=True):
        page = re.search(r"X-Page: (\d+)", h)
        by_page.setdefault(page and page[1], set()).add(i)
    for h in heads:
        to = re.search(r"WARC-Refers-To: <(.*?)>", h)
        assert not to or to[1] in by_page[re.search(r"X-Refers-To-Page: (\d+)", h)[1]]
    want = key(("revisit", b"") if t == "revisit" else ("response", (h or "").encode()) for (p, _, h), (_, _, _, t, _) in zip(sorted(PAGES, key=lambda x: str(x[0])), _paired(), strict=True))
    assert key(found) == want
    big = next(r.record_id for r in rows if r.chunk > 4)
    part = [tuple(r) for r in rows if r.record_id == big]
    assert list(warc.read_records(iter(part)))
    bad = [*part[:2], (*part[2][:2], b"!" + bytes(part[2][2])[1:], *part[2][3:]), *part[3:]]
    for broken in (bad, [part[0], *part[2:]], part[:-1]):
        with pytest.raises(ValueError, match="record"):
            list(warc.read_records(iter(broken)))


def test_payloads_of_many_batches_and_null_pages(spark):
    rows = [(1, "u", "é" * 5_000_000), (2, "u", "é" * 5_000_000), (None, "u", "x" * 2000), (None, None, None), (3, "u", "x" * 2000)]
    out = warc.archived(pages(spark, rows)).collect()
    assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == brute_records(rows)


def _paired():
    """Brute-force records in the order of the pages by id as text."""
    rows = sorted(PAGES, key=lambda x: str(x[0]))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        newest = max((q for q, _, g in PAGES if (g or "").encode() == b and q is not None), default=None)
        to = newest if len(b) >= 1000 and p is not None and p < newest else None
        out.append((p, len(b), "", "response" if to is None else "revisit", to))
    return out
