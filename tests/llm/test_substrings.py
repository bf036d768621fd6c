import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from egolake.llm import substring_dedup as S
from egolake import work
from egolake.llm.fmindex import FMIndex, WaveletTree, suffix_array

from .common import TEXTS, documents, prose


def key(rows):
    return sorted(rows, key=str)


def brute(rows, width=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return key(out)


def got(df):
    return key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_edge_cases_against_brute_force(spark):
    docs = documents(spark, clash=("th", "intervals", "fp", "rid", "words", "start"))
    assert got(S.without_repeats(docs)) == brute(TEXTS)
    assert S.without_repeats(documents(spark, [])).count() == 0


def shared_rows():
    r = random.Random(4)
    passages = [prose(900 + i, 140).split() for i in range(6)]
    hot = prose(999, 61).split()
    rows = []
    for i in range(160):
        w = prose(i, r.randrange(0, 120)).split()
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            a = r.randrange(90)
            at = r.randrange(len(w) + 1)
            w[at:at] = p[a : a + r.choice([48, 49, 50, 51, 55, 70])]
        if i % 3 == 0:
            w += hot
        if i % 11 == 0:
            w += ["loop"] * 120 + ["a", "b"] * 60
        if i % 20 == 0:
            w += prose(3000 + i // 40, 60 + i % 7).split()  # passages of two documents
        rows.append((r.randrange(70) if i % 5 == 0 else 100 + i, " ".join(w)))
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, rows[7][1] + " end")] + [rows[11]] * 40
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [True, False])
def test_shared_passages_of_all_lengths(spark, monkeypatch, small):
    monkeypatch.setattr(S, "SHARD_WORDS", 2000)
    monkeypatch.setattr(S, "QUERY_WORDS", 3000)
    monkeypatch.setattr(S, "STRETCH", 64)
    if not small:  # joins that are too large to broadcast
        monkeypatch.setattr(work, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(work, "HEAVY_KEYS", 50)
    rows = shared_rows()
    assert got(S.without_repeats(documents(spark, rows))) == brute(rows)


def test_the_index_decides(spark, monkeypatch):
    """Without what backward search finds nothing goes; if it found all that is streamed, more would."""
    rows = shared_rows()
    removed = lambda: sum(r[2] for r in got(S.without_repeats(documents(spark, rows))))
    want = sum(r[2] for r in brute(rows))
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.binary()), ("start", pa.int64()), ("stop", pa.int64())])

    def nothing(index, queries):
        return schema.empty_table()

    def everything(index, queries):
        stop = [s + len(w) for s, w in zip(queries["start"].to_pylist(), queries["words"].to_pylist(), strict=True)]
        return pa.table([queries["doc_id"], queries["th"], queries["start"], pa.array(stop, pa.int64())], schema=schema)

    monkeypatch.setattr(S, "_search", nothing)
    assert removed() == 0
    monkeypatch.setattr(S, "_search", everything)
    assert removed() > 1.1 * want


def test_keyed_joins_without_broadcasts(spark, monkeypatch):
    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(300)] + [(None, 1), (99, 2)], "k long, v long")
    n = {r.k: r["count"] for r in left.groupBy("k").count().collect()}
    right = spark.createDataFrame([(k, n[k], f"x{k}") for k in n if k is not None and k != 99], "k long, rows long, x string")
    want = key(tuple(r) for r in left.join(right.drop("rows"), "k", "left").collect())
    assert key(tuple(r) for r in work.keyed(left, right, "k", 1).collect()) == want
    monkeypatch.setattr(work, "BROADCAST_BYTES", 0)
    for heavy in (1, 4, 1000):
        monkeypatch.setattr(work, "HEAVY_KEYS", heavy)
        assert key(tuple(r) for r in work.keyed(left, right, "k", 1).collect()) == want
    as_bytes = lambda df: df.withColumn("k", df.k.cast("string").cast("binary"))
    out = work.keyed(as_bytes(left), as_bytes(right), "k", 1)
    assert key((None if r.k is None else int(bytes(r.k)), r.v, r.x) for r in out.collect()) == want


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 40, 500, dtype=np.uint64)
    bounds = np.array([0, 0, 30, 31, 300, 500])
    chosen = set(S.winnowed(keys, bounds, 35).tolist())
    for a, b in zip(bounds, bounds[1:], strict=False):
        for i in range(a, b - 34):
            span = keys[i : i + 35]
            least = i + 34 - int(span[::-1].argmin())
            assert least in chosen
    assert not any(c < 31 for c in chosen)


def test_suffixes_and_ranks():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100):
        text = rng.integers(0, 3, n)
        want = sorted(range(n), key=lambda i: text[i:].tolist())
        order, common = suffix_array(text)
        assert order.tolist() == want
        for i in range(1, n):
            a, b = text[want[i - 1] :], text[want[i] :]
            k = min(len(a), len(b))
            same = a[:k] == b[:k]
            assert common[i] == (k if same.all() else int(same.argmin()))
        assert common[0] == common[n] == -1
    sym = rng.integers(0, 9, 400)
    tree = WaveletTree(sym, 9)
    at, c = rng.integers(0, 401, 200), rng.integers(0, 9, 200)
    assert tree.rank(at, c).tolist() == [int((sym[:a] == s).sum()) for a, s in zip(at, c, strict=True)]


def test_matches_against_all_windows():
    rng = np.random.default_rng(2)
    for _ in range(30):
        seqs = [rng.integers(0, 3, rng.integers(1, 30)) for _ in range(6)]
        owners = rng.integers(0, 5, 6)
        queries = [rng.integers(0, 4, rng.integers(0, 25)) for _ in range(5)] + [seqs[0], seqs[1][:9]]
        q_owners = rng.integers(0, 7, len(queries))
        fm = FMIndex(seqs, owners)
        for q, o, found in zip(queries, q_owners, fm.matches(queries, q_owners, 4), strict=True):
            on = set()
            for a, b in found:
                on.update(range(a, b - 3))
            want = {i for i in range(len(q) - 3) if any(ow < o and any((s[j : j + 4] == q[i : i + 4]).all() for j in range(len(s) - 3)) for s, ow in zip(seqs, owners, strict=True))}
            assert on == want
    assert FMIndex([], np.zeros(0, np.int64)).matches([], np.zeros(0, np.int64), 4) == []
