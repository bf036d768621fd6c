import random
import re

import numpy as np
from egolake.llm import near_dedup as N
from egolake.llm.graph import components

from .common import TEXTS, WORDS, documents


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    """(doc_id, n_shingles, component) by comparing all pairs of rows."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)), d is not None and d == least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_edge_cases_against_brute_force(spark):
    docs = documents(spark, clash=("node", "band", "bands", "sig", "n", "component_id", "kept", "root"))
    assert got(N.near_duplicates(docs, shingle=3, num=85, den=100)) == brute(TEXTS, 3, 85, 100)


def test_no_rows(spark):
    assert N.near_duplicates(documents(spark, [])).count() == 0


def test_large_group_of_copies_with_growing_edits(spark):
    """A hub with copies that drift from it: links among them that the hub doesn't have count."""
    r = random.Random(5)
    base = [r.choice(WORDS) + str(r.randrange(300)) for _ in range(150)]
    rows = [(i, " ".join(base)) for i in range(40)]
    for i in range(40, 240):
        w = list(base)
        for _ in range(r.randrange(14)):
            at = r.randrange(len(w))
            if r.random() < 0.5:
                del w[at]
            else:
                w[at] = r.choice(WORDS)
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    for k, num in ((3, 85), (5, 80)):
        assert got(N.near_duplicates(documents(spark, rows), shingle=k, num=num, den=100)) == brute(rows, k, num, 100)


def test_estimate_is_unbiased_and_the_slack_holds(spark):
    rng = np.random.default_rng(3)
    pairs = []
    for share in (0.5, 0.7, 0.8, 0.85, 0.95):
        for _ in range(60):
            n = 400
            k = round(2 * n * share / (1 + share))
            both, rest = rng.integers(1, 1 << 63, k, dtype=np.uint64), rng.integers(1, 1 << 63, 2 * (n - k), dtype=np.uint64)
            a, b = np.concatenate([both, rest[: n - k]]), np.concatenate([both, rest[n - k :]])
            pairs.append((share, *([int(v) for v in N.pack(N.minima(np.unique(s))).view(np.int64)] for s in (a, b))))
    df = spark.createDataFrame(pairs, "share double, a array<long>, b array<long>")
    rows = df.select("share", N.estimate(df["a"], df["b"]).alias("e")).collect()
    for share in (0.5, 0.7, 0.8, 0.85, 0.95):
        e = [r.e for r in rows if r.share == share]
        assert abs(np.mean(e) - share) < 0.02
    assert min(r.e for r in rows if r.share == 0.85) > N.least_estimate(85, 100)
    assert min(r.e for r in rows if r.share == 0.8) > N.least_estimate(80, 100)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3), (7, 6)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
