"""N-gram Jaccard join against brute force."""

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallyline.llm import jaccard

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = set()
    for i, s in enumerate(sets):
        for j in {k for x in s for k in where[x] if k > i}:
            shared = len(s & sets[j])
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                links.add((i, j))
                parent[root(i)] = root(j)
    least = defaultdict(lambda: 10**12)
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], d)
    return {d: (len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))}, links, sets


def test_join_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(docs).collect()}
    assert got == brute(rows)[0]


@pytest.mark.parametrize(("frequent", "by_threes"), [(1, 1), (1, 4), (1, 10**9), (3, 5), (3, 10**9), (10**9, 10**9)])
def test_index_misses_no_link(frequent, by_threes):
    rng = np.random.default_rng((frequent + by_threes) % 97)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, n)) for n in (6, 9, 14, 15, 16, 17, 18, 19, 20, 21, 24, 30, 34, 40, 66, 120, 400)]
    rows = []
    for text in base:
        for _ in range(12):
            w = text.split()
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"x{rng.integers(5)}"
            rows.append((len(rows), " ".join(w[: len(w) - int(rng.integers(0, max(1, len(w) // 9)))])))
    _, links, sets = brute(rows)
    hashed = jaccard.shingle_sets(pa.array([t for _, t in rows]))
    assert [len(h) for h in hashed] == [len(s) for s in sets]
    halves, n = np.unique(np.concatenate([(h >> np.uint64(32)).astype(np.uint32) for h in hashed]), return_counts=True)
    halves, threes = halves[n >= frequent], n[n >= frequent] >= by_threes
    index = []
    for h in hashed:
        rare, goes_on = jaccard.rare_signatures(h, halves, 80)
        index.append(set(rare.tolist()) | (set(jaccard.heavy_signatures(h, halves, threes, 80)[0].tolist()) if goes_on else set()))
    assert links and all(index[i] & index[j] for i, j in links)


def test_groups_in_blocks(spark, monkeypatch):
    """Near copies that are mostly not linked, without a central one, by frequent tokens and compared in small blocks."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(int(rng.integers(2, 6))):
            w[int(rng.integers(160))] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
    want, links, sets = brute(rows)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "HELD", 100)
    for by_threes in (50, 10**9):
        monkeypatch.setattr(jaccard, "BY_THREES", by_threes)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert links and got == want


def test_blocks_lose_no_pair():
    """Two entries: every link across components leaves the first entry of both, once; guests are compared with residents only."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**62, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 100 - k], rng.integers(0, 2**62, k).astype(np.uint64)])) for k in rng.integers(0, 20, 60)]
    node, component = np.arange(60), np.where(np.arange(60) < 30, 99, np.arange(60))
    frame = pd.DataFrame({"node": node, "n": [len(x) for x in sets], "h": [len(x) for x in sets], "component": component, "minor": component != 99,
                          "bits": [jaccard.bitmap_of(x) for x in sets], "sigs": [[5, 7] if i % 2 else [7] for i in node]})
    parts = [frame.assign(sig=7), frame[frame.node % 2 == 1].assign(sig=5)]
    rows = pd.concat([p.assign(guest=False) for p in parts] + [p[p.minor].assign(guest=True) for p in parts])
    found = [tuple(r) for r in jaccard.compare_blocks(rows, 80).to_numpy().tolist()]
    share = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    want = {(a, b) for a in node for b in node if a < b and component[a] != component[b] and 100 * (s := share(a, b)) >= 80 * (len(sets[a]) + len(sets[b]) - s)}
    assert want and want <= set(found) and len(found) == len(set(found)) < 60 * 59 / 2


def test_thousands_of_copies(spark):
    """Thousands of exact copies, and thousands of near copies most of which are not linked."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, "copy " * 3 + " ".join(base[:40])) for i in range(2000)]
    for i in range(2000, 3000):
        w = list(base)
        for _ in range(int(rng.integers(0, 9))):
            w[int(rng.integers(120))] = f"x{rng.integers(10**9)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()}
    distinct = {}
    for d, t in rows:
        distinct.setdefault(t, d)
    want = brute([(d, t) for t, d in distinct.items()])[0]
    assert got == {d: want[distinct[t]] for d, t in rows}
    assert len({c for _, c in got.values()}) > 200


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", "c"), (4, "one two", "d"), (5, "ONE  two", "e"), (6, "one two three", "f"), (7, long, "g"), (8, long + " end", "h"),
            (9, long, "i"), (9, long, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").withColumnRenamed("node", "n")
    out = sorted((r.doc_id, r.component_id) for r in jaccard.join_components(docs).collect())
    assert out == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 7), (9, 7), (9, 7)]
    assert jaccard.join_components(docs.where("doc_id < 0")).count() == 0


def test_every_link_counts(spark, monkeypatch):
    """n_links of groups of near copies, small and dealt into blocks, with exact copies among them."""
    monkeypatch.setattr(jaccard, "COUNT_NODES", 8)
    rng = np.random.default_rng(11)
    rows = []
    for group, size in enumerate((2, 3, 5, 40)):
        base = [f"g{group}w{i}" for i in range(100)]
        for _ in range(size):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(100))] = f"x{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, rows[3][1]) for i in range(3)]
    sets = {d: frozenset(shingles(t)) for d, t in rows}
    want = {d: sum(100 * len(s & o) >= 80 * len(s | o) for o in set(sets.values()) if o != s) for d, s in sets.items()}
    assert len({w for w in want.values() if w > 2}) > 2
    got = {r.doc_id: r.n_links for r in jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
