"""Vector codes against an exhaustive search, and on odd rows."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyline.llm import codes

DATA = "/root/testdata/sf0.01"


def brute(rows, parts=16, entries=64, rounds=2):
    """Rows of (vec_id, label, vector); the results' rows, and the codebooks."""
    rows = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    width = -(-max(1, *(len(r[2]) for r in rows)) // parts) * parts
    x = np.array([[max(-codes.MOST, min(codes.MOST, math.floor(256 * c))) for c in r[2]] + [0] * (width - len(r[2])) for r in rows], np.int64)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))[:entries]
    books = [[x[i, p * width // parts : (p + 1) * width // parts].tolist() for i in first] for p in range(parts)]
    for k in range(rounds + 1):
        found = np.zeros((len(rows), parts), int)
        error = np.zeros(len(rows), object)
        for p in range(parts):
            part = x[:, p * width // parts : (p + 1) * width // parts]
            d = ((part[:, None, :] - np.array(books[p])[None, :, :]) ** 2).sum(axis=2)
            found[:, p] = d.argmin(axis=1)
            error += d.min(axis=1)
            if k < rounds:
                for e in range(len(first)):
                    own = part[found[:, p] == e]
                    if len(own):
                        books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    text = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    by_label = defaultdict(int)
    for r, e in zip(rows, error, strict=True):
        by_label[r[1]] += int(e)
    return Counter((r[0], "".join(f"{c:02x}" for c in f), int(e), by_label[r[1]], text) for r, f, e in zip(rows, found, error, strict=True))


def test_codes_of_table(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    want = brute([(r.vec_id, r.label, list(r.embedding)) for r in df.collect()])
    assert Counter(map(tuple, codes.compress(df).collect())) == want


@pytest.mark.parametrize("kind", ["odd", "same", "few", "large"])
def test_codes_of_odd_rows(spark, kind):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 3) if i % 5 else None, [float(v) for v in rng.normal(0, 1, 20)]) for i in range(300)]
    if kind == "odd":
        rows += [(None, 1, [0.5] * 20), (None, None, [0.5] * 3), (7, 2, [0.25] * 20), (7, 2, [0.25] * 20), (400, 1, None), (401, 1, [math.nan] * 20), (402, 1, [math.inf]), (403, None, [None, 1.0]), (404, 1, [])]
    elif kind == "same":
        rows = [(i, 1, [0.5] * 32) for i in range(400)] + rows[:70]
    elif kind == "few":
        rows = rows[:5]
    else:
        rows = [(i, 1, [float(v) for v in rng.integers(-(1 << 20), 1 << 20, 32)]) for i in range(500)] + [(900, 1, [3e30] * 32)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "'x' as code", "1 as error", "2 as salt", "3 as copy")
    assert Counter(map(tuple, codes.compress(df).collect())) == brute(rows)


def test_codes_of_nothing(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    out = codes.compress(df.where("false"))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_trees():
    """Balls hold their points, caches are their sums, candidate lists shrink to owners, and blobs come back as they were."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-400, 400, (3000, 4)), np.repeat(rng.integers(-400, 400, (3, 4)), 300, axis=0), rng.integers(2000, 2010, (500, 4))])
    tree = codes.Tree.load(codes.Tree.build(points).dump())
    assert (points[tree.order] == tree.points).all() and tree.start[0] == 0 and tree.end[0] == len(points) and len(tree.radius) > 60
    for b in range(len(tree.radius)):
        own = tree.points[tree.start[b] : tree.end[b]].astype(np.int64)
        assert (own.sum(axis=0) == tree.sums[b]).all() and np.sqrt(((own - tree.centre[b]) ** 2).sum(axis=1)).max() <= tree.radius[b] + 1e-6
        if tree.left[b] >= 0:
            assert (tree.start[tree.left[b]], tree.end[tree.right[b]], tree.end[tree.left[b]]) == (tree.start[b], tree.end[b], tree.start[tree.right[b]])
        else:
            assert len(own) <= codes.LEAF or tree.radius[b] == 0
    entries = np.concatenate([points[:40], points[:10], points[-3:]])
    owned, owner, rest = tree.walk(entries)
    assert len(owned) > 10 and sum(int(tree.end[b] - tree.start[b]) for b in owned) + sum(t - s for s, t, _ in rest) == len(points)
    nearest = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    found, error = tree.assign(entries)
    assert (found == nearest.argmin(axis=1)).all() and (error == nearest.min(axis=1)).all()
    total = tree.totals(entries)
    assert (total[:, 0] == np.bincount(found, minlength=len(entries))).all() and (total[:, 1:].sum(axis=0) == points.sum(axis=0)).all()


def test_blocks_do_not_matter(spark, monkeypatch):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    want = Counter(map(tuple, codes.compress(df).collect()))
    monkeypatch.setattr(codes, "BLOCK", 70)
    monkeypatch.setattr(codes, "LEAF", 4)
    assert Counter(map(tuple, codes.compress(df.repartition(3)).collect())) == want
