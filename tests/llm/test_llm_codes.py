"""Vector codes against a plain version in whole numbers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tallyline.llm import codes


def plain(rows, rounds=6):
    """vec_id -> (code, error, label error), and the digest; every part against every entry."""
    fine = [(i, v, k) for i, v, k in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    dim = len(fine[0][1])
    fine = [(i, [math.floor(4096 * x) for x in v], k) for i, v, k in fine if len(v) == dim]
    cut = [dim * p // 8 for p in range(9)]
    parts = [[tuple(v[a:z]) for a, z in zip(cut, cut[1:])] for _, v, _ in fine]
    books = [[parts[e][p] for e in range(min(16, len(fine)))] for p in range(8)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(8):
            of = defaultdict(list)
            for row in parts:
                of[nearest(p, row[p])[1]].append(row[p])
            books[p] = [tuple(sum(c) // len(of[k]) for c in zip(*of[k])) if k in of else e for k, e in enumerate(books[p])]
    last = [[nearest(p, row[p]) for p in range(8)] for row in parts]
    errors = [sum(d for d, _ in x) for x in last]
    labels = defaultdict(int)
    for (_, _, k), e in zip(fine, errors):
        labels[k] += e
    out = [(i, "".join(f"{k:02x}" for _, k in x), e, labels[lab]) for (i, _, lab), x, e in zip(fine, last, errors)]
    return sorted(out, key=str), hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def run(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, k, "x") for i, v, k in rows], f"vec_id long, embedding array<{kind}>, label int, code string").repartition(3)
    got, books = codes.coded(df)
    out = codes.with_label_errors(got)
    return sorted((tuple(r) for r in out.select("vec_id", "code", "error", "label_error").collect()), key=str), codes.digest(books)


def vectors(n, dim, spread, seed=1):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [float(np.float32(c + r.gauss(0, spread))) for c in centres[i % 5]], i % 3 if i % 7 else None) for i in range(n)]


@pytest.mark.parametrize("n,dim,spread", [(700, 16, 0.05), (300, 24, 1.0), (9, 8, 1.0), (40, 11, 0.5), (30, 3, 0.5)])
def test_codes(spark, n, dim, spread):
    rows = vectors(n, dim, spread)
    assert run(spark, rows) == plain(rows)


def test_ties_nulls_and_odd_rows(spark):
    same = [(i, [0.5] * 8, 1) for i in range(100, 140)]
    odd = [(1, None, 1), (2, [], 1), (3, [1.0] * 7 + [None], None), (4, [float("nan")] * 8, 2), (5, [float("inf")] * 8, 2), (6, [1.0] * 16, 3), (None, [1.0] * 8, None)]
    rows = vectors(60, 8, 0.3)[10:] + same + odd + [(140, [0.25] * 8, 9), (140, [0.25] * 8, 9)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, odd[:5]) == ([], codes.digest([]))
    assert run(spark, []) == ([], codes.digest([]))


def test_large_components(spark):
    rows = [(i, [x * 3e5 for x in v], k) for i, v, k in vectors(200, 8, 0.3)]
    assert run(spark, rows, "double") == plain(rows)


def test_shortlists_lose_no_nearest_entry():
    r = np.random.default_rng(3)
    points = np.concatenate([r.integers(-9, 9, (500, 8)), r.integers(900, 909, (500, 8))]).astype(np.int64)
    entries = np.concatenate([r.integers(-9, 9, (8, 8)), r.integers(900, 909, (7, 8)), points[:1]]).astype(np.int64)
    blocks = codes.Blocks.build(points)
    index, away, lone = blocks.nearest(entries, True)
    want = ((blocks.points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == want.argmin(axis=1)).all() and (away == want.min(axis=1)).all()
    assert not blocks.shortlists(entries).all() and sorted(map(tuple, blocks.points)) == sorted(map(tuple, points))
    far = codes.Blocks.build(points).nearest(np.array([[0] * 8, [905] * 8]), False)
    assert far[2].sum() >= 14 and (far[0] == (blocks.points[:, 0] > 100)).all()


def test_neighbours_on_the_curve_are_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    walk = grid[np.argsort(codes.hilbert(np.concatenate([grid, [[7, 7, 7]]]))[: len(grid)], kind="stable")]
    assert len(set(codes.hilbert(grid).tolist())) == 512
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).mean() > 0.95
