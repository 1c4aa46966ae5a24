"""Clusters and hard negatives against brute force on small awkward tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from frames import rows_of

from barwatch.llm import clustering, negatives
from barwatch.llm.clustering import candidates, clusters, hilbert
from barwatch.llm.negatives import hard_negatives

SHAPE = "vec_id long, embedding array<float>, label int, _id string, cluster int, distance long, _v int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", -1, -2, 5) for r in rows], SHAPE).repartition(4)


def some_rows(n: int, size: int, seed: int, grid: float = 0.0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    out = []
    for i in range(n):
        v = centres[rng.integers(6)] * rng.choice([0.2, 1.0]) + rng.normal(size=size) * 0.3
        if grid:
            v = np.round(v / grid) * grid
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(4))))
    out += [(n + k, out[min(5, n - 1)][1], 1) for k in range(n // 3)]  # a group of copies
    broken = [None, [], [1.0] * (size - 1), [None] + [1.0] * (size - 1), [math.nan] * size, [math.inf] + [0.0] * (size - 1)]
    out += [(2 * n + k, v, 2) for k, v in enumerate(broken)]
    out += [(3 * n, [0.0] * size, None), (3 * n + 100, [0.0] * size, 3)]
    return out


def kept(rows, size=64):
    fine = [r for r in rows if r[1] is not None and len(r[1]) == size and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(r[0], [math.floor(256 * x) for x in r[1]], r[2]) for r in fine]


def expected_clusters(rows, k=40, rounds=5):
    some = kept(rows)
    order = sorted(some, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    c = [r[1] for r in order[:k]]
    x = np.array([r[1] for r in some], object)

    def assign():
        d = np.array([((x - np.array(q, object)) ** 2).sum(axis=1) for q in c])
        return d.argmin(axis=0), d.min(axis=0)

    for _ in range(rounds):
        best, _ = assign()
        c = [[s // int((best == j).sum()) for s in x[best == j].sum(axis=0)] if (best == j).any() else c[j] for j in range(len(c))]
    best, d = assign()
    sha = [hashlib.sha256(",".join(map(str, q)).encode()).hexdigest() for q in c]
    return Counter((r[0], int(b), int(e), int(d[best == b].sum()), int(d.sum()), sha[b]) for r, b, e in zip(some, best, d))


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("seed, grid", [(1, 0.0), (2, 0.5)])
def test_clusters_equal_brute_force(spark, monkeypatch, seed, grid):
    monkeypatch.setattr(clustering, "BLOCK", 16)
    rows = some_rows(300, 64, seed, grid)
    rows += [rows[0], (None, rows[1][1], 1), (7, rows[2][1], 0)]
    assert rows_of(clusters(table(spark, rows)), *COLUMNS) == expected_clusters(rows)


def test_few_equal_and_no_vectors(spark):
    copies = [(i, [0.5] * 64, 0) for i in range(60)]
    assert rows_of(clusters(table(spark, copies)), *COLUMNS) == expected_clusters(copies)
    three = some_rows(3, 64, 5)
    assert rows_of(clusters(table(spark, three)), *COLUMNS) == expected_clusters(three)
    assert clusters(table(spark, [])).count() == 0
    assert clusters(table(spark, [(1, None, 1), (2, [1.0], 1)])).columns == list(COLUMNS)


def test_large_components_are_exact_and_larger_ones_refused(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-(2**18), 2**18)) for _ in range(64)], 0) for i in range(80)]
    assert rows_of(clusters(table(spark, rows)), *COLUMNS) == expected_clusters(rows)
    with pytest.raises(Exception, match="beyond"):
        clusters(table(spark, [(1, [1e9] * 64, 0)])).count()


def test_boxes_keep_every_nearest_centroid():
    rng = np.random.default_rng(3)
    for _ in range(200):
        centroids, x = rng.integers(-40, 40, (12, 3)), rng.integers(-9, 9, (20, 3)) + rng.integers(-30, 30, 3)
        distance = ((x[:, None] - centroids) ** 2).sum(axis=2)
        best = {j for row in distance for j in np.flatnonzero(row == row.min()).tolist()}
        assert best <= set(candidates(x.min(axis=0), x.max(axis=0), centroids).tolist())


def test_tight_boxes_need_few_centroids():
    centroids = np.random.default_rng(5).integers(-200, 200, (40, 64))
    box = centroids[3] - 5, centroids[3] + 5
    assert candidates(*box, centroids).tolist() == [3]


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3)])
def test_the_curve_visits_each_place_once_by_single_steps(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    at = hilbert(grid, bits)
    assert sorted(at.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def expected_negatives(rows):
    some = [
        (i, [math.floor(256 * x) for x in v], (l + 1) % 10 if i % 7 == 0 else l)
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, asked = Counter(), set()
    for i, v, l in some:
        if i % 100 or (i, l, len(v)) in asked:
            continue
        asked.add((i, l, len(v)))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in some if len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == l and s[1] != i][:5]:
            p = -p
            fits = [(-n, m) for n, m, o in scored if o != l and 30 * p <= 100 * -n <= 90 * p][:10]
            for rank, (n, m) in enumerate(fits, 1):
                out[i, j, rank, m, p, n] += 1
    return out


RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("size, grid, group", [(8, 0.0, 65_536), (8, 0.5, 40), (3, 1.0, 30)])
def test_negatives_equal_brute_force(spark, monkeypatch, size, grid, group):
    monkeypatch.setattr(negatives, "GROUP", group)
    monkeypatch.setattr(negatives, "LEAST", 100)
    rows = some_rows(500, size, 7, grid)
    rows += [rows[3], rows[3], (None, rows[1][1], 1), (77, rows[2][1], 0), (1100, [], 1), (1101, [], 1), (1102, [], 2)]
    got = rows_of(hard_negatives(table(spark, rows)), *RESULT)
    assert got == expected_negatives(rows) and len(got) > 50


def test_zero_and_negative_scores(spark):
    rows = [(100, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, -1.0], 2), (3, [-1.0, 0.0], 2), (4, [-2.0, 0.0], 1), (200, [-1.0, 0.0], 9)]
    got = rows_of(hard_negatives(table(spark, rows)), *RESULT)
    assert got == expected_negatives(rows)
    assert got[100, 1, 1, 2, 0, 0] == 1 and not [k for k in got if k[:2] == (100, 4)]


def test_wide_scores_and_empty_tables(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-60_000, 60_000)) for _ in range(64)], i % 3) for i in range(150)]
    assert rows_of(hard_negatives(table(spark, rows)), *RESULT) == expected_negatives(rows)
    assert hard_negatives(table(spark, [])).count() == 0
    assert hard_negatives(table(spark, [(100, [1.0], 1)])).columns == list(RESULT)
