"""Grid clustering, k-distance and components against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import barwatch.operators.dbscan as dbscan_module
import barwatch.operators.kdistance as kdistance_module
from barwatch.config import FEATURES, DensityParams
from barwatch.functions.components import components, numbered
from barwatch.operators.dbscan import (
    cluster_labels,
    dbscan_anomalies,
    expanding_refit,
    noise_rate,
)
from barwatch.operators.kdistance import k_distance
from barwatch.session import materialize
from helpers import point_frame, row_number_of


def squares(x):
    total = np.zeros((len(x), len(x)))
    for c in range(x.shape[1]):
        total += (x[:, None, c] - x[None, :, c]) * (x[:, None, c] - x[None, :, c])
    return total


def naive_labels(x, eps, min_samples):
    """Clusters expanded in row order; -1 is noise."""
    near = squares(x) <= eps * eps
    core = near.sum(1) >= min_samples
    labels = np.full(len(x), -1)
    cluster = 0
    for start in range(len(x)):
        if not core[start] or labels[start] >= 0:
            continue
        labels[start] = cluster
        stack = [start]
        while stack:
            i = stack.pop()
            if core[i]:
                for j in np.nonzero(near[i])[0]:
                    if labels[j] < 0:
                        labels[j] = cluster
                        stack.append(j)
        cluster += 1
    return labels


def shapes():
    rng = np.random.default_rng(21)
    yield "blobs", np.concatenate(
        [rng.normal(0, 0.5, (400, 3)), rng.normal(3, 0.2, (150, 3)), rng.uniform(-6, 6, (150, 3))]
    )
    # Steps of exactly eps, so that neighbours sit on the limit and on cell borders.
    grid = np.array(list(itertools.product(range(4), repeat=3)), dtype=float) * 0.5
    yield "exact ties", np.concatenate([grid, grid[:20], grid[:5] + 7])
    yield "one hot place", np.concatenate(
        [np.zeros((500, 3)), rng.normal(0, 1e-9, (100, 3)), rng.uniform(-2, 2, (120, 3))]
    )
    ring = rng.uniform(0, 2 * np.pi, 500)
    yield "rings", np.concatenate(
        [np.c_[r * np.cos(ring), r * np.sin(ring), rng.normal(0, 0.05, 500)] for r in (2, 4)]
    )
    yield "sparse", rng.uniform(-10, 10, (200, 3))
    # Coordinates from -3 to 3: the largest lies exactly as far out as the smallest.
    yield "symmetric", np.concatenate([np.round(rng.normal(0, 0.7, (250, 3)) * 2) / 2, [[3, 3, 3], [-3, -3, -3]]])
    yield "far away", np.concatenate(
        [rng.uniform(0, 2, (250, 3)) + 1e9, rng.uniform(0, 2, (250, 3)) - 1e12, rng.normal(0, 0.3, (50, 3))]
    )


SHAPES = dict(shapes())


@pytest.mark.parametrize("shape", SHAPES)
def test_noise_and_labels_equal_the_naive_result(spark, shape):
    x = SHAPES[shape]
    params = DensityParams(eps=0.5, min_samples=7)
    points = materialize(point_frame(spark, x))
    want = naive_labels(x, params.eps, params.min_samples)
    noise = {row_number_of(r) for r in dbscan_anomalies(points, params).collect()}
    assert noise == set(np.nonzero(want == -1)[0])
    got = {row_number_of(r): r["cluster"] for r in cluster_labels(points, params).collect()}
    assert [got[i] for i in range(len(x))] == list(want)


@pytest.mark.parametrize("columns", [["ret_z"], ["ret_z", "vol_z"]])
def test_fewer_dimensions(spark, columns):
    rng = np.random.default_rng(77)
    x = np.round(rng.normal(0, 3, (600, 3)) * 4) / 4
    x[300:, : len(columns)] += rng.uniform(0, 20, (300, len(columns)))
    params = DensityParams(eps=0.25, min_samples=5)
    points = materialize(point_frame(spark, x))
    want = naive_labels(x[:, : len(columns)], 0.25, 5)
    got = {row_number_of(r): r["cluster"] for r in cluster_labels(points, params, columns).collect()}
    assert [got[i] for i in range(len(x))] == list(want)
    want_k = np.sqrt(np.sort(squares(x[:, : len(columns)]), axis=1)[:, 4])
    got_k = {row_number_of(r): r["k_distance"] for r in k_distance(points, 5, columns).collect()}
    np.testing.assert_array_equal([got_k[i] for i in range(len(x))], want_k)


def test_same_result_when_nothing_may_be_broadcast(spark, monkeypatch):
    for module in (dbscan_module, kdistance_module):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, max_rows=0: df)
    monkeypatch.setattr(dbscan_module, "is_small", lambda df, max_rows=0: False)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = SHAPES["blobs"]
        params = DensityParams(eps=0.5, min_samples=7)
        points = materialize(point_frame(spark, x))
        want = naive_labels(x, 0.5, 7)
        got = {row_number_of(r): r["cluster"] for r in cluster_labels(points, params).collect()}
        assert [got[i] for i in range(len(x))] == list(want)
        check_k_distance(spark, x, 7)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_open_cell_pairs_are_settled_by_halving(spark, monkeypatch):
    # Without the shortcut over outermost points every pair of cells has to be settled.
    def nothing_sure(dense, params, columns, real=dbscan_module._cell_pairs):
        sure, unsure = real(dense, params, columns)
        every = sure.join(dense.select(F.col("node").alias("a"), F.col("cell").alias("cell_a")), "a")
        every = every.join(
            dense.select(F.col("node").alias("b"), F.col("cell").alias("cell_b")), "b"
        )
        columns = ["a", "b", "cell_a", "cell_b"]
        both = materialize(every.select(*columns).unionByName(unsure.select(*columns)))
        return sure.limit(0), both

    monkeypatch.setattr(dbscan_module, "_cell_pairs", nothing_sure)
    x = SHAPES["rings"]
    points = materialize(point_frame(spark, x))
    got = {
        row_number_of(r): r["cluster"]
        for r in cluster_labels(points, DensityParams(eps=0.5, min_samples=7)).collect()
    }
    assert [got[i] for i in range(len(x))] == list(naive_labels(x, 0.5, 7))


def test_expanding_window_and_rate(spark):
    x = SHAPES["blobs"]
    params = DensityParams(eps=0.5, min_samples=7)
    split = F.when(F.dayofmonth("date") < 11, "train").when(F.dayofmonth("date") < 21, "val")
    points = materialize(point_frame(spark, x).withColumn("split", split.otherwise("test")))
    splits = np.array([r["split"] for r in points.orderBy("ticker", "date").collect()])
    for i, target in enumerate(("train", "val", "test")):
        used = np.isin(splits, ("train", "val", "test")[: i + 1])
        noise = np.nonzero(used)[0][naive_labels(x[used], 0.5, 7) == -1]
        want = {int(n) for n in noise if splits[n] == target}
        found = expanding_refit(points, target, params)
        assert {row_number_of(r) for r in found.collect()} == want
        assert found.columns == ["date", "ticker", "ret", "anomaly_flag", "cluster"]
        rate = noise_rate(points.filter(F.col("split") == target), found).first()
        assert rate["noise_rate"] == pytest.approx(len(want) / (splits == target).sum())


def test_no_points_raise(spark):
    with pytest.raises(ValueError):
        dbscan_anomalies(point_frame(spark, np.zeros((1, 3))).limit(0))


def check_k_distance(spark, x, k, **kwargs):
    rows = k_distance(materialize(point_frame(spark, x)), k, **kwargs).collect()
    want = np.sqrt(np.sort(squares(x), axis=1)[:, k - 1])
    got = np.full(len(x), np.nan)
    for r in rows:
        got[row_number_of(r)] = r["k_distance"]
    np.testing.assert_array_equal(got, want)
    distances = [r["k_distance"] for r in rows]
    assert distances == sorted(distances) and len(distances) == len(x)


@pytest.mark.parametrize("shape", SHAPES)
def test_k_distance_equals_brute_force(spark, shape):
    check_k_distance(spark, SHAPES[shape], 7, box_points=8)


@pytest.mark.parametrize("many", [1, 4, 20])
def test_k_distance_with_neighbours_in_chunks(spark, many):
    check_k_distance(spark, SHAPES["one hot place"], 7, box_points=8, chunk_boxes=many)
    check_k_distance(spark, SHAPES["blobs"], 7, box_points=8, chunk_boxes=many)


def test_outlier_facing_a_sphere(spark):
    rng = np.random.default_rng(31)
    ball = rng.normal(size=(3000, 3))
    ball /= np.linalg.norm(ball, axis=1)[:, None]
    check_k_distance(spark, np.concatenate([ball, [[0.0, 0, 0]]]), 7, box_points=8, chunk_boxes=200)


def test_one_far_value_leaves_no_crowded_box(spark):
    x = np.random.default_rng(32).normal(size=(1500, 3))
    x[7, 0] = 1e16
    check_k_distance(spark, x, 7)
    points = point_frame(spark, x).groupBy(*FEATURES).agg(F.count("*").alias("weight"))
    _, placed = kdistance_module._halve(points, FEATURES, 32)
    assert placed.groupBy("node").count().agg(F.max("count")).first()[0] <= 32
    assert placed.count() == 1500


@pytest.mark.parametrize("k", [1, 2, 7, 40])
def test_k_distance_for_other_k(spark, k):
    check_k_distance(spark, SHAPES["blobs"], k)


def test_k_distance_needs_k_points(spark):
    with pytest.raises(ValueError):
        k_distance(point_frame(spark, np.zeros((3, 3))), 7)
    check_k_distance(spark, np.zeros((7, 3)), 7)


def test_components_of_paths_stars_and_loners(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(201, 200)]
    nodes = sorted({n for e in edges for n in e} | {300, 301})
    node_frame = materialize(spark.createDataFrame([(n,) for n in nodes], "node long"))
    edge_frame = materialize(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in components(node_frame, edge_frame).collect()}
    assert got == {n: 0 if n <= 60 else 100 if n < 140 else 200 if n < 300 else n for n in nodes}


def test_numbering_is_consecutive_in_order(spark):
    values = [int(v) for v in np.random.default_rng(1).permutation(1000) * 3]
    frame = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    got = {r["v"]: r["n"] for r in numbered(frame, "v", "n").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_few_pairs_of_boxes_are_followed(spark, monkeypatch):
    met = []

    def counted(levels, k, columns, real=kdistance_module._near_leaves):
        near = real(levels, k, columns)
        met.append(near.count())
        return near

    monkeypatch.setattr(kdistance_module, "_near_leaves", counted)
    x = np.random.default_rng(33).uniform(0, 1, (4000, 3))
    check_k_distance(spark, x, 7)
    assert met[0] < len(x)


@pytest.mark.parametrize("bound", [0.01, 0.3, np.inf])
def test_smallest_distances_within_a_bound(bound):
    rng = np.random.default_rng(34)
    me, around = np.round(rng.uniform(0, 1, (40, 3)), 1), np.round(rng.uniform(0, 1, (300, 3)), 1)
    around[0] = np.inf
    sizes, found = kdistance_module.smallest(list(me.T), list(around.T), np.full(40, bound), 7)
    apart = np.sort(((me[:, None] - around) ** 2).sum(axis=2), axis=1)[:, :7]
    want = [row[row <= bound].tolist() for row in apart]
    assert sizes.tolist() == [len(w) for w in want]
    assert found.tolist() == pytest.approx([d for w in want for d in w], abs=0)
    few, all_infinite = kdistance_module.smallest([np.zeros(2)], [np.full(3, np.inf)], np.full(2, np.inf), 7)
    assert few.tolist() == [3, 3] and np.isinf(all_infinite).all()
