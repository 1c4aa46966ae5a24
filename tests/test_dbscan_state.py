"""Points added to a stored grid state against clustering them all at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import barwatch.operators.dbscan_state as module
from barwatch.config import DensityParams
from barwatch.operators.dbscan import dbscan_anomalies
from barwatch.operators.dbscan_state import _points_in, add_points
from helpers import point_frame, row_number_of
from test_density import naive_labels, shapes, squares


@pytest.mark.parametrize("name, x", list(shapes()))
@pytest.mark.parametrize("cuts", [(0.5,), (0.1, 0.15, 0.9)])
def test_additions_equal_brute_force(spark, name, x, cuts, monkeypatch):
    monkeypatch.setattr(module, "SLICE_POINTS", 16)
    params = DensityParams(eps=0.7, min_samples=7)
    order = np.random.default_rng(2).permutation(len(x))
    ends = [0, *[int(c * len(x)) for c in cuts], len(x)]
    frame = point_frame(spark, x)
    number = F.substring("ticker", 2, 9).cast("int") * 1000 + F.datediff("date", F.lit("2020-01-01"))
    state = None
    for begin, end in zip(ends, ends[1:]):
        some, known = order[begin:end].tolist(), sorted(order[:end].tolist())
        state, noise = add_points(frame.filter(number.isin(some)), state, params)
        labels = dict(zip(known, naive_labels(x[known], params.eps, params.min_samples)))
        assert sorted(map(row_number_of, noise.collect())) == sorted(i for i in some if labels[i] == -1)
        near = squares(x[known]) <= params.eps**2
        degree = dict(zip(known, near.sum(axis=1).tolist()))
        for r in state.sparse.collect():
            assert r["degree"] == degree[row_number_of(r)]
    assert state.cells.agg(F.sum("n")).first()[0] == len(x)


def test_old_points_become_core_and_cells_dense(spark):
    params = DensityParams(eps=1.0, min_samples=3)
    first = np.array([[0.0, 0, 0], [0.9, 0, 0], [5, 5, 5]])
    state, noise = add_points(point_frame(spark, first), None, params)
    assert noise.count() == 3
    # (0, 0, 0) gets its third neighbour; the point added at -0.9 is no noise because of it.
    second = point_frame(spark, np.concatenate([first, [[-0.9, 0, 0], [9, 9, 9], [5, 5, 5], [5, 5, 5]]]))
    state, noise = add_points(second.filter("date > '2020-01-03'"), state, params)
    assert [row_number_of(r) for r in noise.collect()] == [4]
    assert state.cells.filter("dense").count() == 1


def test_empty_additions(spark):
    frame = point_frame(spark, np.zeros((9, 3)))
    with pytest.raises(ValueError):
        add_points(frame.filter("false"))
    state, noise = add_points(frame)
    assert noise.count() == 0
    same, none = add_points(frame.filter("false"), state)
    assert same is state and none.count() == 0


def test_only_buckets_of_open_cells_are_read(spark):
    rng = np.random.default_rng(4)
    frame = point_frame(spark, rng.uniform(-20, 20, (2000, 3)))
    state, noise = add_points(frame, None, DensityParams(eps=2.0, min_samples=7))
    assert noise.count() == dbscan_anomalies(frame, DensityParams(eps=2.0, min_samples=7)).count()
    read = _points_in(spark, state.parts, state.cells.limit(1).select("cell"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket" in plan.split("PartitionFilters")[1][:80]
    assert read.count() == state.cells.limit(1).first()["n"]
