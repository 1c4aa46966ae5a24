"""Scaling, K-Means scoring, percentiles and silhouettes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barwatch.operators import kmeans
from barwatch.config import FEATURES
from barwatch.functions import quantiles
from barwatch.functions.quantiles import percentile_by_group
from barwatch.operators.kmeans import (
    cluster_thresholds,
    elbow_curve,
    fit_kmeans,
    kmeans_anomalies,
    nearest_centroid,
)
from barwatch.operators.prep import feature_points, scale_features, scaled_points, split_by_date
from barwatch.operators.silhouette import (
    selection_curves,
    silhouette_euclidean,
    silhouette_squared,
)
from helpers import day, feature_rows, point_frame


def test_feature_points_drop_incomplete_rows(spark):
    rows = [(day(0), "A", 0.1, 1.0, 2.0, 0.5), (day(1), "A", 0.1, None, 2.0, 0.5),
            (day(2), "A", None, 1.0, 2.0, 0.5), (day(3), "A", 0.1, 1.0, float("nan"), 0.5)]
    got = feature_points(feature_rows(spark, rows)).collect()
    assert sorted(r["date"] for r in got) == [day(0), day(2)]


def test_split_by_date_with_text_dates(spark):
    dates = ["2017-12-31", "2018-01-01", "2018-12-31", "2019-03-10", "2020-01-01", "2020-03-31",
             "2020-04-01"]
    frame = spark.createDataFrame([(d, "A") for d in dates], "date string, ticker string")
    got = {str(r["date"]): r["split"] for r in split_by_date(frame).collect()}
    assert got == {"2018-01-01": "train", "2018-12-31": "train", "2019-03-10": "val",
                   "2020-01-01": "test", "2020-03-31": "test"}


def test_scaling_uses_population_deviation_of_train_only(spark):
    frame = spark.createDataFrame(
        [("train", 1.0, 5.0), ("train", 3.0, 5.0), ("val", 5.0, 9.0)], "split string, a double, b double"
    )
    got = {(r["split"], r["a"], r["b"]) for r in scale_features(frame, ["a", "b"]).collect()}
    assert got == {("train", -1.0, 0.0), ("train", 1.0, 0.0), ("val", 3.0, 4.0)}


def test_scaled_points_have_zero_mean_on_train(spark):
    rng = np.random.default_rng(0)
    rows = [(dt.date(2018, 1, 1) + dt.timedelta(days=i), "A", 0.0, *map(float, rng.normal(3, 2, 3)))
            for i in range(500)]
    points = scaled_points(feature_rows(spark, rows))
    train = points.filter("split = 'train'").toPandas()[FEATURES]
    np.testing.assert_allclose(train.mean(), 0, atol=1e-9)
    np.testing.assert_allclose(train.std(ddof=0), 1, atol=1e-9)


def test_fit_finds_separate_groups_in_sorted_order(spark):
    rng = np.random.default_rng(21)
    groups = [rng.normal(c, 0.3, (40, 3)) for c in (-9.0, 0.0, 12.0)]
    points = point_frame(spark, rng.permutation(np.concatenate(groups)))
    centroids, inertia = fit_kmeans(points, 3)
    np.testing.assert_allclose(centroids, [g.mean(0) for g in groups])
    assert inertia == pytest.approx(sum(((g - g.mean(0)) ** 2).sum() for g in groups))
    with pytest.raises(ValueError):
        fit_kmeans(points.limit(0), 3)


def test_the_fit_does_not_depend_on_partitions_or_order(spark):
    rng = np.random.default_rng(31)
    points = point_frame(spark, rng.normal(size=(600, 3)) * [1, 2, 0.5])
    one, inertia = fit_kmeans(points.orderBy("ret_z").coalesce(1), 4)
    many, again = fit_kmeans(points.repartition(7), 4)
    np.testing.assert_allclose(one, many, rtol=1e-9)
    assert inertia == pytest.approx(again, rel=1e-12)
    # A fixed point: every centroid is the mean of the rows nearest to it.
    x = points.select(*FEATURES).toPandas().to_numpy()
    near = ((x[:, None] - np.array(one)[None]) ** 2).sum(axis=2).argmin(axis=1)
    np.testing.assert_allclose(one, [x[near == i].mean(axis=0) for i in range(4)], atol=0.05)
    other, _ = fit_kmeans(points, 4, seed=7)
    assert other == sorted(other)


def test_fits_of_few_different_rows(spark):
    x = np.array([[0.0, 0, 0]] * 20 + [[1.0, 0, 0]] * 5 + [[0, 2.0, 0]])
    centroids, inertia = fit_kmeans(point_frame(spark, x), 5)
    assert centroids == [(0.0, 0.0, 0.0), (0.0, 2.0, 0.0), (1.0, 0.0, 0.0)] and inertia == 0


def test_label_is_the_nearest_centroid(spark):
    rng = np.random.default_rng(3)
    xyz, centroids = rng.normal(size=(300, 3)), rng.normal(size=(4, 3))
    got = nearest_centroid(point_frame(spark, xyz), [tuple(map(float, c)) for c in centroids])
    got = got.orderBy("ticker", "date").toPandas()
    d = np.sqrt(((xyz[:, None] - centroids[None]) ** 2).sum(-1))
    assert list(got.cluster) == list(d.argmin(1))
    np.testing.assert_allclose(got.distance, d.min(1))


def scored(spark, distances, clusters, tickers=None):
    rows = [(day(i), (tickers or ["A"] * len(distances))[i], d, c)
            for i, (d, c) in enumerate(zip(distances, clusters))]
    return spark.createDataFrame(rows, "date date, ticker string, distance double, cluster int")


def test_thresholds_interpolate(spark):
    rng = np.random.default_rng(22)
    distances, clusters = rng.gamma(2, 1, 37), rng.integers(0, 3, 37)
    got = cluster_thresholds(scored(spark, distances.tolist(), clusters.tolist()), 83)
    assert {r["cluster"]: r["threshold"] for r in got.collect()} == {
        c: pytest.approx(np.percentile(distances[clusters == c], 83)) for c in range(3)
    }


# Whole, by brackets that are brought closer step by step, and with sketches too small for their margin.
@pytest.mark.parametrize("percent, sketch, settle_rows", [
    (0, 256, 40), (12.5, 8, 5), (50, 256, 40), (95, 4096, 200_000), (97.5, 256, 40), (100, 8, 5)])
def test_searched_percentiles_equal_numpy(spark, percent, sketch, settle_rows):
    rng = np.random.default_rng(5)
    groups = {0: rng.normal(size=4001), 1: np.repeat(3.25, 500), 2: np.array([7.0]),
              3: np.concatenate([np.repeat(1.0, 3000), rng.pareto(0.5, 1000), [1 + 1e-15]])}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "cluster int, distance double")
    got = percentile_by_group(frame, "cluster", "distance", percent, sketch, settle_rows)
    found = {r["cluster"]: r["threshold"] for r in got.collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g] == pytest.approx(np.percentile(values, percent), rel=1e-12)


def test_a_sketch_that_misses_is_noticed(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "margin", lambda sketch: 1e-9)
    rng = np.random.default_rng(6)
    values = rng.normal(size=20_000)
    frame = spark.createDataFrame([(0, float(v)) for v in values], "cluster int, distance double")
    got = percentile_by_group(frame, "cluster", "distance", 70, sketch=16).first()
    assert got["threshold"] == pytest.approx(np.percentile(values, 70), rel=1e-12)


def test_percentiles_of_nothing(spark):
    frame = spark.createDataFrame([(0, None)], "cluster int, distance double")
    assert percentile_by_group(frame, "cluster", "distance", 50).collect() == []


def test_detection_is_strict_and_skips_clusters_without_threshold(spark):
    rows = scored(spark, [0.7, 0.69, 0.71, 4.0, 1.5], [2, 2, 2, 7, 5], list("pqrst"))
    thresholds = spark.createDataFrame([(2, 0.7), (5, 1.25)], "cluster int, threshold double")
    got = kmeans_anomalies(rows, thresholds)
    assert sorted((r["ticker"], r["anomaly_flag"], r["distance"]) for r in got.collect()) == [
        ("r", 1, 0.71), ("t", 1, 1.5)
    ]
    empty = kmeans_anomalies(rows.limit(0), thresholds)
    assert empty.columns == ["date", "ticker", "anomaly_flag", "cluster", "distance"]


def test_train_flag_rate_matches_percentile(spark):
    rng = np.random.default_rng(8)
    points = point_frame(spark, rng.normal(size=(2000, 3)))
    centroids, _ = fit_kmeans(points, 3)
    train = nearest_centroid(points, centroids)
    flagged = kmeans_anomalies(train, cluster_thresholds(train, 95)).count()
    assert flagged / 2000 == pytest.approx(0.05, abs=0.005)


def by_pairs(x, labels, squared):
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    d = d if squared else np.sqrt(d)
    scores = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_silhouettes_equal_the_pairwise_definition(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, (150, 3)), rng.normal(4, 1, (100, 3)), [[50.0, 50, 50]]])
    labels = np.array([0] * 150 + [1] * 100 + [2])
    centroids = [(0.0, 0.0, 0.0), (4.0, 4.0, 4.0), (50.0, 50.0, 50.0)]
    frame = nearest_centroid(point_frame(spark, x), centroids)
    labels = frame.orderBy("ticker", "date").toPandas().cluster.to_numpy()
    assert silhouette_squared(frame).first()[0] == pytest.approx(by_pairs(x, labels, True))
    for block in (1000, 64):
        got = silhouette_euclidean(frame, block_rows=block).first()[0]
        assert got == pytest.approx(by_pairs(x, labels, False))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)
    expected = ClusteringEvaluator(predictionCol="cluster").evaluate(vectors)
    assert silhouette_squared(frame).first()[0] == pytest.approx(expected)


def test_selection_curves(spark):
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.2, (60, 3)) for c in (0, 5, 10)])
    curves = {r["k"]: r for r in selection_curves(point_frame(spark, x), range(2, 5)).collect()}
    assert set(curves) == {2, 3, 4}
    assert curves[2]["inertia"] > curves[3]["inertia"] > curves[4]["inertia"]
    assert max(curves, key=lambda k: curves[k]["silhouette"]) == 3
    elbow = elbow_curve(point_frame(spark, x), range(2, 4)).filter(F.col("k") == 3).first()
    assert elbow["inertia"] == pytest.approx(curves[3]["inertia"])


def test_fits_for_several_k_share_their_passes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    train = point_frame(spark, np.round(np.concatenate([rng.normal(c, 0.4, (300, 3)) for c in (0, 3, 7)]), 1)).repartition(5)
    train = train.localCheckpoint()
    alone = {k: kmeans.fit_kmeans(train, k) for k in (2, 3, 5)}
    drawn, calls = kmeans._drawn, []
    monkeypatch.setattr(kmeans, "_drawn", lambda *a: calls.append(1) or drawn(*a))
    together = kmeans.fit_each(train, (2, 3, 5))
    assert len(calls) == 1 + kmeans.DRAWS
    for k, (centroids, inertia) in alone.items():
        assert np.allclose(together[k][0], centroids, atol=1e-9) and together[k][1] == pytest.approx(inertia)


def test_of_equal_distances_the_first_centroid_takes_the_row():
    x = np.random.default_rng(2).integers(-3, 4, (3, 9001)).astype(float)
    some = [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (1.0, 1.0, 1.0), (-2.0, 0.0, 1.0)]
    place, least = kmeans._nearest(list(x), some)
    squares = np.stack([((x - np.array(c)[:, None]) ** 2).sum(axis=0) for c in some])
    assert np.array_equal(place, squares.argmin(axis=0)) and np.array_equal(least, squares.min(axis=0))
