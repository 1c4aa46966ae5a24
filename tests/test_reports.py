"""Market table, consensus, card, serving queries and evaluation tables."""

import datetime as dt

import numpy as np
import pytest

from barwatch.config import Period
from barwatch.operators import evaluation as ev
from barwatch.operators.consensus import consensus
from barwatch.operators.market import consensus_market, flag_rate, market_day_table
from barwatch.operators.reporting import (
    anomalies_on_date,
    daily_card,
    market_on_date,
    monthly_report,
)
from helpers import day, feature_rows

FLAGS = "date date, ticker string, anomaly_flag int"
RULE = ("date date, ticker string, anomaly_flag int, type string, ret double, ret_z double, "
        "vol_z double, range_pct double, why string")
KMEANS = "date date, ticker string, anomaly_flag int, cluster int, distance double"
DBSCAN = "date date, ticker string, ret double, anomaly_flag int, cluster int"


def flags(spark, keys):
    return spark.createDataFrame([(d, t, 1) for d, t in keys], FLAGS)


@pytest.fixture
def features(spark):
    rows = [
        (day(0), "A", None, None, None, None), (day(0), "B", None, None, None, None),
        (day(1), "A", 0.1, 1.0, 1.0, 0.5), (day(1), "B", -0.3, 1.0, 1.0, 0.5),
        (day(2), "A", 0.2, 1.0, 1.0, 0.5), (day(2), "B", None, 1.0, 1.0, 0.5),
        (dt.date(2020, 2, 3), "C", 0.0, 3.0, 1.0, 0.5),
    ]
    return feature_rows(spark, rows)


def test_market_day_table(spark, features):
    flagged = flags(spark, [(day(1), "A"), (day(1), "A"), (day(1), "B"), (dt.date(1999, 1, 1), "A")])
    got = {r["date"]: r for r in market_day_table(features, flagged).collect()}
    assert set(got) == {day(0), day(1), day(2), dt.date(2020, 2, 3)}
    assert got[day(0)][1:] == (0.0, 0.0, 0.0, 0)
    assert got[day(1)]["market_ret"] == pytest.approx(-0.1)
    assert got[day(1)]["breadth"] == 0.5
    assert got[day(1)]["flag_rate"] == pytest.approx(2 / 3)
    assert got[day(1)]["market_anomaly_flag"] == 1
    # A missing return is left out of the mean but stays in the denominator of the breadth.
    assert got[day(2)]["market_ret"] == pytest.approx(0.2) and got[day(2)]["breadth"] == 0.5


def test_stress_flag_is_strict(spark, features):
    flagged = flags(spark, [(day(1), "A")])
    at_limit = market_day_table(features, flagged, flag_thresh=1 / 3)
    assert at_limit.agg({"market_anomaly_flag": "max"}).first()[0] == 0


def test_consensus_market_keeps_days_of_any_part(spark, features):
    kmeans = flags(spark, [(day(1), "A")])
    dbscan = spark.createDataFrame([(day(2), "A", 0.2, 1, -1), (day(2), "B", 0.4, 1, -1)], DBSCAN)
    period = Period(day(0), day(2))
    got = {r["date"]: r for r in consensus_market(features, kmeans, dbscan, period).collect()}
    assert set(got) == {day(0), day(1), day(2)}
    assert got[day(1)]["flag_rate"] == pytest.approx(1 / 3) and got[day(1)]["r_mkt"] is None
    assert got[day(2)]["r_mkt"] == pytest.approx(0.3) and got[day(2)]["flag_rate"] is None
    assert flag_rate(kmeans, features).count() == 1


def test_consensus_counts(spark):
    # 37 K-Means points of which 8 are also density noise, as in the published run.
    points = [(day(i), f"T{i % 7}") for i in range(37)]
    table = consensus(flags(spark, points), flags(spark, points[:8]))
    got = table.agg({"union_flag": "sum", "intersection_flag": "sum", "kmeans_flag": "sum"}).first()
    assert table.count() == 37
    assert (got["sum(union_flag)"], got["sum(intersection_flag)"]) == (37, 8)
    only = consensus(flags(spark, []), flags(spark, points[:1])).first()
    assert only[2:] == (0, 1, 1, 0)


@pytest.fixture
def found(spark):
    rule = spark.createDataFrame(
        [(day(1), "A", 1, "crash", 9.9, 9.9, 9.9, 9.9, "|ret_z| > 2.5"),
         (day(2), "A", 1, "", 9.9, 9.9, 9.9, 9.9, "range_pct > 0.95"),
         (dt.date(2020, 2, 3), "C", 1, "spike", 9.9, 9.9, 9.9, 9.9, "|ret_z| > 2.5")], RULE)
    kmeans = spark.createDataFrame([(day(1), "A", 1, 0, 2.5), (day(1), "B", 1, 0, 9.0)], KMEANS)
    dbscan = spark.createDataFrame([(day(2), "A", 0.2, 1, -1), (day(2), "B", 0.2, 1, -1)], DBSCAN)
    return {"rule": rule, "kmeans": kmeans, "dbscan": dbscan}


def test_card_takes_values_from_features_and_drops_learned_only(features, found):
    card = daily_card(features, **found)
    assert card.columns == ["date", "ticker", "anomaly_flag", "type", "why", "ret", "ret_z", "vol_z",
                            "range_pct", "distance", "dbscan_flag"]
    got = {(r["date"], r["ticker"]): r for r in card.collect()}
    assert set(got) == {(day(1), "A"), (day(2), "A"), (dt.date(2020, 2, 3), "C")}
    first = got[day(1), "A"]
    assert (first["ret"], first["distance"], first["dbscan_flag"]) == (0.1, 2.5, 0)
    second = got[day(2), "A"]
    assert (second["distance"], second["dbscan_flag"], second["type"]) == (None, 1, "")


def test_card_without_distance_and_without_rule_rows(features, found):
    found["kmeans"] = found["kmeans"].drop("distance")
    assert "distance" not in daily_card(features, **found).columns
    found["rule"] = found["rule"].limit(0)
    assert daily_card(features, **found).count() == 0


def test_serving_queries(features, found):
    card = daily_card(features, **found)
    market = market_day_table(features, card)
    status = market_on_date(market, day(1)).collect()
    assert len(status) == 1 and status[0]["flag_rate"] == pytest.approx(1 / 3)
    listed = anomalies_on_date(card, day(1))
    assert listed.columns == ["ticker", "type", "ret_z", "vol_z", "why"]
    assert [r["ticker"] for r in listed.collect()] == ["A"]
    report = monthly_report(card, market, "2020-01")
    assert report.columns == ["date", "ticker", "type", "ret_z", "vol_z", "market_anomaly_flag", "why"]
    assert [(r["date"], r["market_anomaly_flag"]) for r in report.collect()] == [(day(1), 1), (day(2), 1)]
    empty = monthly_report(card, market, "2021-12")
    assert empty.columns == report.columns and empty.count() == 0


def dates(spark, numbers, ticker="A"):
    return flags(spark, [(day(n), ticker) for n in numbers])


def test_overlaps_as_published(spark):
    # 43 rule dates, 22 K-Means dates, 19 common; 6 dates by all three.
    rule, kmeans = dates(spark, range(43)), dates(spark, range(24, 46))
    twice = rule.unionByName(dates(spark, range(43), "B"))
    assert tuple(ev.overlap_dates(twice, kmeans).first()) == (24, 3, 19)
    dbscan = dates(spark, [*range(30, 36), 44, 45])
    three = ev.detector_dates({"rule": rule, "kmeans": kmeans, "dbscan": dbscan}).first()
    assert tuple(three) == (43, 22, 8, 6)


def test_detector_dates_per_group(spark):
    a = dates(spark, [0, 1]).withColumn("split", ev.F.lit("val"))
    b = dates(spark, [1, 2]).withColumn("split", ev.F.lit("val"))
    got = ev.detector_dates({"rule": a, "kmeans": b}, by=["split"]).collect()
    assert [tuple(r) for r in got] == [("val", 2, 2, 1)]


def test_counts_rate_and_summary(spark):
    frame = flags(spark, [(day(2), "B"), (day(0), "B"), (day(0), "A"), (day(0), "C")])
    assert [tuple(r) for r in ev.daily_counts(frame).collect()] == [(day(0), 3), (day(2), 1)]
    assert [tuple(r) for r in ev.ticker_counts(frame).collect()] == [("B", 2), ("A", 1), ("C", 1)]
    assert tuple(ev.anomaly_summary(frame).first()) == (4, 2, 3, 2.0)
    assert ev.unique_dates(frame).first()[0] == 2
    days = spark.createDataFrame([(day(i),) for i in range(8)], "date date")
    assert tuple(ev.anomaly_rate(frame, days).first()) == (2, 8, 0.25)
    assert ev.anomaly_rate(frame, days.limit(0)).first()["anomaly_rate"] is None
    assert tuple(ev.anomaly_summary(frame.limit(0)).first()) == (0, 0, 0, None)


@pytest.mark.parametrize("table", [ev.unique_dates, ev.daily_counts, ev.ticker_counts, ev.anomaly_summary])
def test_anomaly_tables_need_their_columns(spark, table):
    with pytest.raises(ValueError, match="anomaly_flag"):
        table(flags(spark, [(day(0), "A")]).drop("anomaly_flag"))


def test_counts_and_rates_by_detector(spark):
    detectors = {"rule": dates(spark, [0, 0, 1]), "kmeans": dates(spark, [1]), "dbscan": dates(spark, [])}
    got = sorted(tuple(r) for r in ev.detector_daily_counts(detectors).collect())
    assert got == [(day(0), 2, 0, 0), (day(1), 1, 1, 0)]
    points = dates(spark, range(10))
    rates = {r["detector"]: (r["flagged"], r["points"], r["flag_rate_pct"])
             for r in ev.point_flag_rates(detectors, points).collect()}
    assert rates == {"rule": (3, 10, 30.0), "kmeans": (1, 10, 10.0), "dbscan": (0, 10, 0.0)}


def test_type_counts(spark):
    frame = spark.createDataFrame([("crash",), ("",), ("",)], "type string")
    assert [tuple(r) for r in ev.type_counts(frame).collect()] == [("", 2), ("crash", 1)]


def test_distributions_agree_with_numpy(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=500), rng.normal(size=500)
    rows = [(float(a), None if i % 10 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "x double, y double")
    counts, edges = np.histogram(x, bins=50)
    got = {r["bin"]: r for r in ev.histogram(frame, ["x"], density=True).collect()}
    assert {b: r["points"] for b, r in got.items()} == dict(enumerate(counts))
    density = np.histogram(x, bins=50, density=True)[0]
    for b, r in got.items():
        assert r["bin_start"] == pytest.approx(edges[b]) and r["density"] == pytest.approx(density[b])

    known = np.array([i % 10 != 0 for i in range(500)])
    corr = {(r["a"], r["b"]): r["corr"] for r in ev.correlation(frame, ["x", "y"]).collect()}
    assert corr["x", "y"] == corr["y", "x"] == pytest.approx(np.corrcoef(x[known], y[known])[0, 1])
    assert corr["x", "x"] == pytest.approx(1)
    shares = {r["column"]: r["null_share"] for r in ev.null_share(frame, ["x", "y"]).collect()}
    assert shares == {"x": 0.0, "y": 0.1}


def test_histogram_per_group_and_of_a_constant(spark):
    frame = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 10.0), ("c", 5.0)], "split string, v double")
    got = ev.histogram(frame, ["v"], bins=10, by="split", groups=["a", "b"]).collect()
    values = {"a": [1.0, 1.0], "b": [0.0, 10.0]}
    want = [(name, i, c) for name, some in values.items() for i, c in enumerate(np.histogram(some, bins=10)[0])]
    assert sorted((r["split"], r["bin"], r["points"]) for r in got) == want


def test_slices_and_preview(features):
    assert ev.of_ticker(features, "A").count() == 3
    assert ev.in_period(features, Period(day(1), day(2))).count() == 4
    assert [(r["date"], r["ticker"]) for r in ev.preview(features, 2).collect()] == [
        (day(0), "A"), (day(0), "B")]
