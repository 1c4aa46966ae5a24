"""Whole jobs and the shape of their plans."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwatch.__main__ import main
from barwatch.config import FEATURES
from barwatch.operators.features import compute_features
from barwatch.operators.kmeans import kmeans_anomalies, nearest_centroid
from barwatch.operators.market import market_day_table
from barwatch.operators.prep import scaled_points
from barwatch.operators.reporting import daily_card
from barwatch.operators.rules import rule_anomalies
from barwatch.plans.detect import run_detection
from barwatch.plans.serving import build_serving_tables, query_date, query_month
from barwatch.session import drop_intermediate, materialize, own_folder, shared_dir
from barwatch.sources.panel import bars_from_lineitem
from barwatch.sources.tables import read_table, write_table
from helpers import bars


def market_bars(spark, tickers=7, faulty=True):
    rng = np.random.default_rng(99)
    first, last = dt.date(2017, 7, 3), dt.date(2020, 3, 31)
    rows = []
    for t in range(tickers):
        price = 100.0
        date = first
        while date <= last:
            if date.weekday() < 5:
                wild = 4.0 if date >= dt.date(2020, 2, 20) else 1.0
                price *= float(np.exp(rng.normal(0, 0.01 * wild)))
                high, low = price * (1 + 0.01 * wild * rng.random()), price * (1 - 0.01 * wild * rng.random())
                volume = float(int(np.exp(rng.normal(12, 0.2 * wild))))
                if faulty and rng.random() < 0.002:
                    volume = -volume
                rows.append((f"T{t}", date, price, high, low, price, price, volume))
            date += dt.timedelta(days=1)
    return bars(spark, rows)


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    paths = run_detection(market_bars(spark), out)
    paths.update(build_serving_tables(spark, out))
    return out, paths


def test_detection_writes_all_tables(spark, served):
    _, paths = served
    tables = {name: read_table(spark, path) for name, path in paths.items()}
    assert tables["features"].count() > 4000
    test_days = F.col("date").between("2020-01-01", "2020-03-31")
    for name in ("anomalies_rule_test", "anomalies_kmeans_test", "anomalies_dbscan_test"):
        table = tables[name]
        assert table.count() > 0 and table.filter(~test_days).count() == 0
    card = tables["daily_anomaly_card"]
    assert card.count() == tables["anomalies_rule_test"].count()
    assert card.filter("type is null").count() == 0
    market = tables["market_day_table"]
    assert market.count() == tables["features"].select("date").distinct().count()
    stressed = market.filter("market_anomaly_flag = 1").select("date")
    assert stressed.exceptAll(card.select("date").distinct()).count() == 0


def test_queries_on_the_served_tables(spark, served):
    out, _ = served
    month = query_month(spark, out, "2020-03")
    rows = month.collect()
    assert rows and [(r["date"], r["ticker"]) for r in rows] == sorted((r["date"], r["ticker"]) for r in rows)
    date = rows[0]["date"]
    market, flagged = query_date(spark, out, date)
    assert market.count() == 1
    assert flagged.count() == sum(r["date"] == date for r in rows)
    assert query_month(spark, out, "2019-05").count() == 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_served_queries_read_one_month_of_the_card_only(spark, served):
    out, _ = served
    for df in (query_date(spark, out, dt.date(2020, 3, 2))[1], query_month(spark, out, "2020-03")):
        scans = [line for line in plan(df).splitlines() if "FileScan" in line and "daily" in line]
        assert scans and all("month" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    market = plan(query_date(spark, out, dt.date(2020, 3, 2))[0])
    assert "EqualTo(date,2020-03-02)" in market or "GreaterThanOrEqual(date,2020-03-02)" in market


def test_features_need_one_exchange_and_one_sort(spark):
    text = plan(compute_features(market_bars(spark, 1)))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_bars_from_items_read_four_columns_and_combine_before_the_shuffle(spark, tmp_path):
    items = spark.range(10).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_suppkey"), F.lit(1.0).alias("l_tax"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.5).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), F.to_date(F.lit("2020-01-01")).alias("l_shipdate"))
    write_table(items, str(tmp_path / "items"), by_month=False)
    df = bars_from_lineitem(read_table(spark, str(tmp_path / "items")))
    text = plan(df)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:date>" in text
    assert "partial_max" in text
    assert df.first()["close"] == 100.0035


def test_no_cross_joins_and_no_python_in_the_plans(spark):
    features = compute_features(market_bars(spark, 2))
    points = scaled_points(features)
    scored = nearest_centroid(points, [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)])
    thresholds = spark.createDataFrame([(0, 1.0), (1, 1.0)], "cluster int, threshold double")
    far = kmeans_anomalies(scored, thresholds)
    rule = rule_anomalies(features)
    for df in (far, market_day_table(features, rule), daily_card(features, rule, far, far)):
        text = plan(df)
        assert not any(w in text for w in ("Cartesian", "NestedLoop", "Python", "Pandas", "Arrow"))
    assert "BroadcastHashJoin" in plan(far)
    assert points.columns == ["date", "ticker", "ret", *FEATURES, "split"]


def test_card_and_points_skip_other_months(spark, served):
    out, _ = served
    features, rule, far, noise = (
        read_table(spark, f"{out}/{name}")
        for name in ("features", "anomalies_rule_test", "anomalies_kmeans_test", "anomalies_dbscan_test")
    )
    for df in (daily_card(features, rule, far, noise), scaled_points(features)):
        scans = [line for line in plan(df).splitlines() if "FileScan" in line and "range_pct" in line]
        assert scans and all(
            "month" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans
        )


def test_commands(spark, served, tmp_path, capsys):
    out, _ = served
    main(["--tables", out, "walkforward"])
    main(["--tables", out, "monthly", "--month", "2019-05"])
    assert "No anomalies found for month 2019-05" in capsys.readouterr().out
    main(["--tables", out, "monthly", "--month", "2020-03"])
    assert "market_anomaly_flag" in capsys.readouterr().out
    main(["--tables", out, "query", "--date", "2020-03-02", "--out", str(tmp_path / "day")])
    assert "breadth" in capsys.readouterr().out
    assert spark.read.csv(str(tmp_path / "day"), header=True).columns == [
        "ticker", "type", "ret_z", "vol_z", "why"]


def test_intermediate_tables_can_be_dropped(spark):
    kept = spark.range(3).select(F.col("id").alias("v"))
    table = materialize(kept)
    assert table.count() == 3
    folder = own_folder(spark).removeprefix("file:")
    assert os.path.isdir(folder) and spark.sparkContext.applicationId in folder
    drop_intermediate(spark)
    assert not os.path.exists(folder)


def test_a_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_detection_from_csv_files(spark, tmp_path):
    raw = market_bars(spark, 2).withColumnRenamed("adj_close", "Adj Close")
    raw.write.partitionBy("ticker").csv(str(tmp_path / "bars"), header=True)
    main(["--tables", str(tmp_path / "tables"), "detect", "--bars", str(tmp_path / "bars")])
    assert read_table(spark, str(tmp_path / "tables" / "features")).count() > 1000
