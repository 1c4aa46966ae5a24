"""One query per operator, over bars derived from the whole line-item table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barwatch.config import FEATURES, Period, Splits, year
from barwatch.functions.quantiles import percentile_by_group
from barwatch.operators import evaluation, market, quality, reporting
from barwatch.operators.consensus import consensus
from barwatch.operators.dbscan import cluster_labels, expanding_refit, noise_rate
from barwatch.operators.dbscan_state import expanding_additions
from barwatch.operators.features import compute_features, eda_columns
from barwatch.operators.kdistance import k_distance
from barwatch.operators.kmeans import cluster_thresholds, fit_each, fit_kmeans, nearest_centroid
from barwatch.operators.prep import scaled_points
from barwatch.operators.rules import rule_anomalies
from barwatch.operators.silhouette import (
    selection_curves,
    silhouette_euclidean,
    silhouette_squared,
)
from barwatch.plans.detect import (
    DBSCAN_TABLE,
    FEATURES_TABLE,
    KMEANS_TABLE,
    RULE_TABLE,
    kmeans_split_anomalies,
)
from barwatch.plans.serving import build_serving_tables, query_date, query_month
from barwatch.session import materialize, new_folder
from barwatch.sources.bars_csv import read_bars
from barwatch.sources.panel import NARROW, WIDE, read_panel
from barwatch.sources.tables import read_table, within, write_table

# Parameters shared with the SQL of the oracle.
SPLITS = Splits(year(1998), year(1999), Period(dt.date(2000, 1, 1), dt.date(2000, 3, 31)))
CENTROIDS = [(0.0, 0.0, -1.0), (0.0, 0.0, 1.0), (2.0, 0.0, 1.0)]
DAY = dt.date(2000, 2, 17)
MONTH = "2000-02"
MONTH_BEFORE = "1999-11"
ONE_TICKER = "S7"
# End of fixed values.

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its name; doubles come out rounded to 6 places."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, halves away from zero, so that two engines' last bits compare equal.

    Plain arithmetic: ``round`` goes through a decimal object per value and dominates big results.
    """

    def places(name: str) -> Column:
        value = F.col(name)
        steps = F.floor(F.abs(value) * 1e6 + 0.5) / 1e6
        return F.when(value < 0, -steps).otherwise(steps) + 0.0

    return df.select(
        *[
            places(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name
            for f in df.schema
        ]
    )


def _features(spark: SparkSession, sf_dir: str, panel: str = WIDE) -> DataFrame:
    return compute_features(read_panel(spark, sf_dir, panel))


def _stored_features(spark: SparkSession, sf_dir: str, panel: str = WIDE) -> DataFrame:
    return materialize(_features(spark, sf_dir, panel))


def _split_features(spark: SparkSession, sf_dir: str, panel: str = WIDE) -> DataFrame:
    """Stored features of all dates the splits cover; their windows reach back before that."""
    found = _features(spark, sf_dir, panel)
    return materialize(within(found, SPLITS.train.first, SPLITS.test.last))


def _points(spark: SparkSession, sf_dir: str, panel: str = WIDE) -> DataFrame:
    return scaled_points(_split_features(spark, sf_dir, panel), SPLITS)


def _stored_points(spark: SparkSession, sf_dir: str, panel: str = WIDE) -> DataFrame:
    return materialize(_points(spark, sf_dir, panel))


def _train(points: DataFrame) -> DataFrame:
    return points.filter("split = 'train'")


def _detectors(features: DataFrame, split: str = "test") -> dict[str, DataFrame]:
    """Anomalies of one split by all three detectors, K-Means with the fixed centroids."""
    points = materialize(scaled_points(features, SPLITS))
    period = dict(SPLITS.items())[split]
    return {
        "rule": evaluation.in_period(rule_anomalies(features), period),
        "kmeans": kmeans_split_anomalies(points, split, CENTROIDS),
        "dbscan": expanding_refit(points, split),
    }


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with faults put in by day of the month: negative volume, high and low out of line."""
    bars = read_panel(spark, sf_dir)
    day = F.dayofmonth("date")
    return bars.select(
        "ticker",
        "date",
        "open",
        F.when(day == 17, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        F.when(day == 19, F.col("high") + 1).otherwise(F.col("low")).alias("low"),
        "close",
        "adj_close",
        F.when(day.isin(13, 17), -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
    )


# Sources and sinks


@query
def bars(spark, sf_dir):
    return read_panel(spark, sf_dir)


@query
def bars_narrow(spark, sf_dir):
    return read_panel(spark, sf_dir, NARROW)


@query
def csv_bars(spark, sf_dir):
    """Bars written as CSV, one folder per ticker, and loaded again by the CSV source."""
    path = new_folder(spark)
    raw = read_panel(spark, sf_dir, NARROW).withColumnRenamed("adj_close", "Adj Close")
    raw.hint("rebalance", "ticker").write.partitionBy("ticker").csv(path, header=True)
    return read_bars(spark, path)


@query
def stored_month(spark, sf_dir):
    """One month of the features table as stored by month."""
    path = new_folder(spark)
    write_table(_features(spark, sf_dir), path)
    return read_table(spark, path).filter(F.col("month") == MONTH)


# Data quality


@query
def quality_issues(spark, sf_dir):
    return quality.issues(_dirty(spark, sf_dir))


@query
def quality_clean(spark, sf_dir):
    return quality.clean(_dirty(spark, sf_dir))


@query
def quality_drop_listed(spark, sf_dir):
    dirty = _dirty(spark, sf_dir)
    return quality.drop_listed(dirty, quality.issues(dirty))


@query
def quality_gate(spark, sf_dir):
    cleaned, _ = quality.quality_gate(materialize(_dirty(spark, sf_dir)))
    return cleaned


@query
def quality_report(spark, sf_dir):
    return quality.report(_dirty(spark, sf_dir))


@query
def reason_counts(spark, sf_dir):
    return quality.reason_counts(_dirty(spark, sf_dir))


@query
def duplicate_bars(spark, sf_dir):
    dirty = _dirty(spark, sf_dir)
    return quality.duplicates(dirty.unionByName(dirty.filter(F.dayofmonth("date") == 23)))


@query
def out_of_order_bars(spark, sf_dir):
    """Bars of the 11th arrive behind those of the next two days."""
    late = F.when(F.dayofmonth("date") == 11, 5).otherwise(0)
    placed = read_panel(spark, sf_dir).withColumn("place", F.unix_date("date") * 2 + late)
    return quality.out_of_order(placed, "place", F.floor(F.col("place") / 500))


@query
def missing_tickers(spark, sf_dir):
    """Every supplier's ticker and as many beyond the keys are looked for among all bars."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    keys = suppliers.select(F.explode(F.array("s_suppkey", F.col("s_suppkey") * 2 + 1)).alias("key"))
    expected = keys.select(F.concat(F.lit("S"), "key").alias("ticker")).distinct()
    return quality.missing_tickers(read_panel(spark, sf_dir), expected)


# Features


@query
def features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def features_narrow(spark, sf_dir):
    return _features(spark, sf_dir, NARROW)


@query
def features_pieces(spark, sf_dir):
    """The same features with every history cut into pieces of 100 rows."""
    return compute_features(read_panel(spark, sf_dir), piece_rows=100)


@query
def eda(spark, sf_dir):
    return eda_columns(read_panel(spark, sf_dir))


# Rules


@query
def rule_flags(spark, sf_dir):
    return rule_anomalies(_features(spark, sf_dir))


@query
def rule_flags_narrow(spark, sf_dir):
    return rule_anomalies(_features(spark, sf_dir, NARROW))


@query
def type_counts(spark, sf_dir):
    return evaluation.type_counts(rule_anomalies(_features(spark, sf_dir, NARROW)))


# Points and K-Means


@query
def scaled_features(spark, sf_dir):
    return _points(spark, sf_dir)


@query
def kmeans_scores(spark, sf_dir):
    scored = nearest_centroid(_points(spark, sf_dir), CENTROIDS)
    return scored.select("date", "ticker", "split", "cluster", "distance")


@query
def kmeans_thresholds(spark, sf_dir):
    scored = nearest_centroid(_train(_stored_points(spark, sf_dir)), CENTROIDS)
    return cluster_thresholds(scored)


@query
def kmeans_thresholds_searched(spark, sf_dir):
    """The same thresholds by brackets brought closer step by step, as for clusters too large to rank what one bracket holds."""
    scored = nearest_centroid(_train(_stored_points(spark, sf_dir)), CENTROIDS)
    return percentile_by_group(scored, "cluster", "distance", 97.5, sketch=512, settle_rows=100)


@query
def kmeans_fixed(spark, sf_dir):
    return kmeans_split_anomalies(_stored_points(spark, sf_dir), "val", CENTROIDS)


@query
def kmeans_fitted(spark, sf_dir):
    points = _stored_points(spark, sf_dir)
    centroids, _ = fit_kmeans(_train(points))
    return kmeans_split_anomalies(points, "test", centroids)


@query
def kmeans_selection(spark, sf_dir):
    """Inertia and silhouette for every candidate number of clusters."""
    return selection_curves(_train(_stored_points(spark, sf_dir)))


@query
def kmeans_fit_check(spark, sf_dir):
    """What holds at every optimum, for every candidate number of clusters.

    Where centroids are the means of their rows, the squares of the points split into those within
    clusters and those of the centroids. ``spread`` takes the former from the rows' distances,
    ``spread_fit`` from the fit; both are per point, to 2 places, as the fit ends within a tolerance.
    """
    train = _train(_stored_points(spark, sf_dir))
    parts = []
    for k, (centroids, inertia) in fit_each(train).items():
        squares = F.array(*[F.lit(sum(x * x for x in c)) for c in centroids])
        around = F.sum(F.element_at(squares, F.col("cluster") + 1))
        points = F.count("*")
        parts.append(
            nearest_centroid(train, centroids).agg(
                F.lit(k).alias("k"),
                F.countDistinct("cluster").alias("clusters"),
                points.alias("points"),
                F.round((F.sum(F.col("distance") * F.col("distance")) + around) / points, 2).alias("spread"),
                F.round((F.lit(inertia) + around) / points, 2).alias("spread_fit"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def silhouette_linear(spark, sf_dir):
    scored = nearest_centroid(_train(_stored_points(spark, sf_dir)), CENTROIDS)
    return silhouette_squared(scored)


@query
def silhouette_pairwise(spark, sf_dir):
    """Euclidean silhouette. Quadratic by definition, hence on the panel the calendar bounds."""
    scored = nearest_centroid(_train(_stored_points(spark, sf_dir, NARROW)), CENTROIDS)
    return silhouette_euclidean(scored)


# DBSCAN


@query
def dbscan_noise_train(spark, sf_dir):
    return expanding_refit(_stored_points(spark, sf_dir), "train")


@query
def dbscan_noise_val(spark, sf_dir):
    return expanding_refit(_stored_points(spark, sf_dir), "val")


@query
def dbscan_noise_test(spark, sf_dir):
    return expanding_refit(_stored_points(spark, sf_dir), "test")


@query
def dbscan_added_val(spark, sf_dir):
    """Noise of the validation split, added to the stored state of the training split."""
    return expanding_additions(_stored_points(spark, sf_dir), "val")


@query
def dbscan_added_test(spark, sf_dir):
    return expanding_additions(_stored_points(spark, sf_dir), "test")


@query
def dbscan_noise_rate(spark, sf_dir):
    points = _stored_points(spark, sf_dir)
    return noise_rate(_train(points), expanding_refit(points, "train"))


@query
def dbscan_labels(spark, sf_dir):
    return cluster_labels(_train(_stored_points(spark, sf_dir)))


@query
def dbscan_labels_narrow(spark, sf_dir):
    return cluster_labels(_train(_stored_points(spark, sf_dir, NARROW)))


@query
def k_distances(spark, sf_dir):
    return k_distance(_train(_stored_points(spark, sf_dir)))


# Reporting, market and consensus


@query
def daily_card(spark, sf_dir):
    features = _split_features(spark, sf_dir)
    return reporting.daily_card(features, **_detectors(features))


@query
def daily_card_narrow(spark, sf_dir):
    features = _split_features(spark, sf_dir, NARROW)
    return reporting.daily_card(features, **_detectors(features))


@query
def market_days(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    return market.market_day_table(features, rule_anomalies(features))


def _served(spark: SparkSession, sf_dir: str) -> str:
    """Folder with detection results on the test split and the serving tables built from them."""
    out = new_folder(spark)
    features = _stored_features(spark, sf_dir)
    found = _detectors(features)
    write_table(features, f"{out}/{FEATURES_TABLE}")
    for name, table in (
        (RULE_TABLE, found["rule"]),
        (KMEANS_TABLE, found["kmeans"]),
        (DBSCAN_TABLE, found["dbscan"]),
    ):
        write_table(table, f"{out}/{name}")
    build_serving_tables(spark, out)
    return out


@query
def date_query_market(spark, sf_dir):
    return query_date(spark, _served(spark, sf_dir), DAY)[0]


@query
def date_query_card(spark, sf_dir):
    return query_date(spark, _served(spark, sf_dir), DAY)[1]


@query
def month_query(spark, sf_dir):
    return query_month(spark, _served(spark, sf_dir), MONTH)


@query
def month_query_empty(spark, sf_dir):
    """A month with bars but before the detected period: no rows, the same columns."""
    return query_month(spark, _served(spark, sf_dir), MONTH_BEFORE)


@query
def consensus_flags(spark, sf_dir):
    found = _detectors(_split_features(spark, sf_dir), "val")
    return consensus(found["kmeans"], found["dbscan"])


@query
def consensus_market(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    found = _detectors(features, "val")
    return market.consensus_market(features, found["kmeans"], found["dbscan"], SPLITS.val)


# Evaluation and exploration


@query
def unique_dates(spark, sf_dir):
    return evaluation.unique_dates(rule_anomalies(_features(spark, sf_dir)))


@query
def anomaly_rate(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    return evaluation.anomaly_rate(rule_anomalies(features), features)


@query
def overlap_dates(spark, sf_dir):
    features = _split_features(spark, sf_dir)
    points = materialize(scaled_points(features, SPLITS))
    rule = evaluation.in_period(rule_anomalies(features), SPLITS.val)
    return evaluation.overlap_dates(rule, kmeans_split_anomalies(points, "val", CENTROIDS))


@query
def daily_counts(spark, sf_dir):
    return evaluation.daily_counts(rule_anomalies(_features(spark, sf_dir)))


@query
def ticker_counts(spark, sf_dir):
    return evaluation.ticker_counts(rule_anomalies(_features(spark, sf_dir)))


@query
def anomaly_summary(spark, sf_dir):
    return evaluation.anomaly_summary(rule_anomalies(_stored_features(spark, sf_dir)))


@query
def split_overlap(spark, sf_dir):
    """Dates per detector and dates of both, for the validation and the test split."""
    features = _split_features(spark, sf_dir)
    points = materialize(scaled_points(features, SPLITS))
    parts = {"rule": [], "kmeans": []}
    for split in ("val", "test"):
        tag = F.lit(split).alias("split")
        period = dict(SPLITS.items())[split]
        rule = evaluation.in_period(rule_anomalies(features), period)
        parts["rule"].append(rule.select(tag, "date"))
        far = kmeans_split_anomalies(points, split, CENTROIDS)
        parts["kmeans"].append(far.select(tag, "date"))
    both = {name: frames[0].unionByName(frames[1]) for name, frames in parts.items()}
    return evaluation.detector_dates(both, by=["split"])


@query
def three_way_overlap(spark, sf_dir):
    return evaluation.detector_dates(_detectors(_split_features(spark, sf_dir)))


@query
def detector_daily_counts(spark, sf_dir):
    return evaluation.detector_daily_counts(_detectors(_split_features(spark, sf_dir)))


@query
def flag_rates(spark, sf_dir):
    features = _split_features(spark, sf_dir)
    scored = scaled_points(features, SPLITS).filter("split = 'test'")
    return evaluation.point_flag_rates(_detectors(features), scored)


@query
def null_share(spark, sf_dir):
    return evaluation.null_share(_features(spark, sf_dir), ["date", "ticker", "ret", *FEATURES])


@query
def feature_histogram(spark, sf_dir):
    return evaluation.histogram(_stored_features(spark, sf_dir), FEATURES)


@query
def distance_histogram(spark, sf_dir):
    scored = nearest_centroid(_stored_points(spark, sf_dir), CENTROIDS)
    return evaluation.histogram(
        scored, ["distance"], by="split", groups=["train", "val", "test"], density=True
    )


@query
def feature_correlation(spark, sf_dir):
    return evaluation.correlation(_features(spark, sf_dir), FEATURES)


@query
def slice_ticker(spark, sf_dir):
    return evaluation.of_ticker(_features(spark, sf_dir), ONE_TICKER)


@query
def slice_period(spark, sf_dir):
    return evaluation.in_period(rule_anomalies(_features(spark, sf_dir)), SPLITS.val)


@query
def preview(spark, sf_dir):
    return evaluation.preview(_features(spark, sf_dir))
