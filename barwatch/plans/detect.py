"""Batch detection: bars in, features and three anomaly tables out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from barwatch.config import (
    CLUSTERS,
    PIPELINE_PERCENTILE,
    SEED,
    DensityParams,
    FeatureParams,
    RuleParams,
    Splits,
)
from barwatch.operators.dbscan import expanding_refit
from barwatch.operators.evaluation import in_period
from barwatch.operators.features import compute_features
from barwatch.operators.kmeans import (
    Centroids,
    cluster_thresholds,
    fit_kmeans,
    kmeans_anomalies,
    nearest_centroid,
)
from barwatch.operators.prep import scaled_points
from barwatch.operators.quality import quality_gate
from barwatch.operators.rules import rule_anomalies
from barwatch.session import materialize
from barwatch.sources.tables import read_table, write_table

# Names of the stored tables.
FEATURES_TABLE = "features"
RULE_TABLE = "anomalies_rule_test"
KMEANS_TABLE = "anomalies_kmeans_test"
DBSCAN_TABLE = "anomalies_dbscan_test"


@dataclass(frozen=True)
class DetectionParams:
    features: FeatureParams = FeatureParams()
    rules: RuleParams = RuleParams()
    splits: Splits = field(default_factory=Splits)
    clusters: int = CLUSTERS
    seed: int = SEED
    percentile: float = PIPELINE_PERCENTILE
    density: DensityParams = DensityParams()


def kmeans_split_anomalies(
    points: DataFrame, split: str, centroids: Centroids, percentile: float = PIPELINE_PERCENTILE
) -> DataFrame:
    """Anomalies of one split against thresholds from the training split."""
    scored = nearest_centroid(points, centroids)
    thresholds = cluster_thresholds(scored.filter("split = 'train'"), percentile)
    return kmeans_anomalies(scored.filter(scored["split"] == split), thresholds)


def run_detection(
    bars: DataFrame, out_dir: str, params: DetectionParams = DetectionParams()
) -> dict[str, str]:
    """Check and clean ``bars``, compute features once, run the detectors on the test period.

    Every table is written below ``out_dir``; returns their paths by name. The bars are stored as a
    columnar table first, since the checks and the features read them several times.
    """
    spark = bars.sparkSession
    paths = {
        name: f"{out_dir}/{name}"
        for name in (FEATURES_TABLE, RULE_TABLE, KMEANS_TABLE, DBSCAN_TABLE)
    }
    cleaned, _ = quality_gate(materialize(bars))
    write_table(compute_features(cleaned, params.features), paths[FEATURES_TABLE])
    features = read_table(spark, paths[FEATURES_TABLE])

    flagged = in_period(rule_anomalies(features, params.rules), params.splits.test)
    write_table(flagged, paths[RULE_TABLE])

    points = materialize(scaled_points(features, params.splits))
    centroids, _ = fit_kmeans(points.filter("split = 'train'"), params.clusters, params.seed)
    far = kmeans_split_anomalies(points, "test", centroids, params.percentile)
    write_table(far, paths[KMEANS_TABLE])

    write_table(expanding_refit(points, "test", params.density), paths[DBSCAN_TABLE])
    return paths
