"""Agreement between the two learned detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.config import KEY


def consensus(kmeans: DataFrame, dbscan: DataFrame) -> DataFrame:
    """Every flagged key with both flags, their union (recall) and intersection (precision)."""
    by_distance = kmeans.select(*KEY, F.col("anomaly_flag").alias("kmeans_flag"))
    by_density = dbscan.select(*KEY, F.col("anomaly_flag").alias("dbscan_flag"))
    k = F.coalesce("kmeans_flag", F.lit(0)).cast("int")
    d = F.coalesce("dbscan_flag", F.lit(0)).cast("int")
    return by_distance.join(by_density, KEY, "full").select(
        *KEY,
        k.alias("kmeans_flag"),
        d.alias("dbscan_flag"),
        ((k == 1) | (d == 1)).cast("int").alias("union_flag"),
        ((k == 1) & (d == 1)).cast("int").alias("intersection_flag"),
    )
