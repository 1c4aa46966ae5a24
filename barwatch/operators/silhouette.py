"""Mean silhouette of a clustering, in a linear and in a pairwise form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import ELBOW_RANGE, FEATURES, KEY, SEED
from barwatch.operators.kmeans import fit_each, nearest_centroid
from barwatch.session import spread

BLOCK_ROWS = 2048


def _score(own_size: Column, a: Column, b: Column) -> Column:
    """(b - a) / max(a, b); 0 for the only point of a cluster."""
    score = F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    return F.when(own_size == 1, 0.0).otherwise(score)


def silhouette_squared(clustered: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """One row: mean silhouette under squared Euclidean distance, in time linear in the rows.

    Sums of squared distances to a cluster follow from its size, its sum vector and its sum of
    squared norms, so k small rows are all a point has to meet.
    """

    def norm(cols: list[Column]) -> Column:
        return reduce(Column.__add__, [c * c for c in cols])

    per_cluster = clustered.groupBy("cluster").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in columns]).alias("total"),
        F.sum(norm([F.col(c) for c in columns])).alias("norms"),
    )
    # One struct per cluster: bounded by k.
    clusters = per_cluster.agg(
        F.collect_list(F.struct("cluster", "n", "total", "norms"))
    ).scalar()
    own_norm = norm([F.col(c) for c in columns])

    def summed(c: Column) -> Column:
        dot = reduce(
            Column.__add__, [F.col(x) * c["total"][i] for i, x in enumerate(columns)]
        )
        return F.greatest(F.lit(0.0), c["n"] * own_norm - 2 * dot + c["norms"])

    scored = clustered.withColumn("_clusters", clusters).select(
        F.filter("_clusters", lambda c: c["cluster"] == F.col("cluster"))[0].alias("own"),
        F.filter("_clusters", lambda c: c["cluster"] != F.col("cluster")).alias("others"),
        *columns,
    )
    a = F.try_divide(summed(F.col("own")), F.col("own.n") - 1)
    b = F.array_min(F.transform("others", lambda c: summed(c) / c["n"]))
    return scored.select(_score(F.col("own.n"), a, b).alias("score")).agg(
        F.avg("score").alias("silhouette")
    )


def silhouette_euclidean(
    clustered: DataFrame, columns: list[str] = FEATURES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row: mean silhouette under Euclidean distance over all rows.

    Euclidean distance sums have no shortcut, so the work is quadratic; use ``silhouette_squared``
    on large inputs. Points are packed into blocks of about ``block_rows`` and every point is
    joined with every block: the shuffled rows are (points x blocks) with one summed distance per
    cluster each, no single pair ever becomes a row, and no task holds more than a block.
    """
    blocks = max(1, -(-clustered.count() // block_rows))
    # By key, which the sums per point then reuse.
    clustered = spread(clustered, *KEY)
    home = F.pmod(F.xxhash64(*KEY), F.lit(blocks)).cast("int")
    point = F.array(*columns)
    packed = clustered.groupBy(home.alias("block"), "cluster").agg(
        F.collect_list(point).alias("members")
    )
    visiting = clustered.select(
        *KEY,
        F.col("cluster").alias("own"),
        point.alias("point"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def distance(member: Column) -> Column:
        squares = [
            (F.col("point")[i] - member[i]) * (F.col("point")[i] - member[i])
            for i in range(len(columns))
        ]
        return F.sqrt(reduce(Column.__add__, squares))

    to_cluster = (
        visiting.join(packed, "block")
        .select(
            *KEY,
            "own",
            "cluster",
            F.aggregate(
                "members", F.lit(0.0), lambda total, m: total + distance(m)
            ).alias("part"),
            F.size("members").alias("n"),
        )
        .groupBy(*KEY, "own", "cluster")
        .agg(F.sum("part").alias("total"), F.sum("n").alias("n"))
    )
    is_own = F.col("own") == F.col("cluster")
    per_point = to_cluster.groupBy(*KEY).agg(
        F.max(F.when(is_own, F.col("n"))).alias("own_n"),
        F.max(F.when(is_own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~is_own, F.col("total") / F.col("n"))).alias("b"),
    )
    return per_point.select(_score(F.col("own_n"), F.col("a"), F.col("b")).alias("score")).agg(
        F.avg("score").alias("silhouette")
    )


def selection_curves(
    train: DataFrame, ks: range = ELBOW_RANGE, seed: int = SEED, euclidean: bool = False
) -> DataFrame:
    """(k, inertia, silhouette): both curves from a single fit per k on a stored table."""
    measure = silhouette_euclidean if euclidean else silhouette_squared
    parts = []
    for k, (centroids, inertia) in fit_each(train, ks, seed).items():
        parts.append(
            measure(nearest_centroid(train, centroids)).select(
                F.lit(k).alias("k"), F.lit(inertia).alias("inertia"), "silhouette"
            )
        )
    return reduce(DataFrame.unionByName, parts)
