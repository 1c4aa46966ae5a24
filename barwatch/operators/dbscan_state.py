"""Noise on an expanding window without clustering it anew: a stored grid state to which points are added.

The state holds what the grid pass of `dbscan` found out: per cell its points' number and bounding box, and per point
of a sparse cell its degree, the number of points within eps. All of it can be added to: numbers add up, boxes grow, a
dense cell stays dense, and an old point's degree grows by the new points near it. So adding points
takes the new points, the sparse points, and those points of dense cells that no bounding box decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.config import FEATURES, KEY, DensityParams
from barwatch.functions.boxes import box_of, farthest_squared, nearest_squared, reach_squared, squared_distance
from barwatch.operators.dbscan import NOISE, SLICE_POINTS, _around, _cell
from barwatch.session import broadcast_if_small, materialize, new_folder

BUCKETS = 16
"""Folders of the stored points by cell, of which only those are read in which an open cell lies."""


@dataclass(frozen=True)
class GridState:
    """What is known of all points added so far; stored tables."""

    params: DensityParams
    columns: tuple[str, ...]
    parts: tuple[str, ...]  # folders: key, coordinates, cell by bucket, one per addition
    cells: DataFrame  # cell, n, box, dense
    sparse: DataFrame  # key, coordinates, cell, degree: points of sparse cells


def _bucket() -> Column:
    return F.pmod(F.xxhash64("cell"), F.lit(BUCKETS)).cast("int")


def _grown_box(columns: list[str]) -> Column:
    """Aggregate: box around boxes."""
    ends = [(f"{c}_{end}", by) for c in columns for end, by in (("low", F.min), ("high", F.max))]
    return F.struct(*[by(f"box.{name}").alias(name) for name, by in ends])


def _points_in(spark: SparkSession, parts: tuple[str, ...], cells: DataFrame) -> DataFrame:
    """The stored points of the given cells."""
    buckets = [r[0] for r in cells.select(_bucket()).distinct().collect()]
    found = spark.read.parquet(*parts) if len(parts) == 1 else None
    for part in parts if found is None else ():
        some = spark.read.parquet(part)
        found = some if found is None else found.unionByName(some)
    return found.filter(F.col("bucket").isin(buckets or [-1])).join(broadcast_if_small(cells), "cell", "left_semi").drop("bucket")


def _hits(askers: DataFrame, cells: DataFrame, members, state: tuple[DensityParams, list[str]]) -> DataFrame:
    """key, cell, dense, hits: points of ``cells`` within eps of each asker, where there are any.

    ``members(cells)`` gives the points of some cells; it is asked for those only that lie partly within eps.
    """
    params, columns = state
    limit = params.eps * params.eps
    near = (
        askers.select(*KEY, F.struct(*columns).alias("at"), F.col("cell").alias("home"))
        .withColumn("step", F.explode(_around(len(columns))))
        .select(*KEY, "at", F.zip_with("home", "step", lambda a, b: a + b).alias("cell"))
        .join(broadcast_if_small(cells), "cell")
        .filter(nearest_squared(F.col("at"), F.col("box"), columns) <= limit)
    )
    near = materialize(near.withColumn("inside", farthest_squared(F.col("at"), F.col("box"), columns) <= limit))
    whole = near.filter("inside").select(*KEY, "cell", "dense", F.col("n").alias("hits"))

    slices = F.ceil(F.col("n") / SLICE_POINTS)
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))
    asker = [F.col(k).alias(f"of_{k}") for k in KEY]
    asked = materialize(near.filter(~F.col("inside")).select(*asker, "at", "cell", "dense", slices.alias("slices"), pieces.alias("slice")))
    crowds = materialize(asked.select("cell", "slices").distinct())
    there = members(crowds.select("cell")).join(broadcast_if_small(crowds), "cell")
    there = there.select(F.struct(*columns).alias("member"), "cell", F.pmod(F.xxhash64(*KEY), "slices").alias("slice"))
    counted = (
        there.join(broadcast_if_small(asked), ["cell", "slice"])
        .filter(squared_distance(F.col("at"), F.col("member"), columns) <= limit)
        .groupBy(*[f"of_{k}" for k in KEY], "cell", "dense").agg(F.count("*").alias("hits"))
        .select(*[F.col(f"of_{k}").alias(k) for k in KEY], "cell", "dense", "hits")
    )
    return whole.unionByName(counted)


def add_points(
    new: DataFrame, state: GridState | None = None, params: DensityParams = DensityParams(), columns: list[str] = FEATURES
) -> tuple[GridState, DataFrame]:
    """The state with ``new`` points added, and the keys of those of them that are noise among all points.

    The first call starts a state with ``params`` and ``columns``; later ones use those of the state. Keys are
    unique over all additions. Without new points the state stays as it is; a state cannot start without any.
    """
    spark = new.sparkSession
    if state is not None:
        params, columns = state.params, list(state.columns)
    limit = params.eps * params.eps
    side = params.eps / math.sqrt(len(columns)) * (1 - 1e-9)
    folder = new_folder(spark)
    placed = new.select(*KEY, *columns, _cell(columns, side).alias("cell"))
    placed.withColumn("bucket", _bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    added = spark.read.schema(placed.schema).parquet(folder).drop("bucket")
    if added.isEmpty():
        if state is None:
            raise ValueError("no points")
        return state, added.select(*KEY)
    parts = (*(state.parts if state else ()), folder)

    fresh = materialize(added.groupBy("cell").agg(F.count("*").alias("n"), box_of(columns).alias("box")))
    merged = fresh if state is None else state.cells.select("cell", "n", "box").unionByName(fresh)
    merged = merged.groupBy("cell").agg(F.sum("n").alias("n"), _grown_box(columns).alias("box"))
    close = reach_squared(F.col("box"), F.col("box"), columns) <= limit
    cells = materialize(merged.withColumn("dense", (F.col("n") >= params.min_samples) & close))
    thin = broadcast_if_small(materialize(cells.filter(~F.col("dense")).select("cell")))

    of = (params, columns)
    own = materialize(added.join(thin, "cell", "left_semi"))
    hits = materialize(_hits(own, cells, lambda some: _points_in(spark, parts, some), of))
    degrees = hits.groupBy(*KEY).agg(F.sum("hits").alias("degree"))
    sparse = own.join(degrees, KEY)
    if state is not None:
        old = materialize(state.sparse.join(thin, "cell", "left_semi"))
        # Only cells with new points can raise an old point's degree.
        touched = fresh.withColumn("dense", F.lit(False))
        more = _hits(old, touched, lambda some: added.join(broadcast_if_small(some), "cell", "left_semi"), of)
        more = more.groupBy(*KEY).agg(F.sum("hits").alias("more"))
        grown = old.join(more, KEY, "left").withColumn("degree", F.col("degree") + F.coalesce("more", F.lit(0))).drop("more")
        sparse = sparse.unionByName(grown)
    sparse = materialize(sparse)

    core = F.col("degree") >= params.min_samples
    lone = sparse.join(own.select(*KEY), KEY, "left_semi").filter(~core)
    touching = hits.filter("dense").select(*KEY).distinct()
    lone = materialize(lone.join(touching, KEY, "left_anti"))
    cores = materialize(sparse.filter(core))
    in_cells = cores.groupBy("cell").agg(F.count("*").alias("n"), box_of(columns).alias("box")).withColumn("dense", F.lit(False))
    reached = _hits(lone, materialize(in_cells), lambda some: cores.join(broadcast_if_small(some), "cell", "left_semi"), of)
    noise = lone.select(*KEY).join(reached.select(*KEY), KEY, "left_anti")
    return GridState(params, tuple(columns), parts, cells, sparse), noise


def expanding_additions(points: DataFrame, target: str, order: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """As `expanding_refit`: noise within split ``target``, from a state to which the splits are added in turn."""
    state, noise = None, None
    for split in order[: order.index(target) + 1]:
        state, noise = add_points(points.filter(F.col("split") == split), state)
    return points.filter(F.col("split") == target).join(noise, KEY, "left_semi").select(
        *KEY, "ret", F.lit(1).alias("anomaly_flag"), F.lit(NOISE).alias("cluster")
    )
