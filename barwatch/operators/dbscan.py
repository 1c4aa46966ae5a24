"""Density-based clustering on a grid: noise points, and full cluster labels.

Cells have a diagonal just below ``eps``. Points sharing a cell are therefore neighbours, and a cell
with ``min_samples`` points ("dense") holds core points only, without computing any distance. What is
left are the points of sparse cells, fewer than ``min_samples`` per cell, so their number is bounded
by the number of cells and not by the number of rows. Only they are compared with their surroundings:

* with each other, at most ``min_samples - 1`` points per neighbouring cell;
* with dense cells, by the bounding box of the cell where that decides, else by streaming the cell's
  points past them. A cell holding most of the data stays spread over its tasks, and hits are counted
  map-side, so pairs are not shuffled.

The neighbourhood is ``<= eps`` and includes the point itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import FEATURES, KEY, DensityParams
from barwatch.functions.boxes import (
    box_of,
    cell_steps,
    farthest_squared,
    gap_squared,
    nearest_squared,
    reach_squared,
    squared_distance,
)
from barwatch.functions.components import components, numbered
from barwatch.session import broadcast_if_small, is_small, materialize, spread

SLICE_POINTS = 4096
"""Points of a dense cell that are counted together."""

NOISE = -1


@dataclass
class Neighbourhoods:
    """What the grid pass found out; all stored tables."""

    points: DataFrame  # key, coordinates, cell
    cells: DataFrame  # cell, n, dense, box
    sparse: DataFrame  # key, coordinates, cell, core: points of sparse cells
    touches: DataFrame  # key, cell: sparse point within eps of a point of that dense cell
    links: DataFrame  # key, other (struct key), other_core: sparse points within eps of each other


def _cell(columns: list[str], side: float) -> Column:
    return F.array(*[F.floor(F.col(c) / side) for c in columns])


def _around(dimensions: int) -> Column:
    """Offsets of all cells that can hold a neighbour, the own cell included.

    A little more than eps over the side of a cell, as cells are a little smaller than they could be.
    """
    return cell_steps(math.ceil(math.sqrt(dimensions) * (1 + 1e-8)), dimensions)


def neighbourhoods(
    points: DataFrame, params: DensityParams = DensityParams(), columns: list[str] = FEATURES
) -> Neighbourhoods:
    """Grid pass over ``points``: which sparse points are core and what they touch."""
    limit = params.eps * params.eps
    side = params.eps / math.sqrt(len(columns)) * (1 - 1e-9)
    placed = materialize(points.select(*KEY, *columns, _cell(columns, side).alias("cell")))
    if placed.isEmpty():
        raise ValueError("no points")

    # The box settles what rounding of huge coordinates could leave open: who shares a cell is close.
    box = F.col("box")
    close = reach_squared(box, box, columns) <= limit
    cells = materialize(
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), box_of(columns).alias("box"))
        .withColumn("dense", (F.col("n") >= params.min_samples) & close)
    )
    sparse_cells = broadcast_if_small(cells.filter(~F.col("dense")).select("cell"))
    sparse = materialize(placed.join(sparse_cells, "cell", "left_semi"))

    # Every sparse point with the existing cells in its reach.
    here = F.struct(*columns)
    nearby = (
        sparse.select(*KEY, here.alias("at"), F.col("cell").alias("home"))
        .withColumn("step", F.explode(_around(len(columns))))
        .select(*KEY, "at", F.zip_with("home", "step", lambda a, b: a + b).alias("cell"))
        .join(broadcast_if_small(cells), "cell")
        .filter(nearest_squared(F.col("at"), F.col("box"), columns) <= limit)
    )
    nearby = materialize(nearby)

    to_dense = nearby.filter("dense")
    inside = farthest_squared(F.col("at"), F.col("box"), columns) <= limit
    whole = to_dense.filter(inside).select(*KEY, "cell", F.col("n").alias("hits"))
    # The points of a dense cell are counted in slices, so that a hot cell is spread over tasks.
    slices = F.ceil(F.col("n") / SLICE_POINTS)
    crowds = cells.filter("dense").select("cell", slices.alias("slices"))
    members = placed.join(broadcast_if_small(crowds), "cell").select(
        here.alias("member"), "cell", F.pmod(F.xxhash64(*KEY), "slices").alias("slice")
    )
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))
    asked = to_dense.filter(~inside).select(
        *[F.col(k).alias(f"of_{k}") for k in KEY], "at", "cell", pieces.alias("slice")
    )
    asker = [f"of_{k}" for k in KEY]
    counted = (
        members.join(broadcast_if_small(materialize(asked)), ["cell", "slice"])
        .filter(squared_distance(F.col("at"), F.col("member"), columns) <= limit)
        .groupBy(*asker, "cell", "slice")
        .agg(F.count("*").alias("hits"))
        .groupBy(*asker, "cell")
        .agg(F.sum("hits").alias("hits"))
        .select(*[F.col(f"of_{k}").alias(k) for k in KEY], "cell", "hits")
    )
    touches = materialize(whole.unionByName(counted))

    others = sparse.select(
        "cell",
        F.struct(*KEY).alias("other"),
        here.alias("member"),
    )
    links = materialize(
        nearby.filter("not dense")
        .select(*KEY, "at", "cell")
        .join(broadcast_if_small(others), "cell")
        .filter(squared_distance(F.col("at"), F.col("member"), columns) <= limit)
        .select(*KEY, "other")
    )

    degrees = (
        touches.select(*KEY, "hits")
        .unionByName(links.select(*KEY, F.lit(1).cast("bigint").alias("hits")))
        .groupBy(*KEY)
        .agg((F.sum("hits") >= params.min_samples).alias("core"))
    )
    judged = materialize(sparse.join(degrees, KEY))
    other_core = judged.select(F.struct(*KEY).alias("other"), F.col("core").alias("other_core"))
    return Neighbourhoods(
        points=placed,
        cells=cells,
        sparse=judged,
        touches=touches.select(*KEY, "cell"),
        links=links.join(other_core, "other"),
    )


def noise_keys(found: Neighbourhoods) -> DataFrame:
    """Keys of the noise points: not core and no core point within eps.

    Points of dense cells are core, and a sparse core point is linked to itself.
    """
    reached = found.touches.select(*KEY).unionByName(
        found.links.filter("other_core").select(*KEY)
    )
    return found.sparse.select(*KEY).join(reached, KEY, "left_anti")


def dbscan_anomalies(
    points: DataFrame, params: DensityParams = DensityParams(), columns: list[str] = FEATURES
) -> DataFrame:
    """Noise among ``points``: date, ticker, ret, anomaly_flag, cluster (-1)."""
    return _as_anomalies(points, neighbourhoods(points, params, columns))


def _as_anomalies(points: DataFrame, found: Neighbourhoods) -> DataFrame:
    """Those of ``points`` that are noise, in the shape of an anomaly table."""
    noise = noise_keys(found)
    if is_small(found.sparse):  # which the noise is a part of
        noise = F.broadcast(noise)
    return points.join(noise, KEY, "left_semi").select(
        *KEY, "ret", F.lit(1).alias("anomaly_flag"), F.lit(NOISE).alias("cluster")
    )


def expanding_refit(
    points: DataFrame,
    target: str,
    params: DensityParams = DensityParams(),
    order: tuple[str, ...] = ("train", "val", "test"),
    columns: list[str] = FEATURES,
) -> DataFrame:
    """Noise within split ``target`` when clustering it together with all earlier splits.

    ``points`` is scaled once, on the training split.
    """
    window = order[: order.index(target) + 1]
    known = points.filter(F.col("split").isin(list(window)))
    found = neighbourhoods(known, params, columns)
    return _as_anomalies(points.filter(F.col("split") == target), found)


def noise_rate(points: DataFrame, noise: DataFrame) -> DataFrame:
    """points, noise and their ratio in one row."""
    flagged = noise.agg(F.count("*")).scalar()
    return points.agg(F.count("*").alias("points")).select(
        "points",
        flagged.alias("noise"),
        F.try_divide(flagged.cast("double"), F.col("points").cast("double")).alias("noise_rate"),
    )


def cluster_labels(
    points: DataFrame, params: DensityParams = DensityParams(), columns: list[str] = FEATURES
) -> DataFrame:
    """date, ticker, cluster of every point; -1 is noise.

    Clusters are numbered by their first core point in (ticker, date) order, and a border point
    goes to the lowest numbered cluster it touches. The graph has one node per dense cell and per
    sparse core point, each named by its first core point.
    """
    found = neighbourhoods(points, params, columns)
    name = F.struct("ticker", "date")
    dense = found.cells.filter("dense")
    here = F.struct(*columns)
    outermost = [by(here, F.col(c)) for c in columns for by in (F.min_by, F.max_by)]
    # Aggregated before the join, so that a hot cell reaches it as one row per task.
    named = found.points.groupBy("cell").agg(
        F.min(name).alias("node"), F.array(*outermost).alias("outermost")
    )
    dense = materialize(dense.join(named, "cell"))
    sparse_core = found.sparse.filter("core").select(name.alias("node"))
    nodes = materialize(dense.select("node").unionByName(sparse_core))

    core = found.sparse.filter("core").select(*KEY)
    point_to_cell = (
        found.touches.join(core, KEY, "left_semi")
        .join(dense.select("cell", F.col("node").alias("b")), "cell")
        .select(name.alias("a"), "b")
    )
    point_to_point = (
        found.links.filter("other_core")
        .join(core, KEY, "left_semi")
        .select(name.alias("a"), F.struct("other.ticker", "other.date").alias("b"))
        .filter(F.col("a") < F.col("b"))
    )
    sure, unsure = _cell_pairs(dense, params, columns)
    edges = materialize(sure.unionByName(point_to_cell).unionByName(point_to_point))
    roots = components(nodes, edges)
    more = _settle(found.points, unsure, roots, params, columns)
    if more is not None:
        roots = components(nodes, materialize(edges.unionByName(more)))

    clusters = numbered(roots.select("root").distinct(), "root", "cluster")
    labelled = roots.join(clusters, "root").select("node", "cluster")
    of_cell = materialize(dense.join(labelled, "node").select("cell", "cluster"))
    in_cells = found.points.join(broadcast_if_small(of_cell), "cell").select(*KEY, "cluster")

    of_core = labelled.select(F.col("node.ticker"), F.col("node.date"), "cluster")
    via_cells = found.touches.join(of_cell, "cell").select(*KEY, "cluster")
    via_points = found.links.filter("other_core").join(
        of_core.select(F.struct(*KEY).alias("other"), "cluster"), "other"
    )
    reached = (
        via_cells.unionByName(via_points.select(*KEY, "cluster"))
        .groupBy(*KEY)
        .agg(F.min("cluster").alias("cluster"))
    )
    outside = found.sparse.select(*KEY).join(reached, KEY, "left").select(
        *KEY, F.coalesce("cluster", F.lit(NOISE)).alias("cluster")
    )
    return in_cells.unionByName(outside)


def _cell_pairs(
    dense: DataFrame, params: DensityParams, columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Neighbouring dense cells: (a, b) surely within eps, and the pairs left open.

    Sure are pairs whose boxes are close as a whole or whose outermost points are. For cells with a
    common side the outermost points towards it are close unless the cells are nearly empty there.
    """
    limit = params.eps * params.eps
    first = dense.select(
        F.col("node").alias("a"), F.col("cell").alias("cell_a"), "box", "outermost"
    )
    second = dense.select(
        F.col("node").alias("b"),
        F.col("cell").alias("cell_b"),
        F.col("box").alias("box_b"),
        F.col("outermost").alias("outermost_b"),
    )
    pairs = (
        spread(first)
        .withColumn("step", F.explode(_around(len(columns))))
        .withColumn("cell_b", F.zip_with("cell_a", "step", lambda x, y: x + y))
        .join(second, "cell_b")
        .filter(F.col("a") < F.col("b"))
    )
    a, b = F.col("box"), F.col("box_b")
    met = F.exists(
        "outermost",
        lambda p: F.exists("outermost_b", lambda q: squared_distance(p, q, columns) <= limit),
    )
    close = (reach_squared(a, b, columns) <= limit) | met
    pairs = materialize(
        pairs.filter(gap_squared(a, b, columns) <= limit).select(
            "a", "b", "cell_a", "cell_b", close.alias("close")
        )
    )
    return pairs.filter("close").select("a", "b"), pairs.filter("not close").drop("close")


def _settle(
    points: DataFrame,
    unsure: DataFrame,
    roots: DataFrame,
    params: DensityParams,
    columns: list[str],
    last_level: int = 40,
) -> DataFrame | None:
    """Edges among the open pairs of dense cells that are not connected anyway; None if there are none.

    Cells are halved per axis, level by level, and only parts whose boxes are neither surely within
    eps nor surely apart are followed; a pair is done at its first close part. At the last level
    single points take the place of parts, so the answer is exact.
    """
    limit = params.eps * params.eps
    side = params.eps / math.sqrt(len(columns)) * (1 - 1e-9)
    root_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    root_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    pending = materialize(
        unsure.join(root_a, "a")
        .join(root_b, "b")
        .filter(F.col("root_a") != F.col("root_b"))
        .select("a", "b", F.col("cell_a").alias("part_a"), F.col("cell_b").alias("part_b"))
    )
    edges = []
    level = 0
    while not pending.isEmpty():
        level += 1
        whole = pending.select(F.col("part_a").alias("parent"))
        wanted = materialize(
            whole.unionByName(pending.select(F.col("part_b").alias("parent"))).distinct()
        )
        if level < last_level:
            part = _cell(columns, side / 2**level)
        else:
            part = F.array(*[F.hash(c).cast("bigint") for c in columns])
        children = (
            points.withColumn("parent", _cell(columns, side / 2 ** (level - 1)))
            .join(broadcast_if_small(wanted), "parent")
            .groupBy("parent", part.alias("part"), *([] if level < last_level else columns))
            .agg(box_of(columns).alias("box"))
            .select("parent", "part", "box")
        )
        children = materialize(children)

        def side_of(which: str) -> DataFrame:
            return children.select(
                F.col("parent").alias(f"part_{which}"),
                F.col("part").alias(f"next_{which}"),
                F.col("box").alias(f"box_{which}"),
            )

        a, b = F.col("box_a"), F.col("box_b")
        judged = materialize(
            pending.join(side_of("a"), "part_a")
            .join(side_of("b"), "part_b")
            .filter(gap_squared(a, b, columns) <= limit)
            .select(
                "a",
                "b",
                F.col("next_a").alias("part_a"),
                F.col("next_b").alias("part_b"),
                (reach_squared(a, b, columns) <= limit).alias("close"),
            )
        )
        close = materialize(judged.filter("close").select("a", "b").distinct())
        edges.append(close)
        if level == last_level:
            break
        pending = materialize(
            judged.filter("not close").drop("close").join(close, ["a", "b"], "left_anti")
        )
    return reduce(DataFrame.unionByName, edges) if edges else None
