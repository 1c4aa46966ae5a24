"""Distance of every point to its k-th nearest neighbour, counting the point itself.

The tight box around the points is halved along every axis, and so are the tight boxes of the parts,
until no box holds more than some hundred distinct points. Halving tight boxes separates any distinct points,
however far away others are. The k-th nearest point of its own box bounds the distance of each point. Pairs
of boxes within the bounds are followed from the whole down; then a point visits just those boxes that
reach into its own bound, which are few. Points of one box, and of those that visit it, are compared as arrays.
No group grows with the data: equal points are counted once, a leaf is small, and its visitors
are looked at in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import FEATURES, KEY, DensityParams
from barwatch.functions.boxes import box_of, gap_squared, nearest_squared, reach_squared
from barwatch.session import broadcast_if_small, materialize, ship_package, spread

BOX_POINTS = 512
CHUNK_BOXES = 64
"""Leaves whose points visit a leaf together; a point keeps only the k smallest distances of each leaf."""

COMPARED, OUT_POINTS = 1 << 17, 1 << 14
"""Distances held at once where points are compared as arrays, and about how many points leave a task together."""


def k_distance(
    points: DataFrame,
    k: int = DensityParams().min_samples,
    columns: list[str] = FEATURES,
    box_points: int = BOX_POINTS,
    chunk_boxes: int = CHUNK_BOXES,
) -> DataFrame:
    """date, ticker, k_distance, ordered by distance."""
    box_points = max(box_points, k)
    known = materialize(points.select(*KEY, *columns))
    total = known.count()
    if total < k:
        raise ValueError(f"{total} points have no {k}-th neighbour")
    distinct = materialize(known.groupBy(*columns).agg(F.count("*").alias("weight")))
    levels, placed = _halve(distinct, columns, box_points)
    members = F.collect_list(F.struct(*columns, "weight")).alias("members")
    packed = materialize(placed.groupBy("node").agg(members))
    held = materialize(_compared(spread(packed, "node"), k, columns))
    near = _near_leaves(_bounded(levels, held, k, columns), k, columns)

    bounds = near.groupBy("a").agg(F.min("bound").alias("outer"))
    facing = materialize(
        near.filter(F.col("a") != F.col("b"))
        .join(broadcast_if_small(materialize(bounds)), "a")
        .filter(F.col("gap") <= F.col("outer"))
        .select("a", "b", "outer", "b_box")
    )
    chunks = facing.groupBy("b").agg(F.ceil(F.count("*") / chunk_boxes).alias("chunks"))
    facing = facing.join(broadcast_if_small(materialize(chunks)), "b").withColumn(
        "chunk", F.pmod(F.xxhash64("a"), "chunks")
    )
    bound = F.least("bound", "outer")
    visits = (
        held.select(F.col("node").alias("a"), F.struct(*columns).alias("me"), "bound")
        .join(facing, "a")
        .filter(nearest_squared(F.col("me"), F.col("b_box"), columns) <= bound)
        .groupBy(F.col("b").alias("node"), "chunk")
        .agg(F.collect_list(F.struct(*[F.col("me")[c].alias(c) for c in columns], bound.alias("bound"))).alias("visitors"))
    )
    met = _compared(spread(visits.join(packed, "node"), "node", "chunk"), k, columns)
    kept = ["node", *columns, "smallest"]
    measured = (
        held.select(*kept)
        .unionByName(met.select(*kept))
        # At first per part of the boxes, so that what is met in many boxes is cut to k on the way.
        .repartition(*columns)
        .groupBy(*columns, F.pmod(F.xxhash64("node"), F.lit(chunk_boxes)).alias("part"))
        .agg(_first(k).alias("smallest"))
        .groupBy(*columns)
        .agg(F.sqrt(F.get(_first(k), F.lit(k - 1))).alias("k_distance"))
    )
    return known.join(materialize(measured), columns).select(*KEY, "k_distance").orderBy("k_distance", *KEY)


def _first(k: int) -> Column:
    """Aggregate: the k smallest numbers of the lists ``smallest``."""
    return F.slice(F.sort_array(F.flatten(F.collect_list("smallest"))), 1, k)


def _compared(packed: DataFrame, k: int, columns: list[str]) -> DataFrame:
    """(node, the point, bound, smallest): per point the k smallest squared distances to a box's members within its bound.

    The points are the ``visitors``, or without that column the members themselves, which then get the k-th of
    these as their bound: infinite, if there are fewer.
    """
    visited = "visitors" in packed.columns

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Some points of one box: (node, coordinates, bound, how many, which)."""
        lists = []
        for name, last in (("members", "weight"), ("visitors", "bound"))[: 1 + visited]:
            column = batch.column(name)
            flat, ends = column.flatten(), column.offsets.to_numpy()
            lists.append(([flat.field(f).to_numpy(zero_copy_only=False) for f in (*columns, last)], ends - ends[0]))
        for row, node in enumerate(batch.column("node").to_pylist()):
            (*around, weight), *others = [[f[ends[row] : ends[row + 1]] for f in fields] for fields, ends in lists]
            *me, bound = others[0] if visited else (*around, np.full(len(weight), np.inf))
            # Equal points stand for themselves as often as they can matter, which is k times.
            if weight.max() > 1:
                around = [np.repeat(x, np.minimum(weight, k)) for x in around]
            at_once = max(1, COMPARED // len(around[0]))
            for i in range(0, len(bound), at_once):
                some, least = [x[i : i + at_once] for x in me], bound[i : i + at_once]
                sizes, found = smallest(some, around, least, k)
                if not visited and len(around[0]) >= k:
                    least = found[k - 1 :: k]
                yield node, some, least, sizes, found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def out() -> pa.RecordBatch:
            nodes, points, *rest = zip(*waiting)
            bound, sizes, found = map(np.concatenate, rest)
            which = np.repeat(np.arange(len(nodes)), [len(b) for b in rest[0]])
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.string()).take(pa.array(which)),
                    *(pa.array(np.concatenate(x), pa.float64()) for x in zip(*points)),
                    pa.array(bound, pa.float64()),
                    pa.ListArray.from_arrays(ends, pa.array(found, pa.float64())),
                ],
                ["node", *columns, "bound", "smallest"],
            )

        held = 0
        for batch in batches:
            for piece in pieces(batch):
                waiting.append(piece)
                held += len(piece[2])
                if held >= OUT_POINTS:
                    yield out()
                    held = 0
        if waiting:
            yield out()

    ship_package(packed.sparkSession)
    shape = ", ".join(["node string", *[f"{c} double" for c in columns], "bound double", "smallest array<double>"])
    return packed.mapInArrow(compare, shape)


def smallest(
    me: list[np.ndarray], around: list[np.ndarray], bound: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """How many, and which, are the k smallest squared distances of each point that are within its bound; ascending.

    Points are given by coordinate, and what is not a number counts as infinite.
    """
    squared = np.zeros((len(bound), len(around[0])))
    with np.errstate(over="ignore", invalid="ignore"):
        for x, y in zip(me, around):
            apart = x[:, None] - y
            apart *= apart
            squared += apart
        within = squared <= bound[:, None]
    sizes = within.sum(axis=1)
    if sizes.max() <= k and np.isfinite(bound).all():
        which, found = np.repeat(np.arange(len(bound)), sizes), squared[within]
        return sizes, found[np.lexsort((found, which))]
    if squared.shape[1] > k:
        squared.partition(k - 1, axis=1)
    squared = np.sort(squared[:, :k], axis=1)
    np.copyto(squared, np.inf, where=np.isnan(squared))
    within = squared <= bound[:, None]
    return within.sum(axis=1), squared[within]


def _halve(
    distinct: DataFrame, columns: list[str], box_points: int
) -> tuple[list[DataFrame], DataFrame]:
    """Boxes of every level (parent, node, box, weight, leaf), and the points with their leaf.

    The box of a part is tight, so one far point costs a level and not the resolution of the rest.
    """

    def upper_half(c: str) -> Column:
        low, high = F.col(f"box.{c}_low"), F.col(f"box.{c}_high")
        # Of neighbouring numbers the middle is rounded to one; it has to be the lower.
        middle = F.greatest(low, low / 2 + high / 2)
        return (F.col(c) > F.when(middle < high, middle).otherwise(low)).cast("int")

    levels, leaves = [], []
    rest = distinct.withColumns({"parent": F.lit(""), "node": F.lit("0")})
    while True:
        boxes = materialize(
            rest.groupBy("parent", "node")
            .agg(box_of(columns).alias("box"), F.sum("weight").alias("weight"), F.count("*").alias("n"))
            .select("parent", "node", "box", "weight", (F.col("n") <= box_points).alias("leaf"))
        )
        levels.append(boxes)
        halves = F.concat(*[upper_half(c).cast("string") for c in columns])
        placed = materialize(
            rest.drop("parent")
            .join(broadcast_if_small(boxes.select("node", "box", "leaf")), "node")
            .select(*columns, "weight", "node", "leaf", F.concat_ws(".", "node", halves).alias("half"))
        )
        leaves.append(placed.filter("leaf").select(*columns, "weight", "node"))
        if boxes.filter("not leaf").isEmpty():
            return levels, reduce(DataFrame.unionByName, leaves)
        rest = placed.filter("not leaf").select(
            *columns, "weight", F.col("node").alias("parent"), F.col("half").alias("node")
        )


def _bounded(levels: list[DataFrame], held: DataFrame, k: int, columns: list[str]) -> list[DataFrame]:
    """The boxes of every level with ``inside``, a squared distance that no k-distance of their points exceeds.

    For a leaf this is the greatest bound of its points; where it has fewer than k, its parent has k and
    its extent counts. For any other box it is the greatest of its leaves.
    """
    named = [b.withColumn("level", F.lit(i)) for i, b in enumerate(levels)]
    boxes = materialize(reduce(DataFrame.unionByName, named))
    extent = reach_squared(F.col("box"), F.col("box"), columns)
    around = boxes.filter("not leaf").select(F.col("node").alias("parent"), extent.alias("extent"))
    names = F.split("node", r"\.")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(names)), lambda n: F.concat_ws(".", F.slice(names, 1, n))
    )
    leaves = held.groupBy("node").agg(F.max("bound").alias("bound"))
    limits = materialize(
        boxes.filter("leaf")
        .join(leaves, "node")
        .join(broadcast_if_small(around), "parent", "left")
        .select(F.explode(ancestors).alias("node"), F.least("bound", "extent").alias("inside"))
        .groupBy("node")
        .agg(F.max("inside").alias("inside"))
    )
    known = materialize(boxes.join(broadcast_if_small(limits), "node"))
    return [known.filter(F.col("level") == i).drop("level") for i in range(len(levels))]


def _near_leaves(levels: list[DataFrame], k: int, columns: list[str]) -> DataFrame:
    """(a, b, b_box, gap, bound): pairs of leaves of which ``b`` can hold one of the k nearest of ``a``.

    ``bound`` is a squared distance no k-distance of the box exceeds: its own ``inside``, or that to the farthest
    corner of the closest box with k points, over all boxes met on the way down.
    """
    sides = ["a", "b"]
    parts = ["box", "leaf", "weight", "inside"]

    def side(boxes: DataFrame, s: str) -> DataFrame:
        named = [F.col(p).alias(f"{s}_{p}_kid") for p in parts]
        return boxes.select(F.col("parent").alias(s), F.col("node").alias(f"{s}_kid"), *named)

    def halves_of(pairs: DataFrame, kids: DataFrame, s: str) -> DataFrame:
        """Pairs with the halves of one side; a leaf stays itself."""
        met = pairs.join(broadcast_if_small(side(kids, s)), s, "left")
        fresh = {f"{s}_{p}": F.coalesce(f"{s}_{p}_kid", f"{s}_{p}") for p in parts}
        fresh[s] = F.coalesce(f"{s}_kid", s)
        return met.withColumns(fresh).select(*pairs.columns).filter(gap <= F.least("bound", "a_inside"))

    gap = gap_squared(F.col("a_box"), F.col("b_box"), columns)
    reach = reach_squared(F.col("a_box"), F.col("b_box"), columns)
    whole = levels[0].select(
        *[
            F.col(p).alias(n)
            for s in sides
            for p, n in [("node", s)] + [(p, f"{s}_{p}") for p in parts]
        ]
    )
    pairs = whole.withColumn("bound", F.least(reach, "a_inside"))
    final = F.col("a_leaf") & F.col("b_leaf")
    done = [pairs.filter(final)]
    for kids in levels[1:]:
        met = materialize(halves_of(halves_of(spread(pairs.filter(~final)), kids, "a"), kids, "b"))
        closest = (
            met.filter(F.col("b_weight") >= k).groupBy("a").agg(F.min(reach).alias("closer"))
        )
        pairs = (
            met.join(closest, "a", "left")
            .withColumn("bound", F.least("bound", "a_inside", "closer"))
            .drop("closer")
            .filter(gap <= F.col("bound"))
        )
        done.append(pairs.filter(final))
    return materialize(
        reduce(DataFrame.unionByName, done).select("a", "b", "b_box", gap.alias("gap"), "bound")
    )
