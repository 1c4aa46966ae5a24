"""Connected components and distributed numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.session import materialize


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): ``root`` is the smallest node of the component.

    ``nodes`` has a column ``node``, ``edges`` (undirected) the columns ``a`` and ``b``; both must be
    stored tables. Each round takes the smallest root among the neighbours and then follows it one
    step further, which halves distances. Grouping is by node, so no group exceeds a node's degree;
    every round is a stored table, so lineage does not grow and lost executors cost one round.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    roots = materialize(nodes.select("node", F.col("node").alias("root")))
    while True:
        offered = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("offered"))
        )
        lowered = roots.join(offered, "node", "left").select(
            "node",
            F.col("root").alias("before"),
            F.least("root", F.coalesce("offered", "root")).alias("near"),
        )
        jump = roots.select(F.col("node").alias("near"), F.col("root").alias("far"))
        step = materialize(
            lowered.join(jump, "near").select("node", "before", F.least("near", "far").alias("root"))
        )
        roots = step.select("node", "root")
        if step.filter(F.col("root") != F.col("before")).isEmpty():
            return roots


def numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Add consecutive numbers from 0 in the order of column ``order``, without a single sorting task.

    Range-sorted rows are stored with their partition and place in it; the offset of a partition is
    the sum of the sizes before it, one small row per partition.
    """
    placed = materialize(
        rows.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + place).cast("int"))
        .drop("_id", "_part", "_before")
    )
