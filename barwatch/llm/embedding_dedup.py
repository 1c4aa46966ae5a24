"""Near duplicates among embeddings by NN-descent, with audited recall and exact completion."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.functions.components import components
from barwatch.llm.common import grouped_rows, in_python, numbered_rows
from barwatch.session import materialize

COSINE = 0.95
NEIGHBOURS = 10
TREES = 8
LEAF = 128
"""Vectors per bucket of a starting tree, about; a block has twice as many at most."""

ROUNDS = 6
SETTLED = 0.002
"""Descent ends when a round changes less than this share of the graph, or after ``ROUNDS`` rounds."""

AUDITED = 1024
LINKED = 128
DRAWS = 4
"""An audit compares ``AUDITED`` vectors of unsaturated lists with all, then twice as many, until ``LINKED``
of them have links, in ``DRAWS`` draws at most."""

RECALL = 0.99
ENLARGED = 3
"""Below ``RECALL`` lists are doubled, this often at most; then all vectors are compared."""

BLOCK = 2048
"""Vectors per block where all are compared."""

CHUNK = 512
"""Vectors per chunk, about, where a component is compared in full."""

PIVOTS = 2048
"""Components whose first vectors are compared with all vectors at once; bounds driver and broadcast."""

ANGLE = math.acos(COSINE)
SAFE = 1e-6


def unit(vectors: list) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(similarity: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` greatest entries above its ``floor``."""
    k = min(k, similarity.shape[1])
    best = np.argpartition(-similarity, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(similarity)), k)
    column = best.ravel()
    good = similarity[row, column] > floor[row]
    return row[good], column[good]


def edges_of(ids: np.ndarray, similarity: np.ndarray, floor: np.ndarray, k: int) -> pa.RecordBatch:
    row, column = nearest(similarity, floor, k)
    return pa.RecordBatch.from_pydict({"a": ids[row], "b": ids[column], "s": similarity[row, column]})


EDGE = "a long, b long, s double"


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """(_row, _vec, _least, _copies) per distinct comparable vector, numbered, and their count."""
    finite = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    comparable = rows.filter(F.col("_vec").isNotNull()).filter(finite).filter(F.exists("_vec", lambda x: x != 0))
    distinct = comparable.groupBy("_vec").agg(F.min("_id").alias("_least"), F.count("*").alias("_copies"))
    numbered, total = numbered_rows(distinct, "_least", "_vec")
    return materialize(numbered), total


def starting_graph(nodes: DataFrame, total: int, k: int, seed: int) -> DataFrame:
    """Edges inside buckets of random hyperplanes; large buckets are split by hash."""
    bits = max(0, math.ceil(math.log2(max(total, 1) / LEAF)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                if size not in planes:
                    planes[size] = np.random.default_rng((seed, size)).normal(size=(size, TREES * bits))
                some = np.flatnonzero(sizes == size)
                signs = (unit([vectors[i] for i in some]) @ planes[size] > 0).reshape(len(some), TREES, bits)
                code = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                rows = pa.array(np.repeat(some, TREES))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(some))),
                        pa.array(np.full(len(some) * TREES, size, np.int32)),
                        pa.array(code.ravel().astype(np.int64)),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                    ],
                    ["tree", "size", "bucket", "row", "vec"],
                )

    vec = nodes.schema["_vec"].dataType.simpleString()
    shape = f"tree int, size int, bucket long, row long, vec {vec}"
    placed = in_python(nodes.select("_row", "_vec"), place, shape)
    keys = ["tree", "size", "bucket"]
    parts = placed.groupBy(*keys).agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts"))
    split = placed.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("row", "tree"), F.col("parts")))
    ordered = split.select(*keys, "part", "row", "vec").repartition(*keys, "part").sortWithinPartitions(*keys, "part", "row")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_rows(batches, 4):
            for at in range(0, len(rows), 2 * LEAF):
                some = rows[at : at + 2 * LEAF]
                x = unit([r[5] for r in some])
                similarity = x @ x.T
                np.fill_diagonal(similarity, -2)
                yield edges_of(np.array([r[4] for r in some]), similarity, np.full(len(some), -1.5), k)

    return in_python(ordered, near, EDGE)


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest per vector: (a, b, s, old); an edge that was there before stays old."""
    single = edges.groupBy("a", "b").agg(F.max("s").alias("s"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return single.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def descent_round(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Edges found among the neighbours of each vector, forward and reverse, of which one is new.

    Reverse neighbours are the ``k`` nearest; only edges better than the worst of a full list come out.
    """
    closest = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("s"), "a"))
    reverse = graph.withColumn("_rank", closest).filter(F.col("_rank") <= k)
    own = graph.groupBy("a").agg(F.min(F.lit(True)).alias("old"))
    members = (
        graph.select(F.col("a").alias("hub"), F.col("b").alias("row"), "old")
        .unionByName(reverse.select(F.col("b").alias("hub"), F.col("a").alias("row"), "old"))
        .unionByName(own.select(F.col("a").alias("hub"), F.col("a").alias("row"), "old"))
        .groupBy("hub", "row").agg(F.min("old").alias("old"))
    )
    moving = members.filter("not old").select("hub").distinct()
    full = graph.groupBy(F.col("a").alias("row")).agg(F.when(F.count("*") >= k, F.min("s")).alias("worst"))
    data = nodes.select(F.col("_row").alias("row"), "_vec").join(full, "row", "left")
    data = data.select("row", "_vec", F.coalesce("worst", F.lit(-1.5)).alias("floor"))
    ordered = (
        members.join(moving, "hub", "left_semi").join(data, "row").select("hub", "row", "old", "floor", "_vec")
        .repartition("hub").sortWithinPartitions("hub", "row")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped_rows(batches, 1):
            x = unit([r[4] for r in rows])
            old = np.array([r[2] for r in rows])
            similarity = x @ x.T
            similarity[old[:, None] & old[None, :]] = -2
            np.fill_diagonal(similarity, -2)
            yield edges_of(np.array([r[1] for r in rows]), similarity, np.array([r[3] for r in rows]), k)

    return in_python(ordered, meet, EDGE)


def settle(graph: DataFrame, nodes: DataFrame, total: int, k: int) -> DataFrame:
    """Rounds of descent until the graph hardly changes."""
    for _ in range(ROUNDS):
        found = descent_round(graph, nodes, k).withColumn("old", F.lit(False))
        graph = materialize(best_lists(graph.withColumn("old", F.lit(True)).unionByName(found), k))
        if graph.filter("not old").count() <= SETTLED * total * k:
            break
    return graph


def audited_recall(graph: DataFrame, nodes: DataFrame, k: int) -> float:
    """Mean share of a vector's links that its list holds, over vectors whose list is not full of links.

    Vectors come in the order of their hashed numbers and are compared with all, until `LINKED` of them
    have links or the draws are over; each linked vector counts once, however many links it has. The size
    of a draw bounds the broadcast.
    """
    held = graph.filter(F.col("s") >= COSINE).groupBy(F.col("a").alias("_row")).agg(F.count("*").alias("held"))
    lists = nodes.select("_row", "_vec").join(held, "_row", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    hashed = F.struct(F.xxhash64("_row").alias("h"), F.col("_row").alias("r"))
    lists = materialize(lists.filter(F.col("held") < k).select("_row", "_vec", "held", hashed.alias("_order")))
    shares, last = [], None
    for draw in range(DRAWS):
        rest = lists if last is None else lists.filter(F.col("_order") > F.struct(F.lit(last[0]).alias("h"), F.lit(last[1]).alias("r")))
        asked = rest.orderBy("_order").limit(AUDITED << draw).collect()
        if not asked:
            break
        last = asked[-1]["_order"]
        there = counted_links(nodes, asked)
        shares += [r["held"] / there[r["_row"]] for r in asked if r["_row"] in there]
        if len(shares) >= LINKED:
            break
    return sum(shares) / len(shares) if shares else 1.0


def counted_links(nodes: DataFrame, asked: list) -> dict[int, int]:
    """How many of ``nodes`` each of the rows (_row, _vec) links with, for those that link with any."""
    by_size: dict[int, list] = {}
    for r in asked:
        by_size.setdefault(len(r["_vec"]), []).append(r)
    known = {n: (np.array([r["_row"] for r in some]), unit([r["_vec"] for r in some])) for n, some in by_size.items()}
    shared = nodes.sparkSession.sparkContext.broadcast(known)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {size: np.zeros(len(ids), np.int64) for size, (ids, _) in shared.value.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column(1).to_pylist()
                rows, sizes = part.column(0).to_numpy(), np.array([len(v) for v in vectors])
                for size, (ids, x) in shared.value.items():
                    some = np.flatnonzero(sizes == size)
                    if len(some):
                        near = x @ unit([vectors[i] for i in some]).T >= COSINE
                        counts[size] += (near & (ids[:, None] != rows[some])).sum(axis=1)
        for size, (ids, _) in shared.value.items():
            yield pa.RecordBatch.from_pydict({"a": ids, "n": counts[size]})

    found = in_python(nodes.select("_row", "_vec"), compare, "a long, n long")
    return {r["a"]: r["total"] for r in found.groupBy("a").agg(F.sum("n").alias("total")).filter("total > 0").collect()}


def exact_links(nodes: DataFrame, total: int, k: int) -> DataFrame:
    """The edges of all linked pairs, at most ``k`` per vector and pair of blocks: all vectors compared."""
    parts = max(1, math.ceil(total / BLOCK))
    own = (F.col("_row") % parts).cast("int")
    spread = nodes.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    ordered = (
        spread.select(F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "_row", "_vec")
        .repartition("lo", "hi").sortWithinPartitions("lo", "hi", "_row")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lo, hi), rows in grouped_rows(batches, 2):
            sizes, block = np.array([len(r[4]) for r in rows]), np.array([r[2] for r in rows])
            for size in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == size)
                x, ids = unit([rows[i][4] for i in some]), np.array([rows[i][3] for i in some])
                similarity = x @ x.T
                np.fill_diagonal(similarity, -2)
                if lo != hi:
                    similarity[block[some][:, None] == block[some][None, :]] = -2
                yield edges_of(ids, similarity, np.full(len(some), np.nextafter(COSINE, 0)), k)

    return in_python(ordered, link, EDGE)


def guests(nodes: DataFrame, pivots: DataFrame) -> DataFrame:
    """(root, _row, _vec, _copies, angle): vectors of other components that may link with one of ``root``.

    ``nodes``: (_row, _vec, _copies, _root, _full) with ``_full`` for crowded components; ``pivots``: (root,
    _pivot, radius) of those. A vector stays if its angle to the pivot is at most the radius and the link
    angle together. Of two crowded components the vectors of the one with the greater root are the guests.
    """
    vec = nodes.schema["_vec"].dataType.simpleString()
    shape = f"root long, _row long, _vec {vec}, _copies long, angle double"
    data = nodes.select("_row", "_vec", "_copies", "_root", "_full")

    def near(shared) -> DataFrame:
        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, PIVOTS):
                    part = batch.slice(at, PIVOTS)
                    vectors = part.column(1).to_pylist()
                    sizes = np.array([len(v) for v in vectors])
                    own, full = part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)
                    for size, (roots, x, radius) in shared.value.items():
                        some = np.flatnonzero(sizes == size)
                        if len(some):
                            angle = np.arccos(np.clip(unit([vectors[i] for i in some]) @ x.T, -1, 1))
                            fits = angle <= ANGLE + radius + SAFE
                            fits &= (own[some][:, None] > roots) | (~full[some][:, None] & (own[some][:, None] != roots))
                            i, r = np.nonzero(fits)
                            here = part.take(pa.array(some[i]))
                            columns = [pa.array(roots[r]), here.column(0), here.column(1), here.column(2), pa.array(angle[i, r])]
                            yield pa.RecordBatch.from_arrays(columns, ["root", "_row", "_vec", "_copies", "angle"])

        return in_python(data, compare, shape)

    found, some = None, []
    rows = pivots.select("root", "_pivot", "radius").toLocalIterator()
    while some := list(islice(rows, PIVOTS)):
        by_size: dict[int, list] = {}
        for r in some:
            by_size.setdefault(len(r[1]), []).append(r)
        known = {
            n: (np.array([r[0] for r in rs]), unit([r[1] for r in rs]), np.array([r[2] for r in rs])) for n, rs in by_size.items()
        }
        here = materialize(near(nodes.sparkSession.sparkContext.broadcast(known)))
        found = here if found is None else found.unionByName(here)
    return nodes.sparkSession.createDataFrame([], shape) if found is None else found


def at_pivots(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` with their angle to the root's vector, and (root, _pivot, radius) with the greatest of them."""
    pivots = members.filter("root = _row").select("root", F.col("_vec").alias("_pivot"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            pairs = [unit([v, p]) for v, p in zip(rows["_vec"], rows["_pivot"])]
            angle = [math.acos(min(1.0, max(-1.0, float(x[0] @ x[1])))) for x in pairs]
            names = ["root", "_row", "_copies", "_vec"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(angle, pa.float64())], [*names, "angle"])

    vec = members.schema["_vec"].dataType.simpleString()
    shape = f"root long, _row long, _copies long, _vec {vec}, angle double"
    measured = materialize(in_python(members.join(pivots, "root"), measure, shape))
    return measured, pivots.join(measured.groupBy("root").agg(F.max("angle").alias("radius")), "root")


def full_counts(members: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(_row, root, _n): copies of all vectors of the component ``root`` that link with the vector.

    ``members``: (root, _row, _vec, _copies), whole components; their own counts include themselves and
    the `guests` out of ``nodes`` that link with them. Vectors are chunked by their angle to the root's vector.
    Two chunks are linked throughout if their greatest angles add up to less than the link angle, and
    not at all if their angles differ by more; only other pairs of chunks are compared, as blocks.
    """
    placed, pivots = at_pivots(members)
    placed = placed.withColumn("guest", F.lit(0))
    if nodes is not None:
        placed = placed.unionByName(guests(nodes, pivots).withColumn("guest", F.lit(1)))
    placed = placed.withColumn("ring", F.floor(F.col("angle") / (ANGLE / 8)))
    parts = placed.groupBy("root", "guest", "ring").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    placed = materialize(
        placed.join(parts, ["root", "guest", "ring"]).withColumn("part", F.pmod(F.xxhash64("_row"), F.col("parts"))).drop("parts")
    )
    chunks = materialize(
        placed.groupBy("root", "guest", "ring", "part")
        .agg(F.sum("_copies").alias("copies"), F.min("angle").alias("lo"), F.max("angle").alias("hi"))
        .withColumn("chunk", F.struct("guest", "ring", "part"))
    )
    left = chunks.select("root", F.col("chunk").alias("c"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    right = chunks.select("root", F.col("chunk").alias("d"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), "copies")
    pairs = left.join(right, "root").filter("c.guest = 0 or d.guest = 0")
    linked = F.col("hi1") + F.col("hi2") <= ANGLE - SAFE
    apart = (F.col("lo1") - F.col("hi2") > ANGLE + SAFE) | (F.col("lo2") - F.col("hi1") > ANGLE + SAFE)
    sure = pairs.filter(linked).groupBy("root", "c").agg(F.sum("copies").alias("_n"))
    keyed = placed.withColumn("c", F.struct("guest", "ring", "part"))
    certain = keyed.join(sure, ["root", "c"]).select("_row", "root", "_n")
    open_pairs = pairs.filter(~linked & ~apart & (F.col("c") <= F.col("d"))).select("root", "c", "d")
    data = keyed.select("root", F.col("c").alias("own"), "_row", "_copies", "_vec")
    first = open_pairs.join(data.withColumnRenamed("own", "c"), ["root", "c"]).withColumn("side", F.lit(0))
    second = open_pairs.filter("c != d").join(data.withColumnRenamed("own", "d"), ["root", "d"]).withColumn("side", F.lit(1))
    names = ["root", "c", "d", "side", "_row", "_copies", "_vec"]
    ordered = (
        first.select(*names).unionByName(second.select(*names))
        .withColumn("pair", F.xxhash64("c", "d"))
        .select("root", "pair", "side", "_row", "_copies", "_vec")
        .repartition("root", "pair").sortWithinPartitions("root", "pair", "side", "_row")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (root, _), rows in grouped_rows(batches, 2):
            x, copies = unit([r[5] for r in rows]), np.array([r[4] for r in rows])
            ids, side = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
            near = x @ x.T >= COSINE
            if side.any():
                near &= side[:, None] != side[None, :]
            yield pa.RecordBatch.from_pydict({"_row": ids, "root": np.full(len(ids), root), "_n": near @ copies})

    counted = in_python(ordered, count, "_row long, root long, _n long")
    return certain.unionByName(counted).groupBy("_row", "root").agg(F.sum("_n").alias("_n"))


def embedding_links(
    table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 42
) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    Two vectors link if their cosine, in double precision, is at least ``COSINE``. ``n_links`` counts
    the rows linked directly, ``component_id`` is the smallest id reachable by links, itself
    included. A vector that is null, empty or zero, or has null or non-finite components, links with
    nothing, nor do vectors of different lengths. A null id comes after all others. Other columns are
    ignored; an empty table gives an empty result.

    Equal vectors are one node. A neighbour graph starts from buckets of random hyperplanes and is refined
    by comparing neighbours of neighbours. Its recall is audited against all vectors, and lists are
    enlarged and refined again while it is too low; if that does not help, all vectors are compared. A list that holds links only is saturated: the
    vector may have more. The component of such a vector is compared in full, in chunks, also with all
    vectors of other components that its angles allow to link, so no link of its members is missed.
    """
    rows = table.select(F.col(vec_id).alias("_id"), F.col(embedding).cast("array<double>").alias("_vec"))
    nodes, total = distinct_vectors(rows)
    k = NEIGHBOURS
    start = starting_graph(nodes, total, k, seed).withColumn("old", F.lit(False))
    graph = settle(materialize(best_lists(start, k)), nodes, total, k)
    turn = 0
    while audited_recall(graph, nodes, k) < RECALL:
        turn += 1
        if turn > ENLARGED:
            graph = materialize(best_lists(exact_links(nodes, total, k).withColumn("old", F.lit(False)), k))
            break
        k *= 2
        more = starting_graph(nodes, total, k, seed + turn).withColumn("old", F.lit(False))
        graph = materialize(best_lists(graph.unionByName(more), k))
        graph = settle(graph, nodes, total, k)
    links = graph.filter(F.col("s") >= COSINE)
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    points = materialize(both.select(F.col("a").alias("node")).distinct())
    roots = components(points, edges)
    saturated = links.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    crowded = roots.join(saturated, roots["node"] == saturated["a"]).select("root").distinct()
    members = materialize(
        roots.join(crowded, "root", "left_semi").join(nodes, F.col("node") == F.col("_row"))
        .select("root", "_row", "_vec", "_copies")
    )
    rooted = materialize(
        nodes.join(roots, nodes["_row"] == roots["node"], "left").withColumn("_root", F.coalesce("root", "_row"))
        .select("_row", "_vec", "_least", "_copies", "_root")
        .join(crowded.select(F.col("root").alias("_root"), F.lit(True).alias("_full")), "_root", "left")
        .withColumn("_full", F.coalesce("_full", F.lit(False)))
    )
    counts = full_counts(members, rooted).filter("_n > 0").join(rooted.select("_row", "_root"), "_row")
    counts = materialize(counts)
    crossing = counts.filter("root != _root").select(F.least("root", "_root").alias("a"), F.greatest("root", "_root").alias("b"))
    crossing = materialize(crossing.distinct())
    ends = materialize(crossing.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    merged = components(ends, crossing).select(F.col("node").alias("_root"), F.col("root").alias("_merged"))
    full = counts.groupBy("_row").agg(F.sum("_n").alias("_n"))
    listed = (
        both.join(nodes.select(F.col("_row").alias("b"), "_copies"), "b")
        .groupBy(F.col("a").alias("_row")).agg(F.sum("_copies").alias("_linked"))
    )
    own = F.when(~F.col("_full"), F.col("_copies") + F.coalesce("_linked", F.lit(0))).otherwise(0)
    placed = materialize(
        rooted.join(listed, "_row", "left").join(full, "_row", "left").join(merged, "_root", "left")
        .select(
            "_vec", F.coalesce("_merged", "_root").alias("_root"), "_least",
            (own + F.coalesce("_n", F.lit(0)) - 1).alias("_links"),
        )
    )
    least = placed.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = placed.join(least, "_root").select(F.col("_vec").alias("_key"), "_links", "_component")
    out = rows.join(known, rows["_vec"] == known["_key"], "left")
    component = F.when(F.col("_key").isNull(), F.col("_id")).otherwise(F.col("_component"))
    return out.select(
        F.col("_id").alias("vec_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
