"""K-means over integer vectors: blocks along a Hilbert curve, box bounds, then exact comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python
from barwatch.llm.vectors import finite, integers, packed, unpacked
from barwatch.session import materialize

SIZE = 64
"""Components a vector has to have."""

CENTROIDS = 40
ROUNDS = 5
BLOCK = 512
"""Vectors per block, at most."""

AXES = 7
BITS = 9
"""Axes of the curve and its steps per axis: together one 63-bit place."""

EXACT = 1 << 21
"""Components up to which squared distances are exact in double precision (64 * (2 * 2**21)**2 = 2**50)."""


def hilbert(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates, each of ``bits`` bits.

    After J. Skilling, "Programming the Hilbert curve" (2004): the coordinates are turned into the
    transposed index by undoing the curve's rotations from the top bit down, then Gray-decoded.
    """
    x = places.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(axes):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inverted, below, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


def integer_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(_id, _v) of the vectors that take part: ``SIZE`` integers each, as little-endian bytes."""
    rows = vectors.select(F.col(vec_id).alias("_id"), F.col(vector).alias("_vec"))
    rows = rows.filter(F.col("_vec").isNotNull() & (F.size("_vec") == SIZE) & finite("_vec"))
    kind = rows.schema["_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(integers(batch.column(1), SIZE))], ["_id", "_v"])

    return in_python(rows, pack, f"_id {kind}, _v binary")


def principal_axes(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centre of the vectors, and the ``AXES`` directions in which they vary most, times half their width.

    From sums and products that are added up per task and then per component: 64 rows a task.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((SIZE, SIZE + 1)), 0
        for batch in batches:
            x = unpacked(batch.column(0), SIZE).astype(float)
            total += x.T @ np.column_stack([x, np.ones(len(x))])
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SIZE), pa.int32()), pa.array([n] * SIZE, pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                ["i", "n", "row"],
            )

    parts = in_python(vectors.select("_v"), products, "i int, n long, row array<double>")
    summed = F.array(*[F.sum(F.col("row")[k]) for k in range(SIZE + 1)])
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), summed.alias("row")).orderBy("i").collect()
    n, total = rows[0].n, np.array([r.row for r in rows])
    mean = total[:, SIZE] / n
    values, axes = np.linalg.eigh(total[:, :SIZE] / n - np.outer(mean, mean))
    width = 3 * np.sqrt(np.maximum(values[-AXES:], 1e-12))
    return mean, axes[:, -AXES:][:, ::-1] / width[::-1]


def along_the_curve(vectors: DataFrame) -> DataFrame:
    """(_id, _v, _at): each vector's place on a Hilbert curve through its principal axes.

    The place only decides which vectors share a block; any place gives the same clusters.
    """
    centre, axes = principal_axes(vectors)
    kind = vectors.schema["_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(1), SIZE).astype(float)
            steps = np.clip(((x - centre) @ axes + 1) * (1 << BITS - 1), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(steps.astype(np.int64)))], ["_id", "_v", "_at"])

    # Stored: a vector keeps its place when a task runs again, wherever it does.
    return materialize(in_python(vectors, place, f"_id {kind}, _v binary, _at long"))


def blocks(placed: DataFrame) -> DataFrame:
    """(ids, vectors, low, high): up to ``BLOCK`` vectors that follow each other on the curve, and their box.

    The range sort samples places and hashes only. Copies share a place; the hash spreads them.
    """
    kind = placed.schema["_id"].dataType.simpleString()
    spread = placed.withColumn("_h", F.xxhash64("_id", "_v"))
    ordered = spread.repartitionByRange("_at", "_h").sortWithinPartitions("_at", "_h").select("_id", "_v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0

        def block() -> pa.RecordBatch:
            x = np.concatenate(held)
            flat = pa.chunked_array(ids).combine_chunks()
            names = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
            box = [pa.array([bound.astype("<i4").tobytes()], pa.binary()) for bound in (x.min(axis=0), x.max(axis=0))]
            return pa.RecordBatch.from_arrays([names, pa.array([x.astype("<i4").tobytes()], pa.binary()), *box], ["ids", "vectors", "low", "high"])

        for batch in batches:
            at = 0
            while at < len(batch):
                take = min(BLOCK - size, len(batch) - at)
                ids.append(batch.column(0).slice(at, take))
                held.append(unpacked(batch.column(1).slice(at, take), SIZE))
                at, size = at + take, size + take
                if size == BLOCK:
                    yield block()
                    ids, held, size = [], [], 0
        if size:
            yield block()

    return in_python(ordered, cut, f"ids array<{kind}>, vectors binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest, or as near as the nearest, to a vector in the box.

    One centroid, the nearest to the middle of the box, is held against each other one: where the
    other is farther by a margin at every point of the box, it goes. The least difference of the two squared
    distances over the box is a sum over the components, each least at one end: exact in integers.
    """
    c = centroids.astype(np.int64)
    centre = (low + high) // 2
    near = int(((c - centre) ** 2).sum(axis=1).argmin())
    step = c - c[near]
    least = (c * c).sum(axis=1) - (c[near] * c[near]).sum() - 2 * np.where(step > 0, step * high, step * low).sum(axis=1)
    return np.flatnonzero(least <= 0)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centroid for each vector (the first of equally near ones) and its squared distance."""
    if max(np.abs(x).max(), np.abs(centroids).max()) <= EXACT:
        a, c = x.astype(float), centroids.astype(float)
        distance = ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    else:
        wide = x.astype(np.int64)
        distance = np.stack([((wide - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(x)), best]


def assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, vectors, cluster and squared distance of each block."""
    for batch in batches:
        boxes = [unpacked(batch.column(k), SIZE).astype(np.int64) for k in ("low", "high")]
        for i in range(len(batch)):
            x = np.frombuffer(batch.column("vectors")[i].as_buffer(), "<i4").reshape(-1, SIZE)
            some = candidates(boxes[0][i], boxes[1][i], centroids)
            best, distance = nearest(x, centroids[some])
            ids = batch.column("ids")[i].values if "ids" in batch.schema.names else None
            yield ids, x, some[best], distance


def initial_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashed ids, in that order; null ids come last, ties by content."""
    order = F.sha2(F.concat(F.lit("2:"), F.col("_id").cast("string")), 256)
    first = vectors.select(order.alias("_h"), "_v").orderBy(F.col("_h").asc_nulls_last(), "_v").limit(k).collect()
    return np.array([np.frombuffer(bytes(r._v), "<i4") for r in first], np.int64).reshape(-1, SIZE)


def moved(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floored mean of its vectors, in exact integers; empty ones stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), SIZE), np.int64)
        for _, x, cluster, _ in assigned(batches, centroids):
            for k in np.unique(cluster).tolist():
                own = x[cluster == k]
                count[k] += len(own)
                total[k] += own.sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    parts = in_python(stored.select("vectors", "low", "high"), sums, "cluster int, n long, total array<long>")
    summed = F.array(*[F.sum(F.col("total")[i]) for i in range(SIZE)])
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), summed.alias("total")).collect():
        out[r.cluster] = [t // r.n for t in r.total]
    return out


def clusters(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with ``SIZE`` components, none null or non-finite, take part; a component x counts as floor(256 * x).
    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``2:<vec_id>`` (all, if fewer), move ``rounds``
    times to the exact floored means of their vectors, and vectors go to the nearest, ties to the smaller number.
    ``distance`` is squared; the inertias are its sums over the cluster and over all.

    Vectors are stored in blocks along a Hilbert curve through their seven principal axes, each with its
    bounding box. In each round a box decides which centroids can be nearest within it, and only those are
    compared with the block's vectors, in integers. Sums leave a task as one row per cluster.

    Repeated rows and ids are vectors of their own; null ids come last among the starting centroids; an
    empty table, or one without such vectors, gives no rows; other columns are ignored. Components beyond
    2**19 would give distances that no long holds and raise an error.
    """
    known = materialize(integer_vectors(vectors, vec_id, vector))
    kind = known.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, cluster int, distance long"
    centroids = initial_centroids(known, k)
    if not len(centroids):
        found = known.sparkSession.createDataFrame([], shape)
    else:
        stored = materialize(blocks(along_the_curve(known)))
        for _ in range(rounds):
            centroids = moved(stored, centroids)

        def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, _, cluster, distance in assigned(batches, centroids):
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["_id", "cluster", "distance"])

        found = materialize(in_python(stored, final, shape))
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = known.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    total = found.agg(F.sum("distance")).scalar()
    by_cluster = sums.join(F.broadcast(named), "cluster").withColumn("inertia", total)  # at most k rows
    return found.join(F.broadcast(by_cluster), "cluster").select(
        F.col("_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
