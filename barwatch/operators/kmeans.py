"""Distance to the nearest centroid, judged by a percentile per cluster."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwatch.config import (
    CLUSTERS,
    ELBOW_RANGE,
    FEATURES,
    KEY,
    SEED,
    THRESHOLD_PERCENTILE,
)
from barwatch.functions.quantiles import percentile_by_group
from barwatch.session import ship_package

STARTS = 3
"""Sets of first centroids from different seeds, of which the one with the least inertia is moved on."""

DRAWS = 2
DRAWN = 100
"""Draws, and rows of each, from which a start's centroids are chosen; they bound what the driver holds."""

TOLERANCE = 1e-4
"""A fit ends when no centroid moves farther than this."""

ROUNDS = 300

BLOCK = 4096
"""Rows compared with a centroid at once, so that what is in between stays in the processor's cache."""

WIDE = 1000
"""Centroids from which the sums of the tasks are added up by tasks before the driver gets them."""

Centroid = tuple[float, ...]
Centroids = list[Centroid]


def _squares(x: np.ndarray, centroids: Centroids) -> np.ndarray:
    """Squared distance of each row of ``x`` to each centroid, added up column by column."""
    return sum((x[:, j, None] - np.array([c[j] for c in centroids])) ** 2 for j in range(x.shape[1]))


def _nearest(columns: list[np.ndarray], centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Per row the first of the nearest centroids and the squared distance to it."""
    n = len(columns[0])
    place, least = np.zeros(n, np.int32), np.full(n, np.inf)
    squares, part, closer = np.empty(BLOCK), np.empty(BLOCK), np.empty(BLOCK, bool)
    for i in range(0, n, BLOCK):
        some = [c[i : i + BLOCK] for c in columns]
        m = len(some[0])
        total, more, nearer = squares[:m], part[:m], closer[:m]
        for k, centroid in enumerate(centroids):
            np.subtract(some[0], centroid[0], out=total)
            np.multiply(total, total, out=total)
            for values, c in zip(some[1:], centroid[1:]):
                np.subtract(values, c, out=more)
                np.multiply(more, more, out=more)
                np.add(total, more, out=total)
            np.less(total, least[i : i + m], out=nearer)
            np.minimum(total, least[i : i + m], out=least[i : i + m])
            np.putmask(place[i : i + m], nearer, k)
    return place, least


def _uniform(key: list[str], tag: str) -> Column:
    """A number between 0 and 1 per row that depends on its key and ``tag`` alone."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(tag))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def _drawn(points: DataFrame, columns: list[str], key: list[str], tags: list[str], chosen: list[Centroids], rows: int) -> list[Centroids]:
    """Per start ``rows`` rows with a chance in proportion to the squared distance to those chosen, as one job.

    The rows with the least -ln(u) / distance are such a draw, whatever their order or partitions. A task gives
    out its own least rows.
    """
    drawn = [_uniform(key, tag).alias(f"_u{s}") for s, tag in enumerate(tags)]
    numbered = points.select(F.struct(*key).alias("key"), *columns, *drawn)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, list[pa.Array]]] = {}
        for batch in batches:
            values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, batch.num_columns)]
            x, u = values[: len(columns)], values[len(columns) :]
            for s, some in enumerate(chosen):
                away = _nearest(x, some)[1] if some else np.ones(batch.num_rows)
                with np.errstate(divide="ignore"):
                    race = np.where(away > 0, -np.log(u[s]) / away, np.inf)
                full = s in best and len(best[s][0]) >= rows
                first = np.flatnonzero((race < np.inf) & (race <= (best[s][0].max() if full else np.inf)))
                if len(first) > rows:
                    first = first[race[first] <= np.partition(race[first], rows - 1)[rows - 1]]
                at = pa.array(first)
                races, parts = race[first], [batch.column(i).take(at) for i in range(len(columns) + 1)]
                if s in best:
                    races = np.concatenate([best[s][0], races])
                    parts = [pa.concat_arrays([a, b]) for a, b in zip(best[s][1], parts)]
                if len(races) > rows:
                    # Rows with equal races are told apart by their keys later on, so all of them stay.
                    kept = np.flatnonzero(races <= np.partition(races, rows - 1)[rows - 1])
                    races, parts = races[kept], [p.take(pa.array(kept)) for p in parts]
                best[s] = races, parts
        for s, (races, parts) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(races), s, np.int32)), pa.array(races), *parts], ["start", "race", "key", *columns])

    shape = f"start int, race double, key {numbered.schema['key'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in columns)
    ship_package(points.sparkSession)
    place = F.row_number().over(Window.partitionBy("start").orderBy("race", "key"))
    ranked = numbered.mapInArrow(least, shape).withColumn("place", place).filter(F.col("place") <= rows)
    out: list[Centroids] = [[] for _ in tags]
    for r in ranked.orderBy("start", "place").collect():
        out[r["start"]].append(tuple(r[c] for c in columns))
    return out


def _best_of(candidates: Centroids, weights: list[float], k: int) -> Centroids:
    """A weighted fit of the candidates, bounded in number.

    It starts with the heaviest, then each time with the one of the greatest weight times squared distance to
    those taken.
    """
    x, w = np.array(candidates), np.array(weights)
    taken = [int(w.argmax())]
    while len(taken) < k:
        gain = w * _squares(x, [candidates[i] for i in taken]).min(axis=1)
        if gain.max() <= 0:
            break
        taken.append(int(gain.argmax()))
    old = x[taken]
    for _ in range(ROUNDS):
        place = _squares(x, old.tolist()).argmin(axis=1)
        size = np.bincount(place, w, len(old))
        sums = np.stack([np.bincount(place, w * c, len(old)) for c in x.T], axis=1)
        new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], old)
        moved, old = ((new - old) ** 2).sum(axis=1).max(), new
        if moved <= TOLERANCE**2:
            break
    return [tuple(c) for c in old.tolist()]


def _held(points: DataFrame, columns: list[str]) -> RDD:
    """The coordinates as blocks of doubles, column after column, which the executors hold."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["block"])

    ship_package(points.sparkSession)
    blocks = points.select(*columns).mapInArrow(pack, "block binary").rdd.map(lambda r: bytes(r.block))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _tallied(blocks: RDD, dimensions: int, centroids: dict) -> dict:
    """Per set and centroid (a row each) its rows, their squared distances and their sums, from one pass."""

    def add(some: Iterator[bytes]) -> Iterator[dict]:
        sums = {s: np.zeros((len(c), dimensions + 2)) for s, c in centroids.items()}
        for block in some:
            x = list(np.frombuffer(block).reshape(dimensions, -1))
            for s, c in centroids.items():
                place, squares = _nearest(x, c)
                sums[s][:, 0] += np.bincount(place, minlength=len(c))
                for j, part in enumerate([squares, *x], 1):
                    sums[s][:, j] += np.bincount(place, part, len(c))
        yield sums

    def both(a: dict, b: dict) -> dict:
        return {s: a[s] + b[s] for s in a}

    parts = blocks.mapPartitions(add)
    return parts.treeReduce(both) if sum(map(len, centroids.values())) > WIDE else parts.reduce(both)


def _settled(blocks: RDD, dimensions: int, firsts: dict[int, Centroids]) -> dict[int, Centroids]:
    """Each set of centroids moved to the means of their rows until they settle; a round of all is one pass."""
    now, moving = {k: np.array(c) for k, c in firsts.items()}, set(firsts)
    for _ in range(ROUNDS):
        found = _tallied(blocks, dimensions, {k: [tuple(c) for c in now[k].tolist()] for k in moving})
        for k, sums in found.items():
            size = sums[:, :1]
            new = np.where(size > 0, sums[:, 2:] / np.maximum(size, 1), now[k])
            moved, now[k] = ((new - now[k]) ** 2).sum(axis=1).max(), new
            if moved <= TOLERANCE**2:
                moving.discard(k)
        if not moving:
            break
    return {k: sorted(tuple(c) for c in centroids.tolist()) for k, centroids in now.items()}


def fit_kmeans(
    train: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    columns: list[str] = FEATURES,
    key: list[str] = KEY,
    starts: int = STARTS,
) -> tuple[Centroids, float]:
    """Fit on the scaled training rows; returns the centroids, sorted, and the inertia.

    Every start makes `DRAWS` draws of `DRAWN` rows with a chance in proportion to the squared distance to
    the rows it has and weighs them by the rows nearest to each; a fit of these gives its first centroids. The start with the
    least inertia over all rows wins, and its centroids move to the means of their rows until they settle; these rounds run
    on blocks of numbers that the executors hold. Chances come from hashes of ``key``, so rows and seed decide the result and
    partitions do not. ``train`` is read some times: pass a stored table. With fewer than k different rows there are
    fewer centroids.
    """
    return fit_each(train, [k], seed, columns, key, starts)[k]


def fit_each(
    train: DataFrame,
    ks: Iterable[int] = ELBOW_RANGE,
    seed: int = SEED,
    columns: list[str] = FEATURES,
    key: list[str] = KEY,
    starts: int = STARTS,
) -> dict[int, tuple[Centroids, float]]:
    """One fit per k (see `fit_kmeans`). They are independent, and share every pass over the rows."""
    ks = list(ks)
    points = train.select(*key, *[F.col(c).cast("double") for c in columns])
    if points.isEmpty():
        raise ValueError("no training rows")
    sets = [(k, start) for k in ks for start in range(starts)]

    def tags(draw: int) -> list[str]:
        return [f"{seed}/{k}/{start}/{draw}" for k, start in sets]

    candidates = _drawn(points, columns, key, tags(0), [[]] * len(sets), 1)
    for draw in range(1, DRAWS + 1):
        more = _drawn(points, columns, key, tags(draw), candidates, DRAWN)
        candidates = [a + b for a, b in zip(candidates, more)]
    blocks = _held(points, columns)
    try:
        weighed = _tallied(blocks, len(columns), dict(zip(sets, candidates)))
        fits = {(k, s): _best_of(some, weighed[k, s][:, 0].tolist(), k) for (k, s), some in zip(sets, candidates)}

        def inertia(some: dict) -> dict:
            return {s: float(sums[:, 1].sum()) for s, sums in _tallied(blocks, len(columns), some).items()}

        costs = inertia(fits)
        best = {k: fits[k, min(range(starts), key=lambda s: (costs[k, s], s))] for k in ks}
        centroids = _settled(blocks, len(columns), best)
        totals = inertia(centroids)
    finally:
        blocks.unpersist()
    return {k: (centroids[k], totals[k]) for k in ks}


def nearest_centroid(
    points: DataFrame, centroids: Centroids, columns: list[str] = FEATURES
) -> DataFrame:
    """Add ``cluster`` and ``distance`` (Euclidean) by column expressions over the k centroids."""

    def to(centroid: Centroid) -> Column:
        squares = [(F.col(c) - x) * (F.col(c) - x) for c, x in zip(columns, centroid)]
        return F.sqrt(sum(squares[1:], squares[0]))

    return (
        points.withColumn("_distances", F.array(*[to(c) for c in centroids]))
        .withColumn("distance", F.array_min("_distances"))
        .withColumn(
            "cluster", (F.array_position("_distances", F.col("distance")) - 1).cast("int")
        )
        .drop("_distances")
    )


def cluster_thresholds(
    train_scored: DataFrame, percentile: float = THRESHOLD_PERCENTILE
) -> DataFrame:
    """(cluster, threshold): exact percentile of the training distances per cluster."""
    return percentile_by_group(train_scored, "cluster", "distance", percentile)


def kmeans_anomalies(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Scored rows beyond their cluster's threshold; clusters without one flag nothing.

    The thresholds are one row per cluster, so that side is broadcast.
    """
    return (
        scored.join(F.broadcast(thresholds), "cluster")
        .filter(F.col("distance") > F.col("threshold"))
        .select(*KEY, F.lit(1).alias("anomaly_flag"), "cluster", "distance")
    )


def elbow_curve(train: DataFrame, ks: range = ELBOW_RANGE, seed: int = SEED) -> DataFrame:
    """(k, inertia) of one fit per k on a stored training table."""
    rows = [(k, inertia) for k, (_, inertia) in fit_each(train, ks, seed).items()]
    return train.sparkSession.createDataFrame(rows, "k int, inertia double")
