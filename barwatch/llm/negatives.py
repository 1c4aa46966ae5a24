"""Hard negatives: scores of anchors against all rows, mined by a secondary sort and a streaming pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python
from barwatch.llm.vectors import finite
from barwatch.session import materialize

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100
"""A negative's score is from ``LOW`` to ``HIGH`` parts in ``WHOLE`` of the positive's."""

SCALE = 256
GROUP = 65_536
LEAST = 4096
"""Rows a task holds at once, about: `GROUP` at most, and no fewer than `LEAST` for the sake of more tasks. Anchors stream past them."""

LARGEST = 1 << 24
"""Scaled components up to which scores, a hundredfold, fit into 64 bits (up to 1,024 components)."""

PRODUCTS = 1 << 21
"""Scores computed at once."""

ROWS = "_g long, _dim int, _kind int, _id long, _label int, _v binary, _p array<long>"


def taking_part(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(_id, _label, _dim, _v): ids, changed labels and integer vectors as little-endian 32-bit bytes."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("_id"), F.col(label).cast("int").alias("_label"), F.col(vector).alias("_vec"))
    rows = rows.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_vec").isNotNull() & finite("_vec"))
    changed = F.when(F.col("_id") % 7 == 0, (F.col("_label") + 1) % 10).otherwise(F.col("_label"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if flat.size and np.abs(flat).max() > LARGEST:
                raise ValueError(f"a component beyond {LARGEST // SCALE} gives scores beyond 64 bits")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            data, ends = flat.astype("<i4").tobytes(), 4 * np.cumsum(sizes, dtype=np.int64)
            held = [data[e - 4 * n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(held, pa.binary())], ["_id", "_label", "_dim", "_v"]
            )

    return in_python(rows.select("_id", changed.cast("int").alias("_label"), "_vec"), pack, "_id long, _label int, _dim int, _v binary")


class Held:
    """The rows of one group and dimension, by id; anchors are scored against all of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.wide = self.x.astype(float)

    def keys(self, anchors: np.ndarray) -> np.ndarray:
        """Score and place in one number, per anchor and row: greater is better, ties by smaller id."""
        most = self.x.shape[1] * int(np.abs(self.x).max(initial=0)) * int(np.abs(anchors).max(initial=0))
        if most < 1 << 53:
            scores = (anchors.astype(float) @ self.wide.T).astype(np.int64)
        else:
            scores = anchors.astype(np.int64) @ self.x.T.astype(np.int64)
        if most * len(self.ids) < 1 << 62:
            return scores * len(self.ids) + np.arange(len(self.ids) - 1, -1, -1)
        return scores.astype(object) * len(self.ids) + np.arange(len(self.ids) - 1, -1, -1).astype(object)

    def decoded(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and score of each key."""
        return len(self.ids) - 1 - (keys % len(self.ids)).astype(np.int64), (keys // len(self.ids)).astype(np.int64)

    def best_positives(self, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, ids, scores): the first rows of the anchor's label, itself excluded, in this group."""
        keys = self.keys(anchors)
        for k, key in enumerate(keys):
            own = np.flatnonzero((self.labels == labels[k]) & (self.ids != ids[k]))
            if len(own) > POSITIVES:
                own = own[np.argpartition(key[own], len(own) - POSITIVES)[-POSITIVES:]]
            place, score = self.decoded(key[own])
            yield k, self.ids[place], score

    def best_negatives(self, labels: np.ndarray, anchors: np.ndarray, positives: list[list[int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, ids, scores): the first rows of other labels within any of the anchor's windows, in this group."""
        keys = self.keys(anchors)
        n = len(self.ids)
        for k, key in enumerate(keys):
            other = np.sort(key[self.labels != labels[k]])
            spans = []
            for low, high in {window(p) for p in positives[k]}:
                # Keys of scores up to high end below (high + 1) * n.
                end = int(np.searchsorted(other, (high + 1) * n))
                begin = max(int(np.searchsorted(other, low * n)), end - NEGATIVES)
                spans += range(begin, end)
            if spans:
                place, score = self.decoded(other[sorted(set(spans))])
                yield k, self.ids[place], score


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative that belongs to a positive's score."""
    return -(-LOW * positive // WHOLE), HIGH * positive // WHOLE


def facing(rows: DataFrame, anchors: DataFrame, groups: int) -> DataFrame:
    """Rows dealt into ``groups`` and every anchor beside each group, rows first: sorted for one streaming pass.

    The anchors, a hundredth of the rows, are what is repeated, once per ``GROUP`` rows.
    """
    none = F.lit(None).cast("array<long>")
    dealt = rows.select(F.pmod(F.xxhash64("_id", "_v"), F.lit(groups)).alias("_g"), "_dim", F.lit(0).alias("_kind"), "_id", "_label", "_v", none.alias("_p"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("_g")
    asked = anchors.select(every, "_dim", F.lit(1).alias("_kind"), "_id", "_label", "_v", "_p")
    keys = ["_g", "_dim"]
    both = dealt.unionByName(asked)
    return both.repartition(groups, *keys).sortWithinPartitions(*keys, "_kind", "_id")


def scored(rows: DataFrame, anchors: DataFrame, groups: int, negatives: bool) -> DataFrame:
    """(_anchor, _positive, _score, _id): per group the positives, or the negatives in their windows, that can matter."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, parts = None, None, []
        for batch in batches:
            g, dim, kind = (batch.column(i).to_numpy() for i in range(3))
            ids, labels = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(dim) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if i == j:
                    continue
                here = (g[i], dim[i])
                if here != at:
                    at, held, parts = here, None, []
                x = np.frombuffer(b"".join(batch.column(5).slice(i, j - i).to_pylist()), "<i4").reshape(j - i, dim[i])
                if kind[i] == 0:
                    parts.append((ids[i:j], labels[i:j], x))
                    continue
                if parts:
                    held = Held(*(np.concatenate(some) for some in zip(*parts)))
                    parts = []
                if held is None:
                    continue
                step = max(1, PRODUCTS // len(held.ids))
                for a in range(i, j, step):
                    b = min(a + step, j)
                    some = x[a - i : b - i]
                    if negatives:
                        found = held.best_negatives(labels[a:b], some, batch.column(6).slice(a, b - a).to_pylist())
                    else:
                        found = held.best_positives(ids[a:b], labels[a:b], some)
                    out = [(np.full(len(names), ids[a + k]), np.full(len(names), labels[a + k]), names, scores) for k, names, scores in found]
                    if out:
                        anchor, label, name, value = (np.concatenate(c) for c in zip(*out))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor), pa.array(label), pa.array(np.full(len(name), dim[i])), pa.array(value), pa.array(name)],
                            ["_anchor", "_label", "_dim", "_score", "_id"],
                        )

    return in_python(facing(rows, anchors, groups), score, "_anchor long, _label int, _dim int, _score long, _id long")


def mined(pairs: DataFrame) -> DataFrame:
    """The result rows, from pairs sorted by (anchor, descending score, positives first, id) within partitions.

    One pass over an anchor's pairs: each of its first positives opens a window, each negative goes to the open
    windows it lies in until they are full. Only the open windows are held. A positive comes before all
    negatives of its window, as these score at most nine tenths of it, or zero as it does itself.
    """
    keys = ["_anchor", "_label", "_dim"]
    down = -F.col("_score")
    ordered = pairs.withColumn("_down", down).repartition(*keys).sortWithinPartitions(*keys, "_down", "_negative", "_id")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened = None, []
        for batch in batches:
            out = []
            for *here, down, negative, name in zip(*(batch.column(c).to_pylist() for c in (*keys, "_down", "_negative", "_id"))):
                if here != anchor:
                    anchor, opened, seen = here, [], 0
                score = -down
                if not negative:
                    if seen < POSITIVES:
                        opened.append([name, score, *window(score), 0])
                    seen += 1
                    continue
                for w in opened:
                    if w[2] <= score <= w[3] and w[4] < NEGATIVES:
                        w[4] += 1
                        out.append((here[0], w[0], w[4], name, w[1], score))
            if out:
                a, p, rank, n, ps, ns = zip(*out)
                columns = [pa.array(c, t) for c, t in zip((a, p, rank, n, ps, ns), [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 3)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return in_python(ordered.select(*keys, "_down", "_negative", "_id"), stream, shape)


def hard_negatives(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. A row's score is the inner product of its integer
    vector, floor(256 * x), with the anchor's; higher scores come first, ties by smaller id. An anchor's
    positives are its first 5 other rows of the same label, and each positive gets the first 10 rows of other
    labels that score 30 to 90 hundredths of it. Labels of ids divisible by 7 are (label + 1) % 10 before.

    Two scoring passes deal all rows into groups of about ``GROUP`` and stream the anchors past each: the first
    finds a group's best positives, the second, with the positives known, its first negatives per window. So
    what is shuffled grows with anchors times groups, not with pairs, and no row that could be in a result is left out.
    The pairs then meet in a secondary sort by (anchor, descending score, id) and one streaming pass.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Scores are only taken between
    vectors of equal length. A row that repeats is a positive or negative as often as it is there; an anchor that
    repeats is asked once for each label it has, with the vector that sorts first, and rows with its id are no
    positives of it. An empty table gives no rows; other columns are ignored. Components beyond 65,536 raise an error.
    """
    rows = materialize(taking_part(vectors, vec_id, vector, label))
    keys = ["_id", "_label", "_dim"]
    anchors = materialize(rows.filter(F.col("_id") % every == 0).groupBy(*keys).agg(F.min("_v").alias("_v")))
    spark = rows.sparkSession
    size, tasks = rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-size // GROUP), min(tasks, size // LEAST))
    none = F.lit(None).cast("array<long>")

    def keyed(found: DataFrame) -> DataFrame:
        return found.select("_anchor", "_label", "_dim", "_score", "_id")

    positives = materialize(keyed(scored(rows, anchors.withColumn("_p", none), groups, False)))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("_score")).alias("d"), "_id"))), 1, POSITIVES)
    known = positives.groupBy(F.col("_anchor").alias("_id"), "_label", "_dim").agg(best.alias("_best"))
    known = known.withColumn("_p", F.transform("_best", lambda b: -b["d"])).drop("_best")
    negatives = keyed(scored(rows, anchors.join(known, keys), groups, True))
    return mined(positives.withColumn("_negative", F.lit(False)).unionByName(negatives.withColumn("_negative", F.lit(True))))
