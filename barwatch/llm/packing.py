"""Packing documents into token windows with the lexical neighbours of a seed document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python, whole_text
from barwatch.llm.encoding import encoder
from barwatch.llm.textarrays import chunks, spread_ranges
from barwatch.session import materialize

WINDOW = 1024
SHARD = 512
"""Remainders that one inverted index holds."""

K1, B = 1.2, 0.75
VOCABULARY = 1 << 16
"""Token ids are below this; it bounds the collected document frequencies."""


def token_rows(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, ids): the 16-bit little-endian ids of every row's whole text and ``end_id``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end = encoder(path), np.array([end_id], "<u2").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in chunks(texts):
                ids = [x.astype("<u2").tobytes() + end for x in tool.encode(texts[i:j])]
                keys = batch.column(0).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))
    return in_python(rows, encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def document_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each id occurs, and the number of documents; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(VOCABULARY, np.int64), 0
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                found[np.unique(np.frombuffer(ids, "<u2"))] += 1
                rows += 1
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict(
            {"token": np.append(some, -1).astype(np.int32), "n": np.append(found[some], rows)}
        )

    parts = in_python(tokens.select("ids"), count, "token int, n long")
    out, rows = np.zeros(VOCABULARY, np.int64), 0
    for token, n in parts.groupBy("token").agg(F.sum("n")).collect():
        if token < 0:
            rows = n
        else:
            out[token] = n
    return out, rows


class Index:
    """Inverted index of a shard with BM25 weights."""

    def __init__(self, rows: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        sizes = np.array([len(r) for r in rows])
        owner = np.repeat(np.arange(len(rows)), sizes)
        keys, tf = np.unique(np.concatenate(rows).astype(np.int64) * len(rows) + owner, return_counts=True)
        term, self.doc = keys // len(rows), keys % len(rows)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.doc] / mean))
        self.starts = np.flatnonzero(np.diff(term, prepend=-1))
        self.sizes = np.diff(np.append(self.starts, len(term)))
        number = np.searchsorted(term[self.starts], term)
        order = np.argsort(self.doc, kind="stable")
        self.terms = np.split(number[order], np.cumsum(np.bincount(self.doc, minlength=len(rows)))[:-1])
        self.rows = len(rows)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every row for the distinct terms of row ``seed``."""
        terms = self.terms[seed]
        at = spread_ranges(self.starts[terms], self.sizes[terms])
        return np.bincount(self.doc[at], self.weight[at], self.rows)


def windows(rows: list[np.ndarray], index: Index, last: bool) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of pieces (row, begin, length) that fill a window each; only the last may be short.

    The longest unused row is the seed; its unused neighbours follow by score (then by row) until the
    window is full, and a neighbour that is too long is cut, its rest staying unused. Unless ``last``,
    a window that would be short is not given, so its rows can join the next shard.
    """
    begin = np.zeros(len(rows), np.int64)
    left = np.array([len(r) for r in rows])
    for seed in np.argsort(-left, kind="stable").tolist():
        if not left[seed]:
            continue
        if left.sum() < WINDOW and not last:
            break
        pieces, room = [], WINDOW
        scores = np.where(left > 0, index.scores(seed), -1.0)
        scores[seed] = np.inf
        for row in np.argsort(-scores, kind="stable").tolist():
            take = int(min(room, left[row]))
            if take:
                pieces.append((row, int(begin[row]), take))
                begin[row] += take
                left[row] -= take
                room -= take
            if not room:
                break
        yield pieces
    rest = [(i, int(begin[i]), int(left[i])) for i in np.flatnonzero(left).tolist()]
    if rest:
        yield rest


def pack(
    docs: DataFrame, path: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids, doc_tokens, ids_crc32, sequence_id, offset.

    Every row of ``docs`` becomes its ids and ``end_id`` (null and empty texts: that id alone).
    ``ids`` of a piece are 16-bit little-endian numbers; ``start`` counts the row's ids before it,
    ``offset`` is its place in the sequence. Each id is in one piece. Sequences hold at most
    ``WINDOW`` ids; what is missing is padding, at most one short sequence per task. Rows that repeat
    are documents of their own; null ids and other columns do no harm; an empty table gives no rows.

    Whole windows are cut off a document's head. The remainders are sorted by their id of
    greatest weight, so that lexical neighbours and copies meet, and a common one is split over tasks by
    the row's id. Each task reads its remainders in order, indexes ``SHARD`` at a time with document
    frequencies of the whole corpus, and packs them.
    """
    tokens = materialize(token_rows(docs, path, end_id, doc_id, text))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    frequencies, n_docs = document_frequencies(tokens)
    idf = np.log1p((n_docs - frequencies + 0.5) / (frequencies + 0.5))
    shape = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, ids_crc32 long"

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = Pieces()
            for i, ids in enumerate(batch.column(1).to_pylist()):
                n = len(ids) // 2
                for at in range(0, n - n % WINDOW, WINDOW):
                    out.add(i, at, WINDOW, ids[2 * at : 2 * (at + WINDOW)], n)
            yield out.batch(batch.column(0))

    def remainders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, route = Pieces(), []
            for i, ids in enumerate(batch.column(1).to_pylist()):
                n = len(ids) // 2
                if n % WINDOW:
                    tail = ids[2 * (n - n % WINDOW) :]
                    some, tf = np.unique(np.frombuffer(tail, "<u2"), return_counts=True)
                    out.add(i, n - n % WINDOW, n % WINDOW, tail, n)
                    route.append(int(some[np.argmax(idf[some] * tf / (tf + K1))]))
            yield out.batch(batch.column(0), route=pa.array(route, pa.int32()))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 33, 0
        held: list[tuple] = []

        def shard(last: bool) -> pa.RecordBatch:
            nonlocal made, held
            rows = [np.frombuffer(h[3], "<u2") for h in held]
            index = Index(rows, idf, float(np.mean([len(r) for r in rows])))
            out, keys, sequence, offset, rest = Pieces(), [], [], [], []
            for pieces in windows(rows, index, last):
                full = sum(p[2] for p in pieces) == WINDOW
                if not full and not last:
                    for row, at, n in pieces:
                        key, start, _, ids, total = held[row]
                        rest.append((key, start + at, n, ids[2 * at : 2 * (at + n)], total))
                    continue
                place = 0
                for row, at, n in pieces:
                    key, start, _, ids, total = held[row]
                    out.add(len(keys), start + at, n, ids[2 * at : 2 * (at + n)], total)
                    keys.append(key)
                    sequence.append(base + made)
                    offset.append(place)
                    place += n
                made += 1
            held = rest
            return out.batch(
                pa.array(keys, key_type), sequence_id=pa.array(sequence, pa.int64()), offset=pa.array(offset, pa.int64())
            )

        for batch in batches:
            key_type = batch.schema.field("doc_id").type
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "start", "length", "ids", "doc_tokens")]
            for row in zip(*columns):
                held.append(row)
                if len(held) >= SHARD:
                    yield shard(False)
        if held:
            yield shard(True)

    whole = in_python(tokens, heads, shape).withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")}
    )
    tails = (
        in_python(tokens, remainders, f"{shape}, route int")
        .repartitionByRange("route", "doc_id", "ids", "start")
        .sortWithinPartitions("route", "doc_id", "ids", "start")
    )
    rest = in_python(tails, packed, f"{shape}, sequence_id long, offset long").withColumn(
        "sequence_id", F.col("sequence_id") * 2 + 1
    )
    return whole.unionByName(rest)


def checksum(ids: bytes) -> int:
    """CRC-32 of 16-bit ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


class Pieces:
    """Rows of pieces that refer to the rows of a batch."""

    def __init__(self) -> None:
        self.rows: list[int] = []
        self.values: list[tuple] = []

    def add(self, row: int, *values) -> None:
        self.rows.append(row)
        self.values.append(values)

    def batch(self, keys: pa.Array, **more: pa.Array) -> pa.RecordBatch:
        start, length, ids, total = zip(*self.values) if self.values else ((), (), (), ())
        columns = {
            "doc_id": keys.take(pa.array(self.rows, pa.int64())),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids": pa.array(ids, pa.binary()),
            "doc_tokens": pa.array(total, pa.int64()),
            "ids_crc32": pa.array([checksum(x) for x in ids], pa.int64()),
        } | more
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
