"""Passages that repeat across documents, found through difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python, same_row, text_key, whole_text, wrapped
from barwatch.llm.textarrays import chunks, spread_ranges
from barwatch.llm.wordarrays import Words
from barwatch.session import materialize

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
"""A difference cover of ``PERIOD``: every difference modulo 31 is one of two members."""

ANCHOR = WINDOW - PERIOD + 1
"""Words of an anchor: two equal windows have an anchor at a cover position of both inside them."""


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position in the text, number of the word) of every anchor of texts with a window."""
    sizes = np.diff(words.first)
    texts = np.flatnonzero(sizes >= WINDOW)
    places = sizes[texts] - ANCHOR + 1
    owner = np.repeat(texts, places)
    position = spread_ranges(np.zeros(len(texts), np.int64), places)
    here = np.isin(np.arange(PERIOD), COVER)[position % PERIOD]
    owner, position = owner[here], position[here]
    return owner, position, words.first[owner] + position


def _per_chunk(texts: list[str]) -> Iterator[tuple[int, int, Words]]:
    for i, j in chunks(texts):
        yield i, j, Words(texts[i:j])


def contents(docs: DataFrame) -> DataFrame:
    """(_id, _tk, _a, _b, _n, _sha) per row: hashes and number of the words, SHA-256 of them in one line."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in _per_chunk(batch.column(2).to_pylist()):
                a, b = words.contents()
                bounds = words.first.tolist()
                sha = [hashlib.sha256(b" ".join(words.texts(x, y))).hexdigest() for x, y in zip(bounds, bounds[1:])]
                keys = [batch.column(k).slice(i, j - i) for k in range(2)]
                columns = [*keys, *map(pa.array, (a, b, np.diff(words.first), sha))]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_tk", "_a", "_b", "_n", "_sha"])

    kind = docs.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, _tk struct<a:bigint,b:bigint>, _a long, _b long, _n long, _sha string"
    return in_python(docs.select("_id", "_tk", "_text"), read, shape)


def anchor_rows(docs: DataFrame, positions: bool) -> DataFrame:
    """(_h, _a[, _pos]) per anchor: its hash, its content's hash, its place in the text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in _per_chunk(batch.column(0).to_pylist()):
                owner, position, at = anchors(words)
                columns = [words.sequences(at, at + ANCHOR, 0).view(np.int64), words.contents()[0][owner]]
                names = ["_h", "_a"]
                if positions:
                    columns.append(position.astype(np.int32))
                    names.append("_pos")
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return in_python(docs.select("_text"), read, "_h long, _a long" + ", _pos int" * positions)


def window_rows(open_docs: DataFrame) -> DataFrame:
    """(_wa, _wb, _id, _a, _b, _start): the windows around the anchors of each open document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = batch.column("_text").to_pylist(), batch.column("_places").to_pylist()
            for i, j, words in _per_chunk(texts):
                owner, start = [], []
                for k in range(j - i):
                    n = words.first[k + 1] - words.first[k]
                    p = np.array(places[i + k], np.int64)
                    near = np.zeros(n + PERIOD + 1, np.int64)
                    np.add.at(near, np.maximum(p - PERIOD + 1, 0), 1)
                    np.add.at(near, p + 1, -1)
                    some = np.flatnonzero(np.cumsum(near)[: max(n - WINDOW + 1, 0)])
                    owner.append(np.full(len(some), k))
                    start.append(some)
                owner, start = np.concatenate(owner), np.concatenate(start)
                at = words.first[owner] + start
                rows = pa.array(owner + i)
                hashed = [pa.array(words.sequences(at, at + WINDOW, k).view(np.int64)) for k in range(2)]
                kept = [batch.column(c).take(rows) for c in ("_id", "_a", "_b")]
                columns = [*hashed, *kept, pa.array(start.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["_wa", "_wb", "_id", "_a", "_b", "_start"])

    kind = open_docs.schema["_id"].dataType.simpleString()
    shape = f"_wa long, _wb long, _id {kind}, _a long, _b long, _start int"
    return in_python(open_docs.select("_id", "_a", "_b", "_text", "_places"), read, shape)


def cut(open_docs: DataFrame) -> DataFrame:
    """(_a, _b, _removed, _kept): each open document's words outside the windows that start at ``_gone``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column("_text").to_pylist(), batch.column("_gone").to_pylist()
            for i, j, words in _per_chunk(texts):
                removed, kept = [], []
                for k in range(j - i):
                    begin, end = int(words.first[k]), int(words.first[k + 1])
                    depth = np.zeros(end - begin + 1, np.int64)
                    start = np.array(gone[i + k], np.int64)
                    np.add.at(depth, start, 1)
                    np.add.at(depth, start + WINDOW, -1)
                    stays = np.cumsum(depth)[:-1] == 0
                    all_words = words.texts(begin, end)
                    removed.append(int((~stays).sum()))
                    kept.append(b" ".join([w for w, s in zip(all_words, stays.tolist()) if s]).decode("utf-8", "surrogatepass"))
                columns = [
                    batch.column("_a").slice(i, j - i), batch.column("_b").slice(i, j - i),
                    pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_a", "_b", "_removed", "_kept"])

    return in_python(open_docs.select("_a", "_b", "_text", "_gone"), read, "_a long, _b long, _removed long, _kept string")


def later(doc: Column, other: Column) -> Column:
    """Whether ``doc`` comes after ``other``; a null id comes after all others."""
    return F.coalesce((doc > other) | (doc.isNull() & other.isNotNull()), F.lit(False))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text, and _tk (`text_key`).

    Words are runs without white space, unchanged. Every word covered by a window of ``WINDOW`` words that
    also starts in a document with a smaller id is removed; windows are judged on the input.
    ``kept_text`` has the other words joined by one space where some were removed, and is null where
    none were; ``kept_sha256`` is of that text in both cases. Null and empty texts have no words. A
    null id counts as the largest; rows that share an id do not cut each other. Other columns are
    ignored; an empty table gives an empty result.

    Copies (equal words) are one content: the row with the smallest id stands for it, the others go whole.
    Anchors that only one content has lead nowhere; counting them is an aggregate with map-side
    combining, and the join back is split where a passage is hot. Only windows around shared anchors
    are hashed (128 bits), and the smallest id per window decides.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), text_key(text).alias("_tk"), whole_text(text).alias("_text"))
    known = materialize(contents(rows))
    first = known.groupBy("_a", "_b").agg(F.min("_id").alias("_first"))
    shared = materialize(
        anchor_rows(rows, False).groupBy("_h").agg(F.min("_a").alias("lo"), F.max("_a").alias("hi"))
        .filter("lo < hi").select("_h")
    )
    places = (
        anchor_rows(rows, True).join(shared, "_h", "left_semi")
        .groupBy("_a").agg(F.collect_set("_pos").alias("_places"))
    )
    wanted = first.join(places, "_a").withColumnRenamed("_first", "_id")
    plain = rows.select("_id", "_text")
    open_docs = materialize(same_content(plain.join(wanted, plain["_id"].eqNullSafe(wanted["_id"])).drop(wanted["_id"])))
    windows = materialize(window_rows(open_docs))
    earliest = (
        windows.groupBy("_wa", "_wb").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1").drop("_n")
    )
    gone = (
        windows.join(earliest, ["_wa", "_wb"]).filter(later(F.col("_id"), F.col("_first")))
        .groupBy("_a", "_b").agg(F.collect_set("_start").alias("_gone"))
    )
    changed = cut(open_docs.join(gone, ["_a", "_b"]).dropDuplicates(["_a", "_b"]))
    changed = materialize(changed.withColumn("_kept_sha", F.sha2("_kept", 256)))
    copy = later(F.col("_id"), F.col("_first")) & (F.col("_n") >= WINDOW)
    return (
        known.join(first, ["_a", "_b"])
        .join(changed, ["_a", "_b"], "left")
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_n").alias("n_words"),
            F.when(copy, F.col("_n")).otherwise(F.coalesce("_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_kept_sha", "_sha")).alias("kept_sha256"),
            F.when(copy, F.lit("")).otherwise(F.col("_kept")).alias("kept_text"),
            "_tk",
        )
    )


def same_content(joined: DataFrame) -> DataFrame:
    """Rows whose text has the words that ``_a`` and ``_b`` stand for; ids may repeat."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_a", "_b"))
            for i, j, words in _per_chunk(batch.column("_text").to_pylist()):
                own = words.contents()
                same = (own[0] == a[i:j]) & (own[1] == b[i:j])
                yield batch.slice(i, j - i).filter(pa.array(same))

    names = ["_id", "_text", "_a", "_b", "_places"]
    kind = joined.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, _text string, _a long, _b long, _places array<int>"
    return in_python(joined.select(*names), read, shape)


def drop_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated passages: cut texts have their kept words joined by one space.

    Rows of which no word is left are dropped; untouched rows keep their text as it is, empty ones
    included. All columns stay; ``n_chars``, if there is one, is counted anew.
    """
    cuts = repeated_passages(docs, doc_id, text).filter("n_removed > 0")
    cuts = materialize(cuts.select(F.col("doc_id").alias("_id"), "_tk", "kept_text").dropDuplicates(["_id", "_tk"]))
    rows = wrapped(docs, doc_id, text)
    kept = rows.join(cuts, same_row(rows, cuts), "left").filter("kept_text is null or kept_text != ''")
    new = F.coalesce("kept_text", F.col("_row")[text])
    row = F.col("_row").withField(text, new)
    if "n_chars" in docs.columns:
        cut_size = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.coalesce(cut_size, F.col("_row")["n_chars"]))
    return kept.select(row.alias("_row")).select("_row.*")
