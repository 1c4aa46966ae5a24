"""Near duplicates by order min-hash sketches, verified by banded alignment."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.functions.components import components
from barwatch.llm.common import grouped_rows, in_python, numbered_rows, whole_text, wrapped
from barwatch.llm.textarrays import chunks, mixed
from barwatch.llm.wordarrays import Words
from barwatch.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
TABLES = 28
TAKEN = 5
"""Shingles per sketch. A pair of long texts at the threshold shares one sketch with probability 0.8**5 = 0.33,
so all 28 tables miss it with probability 1.4e-5; shingles are drawn without replacement, so shorter texts are
missed more often: 36 in 45 shingles with 3.2e-5. A pair that shares a tenth is a candidate with 3e-4."""

SHORT = 40
"""Texts of up to so many shingles also have their rarest ones as keys: pairs of them are never missed."""

CHUNK = 256
"""Nodes of a chunk of a bucket, about."""

STRIP = 8192
"""Shingles of a block that are compared in one matrix product."""

STRETCH = 1 << 14
"""Shingles whose keyed values are held at once."""

SEEDS = mixed(np.arange(1, TABLES + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(words: Words, text: int) -> np.ndarray:
    """Hashes of the text's runs of ``SHINGLE`` words; of all words where there are fewer."""
    begin, end = int(words.first[text]), int(words.first[text + 1])
    if end - begin <= SHINGLE:
        some = np.array([begin] if end > begin else [], np.int64)
        return words.sequences(some, some + (end - begin), 0)
    some = np.arange(begin, end - SHINGLE + 1)
    return words.sequences(some, some + SHINGLE, 0)


def all_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all texts one after the other, and the offsets of the texts."""
    sizes = np.diff(words.first)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    begin = words.first[owner] + np.arange(len(owner)) - offsets[owner]
    return words.sequences(begin, begin + np.minimum(SHINGLE, sizes[owner]), 0), offsets


def labelled(hashed: np.ndarray) -> np.ndarray:
    """Shingles told apart by how often they occurred before in the text."""
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    opens = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    occurrence = np.empty(len(hashed), np.uint64)
    occurrence[order] = np.arange(len(hashed)) - np.repeat(opens, np.diff(np.append(opens, len(hashed))))
    return mixed(hashed + occurrence * np.uint64(0xC2B2AE3D27D4EB4F))


def sketches(hashed: np.ndarray) -> np.ndarray:
    """One 64-bit hash per table: its ``TAKEN`` smallest labelled shingles, in text order.

    A shingle is labelled with how often it occurred before, so repeats count. Texts with fewer
    shingles give all of them.
    """
    places = least_places(labelled(hashed))
    code = SEEDS
    for step in range(places.shape[1]):
        code = mixed((code ^ hashed[places[:, step]]) * np.uint64(0x94D049BB133111EB) + np.uint64(1))
    return code


def least_places(values_of: np.ndarray) -> np.ndarray:
    """Per table the places of the ``TAKEN`` smallest keyed values, in text order."""
    values = np.zeros((TABLES, 0), np.uint64)
    places = np.zeros((TABLES, 0), np.int64)
    for at in range(0, len(values_of), STRETCH):
        keyed = (values_of[None, at : at + STRETCH] ^ SEEDS[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
        keyed ^= keyed >> np.uint64(32)
        here = np.broadcast_to(np.arange(at, at + keyed.shape[1]), keyed.shape)
        values, places = np.concatenate([values, keyed], axis=1), np.concatenate([places, here], axis=1)
        if values.shape[1] > TAKEN:
            least = np.argpartition(values, TAKEN - 1, axis=1)[:, :TAKEN]
            values, places = np.take_along_axis(values, least, 1), np.take_along_axis(places, least, 1)
    return np.sort(places, axis=1)


def alignment(a: list[int], b: list[int]) -> float:
    """Similarity of two shingle sequences: aligned over distinct places, m / (len a + len b - m).

    ``m`` is the longest common subsequence within the band that pairs of at least ``SIMILARITY`` cannot
    leave, so the result is exact for them and at most the true value for others. Rows of the
    alignment are bit vectors. A bound from the common shingles without order comes first.
    """
    if len(a) > len(b):
        a, b = b, a
    total = len(a) + len(b)
    need = SIMILARITY * total / (1 + SIMILARITY)
    if len(a) < need - 1e-9 or sum((Counter(a) & Counter(b)).values()) < need - 1e-9:
        return 0.0
    band = int(total - 2 * need) + 1
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    width = (1 << (2 * band + 1)) - 1
    for j, y in enumerate(b):
        match = at.get(y, 0)
        if match:
            match &= width << (j - band) if j >= band else width >> (band - j)
            found = open_bits & match
            if found:
                open_bits = ((open_bits + found) | (open_bits - found)) & full
    m = len(a) - open_bits.bit_count()
    return m / (total - m)


def sketch_rows(docs: DataFrame) -> DataFrame:
    """(_id, _node, _n, _sketches, _labelled) per row: raw text's hash, number of shingles, sketches.

    ``_labelled`` are the labelled shingles of texts with at most ``SHORT``, else empty.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in chunks(texts):
                words = Words(texts[i:j])
                hashed, offsets = all_shingles(words)
                bounds = offsets.tolist()
                made = [
                    sketches(hashed[x:y]).view(np.int64) if y > x else np.zeros(0, np.int64)
                    for x, y in zip(bounds, bounds[1:])
                ]
                short = [labelled(hashed[x : y if y - x <= SHORT else x]).view(np.int64) for x, y in zip(bounds, bounds[1:])]
                keys = [batch.column(k).slice(i, j - i) for k in range(2)]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (made, short)]
                names = ["_id", "_node", "_n", "_sketches", "_labelled"]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(np.diff(offsets)), *lists], names)

    kind = docs.schema["_id"].dataType.simpleString()
    return in_python(docs, read, f"_id {kind}, _node binary, _n long, _sketches array<long>, _labelled array<long>")


def short_keys(nodes: DataFrame) -> DataFrame:
    """(_row, _n, _bucket): the rarest labelled shingles of each short text that other texts have as well.

    Of n shingles a partner shares at least 0.8 n, so in one order of all shingles the first of those two
    texts share stands among the first n - ceil(0.8 n) + 1 of both.
    """
    single = nodes.select("_row", "_n", F.explode("_labelled").alias("_bucket"))
    often = single.groupBy("_bucket").agg(F.count("*").alias("_often"))
    listed = F.sort_array(F.collect_list(F.struct("_often", "_bucket")))
    ranked = single.join(often, "_bucket").groupBy("_row", "_n").agg(listed.alias("_all"))
    first = (F.col("_n") - F.ceil(F.col("_n") * SIMILARITY - 1e-9) + 1).cast("int")
    keys = ranked.select("_row", "_n", F.explode(F.slice("_all", F.lit(1), first)).alias("_key"))
    return keys.filter("_key._often > 1").select("_row", "_n", F.col("_key._bucket").alias("_bucket"))


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the pairs whose alignment reaches ``SIMILARITY``; ``texts`` has (_row, _text)."""
    left = texts.select(F.col("_row").alias("a"), F.col("_text").alias("_left"))
    right = texts.select(F.col("_row").alias("b"), F.col("_text").alias("_right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch.column(k).to_pylist() for k in (2, 3)]
            near = []
            for i in range(batch.num_rows):
                words = Words([texts[0][i], texts[1][i]])
                near.append(alignment(*(shingles(words, k).tolist() for k in range(2))) >= SIMILARITY - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return in_python(both.select("a", "b", "_left", "_right"), check, "a long, b long")


def overlaps(all_labelled: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """How many labelled shingles every two texts share, by products of incidence strips."""
    _, number, count = np.unique(all_labelled, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    place = np.cumsum(count > 1) - 1
    column, owner = place[number[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((texts, texts), np.float32)
    for at in range(0, int((count > 1).sum()), STRIP):
        lo, hi = np.searchsorted(column, [at, at + STRIP])
        strip = np.zeros((texts, STRIP), np.float32)
        strip[owner[lo:hi], column[lo:hi] - at] = 1
        out += strip @ strip.T
    return out


def block_links(blocks: DataFrame) -> DataFrame:
    """(a, b): roots of classes of a block's rows that a verified link connects.

    ``blocks``: (_bucket, _lo, _hi, _chunk, _row, root, _text), the rows of two chunks of a bucket (or of
    one). Rows of one class are not compared, nor rows of one chunk where there are two; a pair that the
    links found before it connect is not verified again.
    """
    names = ["_bucket", "_lo", "_hi", "_chunk", "_row", "root", "_text"]
    ordered = blocks.select(*names).repartition("_bucket", "_lo", "_hi").sortWithinPartitions("_bucket", "_lo", "_hi", "_row")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lo, hi), rows in grouped_rows(batches, 3):
            roots = np.array([r[5] for r in rows])
            if (roots == roots[0]).all():
                continue
            hashed, offsets = all_shingles(Words([r[6] for r in rows]))
            own = [hashed[i:j] for i, j in zip(offsets.tolist(), offsets[1:].tolist())]
            sizes = np.diff(offsets)
            common = overlaps(np.concatenate([labelled(x) for x in own]), np.repeat(np.arange(len(rows)), sizes), len(rows))
            near = common >= (SIMILARITY - 1e-6) * (sizes[:, None] + sizes[None, :] - common)
            near &= roots[:, None] != roots[None, :]
            given = roots.copy()
            if lo != hi:
                chunk = np.array([r[3] for r in rows])
                near &= chunk[:, None] != chunk[None, :]
            found = []
            for i, j in zip(*np.nonzero(np.triu(near, 1))):
                if roots[i] != roots[j] and alignment(own[i].tolist(), own[j].tolist()) >= SIMILARITY - 1e-9:
                    roots[roots == roots[j]] = roots[i]
                    found.append((int(min(given[i], given[j])), int(max(given[i], given[j]))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return in_python(ordered, link, "a long, b long")


def length_fits(a: str, b: str) -> Column:
    """Whether texts with so many shingles can reach the similarity."""
    return F.least(a, b) >= F.greatest(a, b) * SIMILARITY - 1e-9


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, and _node (hash of the raw text).

    Two texts are near duplicates if the shingles of five words that an alignment pairs in order
    are at least 0.8 of all. Classes are what such pairs connect; ``class_id`` is the smallest id in the
    class and ``kept`` marks its rows. Texts without words are no one's duplicate: their class is their
    own id. A null id comes after all others. Rows that repeat id and text are marked alike;
    ``drop_near`` keeps one of them. Other columns are ignored; an empty table gives an empty result.

    Equal texts are one node. Candidates are nodes that share a sketch in some table, or a rare shingle
    if both are short (`short_keys`, no pair is missed), and whose lengths allow the similarity. First every node is compared with the smallest partner of its buckets. Then
    only buckets that still hold several classes are worked on, in blocks of ``CHUNK`` nodes: a block
    compares its classes and gives the links that connect them. So no link between classes is
    lost, no bucket is paired out into rows, and a bucket of near copies is mostly one class by then.
    """
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.unhex(F.md5(whole_text(text))).alias("_node"), whole_text(text).alias("_text")
    )
    known = materialize(sketch_rows(rows))
    distinct = (
        known.filter("_n > 0").groupBy("_node")
        .agg(F.min("_id").alias("_least"), F.first("_n").alias("_n"), F.first("_sketches").alias("_sketches"), F.first("_labelled").alias("_labelled"))
    )
    numbered, _ = numbered_rows(distinct, "_node")
    nodes = materialize(numbered)
    entries = nodes.select("_row", "_n", F.explode("_sketches").alias("_bucket")).unionByName(short_keys(nodes))
    entries = materialize(entries)
    heads = (
        entries.groupBy("_bucket").agg(F.min(F.struct("_row", "_n")).alias("_head"), F.count("*").alias("_many"))
        .filter("_many > 1")
    )
    members = materialize(entries.join(heads, "_bucket").select("_bucket", "_row", "_n", "_head"))
    stars = materialize(
        members.filter(F.col("_row") != F.col("_head._row")).withColumn("_m", F.col("_head._n"))
        .filter(length_fits("_n", "_m"))
        .select(F.col("_head._row").alias("a"), F.col("_row").alias("b")).distinct()
    )
    asked = members.select("_row").distinct()
    wanted = nodes.join(asked, "_row", "left_semi").select("_row", F.col("_node").alias("_hash"), "_least")
    texts = materialize(
        rows.join(wanted, (rows["_node"] == wanted["_hash"]) & rows["_id"].eqNullSafe(wanted["_least"]))
        .select("_row", "_text").dropDuplicates(["_row"])
    )
    points = materialize(asked.withColumnRenamed("_row", "node"))
    edges = materialize(similar(stars.groupBy("b").agg(F.min("a").alias("a")), texts))
    roots = components(points, edges)
    rooted = members.join(roots, members["_row"] == roots["node"]).select("_bucket", "_row", "root")
    loose = (
        rooted.groupBy("_bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
        .filter("lo < hi").select("_bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("_parts"))
    )
    chunked = rooted.join(loose, "_bucket").withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int"))
    paired = (
        chunked.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumns({"_lo": F.least("_chunk", "_other"), "_hi": F.greatest("_chunk", "_other")})
        .join(texts, "_row")
    )
    links = materialize(block_links(paired).distinct())
    ends = materialize(links.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    merged = components(ends, links).select(F.col("node").alias("root"), F.col("root").alias("_merged"))
    roots = roots.join(merged, "root", "left").select("node", F.coalesce("_merged", "root").alias("root"))

    placed = nodes.join(roots, nodes["_row"] == roots["node"], "left").select(
        "_node", "_least", F.coalesce("root", "_row").alias("_root")
    )
    joined = known.select("_id", "_node").join(placed, "_node", "left")
    sizes = joined.filter("_root is not null").groupBy("_root").agg(F.min("_id").alias("_class"), F.count("*").alias("_size"))
    alone = F.col("_root").isNull()
    return (
        joined.join(sizes, "_root", "left")
        .select(
            F.col("_id").alias("doc_id"),
            F.when(alone, F.col("_id")).otherwise(F.col("_class")).alias("class_id"),
            F.when(alone, F.lit(1)).otherwise(F.col("_size")).cast("long").alias("class_size"),
            (alone | F.col("_id").eqNullSafe(F.col("_class"))).alias("kept"),
            "_node",
        )
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one per class, the one with the smallest id."""
    kept = near_classes(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_keep"), "_node")
    kept = materialize(kept)
    rows = wrapped(docs, doc_id, text).withColumn("_own", F.unhex(F.md5(whole_text("_row." + text))))
    staying = rows.join(
        kept.dropDuplicates(), rows["_id"].eqNullSafe(kept["_keep"]) & (rows["_own"] == kept["_node"]), "left_semi"
    )
    if not kept.groupBy("_keep", "_node").count().filter("count > 1").isEmpty():
        staying = staying.dropDuplicates(["_id", "_own"])  # rows that repeat id and text
    return staying.select("_row.*")
