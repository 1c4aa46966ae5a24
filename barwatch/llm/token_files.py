"""Token-id files of range-coded blocks, and reading them back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwatch.llm.coder import BLOCK, LANES, decode_blocks, encode_blocks
from barwatch.llm.common import in_python, whole_text
from barwatch.llm.encoding import encoder
from barwatch.llm.textarrays import chunks


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of every row's whole text, each followed by ``end_id``, in ascending id order.

    ``folder`` becomes a table with one file per range of ids and one row per block: part, block
    (number in the part), n_ids, crc32 (of the block's ids), payload, and for the documents that end in
    the block doc_ids and doc_ends (ids of the part up to and with each document's end). A block holds
    ``BLOCK`` ids, the last one of a part what is left; it can be decoded without any other block.

    Null ids come first; rows that share an id are ordered by text. Null and empty texts have the end id
    only. Other columns are ignored. An empty table gives a table without blocks.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(path), TaskContext.get().partitionId()
        held = np.zeros(0, np.uint16)
        waiting: list[np.ndarray] = []
        keys: list = []
        ends: list[int] = []
        total = block = given = 0

        def coded(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, block, given
            flat = np.concatenate([held, *waiting])
            waiting.clear()
            whole = len(flat) if last else len(flat) - len(flat) % BLOCK
            blocks = [flat[i : min(i + BLOCK, whole)] for i in range(0, whole, BLOCK)]
            held = flat[whole:]
            at = np.searchsorted(ends, [(block + i) * BLOCK + len(b) for i, b in enumerate(blocks)], "right")
            cuts = [0, *at.tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part] * len(blocks), pa.int32()),
                    "block": pa.array(range(block, block + len(blocks)), pa.int64()),
                    "n_ids": pa.array([len(b) for b in blocks], pa.int32()),
                    "crc32": pa.array([checksum(b) for b in blocks], pa.int64()),
                    "payload": pa.array(encode_blocks(blocks), pa.binary()),
                    "doc_ids": pa.array([keys[i:j] for i, j in zip(cuts, cuts[1:])], pa.list_(key_type)),
                    "doc_ends": pa.array([ends[i:j] for i, j in zip(cuts, cuts[1:])], pa.list_(pa.int64())),
                }
            )
            del keys[: cuts[-1]], ends[: cuts[-1]]
            block += len(blocks)
            given = total

        for batch in batches:
            key_type = batch.schema.field("doc_id").type
            texts, some = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for i, j in chunks(texts):
                for key, ids in zip(some[i:j], tool.encode(texts[i:j])):
                    waiting += [ids, np.array([end_id], np.uint16)]
                    total += len(ids) + 1
                    keys.append(key)
                    ends.append(total)
                if total - given >= LANES * BLOCK:
                    yield from coded(False)
        if keys:
            yield from coded(True)

    shape = (
        "part int, block long, n_ids int, crc32 long, payload binary, "
        f"doc_ids array<{kind}>, doc_ends array<bigint>"
    )
    in_python(ordered, encode, shape).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids, n_tokens, ids_crc32): every document's ids (16-bit little-endian, with the end id).

    ``start`` counts the ids of all documents before it. A block whose ids do not match its checksum
    raises. Blocks of a part are decoded many at a time, in order; parts are independent and dealt in turn.
    """
    blocks = spark.read.parquet(folder)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    offsets = sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, at = np.zeros(0, np.uint16), None, 0
        waiting: list[tuple] = []

        def documents() -> pa.RecordBatch:
            nonlocal held, part, at
            found = decode_blocks([w[4] for w in waiting], [w[2] for w in waiting])
            out: list[tuple] = []
            for (own, _, n, crc, _, keys, ends), ids in zip(waiting, found):
                if checksum(ids) != crc:
                    raise ValueError(f"damaged block in part {own}")
                if own != part:
                    held, part, at = np.zeros(0, np.uint16), own, 0
                flat = np.concatenate([held, ids])
                begin = 0
                for key, end in zip(keys, ends):
                    whole = flat[begin : end - at]
                    out.append((key, own, at + begin, whole.astype("<u2").tobytes(), len(whole), checksum(whole)))
                    begin = end - at
                held, at = flat[begin:], at + begin
            waiting.clear()
            keys, *rest = zip(*out) if out else ((), (), (), (), (), ())
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), *map(pa.array, rest, kinds)],
                ["doc_id", "part", "start", "ids", "n_tokens", "ids_crc32"],
            )

        for batch in batches:
            key_type = batch.schema.field("doc_ids").type.value_type
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                waiting.append(row)
                if len(waiting) >= LANES:
                    yield documents()
        if waiting:
            yield documents()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocks.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "block")
    rows = in_python(ordered, decode, f"doc_id {kind}, part int, start long, ids binary, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_before") + F.col("start")).alias("start"), "ids", "n_tokens", "ids_crc32"
    )
