import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from frames import empty, messy, messy_rows, rows_of
from pyspark.sql import functions as F

from barwatch.llm.exact_dedup import drop_exact, exact_classes
from barwatch.llm.line_dedup import remove_boilerplate
from barwatch.llm.sharding import ROUNDS, permuted, shards, sides


def expected_classes() -> Counter:
    groups = defaultdict(list)
    for r in messy_rows():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = Counter()
    for content, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        for r in rows:
            out[r[0], best, len(rows), r[0] == best, hashlib.sha256(content.encode()).hexdigest()] += 1
    return out


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_classes_of_messy_rows(spark):
    assert rows_of(exact_classes(messy(spark)), *COLUMNS) == expected_classes()


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    found = exact_classes(messy(spark), hashed=lambda c: (F.length(c) % 3).cast("string"))
    assert rows_of(found, *COLUMNS) == expected_classes()


def test_drop_exact_keeps_one_row_and_all_columns(spark):
    docs = messy(spark)
    out = drop_exact(docs)
    assert out.columns == docs.columns
    contents = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.collect()]
    assert len(contents) == len(set(contents)) == len({k[4] for k in expected_classes()})


def test_empty_tables(spark):
    for made in (exact_classes(empty(spark)), drop_exact(empty(spark)), shards(empty(spark), 4), remove_boilerplate(empty(spark))):
        assert made.count() == 0


def test_lines_go_from_three_sites_on(spark):
    rows = [(i, f"own {i}\n  shared\t\n\nshared two", f"s{i % 4}") for i in range(8)]
    rows += [(8, "rare\nrare", "s1"), (9, "rare", "s2"), (10, None, None), (11, "", "s1"), (8, "rare\nrare", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = remove_boilerplate(docs, min_sites=3)
    want = Counter({(i, 4, 2, f"own {i}\n"): 1 for i in range(8)})
    want |= {(8, 2, 0, "rare\nrare"): 2, (9, 1, 0, "rare"): 1, (10, 1, 0, ""): 1, (11, 1, 0, ""): 1}
    assert rows_of(found, "doc_id", "n_lines", "n_removed", "kept_text") == want


def test_many_sites_agree_with_exact_counts_at_the_threshold(spark):
    rows = [(n * 100 + i, f"line {n}", f"site{i}") for n in (38, 39, 40, 41, 60) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = remove_boilerplate(docs, min_sites=40).filter("n_removed > 0").select(F.expr("doc_id div 100").alias("n"))
    assert {r.n for r in gone.distinct().collect()} == {40, 41, 60}


def test_shards_are_even_and_gapless_and_repeatable(spark):
    docs = messy(spark)
    first, second = (sorted(map(tuple, shards(docs.repartition(n), 5).collect()), key=str) for n in (2, 7))
    assert first == second
    slots = defaultdict(list)
    for _, _, _, law, shard, slot, grown in first:
        assert law == "rows" and grown is None
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in messy_rows())
    assert Counter(r[:3] for r in first) == want


def test_permutation_of_any_size(spark):
    for total in (1, 2, 3, 7, 50, 1000):
        rows = spark.range(total).withColumnRenamed("id", "_row")
        assert sorted(r[0] for r in permuted(rows, "_row", total, 3).collect()) == list(range(total))


def plain_place(number: int, total: int, seed: int) -> int:
    """The same network in plain Python, one number at a time, walking until it is below ``total``."""
    a, b = sides(total)

    def keyed(value: int, turn: int) -> int:
        mixed = 42
        for part in (struct.pack("<q", value), struct.pack("<i", seed), struct.pack("<i", turn)):
            mixed = xxhash.xxh64_intdigest(part, seed=mixed)
        return mixed - (1 << 64) if mixed >> 63 else mixed

    while True:
        left, right = divmod(number, b)
        for turn in range(ROUNDS):
            if turn % 2:
                right = (right + keyed(left, turn)) % b
            else:
                left = (left + keyed(right, turn)) % a
        number = left * b + right
        if number < total:
            return number


def test_shards_and_slots_equal_a_plain_network(spark):
    rows = [(i, "t" * (i % 7)) for i in range(1003)]
    found = shards(spark.createDataFrame(rows, "doc_id long, text string"), 40, seed=9).collect()
    want = {i: plain_place(i, len(rows), 9) for i, _ in rows}
    assert {r.doc_id: r.slot * 40 + r.shard for r in found} == want
