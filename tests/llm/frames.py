"""Small, awkward inputs and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_id string, _row long, keep_id long, kept_text string, n int"
)
GAP = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[str]:
    return GAP.findall(text or "")


def prose(rng: random.Random, n: int, syllables: str = "ka lo mi ren tos ul vey dra") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def messy_rows() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(5)
    passage, base = prose(rng, 70), prose(rng, 300).split()
    near = list(base)
    near[40], near[200] = "changed", "altered"
    far = [w if i % 7 else "other" for i, w in enumerate(base)]
    texts = {
        0: " ".join(base), 1: " ".join(near), 2: "  ".join(base), 3: " ".join(far), 4: prose(rng, 40) + "\n" + passage,
        5: passage + " " + prose(rng, 30), 6: passage, 7: None, 8: "", 9: " \n\t ", 10: "a", 11: "!!! 123", 12: "a",
        13: prose(rng, 9000), 14: "x" * 30_000, 15: "loop " * 400, 16: "loop " * 395, 17: "Ünï 'sun's\x85'll \x00 <|endoftext|> 日本 Σ",
        18: prose(rng, 20), 19: prose(rng, 20) + "\nLicensed to all.\n" + prose(rng, 20),
    }
    langs = ["en", "fr"]
    rows = [(i, t, langs[i % 2] if i % 5 else None, f"s{i % 4}", len(t or ""), "x", -1, 7, "k", 3) for i, t in texts.items()]
    rows.append(rows[3])  # a repeated row
    rows.append((3, "another text with the same id", None, None, None, None, None, None, None, None))
    rows.append((None, " ".join(base), "en", None, None, None, None, None, None, None))
    rows.append((None, passage, None, "s1", None, None, None, None, None, None))
    return rows


def messy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(messy_rows(), DOCS).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def rows_of(frame: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def shingles_of(text: str | None) -> Counter:
    w = words_of(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
