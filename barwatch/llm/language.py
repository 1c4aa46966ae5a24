"""Language of texts: n-gram presence kernels, Nystroem landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.llm.common import in_python, same_row, whole_text, wrapped
from barwatch.llm.textarrays import chunks, code_points
from barwatch.session import materialize

PER_LANGUAGE = 400
"""Labelled rows a language is learned from, at most: the ones with the smallest hashed ids."""

LANDMARKS = 64
"""Landmark rows per language, taken from those."""

RIDGE = 1e-3
BITS = (12, 14, 18)
"""Slots, as powers of two, for n-grams of length 1, 2 and 3. Two n-grams rarely share one."""

SLOTS = sum(1 << b for b in BITS)

TOGETHER = 64
"""Texts scored in one matrix product."""

UNKNOWN = "und"
FOREIGN = 0.85
"""A text is claimed while the share of its n-grams that some landmark has stays above this part of ..."""

USUAL = 0.01
"""... what this quantile of the learning rows reaches, each held against the landmarks other than itself."""


@cache
def letters() -> np.ndarray:
    """Every code point's symbol: itself if it is a letter or belongs to one as a mark, else 0."""
    kinds = [unicodedata.category(chr(p)) for p in range(0x110000)]
    return np.where([k[0] == "L" or k in ("Mn", "Mc") for k in kinds], np.arange(0x110000), 0).astype(np.uint32)


def presence(symbols: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Set ``flags`` at the hashed n-grams that occur (all but letters count as one symbol); the places.

    Each n-gram is the sum of its symbols times odd constants, of which the high bits are the slot.
    """
    one, two, three = (symbols * np.uint32(odd) for odd in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
    found, begin = [], 0
    for n, bits in enumerate(BITS):
        m = max(len(symbols) - n, 0)
        sums = one[:m]
        for k, more in enumerate((two, three)[:n]):
            sums = sums + more[k + 1 : k + 1 + m]
        found.append((sums >> np.uint32(32 - bits)).astype(np.int32) + begin)
        begin += 1 << bits
    places = np.concatenate(found)
    flags[places] = True
    return places


class Classifier:
    """Scores texts against landmarks; ``fit`` learns it on the driver from bounded samples."""

    def __init__(self, names: list[str], grams: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray, weights: np.ndarray, floor: float):
        self.names, self.grams, self.floor = names, grams, floor
        self.landmarks, self.sizes, self.weights = landmarks, sizes, weights

    @classmethod
    def fit(cls, rows: list[tuple[str, bytes, bool]]) -> Classifier:
        """``rows``: language, sorted places of its n-grams (32-bit numbers), whether it is a landmark."""
        names = sorted({r[0] for r in rows})
        places = [np.frombuffer(r[1], np.int32) for r in rows]
        marks = [k for k, r in enumerate(rows) if r[2]]
        grams = np.unique(np.concatenate([places[k] for k in marks]))

        def table(some: list[int]) -> np.ndarray:
            out = np.zeros((len(some), len(grams)), np.float32)
            for row, k in zip(out, some):
                at = np.searchsorted(grams, places[k])
                hit = (at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == places[k])
                row[at[hit]] = 1
            return out

        all_sizes = np.array([len(p) for p in places], float)
        landmarks, sizes = table(marks).T.copy(), all_sizes[marks]
        among_others = landmarks.sum(axis=1) > 1
        kernel, known = [], []
        for k in range(0, len(rows), 256):
            some = range(k, min(k + 256, len(rows)))
            hits = table(list(some))
            kernel.append(hits @ landmarks)
            known += [h[among_others].sum() if rows[i][2] else h.sum() for i, h in zip(some, hits)]
        floor = FOREIGN * float(np.quantile(np.array(known) / all_sizes, USUAL))
        kernel = np.concatenate(kernel)
        kernel = kernel.astype(float) / np.sqrt(all_sizes[:, None] * sizes[None, :])
        among = kernel[marks]
        target = np.array([[1.0 if r[0] == n else -1.0 for n in names] for r in rows])
        system = kernel.T @ kernel + RIDGE * len(rows) * among + 1e-8 * np.eye(len(marks))
        return cls(names, grams, landmarks, sizes, np.linalg.solve(system, kernel.T @ target), floor)

    def claims(self, flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether a text has few enough n-grams no landmark has; the root leaves short texts some more."""
        return sizes - flags.sum(axis=1) <= (1 - self.floor) * sizes + np.sqrt(sizes)

    def scores(self, flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One regression value per text and language; a claimed text is near 1, another near -1."""
        kernel = flags.astype(np.float32) @ self.landmarks
        return (kernel / np.sqrt(sizes[:, None] * self.sizes[None, :])) @ self.weights


def learning_rows(docs: DataFrame) -> DataFrame:
    """(_id, _name, _mark): the bounded sample per language, from rows that are not held out.

    Hashed ids are counted by language and power of two, of which the smallest ones that hold
    ``PER_LANGUAGE`` rows are enough: about twice as many rows are ranked, however many there are.
    """
    usable = docs.filter(~F.col("_held_out") & F.col("_id").isNotNull() & F.col("_lang").isNotNull())
    hashed = usable.select("_id", "_lang", F.xxhash64("_id").alias("_hash"))
    level = F.floor(F.log2(F.col("_hash").cast("double") + 2.0**63 + 1)).alias("_level")
    levels = hashed.select("_lang", "_hash", "_id", level)
    before = Window.partitionBy("_lang").orderBy("_level").rowsBetween(Window.unboundedPreceding, -1)
    counted = levels.groupBy("_lang", "_level").count()
    wanted = counted.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    wanted = wanted.filter(F.col("_before") < PER_LANGUAGE).select("_lang", "_level")
    few = levels.join(F.broadcast(wanted), ["_lang", "_level"])  # 64 rows a language at most
    order = Window.partitionBy("_lang").orderBy("_hash", "_id")
    ranked = few.select("_id", "_lang", F.row_number().over(order).alias("_rank")).filter(f"_rank <= {PER_LANGUAGE}")
    return ranked.select("_id", F.col("_lang").alias("_name"), (F.col("_rank") <= LANDMARKS).alias("_mark"))


def learn(docs: DataFrame) -> Classifier | None:
    """The classifier; None where nothing can be learned."""
    chosen = materialize(learning_rows(docs))
    sample = docs.filter(~F.col("_held_out")).select("_id", "_lang", "_text")
    sample = materialize(
        sample.join(chosen, (sample["_id"] == chosen["_id"]) & (sample["_lang"] == chosen["_name"]))
        .select("_name", "_mark", "_text").filter(F.col("_text").rlike(r"\p{L}"))
    )

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, flags = letters(), np.zeros(SLOTS, bool)
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                flags[:] = False
                presence(table[code_points([text.lower()])[0]], flags)
                out.append(np.flatnonzero(flags).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), batch.column(1)], ["name", "grams", "mark"]
            )

    rows = in_python(sample, grams_of, "name string, grams binary, mark boolean").orderBy("name", "grams").collect()
    some = [(r.name, bytes(r.grams), r.mark) for r in rows]
    return Classifier.fit(some) if any(r[2] for r in some) else None


def _keyed(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    crc = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8"))
    return docs.select(
        F.col(doc_id).alias("_id"),
        F.col(lang).cast("string").alias("_lang"),
        whole_text(text).alias("_text"),
        F.coalesce(crc % 4 == 2, F.lit(False)).alias("_held_out"),
    )


def _predicted(rows: DataFrame, classifier: Classifier | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` with _pred and _score, from ``_text``."""
    shared = rows.sparkSession.sparkContext.broadcast(classifier)  # bounded by the samples

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table, flags = letters(), np.zeros(SLOTS, bool)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            names, values, claimed = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for i, j in chunks(texts):
                symbols, _ = code_points(lowered := [t.lower() for t in texts[i:j]])
                symbols = table[symbols]
                bounds = np.cumsum([0, *map(len, lowered)]).tolist()
                for at in range(0, j - i if model else 0, TOGETHER):
                    some = range(at, min(at + TOGETHER, j - i))
                    hits, sizes, rows_of = np.zeros((len(some), len(model.grams)), bool), np.ones(len(some)), []
                    for row, k in enumerate(some):
                        own = symbols[bounds[k] : bounds[k + 1]]
                        if own.any():
                            places = presence(own, flags)
                            hits[row] = flags[model.grams]
                            sizes[row] = np.count_nonzero(flags)
                            flags[places] = False
                            rows_of.append(row)
                    if rows_of:
                        found = model.scores(hits[rows_of], sizes[rows_of])
                        best = found.argmax(axis=1)
                        where = i + at + np.array(rows_of)
                        names[where] = np.array(model.names, object)[best]
                        values[where] = np.clip((found.max(axis=1) + 1) / 2, 0, 1)
                        claimed[where] = model.claims(hits[rows_of], sizes[rows_of])
            columns = [batch.column(k) for k in range(len(keep))] + [pa.array(names, pa.string()), pa.array(values), pa.array(claimed)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_pred", "_score", "_claimed"])

    shape = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return in_python(rows.select(*keep, "_text"), predict, f"{shape}, _pred string, _score double, _claimed boolean")


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, claimed.

    Learns from text and non-null language of rows whose crc32 of the id modulo 4 is not 2; predicts
    from the whole text alone. A text without a letter, or null, is ``und`` with score 0, as is every
    text where no labelled row can be learned from. The score is the winning regression value, moved
    from [-1, 1] to [0, 1]; of equal values the first language by name wins. ``claimed`` is false for ``und``
    and for texts with too many n-grams that no landmark has: scripts or languages without learning rows, and
    random letters. Rows that repeat are predicted alike;
    a null id is not held out and not learned from; other columns are ignored.

    Texts are lower-cased and read as 1- to 3-grams of their letters, of any script, hashed into slots; the kernel of two texts is
    the number of n-grams they share over the geometric mean of how many each has. The samples that
    bound driver and broadcast are ``PER_LANGUAGE`` rows and ``LANDMARKS`` landmarks a language.
    """
    rows = _keyed(docs, doc_id, text, lang)
    classifier = learn(rows)
    out = _predicted(rows, classifier, ["_id", "_held_out"])
    return out.select(
        F.col("_id").alias("doc_id"),
        F.col("_held_out").alias("held_out"),
        F.col("_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_claimed").alias("claimed"),
    )


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that some language claims (see ``languages``)."""
    classifier = learn(_keyed(docs, doc_id, text, lang))
    rows = wrapped(docs, doc_id, text).withColumn("_text", whole_text("_row." + text))
    found = materialize(_predicted(rows, classifier, ["_id", "_tk"]))
    fine = found.filter("_claimed").dropDuplicates(["_id", "_tk"])
    return rows.join(fine, same_row(rows, fine), "left_semi").select("_row.*")
