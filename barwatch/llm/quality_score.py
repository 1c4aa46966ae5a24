"""Quality of texts: random Fourier features over text statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import in_python, whole_text
from barwatch.llm.textarrays import PrimeSliceHash, chunks, code_points
from barwatch.llm.wordarrays import Words
from barwatch.session import materialize

FOURIER = 192
"""Random frequencies; each gives a cosine and a sine."""

WIDTH = 6.0
"""Width of the Gaussian kernel, over standardised statistics."""

RIDGES = (1e-4, 1e-3, 1e-2, 1e-1)
"""Penalties per learning row; the one with the least error out of fold is used."""

FOLDS = 4
STEPS = 2048
"""Regression values are counted in so many steps from -0.5 to 1.5 for the calibration."""

PREDICT = 0.3
TOGETHER = 2048
"""Rows turned into features at once."""

LETTER, UPPER, DIGIT, SPACE, OTHER = range(5)

# Fixed order of the statistics.
STATISTICS = (
    "log_chars", "log_words", "letters", "uppers", "digits", "spaces", "signs", "non_ascii", "lines_per_word",
    "word_length", "word_spread", "long_words", "distinct_words", "common_word", "repeated_next", "signed_words",
    "sign_only_words", "upper_words", "distinct_signs", "doubled_signs", "closed_lines", "distinct_lines", "entropy",
)

LINE_HASH = PrimeSliceHash()


@cache
def classes() -> np.ndarray:
    """Class of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for p in range(0x110000):
        kind = unicodedata.category(chr(p))
        if kind[0] == "L":
            table[p] = UPPER if kind == "Lu" else LETTER
        elif kind[0] == "N":
            table[p] = DIGIT
    table[[9, 10, 11, 12, 13, 32]] = SPACE
    return table


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each slice between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: its different keys, the count of its most frequent one, and its entropy in bits.

    Keys count by their low 43 bits, so that owner and key are sorted as one number.
    """
    both = np.sort((owner << 43) | (keys.astype(np.int64) & ((1 << 43) - 1)))
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(both)))
    of = both[start] >> 43
    most, entropy, size = np.zeros(n), np.zeros(n), np.bincount(owner, minlength=n)
    np.maximum.at(most, of, count)
    share = count / size[of]
    np.add.at(entropy, of, -share * np.log2(share))
    return np.bincount(of, minlength=n).astype(float), most, entropy


def statistics(texts: list[str]) -> np.ndarray:
    """One row of `STATISTICS` per text, from its whole text; shares of nothing are 0."""
    points, offsets = code_points(texts)
    n, kind = len(texts), classes()[points]
    size = np.diff(offsets).astype(float)
    chars = np.maximum(size, 1)
    count = [sums(kind == k, offsets) for k in range(5)]
    owner = np.repeat(np.arange(n), np.diff(offsets))

    space = kind == SPACE
    starts = ~space
    starts[1:] &= space[:-1] | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(starts)
    stops = ~space
    stops[:-1] &= space[1:] | (owner[1:] != owner[:-1])
    end = np.flatnonzero(stops) + 1
    first = np.searchsorted(begin, offsets)
    word_of = owner[begin] if len(begin) else np.zeros(0, np.int64)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    length = (end - begin).astype(float)
    per_word = lambda flag: sums(flag, first) / some
    inside = np.stack([begin, end], axis=1).ravel()
    of_kind = lambda k: sums(kind == k, inside)[::2] if len(begin) else np.zeros(0)
    letters, signs, uppers = of_kind(LETTER) + of_kind(UPPER), of_kind(OTHER), of_kind(UPPER)

    tool = Words(texts)
    hashes = tool.hashes[0]
    hashed_of = np.repeat(np.arange(n), np.diff(tool.first))
    kinds, common, _ = distinct(hashed_of, hashes, n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (hashed_of[1:] == hashed_of[:-1])

    sign = kind == OTHER
    sign_kinds, _, _ = distinct(owner[sign], points[sign], n)
    doubled = np.zeros(len(points), bool)
    doubled[1:] = sign[1:] & (points[1:] == points[:-1]) & (owner[1:] == owner[:-1])
    _, _, entropy = distinct(owner, points, n)

    feed = np.flatnonzero(points == 10)
    line_of = np.append(owner[feed], np.arange(n))
    opens, closes = np.append(feed + 1, offsets[:-1]), np.append(feed, offsets[1:])
    opens, closes = opens[np.lexsort((opens, line_of))], closes[np.lexsort((closes, line_of))]
    line_of = np.sort(line_of)
    lines = np.bincount(line_of, minlength=n).astype(float)
    closed = np.zeros(len(line_of), bool)
    solid = closes > opens
    closed[solid] = np.isin(points[closes[solid] - 1], [33, 46, 63])
    line_kinds, _, _ = distinct(line_of, LINE_HASH(points, opens, closes), n)

    mean = sums(end - begin, first) / some
    spread = np.sqrt(np.maximum(sums((end - begin) ** 2, first) / some - mean**2, 0))
    all_letters = np.maximum(count[LETTER] + count[UPPER], 1)
    found = {
        "log_chars": np.log1p(size), "log_words": np.log1p(words), "letters": (count[LETTER] + count[UPPER]) / chars,
        "uppers": count[UPPER] / all_letters, "digits": count[DIGIT] / chars, "spaces": count[SPACE] / chars,
        "signs": count[OTHER] / chars, "non_ascii": sums(points > 127, offsets) / chars, "lines_per_word": (lines - 1) / some,
        "word_length": np.log1p(mean), "word_spread": np.log1p(spread), "long_words": per_word(length > 20),
        "distinct_words": kinds / some, "common_word": common / some, "repeated_next": sums(again, tool.first) / some,
        "signed_words": per_word((signs > 1) & (letters > 0)), "sign_only_words": per_word((letters == 0) & (signs > 0)),
        "upper_words": per_word((uppers > 1) & (uppers == letters)), "distinct_signs": np.log1p(sign_kinds),
        "doubled_signs": sums(doubled, offsets) / chars, "closed_lines": np.bincount(line_of, closed, n) / lines,
        "distinct_lines": line_kinds / lines, "entropy": entropy,
    }
    return np.stack([found[name] for name in STATISTICS], axis=1)


def measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_id, _fold, _x) per row: crc32 of the id modulo 5 (null for a null id), statistics."""
    fold = (F.crc32(F.encode(F.col("_id").cast("string"), "UTF-8")) % 5).cast("int")
    rows = docs.select(F.col(doc_id).alias("_id"), whole_text(text).alias("_text")).select("_id", fold.alias("_fold"), "_text")
    kind = rows.schema["_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in chunks(texts):
                x = statistics(texts[i:j]).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                columns = [batch.column(k).slice(i, j - i) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*columns, flat], ["_id", "_fold", "_x"])

    return in_python(rows, read, f"_id {kind}, _fold int, _x array<float>")


def rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


class Fourier:
    """Features whose inner products approximate a Gaussian kernel over standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 5) -> None:
        self.mean, self.deviation = mean, deviation
        self.frequencies = np.random.default_rng(seed).normal(size=(len(mean), FOURIER)) / WIDTH
        self.size = 2 * FOURIER + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        angle = np.clip((x - self.mean) / self.deviation, -8, 8) @ self.frequencies
        return np.hstack([np.cos(angle), np.sin(angle), np.full((len(x), 1), np.sqrt(FOURIER))]) / np.sqrt(FOURIER)


def normal_equations(rows: DataFrame, fourier: Fourier) -> dict[int, np.ndarray]:
    """Per fold the sums of features times (features, label): added up per task, then per feature."""
    size = fourier.size

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, y = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
            z = fourier(rows_of(batch.column(2)))
            for k in np.unique(folds).tolist():
                own = z[folds == k]
                total[k] = total.get(k, 0) + own.T @ np.column_stack([own, y[folds == k]])
        for k, t in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, k, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(t.tolist(), pa.list_(pa.float64()))],
                ["fold", "i", "row"],
            )

    parts = in_python(rows.select("_fold", "_label", "_x"), products, "fold int, i int, row array<double>")
    summed = parts.select("fold", "i", F.posexplode("row")).groupBy("fold", "i", "pos").agg(F.sum("col").alias("s"))
    flat = summed.groupBy("fold", "i").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "s"))), lambda c: c["s"]).alias("row"))
    out: dict[int, np.ndarray] = {}
    for r in flat.collect():  # folds x features rows
        out.setdefault(r.fold, np.zeros((size, size + 1)))[r.i] = r.row
    return out


def ridge(total: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of one system; the number of rows is the product of the constant with itself."""
    size = len(total)
    shrink = np.full(size, penalty * total[-1, size - 1])
    shrink[-1] = 1e-9
    return np.linalg.solve(total[:, :size] + np.diag(shrink), total[:, size])


def fold_counts(rows: DataFrame, fourier: Fourier, weights: dict[int, np.ndarray]) -> DataFrame:
    """(fold, ridge, step, n, ones, error): counts of the labelled rows' out-of-fold values."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, y = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(float)
            x = rows_of(batch.column(2))
            for k in np.unique(folds).tolist():
                own = folds == k
                value = fourier(x[own]) @ weights[k]
                for r in range(value.shape[1]):
                    at, place = np.unique(step_of(value[:, r]), return_inverse=True)
                    sums_of = [np.bincount(place, v) for v in (np.ones(len(place)), y[own], (value[:, r] - y[own]) ** 2)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), r, np.int32)), pa.array(at.astype(np.int32)), *map(pa.array, sums_of)],
                        ["ridge", "step", "n", "ones", "error"],
                    )

    parts = in_python(rows.select("_fold", "_label", "_x"), count, "ridge int, step int, n double, ones double, error double")
    return parts.groupBy("ridge", "step").agg(*[F.sum(c).alias(c) for c in ("n", "ones", "error")])


def step_of(value: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((value + 0.5) / 2 * STEPS), 0, STEPS - 1).astype(np.int64)


def isotonic(place: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit: pools of adjacent violators, each at its mean place and share."""
    pools: list[list[float]] = []
    for p, size, hit in zip(place.tolist(), n.tolist(), ones.tolist()):
        pools.append([p * size, size, hit])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def labelled(rows: DataFrame, labels: DataFrame, label_id: str, label: str) -> DataFrame:
    """Rows with one known label, ``_label`` 0 or 1, that are not held out."""
    known = labels.select(F.col(label_id).alias("_lid"), F.col(label).cast("int").alias("_label"))
    known = known.filter(F.col("_lid").isNotNull() & F.col("_label").isin(0, 1))
    known = known.groupBy("_lid").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
    known = known.filter(F.col("_label") == F.col("_most")).drop("_most")
    return rows.filter(F.col("_fold") != 0).join(known, F.col("_id") == F.col("_lid")).select("_fold", "_label", "_x")


class Model:
    """Scores rows of statistics; ``weights`` None scores everything with the share of ones."""

    def __init__(self, fourier: Fourier | None, weights: np.ndarray | None, knots: tuple[np.ndarray, np.ndarray]) -> None:
        self.fourier, self.weights, self.knots = fourier, weights, knots

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.knots[1][0])
        value = np.concatenate([self.fourier(x[i : i + TOGETHER]) @ self.weights for i in range(0, len(x), TOGETHER)] or [np.zeros(0)])
        return np.clip(np.interp(value, *self.knots), 0, 1)


def learn(rows: DataFrame, known: DataFrame) -> Model:
    """Fit on the labelled rows: scaling over all rows, systems per fold, penalty and calibration out of fold."""
    n = len(STATISTICS)
    stats = rows.select([F.col("_x")[k].cast("double").alias(f"s{k}") for k in range(n)])
    found = stats.agg(*[f(f"s{k}").alias(f"{name}{k}") for k in range(n) for name, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    totals = known.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    if not totals.n or totals.ones in (0, totals.n):
        share = totals.ones / totals.n if totals.n else 0.5
        return Model(None, None, (np.zeros(1), np.array([share])))
    mean, deviation = (np.array([found[f"{c}{k}"] for k in range(n)]) for c in "md")
    fourier = Fourier(mean, np.where(deviation > 1e-9, deviation, 1.0))
    systems = normal_equations(known, fourier)
    whole = sum(systems.values())
    others = {k: whole - s if len(systems) > 1 else whole for k, s in systems.items()}
    weights = {k: np.stack([ridge(s, r) for r in RIDGES], axis=1) for k, s in others.items()}
    counts = fold_counts(known, fourier, weights).orderBy("ridge", "step").collect()  # ridges x steps rows at most
    errors = [sum(c.error for c in counts if c.ridge == r) for r in range(len(RIDGES))]
    best = int(np.argmin(errors))
    step, size, ones = (np.array([c[f] for c in counts if c.ridge == best], float) for f in ("step", "n", "ones"))
    return Model(fourier, ridge(whole, RIDGES[best]), isotonic((step + 0.5) / STEPS * 2 - 0.5, size, ones))


def quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if the score is at least 0.3).

    Each whole text becomes the numbers of `STATISTICS`; random Fourier features of them, standardised over all rows,
    approximate a Gaussian kernel. Learning rows are those with a label whose crc32 of the id modulo 5 is not 0: their
    normal equations are added up per task and remainder, which gives a ridge regression on all of them and, by
    subtraction, one without each remainder. Those score their own remainder to choose the penalty and to fit the
    isotonic calibration, on counts of `STEPS` steps. Labels, language, source and id are no inputs of a score.

    Null texts count as empty and are scored. Ids with contradicting labels teach nothing, as do null ids and labels other than 0
    and 1; a null id is not held out. Without learning rows of both labels every score is the share of ones
    (0.5 without any). Repeated rows are scored alike, once each; an empty table gives no rows; other columns are ignored.
    """
    rows = materialize(measured(docs, doc_id, text))
    known = materialize(labelled(rows, labels, label_id, label))
    model = learn(rows, known)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by features and steps
    kind = rows.schema["_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = shared.value(rows_of(batch.column(2))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], ["doc_id", "held_out", "score"])

    held = F.coalesce(F.col("_fold") == 0, F.lit(False)).alias("_held")
    scored = in_python(rows.select("_id", held, "_x"), score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= PREDICT).cast("int"))


