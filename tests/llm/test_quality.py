"""Text statistics, systems and calibration against plain Python; held-out accuracy."""

import math
import random
import re
import unicodedata
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from frames import empty, messy, messy_rows, prose, words_of

from barwatch.llm import quality_score
from barwatch.llm.quality_score import STATISTICS, Fourier, isotonic, normal_equations, quality, ridge, statistics

LABELS = "doc_id long, quality int, toxic int, text string"


def plain(text: str) -> dict[str, float]:
    kinds = [unicodedata.category(c) for c in text]
    white = set(" \t\n\x0b\x0c\r")
    letter = [k[0] == "L" for k in kinds]
    sign = [k[0] not in "LN" and c not in white for c, k in zip(text, kinds)]
    n, words, lines = len(text), words_of(text), text.split("\n")

    def share(flags, whole):
        return sum(flags) / max(1, whole)

    def upper(w):
        ups = [unicodedata.category(c) == "Lu" for c in w]
        return all(ups) and len(w) > 1 if all(unicodedata.category(c)[0] == "L" for c in w) else sum(ups) > 1 and sum(ups) == sum(
            unicodedata.category(c)[0] == "L" for c in w)

    def is_sign(c):
        return unicodedata.category(c)[0] not in "LN" and c not in white

    sizes = [len(w) for w in words] or [0]
    mean = sum(sizes) / max(1, len(words))
    spread = math.sqrt(max(0, sum(s * s for s in sizes) / max(1, len(words)) - mean**2))
    counts = Counter(text)
    w = max(1, len(words))
    return {
        "log_chars": math.log1p(n), "log_words": math.log1p(len(words)), "letters": share(letter, n),
        "uppers": share([k == "Lu" for k in kinds], sum(letter)), "digits": share([k[0] == "N" for k in kinds], n),
        "spaces": share([c in white for c in text], n), "signs": share(sign, n), "non_ascii": share([ord(c) > 127 for c in text], n),
        "lines_per_word": (len(lines) - 1) / w, "word_length": math.log1p(mean), "word_spread": math.log1p(spread),
        "long_words": share([s > 20 for s in sizes], w), "distinct_words": len(set(words)) / w,
        "common_word": max(Counter(words).values(), default=0) / w, "repeated_next": sum(a == b for a, b in pairwise(words)) / w,
        "signed_words": share([sum(map(is_sign, x)) > 1 and any(unicodedata.category(c)[0] == "L" for c in x) for x in words], w),
        "sign_only_words": share([any(map(is_sign, x)) and not any(unicodedata.category(c)[0] == "L" for c in x) for x in words], w),
        "upper_words": share(map(upper, words), w), "distinct_signs": math.log1p(len({c for c, s in zip(text, sign) if s})),
        "doubled_signs": share([a == b and s for (a, b), s in zip(pairwise(text), sign[1:])], n),
        "closed_lines": sum(x.endswith((".", "!", "?")) for x in lines) / len(lines), "distinct_lines": len(set(lines)) / len(lines),
        "entropy": -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0,
    }


def test_statistics_of_messy_texts():
    rng = random.Random(3)
    texts = [r[1] or "" for r in messy_rows()]
    texts += ["", "\n", "a\n", "\n\na.\na.\n", ".", "A!! B!! c?", "AB AB ab ...", "x&&& y***\nZZ 12 ½ Ⅷ", " lead", "trail ", "é" * 50, ""]
    texts += ["".join(rng.choices("aB1 .\n!\té", k=rng.randint(0, 60))) for _ in range(200)]
    got = statistics(texts)
    for text, row in zip(texts, got):
        want = plain(text)
        assert list(want) == list(STATISTICS)
        for name, value in zip(STATISTICS, row):
            assert value == pytest.approx(want[name], abs=1e-9), (name, text[:80])


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(4)
    for _ in range(20):
        n, place = rng.integers(1, 6, 15).astype(float), np.sort(rng.choice(100, 15, False)).astype(float)
        ones = rng.binomial(n.astype(int), np.linspace(0.2, 0.8, 15)).astype(float)
        at, value = isotonic(place, n, ones)
        assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
        # The fit at i is the greatest over starts of the least mean over ends.
        mean = [[ones[a : b + 1].sum() / n[a : b + 1].sum() if a <= b else np.nan for b in range(15)] for a in range(15)]
        want = [max(min(mean[a][b] for b in range(i, 15)) for a in range(i + 1)) for i in range(15)]
        assert sorted(set(np.round(want, 9))) == pytest.approx(value)


def test_systems_equal_the_direct_solution(spark):
    rng = np.random.default_rng(5)
    x, fold, y = rng.normal(size=(300, 23)), rng.integers(1, 5, 300), rng.integers(0, 2, 300)
    rows = [(int(f), int(v), [float(c) for c in r]) for f, v, r in zip(fold, y, x)]
    frame = spark.createDataFrame(rows, "_fold int, _label int, _x array<double>").repartition(5)
    fourier = Fourier(x.mean(axis=0), x.std(axis=0))
    systems = normal_equations(frame, fourier)
    assert sorted(systems) == [1, 2, 3, 4]
    z = fourier(x)
    for k, s in systems.items():
        own = z[fold == k]
        assert np.allclose(s, own.T @ np.column_stack([own, y[fold == k]]), atol=1e-9)
    shrink = np.full(z.shape[1], 0.01 * len(z))
    shrink[-1] = 1e-9
    want = np.linalg.solve(z.T @ z + np.diag(shrink), z.T @ y)
    assert np.allclose(z @ ridge(sum(systems.values()), 0.01), z @ want, atol=1e-6)


def test_features_approximate_the_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(quality_score, "FOURIER", 20_000)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12, 23)) * 2
    z = Fourier(np.zeros(23), np.ones(23))(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * quality_score.WIDTH**2))
    assert np.abs(z @ z.T - want).max() < 0.05


def corpus(spark, n=400):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = prose(rng, rng.randint(5, 80)).split()
        text = " ".join(words) if good else " ".join(w.upper() + "!!" if i % 2 else w + rng.choice(["&&&", "***"]) for w in words)
        docs.append((i, text, "en", f"s{i % 3}", good))
        labels.append((i, int(good), 0, "no text"))
    frame = spark.createDataFrame([d[:4] for d in docs], "doc_id long, text string, lang string, source string")
    return frame, labels, {d[0]: d[4] for d in docs}


def test_held_out_texts_are_told_apart_and_teach_nothing(spark):
    docs, labels, good = corpus(spark)
    found = quality(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(good)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in found if r.held_out]
    assert len(held) > 50 and sum(r.predicted == good[r.doc_id] for r in held) >= 0.97 * len(held)
    lied = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1, "") for i, q, *_ in labels]
    again = quality(docs, spark.createDataFrame(lied, LABELS))
    assert {r.doc_id: round(r.score, 6) for r in again.collect()} == {r.doc_id: round(r.score, 6) for r in found}


def test_messy_tables_and_labels(spark):
    labels = [(i, i % 2, 0, "t") for i in range(20)] + [(3, 0, 0, "t"), (None, 1, 0, "t"), (5, None, 0, "t"), (6, 7, 0, "t"), (999, 1, 1, "t")]
    labels = spark.createDataFrame(labels, LABELS)
    found = quality(messy(spark), labels).collect()
    assert len(found) == len(messy_rows()) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False, False]
    assert len({r.score for r in found if r.doc_id in (7, 8)}) == 1  # null and empty texts
    assert quality(empty(spark), labels).count() == 0
    none = quality(messy(spark), labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert {r.score for r in quality(messy(spark), labels.filter("quality = 1")).collect()} == {1.0}
