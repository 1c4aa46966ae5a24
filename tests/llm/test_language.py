import random
import zlib

import numpy as np
from frames import empty, messy, messy_rows, prose

from barwatch.llm.language import LANDMARKS, PER_LANGUAGE, RIDGE, _keyed, keep_identified, languages, learning_rows

SOUNDS = {"en": "the and ing wh th er on", "fr": "eau oui ez que é è onne", "de": "sch ung ä ü ein cht pf"}


def corpus(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(5, 60), SOUNDS[lang]), lang) for i in range(240) for lang in [sorted(SOUNDS)[i % 3]]]
    return spark.createDataFrame(rows + [(900, None, "en"), (901, "12 !", None), (None, "the thing", "en")], "doc_id long, text string, lang string")


def test_held_out_texts_are_told_apart(spark):
    docs = corpus(spark)
    known = {r.doc_id: r.lang for r in docs.collect()}
    found = languages(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == known[r.doc_id]


def test_held_out_labels_teach_nothing(spark):
    docs = corpus(spark)
    from pyspark.sql import functions as F

    lied = docs.withColumn("lang", F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, "xx").otherwise(F.col("lang")))
    first, second = ({tuple(r) for r in languages(d).collect()} for d in (docs, lied))
    assert first == second


def test_foreign_scripts_languages_and_random_letters_go(spark):
    rng = random.Random(3)
    letters = {"x": "bcdfghjklmnpqrstvwxz", "y": "абвгдежзиклмнопрстуфхцчшы", "z": "αβγδεζηθικλμνξοπρστυφχψω"}
    noise = [
        (1000 + 100 * k + i, " ".join("".join(rng.choices(some, k=rng.randint(2, 9))) for _ in range(rng.randint(20, 90))), None)
        for k, some in enumerate(letters.values()) for i in range(50)
    ] + [(2000 + i, prose(rng, 40, "kyy pää ikk ull akk utt jok vö"), None) for i in range(50)]
    docs = corpus(spark)
    clean = {r.doc_id for r in docs.collect()} - {900, 901}
    left = keep_identified(docs.union(spark.createDataFrame(noise, docs.schema))).collect()
    assert {r.doc_id for r in left} == clean and len(left) == len(clean)


def test_learning_rows_are_those_with_the_smallest_hashes(spark):
    from pyspark.sql import functions as F

    docs = spark.range(9000).select(F.col("id").alias("_id"), F.when(F.col("id") < 8000, "a").when(F.col("id") < 8990, "b").otherwise("c").alias("_lang"), F.lit(False).alias("_held_out"))
    hashes = {r._id: (r._lang, r.h) for r in docs.withColumn("h", F.xxhash64("_id")).collect()}
    want = set()
    for lang in "abc":
        ids = sorted((h, i) for i, (name, h) in hashes.items() if name == lang)[:PER_LANGUAGE]
        want |= {(i, lang, rank < LANDMARKS) for rank, (_, i) in enumerate(ids)}
    found = learning_rows(docs).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def plain_kernel_ridge(rows, texts):
    """Scores by the same formulas on sets of n-grams, without hashing, slots or batches."""
    def grams(text):
        s = "".join(c if c.isalpha() else " " for c in text.lower())
        return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    def kernel(some, others):
        return np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in others] for a in some])

    names = sorted({lang for lang, _, _ in rows})
    learned, marks = [grams(t) for _, t, _ in rows], [grams(t) for _, t, m in rows if m]
    k, among = kernel(learned, marks), kernel(marks, marks)
    target = np.array([[1.0 if lang == n else -1.0 for n in names] for lang, _, _ in rows])
    weights = np.linalg.solve(k.T @ k + RIDGE * len(rows) * among + 1e-8 * np.eye(len(marks)), k.T @ target)
    values = kernel([grams(t) for t in texts], marks) @ weights
    return [(names[i], min(max((v[i] + 1) / 2, 0), 1)) for v in values for i in [int(v.argmax())]]


def test_scores_equal_plain_kernel_ridge(spark):
    docs = corpus(spark).filter("doc_id < 900")
    chosen = {(r._id, r._name): r._mark for r in learning_rows(_keyed(docs, "doc_id", "text", "lang")).collect()}
    rows = sorted((d.doc_id, d.lang, d.text) for d in docs.collect())
    want = plain_kernel_ridge([(lang, t, chosen[i, lang]) for i, lang, t in rows if (i, lang) in chosen], [t for _, _, t in rows])
    got = [(r.lang_pred, r.score) for r in languages(docs).orderBy("doc_id").collect()]
    for (name, score), (told, value) in zip(want, got, strict=True):
        assert name == told and abs(score - value) < 0.02


def test_messy_and_empty_tables(spark):
    assert languages(messy(spark)).count() == len(messy_rows())
    out = keep_identified(messy(spark))
    assert out.columns == messy(spark).columns
    assert not {r.doc_id for r in out.collect()} & {7, 8, 9, 11}
    assert languages(empty(spark)).count() == 0 and keep_identified(empty(spark)).count() == 0
    unlabelled = messy(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in languages(unlabelled).collect()} == {"und"}
