"""As-of joins and overlapping spans against brute force; the shape of their plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barwatch.operators.asof import asof_join
from barwatch.operators.intervals import interval_join, spells
from helpers import day

START = dt.datetime(2024, 1, 1)
LEFT, RIGHT = "id int, k string, j int, t timestamp", "k string, j int, u timestamp, a int, b string"


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def sides(seed: int, n: int, hot: float):
    rng = random.Random(seed)

    def key():
        return rng.choice([("hot", 1)] if rng.random() < hot else [("a", 1), ("a", 2), ("b", 1), ("c", None), (None, 1)])

    def minute():
        return None if rng.random() < 0.03 else rng.randrange(-5_000, 40_000) // rng.choice([1, 500])

    left = [(i, *key(), at(minute())) for i in range(n)]
    right = [(*key(), at(minute()), rng.randrange(3), rng.choice([None, "x", "y"])) for _ in range(n)]
    return left, [r for r in right if r[0] != "b"]


def order_key(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def expected(left, right, inclusive, within=None):
    out = Counter()
    for i, k, j, t in left:
        fits = []
        if None not in (k, j, t):
            fits = [r for r in right if r[:2] == (k, j) and r[2] is not None and (r[2] <= t if inclusive else r[2] < t)]
        best = max(fits, key=lambda r: (r[2], order_key(r[3:])), default=None)
        if best and within is not None and best[2] + within < t:
            best = None
        out[i, k, j, t, *(best[3:] if best else (None, None))] += 1
    return out


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("seed, hot, slice_rows", [(1, 0.0, 10**9), (2, 0.5, 40), (3, 0.9, 25)])
def test_asof_equals_brute_force(spark, seed, hot, slice_rows, inclusive):
    left, right = sides(seed, 400, hot)
    found = asof_join(
        spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3),
        ["k", "j"], "t", "u", ["a", "b"], inclusive=inclusive, slice_rows=slice_rows,
    )
    assert found.columns == ["id", "k", "j", "t", "a", "b"]
    assert Counter(tuple(r) for r in found.collect()) == expected(left, right, inclusive)


def test_asof_within_a_span(spark):
    left, right = sides(4, 300, 0.6)
    found = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "j"], "t", "u", ["a", "b"],
        within=F.make_dt_interval(hours=F.lit(5)), slice_rows=50,
    )
    assert Counter(tuple(r) for r in found.collect()) == expected(left, right, True, dt.timedelta(hours=5))


def test_a_slice_without_right_rows_gets_the_one_before_it(spark):
    left = [(i, "k", 1, at(1440 * i)) for i in range(200)]
    right = [("k", 1, at(-7), 5, "first"), ("k", 1, at(1440 * 150), 6, "second")]
    found = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "j"], "t", "u", ["b"], slice_rows=10
    )
    assert {r.id: r.b for r in found.collect()} == {i: "first" if i < 150 else "second" for i in range(200)}


def test_asof_of_empty_sides_and_clashing_names(spark):
    left, right = sides(5, 20, 0.0)
    none = spark.createDataFrame([], RIGHT)
    assert {(r.a, r.b) for r in asof_join(spark.createDataFrame(left, LEFT), none, ["k", "j"], "t", "u", ["a", "b"]).collect()} == {(None, None)}
    assert asof_join(spark.createDataFrame([], LEFT), none, ["k", "j"], "t", "u", ["a"]).count() == 0
    with pytest.raises(ValueError, match="id"):
        asof_join(spark.createDataFrame(left, LEFT), none.withColumn("id", F.lit(1)), ["k"], "t", "u", ["id"])


def test_asof_plan_has_no_pairs(spark):
    left, right = sides(6, 50, 0.0)
    found = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "j"], "t", "u", ["a"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and plan.count("Window") == 1


SPAN_L, SPAN_R = "k string, f timestamp, t timestamp, l int", "k string, g timestamp, u timestamp, r int"


def spans(seed: int, n: int):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        begin = rng.randrange(-3_000, 30_000)
        length = int(rng.choice([0, 1, 8, 64, 100, 4_000, 60_000, -5]) * rng.random())
        begin, end = at(begin), at(begin + length)
        out.append((rng.choice(["a", "b", None]), rng.choice([begin] * 20 + [None]), rng.choice([end] * 20 + [None]), i))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlaps_equal_brute_force(spark, seed):
    left, right = spans(seed, 250), spans(seed + 50, 250)
    found = interval_join(spark.createDataFrame(left, SPAN_L), spark.createDataFrame(right, SPAN_R), ["k"], ("f", "t"), ("g", "u"))
    assert found.columns == ["k", "f", "t", "l", "g", "u", "r"]
    sound = lambda s: [x for x in s if None not in x[:3] and x[1] <= x[2]]
    want = Counter((*x, *y[1:]) for x in sound(left) for y in sound(right) if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    assert Counter(tuple(r) for r in found.collect()) == want and len(want) > 900


def test_long_spans_meet_short_ones_in_few_bins(spark):
    minutes = [("k", at(i), at(i), i) for i in range(3000)]
    years = [("k", at(-10**6 * (i + 1)), at(10**6), i) for i in range(3)]
    found = interval_join(spark.createDataFrame(minutes, SPAN_L), spark.createDataFrame(years, SPAN_R), ["k"], ("f", "t"), ("g", "u"))
    assert found.count() == 9000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (((" in plan and "_bin" in plan


def test_points_touch_and_adjacent_spans_do_not(spark):
    left = [("k", at(0), at(10), 1), ("k", at(10), at(10), 2), ("k", at(11), at(20), 3)]
    right = [("k", at(10), at(11), 1), ("k", at(-5), at(-1), 2), ("k", at(20), at(20), 3)]
    found = interval_join(spark.createDataFrame(left, SPAN_L), spark.createDataFrame(right, SPAN_R), ["k"], ("f", "t"), ("g", "u"))
    assert sorted((r.l, r.r) for r in found.collect()) == [(1, 1), (2, 1), (3, 1), (3, 3)]


def test_overlaps_of_empty_sides_and_clashing_names(spark):
    some, none = spark.createDataFrame(spans(1, 9), SPAN_L), spark.createDataFrame([], SPAN_R)
    assert interval_join(some, none, ["k"], ("f", "t"), ("g", "u")).count() == 0
    with pytest.raises(ValueError, match="f"):
        interval_join(some, some, ["k"], ("f", "t"), ("f", "t"))


def test_spells(spark):
    rows = [("a", day(n)) for n in (0, 1, 1, 3, 9, 30)] + [("b", day(2)), ("b", None)]
    found = spells(spark.createDataFrame(rows, "k string, d date"), ["k"], "d", 3)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", day(0), day(3), 4), ("a", day(9), day(9), 1), ("a", day(30), day(30), 1), ("b", day(2), day(2), 1)]
