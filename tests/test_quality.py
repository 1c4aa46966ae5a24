import pytest
from pyspark.sql import functions as F

from barwatch.operators import quality
from helpers import bar, bars, day

NAN = float("nan")


def reasons(frame):
    return sorted((r["ticker"], r["date"].day, r["reason"]) for r in quality.issues(frame).collect())


def test_valid_bars_pass(spark):
    frame = bars(spark, [bar(date=day(i)) for i in range(5)])
    same, found = quality.validate(frame, strict=True)
    assert same.count() == 5 and found.count() == 0


def test_each_rule_and_several_at_once(spark):
    frame = bars(
        spark,
        [
            bar(date=day(0), volume=-1.0),
            bar(date=day(1), high=9.5),
            bar(date=day(2), low=10.5),
            bar(date=day(3), high=5.0, low=20.0, volume=-2.0),
            bar(date=day(4), volume=0.0, high=10.0, low=10.0),
        ],
    )
    assert reasons(frame) == [
        ("A", 1, "Negative Volume"),
        ("A", 2, "High < max(open, close, low)"),
        ("A", 3, "Low > min(open, close)"),
        ("A", 4, "High < max(open, close, low)"),
        ("A", 4, "Low > min(open, close)"),
        ("A", 4, "Negative Volume"),
    ]


def test_missing_values_break_no_rule_but_are_skipped_in_comparisons(spark):
    frame = bars(
        spark,
        [
            bar(date=day(0), volume=NAN, high=NAN, low=NAN),
            bar(date=day(1), volume=None, high=None, low=None),
            bar(date=day(2), open=NAN, high=9.5, low=9.0, close=9.9, adj_close=1.0),
        ],
    )
    assert reasons(frame) == [("A", 3, "High < max(open, close, low)")]


def test_strict_raises_first_rule_in_order(spark):
    frame = bars(spark, [bar(date=day(0), low=10.5), bar(date=day(1), volume=-1.0)])
    with pytest.raises(ValueError, match="Negative Volume"):
        quality.validate(frame, strict=True)


def test_duplicates_raise_and_list_all_rows(spark):
    frame = bars(spark, [bar(date=day(0)), bar(date=day(1)), bar(date=day(1)), bar("B", day(1))])
    with pytest.raises(ValueError, match="2020-01-02"):
        quality.validate(frame)
    assert [(r["ticker"], r["date"]) for r in quality.duplicates(frame).collect()] == [
        ("A", day(1)),
        ("A", day(1)),
    ]


def test_empty_and_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="no bars"):
        quality.validate(bars(spark, []))
    with pytest.raises(ValueError, match="volume"):
        quality.validate(bars(spark, [bar()]).drop("volume"))


def test_clean_gate_and_report(spark):
    frame = bars(
        spark,
        [bar(date=day(0)), bar(date=day(1), volume=-1.0, high=1.0), bar("B", day(0)),
         bar("B", day(1), low=50.0)],
    )
    cleaned, log = quality.quality_gate(frame)
    kept = {("A", day(0)), ("B", day(0))}
    assert {(r["ticker"], r["date"]) for r in cleaned.collect()} == kept
    assert {(r["ticker"], r["date"]) for r in quality.drop_listed(frame, log).collect()} == kept
    rows = {r["ticker"]: r for r in quality.report(frame).collect()}
    assert (rows["A"]["rows_before"], rows["A"]["rows_after"]) == (2, 1)
    assert (rows["A"]["negative_volume"], rows["A"]["high_too_low"]) == (1, 1)
    assert "Low > min(open, close)" in rows["B"]["reasons"]


def test_out_of_order_agrees_with_whole_ticker_comparison(spark):
    days = [0, 1, 5, 2, 3, 9, 8, 10, 11, 4]
    placed = spark.createDataFrame(
        [("A", day(d), i) for i, d in enumerate(days)], "ticker string, date date, at long"
    )
    expected = {(day(b), day(a)) for a, b in zip(days, days[1:]) if b < a}
    for size in (1, 2, 3, 100):
        found = quality.out_of_order(placed, "at", F.floor(F.col("at") / size)).collect()
        assert {(r["date"], r["previous_date"]) for r in found} == expected
    frame = bars(spark, [bar(date=day(d)) for d in days])
    unsorted = frame.join(placed, ["ticker", "date"])
    with pytest.raises(ValueError, match="ascending"):
        quality.validate(unsorted, position="at")
    quality.validate(unsorted.withColumn("at", F.unix_date("date")), position="at")


def test_missing_tickers(spark):
    expected = spark.createDataFrame([("A",), ("B",)], "ticker string")
    found = quality.missing_tickers(bars(spark, [bar()]), expected).collect()
    assert [r["ticker"] for r in found] == ["B"]
