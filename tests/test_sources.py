import datetime as dt

import pytest

from barwatch.sources.bars_csv import read_bars, union_bars
from barwatch.sources.tables import read_table, write_table
from helpers import bar, bars

HEADER = "date,open,high,low,close,adj close,volume"
GOOD = ["2020-01-02,10,12,9,11,11,1000", "2020-01-03,11,13,10,12,12,1100"]


def write(folder, name, lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_reads_typed_bars_with_ticker_from_file_name(spark, tmp_path):
    loaded = read_bars(spark, write(tmp_path, "QQQ.csv", [HEADER, *GOOD]))
    assert dict(loaded.dtypes) == {
        "ticker": "string", "date": "date", "open": "double", "high": "double", "low": "double",
        "close": "double", "adj_close": "double", "volume": "double",
    }
    rows = loaded.orderBy("date").collect()
    assert rows[0] == ("QQQ", dt.date(2020, 1, 2), 10.0, 12.0, 9.0, 11.0, 11.0, 1000.0)
    assert len(rows) == 2


def test_header_case_and_extra_columns(spark, tmp_path):
    lines = ["Date,Open,High,Low,Close,Adj Close,Volume,Note"] + [f"{g},x" for g in GOOD]
    loaded = read_bars(spark, write(tmp_path, "A.csv", lines))
    assert "note" not in loaded.columns and loaded.count() == 2


def test_column_order_of_the_file_does_not_matter(spark, tmp_path):
    lines = ["volume,adj close,close,low,high,open,date", "7,5,4,1,9,3,2020-01-02"]
    row = read_bars(spark, write(tmp_path, "A.csv", lines)).first()
    assert (row["volume"], row["high"], row["date"]) == (7.0, 9.0, dt.date(2020, 1, 2))


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_bars(spark, str(tmp_path / "nothing.csv"))


@pytest.mark.parametrize("gone", ["adj close", "date", "volume"])
def test_missing_column_raises_and_is_named(spark, tmp_path, gone):
    names = [n for n in HEADER.split(",") if n != gone]
    path = write(tmp_path, "A.csv", [",".join(names), ",".join("1" for _ in names)])
    with pytest.raises(ValueError, match=gone):
        read_bars(spark, path)


@pytest.mark.parametrize("bad", ["not-a-date", "", "2020-13-01", "02.01.2020"])
def test_bad_or_missing_date_raises(spark, tmp_path, bad):
    path = write(tmp_path, "A.csv", [HEADER, GOOD[0], f"{bad},1,1,1,1,1,1"])
    with pytest.raises(ValueError, match="date"):
        read_bars(spark, path)
    assert read_bars(spark, path, check_dates=False).filter("date is null").count() == 1


def test_missing_numbers_become_null(spark, tmp_path):
    path = write(tmp_path, "A.csv", [HEADER, "2020-01-02,NaN,,null,N/A,nan,NA"])
    row = read_bars(spark, path).first()
    assert all(row[c] is None for c in ("open", "high", "low", "close", "adj_close", "volume"))


def test_universe_of_many_files_in_one_read(spark, tmp_path):
    paths = [write(tmp_path, f"{t}.csv", [HEADER, *GOOD]) for t in ("AAA", "BBB", "CCC")]
    counts = read_bars(spark, paths).groupBy("ticker").count().collect()
    assert {(r["ticker"], r["count"]) for r in counts} == {("AAA", 2), ("BBB", 2), ("CCC", 2)}
    assert read_bars(spark, str(tmp_path)).count() == 6


def test_given_ticker_and_union(spark, tmp_path):
    one = read_bars(spark, write(tmp_path, "x.csv", [HEADER, *GOOD]), ticker="ONE")
    two = read_bars(spark, write(tmp_path, "y.csv", [HEADER, *GOOD]), ticker="TWO")
    both = union_bars([one, two.select(*reversed(two.columns))])
    assert {r["ticker"] for r in both.collect()} == {"ONE", "TWO"}


def test_different_headers_fail_instead_of_shifting_columns(spark, tmp_path):
    write(tmp_path, "A.csv", [HEADER, *GOOD])
    write(tmp_path, "B.csv", ["volume,adj close,close,low,high,open,date", "7,5,4,1,9,3,2020-01-02"])
    with pytest.raises(Exception):
        read_bars(spark, str(tmp_path), check_dates=False).collect()


def test_table_round_trip_by_month_keeps_empty_types(spark, tmp_path):
    flags = spark.createDataFrame(
        [(dt.date(2020, 1, 5), "A", ""), (dt.date(2020, 2, 5), "B", "crash")],
        "date date, ticker string, type string",
    )
    path = str(tmp_path / "flags")
    write_table(flags, path)
    back = read_table(spark, path)
    assert {tuple(r) for r in back.select("date", "ticker", "type").collect()} == {
        tuple(r) for r in flags.collect()
    }
    assert {r["month"] for r in back.collect()} == {"2020-01", "2020-02"}


def test_csv_table_round_trip(spark, tmp_path):
    frame = bars(spark, [bar(), bar(date=dt.date(2020, 1, 2), close=10.5)])
    path = str(tmp_path / "csv")
    write_table(frame, path, by_month=False, fmt="csv")
    back = read_table(spark, path, frame.schema, fmt="csv")
    assert sorted(back.collect()) == sorted(frame.collect())
    with pytest.raises(ValueError):
        read_table(spark, path, fmt="csv")
