import datetime as dt
import glob
import os

import numpy as np
import pytest
from helpers import bar, bars, day

from barwatch.config import FeatureParams
from barwatch.functions.ranks import counts_at_most
from barwatch.operators import features as features_module
from barwatch.operators.features import compute_features
from barwatch.operators.long_rank import trailing_rank
from barwatch.operators.quality import column_findings, strict_findings
from barwatch.plans.upserts import upsert_bars, upsert_months
from barwatch.sources import universe_csv
from barwatch.sources.tables import read_table, write_table
from barwatch.sources.universe_csv import read_universe


def write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def test_files_with_other_headers_load_in_one_call(spark, tmp_path):
    write(tmp_path, "A.csv", ["date,open,high,low,close,adj close,volume", "2020-01-02,10,12,9,11,10.5,1000"])
    write(tmp_path / "deep", "B.csv", ["", "Volume,\"Adj Close\", CLOSE ,Low,High,Open,Date,Extra,More", "7,5,4,1,9,3,2020-01-03,x,y"])
    write(tmp_path, "C.csv", ["﻿date,ticker,open,high,low,close,adj close,volume,open", "2020-01-04,Z,1,2,null,1,1,,99"])
    found, rejected = read_universe(spark, str(tmp_path))
    assert {tuple(r) for r in found.collect()} == {
        ("A", dt.date(2020, 1, 2), 10.0, 12.0, 9.0, 11.0, 10.5, 1000.0),
        ("B", dt.date(2020, 1, 3), 3.0, 9.0, 1.0, 4.0, 5.0, 7.0),
        ("Z", dt.date(2020, 1, 4), 1.0, 2.0, None, 1.0, 1.0, None),
    }
    assert rejected.count() == 0


def test_what_cannot_be_read_is_kept_aside_with_its_reasons(spark, tmp_path):
    header = "date,open,high,low,close,adj close,volume"
    write(tmp_path, "A.csv", [header, "2020-01-02,1,2,1,1,1,5", "02.01.2020,x,2,1,1,1,5", "2020-01-03,1,2,1,1,1,5,8",
                              header, "2020-01-04,1,2", "", "2020-13-01,1,2,1,1,1,5"])
    write(tmp_path, "B.csv", ["date,open,high,close,volume", "2020-01-02,1,2,1,5", "2020-01-03,1,2,1,5"])
    write(tmp_path, "C.csv", ["", " "])
    write(tmp_path, "D.csv", [header])
    write(tmp_path, "E.csv", [])
    found, rejected = read_universe(spark, str(tmp_path))
    assert {(r.ticker, str(r.date), r.low) for r in found.collect()} == {("A", "2020-01-02", 1.0), ("A", "2020-01-04", None)}
    assert {(r.ticker, r.line, r.reason) for r in rejected.collect()} == {
        ("A", "02.01.2020,x,2,1,1,1,5", "bad date; bad number: open"),
        ("A", "2020-01-03,1,2,1,1,1,5,8", "more cells than columns"),
        ("A", "2020-13-01,1,2,1,1,1,5", "bad date"),
        ("B", None, "missing columns: low, adj close"),
        ("C", None, "no header"),
    }


def test_missing_folder_raises_and_empty_files_give_no_bars(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_universe(spark, str(tmp_path / "nothing"))
    write(tmp_path, "C.csv", [])
    write(tmp_path, "D.csv", [""])
    found, rejected = read_universe(spark, str(tmp_path))
    assert found.count() == 0 and [r.reason for r in rejected.collect()] == ["no header"]


def test_many_folders_are_listed_once_by_few_tasks(spark, tmp_path, monkeypatch):
    header = "date,open,high,low,close,adj close,volume"
    for i in range(40):
        write(tmp_path / f"ticker=T{i}", "x.csv", [header, "2020-01-02,1,2,1,1,1,5", f"2020-01-{i},1,2,1,1,1,5"])
    spark.sparkContext.setJobGroup("listing", "read_universe")
    found, rejected = read_universe(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= 8
    bars = sorted(map(tuple, found.collect()))
    bad = sorted(map(tuple, rejected.collect()))
    assert {b[0] for b in bars} == {f"T{i}" for i in range(40)} and len(bars) == 40 + 22 and len(bad) == 18
    monkeypatch.setattr(universe_csv, "MAX_FILES", 10)
    found, rejected = read_universe(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == bars and sorted(map(tuple, rejected.collect())) == bad


def brute_counts(values, rows, first):
    return [
        0 if np.isnan(values[i]) else int((values[max(0, i - rows) : i] <= values[i]).sum()) for i in range(first, len(values))
    ]


@pytest.mark.parametrize("rows", [1, 7, 64, 500])
def test_counts_equal_brute_force(rows):
    rng = np.random.default_rng(rows)
    for values in (rng.normal(size=300), rng.integers(0, 5, 300).astype(float), np.full(50, 2.0), np.full(20, np.nan), np.zeros(0)):
        values[rng.random(len(values)) < 0.1] = np.nan
        for first in (0, len(values) // 2):
            assert counts_at_most(values, rows, first).tolist() == brute_counts(values, rows, first)


def test_rank_over_ten_thousand_rows(spark):
    rng = np.random.default_rng(4)
    n, window = 25_000, 10_000
    values = np.round(rng.normal(size=n), 2)
    start = dt.date(1950, 1, 1)
    rows = [("A", day(i, start), float(v)) for i, v in enumerate(values)] + [("B", day(i, start), 1.0) for i in range(9)]
    frame = spark.createDataFrame(rows, "ticker string, date date, v double")
    found = trailing_rank(frame, "ticker", "date", "v", window, "share")
    got = [r.share for r in found.filter("ticker = 'A'").orderBy("date").collect()]
    assert got[:window] == [None] * window
    want = np.array(brute_counts(values, window, window)) / window
    assert np.array_equal(np.array(got[window:]), want)
    assert [r.share for r in found.filter("ticker = 'B'").collect()] == [None] * 9


def test_features_with_long_windows_are_the_same_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [
        bar(t, day(i), high=float(11 + rng.integers(0, 9)), volume=float(rng.integers(1, 9)), close=0.0 if i % 50 == 9 else 10.0)
        for t in "AB" for i in range(260)
    ]
    frame, params = bars(spark, rows), FeatureParams(range_window=100)
    want = sorted(map(tuple, compute_features(frame, params).collect()))
    monkeypatch.setattr(features_module, "LONG_WINDOW", 100)
    assert sorted(map(tuple, compute_features(frame, params).collect())) == want


def panel(spark, change=lambda t, i: 0.0, skip=()):
    rows = [
        bar(t, day(i), adj_close=10.0 + (i * i + ord(t)) % 7 + change(t, i), high=11.0 + (3 * i + ord(t)) % 5, volume=100.0 + i % 11)
        for t in "ABC" for i in range(400) if (t, i) not in skip
    ]
    return bars(spark, rows)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}


def test_corrections_equal_a_rebuild_and_leave_other_months_alone(spark, tmp_path):
    stored, scored = str(tmp_path / "bars"), str(tmp_path / "features")
    params = FeatureParams(ret_window=20, vol_window=10, range_window=20)
    late = {("B", 100), ("B", 101), ("B", 0)}
    write_table(panel(spark, skip=late), stored)
    write_table(compute_features(panel(spark, skip=late), params), scored)
    before_bars, before = files(stored), files(scored)
    right = panel(spark, lambda t, i: 1.5 if (t, i) in {("A", 200), ("A", 290)} else 0.0)
    keys = [(t, day(i)) for t, i in late | {("A", 200), ("A", 290)}]
    changes = right.join(spark.createDataFrame(keys, "ticker string, date date"), ["ticker", "date"], "left_semi")
    months, feature_months = upsert_bars(spark, stored, scored, changes, params)

    assert months == ["2020-01", "2020-04", "2020-07", "2020-10"]
    assert set(months) < set(feature_months) and "2020-06" not in feature_months
    columns = right.columns
    assert sorted(map(tuple, read_table(spark, stored).select(columns).collect())) == sorted(map(tuple, right.collect()))
    want = compute_features(right, params)
    assert sorted(map(repr, read_table(spark, scored).select(want.columns).collect())) == sorted(map(repr, want.collect()))
    for path, old, touched in ((stored, before_bars, months), (scored, before, feature_months)):
        kept = {f: t for f, t in old.items() if f.split("month=")[1][:7] not in touched}
        assert kept and kept.items() <= files(path).items()


def test_upsert_edge_cases(spark, tmp_path):
    stored = str(tmp_path / "bars")
    write_table(panel(spark), stored)
    old = files(stored)
    assert upsert_months(spark, stored, panel(spark).limit(0)) == [] and files(stored) == old
    twice = bars(spark, [bar("A", day(1)), bar("A", day(1))])
    with pytest.raises(ValueError, match="unique"):
        upsert_months(spark, stored, twice)
    assert upsert_months(spark, stored, bars(spark, [bar("N", dt.date(2031, 5, 1))])) == ["2031-05"]
    assert read_table(spark, stored).count() == 1201


def test_findings_as_rows(spark):
    frame = bars(spark, [bar(volume=-1.0), bar(date=day(1), high=float("nan")), bar(date=day(2), low=99.0)]).drop("close")
    found = {r.column_name: (r.present, r.missing, r.rows) for r in column_findings(frame).collect()}
    assert found["close"] == (False, 3, 3) and found["high"] == (True, 1, 3) and found["date"] == (True, 0, 3)
    whole = bars(spark, [bar(volume=-1.0), bar(date=day(2), low=99.0, volume=-1.0)])
    assert [(r.position, r.rows, r.tickers) for r in strict_findings(whole).orderBy("position").collect()] == [(1, 2, 1), (2, 1, 1), (3, 1, 1)]
    assert strict_findings(bars(spark, [bar()])).count() == 0
