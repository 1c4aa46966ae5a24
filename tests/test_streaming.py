"""Streams: late rows, restarts and state, against the same functions on whole tables."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwatch.operators.features import compute_features
from barwatch.streaming.features import stream_features, trailing_shares, trailing_zscores
from barwatch.streaming.files import deliver, deliver_in_pieces, deliver_marker, drain, file_stream
from barwatch.streaming.windows import sessions, sliding, tumbling
from helpers import BARS, bar, bars, day

START = dt.datetime(2024, 1, 1)
EVENT = "id long, at timestamp, kind string, value double"


def events(spark, rows):
    return spark.createDataFrame([(i, None if h is None else START + dt.timedelta(hours=h), k, 1.0) for i, h, k in rows], EVENT)


def folders(tmp_path):
    return [str(tmp_path / name) for name in ("in", "out", "checkpoint")]


def count(frame):
    return Counter(tuple(r) for r in frame.collect())


def values():
    return [F.count("*").alias("n"), F.sum("value").alias("total")]


KINDS = {
    "tumbling": lambda rows: tumbling(rows, "at", "6 hours", ["kind"], values(), "12 hours"),
    "sliding": lambda rows: sliding(rows, "at", "6 hours", "2 hours", ["kind"], values(), "12 hours"),
    "sessions": lambda rows: sessions(rows, "at", "3 hours", ["kind"], values(), "12 hours"),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_a_restarted_stream_equals_the_table(spark, tmp_path, kind):
    rng = random.Random(kind)
    rows = [(i, h + rng.uniform(-5, 5), rng.choice("abc")) for i, h in enumerate(sorted(rng.uniform(0, 100) for _ in range(150)))]
    source, out, checkpoint = folders(tmp_path)
    table = events(spark, rows)
    for some in (rows[:50], rows[50:100]):
        deliver(events(spark, some), source)
    first = drain(KINDS[kind](file_stream(spark, source, table.schema)), out, checkpoint)
    early = count(first.table)
    assert early and first.dropped == 0
    # The second run goes on from the state of the first: open windows get rows of both.
    deliver(events(spark, [*rows[100:], (900, None, "a")]), source)
    deliver_marker(spark, source, table.schema, "at", START + dt.timedelta(days=30))
    second = drain(KINDS[kind](file_stream(spark, source, table.schema)), out, checkpoint)
    whole = count(KINDS[kind](table))
    assert count(second.table) == whole and not early - whole
    again = drain(KINDS[kind](file_stream(spark, source, table.schema)), out, checkpoint)
    assert count(again.table) == whole and again.dropped == 0


def test_rows_behind_the_watermark_are_left_out_and_counted(spark, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    schema = events(spark, []).schema
    # After the second file the watermark is at hour 48 - 12: hour 40 is late but counts, hours 1 and 2 do not.
    for some in ([(1, 1, "a"), (2, 47, "a")], [(3, 48, "a")], [(4, 40, "a"), (5, 1, "a"), (6, 2, "b"), (7, 60, "a")]):
        deliver(events(spark, some), source)
    deliver_marker(spark, source, schema, "at", START + dt.timedelta(days=30))
    found = drain(KINDS["tumbling"](file_stream(spark, source, schema)), out, checkpoint)
    hours = {((r.window_start - START.replace(tzinfo=dt.timezone.utc).timestamp()) / 3600, r.kind): r.n for r in found.table.collect()}
    assert hours == {(0, "a"): 1, (42, "a"): 1, (36, "a"): 1, (48, "a"): 1, (60, "a"): 1}
    assert found.dropped == 2


def history(seed: int, tickers: int = 4, days: int = 150):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(tickers):
        for n in range(days + 20 * t):
            close = None if rng.random() < 0.03 else float(np.round(10 + rng.normal(), 2))
            close = 0.0 if rng.random() < 0.02 else close
            volume = float(rng.choice([0, -3, 100, 250, 400]))
            rows.append(bar(f"T{t}", day(n), high=11 + float(rng.integers(4)), low=9.0, close=10.0 + float(rng.integers(2)), adj_close=close, volume=volume))
    rows += [bar("flat", day(n)) for n in range(90)] + [bar("short", day(5)), bar("T0", None)]
    return [r[:6] + (float("nan") if r[6] is not None and i % 97 == 0 else r[6],) + r[7:] for i, r in enumerate(rows)]


def rounded(frame):
    return Counter(
        (r.date, r.ticker, *(None if v is None else round(v, 7) for v in (r.ret, r.ret_z, r.vol_z, r.range_pct))) for r in frame.collect()
    )


def test_streamed_features_equal_those_of_the_table(spark, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    table = bars(spark, history(7))
    known = table.filter("date is not null")
    late = F.date_add("date", F.pmod(F.hash("ticker", "date"), F.lit(6)).cast("int")).cast("timestamp")
    ends = [START.replace(year=2020) + dt.timedelta(days=n) for n in (40, 41, 90)]
    deliver_in_pieces(table, source, late, ends)
    build = lambda: stream_features(file_stream(spark, source, table.schema), "6 days")
    first = drain(build(), out, checkpoint)
    wanted = rounded(compute_features(known))
    early = rounded(first.table)
    assert 0 < sum(early.values()) < sum(wanted.values()) and not early - wanted
    deliver_marker(spark, source, table.schema, "date", day(900))
    second = drain(build(), out, checkpoint)
    assert rounded(second.table) == wanted and second.dropped == 0


def test_pieces_of_several_files_are_a_batch_each(spark, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    table = bars(spark, history(7)).filter("date is not null").repartition(4)
    late = F.date_add("date", F.pmod(F.hash("ticker", "date"), F.lit(4)).cast("int")).cast("timestamp")
    ends = [START.replace(year=2020) + dt.timedelta(days=n) for n in (1, 40, 90)]
    files = deliver_in_pieces(table, source, late, ends, file_rows=40)
    # The largest piece is spread over files of some 40 rows; the first one has fewer rows than files.
    assert files > 4 and len(spark.read.parquet(source).inputFiles()) == 4 * files
    assert max(r[0] for r in spark.read.parquet(source).groupBy(F.input_file_name()).agg(F.count("*")).select("count(1)").collect()) <= 60
    deliver_marker(spark, source, table.schema, "date", day(900))
    found = drain(stream_features(file_stream(spark, source, table.schema, files), "4 days"), out, checkpoint)
    assert found.dropped == 0 and rounded(found.table) == rounded(compute_features(table))


def test_corrections_count_while_open_and_late_bars_do_not(spark, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    deliver(bars(spark, [bar("A", day(0), close=10.0), bar("A", day(1), close=11.0)]), source)
    deliver(bars(spark, [bar("A", day(1), close=12.0), bar("A", day(20), close=24.0)]), source)
    deliver(bars(spark, [bar("A", day(21), close=24.0)]), source)
    deliver(bars(spark, [bar("A", day(3), close=99.0), bar("A", day(30), close=48.0)]), source)
    deliver_marker(spark, source, spark.createDataFrame([], BARS).schema, "date", day(90))
    found = drain(stream_features(file_stream(spark, source, spark.createDataFrame([], BARS).schema), "5 days"), out, checkpoint)
    rets = {r.date: r.ret for r in found.table.collect()}
    assert rets == {day(0): None, day(1): pytest.approx(0.2), day(20): pytest.approx(1.0), day(21): 0.0, day(30): pytest.approx(1.0)}
    assert found.dropped == 1


def test_trailing_functions_against_loops():
    rng = np.random.default_rng(3)
    values = np.where(rng.random(60) < 0.05, np.nan, np.round(rng.normal(size=60), 1))
    z, shares = trailing_zscores(values, 5), trailing_shares(values, 5)
    for i, v in enumerate(values):
        past = values[max(0, i - 5) : i]
        whole = len(past) == 5 and not np.isnan(past).any() and len(set(past)) > 1
        assert z[i] == pytest.approx((v - past.mean()) / past.std(ddof=1), nan_ok=True) if whole else np.isnan(z[i])
        assert shares[i] == pytest.approx((past <= v).sum() / 5) if i >= 5 else np.isnan(shares[i])
