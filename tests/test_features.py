import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwatch.config import FeatureParams
from barwatch.functions.trailing import (
    log_volume,
    relative_range,
    simple_return,
    trailing_share_at_most,
    trailing_zscore,
)
from barwatch.operators.features import (
    compute_features,
    eda_columns,
)
from helpers import bar, bars, day

def order():
    return Window.partitionBy("ticker").orderBy("date")


def series(spark, values):
    rows = [("A", day(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, date date, v double")


def column(frame, name):
    return [r[name] for r in frame.orderBy("date").collect()]


def test_return(spark):
    got = column(series(spark, [8, 10, 9, 0, 5, None, 4]).withColumn(
        "r", simple_return(F.col("v"), order())), "r")
    assert got == [None, pytest.approx(0.25), pytest.approx(-0.1), -1.0, None, None, None]


def past_scores(values, window):
    """Z-scores of each value against the ``window`` values before it, by numpy."""
    out = [None] * window
    for i in range(window, len(values)):
        past = np.array(values[i - window:i])
        out.append(pytest.approx((values[i] - past.mean()) / past.std(ddof=1), abs=1e-9))
    return out


def test_zscore_sees_only_the_past(spark):
    values = np.random.default_rng(11).normal(3, 0.5, 12).tolist()
    z = trailing_zscore(F.col("v"), 4, order())
    assert column(series(spark, values).withColumn("z", z), "z") == past_scores(values, 4)
    values[9] = -70.0
    assert column(series(spark, values).withColumn("z", z), "z") == past_scores(values, 4)


def test_constant_window_has_no_zscore(spark):
    z = trailing_zscore(F.col("v"), 3, order())
    got = column(series(spark, [7.5, 7.5, 7.5, 7.5, 8.0, 7.5, 7.5, 7.5, 2.0]).withColumn("z", z), "z")
    assert [v is None for v in got] == [True] * 5 + [False] * 3 + [True]


def test_volume_zscore_warm_up_and_zero(spark):
    z = trailing_zscore(F.col("lv"), 3, order())

    def scores(volumes):
        logged = series(spark, volumes).withColumn("lv", log_volume(F.col("v")))
        return column(logged.withColumn("z", z), "z")

    volumes = np.random.default_rng(12).integers(40, 9000, 10).tolist()
    assert scores(volumes) == past_scores(np.log(volumes).tolist(), 3)
    # A zero voids its own day and every window that contains it.
    got = scores([31, 57, 44, 0, 62, 35, 48, 51, 29])
    assert [v is None for v in got] == [True, True, True, True, True, True, True, False, False]


def test_range_share(spark):
    rng = np.random.default_rng(13)
    rows = [bar(date=day(i), high=12.0 + rng.random(), low=12.0 - rng.random(), close=12.0)
            for i in range(9)]
    spans = bars(spark, rows).withColumn(
        "v", relative_range(F.col("high"), F.col("low"), F.col("close")))
    share = trailing_share_at_most(F.col("v"), 4, order())
    width = [(r[3] - r[4]) / r[5] for r in rows]
    want = [None] * 4 + [
        pytest.approx(np.mean([w <= width[i] for w in width[i - 4:i]])) for i in range(4, 9)
    ]
    assert column(spans.withColumn("s", share), "s") == want


def test_range_share_with_missing_values(spark):
    share = trailing_share_at_most(F.col("v"), 3, order())
    got = column(series(spark, [1, None, 3, 2, None, 4, 1]).withColumn("s", share), "s")
    assert got[:3] == [None] * 3
    assert got[3] == pytest.approx(1 / 3)
    assert got[4] == 0.0
    assert got[5] == pytest.approx(2 / 3)
    assert got[6] == 0.0


def random_bars(seed, tickers=3, days=140, holes=True):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(tickers):
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, days)))
        for i in range(days):
            if holes and rng.random() < 0.1:
                continue
            c = round(float(close[i]), 4)
            rows.append(
                (f"T{t}", day(i * 2 + t), c, round(c * (1 + rng.random() * 0.03), 4),
                 round(c * (1 - rng.random() * 0.03), 4), c, c,
                 0.0 if holes and rng.random() < 0.02 else float(rng.integers(1, 10000)))
            )
    return rows


def by_pandas(rows, p):
    """Features by plain pandas, one ticker at a time."""
    frame = pd.DataFrame(rows, columns=["ticker", "date", "open", "high", "low", "close",
                                        "adj_close", "volume"])
    out = []
    for ticker, g in frame.sort_values("date").groupby("ticker"):
        ret = g.adj_close / g.adj_close.shift(1) - 1
        lv = pd.Series([np.log(v) if v > 0 else np.nan for v in g.volume], index=g.index)

        def z(s, w):
            past = s.shift(1).rolling(w)
            dev = past.std()
            return (s - past.mean()) / dev.where(dev > 1e-12)

        span = ((g.high - g.low) / g.close).to_numpy()
        share = [
            np.mean(span[i - p.range_window:i] <= span[i]) if i >= p.range_window else np.nan
            for i in range(len(span))
        ]
        out.append(pd.DataFrame({"date": g.date, "ticker": ticker, "ret": ret,
                                 "ret_z": z(ret, p.ret_window), "vol_z": z(lv, p.vol_window),
                                 "range_pct": share}))
    return pd.concat(out).sort_values(["ticker", "date"]).reset_index(drop=True)


def test_features_agree_with_pandas(spark):
    rows = random_bars(1)
    p = FeatureParams()
    got = compute_features(bars(spark, rows), p).orderBy("ticker", "date").toPandas()
    want = by_pandas(rows, p)
    assert list(got.ticker) == list(want.ticker) and list(got.date) == list(want.date)
    for c in ("ret", "ret_z", "vol_z", "range_pct"):
        np.testing.assert_allclose(got[c].astype(float), want[c], atol=1e-9, equal_nan=True)
    assert got.range_pct.notna().sum() > 50


def test_warm_up_differs_per_feature(spark):
    rows = random_bars(2, tickers=1, days=80, holes=False)
    got = compute_features(bars(spark, rows)).orderBy("date").toPandas()
    first = {c: int(got[c].first_valid_index()) for c in ("ret", "ret_z", "vol_z", "range_pct")}
    assert first == {"ret": 1, "ret_z": 64, "vol_z": 21, "range_pct": 63}


@pytest.mark.parametrize("piece_rows", [64, 65, 100, 5000])
def test_pieces_give_the_same_features(spark, piece_rows):
    frame = bars(spark, random_bars(3, tickers=4, days=400))
    whole = compute_features(frame)
    pieces = compute_features(frame, piece_rows=piece_rows)
    assert whole.count() == pieces.count()
    assert whole.exceptAll(pieces).count() == 0


def test_pieces_must_hold_the_lookback(spark):
    with pytest.raises(ValueError):
        compute_features(bars(spark, [bar()]), piece_rows=10)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cut=st.integers(30, 120), seed=st.integers(0, 1000))
def test_features_do_not_look_ahead(spark, cut, seed):
    p = FeatureParams(ret_window=10, vol_window=5, range_window=10)
    frame = bars(spark, random_bars(seed, tickers=2, days=130))
    until = F.col("date") <= F.lit(day(cut * 2))
    part = compute_features(frame.filter(until), p)
    whole = compute_features(frame, p).filter(until)
    assert part.count() == whole.count() and part.exceptAll(whole).count() == 0


def test_nan_counts_as_missing(spark):
    rows = [bar(date=day(i), adj_close=float(i + 1)) for i in range(4)]
    rows[2] = bar(date=day(2), adj_close=float("nan"), volume=float("nan"))
    got = column(compute_features(bars(spark, rows)), "ret")
    assert got[1] == 1.0 and got[2] is None and got[3] is None


def test_eda_columns(spark):
    frame = bars(spark, [bar(date=day(0), volume=0.0), bar(date=day(1), adj_close=11.0)])
    got = eda_columns(frame).orderBy("date").collect()
    assert got[0]["log_volume"] is None and got[1]["daily_return"] == pytest.approx(0.1)
    assert eda_columns(frame, piece_rows=1).exceptAll(eda_columns(frame)).count() == 0
