"""Parameters of the engine. Every default lives here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

KEY = ["date", "ticker"]

# Column names, texts and thresholds that results must agree on.
PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]
REQUIRED_COLUMNS = ["date", "open", "high", "low", "close", "adj close", "volume"]
FEATURES = ["ret_z", "vol_z", "range_pct"]
REASON_VOLUME = "Negative Volume"
REASON_HIGH = "High < max(open, close, low)"
REASON_LOW = "Low > min(open, close)"
TYPE_CRASH = "crash"
TYPE_SPIKE = "spike"
TYPE_VOLUME = "volume_shock"
TYPE_SEPARATOR = "+ "
WHY_RETURN = "|ret_z| > "
WHY_VOLUME = "vol_z > "
WHY_RANGE = "range_pct > "
WHY_SEPARATOR = "; "
# End of fixed values.


@dataclass(frozen=True)
class FeatureParams:
    ret_window: int = 63
    vol_window: int = 21
    range_window: int = 63

    @property
    def lookback(self) -> int:
        """Earlier rows one row's features can depend on (a return needs one row more)."""
        return max(self.ret_window + 1, self.vol_window, self.range_window)


@dataclass(frozen=True)
class RuleParams:
    ret_z: float = 2.5
    vol_z: float = 2.5
    range_pct: float = 0.95


@dataclass(frozen=True)
class Period:
    """Inclusive range of dates."""

    first: dt.date
    last: dt.date


def year(y: int) -> Period:
    return Period(dt.date(y, 1, 1), dt.date(y, 12, 31))


@dataclass(frozen=True)
class Splits:
    train: Period = field(default_factory=lambda: year(2018))
    val: Period = field(default_factory=lambda: year(2019))
    test: Period = field(
        default_factory=lambda: Period(dt.date(2020, 1, 1), dt.date(2020, 3, 31))
    )

    def items(self) -> list[tuple[str, Period]]:
        return [("train", self.train), ("val", self.val), ("test", self.test)]


@dataclass(frozen=True)
class DensityParams:
    eps: float = 0.7
    min_samples: int = 7


CLUSTERS = 3
SEED = 42
THRESHOLD_PERCENTILE = 97.5
PIPELINE_PERCENTILE = 95.0
STRESS_FLAG_RATE = 0.05
HISTOGRAM_BINS = 50
ELBOW_RANGE = range(2, 8)
