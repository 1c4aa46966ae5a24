from itertools import product

import pytest

from barwatch.config import RuleParams
from barwatch.operators.rules import rule_anomalies
from helpers import day, feature_rows

QUIET = {"ret": -0.003, "ret_z": -0.4, "vol_z": 0.9, "range_pct": 0.45}


def flagged(spark, at=None, params=RuleParams(), **change):
    """Six quiet rows, of which the one at ``at`` is changed."""
    rows = [
        (day(i), "QT", *({**QUIET, **(change if i == at else {})}).values()) for i in range(6)
    ]
    return rule_anomalies(feature_rows(spark, rows), params)


def spelled_out(ret, ret_z, vol_z, range_pct):
    """Type and reason of a row by the rules in words, or None."""
    kinds, whys = [], []
    if ret_z < -2.5 or ret_z > 2.5:
        kinds.append("crash" if ret is not None and ret < 0 else "spike")
        whys.append("|ret_z| > 2.5")
    if vol_z > 2.5:
        kinds.append("volume_shock")
        whys.append("vol_z > 2.5")
    if range_pct > 0.95:
        whys.append("range_pct > 0.95")
    return ("+ ".join(kinds), "; ".join(whys)) if whys else None


def test_type_and_reason_of_all_combinations(spark):
    cases = list(
        product(
            (-0.021, 0.0, 0.034, None), (-4.1, -2.51, 0.7, 2.9), (-6.0, 1.3, 2.75), (0.4, 0.953, 1.0)
        )
    )
    found = rule_anomalies(
        feature_rows(spark, [(day(i), "QT", *case) for i, case in enumerate(cases)])
    )
    got = {r["date"]: (r["type"], r["why"], r["anomaly_flag"]) for r in found.collect()}
    want = {day(i): (*spelled_out(*c), 1) for i, c in enumerate(cases) if spelled_out(*c)}
    assert got == want and len(got) < len(cases)


def test_calm_rows_low_volume_and_limits_are_not_flagged(spark):
    assert flagged(spark).count() == 0
    assert flagged(spark, 1, vol_z=-9.0).count() == 0
    assert flagged(spark, 1, vol_z=2.5, ret_z=-2.5, range_pct=0.95).count() == 0


@pytest.mark.parametrize("missing", ["ret_z", "vol_z", "range_pct"])
def test_warm_up_rows_are_skipped(spark, missing):
    loud = {"ret_z": 9.0, "vol_z": 9.0, "range_pct": 1.0, missing: None}
    assert flagged(spark, 2, **loud).count() == 0
    loud[missing] = float("nan")
    assert flagged(spark, 2, **loud).count() == 0


def test_thresholds_are_parameters_and_appear_in_the_reason(spark):
    rows = flagged(spark, 1, RuleParams(ret_z=1, vol_z=2, range_pct=0.5), vol_z=2.2).collect()
    assert [r["why"] for r in rows] == ["vol_z > 2.0"]


def test_schema_also_when_empty(spark):
    names = ["date", "ticker", "anomaly_flag", "type", "ret", "ret_z", "vol_z", "range_pct", "why"]
    assert flagged(spark).columns == names
    assert dict(flagged(spark).dtypes)["anomaly_flag"] == "int"
