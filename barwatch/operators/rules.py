"""Threshold rules: which bars are unusual, of what type and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.config import (
    FEATURES,
    TYPE_CRASH,
    TYPE_SEPARATOR,
    TYPE_SPIKE,
    TYPE_VOLUME,
    WHY_RANGE,
    WHY_RETURN,
    WHY_SEPARATOR,
    WHY_VOLUME,
    RuleParams,
)


def rule_anomalies(features: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """Rows that break a rule, with a type and a readable reason. Row-wise: no shuffle.

    The range rule flags without giving a type, so the type may be empty.
    """
    big_move = F.abs("ret_z") > params.ret_z
    heavy_volume = F.col("vol_z") > params.vol_z
    wide_range = F.col("range_pct") > params.range_pct
    direction = F.when(F.col("ret") < 0, TYPE_CRASH).otherwise(TYPE_SPIKE)

    return (
        features.dropna(subset=FEATURES)
        .filter(big_move | heavy_volume | wide_range)
        .select(
            "date",
            "ticker",
            F.lit(1).alias("anomaly_flag"),
            F.concat_ws(
                TYPE_SEPARATOR, F.when(big_move, direction), F.when(heavy_volume, TYPE_VOLUME)
            ).alias("type"),
            "ret",
            *FEATURES,
            F.concat_ws(
                WHY_SEPARATOR,
                F.when(big_move, f"{WHY_RETURN}{float(params.ret_z)}"),
                F.when(heavy_volume, f"{WHY_VOLUME}{float(params.vol_z)}"),
                F.when(wide_range, f"{WHY_RANGE}{float(params.range_pct)}"),
            ).alias("why"),
        )
    )
