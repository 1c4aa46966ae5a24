"""Structural and financial checks of bars, and the cleaning that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwatch.config import (
    KEY,
    PRICE_COLUMNS,
    REASON_HIGH,
    REASON_LOW,
    REASON_VOLUME,
)
from barwatch.sources.bars_csv import require_columns

BAR_COLUMNS = ["date", "ticker", *PRICE_COLUMNS, "volume"]
POSITION_BLOCK = 1 << 20
REASONS = [REASON_VOLUME, REASON_HIGH, REASON_LOW]


def broken_rules() -> Column:
    """Array of the rules a bar breaks, in check order. A missing value breaks none."""

    def known(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    prices = {name: known(name) for name in ("open", "high", "low", "close")}
    body_top = F.greatest(prices["open"], prices["close"], prices["low"])
    body_bottom = F.least(prices["open"], prices["close"])
    return F.array_compact(
        F.array(
            F.when(known("volume") < 0, REASON_VOLUME),
            F.when(prices["high"] < body_top, REASON_HIGH),
            F.when(prices["low"] > body_bottom, REASON_LOW),
        )
    )


def issues(bars: DataFrame) -> DataFrame:
    """One row per bar and broken rule. One pass, no shuffle."""
    return bars.select("ticker", "date", F.explode(broken_rules()).alias("reason"))


def clean(bars: DataFrame) -> DataFrame:
    """Bars that break no rule. Nothing is imputed."""
    return bars.filter(F.size(broken_rules()) == 0)


def drop_listed(bars: DataFrame, issue_log: DataFrame) -> DataFrame:
    """Bars whose (ticker, date) is not in a given issue log."""
    return bars.join(issue_log.select(*KEY), KEY, "left_anti")


def duplicates(bars: DataFrame) -> DataFrame:
    """All rows of every (ticker, date) that occurs more than once."""
    repeated = bars.groupBy(*KEY).count().filter("count > 1").select(*KEY)
    return bars.join(repeated, KEY, "left_semi")


def out_of_order(bars: DataFrame, position: str, block: Column) -> DataFrame:
    """Places where the date falls along the ingest ``position`` within a ticker.

    ``block`` cuts the positions into ascending, bounded runs (for instance input splits): rows are
    compared with their predecessor inside a block and each block's first row with the last row of
    the block before, so no task has to hold a whole ticker. Returns ticker, date, previous_date.
    """
    placed = bars.select("ticker", "date", F.col(position).alias("_at"), block.alias("_block"))
    inside = Window.partitionBy("ticker", "_block").orderBy("_at")
    within = placed.select("ticker", "date", F.lag("date").over(inside).alias("previous_date"))

    ends = placed.groupBy("ticker", "_block").agg(
        F.min_by("date", "_at").alias("date"), F.max_by("date", "_at").alias("_last")
    )
    across = Window.partitionBy("ticker").orderBy("_block")
    between = ends.select("ticker", "date", F.lag("_last").over(across).alias("previous_date"))
    return within.unionByName(between).filter(F.col("date") < F.col("previous_date"))


def missing_tickers(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tickers without a single bar."""
    return expected.select("ticker").distinct().join(
        bars.select("ticker").distinct(), "ticker", "left_anti"
    )


def report(bars: DataFrame) -> DataFrame:
    """Per ticker: rows before and after cleaning, and how often each rule was broken."""
    counted = bars.select("ticker", broken_rules().alias("broken"))

    def times(reason: str) -> Column:
        return F.count_if(F.array_contains("broken", reason))

    return counted.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.size("broken") == 0).alias("rows_after"),
        times(REASON_VOLUME).alias("negative_volume"),
        times(REASON_HIGH).alias("high_too_low"),
        times(REASON_LOW).alias("low_too_high"),
        F.concat_ws(
            "; ", F.array_sort(F.array_distinct(F.flatten(F.collect_set("broken"))))
        ).alias("reasons"),
    )


def reason_counts(bars: DataFrame) -> DataFrame:
    return issues(bars).groupBy("ticker", "reason").count()


def validate(
    bars: DataFrame,
    strict: bool = False,
    position: str | None = None,
    block: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Check structure, then prices and volumes; returns the bars and their issue log.

    Raises ValueError for missing columns, no rows or duplicate keys, and with ``strict`` also for
    any broken rule (all rules are counted in one job, the first in check order is reported).
    Order is not a property of a DataFrame; it is checked if the bars carry an ingest ``position``
    (see ``out_of_order``, also for ``block``).
    """
    require_columns(bars, BAR_COLUMNS)
    if bars.isEmpty():
        raise ValueError("no bars")
    repeated = bars.groupBy(*KEY).count().filter("count > 1").limit(10).collect()
    if repeated:
        keys = sorted({(r["ticker"], str(r["date"])) for r in repeated})
        raise ValueError(f"duplicate dates, e.g. {keys}")
    if position is not None:
        runs = block if block is not None else F.floor(F.col(position) / POSITION_BLOCK)
        late = out_of_order(bars, position, runs).limit(10).collect()
        if late:
            keys = sorted({(r["ticker"], str(r["date"])) for r in late})
            raise ValueError(f"dates not in ascending order, e.g. {keys}")
    if strict:
        require_sane(bars)
    return bars, issues(bars)


def column_findings(bars: DataFrame, required: list[str] = BAR_COLUMNS) -> DataFrame:
    """One row per required column: column_name, present, missing (rows without a value), rows.

    What ``validate`` raises for columns, as a table: an absent column is missing in every row. Null and
    NaN count as missing. One pass, no value leaves the scan.
    """

    def absent(name: str) -> Column:
        if name not in bars.columns:
            return F.count(F.lit(1))
        value = F.col(f"`{name}`")
        return F.count_if(value.isNull() | F.isnan(value.try_cast("double")) if name in PRICE_COLUMNS else value.isNull())

    counted = bars.agg(F.count(F.lit(1)).alias("rows"), *[absent(c).alias(f"n{i}") for i, c in enumerate(required)])
    found = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(c in bars.columns).alias("present"), F.col(f"n{i}").alias("missing"))
            for i, c in enumerate(required)
        ]
    )
    return counted.select(F.explode(found).alias("found"), "rows").select("found.*", "rows")


def strict_findings(bars: DataFrame) -> DataFrame:
    """Broken rules: position (the order in which strict mode reports them), reason, rows, tickers, first_date.

    No row for a rule nothing breaks; strict mode raises for the one with the smallest position.
    """
    position = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reason")).cast("int")
    return (
        issues(bars)
        .groupBy(position.alias("position"), "reason")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("ticker").alias("tickers"),
            F.min("date").alias("first_date"),
        )
    )


def require_sane(bars: DataFrame) -> None:
    found = issues(bars).groupBy("reason").count().collect()
    counts = {row["reason"]: row["count"] for row in found}
    for reason in REASONS:
        if reason in counts:
            raise ValueError(f"{reason}: {counts[reason]} rows")


def quality_gate(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate, clean if something is wrong, validate strictly; returns clean bars and issues."""
    _, issue_log = validate(bars)
    if issue_log.isEmpty():
        return bars, issue_log
    cleaned = clean(bars)
    require_sane(cleaned)
    return cleaned, issue_log
