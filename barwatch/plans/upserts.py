"""Late and corrected bars: only the months they touch are written again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwatch.config import KEY, FeatureParams
from barwatch.operators.features import compute_features
from barwatch.session import materialize
from barwatch.sources.tables import MONTH, month_of, read_table


def touched_months(rows: DataFrame) -> list[str]:
    """Months of the rows' dates, ascending; the calendar bounds their number."""
    found = rows.select(month_of("date").alias(MONTH)).distinct().collect()
    return sorted(r[MONTH] for r in found)


def upsert_months(spark: SparkSession, path: str, rows: DataFrame) -> list[str]:
    """Put ``rows`` into the table stored by month at ``path``; returns the months written.

    A row replaces the stored one of its (date, ticker) or is added. The keys of ``rows`` have to be
    unique and their dates not null, else ValueError. Only the folders of touched months are read and
    replaced (dynamic partition overwrite); other folders keep their files. The new months are complete
    in the shared folder before anything is replaced, and doing it again gives the same table.
    """
    fresh = materialize(rows)
    checked = fresh.groupBy(*KEY).count().filter((F.col("count") > 1) | F.col("date").isNull())
    if not checked.isEmpty():
        raise ValueError("upserted rows need unique (date, ticker) with a date")
    months = touched_months(fresh)
    if not months:
        return months
    stored = read_table(spark, path)
    kept = stored.filter(F.col(MONTH).isin(months)).join(fresh.select(*KEY), KEY, "left_anti")
    merged = kept.unionByName(fresh.withColumn(MONTH, month_of("date"))).select(*stored.columns)
    whole = materialize(merged)
    (
        whole.hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )
    return months


def affected_keys(dates: DataFrame, changes: DataFrame, lookback: int) -> DataFrame:
    """(date, ticker, affected): rows to compute again, and the rows before them that these need.

    ``dates`` are the keys of all bars, the changed ones included. A row is affected if it or one of
    the ``lookback`` rows of its ticker before it has changed; each affected row comes with its
    ``lookback`` rows of past. Tickers without a change are left out before anything is sorted.
    """
    marked = changes.select(*KEY).withColumn("_changed", F.lit(1))
    tickers = changes.select("ticker").distinct()
    some = dates.select(*KEY).join(tickers, "ticker", "left_semi").join(marked, KEY, "left")
    order = Window.partitionBy("ticker").orderBy("date")
    hit = F.max("_changed").over(order.rowsBetween(-lookback, 0)).isNotNull()
    flagged = some.withColumn("affected", hit)
    ahead = F.max("affected").over(order.rowsBetween(0, lookback))
    return flagged.withColumn("_needed", ahead).filter("_needed").select(*KEY, "affected")


def upsert_bars(
    spark: SparkSession,
    bars_path: str,
    features_path: str,
    changes: DataFrame,
    params: FeatureParams = FeatureParams(),
) -> tuple[list[str], list[str]]:
    """Put late or corrected bars into the stored bars and bring the stored features up to date.

    Returns the months written in either table. Both are stored by month; bars are unique per
    (date, ticker). Features are computed again for rows within the lookback of a change only, from
    the months those rows and their past lie in; of all other bars two columns of the changed tickers
    are read. If the job fails half-way, it is repeated with the same ``changes``.
    """
    fresh = materialize(changes)
    months = upsert_months(spark, bars_path, fresh)
    if not months:
        return [], []
    bars = read_table(spark, bars_path)
    keys = materialize(affected_keys(bars, fresh, params.lookback))
    some = bars.filter(F.col(MONTH).isin(touched_months(keys))).join(keys.select(*KEY), KEY, "left_semi")
    again = compute_features(some, params).join(keys.filter("affected").select(*KEY), KEY, "left_semi")
    return months, upsert_months(spark, features_path, again)
