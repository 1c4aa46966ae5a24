"""Queries on time: streams of events and bars, as-of joins, overlapping spans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.catalog.queries import _features, query
from barwatch.operators.asof import asof_join
from barwatch.operators.intervals import interval_join, spells
from barwatch.operators.rules import rule_anomalies
from barwatch.session import materialize, new_folder
from barwatch.sources.panel import NARROW, WIDE, read_panel
from barwatch.streaming.features import stream_features
from barwatch.streaming.files import deliver_in_pieces, deliver_marker, drain, file_stream
from barwatch.streaming.windows import sessions, sliding, tumbling

# Parameters shared with the SQL of the oracle.
LATE_HOURS = 36
WEEK_ENDS = [dt.datetime(2024, 1, day) for day in (9, 17, 25)]
YEAR_ENDS = [dt.datetime(year, 1, 1) for year in (1997, 1999, 2001)]
EVENTS_OVER = dt.datetime(2024, 3, 1)
BARS_OVER = dt.date(2003, 1, 1)
# End of fixed values.


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _arriving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream of four pieces, in which errors arrive 36 hours late."""
    events = _events(spark, sf_dir)
    folder = new_folder(spark)
    late = F.when(F.col("event_type") == "error", F.make_dt_interval(hours=F.lit(LATE_HOURS))).otherwise(F.make_dt_interval())
    files = deliver_in_pieces(events, folder, F.col("ts") + late, WEEK_ENDS)
    deliver_marker(spark, folder, events.schema, "ts", EVENTS_OVER)
    return file_stream(spark, folder, events.schema, files)


def _drained(result: DataFrame) -> DataFrame:
    spark = result.sparkSession
    return drain(result, new_folder(spark), new_folder(spark)).table


def _counted() -> list[Column]:
    return [F.count("*").alias("events"), F.sum("value").alias("total"), F.max("value").alias("most")]


@query
def stream_tumbling(spark, sf_dir):
    """Events per type in windows of six hours."""
    return _drained(tumbling(_arriving_events(spark, sf_dir), "ts", "6 hours", ["event_type"], _counted(), "2 days"))


@query
def stream_sliding(spark, sf_dir):
    """Events per type in windows of a day that start every six hours."""
    return _drained(sliding(_arriving_events(spark, sf_dir), "ts", "24 hours", "6 hours", ["event_type"], _counted(), "2 days"))


@query
def stream_sessions(spark, sf_dir):
    """Runs of a user's events less than eight hours apart."""
    return _drained(sessions(_arriving_events(spark, sf_dir), "ts", "8 hours", ["user_id"], _counted(), "2 days"))


def _streamed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all bars, streamed as four pieces in which bars are up to three days late."""
    bars = materialize(read_panel(spark, sf_dir, WIDE))
    folder = new_folder(spark)
    late = F.date_add("date", F.pmod(F.xxhash64("ticker", "date"), F.lit(4)).cast("int"))
    files = deliver_in_pieces(bars, folder, late.cast("timestamp"), YEAR_ENDS)
    deliver_marker(spark, folder, bars.schema, "date", BARS_OVER)
    return stream_features(file_stream(spark, folder, bars.schema, files), "4 days")


@query
def stream_feature_rows(spark, sf_dir):
    return _drained(_streamed_features(spark, sf_dir))


@query
def stream_rule_flags(spark, sf_dir):
    """The rules are row-wise, so they follow the features within the stream."""
    return _drained(rule_anomalies(_streamed_features(spark, sf_dir)))


@query
def asof_event_view(spark, sf_dir):
    """Every purchase with the user's latest view before or at it."""
    events = _events(spark, sf_dir)
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    viewed = events.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.unix_micros("ts").alias("view_us"))
    return asof_join(bought, viewed, ["user_id"], "ts", "ts", ["view_us", "view_id"]).withColumn("ts", F.unix_micros("ts"))


@query
def asof_event_view_recent(spark, sf_dir):
    """Every purchase with the user's latest view in the six hours before it."""
    events = _events(spark, sf_dir)
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = events.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    within = F.make_dt_interval(hours=F.lit(6))
    return asof_join(bought, viewed, ["user_id"], "ts", "ts", ["view_id"], within=within).drop("ts")


def _items(spark: SparkSession, sf_dir: str, ticker: Column) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.select("l_orderkey", "l_linenumber", "l_quantity", ticker.alias("ticker"), F.col("l_shipdate").cast("date").alias("date"))


@query
def asof_item_bar(spark, sf_dir):
    """Every line item with its ticker's last bar before the day it was shipped."""
    items = _items(spark, sf_dir, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
    bars = read_panel(spark, sf_dir, WIDE).select("ticker", "date", F.col("date").cast("string").alias("bar_date"), F.col("close").alias("bar_close"))
    return asof_join(items, bars, ["ticker"], "date", "date", ["bar_date", "bar_close"], inclusive=False)


@query
def asof_item_bar_sliced(spark, sf_dir):
    """The same for the few tickers that hold all items, with their time cut into slices of about 1,000 rows."""
    items = _items(spark, sf_dir, F.concat("l_returnflag", "l_linestatus"))
    bars = read_panel(spark, sf_dir, NARROW).select("ticker", "date", F.col("date").cast("string").alias("bar_date"), F.col("close").alias("bar_close"))
    return asof_join(items, bars, ["ticker"], "date", "date", ["bar_date", "bar_close"], inclusive=False, slice_rows=1000)


@query
def spell_overlaps(spark, sf_dir):
    """Spells of rule anomalies with the spells of heavy volume of the same ticker that they overlap."""
    features = materialize(_features(spark, sf_dir))
    odd = spells(rule_anomalies(features), ["ticker"], "date", 10).withColumnRenamed("rows", "flags")
    heavy = spells(features.filter("vol_z > 0.5"), ["ticker"], "date", 30)
    heavy = heavy.select("ticker", F.col("first_date").alias("heavy_first_date"), F.col("last_date").alias("heavy_last_date"), F.col("rows").alias("heavy_rows"))
    return interval_join(odd, heavy, ["ticker"], ("first_date", "last_date"), ("heavy_first_date", "heavy_last_date"))


@query
def spell_open_orders(spark, sf_dir):
    """For each spell of rule anomalies the orders under way in it: ordered before its end, shipped after its start."""
    odd = spells(rule_anomalies(_features(spark, sf_dir)), ["ticker"], "date", 10)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("ordered"))
    items = _items(spark, sf_dir, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).join(orders, "l_orderkey")
    spans = items.select("ticker", "l_quantity", F.least("ordered", "date").alias("begin"), F.greatest("ordered", "date").alias("end"))
    met = interval_join(odd, spans, ["ticker"], ("first_date", "last_date"), ("begin", "end"))
    return met.groupBy("ticker", "first_date", "last_date", "rows").agg(F.count("*").alias("items"), F.sum("l_quantity").alias("quantity"))
