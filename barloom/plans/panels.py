"""Panels derived from the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.layout import ROWS_PER_TASK, Layout, measure

_measured: dict[tuple, Layout] = {}
_heaviest: dict[tuple, int] = {}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their supplier as text, dealt by it, so that bars and the windows over them need no other exchange.

    Where one supplier has more rows than a task takes, they stay as they lie and the grouping combines them first.
    """
    items = load(spark, folder, "lineitem")
    key = (spark.sparkContext.applicationId, hash(tuple(sorted(items.inputFiles()))))
    if key not in _heaviest:
        _heaviest[key] = items.groupBy("l_suppkey").count().agg(F.max("count")).first()[0] or 0
    named = items.withColumn("stock_symbol", F.col("l_suppkey").cast("string"))
    return named.repartition("stock_symbol") if _heaviest[key] <= ROWS_PER_TASK else named


def panel_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per supplier and ship date."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        _by_supplier(spark, folder)
        .groupBy("stock_symbol", "l_shipdate")
        .agg(
            (20000 + F.min(price)).alias("Low"),
            (20000 + F.max(price)).alias("High"),
            (20000 + F.avg(price)).alias("Close"),
            F.sum("l_quantity").alias("Volume"),
            F.when(F.count(F.lit(1)) > 1, 1).otherwise(0).alias("News_flag"),
            F.avg("l_discount").alias("_discount"),
        )
        .select(
            "stock_symbol",
            F.col("l_shipdate").alias("Date"),
            F.col("Low").alias("Open"),
            "High",
            "Low",
            "Close",
            F.col("Close").alias("Adj_Close"),
            "Volume",
            "News_flag",
            (50 * F.col("_discount")).alias("Sentiment_gpt"),
            (10 * F.col("_discount")).alias("Scaled_sentiment"),
        )
    )


def _sentiment() -> Column:
    return F.get_json_object("props", "$.k").try_cast("double")


def panel_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per event type and hour."""
    hour = F.expr("ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts))")
    return (
        load(spark, folder, "events")
        .withColumns({"_hour": hour, "_k": _sentiment()})
        .groupBy("event_type", "_hour")
        .agg(
            (100 + F.min_by("value", "ts")).alias("Open"),
            (100 + F.max("value")).alias("High"),
            (100 + F.min("value")).alias("Low"),
            (100 + F.max_by("value", "ts")).alias("Close"),
            F.count(F.lit(1)).cast("double").alias("Volume"),
            F.avg("_k").alias("_k"),
        )
        .select(
            F.col("event_type").alias("stock_symbol"),
            F.col("_hour").alias("Date"),
            "Open",
            "High",
            "Low",
            "Close",
            F.col("Close").alias("Adj_Close"),
            "Volume",
            F.when(F.col("Volume") > 1, 1).otherwise(0).alias("News_flag"),
            (F.col("_k") / 19).alias("Sentiment_gpt"),
            (F.col("_k") / 97).alias("Scaled_sentiment"),
        )
    )


def panel_edge(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per event: zero volumes, zero prices and wild moves."""
    value = F.col("value")
    return load(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("stock_symbol"),
        F.col("ts").alias("Date"),
        value.alias("Open"),
        (value * 1.01).alias("High"),
        (value * 0.99).alias("Low"),
        value.alias("Close"),
        value.alias("Adj_Close"),
        _sentiment().alias("Volume"),
        F.lit(1).alias("News_flag"),
        (_sentiment() / 19).alias("Sentiment_gpt"),
        (_sentiment() / 97).alias("Scaled_sentiment"),
    )


def raw_text(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an untyped upload: all columns text, several of them not castable."""
    text = {
        "Date": F.when(F.col("value") > 100, F.col("event_type")).otherwise(F.col("ts").cast("string")),
        "Open": F.col("props"),
        "High": (F.col("value") * 2).cast("string"),
        "Low": F.col("value").cast("string"),
        "Close": F.col("value").cast("string"),
        "Adj close": F.when(F.col("event_type") != "view", F.col("value").cast("string")).otherwise("n/a"),
        "Volume": F.get_json_object("props", "$.k"),
        "News_flag": F.when(F.col("event_type") == "error", "yes").otherwise(F.col("event_id").cast("string")),
        "Scaled_sentiment": F.get_json_object("props", "$.k"),
    }
    return load(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("stock_symbol"),
        "event_id",
        *[c.alias(n) for n, c in text.items()],
    )


PANELS = {"panel_daily": panel_daily, "panel_hourly": panel_hourly, "panel_edge": panel_edge}
SOURCES = {"panel_daily": "lineitem", "panel_hourly": "events", "panel_edge": "events"}


def layout_of(spark: SparkSession, folder: str, panel: str, rows_per_task: int = ROWS_PER_TASK) -> Layout:
    """The panel's layout, measured once for the files of its source table as they are now."""
    files = tuple(sorted(load(spark, folder, SOURCES[panel]).inputFiles()))
    key = (spark.sparkContext.applicationId, panel, rows_per_task, hash(files))
    if key not in _measured:
        _measured[key] = measure(PANELS[panel](spark, folder), rows_per_task=rows_per_task)
    return _measured[key]
