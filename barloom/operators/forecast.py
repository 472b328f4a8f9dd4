"""From scored rows to next-bar price predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import change
from barloom.operators.split import latest_one
from barloom.schema import KEYS, Keys


def run_stamp(at: Column | None = None) -> Column:
    """A time, by default that of processing, as ``yyyyMMdd_HHmmss``."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd_HHmmss")


def predict_price(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """Scored rows as prediction records: current price, predicted return and price."""
    return df.select(
        keys.entity,
        F.col(keys.time).alias("current_date"),
        F.col("Close").alias("current_price"),
        F.col("prediction").alias("predicted_return"),
        (F.col("Close") * (1 + F.col("prediction"))).alias("predicted_price"),
    )


def latest_predictions(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """The newest prediction record of each entity."""
    return latest_one(predict_price(df, keys), Keys(keys.entity, "current_date"))


def with_direction(predictions: DataFrame) -> DataFrame:
    """Add the relative predicted change and its direction: up, down or flat."""
    moved = predictions.withColumn(
        "predicted_change", change(F.col("predicted_price"), F.col("current_price"))
    )
    sign = F.col("predicted_change")
    return moved.withColumn("direction", F.when(sign > 0, "up").when(sign < 0, "down").otherwise("flat"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    value = F.col("predicted_return")
    return predictions.agg(
        F.avg(value).alias("avg_return"),
        F.max(value).alias("max_return"),
        F.min(value).alias("min_return"),
        F.count_if(value > 0).alias("n_bullish"),
        F.count_if(value < 0).alias("n_bearish"),
    )
