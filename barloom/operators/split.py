"""Time split and newest rows per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.layout import Layout, with_position
from barloom.schema import KEYS, Keys

TRAIN, TEST = "train", "test"
PLACE, PLACES = "place", "places"


def time_split(
    df: DataFrame, ratio: float = 0.85, layout: Layout | None = None, keys: Keys = KEYS
) -> DataFrame:
    """Label the first ``floor(n * ratio)`` rows of each entity ``train``, the rest ``test``."""
    placed = with_position(df, layout, keys)
    label = F.when(F.col("_pos") <= F.floor(F.col("_size") * F.lit(ratio)), TRAIN).otherwise(TEST)
    return placed.withColumn("split", label).drop("_pos", "_size")


def placed_split(df: DataFrame, ratio: float = 0.85, layout: Layout | None = None, keys: Keys = KEYS) -> DataFrame:
    """``time_split`` with each row's position in its entity's rows of the same label, and their number."""
    placed = with_position(df, layout, keys)
    early = F.floor(F.col("_size") * F.lit(ratio))
    first = F.col("_pos") <= early
    return placed.select(
        *df.columns,
        F.when(first, TRAIN).otherwise(TEST).alias("split"),
        F.when(first, F.col("_pos")).otherwise(F.col("_pos") - early).cast("int").alias(PLACE),
        F.when(first, early).otherwise(F.col("_size") - early).cast("int").alias(PLACES),
    )


def split_sizes(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return df.groupBy(keys.entity, "split").agg(F.count(F.lit(1)).alias("n"))


def part(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col("split") == label)


def latest_n(df: DataFrame, n: int, keys: Keys = KEYS, rank: str | None = None) -> DataFrame:
    """The newest ``n`` rows of each entity, with their rank in a column where ``rank`` names one.

    The rank filter becomes a window group limit, so each task ships at most ``n`` rows per entity.
    """
    newest = Window.partitionBy(keys.entity).orderBy(F.col(keys.time).desc(), *keys.tie_order(descending=True))
    placed = df.withColumn(rank or "_rank", F.row_number().over(newest)).filter(F.col(rank or "_rank") <= n)
    return placed if rank else placed.drop("_rank")


def latest_one(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """The newest row of each entity, as an aggregate with map-side combine.

    A task sorts its rows by entity first, since whole rows do not fit a hash aggregate; it ships one row per entity.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(keys.time, *keys.ties)).alias("_row")
    return df.groupBy(keys.entity).agg(row).select("_row.*")
