"""Residual diagnostics of scored rows as plain tables, ready for any charting tool."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import one_row
from barloom.functions.layout import Layout
from barloom.operators.quantiles import exact_quantiles_of, quantile_column
from barloom.schema import KEYS, Keys

BINS = 50  # fixed values: chart resolution and tail probabilities
CURVE_POINTS = 100
QQ_PROBABILITIES = [k / 100 for k in range(1, 100)]
QUARTILES = [0.25, 0.5, 0.75]
TAILS = [0.025, 0.975]
WHISKER = 1.5


def residuals(df: DataFrame, actual: str = "target", predicted: str = "prediction") -> DataFrame:
    """Add ``residual`` = actual - predicted and ``abs_error``."""
    error = F.col(actual) - F.col(predicted)
    return df.withColumns({"residual": error, "abs_error": F.abs(error)})


def axis_bounds(df: DataFrame, actual: str = "target", predicted: str = "prediction") -> DataFrame:
    return df.agg(
        F.least(F.min(actual), F.min(predicted)).alias("lower"),
        F.greatest(F.max(actual), F.max(predicted)).alias("upper"),
    )


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins with edges, count and density; empty bins are listed too.

    The largest value belongs to the last bin. When all values are equal the range is
    widened by one half on both sides.
    """
    span = df.agg(F.min(value).alias("a"), F.max(value).alias("b"), F.count(value).alias("n"))
    flat = F.col("a") == F.col("b")
    edges = span.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
        "n",
    )
    at = F.floor(bins * (F.col(value) - F.col("_e.lo")) / (F.col("_e.hi") - F.col("_e.lo"))) + 1
    counted = (
        df.filter(F.col(value).isNotNull())
        .withColumn("_e", one_row(edges))
        .groupBy(F.least(at, F.lit(bins)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("found"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        edges.filter(F.col("n") > 0)
        .withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"),
            (F.col("lo") + F.col("bin") * width).alias("bin_end"),
            F.coalesce("found", F.lit(0)).cast("long").alias("n"),
            (F.coalesce("found", F.lit(0)) / (F.col("n") * width)).alias("density"),
        )
    )


def normal_overlay(df: DataFrame, value: str = "residual", points: int = CURVE_POINTS) -> DataFrame:
    """Normal density with the column's mean and sample deviation on an even grid over its range."""
    stats = df.agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mu"), F.stddev(value).alias("sd")
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    z = F.try_divide(F.col("x") - F.col("mu"), F.col("sd"))
    return (
        stats.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("lo") + F.col("point") * step)
        .select(
            "point",
            "x",
            F.try_divide(F.exp(-0.5 * z * z), F.col("sd") * math.sqrt(2 * math.pi)).alias("density"),
        )
    )


def qq_points(df: DataFrame, value: str = "residual", layout: Layout | None = None) -> DataFrame:
    """Sample quantiles against normal quantiles of the same probabilities."""
    quantiles = quantile_column(df, value, QQ_PROBABILITIES, layout)
    normal = NormalDist()
    grid = F.array(
        *[
            F.struct(F.lit(p).alias("probability"), F.lit(normal.inv_cdf(p)).alias("theoretical"))
            for p in QQ_PROBABILITIES
        ]
    )
    paired = quantiles.select(F.explode(F.arrays_zip(grid.alias("g"), F.col("q").alias("s"))).alias("z"))
    return paired.select("z.g.probability", "z.g.theoretical", F.col("z.s").alias("sample"))


def _box(entity: str, value: str) -> list[Column]:
    low, high = F.col("_q")[0], F.col("_q")[2]
    reach = WHISKER * (high - low)
    inside = (F.col(value) >= low - reach) & (F.col(value) <= high + reach)
    return [
        F.first("_q").alias("_q"),
        F.min(F.when(inside, F.col(value))).alias("lowest"),
        F.max(F.when(inside, F.col(value))).alias("highest"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(value).alias("n"),
    ]


def box_per_entity(
    df: DataFrame, value: str = "residual", layout: Layout | None = None, keys: Keys = KEYS
) -> DataFrame:
    """Quartiles, whiskers (extreme rows within 1.5 IQR) and outlier count per entity.

    Entities within the task limit get their quartiles from a window, so the second
    aggregation needs no further exchange. Over-long ones get them from
    ``exact_quantiles_of`` and a broadcast of those few rows.
    """
    rows = df.select(keys.entity, value).filter(F.col(value).isNotNull())
    hot = [name for name, _ in layout.cuts] if layout else []
    w = Window.partitionBy(keys.entity)
    label = F.col(keys.entity).cast("string")
    few = rows
    if hot:
        names = rows.sparkSession.createDataFrame([(h,) for h in hot], "_hot string")
        few = rows.join(F.broadcast(names), label.eqNullSafe(F.col("_hot")), "left_anti")
    boxed = few.withColumn("_q", F.percentile(value, QUARTILES).over(w))
    boxed = boxed.groupBy(keys.entity).agg(*_box(keys.entity, value))
    if hot:
        found = exact_quantiles_of(rows, value, QUARTILES, keys.entity, hot)
        table = rows.sparkSession.createDataFrame(list(found.items()), "_hot string, _q array<double>")
        many = rows.join(F.broadcast(table), label.eqNullSafe(F.col("_hot")))
        boxed = boxed.unionByName(many.groupBy(keys.entity).agg(*_box(keys.entity, value)))
    q = F.col("_q")
    return boxed.select(
        keys.entity,
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        F.least("lowest", q[0]).alias("whisker_low"),
        F.greatest("highest", q[2]).alias("whisker_high"),
        "n_outliers",
        "n",
    )


def residual_stats(df: DataFrame, value: str = "residual", layout: Layout | None = None) -> DataFrame:
    """Mean, deviation, range, bias-corrected skewness and excess kurtosis, central 95% interval."""
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    moments = df.agg(
        F.count(value).cast("double").alias("n"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.skewness(value).alias("g1"),
        F.kurtosis(value).alias("g2"),
    )
    tails = one_row(quantile_column(df, value, TAILS, layout))
    return moments.withColumn("_t", tails).select(
        "mean",
        "std",
        "min",
        "max",
        F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2).alias("skewness"),
        (F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
        F.col("_t.q")[0].alias("q025"),
        F.col("_t.q")[1].alias("q975"),
    )
