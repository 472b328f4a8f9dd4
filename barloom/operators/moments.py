"""Counts, means and spreads that can be stored per part of a panel and merged exactly.

A part, such as a slice of time, keeps for each column its count, mean, sum of squared gaps from the mean, least and
greatest value. Merging moves every part's mean to the common one, so figures of any set of parts equal those of all
their rows, and a refit over new bars reads the new bars and the small table, not the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ["n", "mean", "m2", "low", "high"]


def moments(df: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """One row per part (``by`` columns) and column: by, feature, n, mean, m2, low, high. NULLs are not counted.

    One aggregation with map-side combine, whatever the number of columns. A part in which a column has no value has
    n = 0 and NULL figures; without ``by`` an empty frame gives such rows, with ``by`` none.
    """
    by = by or []
    figures = []
    for i, name in enumerate(names):
        x = F.col(name).cast("double")
        cells = (F.count(x), F.avg(x), F.var_pop(x) * F.count(x), F.min(x), F.max(x))
        figures += [c.alias(f"{kind}_{i}") for c, kind in zip(cells, COLUMNS)]
    wide = df.groupBy(*by).agg(*figures)
    cells = ", ".join(f"'{name}', " + ", ".join(f"{kind}_{i}" for kind in COLUMNS) for i, name in enumerate(names))
    kept = [f"`{c}`" for c in by]
    return wide.selectExpr(*kept, f"stack({len(names)}, {cells}) AS (feature, {', '.join(COLUMNS)})")


def merge(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The moments of all parts of each feature, and of each value of ``by``, together."""
    group = [*(by or []), "feature"]
    whole = Window.partitionBy(*group)
    rows = F.sum("n").over(whole)
    centre = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), rows)
    placed = parts.withColumn("_centre", centre)
    moved = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_centre")) ** 2
    return placed.groupBy(*group).agg(
        F.sum("n").alias("n"), F.first("_centre", True).alias("mean"), F.sum(moved).alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )


def deviation(sample: bool = True) -> Column:
    """Standard deviation from merged moments, of a sample by default; NULL for fewer rows than it needs."""
    return F.sqrt(F.try_divide(F.col("m2"), F.col("n") - (1 if sample else 0)))


def stats(merged: DataFrame) -> DataFrame:
    """Columns feature, mean and std (of a sample), as a scaler needs them."""
    return merged.select("feature", "mean", deviation().alias("std"))


def describe(merged: DataFrame) -> DataFrame:
    """Columns feature, count, mean, stddev, min, max."""
    return merged.select(
        "feature", F.col("n").alias("count"), "mean", deviation().alias("stddev"),
        F.col("low").alias("min"), F.col("high").alias("max"),
    )


def scale_by(df: DataFrame, names: list[str], table: DataFrame) -> DataFrame:
    """Standardise columns by a table of ``stats``; a constant column becomes 0.0, a NULL stays.

    The table has one row per feature and is read through a scalar subquery, so it takes no join.
    """
    held = df.withColumn("_stats", table.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std"))))).scalar())

    def scaled(name: str) -> Column:
        own = F.col("_stats")[name]
        return F.when(F.col(name).isNotNull(), F.coalesce(F.try_divide(F.col(name) - own["mean"], own["std"]), F.lit(0.0)))

    return held.withColumns({n: scaled(n) for n in names}).drop("_stats")
