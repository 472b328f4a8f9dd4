"""Exact interpolated quantiles without collecting a large group in one task.

A group within the task limit uses the built-in exact percentile. Larger groups go
through three passes: an approximate sketch gives cut values around each wanted rank,
exact counts between the cuts say which interval holds the rank, and only the rows
inside those intervals are ordered. The sketch affects speed, never the result.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.layout import ROWS_PER_TASK, Layout

SKETCH_ACCURACY = 50_000
GRID = 64
_INTERVAL = "_interval"


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    accuracy: int = SKETCH_ACCURACY,
    rows_per_task: int = ROWS_PER_TASK,
) -> list[float] | None:
    """Quantiles of one column over the whole frame, or None when it has no values."""
    rows = df.select(F.col(value).alias("x")).filter(F.col("x").isNotNull())
    n, cuts = rows.agg(F.count(F.lit(1)), _sketch(probabilities, accuracy)).first()
    if not n:
        return None
    held = rows.withColumn("entity", F.lit("")).withColumn("cuts", F.array(*[F.lit(c) for c in dict.fromkeys(cuts)]))
    return _select_ranks(_placed(held), {"": n}, probabilities, rows_per_task)[""]


def exact_quantiles_of(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    entity: str,
    hot: list[str | None],
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str | None, list[float]]:
    """The same for each of the over-long entities in ``hot``, the NULL entity among them where it is listed."""
    spark = df.sparkSession
    # Names carry a mark in front, so that the empty string is free to stand for NULL in joins.
    wanted = F.broadcast(spark.createDataFrame([("" if h is None else f"={h}",) for h in hot], "entity string"))
    name = F.coalesce(F.concat(F.lit("="), F.col(entity).cast("string")), F.lit(""))
    rows = (
        df.select(name.alias("entity"), F.col(value).alias("x"))
        .filter(F.col("x").isNotNull())
        .join(wanted, "entity")
    )
    found = rows.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.array_distinct(_sketch(probabilities, accuracy))).alias("cuts")
    ).collect()
    if not found:
        return {}
    cuts = spark.createDataFrame([(r.entity, r.cuts) for r in found], "entity string, cuts array<double>")
    placed = _placed(rows.join(F.broadcast(cuts), "entity"))
    chosen = _select_ranks(placed, {r.entity: r.n for r in found}, probabilities)
    return {e[1:] if e else None: q for e, q in chosen.items()}


def _placed(rows: DataFrame) -> DataFrame:
    """Label rows with the number of cuts at or below them, in the order of the built-in: NaN above infinity."""
    return rows.withColumn(_INTERVAL, F.size(F.filter("cuts", lambda c: c <= F.col("x"))).cast("double")).drop("cuts")


def _between(a: float, b: float, weight: float) -> float:
    """Interpolation as the built-in percentile does it, so that infinities and NaN come out alike."""
    if weight == 0 or a == b or (math.isnan(a) and math.isnan(b)):
        return a
    return (1 - weight) * a + weight * b


def _sketch(probabilities: list[float], accuracy: int) -> Column:
    """Values just below and just above each probability, by twice the sketch's rank error."""
    margin = 2 / accuracy
    around = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)})
    return F.percentile_approx("x", around, accuracy)


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    at = p * (n - 1)
    low = math.floor(at)
    return low, min(low + 1, n - 1), at - low


def _targets(placed: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, float], tuple[int, list[tuple[int, int]]]]:
    """Intervals that hold a wanted rank: their size, and each rank with its place in the interval."""
    counts = defaultdict(list)
    for r in placed.groupBy("entity", _INTERVAL).count().collect():
        counts[r.entity].append((r[_INTERVAL], r["count"]))
    out = {}
    for entity, intervals in counts.items():
        before = 0
        for interval, n in sorted(intervals):
            inside = [(k, k - before) for k in wanted[entity] if before <= k < before + n]
            if inside:
                out[entity, interval] = (n, inside)
            before += n
    return out


def _narrowed(placed: DataFrame, heavy: list[tuple[str, float]], step: float) -> DataFrame:
    """Cut each of the given intervals at a sketch of its own; labels keep the order of the values."""
    keys = F.broadcast(placed.sparkSession.createDataFrame(heavy, f"entity string, {_INTERVAL} double"))
    grid = [k / GRID for k in range(1, GRID)]
    found = (
        placed.join(keys, ["entity", _INTERVAL])
        .groupBy("entity", _INTERVAL)
        .agg(F.array_distinct(F.percentile_approx("x", grid, 100 * GRID)).alias("cuts"))
        .collect()
    )
    cuts = placed.sparkSession.createDataFrame(
        [(r.entity, r[_INTERVAL], r.cuts) for r in found], f"entity string, {_INTERVAL} double, cuts array<double>"
    )
    inner = F.size(F.filter("cuts", lambda c: c <= F.col("x"))) * step
    return (
        placed.join(F.broadcast(cuts), ["entity", _INTERVAL], "left")
        .withColumn(_INTERVAL, F.col(_INTERVAL) + F.when(F.col("cuts").isNotNull(), inner).otherwise(0.0))
        .drop("cuts")
    )


def _select_ranks(
    placed: DataFrame, sizes: dict[str, int], probabilities: list[float], rows_per_task: int = ROWS_PER_TASK
) -> dict[str, list[float]]:
    """Read the order statistics next to each probability from rows labelled with intervals.

    An interval of more than ``rows_per_task`` rows is cut again until it fits, or until one value fills it.
    """
    spark = placed.sparkSession
    wanted = {e: sorted({k for p in probabilities for k in _ranks(n, p)[:2]}) for e, n in sizes.items()}
    targets = _targets(placed, wanted)
    step, done = 1.0, set()
    while heavy := [k for k, (n, _) in targets.items() if n > rows_per_task and (k, n) not in done]:
        done |= {(k, targets[k][0]) for k in heavy}
        step /= 2 * GRID
        placed = _narrowed(placed, heavy, step)
        targets = _targets(placed, wanted)
    rows = [(e, interval, k, local) for (e, interval), (_, inside) in targets.items() for k, local in inside]
    ranks = F.broadcast(spark.createDataFrame(rows, f"entity string, {_INTERVAL} double, rank long, local long"))
    w = Window.partitionBy("entity", _INTERVAL).orderBy("x")
    ordered = (
        placed.join(ranks.select("entity", _INTERVAL).distinct(), ["entity", _INTERVAL], "left_semi")
        .groupBy("entity", _INTERVAL, "x")
        .count()
        .withColumn("_through", F.sum("count").over(w))
    )
    hits = (
        ordered.join(ranks, ["entity", _INTERVAL])
        .filter((F.col("local") < F.col("_through")) & (F.col("local") >= F.col("_through") - F.col("count")))
        .select("entity", "rank", "x")
        .collect()
    )
    at = {(r.entity, r["rank"]): r.x for r in hits}
    return {
        e: [_between(at[e, low], at[e, high], weight) for low, high, weight in (_ranks(n, p) for p in probabilities)]
        for e, n in sizes.items()
    }


def quantile_column(
    df: DataFrame, value: str, probabilities: list[float], layout: Layout | None = None
) -> DataFrame:
    """One row (``q``: array) with the exact quantiles of a column over the whole frame."""
    if layout is not None and layout.fits_one_task:
        return df.agg(F.percentile(value, probabilities).alias("q"))
    limit = layout.rows_per_task if layout else ROWS_PER_TASK
    found = exact_quantiles(df, value, probabilities, rows_per_task=limit)
    return df.sparkSession.createDataFrame([(found,)], "q array<double>")
