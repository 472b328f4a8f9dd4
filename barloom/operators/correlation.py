"""Feature correlation in long form and greedy pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A spread below this share of the raw second moment is rounding, not variation.
FLAT = 1e-13
PARTIAL_SUMS = 16
SCHEMA = "i int, j int, feature_a string, feature_b string, r double"


def correlation(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson correlation of every pair of features; expects frames without NULLs.

    The rows are reduced to one k x k matrix by tree aggregation. Only that matrix,
    whose size depends on the number of features alone, reaches the driver. Means and
    products take a pass each: stage a computed frame first.
    """
    vectors = VectorAssembler(inputCols=names, outputCol="_v").transform(df).select("_v")
    matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
    cells = [
        (i, j, a, b, float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(cells, SCHEMA)


def pairwise_correlation(df: DataFrame, names: list[str]) -> DataFrame:
    """The same for columns that may hold NULLs: every pair i < j uses the rows where both are known.

    A row becomes the vector of its values (0 where NULL), its marks (1 where known) and its squares. The product of
    that matrix with itself holds, for every pair at once, the count, both sums, both sums of squares and the sum of
    products over the pair's own rows. Tasks add it up over whole batches and their sums are added in a second step; it
    has (3 k)^2 cells whatever the number of rows. Values are shifted by their column's mean and divided by its spread first, so that sums of
    large values do not swallow small differences. A pair with fewer than two rows, or one whose values do not vary
    over its rows, has a NULL correlation. An empty frame has NULLs only. Stage a computed frame first: it is read twice.
    """
    k = len(names)
    centred = df.select([F.col(n).cast("double").alias(n) for n in names])
    gram = _gram(centred, *_centre_and_spread(centred))
    x, m, q = (slice(at * k, (at + 1) * k) for at in range(3))
    n, sums, squares, products = gram[m, m], gram[x, m], gram[q, m], gram[x, x]
    with np.errstate(invalid="ignore", divide="ignore"):
        spreads = n * squares - sums**2
        spreads[spreads <= FLAT * np.maximum(n * squares, 1e-300)] = np.nan
        r = (n * products - sums * sums.T) / np.sqrt(spreads * spreads.T)
    r[n < 2] = np.nan
    cells = [
        (i, j, names[i], names[j], None if np.isnan(r[i, j]) else float(min(1.0, max(-1.0, r[i, j]))))
        for i in range(k)
        for j in range(i + 1, k)
    ]
    return df.sparkSession.createDataFrame(cells, SCHEMA)


def _helpers():
    """Functions for tasks, which get them by value: workers need not find this package."""

    def values(batch) -> tuple[np.ndarray, np.ndarray]:
        """One row a column: its values, 0 where NULL, and marks, 1 where known."""
        known = np.array([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
        return known, np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)

    def merged(parts) -> np.ndarray:
        """Counts, means and squared gaps from the mean (three rows) of all parts together."""
        n, mean, m2 = next(parts := iter(parts))
        with np.errstate(invalid="ignore"):
            for other, centre, gaps in parts:
                both = n + other
                gap, most = centre - mean, np.maximum(both, 1)
                mean, m2, n = mean + gap * other / most, m2 + gaps + gap * gap * n * other / most, both
        return np.array([n, mean, m2])

    return values, merged


def _centre_and_spread(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of each column, 0 and 1 where there is none; one pass, few rows to the driver."""
    k = len(df.columns)
    values_of, merged = _helpers()

    def moments(batches):
        def parts():
            yield np.zeros((3, k))
            for batch in batches:
                if not batch.num_rows:
                    continue
                known, marks = values_of(batch)
                with np.errstate(all="ignore"):
                    n = marks.sum(axis=1)
                    mean = known.sum(axis=1) / np.maximum(n, 1)
                    yield np.array([n, mean, (np.where(marks > 0, known - mean[:, None], 0.0) ** 2).sum(axis=1)])

        yield pa.RecordBatch.from_pydict({"cells": [merged(parts()).tobytes()]})

    def added(batches):
        cells = [np.zeros((3, k)), *(np.frombuffer(c.as_py()).reshape(3, k) for b in batches for c in b.column("cells"))]
        yield pa.RecordBatch.from_pydict({"cells": [merged(cells).tobytes()]})

    rows = df.mapInArrow(moments, "cells binary").repartition(PARTIAL_SUMS).mapInArrow(added, "cells binary").collect()
    n, mean, m2 = merged([np.zeros((3, k)), *(np.frombuffer(r.cells).reshape(3, k) for r in rows)])
    spread = np.sqrt(m2 / np.maximum(n, 1))
    return mean, np.where(spread == 0, 1.0, spread)


def _gram(df: DataFrame, shift: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Product with itself of the matrix of values, marks and squares; few partial sums reach the driver."""
    k = len(shift)
    values_of, _ = _helpers()
    low, scale = shift[:, None], spread[:, None]

    def products(batches):
        total = np.zeros((3 * k, 3 * k))
        for batch in batches:
            if not batch.num_rows:
                continue
            known, marks = values_of(batch)
            with np.errstate(all="ignore"):
                values = np.where(marks > 0, (known - low) / scale, 0.0)
                rows = np.concatenate([values, marks, values * values])
                total += rows @ rows.T
        yield pa.RecordBatch.from_pydict({"cells": [total.tobytes()]})

    def added(batches):
        total = np.zeros(9 * k * k)
        for batch in batches:
            for cells in batch.column("cells"):
                total += np.frombuffer(cells.as_py())
        yield pa.RecordBatch.from_pydict({"cells": [total.tobytes()]})

    parts = df.mapInArrow(products, "cells binary").repartition(PARTIAL_SUMS).mapInArrow(added, "cells binary")
    return sum((np.frombuffer(r.cells) for r in parts.collect()), np.zeros(9 * k * k)).reshape(3 * k, 3 * k)


def lower_triangle(corr: DataFrame) -> DataFrame:
    return corr.filter(F.col("i") > F.col("j"))


def prune_correlated(corr: DataFrame, threshold: float = 0.95) -> list[str]:
    """Features to keep: in name order, drop one whose |r| with an already kept one exceeds the threshold.

    Works on the k x k table only.
    """
    rows = corr.select("i", "j", "feature_a", "feature_b", "r").collect()
    names = dict(sorted({r.i: r.feature_a for r in rows}.items()))
    strong = {(r.i, r.j) for r in rows if abs(r.r) > threshold}
    kept: list[int] = []
    for j in names:
        if not any((i, j) in strong for i in kept):
            kept.append(j)
    return [names[i] for i in kept]


def prune_table(corr: DataFrame, threshold: float = 0.95) -> DataFrame:
    kept = prune_correlated(corr, threshold)
    return (
        corr.select(F.col("i").alias("position"), F.col("feature_a").alias("feature"))
        .distinct()
        .withColumn("kept", F.col("feature").isin(kept))
    )
