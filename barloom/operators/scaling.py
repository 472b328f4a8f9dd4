"""Feature vectors and standardisation fitted on the training rows only."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import one_row
from barloom.operators.split import TRAIN, part


def train_stats(df: DataFrame, names: list[str]) -> DataFrame:
    """Mean and sample standard deviation of each feature over the training rows, one row per feature."""
    wide = _wide_stats(df, names)
    cells = ", ".join(f"'{n}', `mean_{n}`, `std_{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {cells}) AS (feature, mean, std)")


def _wide_stats(df: DataFrame, names: list[str]) -> DataFrame:
    return part(df, TRAIN).agg(
        *[F.avg(n).alias(f"mean_{n}") for n in names], *[F.stddev(n).alias(f"std_{n}") for n in names]
    )


def scale_columns(df: DataFrame, names: list[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Standardise columns in place; a constant column becomes 0.0.

    The statistics come from the training rows of ``fitted_on`` (``df`` itself by default),
    in a pass of their own: stage a computed frame first.
    """
    stats = one_row(_wide_stats(fitted_on if fitted_on is not None else df, names))
    held = df.withColumn("_stats", stats)
    scaled = {
        n: F.when(
            F.col(n).isNotNull(),
            F.coalesce(
                F.try_divide(F.col(n) - F.col(f"_stats.mean_{n}"), F.col(f"_stats.std_{n}")), F.lit(0.0)
            ),
        )
        for n in names
    }
    return held.withColumns(scaled).drop("_stats")


def assemble(df: DataFrame, names: list[str], output: str = "features_raw") -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol=output).transform(df)


def fit_scaler(df: DataFrame) -> StandardScalerModel:
    """Fit on the training rows of a frame that carries ``features_raw``."""
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    return scaler.fit(part(df, TRAIN))


def feature_vectors(df: DataFrame, names: list[str]) -> tuple[DataFrame, StandardScalerModel]:
    assembled = assemble(df, names)
    model = fit_scaler(assembled)
    return model.transform(assembled), model
