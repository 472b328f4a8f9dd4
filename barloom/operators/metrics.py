"""Regression metrics of scored rows as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import one_row
from barloom.schema import KEYS, Keys

METRICS = ["mae", "mse", "rmse", "r2"]


def r_squared(actual: str, predicted: str) -> Column:
    """R2; with constant actuals 1.0 for a perfect fit and 0.0 otherwise; NULL below two rows."""
    error = F.sum((F.col(actual) - F.col(predicted)) * (F.col(actual) - F.col(predicted)))
    spread = F.var_pop(actual) * F.count(actual)
    return F.when(F.count(actual) < 2, F.lit(None).cast("double")).otherwise(
        F.when(spread == 0, F.when(error == 0, 1.0).otherwise(0.0)).otherwise(
            1 - F.try_divide(error, spread)
        )
    )


def _aggregates(actual: str, predicted: str) -> dict[str, Column]:
    error = F.col(actual) - F.col(predicted)
    return {
        "mae": F.avg(F.abs(error)),
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": r_squared(actual, predicted),
    }


def metrics(
    df: DataFrame, by: list[str] | None = None, actual: str = "target", predicted: str = "prediction"
) -> DataFrame:
    """mae, mse, rmse, r2 and sample_count, overall or per group."""
    aggs = [c.alias(n) for n, c in _aggregates(actual, predicted).items()]
    return df.groupBy(*(by or [])).agg(*aggs, F.count(F.lit(1)).alias("sample_count"))


def entity_metrics(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return metrics(df, [keys.entity]).drop("rmse")


def relative_to_best(table: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<metric>_ratio`` = value / largest value of that metric in the table."""
    tops = one_row(table.agg(*[F.max(c).alias(c) for c in columns]))
    return (
        table.withColumn("_top", tops)
        .withColumns({f"{c}_ratio": F.try_divide(F.col(c), F.col(f"_top.{c}")) for c in columns})
        .drop("_top")
    )


def metric_rows(table: DataFrame, keys: list[str], columns: list[str] = METRICS) -> DataFrame:
    """Wide metric table to long rows (key..., metric, value); absent metrics are skipped."""
    present = [c for c in columns if c in table.columns]
    return table.select(*keys, *present).unpivot(keys, present, "metric", "value")


def compare_models(rows: DataFrame) -> DataFrame:
    """Long (model, metric, value) rows to one row per model plus each metric's ratio to the largest."""
    wide = rows.groupBy("model").pivot("metric", METRICS).agg(F.first("value"))
    return relative_to_best(wide, METRICS)
