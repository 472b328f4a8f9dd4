"""Casting, validation and summary of a panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import all_not_null, change
from barloom.functions.layout import Layout, over_history
from barloom.schema import CRITICAL_COLUMNS, DOUBLE_COLUMNS, INT_COLUMNS, KEYS, RENAMES, SUMMARY_COLUMNS, Keys

MAX_CHANGE = 0.5  # fixed value: largest accepted move between consecutive bars
RULES = ["null", "nan", "invalid", "outlier"]


def clean_casts(df: DataFrame, time: str = KEYS.time, time_type: str = "timestamp") -> DataFrame:
    """Rename and type the known columns; text that cannot be cast becomes NULL."""
    df = df.withColumnsRenamed({old: new for old, new in RENAMES.items() if old in df.columns})
    types = {time: time_type}
    types |= {c: "double" for c in DOUBLE_COLUMNS}
    types |= {c: "int" for c in INT_COLUMNS}
    return df.select(
        [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def with_entity(df: DataFrame, entity: str, name: str = KEYS.entity) -> DataFrame:
    """Label a frame that holds a single entity."""
    return df.withColumn(name, F.lit(entity.upper()))


def combine_panels(*panels: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), panels)


def distribute(df: DataFrame, keys: Keys = KEYS, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by (entity, time), splitting a long entity over several tasks."""
    shuffled = df.repartitionByRange(*([partitions] if partitions else []), keys.entity, keys.time)
    return shuffled.sortWithinPartitions(keys.entity, keys.time)


def _critical(df: DataFrame) -> list[str]:
    return [c for c in CRITICAL_COLUMNS if c in df.columns]


def drop_null_critical(df: DataFrame) -> DataFrame:
    return df.filter(all_not_null(_critical(df)))


def drop_nan(df: DataFrame) -> DataFrame:
    return df.filter(~_any_nan(df))


def drop_invalid_price(df: DataFrame) -> DataFrame:
    """Close above 0 and, where the panel has one, Volume not below 0."""
    return df.filter(~_invalid(df))


def _invalid(df: DataFrame) -> Column:
    bad = F.col("Close") <= 0
    return bad | (F.col("Volume") < 0) if "Volume" in df.columns else bad


def _any_nan(df: DataFrame) -> Column:
    numbers = [c for c in _critical(df) if c in DOUBLE_COLUMNS]
    return reduce(lambda a, b: a | b, [F.isnan(c) for c in numbers])


def _jump(window) -> Column:
    return F.abs(change(F.col("Close"), F.lag("Close").over(window)))


def drop_outliers(
    df: DataFrame, layout: Layout | None = None, keys: Keys = KEYS, limit: float = MAX_CHANGE
) -> DataFrame:
    """Drop bars that moved more than ``limit`` against the previous input bar.

    One pass: a bar after a spike is compared with the spike. First bars stay.
    """
    jumped = over_history(df, lambda d, w: d.withColumn("_jump", _jump(w)), back=1, layout=layout, keys=keys)
    return jumped.filter(F.col("_jump").isNull() | (F.col("_jump") <= limit)).drop("_jump")


def validate(
    df: DataFrame, layout: Layout | None = None, keys: Keys = KEYS, limit: float = MAX_CHANGE
) -> DataFrame:
    """All row rules, then the outlier rule on what is left."""
    return drop_outliers(drop_invalid_price(drop_nan(drop_null_critical(df))), layout, keys, limit)


def _row_rule(df: DataFrame) -> Column:
    return F.when(~all_not_null(_critical(df)), "null").when(_any_nan(df), "nan").when(_invalid(df), "invalid")


def _outliers(df: DataFrame, layout: Layout | None, keys: Keys, limit: float) -> DataFrame:
    """Accepted rows with ``rejected_by`` from the outlier rule."""
    jumped = over_history(df, lambda d, w: d.withColumn("_jump", _jump(w)), back=1, layout=layout, keys=keys)
    return jumped.withColumn("rejected_by", F.when(F.col("_jump") > limit, "outlier")).drop("_jump")


def flag_rows(
    df: DataFrame, layout: Layout | None = None, keys: Keys = KEYS, limit: float = MAX_CHANGE
) -> DataFrame:
    """Keep every row and name the first rule it breaks in ``rejected_by`` (NULL: accepted).

    Only rows that pass the row rules go through the window, as in ``validate``.
    """
    ruled = df.withColumn("rejected_by", _row_rule(df))
    accepted = ruled.filter(F.col("rejected_by").isNull()).drop("rejected_by")
    return _outliers(accepted, layout, keys, limit).unionByName(ruled.filter(F.col("rejected_by").isNotNull()))


def removed_counts(
    df: DataFrame, layout: Layout | None = None, keys: Keys = KEYS, limit: float = MAX_CHANGE
) -> DataFrame:
    """Rows in, rows removed by each rule and rows kept, per entity; rejected rows are only counted."""
    rejected = F.col("rejected_by")
    return (
        flag_rows(df, layout, keys, limit)
        .select(keys.entity, "rejected_by")
        .groupBy(keys.entity)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(rejected == r).alias(f"n_{r}") for r in RULES],
            F.count_if(rejected.isNotNull()).alias("n_removed"),
            F.count_if(rejected.isNull()).alias("n_kept"),
        )
    )


def rows_per_entity(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return df.groupBy(keys.entity).agg(F.count(F.lit(1)).alias("n"))


def date_range(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return df.agg(F.min(keys.time).alias("min_date"), F.max(keys.time).alias("max_date"))


def describe_panel(df: DataFrame, columns: list[str] = SUMMARY_COLUMNS) -> DataFrame:
    """count, mean, stddev, min and max, one row per statistic and one column per variable."""
    stats = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(*[fn(c).alias(f"{s}_{c}") for s, fn in stats.items() for c in columns])
    cells = ", ".join(f"'{s}', " + ", ".join(f"`{s}_{c}`" for c in columns) for s in stats)
    names = ", ".join(["statistic", *columns])
    return wide.selectExpr(f"stack({len(stats)}, {cells}) AS ({names})")


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_entities(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return df.select(keys.entity).distinct()


def count_entities(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    return df.agg(F.countDistinct(keys.entity).alias("n_entities"))
