"""Panel tables cut into slices of time, for readers that want the newest bars of every entity.

``bars/slice=N`` holds the rows of one span of time, N growing with it; ``spans`` holds, for each slice and entity, the
number of rows and their first and last time. A slice counts once it stands in ``spans``, which is written last, so a
write that fails leaves the table as it was. Who needs the newest bars reads the narrow ``spans`` first and then opens
only the slices in which some entity still has bars among its newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.layout import clock
from barloom.schema import KEYS, Keys
from barloom.sources.staging import discard, write_shared
from barloom.sources.tables import read_table, table_exists

SLICE = "slice"
ROWS_PER_SLICE = 50_000_000
ROWS_PER_FILE = 2_000_000


def write_slices(df: DataFrame, path: str, keys: Keys = KEYS, rows_per_slice: int = ROWS_PER_SLICE, rows_per_file: int = ROWS_PER_FILE) -> list[int]:
    """Add rows to a sliced table, making it where there is none; returns the numbers of the new slices.

    The rows are cut at quantiles of time into slices of about ``rows_per_slice``. New slices follow the stored ones
    in number, whatever times they cover: late rows need no rewrite, since readers go by the spans. Rows without a time
    count as the oldest. An empty frame adds nothing.
    """
    spark = df.sparkSession
    ready, staged = write_shared(df, "slices")
    at = clock(ready, keys.time)
    rows = ready.count()
    if not rows:
        discard(spark, staged)
        return []
    n = -(-rows // rows_per_slice)
    cuts = ready.agg(F.percentile_approx(at, [k / n for k in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    first = (spans(spark, path).agg(F.max(SLICE)).first()[0] if table_exists(spark, f"{path}/spans") else 0) or 0
    later = [F.when(at > cut, 1).otherwise(0) for cut in cuts]
    number = F.lit(first + 1) + sum(later, F.lit(0))
    cut = ready.withColumn(SLICE, F.coalesce(number, F.lit(first + 1)).cast("int"))
    files = max(1, -(-rows // rows_per_file))
    order = [SLICE, *keys.pair]
    laid = cut.repartitionByRange(files, *order).sortWithinPartitions(*order)
    writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(SLICE).parquet(f"{path}/bars")
    time = clock(cut, keys.time)
    spanned = cut.groupBy(SLICE, keys.entity).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("low"), F.max(time).alias("high")
    )
    spanned.write.mode("append").parquet(f"{path}/spans")
    discard(spark, staged)
    return list(range(first + 1, first + 2 + len(cuts)))


def spans(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, f"{path}/spans")


def read_slices(spark: SparkSession, path: str, numbers: list[int] | None = None) -> DataFrame:
    """All rows of a sliced table, or those of some slices; files of other slices are not opened."""
    known = {r[0] for r in spans(spark, path).select(SLICE).distinct().collect()}
    return _bars(spark, path, sorted(known if numbers is None else known & set(numbers))).drop(SLICE)


def _bars(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """Rows of some slices with their number. Only these folders are listed, and the schema comes from their files."""
    if not numbers:
        return read_table(spark, f"{path}/bars").limit(0)
    return spark.read.option("basePath", f"{path}/bars").parquet(*[f"{path}/bars/{SLICE}={n}" for n in numbers])


def needed_spans(table: DataFrame, n: int, keys: Keys = KEYS) -> DataFrame:
    """The (slice, entity) pairs that hold some of the newest ``n`` bars of their entity.

    A pair can be left out when pairs of the same entity that begin after its end hold ``n`` bars already, so slices
    may overlap in time. Works on the spans alone: one row per slice and entity.
    """
    known = table.select(SLICE, keys.entity, "n", F.coalesce("low", F.lit(-(1 << 62))).alias("low"), F.coalesce("high", F.lit(-(1 << 62))).alias("high"))
    begins = known.select(keys.entity, F.col("low").alias("at"), F.lit(1).alias("kind"), "n", F.lit(None).cast("int").alias(SLICE))
    ends = known.select(keys.entity, F.col("high").alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("n"), SLICE)
    newest = Window.partitionBy(keys.entity).orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    return (
        begins.unionByName(ends)
        .withColumn("newer", F.sum("n").over(newest))
        .where(F.col(SLICE).isNotNull() & (F.col("newer") < n))
        .select(SLICE, keys.entity)
    )


def read_newest(spark: SparkSession, path: str, n: int, keys: Keys = KEYS) -> DataFrame:
    """At least the newest ``n`` bars of every entity, and no slice in which no entity has one of them.

    Rows of an entity in a slice it does not need are dropped while reading, so an old slice that one rarely traded
    entity needs costs a scan of that slice's files, not a shuffle of its rows.
    """
    pairs, staged = write_shared(needed_spans(spans(spark, path), n, keys), "needed")
    numbers = sorted(r[0] for r in pairs.select(SLICE).distinct().collect())
    bars = _bars(spark, path, numbers)
    same = (bars[SLICE] == pairs[SLICE]) & bars[keys.entity].eqNullSafe(pairs[keys.entity])
    return bars.join(pairs, same, "left_semi").drop(SLICE)
