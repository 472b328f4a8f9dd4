"""Stored tables: overwrite, append, read, and CSV exports."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.quality import distribute
from barloom.schema import KEYS, Keys
from barloom.sources.staging import discard, write_shared


RUN_PART = "run_part"


def write_panel(df: DataFrame, path: str, keys: Keys = KEYS, partitions: int | None = None, format: str = "parquet") -> None:
    """Overwrite a panel table, whatever schema it had, with files ranged and sorted by (entity, time).

    Ranges split a long entity over several files, and file statistics let readers skip
    by entity or time without one folder per entity. A Parquet table is replaced whole or not at all.
    """
    laid = distribute(df, keys, partitions)
    if format == "parquet":
        return replace_table(laid, path)
    writer = laid.write.mode("overwrite").format(format)
    if format == "delta":
        writer = writer.option("overwriteSchema", True)
    writer.save(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table at ``path``, then swap by renaming.

    The old table can be read until the new one is whole, also by ``df`` itself; a write that fails leaves it as it
    was. Between the two renames nothing lies at ``path``; where the second one fails the old table is put back.
    """
    spark = df.sparkSession
    target, fresh, old = (_path(spark, f"{path.rstrip('/')}{tail}") for tail in ("", f".{uuid.uuid4().hex}.new", f".{uuid.uuid4().hex}.old"))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.mode("error").parquet(fresh.toString())
        stood = files.exists(target)
        if stood and not files.rename(target, old):
            raise OSError(f"cannot move {path} away")
        if not files.rename(fresh, target):
            if stood:
                files.rename(old, target)
            raise OSError(f"cannot move the new table to {path}")
    except BaseException:
        files.delete(fresh, True)
        raise
    if stood:
        files.delete(old, True)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def write_run(df: DataFrame, path: str, run_id: str, format: str = "parquet") -> bool:
    """Store one run's rows in a table of runs; the same run written again replaces its rows and no others.

    Each run has a partition of its own, named by ``RUN_PART``. An empty frame writes nothing and leaves what the run
    has stored. Says whether rows were written.
    """
    part = f"run_{run_id}"
    ready, staged = write_shared(df.withColumn(RUN_PART, F.lit(part)), "run")
    filled = not ready.isEmpty()
    if filled:
        writer = ready.write.mode("overwrite").format(format).partitionBy(RUN_PART)
        if format == "delta":
            writer = writer.option("replaceWhere", f"{RUN_PART} = '{part}'")
        else:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.save(path)
    discard(df.sparkSession, staged)
    return filled


def read_run(spark: SparkSession, path: str, run_id: str, format: str = "parquet") -> DataFrame:
    """The rows that ``write_run`` stored for one run; other runs' files are not opened."""
    return read_table(spark, path, format).where(F.col(RUN_PART) == f"run_{run_id}").drop(RUN_PART)


def write_append(df: DataFrame, path: str, format: str = "parquet") -> bool:
    """Append rows to a table; an empty frame writes nothing. Says whether rows were written.

    The frame is computed once, into a staged table that is then looked at and appended.
    """
    ready, staged = write_shared(df, "append")
    filled = not ready.isEmpty()
    if filled:
        ready.write.mode("append").format(format).save(path)
    discard(df.sparkSession, staged)
    return filled


def path_missing(error: AnalysisException) -> bool:
    """Whether reading failed because there is nothing at the path, and for no other reason."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_PATH_DOES_NOT_EXIST")


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    try:
        return spark.read.format(format).load(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        raise FileNotFoundError(f"no table at {path}") from error


def table_exists(spark: SparkSession, path: str, format: str = "parquet") -> bool:
    try:
        return bool(read_table(spark, path, format).columns)
    except FileNotFoundError:
        return False


def export_csv(df: DataFrame, folder: str, run_id: str, single_file: bool = False) -> str:
    """Write a result as CSV under ``folder/run_<id>``.

    ``single_file`` is for results of a few rows per entity at most; by default the
    table keeps its partitions.
    """
    path = f"{folder}/run_{run_id}"
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_run(folder: str, run_id: str, importance: DataFrame, per_entity: DataFrame, predictions: DataFrame, keys: Keys = KEYS) -> dict[str, str]:
    """The three result tables of a training run as CSV, each in the run's own folder."""
    test = predictions.select(
        keys.entity,
        F.col(keys.time).alias("date"),
        F.col("target").alias("true_value"),
        F.col("prediction").alias("predicted_value"),
    )
    return {
        "feature_importance": export_csv(importance, f"{folder}/feature_importance", run_id, single_file=True),
        "per_entity_metrics": export_csv(per_entity, f"{folder}/per_entity_metrics", run_id),
        "test_predictions": export_csv(test, f"{folder}/test_predictions", run_id),
    }
