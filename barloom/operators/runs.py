"""Run bookkeeping as one long table: (run_id, started_at, kind, key, value, text)."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.operators.metrics import metric_rows
from barloom.schema import KEYS, RUNS, Keys

METRIC_COLUMNS = ["mae", "mse", "rmse", "r2", "sample_count"]


def _stamped(rows: DataFrame, run_id: str, started_at: datetime, kind: str) -> DataFrame:
    typed = rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(kind).alias("kind"),
        "key",
        F.col("value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"),
    )
    return typed


def log_params(spark: SparkSession, run_id: str, started_at: datetime, params: dict, kind: str = "param") -> DataFrame:
    """Parameters or single figures of a run; numbers go to ``value``, everything else to ``text``."""
    rows = []
    for key, value in params.items():
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        rows.append(
            (run_id, started_at, kind, key, float(value) if number else None, None if number else str(value))
        )
    return spark.createDataFrame(rows, RUNS)


def log_metrics(table: DataFrame, run_id: str, started_at: datetime, prefix: str) -> DataFrame:
    """A one-row metric table as ``<prefix>_<metric>`` rows."""
    wide = table.select([F.col(c).cast("double").alias(c) for c in METRIC_COLUMNS if c in table.columns])
    long = metric_rows(wide.withColumn("_prefix", F.lit(prefix)), ["_prefix"], METRIC_COLUMNS)
    return _stamped(
        long.select(F.concat_ws("_", "_prefix", "metric").alias("key"), "value"), run_id, started_at, "metric"
    )


def log_entity_metrics(table: DataFrame, run_id: str, started_at: datetime, keys: Keys = KEYS) -> DataFrame:
    """Per-entity metrics as ``<entity>_<metric>`` rows."""
    present = [c for c in METRIC_COLUMNS if c in table.columns]
    wide = table.select(
        F.col(keys.entity).cast("string").alias("_entity"), *[F.col(c).cast("double").alias(c) for c in present]
    )
    long = metric_rows(wide, ["_entity"], METRIC_COLUMNS)
    return _stamped(
        long.select(F.concat_ws("_", "_entity", "metric").alias("key"), "value"), run_id, started_at, "metric"
    )


def log_importance(table: DataFrame, run_id: str, started_at: datetime, top: int = 10) -> DataFrame:
    rows = table.filter(F.col("rank") <= top).select(
        F.concat(F.lit("importance_"), "feature").alias("key"), F.col("importance").alias("value")
    )
    return _stamped(rows, run_id, started_at, "metric")


def model_versions(runs: DataFrame) -> DataFrame:
    """Registered models of a runs table, one row per run, from its ``model`` rows."""
    return (
        runs.filter(F.col("kind") == "model")
        .groupBy("run_id", "started_at")
        .agg(
            F.max(F.when(F.col("key") == "name", F.col("text"))).alias("name"),
            F.max(F.when(F.col("key") == "stage", F.col("text"))).alias("stage"),
            F.max(F.when(F.col("key") == "version", F.col("value"))).alias("version"),
            F.max(F.when(F.col("key") == "path", F.col("text"))).alias("path"),
        )
    )


def claim_version(spark: SparkSession, folder: str, name: str, known: int = 0) -> int:
    """The next version of a model, claimed so that no other run gets it: the first number above ``known`` whose
    claim file this call creates.

    A claim is a file that must not exist before. The create is atomic on local disks and on HDFS; an object store
    without a conditional create gives no such promise. A claimed version stays taken when its run fails.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(f"{folder}/claims/{quote(name, safe='')}")
    files = where.getFileSystem(conf)
    files.mkdirs(where)
    taken = [int(s.getPath().getName()) for s in files.listStatus(where)]
    version = max([known, *taken]) + 1
    while not _created(jvm, files, jvm.org.apache.hadoop.fs.Path(where, str(version))):
        version += 1
    return version


def _created(jvm, files, path) -> bool:
    """Create a file that must not exist yet; Hadoop's local file system checks and creates in two steps, Java's in one."""
    try:
        if files.getUri().getScheme() == "file":
            file = jvm.java.io.File(files.makeQualified(path).toUri().getPath())
            return bool(file.createNewFile())
        files.create(path, False).close()
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getSimpleName():
            return False
        raise


def select_latest_run(
    versions: DataFrame, by: list[str] | None = None, name: str | None = None
) -> DataFrame:
    """The run to use: the highest version in production, else the highest without a stage, else the latest start.

    So a staged or archived version is used only where nothing else is registered, whatever its number.
    ``by`` picks one per group instead of one overall, ``name`` looks at one model only.
    """
    if name is not None:
        versions = versions.filter(F.col("name") == name)
    stage = F.coalesce("stage", F.lit("None"))
    place = F.when(stage == "Production", 2).when(stage == "None", 1).otherwise(0)
    order = [
        place.desc(),
        F.when(place > 0, F.col("version")).desc_nulls_last(),
        F.col("started_at").desc(),
        F.col("run_id"),
    ]
    if not by:
        return versions.orderBy(*order).limit(1)
    first = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return versions.withColumn("_rank", first).filter(F.col("_rank") == 1).drop("_rank")
