"""CSV folder to validated panel table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.layout import measure
from barloom.operators.quality import validate
from barloom.schema import KEYS, Keys
from barloom.sources.csv_panel import FILE_STEM, entity_of, read_panel
from barloom.sources.staging import discard, write_shared
from barloom.sources.tables import path_missing, read_table, replace_table, table_exists, write_panel

BUCKET = "bucket"


def ingest(
    spark: SparkSession,
    csv_folder: str,
    table: str,
    entity_pattern: str | None = FILE_STEM,
    time_type: str = "timestamp",
    keys: Keys = KEYS,
) -> DataFrame:
    """Read, type and validate a folder of CSV files and overwrite the panel table.

    The text is parsed once: typed rows are staged, measured and validated from there.
    """
    panel, staged = write_shared(read_panel(spark, csv_folder, entity_pattern, time_type, keys), "typed")
    layout = measure(panel, keys)
    write_panel(validate(panel, layout, keys), table, keys)
    discard(spark, staged)
    return read_table(spark, table)


def ingest_if_missing(spark: SparkSession, csv_folder: str, table: str, **options) -> DataFrame:
    if table_exists(spark, table):
        return read_table(spark, table)
    return ingest(spark, csv_folder, table, **options)


@dataclass
class Changes:
    """What an incremental ingest did: the files it parsed, and the entities whose rows it replaced."""

    files: list[str]
    entities: int
    panel: DataFrame


def ingest_changed(
    spark: SparkSession,
    csv_folder: str,
    table: str,
    entity_pattern: str = FILE_STEM,
    time_type: str = "timestamp",
    buckets: int = 64,
    keys: Keys = KEYS,
) -> Changes:
    """Bring a panel table up to date with a folder: only entities with new, changed or removed files are parsed again.

    A ledger keeps path, length and change time of every file. ``<table>/bars`` lies in ``buckets`` folders by hash of
    the entity; only folders that hold a touched entity are rewritten, with the stored rows of their other entities.
    Validation works entity by entity, so the result is that of a full ingest. The ledger is written last: a call that
    fails is made up for by the next one. Once all files are gone the table is empty and has no schema of its own.
    """
    now = _listing(spark, csv_folder)
    ledger = f"{table}/files"
    old = read_table(spark, ledger) if table_exists(spark, ledger) else now.limit(0)
    entity = entity_of(F.col("path"), entity_pattern).alias(keys.entity)
    fresh = now.join(old, ["path", "length", "modified"], "left_anti").select(entity)
    gone = old.join(now, ["path"], "left_anti").select(entity)
    touched, touched_path = write_shared(fresh.unionByName(gone).distinct(), "touched")
    files = [r.path for r in now.select("path", entity).join(touched, keys.entity, "left_semi").select("path").collect()]
    entities = touched.count()
    schema = None
    if entities:
        schema = _rewrite(spark, table, touched, files, entity_pattern, time_type, buckets, keys)
        replace_table(now.select("path", "length", "modified"), ledger)
    discard(spark, touched_path)
    if schema and not table_exists(spark, f"{table}/bars"):
        return Changes(files, entities, spark.createDataFrame([], schema).drop(BUCKET))
    return Changes(files, entities, read_ingested(spark, table))


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, f"{table}/bars").drop(BUCKET)


def _rewrite(
    spark: SparkSession, table: str, touched: DataFrame, files: list[str], entity_pattern: str, time_type: str, buckets: int, keys: Keys
) -> T.StructType | None:
    bucket = _bucket(F.col(keys.entity), buckets)
    hit = [r[0] for r in touched.select(bucket).distinct().collect()]
    bars, staged, schema = f"{table}/bars", [], None
    parts = []
    if table_exists(spark, bars):
        stored = read_table(spark, bars).where(F.col(BUCKET).isin(hit))
        parts.append(stored.join(touched, keys.entity, "left_anti"))
    if files:
        panel, typed = write_shared(read_panel(spark, files, entity_pattern, time_type, keys), "typed")
        staged.append(typed)
        parts.append(validate(panel, measure(panel, keys), keys).withColumn(BUCKET, bucket))
    if parts:
        whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        ready, path = write_shared(whole, "bars")
        staged.append(path)
        schema = ready.schema
        laid = ready.repartitionByRange(BUCKET, *keys.pair).sortWithinPartitions(BUCKET, *keys.pair)
        laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(bars)
        filled = {r[0] for r in ready.select(BUCKET).distinct().collect()}
        for empty in set(hit) - filled:
            discard(spark, f"{bars}/{BUCKET}={empty}")
    for path in staged:
        discard(spark, path)
    return schema


def _bucket(entity: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int").alias(BUCKET)


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and change time of all CSV files below a folder; their content is not read."""
    source = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    try:
        found = source.load(folder)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        raise FileNotFoundError(f"no folder {folder}") from error
    return found.select("path", "length", F.col("modificationTime").alias("modified"))
