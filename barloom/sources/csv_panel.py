"""One CSV file per entity, read as one panel in a single scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.quality import clean_casts, combine_panels
from barloom.schema import KEYS, Keys
from barloom.sources.tables import path_missing

FILE_STEM = r"([^/]+)\.csv$"


def read_text_panel(
    spark: SparkSession, path: str | list[str], entity_pattern: str | None = FILE_STEM, keys: Keys = KEYS
) -> DataFrame:
    """All ``*.csv`` files below ``path`` with every column as text, plus the entity.

    The entity is the upper-cased first group of ``entity_pattern`` in the file's path,
    by default the file stem; with None the files have it as a column, so their number need not grow with the entities. The first file's header gives the columns. Every other file
    is checked against it, so a file with another column order fails instead of mixing columns.
    """
    source = spark.read.option("header", True).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    try:
        columns = source.csv(path).columns
    except AnalysisException as error:
        if not path_missing(error):
            raise
        raise FileNotFoundError(f"no CSV files in {path}") from error
    if not columns:
        raise FileNotFoundError(f"no CSV files in {path}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if entity_pattern is None:
        return source.schema(text).option("enforceSchema", False).csv(path)
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return (
        source.schema(text)
        .option("enforceSchema", False)
        .csv(path)
        .select("*", entity_of(file, entity_pattern).alias(keys.entity))
    )


def entity_of(path: Column, pattern: str) -> Column:
    """The upper-cased first group of the pattern in a file's path."""
    return F.upper(F.regexp_extract(path, pattern, 1))


def read_panel(
    spark: SparkSession,
    path: str | list[str],
    entity_pattern: str | None = FILE_STEM,
    time_type: str = "timestamp",
    keys: Keys = KEYS,
) -> DataFrame:
    """The typed panel of a folder of CSV files with one header layout."""
    return clean_casts(read_text_panel(spark, path, entity_pattern, keys), keys.time, time_type)


def read_panels(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Folders or globs with different headers, combined by column name."""
    return combine_panels(*[read_panel(spark, p, **options) for p in paths])
