"""Folders shared by all executors, and tables staged there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one on the default file system.

    A default file system of ``file:`` is shared by all tasks only in a local session; elsewhere this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    default = context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if default.startswith("file:"):
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return f"file:///tmp/barloom-{context.applicationId}"
    return f"{default.rstrip('/')}/tmp/barloom-{context.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run under the shared folder; it goes when the application ends."""
    path = f"{shared_folder(spark)}/barloom/{name}-{uuid.uuid4().hex}"
    _at_exit(spark, path)
    return path


def _at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path of ``work_path`` that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_shared(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """Compute once into a Parquet table of the shared folder; returns the table and its path.

    Unlike a checkpoint of rows the table is columnar, so later readers still prune columns, and a lost executor
    costs no recomputation.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage_table(df: DataFrame) -> DataFrame:
    """Compute once and continue from a Parquet table of the shared folder."""
    return write_shared(df, "staged")[0]


def stage_buckets(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Compute once into a table of one file a bucket of ``column``, and read it one bucket a task.

    Deal the rows by ``repartition(buckets, column)`` before: their order is then kept, and the partitions of the
    result are the same in every session. Only a table of the catalog keeps its buckets; its entry goes at once, its
    files when the application ends. Spark would read buckets only under a join or a group by ``column``: for the
    session this is turned off, which changes the tasks of a scan and no result.
    """
    spark, name = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{work_path(spark, 'buckets')}/table")
    writer.bucketBy(buckets, column).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def keep_checkpoints(spark: SparkSession) -> None:
    """Set the checkpoint folder, where none is, to one below the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "checkpoints"))


def stage(df: DataFrame) -> DataFrame:
    """Compute once and continue from a reliable checkpoint, which survives lost executors.

    A checkpoint keeps partitions and the order in them, which a table does not: use it where these matter, and
    ``stage_table`` elsewhere. Select the needed columns first: the checkpoint holds everything in the frame.
    """
    keep_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
