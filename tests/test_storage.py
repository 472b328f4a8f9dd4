"""Tables: replaced whole, runs stored once, slices of time, claimed versions."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from barloom.operators import runs, split
from barloom.sources import slices, tables

SCHEMA = "stock_symbol string, Date timestamp, Close double"


def bars(spark, entities=6, n=60, start=0, seed=1):
    rng = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    rows = [(f"S{e}", day + dt.timedelta(days=start + i), rng.random()) for e in range(entities) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_panel(bars(spark), path)
    boom = F.when(F.col("Close") > 0.5, F.raise_error(F.lit("half-way"))).otherwise(F.col("Close"))
    with pytest.raises(Exception, match="half-way"):
        tables.write_panel(bars(spark).withColumn("Close", boom), path)
    assert same(tables.read_table(spark, path), bars(spark))
    assert os.listdir(tmp_path) == ["t"]


def test_a_table_can_replace_itself_with_another_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_panel(bars(spark), path)
    tables.write_panel(tables.read_table(spark, path).withColumn("twice", F.col("Close") * 2).where("Close < 0.5"), path)
    got = tables.read_table(spark, path)
    assert got.columns[-1] == "twice" and got.count() == bars(spark).where("Close < 0.5").count()
    assert os.listdir(tmp_path) == ["t"]


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = f"{tmp_path}/runs"
    for run_id, n in (("1", 3), ("1", 4), ("a/b=c", 5), ("1", 2)):
        assert tables.write_run(spark.range(n), path, run_id)
    assert tables.read_run(spark, path, "1").count() == 2 and tables.read_run(spark, path, "a/b=c").count() == 5
    assert not tables.write_run(spark.range(0), path, "1") and tables.read_table(spark, path).count() == 7
    assert not tables.write_run(spark.range(0), f"{tmp_path}/none", "1") and not tables.table_exists(spark, f"{tmp_path}/none")


def test_newest_bars_from_slices(spark, tmp_path):
    path, all_rows = f"{tmp_path}/s", bars(spark)
    numbers = slices.write_slices(all_rows, path, rows_per_slice=60)
    assert numbers == list(range(1, 7))
    got = slices.read_newest(spark, path, 7)
    assert same(split.latest_n(got, 7), split.latest_n(all_rows, 7))
    files = {f.split("slice=")[1].split("/")[0] for f in got.inputFiles() if "slice=" in f}
    assert files == {"6"}
    assert same(slices.read_slices(spark, path), all_rows)


def test_older_files_are_not_opened(spark, tmp_path):
    path, all_rows = f"{tmp_path}/s", bars(spark)
    slices.write_slices(all_rows, path, rows_per_slice=60)
    want = sorted(map(str, split.latest_n(all_rows, 12).collect()))
    for old in range(1, 5):
        for file in glob.glob(f"{path}/bars/slice={old}/*.parquet"):
            with open(file, "wb") as f:
                f.write(b"not a table")
    assert sorted(map(str, split.latest_n(slices.read_newest(spark, path, 12), 12).collect())) == want
    with pytest.raises(Exception):
        slices.read_slices(spark, path).collect()


def test_late_rare_and_overlapping_rows(spark, tmp_path):
    path = f"{tmp_path}/s"
    old = bars(spark, 3, 40)
    rare = spark.createDataFrame([("RARE", dt.datetime(2024, 1, 3), 0.1), (None, dt.datetime(2024, 1, 5), 0.2), (None, None, 0.3)], SCHEMA)
    first = old.unionByName(rare)
    late = bars(spark, 2, 25, start=20, seed=3).unionByName(spark.createDataFrame([("NEW", dt.datetime(2023, 1, 1), 0.5)], SCHEMA))
    slices.write_slices(first, path, rows_per_slice=30)
    slices.write_slices(late, path, rows_per_slice=20)
    assert slices.write_slices(late.limit(0), path) == []
    whole = first.unionByName(late)
    for n in (1, 5, 30, 1000):
        got = split.latest_n(slices.read_newest(spark, path, n), n)
        # Bars of equal time come from both writes, so only keys are compared.
        keys = lambda df: sorted(map(str, split.latest_n(df, n).select("stock_symbol", "Date").collect()))
        assert keys(got) == keys(whole)


def test_rows_that_never_reached_the_spans_do_not_count(spark, tmp_path):
    path = f"{tmp_path}/s"
    slices.write_slices(bars(spark, 2, 10), path)
    shutil.copytree(f"{path}/bars/slice=1", f"{path}/bars/slice=2")
    assert slices.read_slices(spark, path).count() == 20
    assert slices.write_slices(bars(spark, 1, 5, start=10), path) == [2]
    assert slices.read_slices(spark, path).count() == 25


def test_two_claims_get_two_versions(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: runs.claim_version(spark, str(tmp_path), "a/b"), range(16)))
    assert sorted(got) == list(range(1, 17))
    assert runs.claim_version(spark, str(tmp_path), "a/b", known=40) == 41
    assert runs.claim_version(spark, str(tmp_path), "other") == 1
