"""Incremental ingest and mergeable moments."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from test_plans import line, write_csv

from barloom.operators import moments, scaling
from barloom.plans import ingest
from barloom.sources import tables


def rows_of(frame):
    return sorted(str(r.asDict()) for r in frame.select(*sorted(frame.columns)).collect())


def up_to_date(spark, source, table):
    """An incremental call gives the panel of a full one; returns what it parsed."""
    done = ingest.ingest_changed(spark, str(source), table, buckets=4)
    if any(f.endswith(".csv") for f in os.listdir(source)):
        full = ingest.ingest(spark, str(source), f"{table}-full")
        assert rows_of(done.panel) == rows_of(full)
    return sorted(os.path.basename(f) for f in done.files), done.entities


def test_only_changed_files_are_parsed(spark, tmp_path):
    source, table = tmp_path / "csv", f"{tmp_path}/panel"
    for e in "abcdef":
        write_csv(source, f"{e}.csv", [line(i, 10.0 + i) for i in range(4)])
    assert up_to_date(spark, source, table) == ([f"{e}.csv" for e in "abcdef"], 6)
    assert up_to_date(spark, source, table) == ([], 0)
    write_csv(source, "b.csv", [line(0, 20.0), line(1, 200.0), line(2, 21.0), line(3, 21.5)])
    assert up_to_date(spark, source, table) == (["b.csv"], 1)
    write_csv(source, "new.csv", [line(0, 5.0)])
    os.remove(source / "c.csv")
    assert up_to_date(spark, source, table) == (["new.csv"], 2)
    for e in ("a", "b", "d", "e", "f", "new"):
        os.remove(source / f"{e}.csv")
    done = ingest.ingest_changed(spark, str(source), table, buckets=4)
    assert (done.files, done.entities, done.panel.count()) == ([], 6, 0)


def test_a_failed_call_is_made_up_for(spark, tmp_path):
    source, table = tmp_path / "csv", f"{tmp_path}/panel"
    write_csv(source, "a.csv", [line(0, 10.0)])
    write_csv(source, "b.csv", [line(0, 10.0)], "Wrong,Header")
    with pytest.raises(Exception):
        ingest.ingest_changed(spark, str(source), table)
    assert not tables.table_exists(spark, f"{table}/files")
    write_csv(source, "b.csv", [line(0, 11.0)])
    assert up_to_date(spark, source, table) == (["a.csv", "b.csv"], 2)


def test_a_missing_folder_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.ingest_changed(spark, f"{tmp_path}/none", f"{tmp_path}/t")


@pytest.fixture(scope="module")
def holes(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), 1e9 + rng.gauss(0, 1), None if rng.random() < 0.4 else rng.gauss(3, 2), 7.0, None) for _ in range(500)]
    rows += [(9, 1e9, None, 7.0, None)]
    return spark.createDataFrame(rows, "part int, a double, b double, c double, d double")


def test_merged_moments_equal_those_of_all_rows(holes):
    names = ["a", "b", "c", "d"]
    whole = {r.feature: r for r in moments.moments(holes, names).collect()}
    for parts in (moments.moments(holes, names, ["part"]), moments.moments(holes.withColumn("row", F.rand(1)), names, ["row"])):
        for r in moments.merge(parts).collect():
            want = whole[r.feature]
            assert (r.n, r.low, r.high) == (want.n, want.low, want.high)
            assert r.mean == (pytest.approx(want.mean, rel=1e-14) if want.n else None)
            assert r.m2 == (pytest.approx(want.m2, rel=1e-6, abs=1e-9) if want.n else None)


def test_a_new_part_is_merged_without_the_old_rows(holes):
    names = ["a", "b"]
    old = moments.moments(holes.where("part < 3"), names, ["part"])
    both = moments.merge(old.unionByName(moments.moments(holes.where("part >= 3"), names, ["part"])))
    got = {r.feature: r for r in moments.stats(both).collect()}
    want = {r.feature: r for r in scaling.train_stats(holes.withColumn("split", F.lit("train")), names).collect()}
    for name in names:
        assert got[name].mean == pytest.approx(want[name].mean, rel=1e-14)
        assert got[name].std == pytest.approx(want[name]["std"], rel=1e-6)


def test_scaling_by_merged_figures_equals_scaling_by_the_rows(holes):
    names = ["a", "b", "c", "d"]
    marked = holes.withColumn("split", F.lit("train"))
    table = moments.stats(moments.merge(moments.moments(marked, names, ["part"])))
    both = moments.scale_by(marked.withColumns({f"_{n}": F.col(n) for n in names}), [f"_{n}" for n in names], table.withColumn("feature", F.concat(F.lit("_"), "feature")))
    gaps = scaling.scale_columns(both, names).select([F.max(F.abs(F.col(n) - F.col(f"_{n}"))).alias(n) for n in names] + [
        F.count_if(F.col(n).isNull() != F.col(f"_{n}").isNull()).alias(f"_{n}") for n in names
    ]).first()
    assert all((gaps[n] or 0) < 1e-5 and gaps[f"_{n}"] == 0 for n in names)


def test_parts_of_an_empty_frame(holes):
    none = holes.limit(0)
    assert moments.moments(none, ["a"], ["part"]).count() == 0 and moments.merge(moments.moments(none, ["a"], ["part"])).count() == 0
    assert [tuple(r) for r in moments.stats(moments.merge(moments.moments(none, ["a"]))).collect()] == [("a", None, None)]
