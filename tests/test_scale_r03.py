"""Growth of shared steps: no fit moves wide rows, entities that are long keep the even layout, correlation in batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.config import PipelineConfig, StoppingConfig, TuningConfig
from barloom.functions.layout import measure
from barloom.operators import correlation, model, split
from barloom.plans import panels, training

SMALL = {"maxIter": 2, "maxDepth": 2, "seed": 42, "subsamplingRate": 0.8}


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(3)
    rows = []
    for e in range(7):
        price = 50.0
        for i in range(90):
            price *= 1 + rng.uniform(-0.03, 0.03)
            day = datetime(2024, 1, 1) + timedelta(days=i)
            rows.append((f"S{e}", day, price, price * 1.01, price * 0.99, price, price, float(rng.randint(1, 9)), 1, rng.random(), rng.random()))
    names = "stock_symbol string, Date timestamp_ntz, Open double, High double, Low double, Close double, Adj_Close double, Volume double, News_flag int, Sentiment_gpt double, Scaled_sentiment double"
    return spark.createDataFrame(rows, names)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dealt(panel, monkeypatch):
    monkeypatch.setattr(model, "ROWS_PER_PARTITION", 200)
    return training.training_set(panel, PipelineConfig(gbt=SMALL))


def test_training_rows_lie_as_stored(spark, panel, dealt):
    assert dealt.buckets == 4 and "Exchange" not in plan(dealt.laid())
    parts = dealt.laid().select("stock_symbol", "Date", F.spark_partition_id().alias("p")).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    again = dealt.laid().select("stock_symbol", "Date", F.spark_partition_id().alias("p")).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts == again and len({r.p for r in parts}) > 1
    assert all(len({r.p for r in parts if r.stock_symbol == s}) == 1 for s in {r.stock_symbol for r in parts})


def test_stored_places_give_the_splits_of_windows(dealt):
    key = ["stock_symbol", "Date"]
    by_window = {tuple(r) for r in split.time_split(dealt.train.drop("split"), 0.8).where("split = 'train'").select(*key).collect()}
    assert {tuple(r) for r in dealt.train.where(model._early(0.8)).select(*key).collect()} == by_window
    folds = {tuple(r) for r in model.time_folds(dealt.train, 3).select(*key, "fold").collect()}
    assert {tuple(r) for r in dealt.train.withColumn("fold", model._block("place", "places", 3)).select(*key, "fold").collect()} == folds


def test_fits_and_searches_stage_nothing_again(dealt, monkeypatch):
    def no(*_, **__):
        raise AssertionError("rows are moved again")

    monkeypatch.setattr(model, "stage", no)
    monkeypatch.setattr(model, "fixed_layout", no)
    ranges = {"maxIter": [1, 2], "maxDepth": [1, 2]}
    for cfg in (TuningConfig(ranges=ranges, folds=2), TuningConfig(ranges=ranges, folds=2, fold_kind="time"),
                TuningConfig(method="random", ranges=ranges, n_trials=2), TuningConfig(method="sequential", ranges=ranges, n_trials=2)):
        found = model.tune(dealt.laid(), cfg, dealt.layout, dealt=True)
        assert all(t.usable for t in found.trials)
    assert model.fit_stopped(dealt.laid(), SMALL, StoppingConfig(share=0.2), dealt.layout, dealt=True).getNumTrees >= 1


def test_long_entities_keep_the_even_layout(panel, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_PARTITION", 20)
    data = training.training_set(panel, PipelineConfig(gbt=SMALL))
    assert measure(panel).longest == 90 and data.buckets == 0 and data.laid().count() == data.train.count()


def test_daily_bars_need_one_exchange_unless_one_supplier_is_long(spark, tmp_path, monkeypatch):
    rows = [(s, datetime(2024, 1, 1 + d % 5).date(), 10.0 + d, 2.0, 0.05) for s in (1, 2, None) for d in range(9)]
    names = "l_suppkey int, l_shipdate date, l_extendedprice double, l_quantity double, l_discount double"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    even = panels.panel_daily(spark, str(tmp_path))
    assert "REPARTITION_BY_COL" in plan(even) and plan(even).count("Exchange") == 1
    want = sorted(map(str, even.collect()))
    monkeypatch.setattr(panels, "ROWS_PER_TASK", 3)
    skewed = panels.panel_daily(spark, str(tmp_path))
    assert "REPARTITION" not in plan(skewed) and sorted(map(str, skewed.collect())) == want


def test_pairwise_correlation_over_batches_and_parts(spark):
    rng = np.random.default_rng(1)
    rows = [[None if rng.random() < 0.2 else float(v) for v in (1e6 + x, x + rng.normal(), rng.normal(), 4.0)] for x in rng.normal(size=900)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    got = {(r.feature_a, r.feature_b): r.r for r in correlation.pairwise_correlation(df, ["a", "b", "c", "d"]).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        x = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
        assert got["abcd"[i], "abcd"[j]] == pytest.approx(np.corrcoef(x.T)[0, 1], abs=1e-9)
    assert got["a", "d"] is None
    assert all(r.r is None for r in correlation.pairwise_correlation(df.limit(0), ["a", "b"]).collect())


@pytest.mark.parametrize("method", ["spark_cv", "random", "sequential"])
def test_fits_of_a_search_read_rows_computed_once(spark, dealt, monkeypatch, method):
    seen = []
    fit = model.fit_gbt
    monkeypatch.setattr(model, "fit_gbt", lambda df, params: seen.append(plan(df)) or fit(df, params))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    cfg = TuningConfig(method=method, ranges={"maxIter": [1, 2], "maxDepth": [1, 2]}, folds=2, n_trials=2)
    found = model.tune(dealt.laid(), cfg, dealt.layout, dealt=True)
    assert seen and all("InMemoryTableScan" in p for p in seen) and all(t.usable for t in found.trials)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_kept_rows_give_the_fit_of_stored_rows(dealt):
    with model.kept(dealt.laid().select("features", "target")) as rows:
        trees = [model.fit_gbt(df, SMALL).toDebugString.split("\n", 1)[1] for df in (rows, dealt.laid())]
    assert trees[0] == trees[1]


def test_open_fits_follow_the_parts(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [model.open_fits(spark.range(0, 9, 1, n), 4) for n in (1, 2 * cores, 4 * cores, 5 * cores)] == [4, 2, 1, 1]
