from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.config import FeatureConfig, PipelineConfig, TuningConfig
from barloom.operators import forecast, model, runs, split
from barloom.plans import inference, ingest, training
from barloom.sources import models, tables
from barloom.sources.csv_panel import read_panel, read_panels

HEADER = "Date,Open,High,Low,Close,Adj close,Volume,News_flag,Sentiment_gpt,Scaled_sentiment"
SMALL = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.9, "featureSubsetStrategy": "all", "seed": 42}


def line(i, close, sentiment=0.1):
    day = (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat()
    return f"{day},{close},{close + 1},{close - 1},{close},{close},{100 + i % 7},1,0.5,{sentiment}"


def write_csv(path, name, lines, header=HEADER):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join([header, *lines]) + "\n")


def test_entity_comes_from_the_file_name(spark, tmp_path):
    write_csv(tmp_path, "nvda.csv", [line(0, 10.0), line(1, 11.0)])
    write_csv(tmp_path, "B+K co.csv", [line(0, 20.0)])
    write_csv(tmp_path, "notes.txt", ["not a panel"])
    panel = read_panel(spark, str(tmp_path))
    assert {r.stock_symbol for r in panel.collect()} == {"NVDA", "B+K CO"} and panel.count() == 3
    types = dict(panel.dtypes)
    assert types["Date"] == "timestamp" and types["Adj_Close"] == "double" and types["News_flag"] == "int"


def test_swapped_header_fails(spark, tmp_path):
    write_csv(tmp_path, "a.csv", [line(i, 10.0) for i in range(5)])
    swapped = HEADER.replace("Open,High", "High,Open")
    write_csv(tmp_path, "b.csv", [line(0, 10.0)], swapped)
    with pytest.raises(Exception, match="(?i)header"):
        read_panel(spark, str(tmp_path)).collect()


def test_folders_with_other_columns_combine_by_name(spark, tmp_path):
    write_csv(tmp_path / "x", "a.csv", [line(0, 10.0)])
    write_csv(tmp_path / "y", "b.csv", ["0.5,2024-01-01,7"], "Scaled_sentiment,Date,Close")
    rows = {r.stock_symbol: r for r in read_panels(spark, [str(tmp_path / "x"), str(tmp_path / "y")]).collect()}
    assert rows["B"].Close == 7.0 and rows["B"].Volume is None and rows["A"].Volume == 100.0


def test_missing_inputs_are_named(spark, tmp_path):
    for call in (
        lambda: read_panel(spark, str(tmp_path)),
        lambda: tables.read_table(spark, f"{tmp_path}/none"),
        lambda: models.load_gbt(f"{tmp_path}/none"),
        lambda: models.load_scaler(f"{tmp_path}/none"),
    ):
        with pytest.raises(FileNotFoundError):
            call()


def test_ingest_validates_and_runs_once(spark, tmp_path):
    source, table = tmp_path / "csv", f"{tmp_path}/panel"
    write_csv(source, "a.csv", [line(0, 10.0), line(1, 100.0), line(2, 10.0), line(3, 10.5)])
    first = ingest.ingest_if_missing(spark, str(source), table)
    assert sorted(r.Close for r in first.collect()) == [10.0, 10.5]
    write_csv(source, "b.csv", [line(0, 5.0)])
    assert ingest.ingest_if_missing(spark, str(source), table).count() == 2
    assert ingest.ingest(spark, str(source), table).count() == 3


def test_append_skips_empty_frames(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not tables.write_append(spark.range(0), path) and not tables.table_exists(spark, path)
    assert tables.write_append(spark.range(2), path) and tables.write_append(spark.range(3), path)
    assert not tables.write_append(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 5


def test_export_names_the_run(spark, tmp_path):
    path = tables.export_csv(spark.range(3), str(tmp_path), "20240101_000000", single_file=True)
    assert path.endswith("run_20240101_000000")
    assert spark.read.option("header", True).csv(path).count() == 3


def test_newest_rows(spark):
    df = spark.createDataFrame([("A", i) for i in range(9)] + [("B", 1)], "stock_symbol string, Date int")
    assert sorted(tuple(r) for r in split.latest_n(df, 2).collect()) == [("A", 7), ("A", 8), ("B", 1)]
    assert sorted(tuple(r) for r in split.latest_one(df).collect()) == [("A", 8), ("B", 1)]
    assert "WindowGroupLimit" in split.latest_n(df, 2)._jdf.queryExecution().executedPlan().toString()


def test_directions(spark):
    df = spark.createDataFrame([(10.0, 11.0), (10.0, 9.0), (10.0, 10.0)], "current_price double, predicted_price double")
    assert [r.direction for r in forecast.with_direction(df).collect()] == ["up", "down", "flat"]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("a", 1, "None", 5.0), ("b", 2, "Production", 1.0)], "b"),
        ([("a", 1, "None", 5.0), ("b", 2, None, 1.0)], "a"),
        ([("a", 1, None, None), ("b", 2, None, None)], "b"),
        ([("a", 1, "None", 1.0), ("b", 2, "Archived", 9.0), ("c", 3, "Staging", 8.0)], "a"),
        ([("b", 2, "Archived", 9.0), ("c", 3, "Staging", 8.0)], "c"),
    ],
)
def test_run_selection(spark, rows, want):
    df = spark.createDataFrame(rows, "run_id string, started_at int, stage string, version double")
    assert runs.select_latest_run(df).first().run_id == want


def wavy(spark, entities=4, n=120):
    rng = random.Random(4)
    rows = []
    for e in range(entities):
        for i in range(n):
            close = 100 + e + 8 * math.sin(i / 4 + e) + rng.uniform(-0.1, 0.1)
            at = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((f"S{e}", at, close, close + 1, close - 1, close, 50.0 + i % 5, math.cos(i)))
    schema = "stock_symbol string, Date timestamp, Open double, High double, Low double, Close double, Volume double, Scaled_sentiment double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("home"))
    panel = wavy(spark).cache()
    cfg = PipelineConfig(gbt=SMALL)
    return home, panel, cfg, training.train(panel, cfg, home, run_id="r1")


def test_training_beats_the_mean(trained):
    _, _, _, run = trained
    test = run.evaluation.test_metrics.first()
    assert test.r2 > 0.2 and test.sample_count == run.data.test.count()
    assert run.evaluation.per_entity.count() == 4


def test_importances_sum_to_one(trained):
    rows = trained[3].evaluation.importance.collect()
    assert sum(r.importance for r in rows) == pytest.approx(1) and [r["rank"] for r in rows] == list(range(1, 43))
    assert all(a.importance >= b.importance for a, b in zip(rows, rows[1:]))


def test_run_log_holds_parameters_and_metrics(spark, trained):
    home, _, _, run = trained
    log = {r.key: r for r in tables.read_table(spark, f"{home}/runs").collect()}
    assert log["maxDepth"].value == 3.0 and log["algorithm"].text == "GBTRegressor"
    assert log["num_features"].value == 42 and log["feature_names"].text.startswith("close_lag_1,")
    assert log["test_r2"].value == pytest.approx(run.evaluation.test_metrics.first().r2)
    assert "S0_mae" in log and log["version"].value == 1 and log["training_time_seconds"].value > 0
    assert sum(k.startswith("importance_") for k in log) == 10


def test_reload_repeats_predictions_and_refit_repeats_the_model(spark, trained):
    home, _, cfg, run = trained
    again = models.load_gbt(f"{home}/models/r1")
    a = {(r.stock_symbol, r.Date): r.prediction for r in run.model.transform(run.data.test).collect()}
    b = {(r.stock_symbol, r.Date): r.prediction for r in again.transform(run.data.test).collect()}
    assert a == b
    refit = model.fit_gbt(model.fixed_layout(run.data.train.repartition(3)), cfg.gbt)
    assert refit.featureImportances == run.model.featureImportances


def test_inference_predicts_the_newest_bar(spark, trained):
    home, panel, cfg, _ = trained
    first = inference.run_inference(spark, panel, home, cfg, run_id="i1")
    rows = first.predictions.collect()
    newest = {r.stock_symbol: r for r in split.latest_one(panel).collect()}
    assert len(rows) == 4
    for r in rows:
        assert r.current_date == newest[r.stock_symbol].Date and r.current_price == newest[r.stock_symbol].Close
        assert r.predicted_price == pytest.approx(r.current_price * (1 + r.predicted_return))
    s = first.summary.first()
    assert s.n_bullish + s.n_bearish == 4
    inference.run_inference(spark, panel, home, cfg, run_id="i2")
    assert tables.read_table(spark, f"{home}/predictions").count() == 8
    late = inference.inference_rows(panel, cfg, require_target=True)
    assert late.agg(F.max("Date")).first()[0] < max(r.Date for r in newest.values())


def test_searches(spark, trained):
    _, _, _, run = trained
    ranges = {"maxIter": [1, 2], "maxDepth": [1, 2, 3]}
    cfg = TuningConfig(ranges=ranges, folds=2, n_trials=4)
    train = model.fixed_layout(run.data.train).cache()
    grid = model.tune(train, cfg)
    assert len(grid.trials) == 6 and grid.score == min(t.score for t in grid.trials)
    assert grid.model.featureImportances == model.fit_gbt(train, {**grid.params, "seed": cfg.seed}).featureImportances
    r2 = model.tune(train, TuningConfig(method="random", ranges=ranges, n_trials=4, metric="r2"))
    assert len(r2.trials) == 4 and r2.score == max(t.score for t in r2.trials)
    bad = TuningConfig(method="random", ranges={"maxIter": [1], "maxDepth": [2, 99]}, n_trials=2)
    by_depth = {t.params["maxDepth"]: t for t in model.tune(train, bad).trials}
    assert by_depth[99].score is None and "maxDepth" in by_depth[99].error and by_depth[2].score < math.inf
    for kind in ("random", "time"):
        with pytest.raises(RuntimeError, match="every candidate failed"):
            model.tune(train, TuningConfig(method="random" if kind == "random" else "grid", fold_kind=kind, ranges={"maxDepth": [99]}))


def test_time_folds_look_forward_only(spark, trained):
    _, _, _, run = trained
    folded = model.time_folds(run.data.train, 3)
    spans = folded.groupBy("stock_symbol", "fold").agg(F.min("Date").alias("a"), F.max("Date").alias("b")).collect()
    at = {(r.stock_symbol, r.fold): r for r in spans}
    assert all(at[s, k].b < at[s, k + 1].a for s, k in at if k < 2)
    found = model.tune(run.data.train, TuningConfig(ranges={"maxIter": [1], "maxDepth": [1, 2]}, folds=2, fold_kind="time"))
    assert len(found.trials) == 2 and found.score == min(t.score for t in found.trials)


def test_layout_follows_the_rows_alone(spark, trained):
    train = trained[3].data.train
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert model.fixed_layout(train).rdd.getNumPartitions() == 1
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [model.layout_partitions(n) for n in (0, 50_000, 50_001, 10**12)] == [1, 1, 2, 20_000]


def test_grid_size_of_the_defaults():
    assert len(model.candidates(TuningConfig().ranges, 3)) == 243
    assert len(model.candidates(TuningConfig().ranges, TuningConfig().max_values)) == 432


def test_pruned_training_set(spark, trained):
    _, panel, _, _ = trained
    cfg = PipelineConfig(features=FeatureConfig(max_features=10), gbt=SMALL)
    names = training.training_set(panel, cfg, select="corr").names
    assert len(names) == 10 and not {"close_normalized_vs_lag1", "close_normalized_vs_lag5"} & set(names)
    assert len(training.training_set(panel, PipelineConfig(gbt=SMALL), select="corr").names) > 10


def test_short_sequences_do_not_change_the_newest_bar(spark, trained):
    _, panel, cfg, _ = trained
    whole = inference.inference_rows(panel, cfg).filter("stock_symbol = 'S1'").orderBy(F.desc("Date")).first()
    short = inference.inference_rows(panel, PipelineConfig(sequence_length=3))
    assert short.groupBy("stock_symbol").count().agg(F.max("count")).first()[0] == 3
    assert short.filter("stock_symbol = 'S1'").orderBy(F.desc("Date")).first() == whole


def test_shared_folder(spark):
    from barloom.sources import shared

    assert shared.shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or shared.shared_folder(spark)).rstrip("/")
    path = shared.work_path(spark, "x")
    frame, written = shared.write_shared(spark.range(3), "y")
    assert frame.count() == 3 and path != written
    shared.discard(spark, written)
    with pytest.raises(Exception, match="(?i)not.?exist|PATH_NOT_FOUND"):
        spark.read.parquet(written)
