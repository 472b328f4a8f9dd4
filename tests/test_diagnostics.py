from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.layout import Layout
from barloom.operators import correlation as corr
from barloom.operators import diagnostics as diag
from barloom.operators import metrics, sampling, scaling
from barloom.operators.model import metric_by_name
from barloom.operators.quantiles import exact_quantiles, exact_quantiles_of

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.975, 1.0]


def numbers(spark, values, name="residual"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize(
    "values",
    [
        [random.Random(1).gauss(0, 1) for _ in range(3000)],
        [random.Random(2).choice([0.0, 0.0, 0.0, 1.0, 2.0]) for _ in range(3000)],
        [10.0 ** random.Random(3 + i).uniform(-9, 9) for i in range(500)],
        [4.0],
    ],
    ids=["normal", "ties", "wide", "single"],
)
def test_quantiles_are_exact_whatever_the_sketch(spark, values):
    df = numbers(spark, values)
    for accuracy in (10, 50_000):
        assert exact_quantiles(df, "residual", PS, accuracy) == pytest.approx(np.quantile(values, PS))


def test_quantiles_without_values(spark):
    assert exact_quantiles(numbers(spark, []), "residual", [0.5]) is None


def test_quantiles_per_entity(spark):
    rng = random.Random(5)
    rows = [(k, rng.expovariate(1)) for k in "AAAB" for _ in range(400)] + [("C", 1.0)]
    df = spark.createDataFrame(rows, "stock_symbol string, x double")
    got = exact_quantiles_of(df, "x", PS, "stock_symbol", ["A", "B"], accuracy=20)
    for name in "AB":
        assert got[name] == pytest.approx(np.quantile([v for k, v in rows if k == name], PS))


def test_large_frames_give_the_same_tables(spark):
    rng = random.Random(6)
    rows = [(k, rng.gauss(0, 1)) for k in "AAB" for _ in range(200)]
    df = spark.createDataFrame(rows, "stock_symbol string, residual double")
    small, large = Layout(10), Layout(10**9, cuts=(("A", (1,)),))

    def same(make):
        a, b = (make(x).toPandas() for x in (small, large))
        key = [c for c in a.columns if a[c].dtype == object] or [a.columns[0]]
        pd.testing.assert_frame_equal(
            a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
        )

    same(lambda x: diag.box_per_entity(df, layout=x))
    same(lambda x: diag.qq_points(df, layout=x))
    same(lambda x: diag.residual_stats(df, layout=x))


def test_wide_intervals_are_cut_again(spark):
    rng = random.Random(11)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [0.25] * 500
    got = exact_quantiles(numbers(spark, values), "residual", PS, accuracy=4, rows_per_task=10)
    assert got == pytest.approx(np.quantile(values, PS))


@pytest.mark.parametrize("odd", [[math.nan, 4.0, math.nan], [math.inf, math.inf, 1.0], [-math.inf, math.inf, math.nan], [2.0] * 9])
def test_large_path_equals_the_built_in_on_odd_values(spark, odd):
    df = numbers(spark, [10.0, *odd, 4.0])
    want = df.agg(F.percentile("residual", PS).alias("q")).first().q
    assert exact_quantiles(df, "residual", PS) == pytest.approx(want, nan_ok=True)


def test_residual_stats_match_pandas(spark):
    values = [random.Random(7).gauss(1, 2) ** 3 for _ in range(50)] + [1.0, 2.0, 3.5]
    r = diag.residual_stats(numbers(spark, values)).first()
    s = pd.Series(values)
    assert r.skewness == pytest.approx(s.skew()) and r.kurtosis == pytest.approx(s.kurtosis())
    assert r["std"] == pytest.approx(s.std()) and r.q025 == pytest.approx(s.quantile(0.025))


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 9.0], [3.0] * 5, [-1.0, 1.0]])
def test_histogram_matches_numpy(spark, values):
    got = diag.histogram(numbers(spark, values), "residual").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    density, _ = np.histogram(values, bins=50, density=True)
    assert [r.n for r in got] == list(counts)
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1])
    assert [r.density for r in got] == pytest.approx(density)


def test_histogram_of_nothing(spark):
    assert diag.histogram(numbers(spark, []), "residual").count() == 0


def test_metrics_and_constant_actuals(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 2.5), ("flat", 2.0, 2.0), ("flat", 2.0, 3.0), ("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("one", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "stock_symbol string, target double, prediction double")
    got = {r.stock_symbol: r for r in metrics.metrics(df, ["stock_symbol"]).collect()}
    assert got["a"].mae == 0.75 and got["a"].mse == 0.625 and got["a"].r2 == pytest.approx(1 - 1.25 / 2)
    assert got["flat"].r2 == 0.0 and got["hit"].r2 == 1.0 and got["one"].r2 is None
    overall = metrics.metrics(df).first()
    for name in metrics.METRICS:
        assert overall[name] == pytest.approx(metric_by_name(df, name))


def test_comparison_skips_absent_metrics(spark):
    rows = spark.createDataFrame([("m", "mae", 2.0), ("k", "mae", 4.0)], "model string, metric string, value double")
    got = {r.model: r for r in metrics.compare_models(rows).collect()}
    assert got["m"].mae_ratio == 0.5 and got["k"].mae_ratio == 1.0 and got["m"].r2 is None


def test_constant_column_scales_to_zero(spark):
    rows = [("train", 1.0, 5.0), ("train", 3.0, 5.0), ("test", 9.0, 7.0), ("test", None, 5.0)]
    df = spark.createDataFrame(rows, "split string, a double, b double")
    got = scaling.scale_columns(df, ["a", "b"]).collect()
    assert [r.b for r in got] == [0.0] * 4
    assert [r.a for r in got] == pytest.approx([-(0.5**0.5), 0.5**0.5, 7 / 2**0.5, None], nan_ok=True)


def test_column_and_vector_scaling_agree(spark):
    rng = random.Random(8)
    rows = [("train" if i % 3 else "test", rng.gauss(5, 2), rng.random()) for i in range(60)]
    df = spark.createDataFrame(rows, "split string, a double, b double").coalesce(1)
    vectors, model = scaling.feature_vectors(df, ["a", "b"])
    plain = scaling.scale_columns(df, ["a", "b"]).collect()
    for v, p in zip(vectors.collect(), plain):
        assert list(v.features) == pytest.approx([p.a, p.b])
    train = [v.features for v in vectors.collect() if v.split == "train"]
    assert np.mean(train, axis=0) == pytest.approx([0, 0], abs=1e-9)
    assert np.std(train, axis=0, ddof=1) == pytest.approx([1, 1])


def test_correlation_and_pruning(spark):
    rng = random.Random(9)
    rows = [(a := rng.random(), a * 2 + 1, rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    table = corr.correlation(df, ["a", "b", "c"])
    want = pd.DataFrame(rows, columns=list("abc")).corr()
    for r in table.collect():
        assert r.r == pytest.approx(want.loc[r.feature_a, r.feature_b])
    assert corr.prune_correlated(table) == ["a", "c"]
    assert corr.lower_triangle(table).count() == 3


def test_pairwise_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    want = pd.DataFrame(rows, columns=["a", "b"]).corr().loc["a", "b"]
    assert corr.pairwise_correlation(df, ["a", "b"]).first().r == pytest.approx(want)


def test_pairwise_correlation_of_many_columns_with_holes(spark):
    rng = random.Random(8)
    names = [f"c{i}" for i in range(9)]
    rows = []
    for _ in range(400):
        base = rng.gauss(0, 1)
        row = [base * (i - 4) + rng.gauss(0, 1) + 1e6 * i for i in range(6)] + [7.0, rng.gauss(0, 1e-9) + 1e3, None]
        rows.append([None if rng.random() < 0.3 else x for x in row])
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} double" for n in names))
    want = pd.DataFrame(rows, columns=names, dtype=float).corr()
    got = {(r.feature_a, r.feature_b): r.r for r in corr.pairwise_correlation(df, names).collect()}
    assert len(got) == 36
    for (a, b), r in got.items():
        if {"c6", "c8"} & {a, b}:
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-3 if "c7" in (a, b) else 1e-9)
    none = corr.pairwise_correlation(df.limit(0), names).collect()
    assert len(none) == 36 and all(r.r is None for r in none)


def test_an_over_long_null_entity_gets_exact_quartiles(spark):
    rng = random.Random(3)
    rows = [(None, rng.gauss(0, 1)) for _ in range(900)] + [("", rng.gauss(5, 1)) for _ in range(700)] + [("=", rng.random()) for _ in range(20)]
    df = spark.createDataFrame(rows, "stock_symbol string, residual double")
    cut = Layout(len(rows), 100, ((None, (1,)), ("", (1,))))
    assert set(exact_quantiles_of(df, "residual", [0.5], "stock_symbol", [None, ""])) == {None, ""}
    plain = sorted(map(str, diag.box_per_entity(df).collect()))
    assert sorted(map(str, diag.box_per_entity(df, layout=cut).collect())) == plain


def test_samples_do_not_depend_on_layout(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    for make in (lambda d: sampling.sample_n(d, ["k"], 50), lambda d: sampling.sample_fraction(d, ["k"], 0.3)):
        a = {r.id for r in make(df.repartition(3)).collect()}
        assert a == {r.id for r in make(df.repartition(7)).collect()}
    assert 450 < len(a) < 750
