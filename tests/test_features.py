from __future__ import annotations

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.config import FeatureConfig
from barloom.operators import features as feat

SCHEMA = "stock_symbol string, Date timestamp, High double, Low double, Close double, Volume double, Scaled_sentiment double"


def bars(spark, name, closes, volumes=None, sentiment=None):
    rows = []
    for i, c in enumerate(closes):
        v = volumes[i] if volumes else 10.0 + i
        s = sentiment[i] if sentiment else math.sin(i)
        rows.append((name, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), c + 1, c - 1, c, float(v), s))
    return spark.createDataFrame(rows, SCHEMA)


def test_names_and_their_order():
    names = feat.feature_names()
    assert len(names) == 42 == len(set(names))
    assert names[:4] == ["close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5"]
    assert feat.model_features() == names and names[24] == "sentiment_lag_3"
    assert feat.model_features(FeatureConfig(max_features=25)) == names[:25]
    assert feat.model_features(FeatureConfig(max_features=0)) == names


def test_switches_remove_groups(spark):
    cfg = FeatureConfig(enable_rsi=False, enable_interactions=False, enable_volatility=False)
    assert len(feat.feature_names(cfg)) == 42 - 1 - 4 - 5
    out = feat.add_features(bars(spark, "A", [10.0 + i for i in range(8)]), cfg)
    assert set(feat.feature_names(cfg)) < set(out.columns) and "momentum_ratio" not in out.columns


def test_custom_lags_and_windows(spark):
    cfg = FeatureConfig(price_lags=(2,), volume_lags=(3,), sentiment_lags=(4,), ma_windows=(3,))
    out = feat.add_features(bars(spark, "A", [10.0 + i for i in range(8)]), cfg)
    assert {"close_lag_2", "volume_lag_3", "sentiment_lag_4", "ma_3", "close_vs_ma3"} < set(out.columns)
    assert "close_lag_1" not in out.columns and "ma_5" not in out.columns
    last = out.orderBy(F.desc("Date")).first()
    assert last.close_lag_2 == 15.0 and last.ma_3 == 16.0


def test_values_against_plain_python(spark):
    closes = [10.0, 11.0, 10.5, 12.0, 11.5, 13.0, 12.5, 14.0]
    rows = feat.add_features(bars(spark, "A", closes)).orderBy("Date").collect()
    moves = [None] + [(b - a) / a for a, b in zip(closes, closes[1:])]
    r = rows[6]
    assert r.price_change_3d == pytest.approx((closes[6] - closes[3]) / closes[3])
    assert r.ma_5 == pytest.approx(statistics.mean(closes[2:7]))
    assert r.ma_20 == pytest.approx(statistics.mean(closes[:7]))
    assert r.price_volatility_5d == pytest.approx(statistics.stdev(moves[2:7]))
    gain = sum(max(m, 0) for m in moves[1:7]) / 7  # the first bar counts with a gain of zero
    loss = sum(max(-m, 0) for m in moves[1:7]) / 7
    assert r.momentum_ratio == pytest.approx(gain / (loss + 0.001))
    assert r.price_position_5d == pytest.approx((12.5 - 9.5) / (14.0 - 9.5 + 0.001))
    assert r.target == pytest.approx(14.0 / 12.5 - 1)
    assert rows[-1].target is None and rows[0].price_gain == 0.0


@pytest.mark.parametrize("n, clean", [(1, 0), (6, 0), (7, 1)])
def test_warm_up(spark, n, clean):
    built = feat.add_features(bars(spark, "A", [10.0 + i for i in range(n)]))
    assert feat.clean_features(built).count() == clean


def test_newest_bar_stays_without_target(spark):
    built = feat.add_features(bars(spark, "A", [10.0 + i for i in range(7)]))
    assert feat.clean_features(built, require_target=False).count() == 2


def test_zero_volume_gives_null_not_an_error(spark):
    volumes = [10, 10, 10, 10, 10, 10, 0, 100, 10, 10]
    built = feat.add_features(bars(spark, "A", [10.0 + i for i in range(10)], volumes))
    by_day = {r.Date.day: r for r in built.collect()}
    assert by_day[8].volume_change_1d is None and by_day[8].volume_normalized_vs_lag1 is None
    kept = {r.Date.day for r in feat.clean_features(built).collect()}
    assert kept == {6, 7, 9}


def test_entities_do_not_mix(spark):
    both = bars(spark, "A", [10.0] * 8).unionByName(bars(spark, "B", [50.0] * 8))
    firsts = feat.add_features(both).filter("close_lag_1 IS NULL").groupBy("stock_symbol").count().collect()
    assert {r["count"] for r in firsts} == {1}


def test_one_exchange_for_features_and_split(spark):
    """Features, cleaning and split share one exchange, and the plan does not grow with entities."""
    from barloom.operators.quality import validate
    from barloom.operators.split import time_split

    df = bars(spark, "A", [10.0 + i for i in range(9)])
    out = time_split(feat.clean_features(feat.add_features(validate(df))))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    prepared = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert prepared.count("Exchange hashpartitioning") == 1 and prepared.count("Sort [") == 1
    assert "BatchEvalPython" not in plan
