from __future__ import annotations

import datetime as dt

import pytest

from barloom.operators import quality

SCHEMA = "stock_symbol string, Date timestamp, Close double, Volume double, Scaled_sentiment double"
NAN = float("nan")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_bad_casts_become_null(spark):
    raw = spark.createDataFrame(
        [("A", "bad", "x", "1.5", "7.9"), ("A", "2024-01-02", "2", "y", "3")],
        "stock_symbol string, Date string, Open string, `Adj close` string, News_flag string",
    )
    typed = quality.clean_casts(raw)
    assert typed.columns == ["stock_symbol", "Date", "Open", "Adj_Close", "News_flag"]
    assert [t for _, t in typed.dtypes] == ["string", "timestamp", "double", "double", "int"]
    first, second = sorted(typed.collect(), key=lambda r: r.Date is not None)
    assert first.Date is None and first.Open is None and first.Adj_Close == 1.5
    assert second.Date == day(1) and second.Open == 2.0 and second.Adj_Close is None and second.News_flag == 3


def test_every_rule_counts_its_rows(spark):
    rows = [
        ("A", None, 1.0, 1.0, 1.0),
        ("A", day(0), None, 1.0, 1.0),
        ("A", day(1), 1.0, None, 1.0),
        ("A", day(2), 1.0, 1.0, None),
        ("A", day(3), 0.0, 1.0, 1.0),
        ("A", day(4), -1.0, 1.0, 1.0),
        ("A", day(5), 1.0, -1.0, 1.0),
        ("A", day(6), NAN, 1.0, 1.0),
        ("A", day(7), 1.0, NAN, 1.0),
        ("A", day(8), 1.0, 1.0, NAN),
        ("A", day(9), 10.0, 0.0, 1.0),
        ("A", day(10), 100.0, 1.0, 1.0),
        ("A", day(11), 10.0, 1.0, 1.0),
        ("A", day(12), 15.0, 1.0, 1.0),
        ("B", day(0), 5.0, 1.0, 1.0),
    ]
    df = frame(spark, rows)
    got = {r.stock_symbol: r.asDict() for r in quality.removed_counts(df).collect()}
    a = got["A"]
    assert (a["n_null"], a["n_nan"], a["n_invalid"], a["n_outlier"]) == (4, 3, 3, 2)
    assert (a["n_rows"], a["n_removed"], a["n_kept"]) == (14, 12, 2)
    assert got["B"]["n_kept"] == 1
    kept = {(r.stock_symbol, r.Close) for r in quality.validate(df).collect()}
    assert kept == {("A", 10.0), ("A", 15.0), ("B", 5.0)}  # the change of exactly 0.5 stays


def test_spike_removes_two_bars(spark):
    df = frame(spark, [("A", day(i), c, 1.0, 0.0) for i, c in enumerate([10.0, 100.0, 10.0])])
    assert [r.Close for r in quality.drop_outliers(df).collect()] == [10.0]


def test_combine_by_name_not_by_position(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "Close double, Volume double")
    b = spark.createDataFrame([(20.0, 10.0, 5)], "Volume double, Close double, News_flag int")
    rows = sorted(quality.combine_panels(a, b).collect())
    assert [tuple(r) for r in rows] == [(1.0, 2.0, None), (10.0, 20.0, 5)]


def test_label_is_upper_case(spark):
    assert quality.with_entity(spark.range(1), "nvda").first().stock_symbol == "NVDA"


def test_describe(spark):
    df = frame(spark, [("A", day(i), float(i + 1), 2.0, None) for i in range(3)])
    got = {r.statistic: r for r in quality.describe_panel(df).collect()}
    assert got["count"].Close == 3 and got["count"].Scaled_sentiment == 0
    assert got["mean"].Close == 2.0 and got["stddev"].Close == pytest.approx(1.0)
    assert got["min"].Close == 1.0 and got["max"].Close == 3.0


def test_range_layout_splits_one_long_entity(spark):
    df = frame(spark, [("A", day(i), 1.0, 1.0, 1.0) for i in range(400)])
    parts = quality.distribute(df, partitions=4).rdd.glom().map(len).collect()
    assert sum(parts) == 400 and max(parts) < 250
