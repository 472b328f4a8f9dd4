"""Queries against their SQL on the smallest tables, whole and with cut histories."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as spark_entry
from barloom.plans import catalog as queries
from barloom.plans import panels

FOLDER = "/root/testdata/sf0.001"
SQL = spark_entry.oracle_sql()
ALL = spark_entry.queries()

CUT = [
    "validate_edge", "removed_counts", "lag_lead", "features_all", "features_all_hourly",
    "split_sizes", "metrics_per_symbol", "qq_points", "box_per_symbol", "residual_stats",
]


#: Queries whose subpackage may be absent have their tests there.
OWN = sorted(k for k in SQL if k in queries.catalog())
#: Fits of default size take minutes on any table: tests/compare.py runs this one, tests/test_search.py its parts.
SLOW = {"sequential_search"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_flagship_returns_one_row_per_symbol(spark):
    out = spark_entry.entry(spark)
    assert out.columns == ["stock_symbol", "Date", "Close", "price_change_1d", "ma_5"]
    assert out.count() == out.select("stock_symbol").distinct().count() == 10


def test_every_query_of_the_catalogue_has_sql():
    assert set(OWN) == set(queries.catalog()) and set(SQL) <= set(ALL)


@pytest.mark.parametrize("name", [n for n in OWN if n not in SLOW])
def test_query_equals_sql(spark, duck, name):
    assert difference(ALL[name](spark, FOLDER).toPandas(), duck.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", CUT)
def test_query_equals_sql_with_cut_histories(spark, duck, name, monkeypatch):
    monkeypatch.setattr(queries, "layout_of", lambda s, f, p: panels.layout_of(s, f, p, rows_per_task=40))
    assert panels.layout_of(spark, FOLDER, "panel_daily", 40).cuts
    assert difference(ALL[name](spark, FOLDER).toPandas(), duck.execute(SQL[name]).df()) is None
