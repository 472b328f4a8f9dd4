"""Cut histories must give exactly the results of uncut ones."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions.layout import COPY, PIECE, Layout, clock, measure, over_history, with_position
from barloom.operators import features as feat
from barloom.operators import quality, split
from barloom.schema import Keys

START = dt.datetime(2020, 1, 1)
SCHEMA = (
    "stock_symbol string, Date timestamp_ntz, Open double, High double, Low double, Close double, "
    "Volume double, Scaled_sentiment double"
)


def panel(spark, sizes: dict[str, int], seed: int = 1, uneven: bool = False):
    """Random bars; with ``uneven`` most of a history falls into bursts with long gaps between them."""
    rng = random.Random(seed)
    rows = []
    for name, n in sizes.items():
        at = START
        close = 100.0
        for _ in range(n):
            gap = rng.choice([1, 1, 1, 5_000_000]) if uneven else rng.randint(1, 86_400)
            at += dt.timedelta(seconds=gap)
            close *= rng.uniform(0.4, 1.7) if rng.random() < 0.1 else rng.uniform(0.97, 1.03)
            volume = float(rng.choice([0, 10, 20, 35]))
            rows.append((name, at, close, close * 1.01, close * 0.99, close, volume, rng.uniform(-1, 1)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module", params=[False, True], ids=["even", "uneven"])
def skewed(spark, request):
    return panel(spark, {"HOT": 700, "WARM": 90, "B": 30, "ONE": 1}, uneven=request.param).cache()


@pytest.fixture(scope="module", params=[15, 200])
def cut(skewed, request):
    return measure(skewed, rows_per_task=request.param)


def test_ordinary_panel_is_not_cut(spark):
    layout = measure(panel(spark, {"A": 20, "B": 30}))
    assert layout.cuts == () and layout.rows == 50 and layout.fits_one_task


def test_empty_panel(spark):
    assert measure(panel(spark, {"A": 1}).filter("false")).rows == 0


def test_only_long_histories_are_cut(skewed):
    layout = measure(skewed, rows_per_task=200)
    assert [name for name, _ in layout.cuts] == ["HOT"]


def placed(skewed, cut, back=20, ahead=1):
    """The rows that the windows of cut histories get, copies included."""
    seen = []
    over_history(skewed, lambda d, w: seen.append(d) or d, back=back, ahead=ahead, layout=cut)
    return seen[1]


def test_pieces_hold_about_equal_counts(skewed, cut):
    sizes = [r.n for r in placed(skewed, cut).filter(~F.col(COPY)).groupBy("stock_symbol", PIECE).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * cut.rows_per_task


def test_copies_stay_few_whatever_the_gaps(skewed):
    layout = measure(skewed, rows_per_task=200)
    counts = placed(skewed, layout).agg(F.count("*"), F.count_if(COPY)).first()
    assert counts[0] < 1.5 * 700 and counts[1] <= 21 * 5


def test_only_long_histories_are_copied(skewed):
    assert {r.stock_symbol for r in placed(skewed, measure(skewed, rows_per_task=200)).collect()} == {"HOT"}


def test_null_entities_are_cut_like_others(skewed):
    nameless = skewed.withColumn("stock_symbol", F.when(F.col("stock_symbol") != "HOT", F.col("stock_symbol")))
    layout = measure(nameless, rows_per_task=100)
    assert [name for name, _ in layout.cuts] == [None]
    assert rows_of(feat.add_features(nameless, layout=layout)) == rows_of(feat.add_features(nameless))
    assert rows_of(split.time_split(nameless, 0.85, layout)) == rows_of(split.time_split(nameless, 0.85))


def test_equal_times_follow_the_tie_columns(spark):
    rng = random.Random(8)
    rows = [("HOT", START + dt.timedelta(seconds=i // 4), float(i % 4), rng.uniform(1, 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "stock_symbol string, Date timestamp_ntz, n double, Close double").repartition(5)
    keys = Keys(ties=("n",))
    lag = lambda d, w: d.withColumn("before", F.lag("Close", 3).over(w))
    layout = measure(df, keys, rows_per_task=50)
    assert rows_of(over_history(df, lag, 3, 0, layout, keys)) == rows_of(over_history(df, lag, 3, 0, None, keys))
    assert rows_of(split.latest_n(df, 3, keys)) == rows_of(df.orderBy(F.desc("Date"), F.desc("n")).limit(3))
    assert split.latest_one(df, keys).first().n == 3.0


@pytest.mark.parametrize("null_time", [False, True])
@pytest.mark.parametrize("kind", ["double", "string"])
def test_bursts_of_one_time_are_cut_at_the_tie_columns(spark, kind, null_time):
    """Most bars share one time: pieces stay small, and windows over (time, ties) are those of the uncut history."""
    rng = random.Random(9)
    at = [START + dt.timedelta(seconds=i) for i in range(40)]
    rows = [("HOT", at[i % 40], float(i), 1, rng.uniform(1, 2)) for i in range(80)]
    rows += [("HOT", None if null_time else at[20], float(i), 2, rng.uniform(1, 2)) for i in range(1000, 1500)]
    rows += [(None, at[5], float(i), 3, rng.uniform(1, 2)) for i in range(300)] + [("B", at[0], 1.0, 4, 1.5)]
    df = spark.createDataFrame(rows, "stock_symbol string, Date timestamp_ntz, n double, m int, Close double").repartition(5)
    df = df.withColumn("n", F.col("n").cast(kind))
    keys = Keys(ties=("n", "m"))
    layout = measure(df, keys, rows_per_task=50)
    assert {(e, t is None) for e, t, _ in layout.bursts} == {("HOT", null_time), (None, False)}
    seen = []
    over_history(df, lambda d, w: seen.append(d) or d, 3, 1, layout, keys)
    sizes = [r.n for r in seen[1].filter(~F.col(COPY)).groupBy("stock_symbol", PIECE).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * 50 and sum(sizes) == 880
    near = lambda d, w: d.withColumns({"before": F.lag("Close", 3).over(w), "after": F.lead("Close").over(w)})
    assert rows_of(over_history(df, near, 3, 1, layout, keys)) == rows_of(over_history(df, near, 3, 1, None, keys))
    assert rows_of(split.time_split(df, 0.85, layout, keys)) == rows_of(split.time_split(df, 0.85, None, keys))


def test_bars_equal_in_all_keys_stay_together(spark):
    rows = [("HOT", START, 1.0, 2.0)] * 200
    df = spark.createDataFrame(rows, "stock_symbol string, Date timestamp_ntz, n double, Close double")
    keys = Keys(ties=("n",))
    layout = measure(df, keys, rows_per_task=50)
    assert rows_of(split.time_split(df, 0.5, layout, keys)) == rows_of(split.time_split(df, 0.5, None, keys))


def test_windows_see_only_a_bounded_number_of_rows(skewed):
    """No task may receive a whole long history: pieces plus their copies bound the group size."""
    layout = measure(skewed, rows_per_task=60)
    groups = placed(skewed, layout).groupBy("stock_symbol", PIECE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(COPY).alias("copies")
    )
    top = groups.filter("stock_symbol = 'HOT'").agg(F.max("n"), F.max("copies")).first()
    assert top[0] <= 2 * 60 + 21 and top[1] <= 21


def test_features_equal_uncut(skewed, cut):
    plain = feat.add_features(skewed)
    assert rows_of(feat.add_features(skewed, layout=cut)) == rows_of(plain)


def test_outliers_and_counts_equal_uncut(skewed, cut):
    assert rows_of(quality.drop_outliers(skewed, cut)) == rows_of(quality.drop_outliers(skewed))
    holes = skewed.withColumn("Close", F.when(F.crc32(F.col("Date").cast("string")) % 7 > 0, F.col("Close")))
    assert rows_of(quality.removed_counts(holes, cut)) == rows_of(quality.removed_counts(holes))
    kept = quality.removed_counts(holes, cut).agg(F.sum("n_kept")).first()[0]
    assert kept == quality.validate(holes, cut).count()


def test_split_equals_uncut(skewed, cut):
    assert rows_of(split.time_split(skewed, 0.85, cut)) == rows_of(split.time_split(skewed, 0.85))


def test_positions(skewed, cut):
    got = with_position(skewed, cut).groupBy("stock_symbol").agg(
        F.countDistinct("_pos").alias("n"), F.min("_pos").alias("a"), F.max("_pos").alias("b"), F.max("_size").alias("s")
    )
    for r in got.collect():
        assert r.a == 1 and r.n == r.b == r.s


def test_chain_equals_uncut(skewed):
    cut = measure(skewed, rows_per_task=60)

    def chain(layout):
        kept = quality.validate(skewed, layout)
        return split.time_split(feat.clean_features(feat.add_features(kept, layout=layout)), 0.85, layout)

    assert rows_of(chain(cut)) == rows_of(chain(None))


def test_clock_orders_like_the_column(spark):
    texts = ["1950-03-01 00:00:00.000001", "1970-01-01 00:00:00", "2024-03-10 02:30:00", "2024-03-10 03:00:00"]
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind))
        values = [r[0] for r in df.select(clock(df, "t").alias("c")).orderBy("t").collect()]
        assert values == sorted(values)
    df = spark.createDataFrame([(texts[0],)], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert df.select((clock(df, "t") % 1_000_000).alias("c")).first()[0] in (1, 1 - 1_000_000)


def test_other_key_names(spark):
    df = panel(spark, {"A": 40, "B": 3}).withColumnsRenamed({"stock_symbol": "who", "Date": "at"})
    keys = Keys("who", "at")
    layout = measure(df, keys, rows_per_task=10)
    assert rows_of(feat.add_features(df, layout=layout, keys=keys)) == rows_of(feat.add_features(df, keys=keys))


def test_layout_defaults():
    assert Layout(5).fits_one_task and not Layout(5, rows_per_task=4).fits_one_task
