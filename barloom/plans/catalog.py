"""Every operator as a named query over the test tables: ``name -> fn(spark, folder)``.

All queries read whole tables. Their layouts are measured on the source tables, so a
supplier, user or event type that holds a large share of the rows is cut into pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.config import FeatureConfig, PipelineConfig, StoppingConfig, TuningConfig
from barloom.functions.columns import change, ratio_minus_one
from barloom.functions.layout import over_history
from barloom.operators import correlation as corr
from barloom.operators import diagnostics as diag
from barloom.operators import features as feat
from barloom.operators import forecast, metrics, model, moments, quality, runs, sampling, scaling, split
from barloom.plans import inference, ingest, training
from barloom.plans.panels import PANELS, layout_of, load, raw_text
from barloom.schema import SUMMARY_COLUMNS
from barloom.sources import models, slices, tables
from barloom.sources.csv_panel import read_panel
from barloom.sources.staging import stage_table, work_path, write_shared

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["stock_symbol", "Date"]
MEANS = ["ma_5", "ma_10", "ma_20"]
TOP25 = FeatureConfig(max_features=25)
ALL = FeatureConfig()
DIR_NAME = r"stock_symbol=([^/]+)/"

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def catalog() -> dict[str, Query]:
    return dict(_queries)


# Shared inputs and output form


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles in the form two engines agree on: rounded, negative zero as zero.

    Moving averages of prices fall on decimal ties, and sums differ in their last bit between engines: they are cut
    to steps of 1e-4 whose borders lie off the ties.
    """

    def shown(name: str) -> Column:
        if name in MEANS:
            return F.floor(F.col(name) * 10_000 + 0.637) / 10_000
        return F.round(F.col(name), digits)

    return df.select(
        [
            (shown(f.name) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def rounded_scores(df: DataFrame) -> DataFrame:
    """``rounded`` for standardised columns: the same digits, the six without a decimal number a cell."""

    def shown(name: str) -> Column:
        if name in MEANS:
            return F.floor(F.col(name) * 10_000 + 0.637) / 10_000
        return F.rint(F.col(name) * 1_000_000) / 1_000_000

    return df.select(
        [(shown(f.name) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema]
    )


def bars(spark: SparkSession, folder: str, panel: str = "panel_daily") -> DataFrame:
    return PANELS[panel](spark, folder)


def valid(spark: SparkSession, folder: str, panel: str = "panel_daily") -> DataFrame:
    layout = layout_of(spark, folder, panel)
    return quality.validate(bars(spark, folder, panel), layout)


def featured(spark: SparkSession, folder: str, panel: str = "panel_daily") -> DataFrame:
    layout = layout_of(spark, folder, panel)
    return feat.add_features(valid(spark, folder, panel), ALL, layout)


def cleaned(spark: SparkSession, folder: str, panel: str = "panel_daily") -> DataFrame:
    return feat.clean_features(featured(spark, folder, panel))


def parted(spark: SparkSession, folder: str, panel: str = "panel_daily") -> DataFrame:
    layout = layout_of(spark, folder, panel)
    return split.time_split(cleaned(spark, folder, panel), 0.85, layout)


def complete(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Staged complete feature rows, for statistics that take more than one pass."""
    return stage_table(cleaned(spark, folder).select(names))


def scored(spark: SparkSession, folder: str, panel: str = "panel_daily", part: str = split.TEST) -> DataFrame:
    """Test rows with a prediction that is itself a feature, so every diagnostic has an exact answer."""
    rows = split.part(parted(spark, folder, panel), part)
    return rows.select(*KEY, "Close", "target", F.col("close_vs_ma5").alias("prediction"))


def errors(spark: SparkSession, folder: str) -> DataFrame:
    """Residuals on staged test rows, for tables that read them more than once."""
    return diag.residuals(stage_table(scored(spark, folder)))


# Casts, validation, summary


@query
def clean_casts(spark, folder):
    return rounded(quality.clean_casts(raw_text(spark, folder), time_type="timestamp_ntz"))


@query
def drop_null_critical(spark, folder):
    typed = quality.clean_casts(raw_text(spark, folder), time_type="timestamp_ntz")
    return rounded(quality.drop_null_critical(typed).select("event_id", *KEY, "Close", "Volume"))


@query
def drop_invalid_price(spark, folder):
    return rounded(quality.drop_invalid_price(bars(spark, folder, "panel_edge")))


@query
def outlier_rule(spark, folder):
    layout = layout_of(spark, folder, "panel_daily")
    return rounded(quality.drop_outliers(bars(spark, folder), layout).select(*KEY, "Close", "Volume"))


@query
def validate_daily(spark, folder):
    return rounded(valid(spark, folder))


@query
def validate_hourly(spark, folder):
    return rounded(valid(spark, folder, "panel_hourly"))


@query
def validate_edge(spark, folder):
    return rounded(valid(spark, folder, "panel_edge"))


@query
def removed_counts(spark, folder):
    typed = quality.clean_casts(raw_text(spark, folder), time_type="timestamp_ntz")
    return quality.removed_counts(typed, layout_of(spark, folder, "panel_edge"))


@query
def literal_entity(spark, folder):
    one = bars(spark, folder, "panel_edge").drop("stock_symbol").select("Date", "Close")
    return rounded(quality.with_entity(one, "acme"))


@query
def sorted_panel(spark, folder):
    return rounded(quality.distribute(bars(spark, folder)).select(*KEY, "Close"))


@query
def rows_per_symbol(spark, folder):
    return quality.rows_per_entity(valid(spark, folder))


@query
def date_range(spark, folder):
    return quality.date_range(valid(spark, folder))


@query
def describe_panel(spark, folder):
    return rounded(quality.describe_panel(valid(spark, folder)), 4)


@query
def total_rows(spark, folder):
    return quality.total_rows(valid(spark, folder))


@query
def distinct_symbols(spark, folder):
    return quality.distinct_entities(bars(spark, folder))


@query
def count_symbols(spark, folder):
    return quality.count_entities(bars(spark, folder, "panel_edge"))


@query
def union_panels(spark, folder):
    hourly = bars(spark, folder, "panel_hourly").drop("Adj_Close")
    return rounded(quality.combine_panels(hourly, bars(spark, folder, "panel_edge").drop("News_flag")))


# Windows


@query
def lag_lead(spark, folder):
    def add(df, w):
        lags = {f"close_lag_{n}": feat.lagged("Close", n, w) for n in (1, 2, 3, 5)}
        return df.withColumns({**lags, "close_lead_1": F.lead("Close", 1).over(w)})

    out = over_history(valid(spark, folder), add, 5, 1, layout_of(spark, folder, "panel_daily"))
    return rounded(out.select(*KEY, *[f"close_lag_{n}" for n in (1, 2, 3, 5)], "close_lead_1"))


def _rolling(spark, folder, columns, back, panel="panel_daily"):
    def add(df, w):
        return df.withColumns({name: make(w) for name, make in columns.items()})

    out = over_history(valid(spark, folder, panel), add, back, 0, layout_of(spark, folder, panel))
    return rounded(out.select(*KEY, *columns))


@query
def rolling_mean(spark, folder):
    columns = {f"ma_{n}": lambda w, n=n: feat.rolling_mean("Close", n, w) for n in (5, 10, 20)}
    columns |= {f"volume_ma_{n}": lambda w, n=n: feat.rolling_mean("Volume", n, w) for n in (5, 20)}
    return _rolling(spark, folder, columns, 19)


@query
def rolling_stddev(spark, folder):
    columns = {f"sd_{n}": lambda w, n=n: feat.rolling_stddev("Scaled_sentiment", n, w) for n in (5, 10)}
    return _rolling(spark, folder, columns, 9, "panel_hourly")


@query
def rolling_minmax(spark, folder):
    columns = {
        "high_5d": lambda w: feat.rolling_max("High", 5, w),
        "low_5d": lambda w: feat.rolling_min("Low", 5, w),
    }
    return _rolling(spark, folder, columns, 4)


@query
def pct_change(spark, folder):
    columns = {
        "price_change_1d": lambda w: change(F.col("Close"), feat.lagged("Close", 1, w)),
        "close_normalized_vs_lag5": lambda w: ratio_minus_one(F.col("Close"), feat.lagged("Close", 5, w)),
        "sentiment_change_3d": lambda w: F.col("Scaled_sentiment") - feat.lagged("Scaled_sentiment", 3, w),
    }
    return _rolling(spark, folder, columns, 5, "panel_edge")


@query
def ratio_to_ma(spark, folder):
    columns = {
        "close_vs_ma10": lambda w: ratio_minus_one(F.col("Close"), feat.rolling_mean("Close", 10, w)),
        "volume_vs_ma5": lambda w: ratio_minus_one(F.col("Volume"), feat.rolling_mean("Volume", 5, w)),
    }
    return _rolling(spark, folder, columns, 9, "panel_edge")


@query
def feat_price(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.price_names()))


@query
def feat_volume(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.volume_names()))


@query
def feat_sentiment(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.sentiment_names()))


@query
def feat_technical(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.technical_names(), *feat.HELPERS))


@query
def feat_interaction(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.interaction_names()))


@query
def feat_volatility(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.volatility_names()))


@query
def target_next(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, "Close", "target"))


@query
def features_all(spark, folder):
    return rounded(featured(spark, folder).select(*KEY, *feat.feature_names(), "target"))


@query
def features_all_hourly(spark, folder):
    return rounded(featured(spark, folder, "panel_hourly").select(*KEY, *feat.feature_names(), "target"))


@query
def features_all_edge(spark, folder):
    return rounded(featured(spark, folder, "panel_edge").select(*KEY, *feat.feature_names(), "target"))


@query
def features_clean(spark, folder):
    return rounded(cleaned(spark, folder, "panel_edge").select(*KEY, *feat.feature_names(), "target"))


@query
def features_top25(spark, folder):
    return rounded(cleaned(spark, folder).select(*KEY, *feat.model_features(TOP25), "target"))


# Split, newest rows


@query
def time_split(spark, folder):
    return parted(spark, folder).select(*KEY, "split")


@query
def split_sizes(spark, folder):
    return split.split_sizes(parted(spark, folder))


@query
def test_rows(spark, folder):
    return rounded(split.part(parted(spark, folder, "panel_hourly"), split.TEST).select(*KEY, "Close", "target"))


@query
def latest_n(spark, folder):
    return rounded(split.latest_n(bars(spark, folder), 50).select(*KEY, "Close", "Volume"))


@query
def latest_1(spark, folder):
    return rounded(split.latest_one(bars(spark, folder)).select(*KEY, "Close", "Volume"))


# Scaling, correlation, sampling


@query
def scale_train_stats(spark, folder):
    return rounded(scaling.train_stats(parted(spark, folder), feat.model_features()))


@query
def scale_merged_stats(spark, folder):
    """Scaler figures from moments stored per year of the training rows and merged."""
    names = feat.feature_names()
    rows = split.part(parted(spark, folder), split.TRAIN).withColumn("year", F.year("Date"))
    stored, _ = write_shared(moments.moments(rows, names, ["year"]), "moments")
    return rounded(moments.stats(moments.merge(stored)))


@query
def describe_merged(spark, folder):
    """The panel's summary figures from moments stored per symbol and merged."""
    stored, _ = write_shared(moments.moments(valid(spark, folder), SUMMARY_COLUMNS, ["stock_symbol"]), "moments")
    return rounded(moments.describe(moments.merge(stored)))


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """Staged complete feature rows with their split; combinations of other columns are not stored."""
    rows = stage_table(parted(spark, folder).select(*KEY, "split", *feat.stored_names()))
    return feat.derive_features(rows).select(*KEY, "split", *feat.feature_names())


@query
def scaled_features(spark, folder):
    names = feat.model_features()
    return rounded_scores(scaling.scale_columns(_stored_features(spark, folder), names).select(*KEY, "split", *names))


@query
def scaled_vectors(spark, folder):
    names = feat.model_features()
    vectors, _ = scaling.feature_vectors(_stored_features(spark, folder), names)
    values = vectors.select(*KEY, "split", vector_to_array("features").alias("_v"))  # on its own: made once a row, not once a cell
    return rounded_scores(values.select(*KEY, "split", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)]))


@query
def corr_long(spark, folder):
    names = feat.feature_names()
    return rounded(corr.correlation(complete(spark, folder, names), names).drop("i", "j"))


@query
def corr_lower(spark, folder):
    names = feat.model_features()
    full = corr.correlation(complete(spark, folder, names), names)
    return rounded(corr.lower_triangle(full).drop("i", "j"))


@query
def corr_pairwise(spark, folder):
    names = ["price_change_1d", "volume_change_1d", "sentiment_change_1d", "momentum_ratio", "target"]
    return rounded(corr.pairwise_correlation(featured(spark, folder), names).drop("i", "j"))


@query
def corr_pairwise_all(spark, folder):
    """All features before cleaning: each pair over the rows where both are known."""
    names = feat.feature_names()
    rows = stage_table(featured(spark, folder).select(feat.stored_names()))
    return rounded(corr.pairwise_correlation(feat.derive_features(rows), names).drop("i", "j"))


@query
def corr_prune(spark, folder):
    names = feat.feature_names()
    return corr.prune_table(corr.correlation(complete(spark, folder, names), names), ALL.correlation_threshold)


@query
def sample_md5(spark, folder):
    return sampling.sample_n(bars(spark, folder), KEY, 1000).select(*KEY)


@query
def sample_fraction(spark, folder):
    return sampling.sample_fraction(bars(spark, folder), KEY, 0.3).select(*KEY)


# Metrics and diagnostics


@query
def metrics_overall(spark, folder):
    rows = parted(spark, folder).withColumn("prediction", F.col("close_vs_ma5"))
    return rounded(metrics.metrics(rows, ["split"]))


@query
def metrics_per_symbol(spark, folder):
    return rounded(metrics.entity_metrics(scored(spark, folder)))


@query
def residuals(spark, folder):
    rows = diag.residuals(scored(spark, folder))
    return rounded(rows.select(*KEY, "target", "prediction", "residual", "abs_error"))


@query
def axis_bounds(spark, folder):
    return rounded(diag.axis_bounds(scored(spark, folder)))


@query
def hist_actual(spark, folder):
    return rounded(diag.histogram(errors(spark, folder), "target"))


@query
def hist_predicted(spark, folder):
    return rounded(diag.histogram(errors(spark, folder), "prediction"))


@query
def hist_residual(spark, folder):
    return rounded(diag.histogram(errors(spark, folder), "residual"))


@query
def hist_abs_error(spark, folder):
    return rounded(diag.histogram(errors(spark, folder), "abs_error"))


@query
def normal_overlay(spark, folder):
    return rounded(diag.normal_overlay(diag.residuals(scored(spark, folder))))


@query
def qq_points(spark, folder):
    return rounded(diag.qq_points(errors(spark, folder), layout=layout_of(spark, folder, "panel_daily")))


@query
def box_per_symbol(spark, folder):
    return rounded(diag.box_per_entity(errors(spark, folder), layout=layout_of(spark, folder, "panel_daily")))


@query
def residual_stats(spark, folder):
    return rounded(diag.residual_stats(errors(spark, folder), layout=layout_of(spark, folder, "panel_daily")))


@query
def sampled_fit(spark, folder):
    sample = sampling.sample_n(scored(spark, folder), KEY, 1000)
    return rounded(metrics.metrics(sample).select("r2", "mae", "sample_count"))


@query
def per_symbol_ratio(spark, folder):
    table = metrics.entity_metrics(stage_table(scored(spark, folder)))
    return rounded(metrics.relative_to_best(table, ["mae", "mse", "r2"]))


@query
def model_comparison_pivot(spark, folder):
    """Three moving-average predictors compared as models."""
    names = ["close_vs_ma5", "close_vs_ma10", "close_vs_ma20"]
    rows = stage_table(split.part(parted(spark, folder), split.TEST).select("target", *names))
    long = rows.unpivot(["target"], names, "model", "prediction")
    return rounded(metrics.compare_models(metrics.metric_rows(metrics.metrics(long, ["model"]), ["model"])))


# Forecasts


@query
def predict_price(spark, folder):
    return rounded(forecast.predict_price(scored(spark, folder)))


@query
def latest_predictions(spark, folder):
    return rounded(forecast.latest_predictions(scored(spark, folder)))


@query
def direction(spark, folder):
    return rounded(forecast.with_direction(forecast.latest_predictions(scored(spark, folder))))


@query
def prediction_summary(spark, folder):
    return rounded(forecast.prediction_summary(forecast.latest_predictions(scored(spark, folder))))


@query
def inference_features(spark, folder):
    """Newest complete bars in the scale of the training rows, in column form."""
    names = feat.model_features()
    rows = inference.inference_rows(valid(spark, folder))
    return rounded(scaling.scale_columns(rows, names, fitted_on=parted(spark, folder)).select(*KEY, *names))


@query
def inference_features_with_target(spark, folder):
    """The same features, restricted to bars whose next bar is known."""
    rows = inference.inference_rows(valid(spark, folder, "panel_hourly"), require_target=True)
    return rounded(rows.select(*KEY, *feat.model_features(), "target"))


# Run bookkeeping, on orders read as a history of model versions


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    stage_of = F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "P", "Staging")
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderpriority").alias("name"),
        stage_of.alias("stage"),
        F.col("o_custkey").cast("double").alias("version"),
    )


@query
def select_latest_run(spark, folder):
    return runs.select_latest_run(_versions(spark, folder))


@query
def select_latest_per_model(spark, folder):
    return runs.select_latest_run(_versions(spark, folder), by=["name"])


@query
def run_stamps(spark, folder):
    """Start times as the stamps that name runs and exports."""
    stamp = forecast.run_stamp(F.col("started_at")).alias("stamp")
    return _versions(spark, folder).select("run_id", stamp)


@query
def run_log_append(spark, folder):
    """Metrics of two runs appended to one table and read back."""
    path = work_path(spark, "runs")
    for run_id, part in (("a", split.TRAIN), ("b", split.TEST)):
        table = metrics.metrics(scored(spark, folder, part=part))
        tables.write_append(runs.log_metrics(table, run_id, datetime(2024, 1, 1), part), path)
    return rounded(tables.read_table(spark, path).select("run_id", "kind", "key", "value"))


@query
def run_log_entities(spark, folder):
    table = metrics.entity_metrics(scored(spark, folder))
    return rounded(runs.log_entity_metrics(table, "a", datetime(2024, 1, 1)).select("run_id", "kind", "key", "value"))


# Sources and sinks


def _as_csv(spark: SparkSession, folder: str, panel: str) -> str:
    """Write a panel as text files, one folder per entity, and return the path."""
    path = work_path(spark, "csv")
    text = bars(spark, folder, panel).withColumnRenamed("Adj_Close", "Adj close")
    ready = text.repartitionByRange("stock_symbol", "Date")
    ready.write.mode("overwrite").partitionBy("stock_symbol").option("header", True).csv(path)
    return path


@query
def csv_roundtrip(spark, folder):
    """Many entities: a bounded number of files with the entity as a column."""
    path = work_path(spark, "csv")
    text = bars(spark, folder).withColumnRenamed("Adj_Close", "Adj close")
    text.write.mode("overwrite").option("header", True).csv(path)
    return rounded(read_panel(spark, path, None, "timestamp_ntz"))


@query
def ingest_csv(spark, folder):
    """CSV to validated table; the second call finds the table and only reads it."""
    source, table = _as_csv(spark, folder, "panel_hourly"), work_path(spark, "panel")
    options = {"entity_pattern": DIR_NAME, "time_type": "timestamp_ntz"}
    ingest.ingest_if_missing(spark, source, table, **options)
    return rounded(ingest.ingest_if_missing(spark, source, table, **options))


@query
def ingest_incremental(spark, folder):
    """Files of one symbol change between two calls; the second parses these alone and gives the panel of all files."""
    table = work_path(spark, "panel")
    source = _as_csv(spark, folder, "panel_hourly")
    first = bars(spark, folder, "panel_hourly").agg(F.min("stock_symbol")).first()[0]
    stale = f"{work_path(spark, 'stale')}/csv"
    text = bars(spark, folder, "panel_hourly").withColumnRenamed("Adj_Close", "Adj close")
    held = (F.col("stock_symbol") != first) | (F.col("Volume") > 1)
    text.where(held).repartitionByRange("stock_symbol").write.partitionBy("stock_symbol").option("header", True).csv(stale)
    options = {"entity_pattern": DIR_NAME, "time_type": "timestamp_ntz", "buckets": 8}
    ingest.ingest_changed(spark, stale, table, **options)
    own = f"stock_symbol={first}"
    fresh = spark.read.option("header", True).csv(f"{source}/{own}")
    fresh.write.mode("overwrite").option("header", True).csv(f"{stale}/{own}")
    again = ingest.ingest_changed(spark, stale, table, **options)
    parsed = F.lit(all(f"/{own}/" in f for f in again.files) and again.entities == 1)
    return rounded(again.panel.withColumn("one_parsed", parsed))


@query
def table_overwrite(spark, folder):
    """A table overwritten by one with another schema."""
    path = work_path(spark, "panel")
    tables.write_panel(bars(spark, folder, "panel_hourly"), path)
    tables.write_panel(valid(spark, folder).select(*KEY, "Close", "Volume"), path)
    return rounded(tables.read_table(spark, path))


@query
def table_append(spark, folder):
    """Two appends and an empty one, which writes nothing."""
    path = work_path(spark, "predictions")
    records = forecast.latest_predictions(scored(spark, folder))
    hourly = forecast.latest_predictions(scored(spark, folder, "panel_hourly"))
    tables.write_append(records, path)
    tables.write_append(hourly, path)
    tables.write_append(hourly.filter(F.col("current_price") < 0), path)
    return rounded(tables.read_table(spark, path))


@query
def table_append_repeated(spark, folder):
    """Two runs stored in one table, each of them twice; a repeated run replaces its own rows."""
    path = work_path(spark, "predictions")
    rows = {panel: stage_table(scored(spark, folder, panel)) for panel in ("panel_daily", "panel_hourly")}
    for panel in ("panel_daily", "panel_hourly", "panel_daily", "panel_hourly"):
        records = forecast.latest_predictions(rows[panel])
        tables.write_run(records.withColumn("run_id", F.lit(panel)), path, panel)
    daily, hourly = (tables.read_run(spark, path, panel) for panel in ("panel_daily", "panel_hourly"))
    return rounded(daily.unionByName(hourly))


@query
def table_replace_itself(spark, folder):
    """A stored panel overwritten by its own first half of columns; the old table is read until the new one is whole."""
    path = work_path(spark, "panel")
    tables.write_panel(valid(spark, folder, "panel_hourly"), path)
    kept = tables.read_table(spark, path).select(*KEY, "Close", "Volume").where(F.col("Volume") > 1)
    tables.write_panel(kept, path)
    return rounded(tables.read_table(spark, path))


@query
def slices_newest(spark, folder):
    """The newest 50 bars of every symbol from a table in slices of time, later rows added in a second write."""
    path = work_path(spark, "slices")
    rows = valid(spark, folder)
    late = F.year("Date") >= 1998
    slices.write_slices(rows.where(~late), path, rows_per_slice=max(1, rows.count() // 8))
    slices.write_slices(rows.where(late), path)
    return rounded(split.latest_n(slices.read_newest(spark, path, 50), 50))


@query
def predictions_export(spark, folder):
    """The three result tables of a run exported as CSV and read back, in one long table."""
    rows = stage_table(scored(spark, folder))
    per_entity = metrics.entity_metrics(rows)
    fitted, data = _fitted(spark, folder)
    top = model.importance(fitted, data.names, data.frame)
    paths = tables.export_run(work_path(spark, "results"), "a", top, per_entity, rows)

    def again(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("header", True).csv(paths[name])

    predictions = again(
        "test_predictions", "stock_symbol string, date timestamp_ntz, true_value double, predicted_value double"
    )
    by_entity = again("per_entity_metrics", "stock_symbol string, mae double, mse double, r2 double, sample_count long")
    features = again("feature_importance", "rank int, feature string, importance double")
    nothing = F.lit(None).cast("timestamp_ntz").alias("date")
    return rounded(
        predictions.select(F.lit("prediction").alias("part"), F.col("stock_symbol").alias("name"), "date",
                           F.col("true_value").alias("x"), F.col("predicted_value").alias("y"))
        .unionByName(by_entity.select(F.lit("entity").alias("part"), F.col("stock_symbol").alias("name"), nothing,
                                      F.col("mae").alias("x"), F.col("r2").alias("y")))
        .unionByName(features.select(F.lit("feature").alias("part"), F.col("feature").alias("name"), nothing,
                                     F.col("importance").between(0, 1).cast("double").alias("x"), F.lit(None).cast("double").alias("y")))
    )


# Models. Few small trees keep these short; they run over the whole panel and all features all the same. Scores of a
# fit have no SQL: each query returns what SQL can say about its result, and tests check the scores.

SMALL_GBT = {
    "maxIter": 5,
    "maxDepth": 4,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "sqrt",
    "seed": 42,
}
SMALL_RANGES = {"maxIter": [2, 3], "maxDepth": [2, 3], "stepSize": [0.1, 0.2]}
SMALL = PipelineConfig(gbt=SMALL_GBT)


def _training_set(spark: SparkSession, folder: str, select: str = "first") -> training.TrainingSet:
    panel = valid(spark, folder)
    return training.training_set(panel, SMALL, layout_of(spark, folder, "panel_daily"), select)


def _rows(data: training.TrainingSet) -> DataFrame:
    """Training rows for a search or fit that deals them itself where they have no layout yet."""
    return data.laid() if data.buckets else data.train


def _fitted(spark: SparkSession, folder: str):
    data = _training_set(spark, folder)
    return model.fit_gbt(data.laid(), SMALL_GBT, data.thin), data


def _importances(fitted, data: training.TrainingSet) -> DataFrame:
    """Feature names with whether each weight is a share, and whether the shares sum to one."""
    table = model.importance(fitted, data.names, data.frame)
    total = F.sum("importance").over(Window.partitionBy())
    return table.select(
        "feature", F.col("importance").between(0, 1).alias("valid"), (F.abs(total - 1) < 1e-9).alias("sums_to_one")
    )


def _candidates(result: model.SearchResult, df: DataFrame) -> DataFrame:
    """Candidates with whether each was scored, and the number of winners."""
    best = F.sum(F.col("best").cast("long")).over(Window.partitionBy())
    return result.table(df).select("params", F.col("score").isNotNull().alias("scored"), best.alias("n_best"))


@query
def gbt_fit_score(spark, folder):
    """Rows and spread of the target by split, and whether the fit beats the mean on the rows it saw."""
    fitted, data = _fitted(spark, folder)
    scored_rows = model.score(fitted, data.frame)
    error = F.avg((F.col("target") - F.col("prediction")) ** 2)
    table = scored_rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("target").alias("spread"), error.alias("_mse")
    )
    beats = F.when(F.col("split") == split.TRAIN, F.col("_mse") < F.col("spread"))
    return rounded(table.select("split", "n", "spread", beats.alias("beats_mean")))


@query
def gbt_importance(spark, folder):
    return _importances(*_fitted(spark, folder))


@query
def gbt_pruned_features(spark, folder):
    """Importance over features chosen by correlation instead of by order."""
    data = _training_set(spark, folder, select="corr")
    return _importances(model.fit_gbt(data.laid(), SMALL_GBT, data.thin), data)


@query
def gbt_reload(spark, folder):
    """Largest difference between a model's predictions and those of its reloaded copy."""
    fitted, data = _fitted(spark, folder)
    again = models.load_gbt(models.save_fitted(fitted, work_path(spark, "model")))
    scaler = models.load_scaler(models.save_fitted(data.scaler, work_path(spark, "scaler")))
    both = again.setPredictionCol("reloaded").transform(model.score(fitted, data.test))
    gap = F.max(F.abs(F.col("prediction") - F.col("reloaded")))
    same_scaler = scaler.mean == data.scaler.mean and scaler.std == data.scaler.std
    return both.agg(gap.alias("largest_gap"), F.count(F.lit(1)).alias("n")).withColumn(
        "same_scaler", F.lit(bool(same_scaler))
    )


@query
def cv_grid(spark, folder):
    data = _training_set(spark, folder)
    cfg = TuningConfig(ranges=SMALL_RANGES, folds=3)
    return _candidates(model.tune(data.laid(), cfg, data.layout, dealt=bool(data.buckets), thin=data.thin), data.frame)


@query
def cv_time_folds(spark, folder):
    """The same grid, each block of time judged by a fit on the blocks before it."""
    data = _training_set(spark, folder)
    cfg = TuningConfig(ranges=SMALL_RANGES, folds=2, fold_kind="time")
    return _candidates(model.tune(_rows(data), cfg, data.layout, dealt=bool(data.buckets), thin=data.thin), data.frame)


def _counted(found: model.SearchResult, df: DataFrame, cfg: TuningConfig) -> DataFrame:
    """How many candidates of a search over ``cfg.ranges`` were scored, differ, lie in the ranges and won."""
    table = found.table(df)
    pairs = F.transform(F.split("params", ","), lambda p: F.split(p, "=")[1])
    known = [F.col("_v")[i].isin([str(v) for v in values]) for i, values in enumerate(cfg.ranges.values())]
    fits = reduce(lambda a, b: a & b, known)
    return table.withColumn("_v", pairs).agg(
        F.count("score").alias("n_scored"), F.countDistinct("params").alias("n_distinct"),
        F.count_if(fits).alias("n_in_range"), F.count_if("best").alias("n_best"),
    )


@query
def random_search(spark, folder):
    """The default number of draws from the whole default ranges."""
    data = _training_set(spark, folder)
    cfg = TuningConfig(method="random", parallelism=10)
    return _counted(model.tune(_rows(data), cfg, data.layout, dealt=bool(data.buckets), thin=data.thin), data.frame, cfg)


@query
def sequential_search(spark, folder):
    """The default number of trials over the whole default ranges, each chosen by the results of those before."""
    data = training.training_set(valid(spark, folder, "panel_hourly"), PipelineConfig(), layout_of(spark, folder, "panel_hourly"))
    cfg = TuningConfig(method="sequential", parallelism=5)
    return _counted(model.tune(_rows(data), cfg, data.layout, dealt=bool(data.buckets), thin=data.thin), data.frame, cfg)


@query
def gbt_early_stopping(spark, folder):
    """A fit that ends by the error on the end of each symbol's training rows; rows and gain as for ``gbt_fit_score``."""
    data = _training_set(spark, folder)
    fitted = model.fit_stopped(_rows(data), {**SMALL_GBT, "maxIter": 20}, StoppingConfig(share=0.1), data.layout, dealt=bool(data.buckets), thin=data.thin)
    rows = model.score(fitted, data.frame)
    table = rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("target").alias("spread"), F.avg((F.col("target") - F.col("prediction")) ** 2).alias("_mse")
    )
    beats = F.when(F.col("split") == split.TRAIN, F.col("_mse") < F.col("spread"))
    stopped = F.lit(1 <= fitted.getNumTrees <= 20)
    return rounded(table.select("split", "n", "spread", beats.alias("beats_mean"), stopped.alias("within_limit")))


@query
def inference_run(spark, folder):
    """Train, store and register a model, then predict the newest bar of every symbol with it."""
    home = work_path(spark, "home")
    tables.write_panel(valid(spark, folder), f"{home}/panel")
    panel = tables.read_table(spark, f"{home}/panel")
    training.train(panel, SMALL, home, run_id="run1", stage_name="Production")
    done = inference.run_inference(spark, panel, home, SMALL, run_id="infer1")
    return _priced(done)


def _priced(done: inference.InferenceRun) -> DataFrame:
    gap = F.abs(F.col("predicted_price") - F.col("current_price") * (1 + F.col("predicted_return")))
    return rounded(done.predictions.select("stock_symbol", "current_date", "current_price", (gap < 1e-6).alias("consistent")))


@query
def inference_sliced(spark, folder):
    """Feature rows for inference from a sliced table, of which only slices with newest bars are read."""
    path = work_path(spark, "slices")
    rows = valid(spark, folder)
    slices.write_slices(rows, path, rows_per_slice=max(1, rows.count() // 10))
    return rounded(inference.inference_rows(inference.newest_panel(spark, path), PipelineConfig()).select(*KEY, *feat.feature_names()))


@query
def inference_named(spark, folder):
    """Two models and their stages in one registry: each name gets its own production model, whatever is newer."""
    home = work_path(spark, "home")
    tables.write_panel(valid(spark, folder, "panel_hourly"), f"{home}/panel")
    panel = tables.read_table(spark, f"{home}/panel")
    for run_id, name, stage_name in (
        ("a1", "a", "Production"), ("a2", "a", "Archived"), ("b1", "b", None), ("b2", "b", "Staging"),
    ):
        training.train(panel, replace(SMALL, model_name=name), home, run_id=run_id, stage_name=stage_name)
    found = runs.model_versions(tables.read_table(spark, f"{home}/runs"))
    return runs.select_latest_run(found, by=["name"]).select("name", "run_id", "version", F.coalesce("stage", F.lit("None")).alias("stage"))


@query
def run_log_model(spark, folder):
    """Parameters, importance and model rows of a training run, as its log keeps them."""
    home = work_path(spark, "home")
    training.train(valid(spark, folder, "panel_hourly"), SMALL, home, run_id="r1", stage_name="Production")
    log = tables.read_table(spark, f"{home}/runs")
    counted = log.select(
        "kind",
        F.when(F.col("key").startswith("importance_"), "importance").otherwise(F.col("key")).alias("key"),
        F.when(~F.col("key").isin("path", "feature_names"), F.col("text")).alias("text"),
        F.when(F.col("kind").isin("param", "model"), F.col("value")).alias("value"),
    ).where("kind <> 'metric' or key = 'importance'")
    return rounded(counted.groupBy("kind", "key", "text", "value").agg(F.count(F.lit(1)).alias("n")))


@query
def validate_without_volume(spark, folder):
    """A panel that has no Volume column is validated by its other rules."""
    return rounded(quality.validate(bars(spark, folder, "panel_edge").drop("Volume")).select(*KEY, "Close"))
