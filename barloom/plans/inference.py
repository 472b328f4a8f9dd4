"""Scoring of the newest bars with a stored model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.config import PipelineConfig
from barloom.operators.features import add_features, clean_features, lookback, model_features
from barloom.operators.forecast import predict_price, prediction_summary, with_direction
from barloom.operators.model import score
from barloom.operators.runs import model_versions, select_latest_run
from barloom.operators.scaling import assemble
from barloom.operators.split import latest_n, latest_one
from barloom.schema import KEYS, PREDICTIONS, Keys
from barloom.sources.models import load_gbt, load_scaler
from barloom.sources.slices import read_newest
from barloom.sources.tables import export_csv, read_run, read_table, write_run


def inference_rows(
    panel: DataFrame, cfg: PipelineConfig | None = None, require_target: bool = False, keys: Keys = KEYS
) -> DataFrame:
    """Complete feature rows of the newest ``sequence_length`` bars of each entity.

    Features are computed with as many earlier bars as their windows reach back, so none is cut short. The newest
    bar has no target yet and is kept; ``require_target=True`` drops it. Histories are short here, so no piece
    layout is needed.
    """
    cfg = cfg or PipelineConfig()
    recent = latest_n(panel, cfg.sequence_length + lookback(cfg.features), keys, rank="_age")
    built = add_features(recent, cfg.features, keys=keys).filter(F.col("_age") <= cfg.sequence_length).drop("_age")
    return clean_features(built, cfg.features, require_target)


def newest_panel(spark: SparkSession, table: str, cfg: PipelineConfig | None = None, keys: Keys = KEYS) -> DataFrame:
    """The part of a sliced table that inference reads: slices without newest bars are not opened."""
    cfg = cfg or PipelineConfig()
    return read_newest(spark, table, cfg.sequence_length + lookback(cfg.features), keys)


def inference_set(
    panel: DataFrame,
    scaler: StandardScalerModel,
    names: list[str] | None = None,
    cfg: PipelineConfig | None = None,
    require_target: bool = False,
    keys: Keys = KEYS,
) -> DataFrame:
    cfg = cfg or PipelineConfig()
    rows = inference_rows(panel, cfg, require_target, keys)
    return scaler.transform(assemble(rows, names or model_features(cfg.features)))


@dataclass
class InferenceRun:
    predictions: DataFrame
    summary: DataFrame


def run_inference(
    spark: SparkSession,
    panel: DataFrame,
    folder: str,
    cfg: PipelineConfig | None = None,
    run_id: str | None = None,
    require_target: bool = False,
    keys: Keys = KEYS,
) -> InferenceRun:
    """Load the selected model of ``folder``, predict the newest bar of each entity, store and export.

    A repeated run replaces its stored predictions. Pass ``newest_panel`` of a sliced table to read no more history
    than the windows of the newest bars need.
    """
    started = datetime.now()
    run_id = run_id or started.strftime("%Y%m%d_%H%M%S")
    runs = read_table(spark, f"{folder}/runs")
    name = (cfg or PipelineConfig()).model_name
    chosen = select_latest_run(model_versions(runs), name=name).first()
    if chosen is None:
        raise FileNotFoundError(f"no model {name} is registered in {folder}/runs")
    model = load_gbt(chosen.path)
    scaler = load_scaler(f"{folder}/feature_scaler/{chosen.run_id}")
    names_row = runs.filter((F.col("run_id") == chosen.run_id) & (F.col("key") == "feature_names")).first()
    names = names_row.text.split(",")
    newest = latest_one(inference_rows(panel, cfg, require_target, keys).select(*keys.pair, "Close", *names), keys)
    scored = score(model, scaler.transform(assemble(newest, names)).select(*keys.pair, "Close", "features"))
    fresh = predict_price(scored, keys).withColumn("timestamp", F.lit(started).cast("timestamp"))
    stored = fresh.withColumns(
        {f.name: F.col(f.name).cast(f.dataType) for f in PREDICTIONS if f.name in fresh.columns}
    )
    if write_run(stored.withColumn("run_id", F.lit(run_id)), f"{folder}/predictions", run_id):
        stored = read_run(spark, f"{folder}/predictions", run_id).drop("run_id")
        export_csv(stored, f"{folder}/inference", run_id, single_file=False)
    return InferenceRun(with_direction(stored), prediction_summary(stored))
