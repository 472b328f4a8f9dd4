"""Save and load fitted scalers and models."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.regression import GBTRegressionModel


def save_fitted(fitted, path: str) -> str:
    fitted.write().overwrite().save(path)
    return path


def _load(kind, path: str):
    try:
        return kind.load(path)
    except (Py4JJavaError, AnalysisException) as error:
        raise FileNotFoundError(f"no {kind.__name__} at {path}") from error


def load_scaler(path: str) -> StandardScalerModel:
    return _load(StandardScalerModel, path)


def load_gbt(path: str) -> GBTRegressionModel:
    return _load(GBTRegressionModel, path)
