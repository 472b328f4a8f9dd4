"""Settings that change results, as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# Default and search-space parameters of the boosted-tree model.
DEFAULT_GBT = {
    "maxIter": 150,
    "maxDepth": 8,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "sqrt",
    "seed": 42,
}
GBT_RANGES = {
    "maxIter": [100, 150, 200],
    "maxDepth": [6, 8, 10, 12],
    "stepSize": [0.01, 0.05, 0.1, 0.2],
    "subsamplingRate": [0.7, 0.8, 0.9],
    "featureSubsetStrategy": ["auto", "sqrt", "log2"],
}


# The defaults of the next three classes, but for the limits, which are off unless set.
@dataclass(frozen=True)
class FeatureConfig:
    """``max_features`` keeps the first names only; 0 keeps all."""

    price_lags: tuple[int, ...] = (1, 2, 3, 5)
    volume_lags: tuple[int, ...] = (1,)
    sentiment_lags: tuple[int, ...] = (1, 3)
    ma_windows: tuple[int, ...] = (5, 10, 20)
    enable_rsi: bool = True
    enable_volatility: bool = True
    enable_interactions: bool = True
    max_features: int = 0
    correlation_threshold: float = 0.95


@dataclass(frozen=True)
class SamplerConfig:
    """Sequential search: even draws at the start, then the best of ``candidates`` draws from the good trials.

    Good are ``good_share`` of the trials, at most ``most_good``; ``prior`` is the weight of an even trial.
    """

    startup: int = 5
    candidates: int = 24
    good_share: float = 0.1
    most_good: int = 25
    prior: float = 1.0


@dataclass(frozen=True)
class TuningConfig:
    """``method`` is ``spark_cv``, ``random`` or ``sequential``; ``fold_kind`` is ``random`` or ``time``.

    ``max_values`` and ``sample_fraction`` shrink a search on request.
    """

    enabled: bool = False
    method: str = "spark_cv"
    n_trials: int = 10
    metric: str = "mae"
    folds: int = 3
    sample_fraction: float = 1.0
    max_values: int | None = None
    fold_kind: str = "random"
    parallelism: int = 4
    seed: int = 42
    sampler: SamplerConfig = SamplerConfig()
    ranges: dict[str, list[Any]] = field(default_factory=lambda: dict(GBT_RANGES))


@dataclass(frozen=True)
class StoppingConfig:
    """Early stopping: the last ``share`` of each entity's training rows judge every tree. A share of 0 turns it off.

    Boosting ends when the error on them falls by less than ``tolerance`` of itself, or grows.
    """

    share: float = 0.0
    tolerance: float = 0.001


@dataclass(frozen=True)
class PipelineConfig:
    features: FeatureConfig = FeatureConfig()
    tuning: TuningConfig = field(default_factory=TuningConfig)
    gbt: dict[str, Any] = field(default_factory=lambda: dict(DEFAULT_GBT))
    stopping: StoppingConfig = StoppingConfig()
    train_ratio: float = 0.85
    sequence_length: int = 50
    model_name: str = "panel_gbt"
