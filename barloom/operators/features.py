"""Window features of a panel, declared as data and added in four projections.

Stage 1 reads the bars through windows, stage 2 combines stage 1 row by row, stage 3
runs windows over stage 2, stage 4 combines again. Each lag and each rolling value is
declared once and referred to by name, so Spark evaluates it once, and all windows
share one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from barloom.config import FeatureConfig
from barloom.functions.columns import all_not_null, change, guarded_ratio, ratio_minus_one
from barloom.functions.layout import Layout, over_history
from barloom.schema import KEYS, Keys

DEFAULTS = FeatureConfig()

# Lags and frame lengths that the feature definitions themselves use.
CHANGE_LAGS = (1, 3, 5)
VOLUME_WINDOWS = (5, 20)
SENTIMENT_WINDOWS = (5, 10, 20)
SENTIMENT_CHANGE_LAGS = (1, 3)
GAIN_WINDOW = 14
RANGE_WINDOW = 5
VOLATILITY_WINDOWS = (5, 10)

HELPERS = ["price_gain", "price_loss", "avg_gain_14", "avg_loss_14", "high_5d", "low_5d"]
TARGET = "target"


def price_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    return [
        *[f"close_lag_{n}" for n in cfg.price_lags],
        *[f"price_change_{n}d" for n in CHANGE_LAGS],
        *[name for n in cfg.ma_windows for name in (f"ma_{n}", f"close_vs_ma{n}")],
        "high_low_spread",
        "close_normalized_vs_lag1",
        "close_normalized_vs_lag5",
    ]


def volume_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    return [
        *[f"volume_lag_{n}" for n in cfg.volume_lags],
        *[f"volume_ma_{n}" for n in VOLUME_WINDOWS],
        "volume_change_1d",
        *[f"volume_vs_ma{n}" for n in VOLUME_WINDOWS],
        "volume_normalized_vs_lag1",
    ]


def sentiment_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    return [
        *[f"sentiment_lag_{n}" for n in cfg.sentiment_lags],
        *[f"sentiment_ma_{n}" for n in SENTIMENT_WINDOWS],
        *[f"sentiment_change_{n}d" for n in SENTIMENT_CHANGE_LAGS],
        "sentiment_volatility_5d",
    ]


def technical_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    return [*(["momentum_ratio"] if cfg.enable_rsi else []), "price_position_5d"]


def interaction_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    if not cfg.enable_interactions:
        return []
    return [
        "price_volume_interaction",
        "price_sentiment_interaction",
        "volume_sentiment_interaction",
        "price_volume_sentiment_interaction",
    ]


def volatility_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    if not cfg.enable_volatility:
        return []
    return [
        *[f"price_volatility_{n}d" for n in VOLATILITY_WINDOWS],
        "volume_volatility_5d",
        "volatility_ratio_5_10",
        "risk_adjusted_return",
    ]


def feature_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    """All feature names in declaration order."""
    groups = (price_names, volume_names, sentiment_names, technical_names, interaction_names, volatility_names)
    return [name for group in groups for name in group(cfg)]


def model_features(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    """The names that reach the model: the first ``max_features``, or all when it is not positive."""
    names = feature_names(cfg)
    return names[: cfg.max_features] if cfg.max_features > 0 else names


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, 0)


def lagged(column: str, n: int, w: WindowSpec) -> Column:
    return F.lag(column, n).over(w)


def rolling_mean(column: str, n: int, w: WindowSpec) -> Column:
    return F.avg(column).over(_frame(w, n))


def rolling_stddev(column: str, n: int, w: WindowSpec) -> Column:
    return F.stddev(column).over(_frame(w, n))


def rolling_max(column: str, n: int, w: WindowSpec) -> Column:
    return F.max(column).over(_frame(w, n))


def rolling_min(column: str, n: int, w: WindowSpec) -> Column:
    return F.min(column).over(_frame(w, n))


def _bar_windows(cfg: FeatureConfig, w: WindowSpec) -> dict[str, Column]:
    close_lags = sorted({*cfg.price_lags, *CHANGE_LAGS})
    volume_lags = sorted({*cfg.volume_lags, 1})
    sentiment_lags = sorted({*cfg.sentiment_lags, *SENTIMENT_CHANGE_LAGS})
    return {
        **{f"close_lag_{n}": lagged("Close", n, w) for n in close_lags},
        **{f"volume_lag_{n}": lagged("Volume", n, w) for n in volume_lags},
        **{f"sentiment_lag_{n}": lagged("Scaled_sentiment", n, w) for n in sentiment_lags},
        **{f"ma_{n}": rolling_mean("Close", n, w) for n in cfg.ma_windows},
        **{f"volume_ma_{n}": rolling_mean("Volume", n, w) for n in VOLUME_WINDOWS},
        **{f"sentiment_ma_{n}": rolling_mean("Scaled_sentiment", n, w) for n in SENTIMENT_WINDOWS},
        "sentiment_volatility_5d": rolling_stddev("Scaled_sentiment", 5, w),
        "high_5d": rolling_max("High", RANGE_WINDOW, w),
        "low_5d": rolling_min("Low", RANGE_WINDOW, w),
        "_next_close": F.lead("Close", 1).over(w),
    }


def _bar_ratios(cfg: FeatureConfig) -> dict[str, Column]:
    close, volume, sentiment = F.col("Close"), F.col("Volume"), F.col("Scaled_sentiment")
    return {
        **{f"price_change_{n}d": change(close, F.col(f"close_lag_{n}")) for n in CHANGE_LAGS},
        **{f"close_vs_ma{n}": ratio_minus_one(close, F.col(f"ma_{n}")) for n in cfg.ma_windows},
        **{f"close_normalized_vs_lag{n}": ratio_minus_one(close, F.col(f"close_lag_{n}")) for n in (1, 5)},
        "high_low_spread": F.try_divide(F.col("High") - F.col("Low"), close),
        "volume_change_1d": change(volume, F.col("volume_lag_1")),
        "volume_normalized_vs_lag1": ratio_minus_one(volume, F.col("volume_lag_1")),
        **{f"volume_vs_ma{n}": ratio_minus_one(volume, F.col(f"volume_ma_{n}")) for n in VOLUME_WINDOWS},
        **{f"sentiment_change_{n}d": sentiment - F.col(f"sentiment_lag_{n}") for n in SENTIMENT_CHANGE_LAGS},
        "price_position_5d": guarded_ratio(close - F.col("low_5d"), F.col("high_5d") - F.col("low_5d")),
        TARGET: ratio_minus_one(F.col("_next_close"), close),
    }


def _gain_and_loss() -> dict[str, Column]:
    move = F.col("price_change_1d")
    return {
        "price_gain": F.when(move > 0, move).otherwise(0.0),
        "price_loss": F.when(move < 0, -move).otherwise(0.0),
    }


def _change_windows(cfg: FeatureConfig, w: WindowSpec) -> dict[str, Column]:
    out = {}
    if cfg.enable_rsi:
        out |= {
            "avg_gain_14": rolling_mean("price_gain", GAIN_WINDOW, w),
            "avg_loss_14": rolling_mean("price_loss", GAIN_WINDOW, w),
        }
    if cfg.enable_volatility:
        out |= {f"price_volatility_{n}d": rolling_stddev("price_change_1d", n, w) for n in VOLATILITY_WINDOWS}
        out["volume_volatility_5d"] = rolling_stddev("volume_change_1d", 5, w)
    return out


def _products(cfg: FeatureConfig) -> dict[str, Column]:
    price, volume, sentiment = (F.col(c) for c in ("price_change_1d", "volume_change_1d", "sentiment_change_1d"))
    out = {}
    if cfg.enable_rsi:
        out["momentum_ratio"] = guarded_ratio(F.col("avg_gain_14"), F.col("avg_loss_14"))
    if cfg.enable_interactions:
        out |= {
            "price_volume_interaction": price * volume,
            "price_sentiment_interaction": price * sentiment,
            "volume_sentiment_interaction": volume * sentiment,
            "price_volume_sentiment_interaction": price * volume * sentiment,
        }
    if cfg.enable_volatility:
        short, long = F.col("price_volatility_5d"), F.col("price_volatility_10d")
        out["volatility_ratio_5_10"] = guarded_ratio(short, long)
        out["risk_adjusted_return"] = guarded_ratio(price, short)
    return out


def lookback(cfg: FeatureConfig = DEFAULTS) -> int:
    """Earlier rows that one row's features depend on, through chained windows too."""
    direct = max(
        *cfg.price_lags, *cfg.volume_lags, *cfg.sentiment_lags, *CHANGE_LAGS,
        *(n - 1 for n in (*cfg.ma_windows, *VOLUME_WINDOWS, *SENTIMENT_WINDOWS)),
    )
    return max(direct, GAIN_WINDOW, *VOLATILITY_WINDOWS)


def add_features(
    df: DataFrame,
    cfg: FeatureConfig = DEFAULTS,
    layout: Layout | None = None,
    keys: Keys = KEYS,
) -> DataFrame:
    """Panel plus every feature, the helper columns and ``target``; no row is dropped."""

    def stages(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumns(_bar_windows(cfg, w)).withColumns(_bar_ratios(cfg))
        if cfg.enable_rsi:
            d = d.withColumns(_gain_and_loss())
        return d.withColumns(_change_windows(cfg, w)).withColumns(_products(cfg))

    built = over_history(df, stages, back=lookback(cfg), ahead=1, layout=layout, keys=keys)
    helpers = HELPERS if cfg.enable_rsi else HELPERS[-2:]
    return built.select(*df.columns, *feature_names(cfg), *helpers, TARGET)


def stored_names(cfg: FeatureConfig = DEFAULTS) -> list[str]:
    """The bar columns, window values and target from which ``derive_features`` gives every feature."""
    w = Window.orderBy(F.lit(0))
    windows = [n for n in (*_bar_windows(cfg, w), *_change_windows(cfg, w)) if n != "_next_close"]
    return ["Close", "High", "Low", "Volume", "Scaled_sentiment", *windows, TARGET]


def derive_features(df: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    """Add the features that are plain combinations of ``stored_names``: a table need not hold them."""
    ratios = {n: c for n, c in _bar_ratios(cfg).items() if n != TARGET}
    return df.withColumns(ratios).withColumns(_products(cfg))


def clean_features(df: DataFrame, cfg: FeatureConfig = DEFAULTS, require_target: bool = True) -> DataFrame:
    """Keep rows where every declared feature, used by the model or not, is present."""
    names = feature_names(cfg) + ([TARGET] if require_target else [])
    return df.filter(all_not_null(names))
