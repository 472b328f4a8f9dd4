"""Column names and schemas of the panel and of the tables derived from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = "stock_symbol"
TIME = "Date"

# The input columns and the rename applied on load.
RENAMES = {"Adj close": "Adj_Close"}
DOUBLE_COLUMNS = [
    "Open",
    "High",
    "Low",
    "Close",
    "Adj_Close",
    "Volume",
    "Sentiment_gpt",
    "Scaled_sentiment",
]
INT_COLUMNS = ["News_flag"]
CRITICAL_COLUMNS = ["Date", "Close", "Volume", "Scaled_sentiment"]
SUMMARY_COLUMNS = ["Close", "Volume", "Scaled_sentiment"]


@dataclass(frozen=True)
class Keys:
    """Names of the two key columns of a panel, and of columns that order bars of equal time."""

    entity: str = ENTITY
    time: str = TIME
    ties: tuple[str, ...] = ()

    @property
    def pair(self) -> list[str]:
        return [self.entity, self.time]

    @property
    def order(self) -> list[str]:
        """Columns that order a history."""
        return [self.time, *self.ties]

    def tie_order(self, descending: bool = False) -> list[Column]:
        return [F.col(c).desc() if descending else F.col(c) for c in self.ties]


KEYS = Keys()

PREDICTIONS = T.StructType(
    [
        T.StructField("stock_symbol", T.StringType()),
        T.StructField("current_date", T.TimestampType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("predicted_return", T.DoubleType()),
        T.StructField("predicted_price", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)

IMPORTANCE = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType()),
    ]
)
