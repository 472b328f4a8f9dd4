"""Toxicity by compression distance.

Two zstandard dictionaries are word lists ranked by document counts and log-odds of labelled text. Both hold the strings
common to all text, so that ordinary words compress alike; the toxic one also holds the strings that toxic documents
have far more often. Every window of a text is compressed with each, and the bytes the toxic dictionary saves are its distance. A
window is one word in a fixed frame: the frame puts the compressor into the same mode for words of any length, and no
word hides behind its neighbours. Thresholds on the distances of a document are calibrated by logistic regression on
documents that the dictionaries were not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.staging import discard, write_shared

FRAME = b" compression window filler text 0123456789 "
FOLDS = 2
STEPS = (1, 2, 3, 4)
REMEMBER = 400_000
SEPARATORS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Training:
    """Bounds of the fit. At most ``rows_per_class`` labelled rows of each class are used, chosen by hash of doc_id.

    A dictionary holds the best strings that fit into its bytes; a string that does not fit is passed over.
    """

    rows_per_class: int = 6000
    toxic_bytes: int = 110_000
    common_bytes: int = 110_000
    least_evidence: float = 8.0
    least_ratio: float = 3.0
    level: int = 12
    ridge: float = 0.1
    candidates: int = 40_000


@dataclass(frozen=True)
class Model:
    """Dictionaries as raw content, and the calibration: weights over standardised features."""

    common: bytes
    toxic: bytes
    level: int
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


class Distance:
    """Bytes saved by the toxic dictionary, remembered per window."""

    def __init__(self, common: bytes, toxic: bytes, level: int, remember: int = REMEMBER):
        self.compressors = [_compressor(extra + common + FRAME, level) for extra in (b"", toxic)]
        self.remember = remember
        self.known: dict[bytes, int] = {}

    def of(self, window: bytes) -> int:
        found = self.known.get(window)
        if found is None:
            framed = b" " + window + b" " + FRAME
            ordinary, toxic = (len(c.compress(framed)) for c in self.compressors)
            if len(self.known) >= self.remember:
                self.known.clear()
            found = self.known[window] = ordinary - toxic
        return found

    def features(self, text: str | None) -> list[float]:
        """Largest distance, mean of the two largest, then windows at or above each step: their log, root of share."""
        saved = sorted(map(self.of, (text or "").encode().split()))
        if not saved:
            return [0.0] * (2 + 2 * len(STEPS))
        values = np.array(saved)
        counts = len(values) - np.searchsorted(values, STEPS)
        return [
            float(values[-1]), float(values[-2:].mean()),
            *np.log1p(counts).tolist(), *np.sqrt(counts / len(values)).tolist(),
        ]


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        level, min_match=4, source_size=64, dict_size=len(content),
        write_content_size=False, write_dict_id=False, write_checksum=False,
    )
    content_dict = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content_dict.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=content_dict, compression_params=settings)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of doc_id as text, divisible by 5. A NULL doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Train dictionaries and calibration on labelled rows that are not held out.

    Of labels that repeat for a doc_id the greatest counts; labels without document, NULL labels and NULL doc_ids are
    ignored. String counts run as Spark jobs over the sample; the driver gets at most ``candidates`` strings a
    dictionary and one short feature row per sampled document. Without labels of both classes the model scores every
    text with the smoothed share of toxic labels.
    """
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    chosen = [marks.where(F.col("toxic") == c).orderBy(order).limit(training.rows_per_class) for c in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    folded = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    rows, path = write_shared(folded, "toxic-sample")
    strings, counts_path = write_shared(_string_counts(rows), "toxic-strings")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    totals = [sum(n for (_, c), n in sizes.items() if c == label) for label in (0, 1)]
    share = (totals[1] + 0.5) / (sum(totals) + 1) if sum(totals) else 0.0
    model = Model(b"", b"", training.level, (), (), (share,))
    if min(totals):
        folds = [_dictionaries(strings, sizes, fold, training) for fold in range(FOLDS)]
        common, toxic = _dictionaries(strings, sizes, None, training)
        schema = "toxic int, features array<double>"
        table = rows.select("fold", "toxic", "text").mapInArrow(partial(_sample_features, folds, training.level), schema)
        measured = table.toPandas()
        mean, scale, weights = _calibrate(np.stack(measured["features"]), measured["toxic"].to_numpy(), training.ridge)
        model = Model(common, toxic, training.level, tuple(mean), tuple(scale), tuple(weights))
    for used in (path, counts_path):
        discard(docs.sparkSession, used)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns doc_id and score, 0 to 1, of every whole text; NULL and empty texts have the score of no window.

    Repeated rows score alike, other columns are ignored, an empty input gives no row.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_score, model), "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they were."""
    return docs.mapInArrow(partial(_keep, model, threshold), docs.schema)


def _string_counts(rows: DataFrame) -> DataFrame:
    strings = F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), SEPARATORS))).alias("string")
    counted = rows.select("fold", "toxic", strings).where("string <> ''").groupBy("string")
    columns = [
        F.count_if((F.col("fold") == f) & (F.col("toxic") == c)).alias(f"n_{f}_{c}") for f in range(FOLDS) for c in (0, 1)
    ]
    return counted.agg(*columns).where(" + ".join(f"n_{f}_{c}" for f in range(FOLDS) for c in (0, 1)) + " > 1")


def _dictionaries(strings: DataFrame, sizes: dict, left_out: int | None, training: Training) -> tuple[bytes, bytes]:
    """Contents trained on all folds but one: common strings and toxic strings, the best last, nearest to the window."""
    folds = [f for f in range(FOLDS) if f != left_out]
    n = [sum(sizes.get((f, c), 0) for f in folds) for c in (0, 1)]
    ordinary, toxic = (sum((F.col(f"n_{f}_{c}") for f in folds), F.lit(0)) for c in (0, 1))
    ratio = ((toxic + 0.5) / (n[1] + 1)) / ((ordinary + 0.5) / (n[0] + 1))
    scored = strings.select(
        "string", (ordinary + toxic).alias("n"), ratio.alias("ratio"), (toxic * F.log(ratio)).alias("evidence")
    )
    marked = scored.where((F.col("ratio") > training.least_ratio) & (F.col("evidence") >= training.least_evidence))
    shared = scored.where((F.col("ratio") <= training.least_ratio) & (F.col("n") > 0))
    ranked = [
        (frame.where(F.octet_length("string") < most).orderBy(F.desc(key), "string").limit(training.candidates), most)
        for frame, key, most in ((shared, "n", training.common_bytes), (marked, "evidence", training.toxic_bytes))
    ]
    return tuple(_content([r[0] for r in frame.collect()], most) for frame, most in ranked)


def _content(ranked: list[str], most: int) -> bytes:
    out: list[bytes] = []
    size = 0
    for string in ranked:
        raw = b" " + string.encode()
        if size + len(raw) > most:
            continue
        size += len(raw)
        out.append(raw)
    return b"".join(reversed(out))


def _calibrate(features: np.ndarray, labels: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression with weights of at least 0, so that no further toxic window lowers a score.

    While a weight is negative, the most negative feature leaves the fit.
    """
    mean, scale = features.mean(0), features.std(0) + 1e-9
    standard = (features - mean) / scale
    live = list(range(features.shape[1]))
    while True:
        fitted = _logistic(np.c_[np.ones(len(features)), standard[:, live]], labels, ridge)
        if not live or fitted[1:].min() >= 0:
            break
        live.pop(int(np.argmin(fitted[1:])))
    weights = np.zeros(features.shape[1] + 1)
    weights[[0, *(i + 1 for i in live)]] = fitted
    return mean, scale, weights


def _logistic(design: np.ndarray, labels: np.ndarray, ridge: float) -> np.ndarray:
    weights = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -35, 35)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, design.T @ (labels - p) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _sample_features(folds: list[tuple[bytes, bytes]], level: int, batches) -> Iterator[pa.RecordBatch]:
    distances = [Distance(common, toxic, level) for common, toxic in folds]
    for batch in batches:
        fold, toxic, texts = (batch.column(i).to_pylist() for i in range(3))
        yield pa.RecordBatch.from_pydict(
            {
                "toxic": pa.array(toxic, pa.int32()),
                "features": pa.array([distances[f].features(t) for f, t in zip(fold, texts)], pa.list_(pa.float64())),
            }
        )


def _scores(model: Model, distance: Distance | None, texts: pa.Array) -> np.ndarray:
    if distance is None:
        return np.full(len(texts), model.weights[0])
    features = np.array([distance.features(t.as_py()) for t in texts]).reshape(len(texts), -1)
    design = (features - np.array(model.mean)) / np.array(model.scale)
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + design @ np.array(model.weights[1:]), -35, 35)))


def _distance(model: Model) -> Distance | None:
    return Distance(model.common, model.toxic, model.level) if model.mean else None


def _score(model: Model, batches) -> Iterator[pa.RecordBatch]:
    distance = _distance(model)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_scores(model, distance, batch.column(1)), pa.float64())], names=["doc_id", "score"]
        )


def _keep(model: Model, threshold: float, batches) -> Iterator[pa.RecordBatch]:
    distance = _distance(model)
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        yield batch.filter(pa.array(_scores(model, distance, texts) < threshold))
