"""Quality rules by compression bands.

A text that repeats itself compresses too well, random characters hardly at all. The zstandard ratio (compressed bytes
per byte) of the whole text and of each fixed chunk must lie in a band that depends on the length compressed, since
short texts carry their frame and have little to refer back to.

General bands catch gross cases only. ``fit`` draws closer ones from the corpus itself: for each class of lengths, a
quarter of a doubling wide, the quartiles of the ratios of all different texts (and of their chunks) and limits some
spreads beyond them. Ratios are counted in steps of a thousandth, so the limits do not depend on how rows lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import words as W

# Fixed values: (length in bytes from which the band holds, least ratio, greatest ratio).
BANDS = (
    (0, 0.0, float("inf")),
    (128, 0.30, 1.02),
    (256, 0.25, 0.97),
    (512, 0.20, 0.90),
    (1024, 0.18, 0.85),
    (2048, 0.16, 0.80),
    (4096, 0.14, 0.74),
    (16384, 0.12, 0.70),
    (65536, 0.10, 0.66),
)
SYMBOLS = b"#*$%&|<>"
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("whole_ratio", pa.float64()),
        ("n_chunks", pa.int64()),
        ("low_chunks", pa.int64()),
        ("high_chunks", pa.int64()),
        ("reason", pa.string()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
SPARK_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, n_chunks long, low_chunks long, high_chunks long, reason string, "
    "base_failed boolean, kept boolean"
)

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Rules:
    """Limits: a text fails as a whole, or when more than ``bad_chunks`` of its chunks leave their band."""

    bands: tuple[tuple[int, float, float], ...] = BANDS
    chunk_bytes: int = 4096
    bad_chunks: float = 0.25
    least_words: int = 50
    repeat_percent: int = 50
    level: int = 3


@dataclass(frozen=True)
class Fit:
    """How far limits lie from the quartiles, in spreads between them, a spread counting as ``least_spread`` at least.

    Ratios fall with length. So a class of fewer than ``least_texts`` different texts and chunks takes its least ratio
    from the next longer class that has enough and its greatest from the next shorter one, and where there is none
    keeps the general limit.
    """

    below: float = 2.0
    above: float = 4.0
    least_spread: float = 0.012
    least_texts: int = 50
    steps: int = 1000
    per_doubling: int = 4


def fit(docs: DataFrame, rules: Rules = Rules(), how: Fit = Fit()) -> Rules:
    """Rules whose bands follow the ratios of all texts that pass the base rules; equal texts count once.

    The driver gets one row per class of lengths and step of the ratio, about a hundred classes of some thousand steps
    whatever the corpus. Where no class has enough texts the bands stay as they are; a fitted band is never wider than
    the given one.
    """
    found = docs.select("text").mapInArrow(partial(_ratios, rules, how), "class int, step int, key long").distinct()
    steps: dict[int, list[tuple[int, int]]] = {}
    for row in found.groupBy("class", "step").agg(F.count("*").alias("n")).collect():
        steps.setdefault(row["class"], []).append((row["step"], row["n"]))
    limits = {}
    for number, counts in steps.items():
        counts.sort()
        total = sum(n for _, n in counts)
        if total < how.least_texts:
            continue
        low, high = (_quantile(counts, total, share) / how.steps for share in (0.25, 0.75))
        spread = max(high - low, how.least_spread)
        limits[number] = (round(low - how.below * spread, 6), round(high + how.above * spread, 6))
    if not limits:
        return rules
    bands = []
    classes = range(min(steps), max(steps) + 2)
    starts = {math.ceil(2 ** (number / how.per_doubling)): number for number in classes}
    starts |= {start: classes[-1] for start, _, _ in rules.bands if start > max(starts)}
    for start, number in starts.items():
        low, high = band(rules, start)
        longer = [limits[k][0] for k in sorted(limits) if k >= number]
        lower = [limits[k][1] for k in sorted(limits) if k <= number]
        bands.append((start, max([low, *longer[:1]]), min([high, *lower[-1:]])))
    shorter = [b for b in rules.bands if b[0] < bands[0][0]]
    return replace(rules, bands=(*shorter, *bands))


def _quantile(counts: list[tuple[int, int]], total: int, share: float) -> int:
    at, seen = share * (total - 1), 0
    for step, n in counts:
        seen += n
        if seen > at:
            return step
    return counts[-1][0]


def _ratios(rules: Rules, how: Fit, batches) -> Iterator[pa.RecordBatch]:
    """Length class and ratio of every whole text and chunk that the bands will judge, with a key of the bytes."""
    compressor = _compressor(rules)
    for batch in batches:
        for part in W.slices(batch.column(0)):
            counts = _counts(part)
            text, bounds = part.data.tobytes(), part.offsets
            rows = []
            for i in range(len(bounds) - 1):
                own = text[bounds[i] : bounds[i + 1]]
                if not own or _base_failed(rules, counts[0][i], counts[4][i]):
                    continue
                pieces = [own, *_chunks(rules, own)]
                for piece in pieces:
                    key = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
                    ratio = len(compressor.compress(piece)) / len(piece)
                    rows.append((int(how.per_doubling * math.log2(len(piece))), int(ratio * how.steps), key))
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64()))], names=["class", "step", "key"]
            )


def _compressor(rules: Rules):
    return zstandard.ZstdCompressor(level=rules.level, write_checksum=False, write_content_size=False)


def _chunks(rules: Rules, text: bytes) -> list[bytes]:
    if len(text) <= rules.chunk_bytes:
        return []
    return [text[at : at + rules.chunk_bytes] for at in range(0, len(text), rules.chunk_bytes)]


def _base_failed(rules: Rules, n_words: int, n_repeat: int) -> bool:
    return bool(n_words < rules.least_words or 100 * n_repeat > rules.repeat_percent * n_words)


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts, ratios and verdict of every whole text: one row per input row.

    ``reason`` is the first rule broken: words, repeats, repetitive, incompressible, repetitive_chunks,
    incompressible_chunks, or NULL for a kept text. A NULL or empty text has no words and fails; its ratio is NULL.
    The last chunk is judged by the band of its own length. Repeated rows are judged alike, other columns are
    ignored, an empty input gives no row.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_judge, rules), SPARK_SCHEMA)


def band(rules: Rules, length: int) -> tuple[float, float]:
    low, high = 0.0, float("inf")
    for start, a, b in rules.bands:
        if length >= start:
            low, high = a, b
    return low, high


def _judge(rules: Rules, batches) -> Iterator[pa.RecordBatch]:
    compressor = _compressor(rules)
    for batch in batches:
        doc_ids = batch.column(0)
        for part in W.slices(batch.column(1)):
            counts = _counts(part)
            bounds = part.offsets
            text = part.data.tobytes()
            verdicts = [
                _verdict(rules, compressor, text[bounds[i] : bounds[i + 1]], counts[0][i], counts[4][i])
                for i in range(len(bounds) - 1)
            ]
            columns = [doc_ids[part.rows], *counts, *zip(*verdicts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, SCHEMA)],
                schema=SCHEMA,
            )


def _counts(part: W.Words) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document of a slice."""
    data, bounds, first = part.data, part.offsets, part.first
    inside = ~W.is_space(data)

    def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[edges[1:]] - sums[edges[:-1]]

    chars = per_doc(inside & ((data & 0xC0) != 0x80), bounds)
    symbols = per_doc(_IS_SYMBOL[data], bounds)
    docs = np.arange(len(bounds) - 1)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate((bounds[:-1], breaks + 1)))
    line_ends = np.concatenate((line_starts[1:], bounds[-1:]))
    line_ends = line_ends - ((line_ends > line_starts) & (data[np.maximum(line_ends, 1) - 1] == 10)) if len(data) else line_ends
    worded = np.concatenate(([0], np.cumsum(inside)))
    full = worded[line_ends] > worded[line_starts]
    line_starts, line_ends = line_starts[full], line_ends[full]
    owner = np.searchsorted(bounds, line_starts, side="right") - 1
    keys = part.range_hashes(line_starts, line_ends) ^ W.mix(owner.astype(np.uint64))
    _, seen = np.unique(keys, return_index=True)
    duplicates = np.bincount(owner, minlength=len(docs)) - np.bincount(owner[seen], minlength=len(docs))

    starts = W.full_starts(first, 3)
    owner = np.searchsorted(first, starts, side="right") - 1
    keys = W.windows(part.hashes(), starts, 3) ^ W.mix(owner.astype(np.uint64))
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(first[-1], bool)
    repeated = starts[count[inverse] > 1]
    for shift in range(3):
        covered[repeated + shift] = True
    return [np.diff(first), chars, symbols, duplicates, per_doc(covered, first)]


def _verdict(rules: Rules, compressor, text: bytes, n_words: int, n_repeat: int) -> tuple:
    if not text:
        return None, 0, 0, 0, "words", True, False
    whole = len(compressor.compress(text)) / len(text)
    chunks = low_chunks = high_chunks = 0
    for piece in _chunks(rules, text):
        ratio = len(compressor.compress(piece)) / len(piece)
        low, high = band(rules, len(piece))
        chunks += 1
        low_chunks += ratio < low
        high_chunks += ratio > high
    low, high = band(rules, len(text))
    base_failed = _base_failed(rules, n_words, n_repeat)
    if base_failed:
        reason = "words" if n_words < rules.least_words else "repeats"
    elif whole < low:
        reason = "repetitive"
    elif whole > high:
        reason = "incompressible"
    elif low_chunks > rules.bad_chunks * chunks:
        reason = "repetitive_chunks"
    elif high_chunks > rules.bad_chunks * chunks:
        reason = "incompressible_chunks"
    else:
        reason = None
    return whole, chunks, low_chunks, high_chunks, reason, base_failed, reason is None
