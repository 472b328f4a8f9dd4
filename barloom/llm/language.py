"""Language of texts by rank-order n-gram profiles.

A profile lists a language's most frequent letter n-grams by rank. A document's own most frequent n-grams are compared
with each profile by the out-of-place distance: the sum over them of how far their ranks lie apart, an n-gram that the
profile lacks counting as the profile's full length. N-grams run within words of letters, framed by one blank on each
side, lower-cased; of equal counts the n-gram of smaller code points ranks first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Counts of n-grams a task holds for one batch of languages before it passes them on.
HELD = 2_000_000
SLICE = 1 << 16
BITS = 21
BLANK = ord(" ")


@dataclass(frozen=True)
class Settings:
    """``most_languages`` guards the driver, which holds ``length`` n-grams for each: more raise an error."""

    longest: int = 3
    length: int = 300
    most_languages: int = 5000

    def __post_init__(self):
        if not 1 <= self.longest <= 3:
            raise ValueError("n-grams of 1 to 3 code points fit into 63 bits")


@dataclass(frozen=True)
class Profiles:
    """Languages in order of name; ``ranks[g]`` holds the rank of ``grams[g]`` in each, ``length`` where it is absent."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    settings: Settings


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned: crc32 of doc_id as text leaves 1 modulo 3. A NULL doc_id is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Columns lang, gram (code points packed in 21 bits each), n: how often each n-gram occurs in a language's texts.

    Tasks add up their own texts, so only different n-grams are shuffled.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    part = known.mapInArrow(partial(_count, settings), "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, settings: Settings = Settings()) -> Profiles:
    """Profiles from all documents with a language that are not held out, whole texts.

    NULL languages, NULL texts and texts without letters teach nothing; a language whose texts have no letters is
    not learned. Repeated rows count as often as they stand there.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked = counts(docs.where(~held_out(F.col("doc_id"))), settings).withColumn("rank", rank).where(F.col("rank") <= settings.length)
    rows = ranked.select("lang", "gram", "rank").limit(settings.most_languages * settings.length + 1).toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    if len(languages) > settings.most_languages or len(rows) > settings.most_languages * settings.length:
        raise ValueError(f"more than {settings.most_languages} languages")
    grams = np.unique(rows["gram"].to_numpy(np.int64))
    ranks = np.full((len(grams), len(languages)), settings.length, np.int32)
    column = {name: i for i, name in enumerate(languages)}
    ranks[np.searchsorted(grams, rows["gram"].to_numpy(np.int64)), rows["lang"].map(column).to_numpy(int)] = rows["rank"] - 1
    return Profiles(languages, grams, ranks, settings)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Columns doc_id, lang_pred, score and distance of every whole text.

    A NULL text and one without letters is ``und`` with score 0 and no distance, as is every text where no language was
    learned. Of equal distances the language of smaller name wins. The score says how much nearer the best language is
    than the next: 1 - distance / next distance; with a single language, 1 - distance / greatest distance. Repeated rows
    are predicted alike, other columns are ignored, an empty table gives no row.
    """
    schema = "doc_id long, lang_pred string, score double, distance long"
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, profiles), schema)


def grams(text: str, longest: int) -> np.ndarray:
    """All n-grams of 1 to ``longest`` code points in order of length; those of a single blank are left out."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = letter
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    kept[:-1] |= inside[1:]
    # A blank before and after every word: two words that share one separator share the blank.
    line = np.full(len(points) + 2, BLANK, np.int64)
    line[1:-1] = np.where(letter, points, BLANK)
    line, inside = line[kept], inside[kept]
    found = [line[inside]]
    packed = line
    for n in range(2, longest + 1):
        packed = (packed[:-1] << BITS) | line[n - 1 :]
        whole = inside[:-1] | inside[1:] if n == 2 else inside[1 : 1 + len(packed)].copy()
        for k in range(2, n - 1):
            whole &= inside[k : k + len(packed)]
        found.append(packed[whole])
    return np.concatenate(found)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _tallied(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces that end between words, so that counting a very long one needs bounded memory."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _count(settings: Settings, batches) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = 0

    def release() -> pa.RecordBatch:
        names, values, amounts = [], [], []
        for lang, parts in held.items():
            grams_, n = _merged(parts)
            names.append(np.repeat(lang, len(grams_)))
            values.append(grams_)
            amounts.append(n)
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(np.concatenate(names).tolist(), pa.string()), "gram": np.concatenate(values), "n": np.concatenate(amounts)}
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for piece in _pieces(text.as_py()):
                values, n = _tallied(grams(piece, settings.longest))
                held.setdefault(lang, []).append((values, n))
                size += len(values)
            if size > HELD:
                for name, parts in held.items():
                    held[name] = [_merged(parts)]
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD // 2:
                    yield release()
                    held.clear()
                    size = 0
    if held:
        yield release()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([p[1] for p in parts]), len(values)).astype(np.int64)


def top(text: str, settings: Settings) -> np.ndarray:
    """The most frequent n-grams of a whole text, most frequent first."""
    parts = [_tallied(grams(piece, settings.longest)) for piece in _pieces(text)]
    values, n = parts[0] if len(parts) == 1 else _merged(parts)
    return values[np.lexsort((values, -n))[: settings.length]]


def distances(text: str | None, profiles: Profiles) -> np.ndarray | None:
    """Out-of-place distance of a text to each language, or None where there is nothing to compare."""
    own = top(text, profiles.settings) if text else np.empty(0, np.int64)
    if not len(own) or not len(profiles.grams):
        return None
    at = np.minimum(np.searchsorted(profiles.grams, own), len(profiles.grams) - 1)
    ranks = np.where((profiles.grams[at] == own)[:, None], profiles.ranks[at], profiles.settings.length)
    gap = np.abs(ranks - np.arange(len(own))[:, None])
    return np.where(ranks < profiles.settings.length, gap, profiles.settings.length).sum(0)


def _predict(profiles: Profiles, batches) -> Iterator[pa.RecordBatch]:
    length = profiles.settings.length
    for batch in batches:
        names, scores, nearest = [], [], []
        for text in batch.column(1):
            far = distances(text.as_py(), profiles)
            if far is None:
                names.append(UNKNOWN), scores.append(0.0), nearest.append(None)
                continue
            best = int(far.argmin())
            others = np.delete(far, best)
            limit = int(others.min()) if len(others) else length * length
            names.append(profiles.languages[best])
            scores.append(max(0.0, 1 - int(far[best]) / limit) if limit else 0.0)
            nearest.append(int(far[best]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(nearest, pa.int64())],
            names=["doc_id", "lang_pred", "score", "distance"],
        )
