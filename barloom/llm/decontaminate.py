"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words that looks at some positions and ignores the others, so a substituted
word at an ignored position does not break the hit. Training windows and test windows are joined on the hash of the
looked-at words. Around every hit the two texts are compared word by word on its diagonal, and the overlap extends
while matches outweigh substitutions. An extension that runs on into text that is too unlike gives way to the longest
stretch of the diagonal that reaches the rules.

The test side is the stated query set: its seeds go to every task in blocks of bounded size, and each block is run
against all documents, so nothing of the training side is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import words as W

# 1 looks at a word, 0 ignores it. With the default rules no overlap is without a hit: s substitutions
# among e >= max(13, 4 s) equal words leave a run of 4, and in items of up to 15 words, which need fewer, one of the
# gapped masks fits where no such run is left. Items of up to 4 words must be equal in every word.
MASKS = ("1111", "11101", "11011", "10111")
SCHEMA = "doc_id long, item_id long, start long, item_start long, n_overlap long, n_equal long, n_item_words long"


@dataclass(frozen=True)
class Rules:
    """An overlap counts from ``least_equal`` equal words on, or from the whole item where that is shorter.

    ``least_share`` of its aligned words must be equal. A substitution costs ``penalty`` matches in the extension,
    which ends when the sum falls ``drop`` below its best.
    """

    masks: tuple[str, ...] = MASKS
    least_equal: int = 13
    least_share: float = 0.8
    penalty: int = 2
    drop: int = 5
    block_bytes: int = 8 << 20


@dataclass
class Items:
    """Words of a block of test items, and the sorted seed hashes that point into them."""

    ids: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    keys: np.ndarray
    at: np.ndarray
    mask: np.ndarray
    filter: np.ndarray


def overlaps(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The longest overlap of each document with each test item: one row per pair that reaches the rules.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Columns doc_id, item_id, start and item_start (word positions),
    n_overlap (aligned words), n_equal and n_item_words. NULL texts have no words and match nothing; so do items
    shorter than the shortest mask unless a document equals them word for word there, which the default rules ask of
    them anyway. Repeated documents of one doc_id give one row; other columns are ignored; an empty side gives no row.
    """
    texts = docs.select("doc_id", "text")
    found = None
    for block in _blocks(benchmark, rules):
        rows = texts.mapInArrow(partial(_overlaps, block, rules), SCHEMA)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("n_equal"), "n_overlap", "start", "item_start")
    return found.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")


def clean(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows without any overlap, all columns as they were; judged where they are read, so nothing is shuffled."""
    for block in _blocks(benchmark, rules):
        docs = docs.mapInArrow(partial(_clean, block, rules), docs.schema)
    return docs


def _blocks(benchmark: DataFrame, rules: Rules) -> Iterator[Items]:
    """Test items in blocks of at most ``block_bytes`` of text (a longer item is a block of its own)."""
    rows = benchmark.select("item_id", "text").where("text is not null and item_id is not null")
    held: list[tuple[int, str]] = []
    size = 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if held and size + len(row["text"]) > rules.block_bytes:
            yield _items(held, rules)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if held:
        yield _items(held, rules)


def _items(rows: list[tuple[int, str]], rules: Rules) -> Items:
    hashes, first = [np.empty(0, np.uint64)], [0]
    for part in W.slices(pa.array([text for _, text in rows], pa.string())):
        hashes.append(part.hashes())
        first += (part.first[1:] + first[-1]).tolist()
    words, first = np.concatenate(hashes), np.array(first)
    keys, at, mask = [], [], []
    for number, positions in enumerate(map(_positions, rules.masks)):
        starts = W.full_starts(first, positions[-1] + 1)
        keys.append(_seed(words, starts, positions, number))
        at.append(starts)
        mask.append(np.full(len(starts), number))
    short = np.flatnonzero((np.diff(first) < _shortest(rules)) & (np.diff(first) > 0))
    for i in short:  # no mask fits: the whole item is its own seed
        length = int(first[i + 1] - first[i])
        keys.append(W.windows(words, first[i : i + 1], length, length))
        at.append(first[i : i + 1])
        mask.append(np.full(1, -length))
    keys, at, mask = np.concatenate(keys), np.concatenate(at), np.concatenate(mask)
    order = np.argsort(keys, kind="stable")
    return Items(
        np.array([i for i, _ in rows], np.int64), first, words, keys[order], at[order], mask[order], _filter(keys)
    )


def _shortest(rules: Rules) -> int:
    return min(map(len, rules.masks))


def _positions(mask: str) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1"))


def _seed(words: np.ndarray, starts: np.ndarray, positions: np.ndarray, number: int) -> np.ndarray:
    total = np.full(len(starts), number + 1, np.uint64)
    for p in positions:
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[starts + p]
    return W.mix(total)


FILTER_BITS = 22


def _filter(keys: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[keys >> np.uint64(64 - FILTER_BITS)] = True
    return table


def _overlaps(items: Items, rules: Rules, batches) -> Iterator[pa.RecordBatch]:
    names = [column.split()[0] for column in SCHEMA.split(", ")]
    for batch in batches:
        doc_ids = batch.column(0)
        for part in W.slices(batch.column(1)):
            rows = _found(items, rules, part)
            if rows:
                owner, *rest = zip(*rows)
                ids = doc_ids[part.rows].take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in rest)], names=names)


def _clean(items: Items, rules: Rules, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = np.ones(batch.num_rows, bool)
        for part in W.slices(batch.column(batch.schema.get_field_index("text"))):
            for owner, *_ in _found(items, rules, part):
                kept[part.rows.start + owner] = False
        yield batch.filter(pa.array(kept))


def _found(items: Items, rules: Rules, part: W.Words) -> list[tuple]:
    """Overlaps of a slice of documents, each with the document's place in the slice first."""
    words = part.hashes()
    pairs = []
    for number, positions in enumerate(map(_positions, rules.masks)):
        starts = W.full_starts(part.first, positions[-1] + 1)
        pairs.append(_hits(items, _seed(words, starts, positions, number), starts, number))
    for length in sorted({-int(m) for m in items.mask[items.mask < 0]}):
        starts = W.full_starts(part.first, length)
        pairs.append(_hits(items, W.windows(words, starts, length, length), starts, -length))
    return _verified(items, rules, part, words, np.concatenate(pairs, axis=1))


def _hits(items: Items, seeds: np.ndarray, starts: np.ndarray, mask: int) -> np.ndarray:
    """Pairs (document word, item word) with equal seeds of one mask."""
    maybe = np.flatnonzero(items.filter[seeds >> np.uint64(64 - FILTER_BITS)])
    low = np.searchsorted(items.keys, seeds[maybe], side="left")
    count = np.searchsorted(items.keys, seeds[maybe], side="right") - low
    total = int(count.sum())
    which = np.repeat(low, count) + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    pairs = np.stack([np.repeat(starts[maybe], count), items.at[which]])
    return pairs[:, items.mask[which] == mask]


def _verified(items: Items, rules: Rules, part: W.Words, words: np.ndarray, pairs: np.ndarray) -> list[tuple]:
    """Best overlap per (document, item) among the hits; a hit inside an overlap already measured is not repeated.

    Where the extension of a hit does not reach the rules, the longest stretch of its whole diagonal that does counts.
    """
    best: dict[tuple[int, int], tuple] = {}
    if not pairs.shape[1]:
        return []
    owner = np.searchsorted(part.first, pairs[0], side="right") - 1
    item = np.searchsorted(items.first, pairs[1], side="right") - 1
    order = np.lexsort((pairs[0], pairs[0] - pairs[1], item, owner))
    done: tuple | None = None
    for k in order:
        d, i, at, there = int(owner[k]), int(item[k]), int(pairs[0][k]), int(pairs[1][k])
        if done is not None and done[:3] == (d, i, at - there) and at < done[3]:
            continue
        left = min(at - part.first[d], there - items.first[i])
        right = min(part.first[d + 1] - at, items.first[i + 1] - there)
        equal = words[at - left : at + right] == items.hashes[there - left : there + right]
        size = int(items.first[i + 1] - items.first[i])
        if int(equal.sum()) < _needed(rules, size):
            done = (d, i, at - there, at + right)
            continue
        start, end = _extend(equal, int(left), rules)
        done = (d, i, at - there, at - left + end)
        n_equal = int(equal[start:end].sum())
        if n_equal < _needed(rules, size) or n_equal < rules.least_share * (end - start):
            start, end = _longest(equal, rules)
            done = (d, i, at - there, at + right)
            n_equal = int(equal[start:end].sum())
            if n_equal < _needed(rules, size):
                continue
        row = (n_equal, -(end - start), -int(at - left + start - part.first[d]), int(there - left + start - items.first[i]), size)
        if (d, i) not in best or row > best[d, i]:
            best[d, i] = row
    return [
        (d, int(items.ids[i]), -start, item_start, -overlap, n_equal, size)
        for (d, i), (n_equal, overlap, start, item_start, size) in best.items()
    ]


def _needed(rules: Rules, size: int) -> int:
    """Equal words an overlap with an item of ``size`` words must have."""
    return min(rules.least_equal, math.ceil(Fraction(str(rules.least_share)) * size))


def _longest(equal: np.ndarray, rules: Rules) -> tuple[int, int]:
    """The stretch of most equal words among those of ``least_share``; of these the shortest, then the first.

    It begins and ends at equal words. From the i-th to the j-th of them it has the share if the gain before i, of
    1 - least_share an equal word and -least_share a substituted one, is at most the gain up to and with j.
    """
    share = Fraction(str(rules.least_share))
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    place = np.arange(len(at))
    before = place * share.denominator - at * share.numerator
    after = before + share.denominator - share.numerator
    first = np.searchsorted(-np.minimum.accumulate(before), -after)  # the first i whose gain before is low enough
    count = place - first + 1
    best = np.lexsort((at, at - at[first], -count))[0]
    return int(at[first[best]]), int(at[best]) + 1


def _extend(equal: np.ndarray, seed: int, rules: Rules) -> tuple[int, int]:
    """The overlap around a seed that begins at ``seed``: extended both ways to the best sum of matches."""
    gain = np.where(equal, 1, -rules.penalty)
    return seed - _reach(gain[:seed][::-1], rules.drop), seed + _reach(gain[seed:], rules.drop)


def _reach(gain: np.ndarray, drop: int) -> int:
    if not len(gain):
        return 0
    sums = np.cumsum(gain)
    top = np.maximum(np.maximum.accumulate(sums), 0)
    fallen = np.flatnonzero(top - sums >= drop)
    sums = sums[: fallen[0]] if len(fallen) else sums
    return int(np.argmax(sums)) + 1 if len(sums) and sums.max() > 0 else 0
