"""Best-fit packing of token sequences with a bounded number of open bins.

Every task packs the pieces of its documents as they arrive. Its open bins are keyed by their free space in one
integer used as a bitset, so the tightest bin that holds a piece is the lowest set bit from the piece's length on.
A piece that fits nowhere opens a bin; beyond ``open_bins`` the fullest closes first. No shuffle is needed: the
input is read in tasks large enough that the bins still open at their end are few.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.tokenizer import content, word_ids

OPEN_BINS = 512
TASK_BYTES = 32 << 20
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
SPARK_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class OpenBins:
    """Open bins of one task. ``place`` returns (bin, offset) for a piece of at most ``capacity`` tokens."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits = 0
        self.by_free: dict[int, deque[int]] = {}
        self.count = 0
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        if free > length:
            self.by_free.setdefault(free - length, deque()).append(number)
            self.bits |= 1 << (free - length)
            self.count += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        line = self.by_free[free]
        number = line.popleft()
        self.count -= 1
        if not line:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        return number


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    separator: int = 0,
    open_bins: int = OPEN_BINS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Encode whole texts, end each with ``separator``, and pack them into sequences of at most ``capacity`` ids.

    Only documents longer than ``capacity`` are cut, into full pieces and a last, perhaps shorter one. One row per
    piece: doc_id, piece, start (ids of the document before it), length, its ids as little-endian unsigned 32 bits,
    sequence_id and offset. The pieces of a sequence lie in it without gaps from 0. A NULL or empty text has the
    separator alone; repeated rows are packed once each; other columns are ignored; an empty input gives no row.
    """
    if capacity < 1 or open_bins < 1:
        raise ValueError("capacity and open_bins start at 1")
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = texts.coalesce(max(1, -(-size // task_bytes)))
    return tasks.mapInArrow(partial(_pack, content(tokenizer), capacity, separator, open_bins), SPARK_SCHEMA)


def _pack(tokenizer: str, capacity: int, separator: int, open_bins: int, batches) -> Iterator[pa.RecordBatch]:
    coder, bins, end = word_ids(tokenizer), OpenBins(capacity, open_bins), separator.to_bytes(4, "little")
    base = TaskContext.get().partitionId() << 36
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = coder.encode(text.as_py()) + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                number, offset = bins.place(len(part) // 4)
                rows.append((doc_id, piece, at // 4, len(part) // 4, part, base + number, offset))
                held += len(part)
            if held > 4 << 20:
                yield _batch(rows)
                rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def digests(packed: DataFrame) -> DataFrame:
    """Rows of ``pack`` with the crc32 of their ids in place of the ids."""
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
