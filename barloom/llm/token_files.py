"""Token ids in fixed-width bit-packed blocks.

Every id takes the same number of bits, the fewest that hold the vocabulary, so id i of a block starts at bit
``i * bits``. A block is one row of a Parquet table: its least and greatest document, the offsets of their ids in the
block, the number of ids before it, and the packed bytes. ``lookup`` and ``span`` find a document or a range of
positions by those columns, which Parquet's own statistics skip by, and unpack the wanted ids alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.tokenizer import content, slices, vocabulary_size, word_ids

BLOCK_IDS = 1 << 16
ROW_GROUP_BYTES = 8 << 20
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
BLOCK_SCHEMA = "part int, block int, first long, n_ids long, bits int, low_doc long, high_doc long, doc_ids array<long>, offsets array<long>, packed binary"


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Unsigned 32-bit ids to a stream of ``bits`` bits each, lowest bit first, padded to a whole byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.reshape(-1), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a packed stream; only the bytes that hold them are touched."""
    count = len(packed) * 8 // bits if stop is None else stop
    raw = np.frombuffer(packed, np.uint8)
    if bits in (8, 16, 32):
        width = bits // 8
        return raw[start * width : count * width].view(f"<u{width}").astype(np.uint32)
    low, skip = divmod(start * bits, 8)
    need = raw[low : (count * bits + 7) // 8]
    each = np.unpackbits(need, bitorder="little")[skip : skip + (count - start) * bits].reshape(-1, bits)
    wide = np.zeros((len(each), 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> None:
    """Encode whole texts in ascending doc_id order into packed blocks below ``path``.

    A NULL or empty text has the end id alone. Rows of equal doc_id follow each other by text, a NULL doc_id comes
    first, and other columns are ignored. A block closes behind the document with which it reaches ``block_ids``
    ids, so a longer document makes a longer block. An empty input writes an empty table.
    """
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(partial(_blocks, content(tokenizer), end_id, bits, block_ids), BLOCK_SCHEMA)
    # A page a block, so that a reader of one block does not fetch its neighbours.
    pages = {"compression": "zstd", "parquet.page.row.count.limit": "1", "parquet.block.size": str(ROW_GROUP_BYTES)}
    blocks.write.mode("overwrite").options(**pages).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The blocks below ``path`` with ``start``, the number of ids before each in the whole table.

    ``first`` counts within a part. The parts are the ranges of the writing job, so their totals stay a small table.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    starts = _part_starts(blocks)
    joined = blocks.join(F.broadcast(starts), "part")
    return joined.withColumn("start", F.col("part_start") + F.col("first")).drop("part_start")


def _part_starts(blocks: DataFrame) -> DataFrame:
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents of some ids, as ``documents`` gives them but without ``start``: only blocks around them are read.

    Repeated ids give every row of theirs; an id that is not there gives none. Documents without an id have no place
    to look up.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    near = [(F.col("low_doc") <= d) & (F.col("high_doc") >= d) for d in sorted(set(doc_ids))]
    here = blocks.where(reduce(or_, near, F.lit(False)))
    wanted = frozenset(doc_ids)
    found = here.select(F.lit(0).cast("long").alias("start"), "bits", "doc_ids", "offsets", "packed")
    return found.mapInArrow(partial(_documents, wanted), DOCUMENT_SCHEMA).drop("start")


def span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Ids ``start`` to ``stop`` of the whole table: rows of (start, ids), to be read in order of start.

    The totals of the parts tell which parts and blocks hold the range; no other block is read. Positions outside the
    table give nothing.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    parts = _part_starts(blocks).collect()
    near = []
    for r in parts:
        a, b = start - r["part_start"], stop - r["part_start"]
        near.append((F.col("part") == r["part"]) & (F.col("first") < b) & (F.col("first") + F.col("n_ids") > a))
    here = blocks.where(reduce(or_, near, F.lit(False))) if start < stop else blocks.limit(0)
    known = {r["part"]: r["part_start"] for r in parts}
    return here.select("part", "first", "n_ids", "bits", "packed").mapInArrow(partial(_span, known, start, stop), "start long, ids binary")


def _span(known: dict[int, int], start: int, stop: int, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            at = known[row["part"]] + row["first"]
            low, high = max(start, at), min(stop, at + row["n_ids"])
            rows.append((low, unpack(row["packed"], row["bits"], low - at, high - at).tobytes()))
        columns = list(zip(*rows)) if rows else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["start", "ids"])


def documents(blocks: DataFrame) -> DataFrame:
    """Unpack blocks of ``read``: per document doc_id, start, n_tokens and its ids as little-endian unsigned 32 bits."""
    return blocks.select("start", "bits", "doc_ids", "offsets", "packed").mapInArrow(partial(_documents, None), DOCUMENT_SCHEMA)


def digests(blocks: DataFrame) -> DataFrame:
    """Per document of ``read``: doc_id, start, n_tokens and the crc32 of its unpacked ids."""
    return documents(blocks).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _blocks(tokenizer: str, end_id: int, bits: int, block_ids: int, batches) -> Iterator[pa.RecordBatch]:
    coder = word_ids(tokenizer)
    part, block, before = TaskContext.get().partitionId(), 0, 0
    doc_ids: list[int | None] = []
    chunks: list[np.ndarray] = []
    offsets = [0]

    def close() -> pa.RecordBatch:
        nonlocal block, before, doc_ids, chunks, offsets
        ids = np.concatenate(chunks)
        named = [d for d in doc_ids if d is not None]
        ends = (named[0], named[-1]) if named else (None, None)
        row = (part, block, before, len(ids), bits, *ends, doc_ids, offsets, pack(ids, bits))
        block, before, doc_ids, chunks, offsets = block + 1, before + len(ids), [], [], [0]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = [column.split()[0] for column in BLOCK_SCHEMA.split(", ")]
    for batch in batches:
        for low, high in slices(batch.column(1)):
            ids, starts = coder.encode_all(batch.column(1).slice(low, high - low))
            ids, ends = np.insert(ids, starts[1:], end_id), (starts[1:] + np.arange(1, high - low + 1)).tolist()
            for doc_id, start, stop in zip(batch.column(0).slice(low, high - low).to_pylist(), [0, *ends], ends):
                chunks.append(ids[start:stop])
                doc_ids.append(doc_id)
                offsets.append(offsets[-1] + stop - start)
                if offsets[-1] >= block_ids:
                    yield close()
    if doc_ids:
        yield close()


def _documents(wanted: frozenset | None, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            places = [
                (d, a, b) for d, a, b in zip(row["doc_ids"], row["offsets"], row["offsets"][1:]) if wanted is None or d in wanted
            ]
            if not places:
                continue
            low = places[0][1]
            ids = unpack(row["packed"], row["bits"], low, places[-1][2]).tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([d for d, _, _ in places], pa.int64()),
                    "start": pa.array([row["start"] + a for _, a, _ in places], pa.int64()),
                    "n_tokens": pa.array([b - a for _, a, b in places], pa.int64()),
                    "ids": pa.array([ids[4 * (a - low) : 4 * (b - low)] for _, a, b in places], pa.binary()),
                }
            )
