"""Removal of repeated passages by level-wise doubling.

Windows of a short length come first. Only where a window is repeated somewhere, and so is the one right behind it,
can a window of twice the length be repeated; such places alone are candidates of the next level, until the wanted
length is reached or no candidate survives.

Documents are dealt into chunks once, by hash of doc_id, and stored as a table bucketed by chunk, so that no level moves
text again. For a level, every chunk sends the distinct hashes of its candidate windows, packed, to buckets of hash
space; a bucket answers with one bit per hash. So a window that fills the corpus costs one hash per chunk, and what
moves is a few bytes per window, whatever the repeats. Between levels only the candidates' places are kept.
"""

from __future__ import annotations

import gc
import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import words as W
from barloom.sources.staging import discard, work_path, write_shared

SENT = "bucket int, chunk long, hashes binary, several binary, owners binary, absent binary"
ANSWER = "chunk long, bucket int, n int, repeated binary, first binary"
DONE = "doc_id long, n_words long, n_removed long, kept string"
SENT_TYPES = [
    ("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary()), ("owners", pa.binary()),
    ("absent", pa.binary()),
]
ANSWER_TYPES = [("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("repeated", pa.binary()), ("first", pa.binary())]
DONE_TYPES = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
#: The bucket number of a row that holds the candidates' places of a chunk instead of an answer.
PLACES = -1


@dataclass(frozen=True)
class Settings:
    """The wanted length in words, the least length to begin with, and the text bytes of a chunk, a bucket and a task."""

    window: int = 20
    least: int = 8
    chunk_bytes: int = 4 << 20
    bucket_bytes: int = 8 << 20
    task_bytes: int = 32 << 20

    def levels(self) -> list[int]:
        lengths = [self.window]
        while lengths[0] % 2 == 0 and lengths[0] // 2 >= self.least:
            lengths.insert(0, lengths[0] // 2)
        return lengths


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each document without the words of passages that start earlier elsewhere: doc_id, n_words, n_removed, kept.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``window`` words covers it whose words
    also start earlier, in a smaller doc_id or before it in the same document; windows are judged on the input.
    ``kept`` joins the rest by one space. A NULL text has no words. Rows of one doc_id are documents of their own, in
    order of their texts; rows without doc_id come last, in order of a hash of their texts. Other columns are ignored;
    an empty input gives no row.

    Hashes below the wanted length have 32 bits within their bucket and only preselect. At the wanted length they have
    64 bits besides those that choose the bucket, so two different windows meet by chance about once in 10^13.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(-(-size // settings.task_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = max(-(-size // settings.chunk_bytes), 2 * tasks)
    buckets = max(-(-size // settings.bucket_bytes), tasks)
    place = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = _dealt(texts.select(F.pmod(place, F.lit(chunks)).alias("chunk"), "doc_id", "text"), tasks)
    places = path = None
    for length in settings.levels():
        answers = _answers(dealt, places, length, buckets, tasks, length == settings.window)
        if places is not None:
            answers = answers.unionByName(places)
        if length == settings.window:
            return _finished(dealt, answers, length)
        last_path = path
        places, path = write_shared(_narrowed(dealt, answers, length), "places")
        if last_path:
            discard(spark, last_path)
        _release(spark)
        if places.isEmpty():
            return _finished(dealt, places, settings.window)


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """The chunks as a stored table, bucketed so that grouping by chunk moves nothing.

    Only a table of the catalog keeps its buckets; its entry goes at once, its files when the application ends.
    """
    spark = rows.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    laid = rows.repartition(tasks, "chunk").sortWithinPartitions("chunk")
    writer = laid.write.format("parquet").option("compression", "zstd").option("path", f"{work_path(spark, 'chunks')}/table")
    writer.bucketBy(tasks, "chunk").sortBy("chunk").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    _release(spark)
    return table


def _release(spark) -> None:
    """Let go of the shuffle files of steps that are written: Spark deletes them once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _answers(dealt: DataFrame, places: DataFrame | None, length: int, buckets: int, tasks: int, last: bool) -> DataFrame:
    def send_all(table: pa.Table) -> pa.Table:
        return _send(length, buckets, last, table, None)

    def send(table: pa.Table, places: pa.Table) -> pa.Table:
        return _send(length, buckets, last, table, places)

    def answer(table: pa.Table) -> pa.Table:
        return _answer(last, table)

    by_chunk = dealt.groupBy("chunk")
    if places is None:
        sent = by_chunk.applyInArrow(send_all, SENT)
    else:
        sent = by_chunk.cogroup(places.groupBy("chunk")).applyInArrow(send, SENT)
    return sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(answer, ANSWER)


def _narrowed(dealt: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """The places of each chunk where a window of twice the length may be repeated; chunks without any are left out."""

    def narrow(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _narrow(length, table, answers)

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(narrow, ANSWER)


def _finished(dealt: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _finish(length, table, answers)

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, DONE)


@dataclass
class Chunk:
    """A chunk's documents in order, their words, and the distinct windows at the candidate places."""

    table: pa.Table
    first: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    distinct: np.ndarray
    index: np.ndarray
    inverse: np.ndarray
    count: np.ndarray


def _chunk(table: pa.Table, length: int, places: pa.Table | None) -> Chunk:
    """``places`` may hold answers too; without it every window is a candidate, without a row of places none is."""
    doc_ids, texts = (table.column(c).combine_chunks() for c in ("doc_id", "text"))
    absent = doc_ids.is_null()
    owners = doc_ids.to_pylist()
    for i in np.flatnonzero(absent.to_numpy(zero_copy_only=False)):
        text = texts[int(i)].as_py()
        owners[i] = int.from_bytes(hashlib.md5((text or "").encode()).digest()[:8], "little", signed=True)
    table = table.append_column("absent", absent.cast(pa.int8())).append_column("owner", pa.array(owners, pa.int64()))
    table = table.sort_by([("absent", "ascending"), ("owner", "ascending"), ("text", "ascending")]).combine_chunks()
    hashes, first = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    texts = table.column("text").combine_chunks()
    for part in W.slices(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts):
        hashes.append(part.hashes())
        first.append(part.first[1:] + first[-1][-1])
    words, first = np.concatenate(hashes), np.concatenate(first)
    if places is None:
        starts = W.full_starts(first, length)
    else:
        kept = [(n, s) for b, n, s in zip(*(places.column(c).to_pylist() for c in ("bucket", "repeated", "first"))) if b == PLACES]
        starts = np.empty(0, np.int64)
        if kept:
            counts, starts = np.frombuffer(kept[0][0], np.int32), np.frombuffer(kept[0][1], np.int32).astype(np.int64)
            starts += np.repeat(first[:-1], counts)
    found = W.windows(words, starts, length)
    return Chunk(table, first, words, starts, *np.unique(found, return_index=True, return_inverse=True, return_counts=True))


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _send(length: int, buckets: int, last: bool, table: pa.Table, places: pa.Table | None) -> pa.Table:
    number = table.column("chunk")[0].as_py() if table.num_rows else 0
    if not table.num_rows or (places is not None and not places.num_rows):
        return pa.table({n: pa.array([], t) for n, t in SENT_TYPES})
    chunk = _chunk(table, length, places)
    hashes, several = chunk.distinct, chunk.count > 1
    edges = np.searchsorted(_bucket_of(hashes, buckets), np.arange(buckets + 1))
    owners = absent = None
    if last:
        at = chunk.starts[chunk.index]
        payload = W.windows(chunk.words, at, length, seed=1)
        document = np.searchsorted(chunk.first, at, side="right") - 1
        owners = chunk.table.column("owner").to_numpy()[document].astype(np.int64)
        absent = chunk.table.column("absent").to_numpy()[document].astype(bool)
    else:
        payload = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    rows = [(b, slice(edges[b], edges[b + 1])) for b in np.flatnonzero(np.diff(edges))]
    columns = {
        "bucket": [b for b, _ in rows],
        "chunk": [number] * len(rows),
        "hashes": [payload[s].tobytes() for _, s in rows],
        "several": [np.packbits(several[s]).tobytes() for _, s in rows],
        "owners": [owners[s].tobytes() if last else None for _, s in rows],
        "absent": [np.packbits(absent[s]).tobytes() if last else None for _, s in rows],
    }
    return pa.table({n: pa.array(columns[n], t) for n, t in SENT_TYPES})


def _answer(last: bool, table: pa.Table) -> pa.Table:
    kind = np.uint64 if last else np.uint32
    lists = [np.frombuffer(x.as_py(), kind) for x in table.column("hashes")]
    sizes = np.array([len(x) for x in lists])
    hashes = np.concatenate(lists)
    several = np.concatenate([_bits(x.as_py(), n) for x, n in zip(table.column("several"), sizes)])
    _, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
    repeated = (count > 1) | (np.bincount(inverse, weights=several) > 0)
    first = np.zeros(len(hashes), bool)
    if last:
        owners = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("owners")])
        absent = np.concatenate([_bits(x.as_py(), n) for x, n in zip(table.column("absent"), sizes)])
        chunks = np.repeat(table.column("chunk").to_numpy(), sizes)
        order = np.lexsort((chunks, owners, absent, inverse))
        first[order[np.concatenate(([True], np.diff(inverse[order]) != 0))]] = True
    edges = np.concatenate(([0], np.cumsum(sizes)))
    pieces = [slice(a, b) for a, b in zip(edges, edges[1:])]
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "bucket": table.column("bucket"),
            "n": pa.array(sizes, pa.int32()),
            "repeated": pa.array([np.packbits(repeated[inverse[s]]).tobytes() for s in pieces], pa.binary()),
            "first": pa.array([np.packbits(first[s]).tobytes() for s in pieces], pa.binary()),
        }
    )


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=int(n)).astype(bool)


def _flags(answers: pa.Table, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Whether each candidate is repeated, and whether its hash was first sent by this chunk."""
    answered = answers.filter(pc.not_equal(answers.column("bucket"), PLACES)).sort_by("bucket")
    sizes = answered.column("n").to_pylist()
    parts = ([_bits(x.as_py(), n) for x, n in zip(answered.column(c), sizes)] for c in ("repeated", "first"))
    return tuple(np.concatenate([np.empty(0, bool), *p])[chunk.inverse] for p in parts)


def _narrow(length: int, table: pa.Table, answers: pa.Table) -> pa.Table:
    nothing = pa.table({n: pa.array([], t) for n, t in ANSWER_TYPES})
    if not table.num_rows or not answers.num_rows:
        return nothing
    held = pc.any(pc.equal(answers.column("bucket"), PLACES)).as_py()
    chunk = _chunk(table, length, answers if held else None)
    repeated, _ = _flags(answers, chunk)
    here = np.zeros(len(chunk.words) + length, bool)
    here[chunk.starts[repeated]] = True
    both = np.flatnonzero(here[: len(chunk.words)] & here[length : length + len(chunk.words)])
    owner = np.searchsorted(chunk.first, both, side="right") - 1
    inside = both + 2 * length <= chunk.first[owner + 1]
    both, owner = both[inside], owner[inside]
    if not len(both):
        return nothing
    counts = np.bincount(owner, minlength=chunk.table.num_rows).astype(np.int32)
    starts = (both - chunk.first[owner]).astype(np.int32)
    row = (table.column("chunk")[0].as_py(), PLACES, chunk.table.num_rows, counts.tobytes(), starts.tobytes())
    return pa.table({n: pa.array([v], t) for v, (n, t) in zip(row, ANSWER_TYPES)})


def _finish(length: int, table: pa.Table, answers: pa.Table) -> pa.Table:
    if not table.num_rows:
        return pa.table({n: pa.array([], t) for n, t in DONE_TYPES})
    held = not answers.num_rows or pc.any(pc.equal(answers.column("bucket"), PLACES)).as_py()
    chunk = _chunk(table, length, answers if held else None)
    repeated, first = _flags(answers, chunk)
    covered = np.zeros(len(chunk.words) + 1, np.int64)
    earliest = np.zeros(len(chunk.starts), bool)
    earliest[chunk.index] = True
    later = chunk.starts[repeated & ~(first & earliest)]
    np.add.at(covered, later, 1)
    np.add.at(covered, later + length, -1)
    gone = np.cumsum(covered[:-1]) > 0
    kept, removed = [], []
    for i, text in enumerate(chunk.table.column("text").to_pylist()):
        words, out = (text or "").encode().split(), gone[chunk.first[i] : chunk.first[i + 1]]
        removed.append(int(out.sum()))
        kept.append(b" ".join(w for w, o in zip(words, out.tolist()) if not o) if removed[-1] else b" ".join(words))
    columns = (chunk.table.column("doc_id").to_pylist(), np.diff(chunk.first), removed, [k.decode() for k in kept])
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, DONE_TYPES)})
