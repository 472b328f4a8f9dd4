"""Centroid clustering by Lloyd's rounds sharded over dimensions.

Vectors are cut into chunks of rows and each chunk into column blocks, stored apart by block. A task on one block adds
up exact integer distances to the centroids' slices of that block alone. Partial distances meet by chunk, are added
and give each vector its nearest centroid. Every block then gets the labels back, sums its own columns per centroid and
updates its own slice. A chunk holds a bounded number of rows, so no key grows with the data, however many vectors are
equal. The driver holds centroids only: clusters times dimensions integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources.staging import discard, work_path, write_shared

#: Components beyond this are refused: distances of up to 64 components would no longer fit into 64 bits.
LARGEST = 1 << 27
CHUNK_ROWS = 2048

TILES = "chunk long, block int, n int, ids binary, nulls binary, tile binary, width int"


@dataclass(frozen=True)
class Settings:
    """``seed`` is the text before ``:<vec_id>`` whose hashes choose the first centroids."""

    clusters: int = 16
    rounds: int = 3
    dimensions: int = 64
    scale: int = 64
    blocks: int = 4
    seed: str = "1"

    def __post_init__(self):
        if self.dimensions > 64 or self.clusters < 1 or not 1 <= self.blocks <= self.dimensions:
            raise ValueError("clusters and blocks must be positive, dimensions at most 64, blocks at most dimensions")

    def columns(self) -> list[slice]:
        edges = [self.dimensions * b // self.blocks for b in range(self.blocks + 1)]
        return [slice(a, b) for a, b in zip(edges, edges[1:])]


def integers(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Columns vec_id and v, ``floor(scale * x)`` of every vector that has all its components, none NULL or non-finite."""
    x = F.col("embedding")
    whole = (F.size(x) == settings.dimensions) & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    )
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * settings.scale))
    kept = vectors.select("vec_id", F.when(whole, x).alias("embedding")).where(F.col("embedding").isNotNull())
    far = F.exists(x, lambda c: F.abs(c.cast("double") * settings.scale) >= LARGEST)
    return kept.select("vec_id", F.when(far, F.raise_error(F.lit(f"a component times {settings.scale} exceeds {LARGEST}"))).otherwise(scaled).alias("v"))


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, list[list[int]]]:
    """Columns vec_id, cluster and distance (squared) of every kept vector, and the final centroids.

    Vectors of another length, NULL ones and those with NULL, NaN or infinite components are left out. The first
    centroids are the vectors of least sha256 of ``seed:vec_id``; of equal ids the least vector comes first, NULL ids
    come last. With fewer vectors than clusters there are fewer centroids. Repeated rows are vectors of their own; equal
    distances go to the smaller centroid; an empty centroid stays where it was; other columns are ignored; an empty
    table gives no row. A component too large for exact 64-bit distances raises an error.
    """
    rows = integers(vectors, settings)
    hashed = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.withColumn("hash", hashed).orderBy(F.col("hash").asc_nulls_last(), "v").limit(settings.clusters)
    centroids = np.array([r["v"] for r in first.collect()], np.int64).reshape(-1, settings.dimensions)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), []
    cut = rows.mapInArrow(partial(_tiles, settings), TILES)
    path = _write_blocks(cut)
    tiles = vectors.sparkSession.read.schema(TILES).parquet(path)
    for _ in range(settings.rounds):
        centroids = _update(tiles, nearest(tiles, centroids, settings), centroids, settings)
    ids = tiles.where("block = 0").select("chunk", "ids", "nulls", "n")
    placed = ids.join(nearest(tiles, centroids, settings).drop("n"), "chunk").mapInArrow(
        _rows, "vec_id long, cluster int, distance long"
    )
    done, _ = write_shared(placed, "clusters")
    discard(vectors.sparkSession, path)
    return done, centroids.tolist()


def nearest(tiles: DataFrame, centroids: np.ndarray, settings: Settings) -> DataFrame:
    """Labels and squared distances of every chunk: blocks measure their columns, the sum over blocks decides."""
    slices = [centroids[:, s] for s in settings.columns()]
    parts = tiles.select("chunk", "block", "n", "tile", "width").mapInArrow(
        partial(_partial_distances, slices), "chunk long, n int, part binary, width int"
    )
    clusters = len(centroids)

    def argmin(table: pa.Table) -> pa.Table:
        return _argmin(clusters, table)

    return parts.groupBy("chunk").applyInArrow(argmin, "chunk long, n int, labels binary, distances binary")


def _update(tiles: DataFrame, labels: DataFrame, centroids: np.ndarray, settings: Settings) -> np.ndarray:
    """Each block moves its own slice: exact floor of the mean of its columns, empty centroids as they were."""
    joined = tiles.select("chunk", "block", "n", "tile", "width").join(labels.select("chunk", "labels"), "chunk")
    sums = joined.select("block", "n", "tile", "width", "labels").mapInArrow(
        partial(_block_sums, len(centroids)), "block int, centroid int, rows long, sums array<long>"
    )
    each = sums.select("block", "centroid", "rows", F.posexplode("sums").alias("column", "part"))
    totals = each.groupBy("block", "centroid", "column").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    )
    slices = [centroids[:, s].tolist() for s in settings.columns()]

    def move(table: pa.Table) -> pa.Table:
        return _moved(slices, table)

    moved = totals.groupBy("block").applyInArrow(move, "block int, slice array<array<long>>").collect()
    out = centroids.copy()
    for row in moved:
        out[:, settings.columns()[row["block"]]] = row["slice"]
    return out


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256, from one row per cluster."""
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [
        (c, sums.get(c, 0), hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()) for c, values in enumerate(centroids)
    ]
    by_cluster = placed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    total = F.lit(sum(sums.values())).cast("long").alias("inertia")
    return placed.join(F.broadcast(by_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", total, "centroid_sha256"
    )


def _write_blocks(tiles: DataFrame) -> str:
    path = work_path(tiles.sparkSession, "tiles")
    tiles.write.mode("overwrite").partitionBy("block").option("compression", "zstd").parquet(path)
    return path


def _pack(values: np.ndarray) -> tuple[bytes, int]:
    """Little-endian bytes of the least integer width that holds all values."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return values.astype(f"<i{width}").tobytes(), width


def _unpack(data: bytes, width: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").astype(np.int64).reshape(n, -1)


def _tiles(settings: Settings, batches) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 33
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            ids, vectors = (batch.slice(at, CHUNK_ROWS).column(i) for i in range(2))
            n = len(ids)
            matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, settings.dimensions)
            rows = []
            for b, columns in enumerate(settings.columns()):
                tile, width = _pack(np.ascontiguousarray(matrix[:, columns]))
                known = (ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes()) if b == 0 else (None, None)
                rows.append((chunk, b, n, *known, tile, width))
            chunk += 1
            yield _batch(rows, [("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("nulls", pa.binary()), ("tile", pa.binary()), ("width", pa.int32())])


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _partial_distances(slices: list[np.ndarray], batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, block, n, tile, width in zip(*(batch.column(i).to_pylist() for i in range(5))):
            values, own = _unpack(tile, width, n), slices[block]
            part = np.empty((n, len(own)), np.int64)
            for c, centre in enumerate(own):
                gap = values - centre
                part[:, c] = np.einsum("ij,ij->i", gap, gap)
            data, width = _pack(part)
            yield _batch([(chunk, n, data, width)], [("chunk", pa.int64()), ("n", pa.int32()), ("part", pa.binary()), ("width", pa.int32())])


def _argmin(clusters: int, group: pa.Table) -> pa.Table:
    """Adds the partial distances of all blocks of a chunk; argmin takes the first, so ties go to the smaller number."""
    n = group.column("n")[0].as_py()
    total = np.zeros((n, clusters), np.int64)
    for part, width in zip(group.column("part").to_pylist(), group.column("width").to_pylist()):
        total += _unpack(part, width, n)
    labels = total.argmin(1)
    least = total[np.arange(n), labels]
    row = (group.column("chunk")[0].as_py(), n, labels.astype("<i4").tobytes(), least.astype("<i8").tobytes())
    return pa.Table.from_batches([_batch([row], [("chunk", pa.int64()), ("n", pa.int32()), ("labels", pa.binary()), ("distances", pa.binary())])])


def _block_sums(clusters: int, batches) -> Iterator[pa.RecordBatch]:
    """Sums and counts of each centroid over the task's tiles of a block; a sum is passed on before it could overflow."""
    fields = [("block", pa.int32()), ("centroid", pa.int32()), ("rows", pa.int64()), ("sums", pa.list_(pa.int64()))]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def rows(block: int) -> list[tuple]:
        sums, counts = held.pop(block)
        return [(block, int(c), int(counts[c]), sums[c].tolist()) for c in np.flatnonzero(counts)]

    for batch in batches:
        for block, n, tile, width, labels in zip(*(batch.column(i).to_pylist() for i in range(5))):
            values, label = _unpack(tile, width, n), np.frombuffer(labels, "<i4")
            sums, counts = held.setdefault(block, (np.zeros((clusters, values.shape[1]), np.int64), np.zeros(clusters, np.int64)))
            counts += np.bincount(label, minlength=clusters)
            np.add.at(sums, label, values)
            if np.abs(sums).max() > 1 << 61:
                yield _batch(rows(block), fields)
    for block in list(held):
        if found := rows(block):
            yield _batch(found, fields)


def _moved(slices: list[list[list[int]]], group: pa.Table) -> pa.Table:
    """One row per centroid and column of a block; Python integers keep the division exact."""
    block = group.column("block")[0].as_py()
    own = [list(s) for s in slices[block]]
    for centroid, column, n, total in zip(*(group.column(c).to_pylist() for c in ("centroid", "column", "rows", "total"))):
        own[centroid][column] = int(total) // n
    return pa.table({"block": pa.array([block], pa.int32()), "slice": pa.array([own], pa.list_(pa.list_(pa.int64())))})


def _rows(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("ids", "nulls", "labels", "distances"))
        for ids, nulls, labels, distances in zip(*columns):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(ids, "<i8"), pa.int64(), mask=np.frombuffer(nulls, bool)),
                    pa.array(np.frombuffer(labels, "<i4"), pa.int32()),
                    pa.array(np.frombuffer(distances, "<i8"), pa.int64()),
                ],
                names=["vec_id", "cluster", "distance"],
            )
