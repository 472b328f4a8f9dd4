"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its five-word shingles, each with its number of occurrences. Every element owns a region
of its weight, and a Poisson process of hashed darts falls on the plane of weight and rank. Darts are the same for
equal elements of all documents; a document keeps those inside its regions and, per coordinate, the earliest one. Two
documents agree in a coordinate with the probability of their weighted Jaccard similarity. Ranks are visited cell by
cell only until every coordinate has a dart, so a signature costs about one pass over the shingles.

Bands of the signature join documents into buckets. Candidate pairs are checked on their whole shingle sets; classes
are the connected components of the links. Equal texts are one node from the start, and a bucket is first resolved
by its most typical member, so copies are never expanded into pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import words as W
from barloom.sources.staging import discard, write_shared

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Rank cells: 1/64, then doubling up to 1, then one unit each.
EDGES = (0.0, *(2.0**e for e in range(-6, 1)))


@dataclass(frozen=True)
class Settings:
    """``bands`` of ``rows`` coordinates each; at 0.8 a pair is missed with probability (1 - 0.8^4)^32 < 1e-7."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 4
    block: int = 512


#: Contents with more than this part of all copies are joined without a shuffle.
HOT_SHARE = 4096


def content_key(text: Column) -> Column:
    """128 bits of a text; NULL counts as the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, content_key, class_id.

    ``class_id`` is the least doc_id of the class. Texts without words, NULL among them, have no shingle and are
    classes of their own, as are rows without doc_id (their class is NULL). A text of fewer words than a shingle is
    one shingle. Repeated rows are equal texts. A doc_id is expected to name one text: where it comes with another as
    well, both texts are classed, but share their links. Other columns are ignored; an empty input gives no row.
    """
    key = content_key(F.col("text")).alias("content_key")
    signed, signed_path = write_shared(
        docs.select("doc_id", key, "text").mapInArrow(
            partial(_signatures, settings), "doc_id long, content_key binary, bands array<long>"
        ),
        "signatures",
    )
    full = signed.where("bands is not null and doc_id is not null")
    nodes = full.groupBy("content_key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    buckets, bucket_path = write_shared(_shared_buckets(nodes), "buckets")
    ids = buckets.select("node").distinct()
    # Both sides grow with the corpus, so the plan is the same at every size.
    texts = docs.select("doc_id", "text").join(ids.withColumnRenamed("node", "doc_id").hint("shuffle_merge"), "doc_id")
    columns, column_path = write_shared(
        texts.mapInArrow(partial(_columns, settings), "doc_id long, columns array<int>").dropDuplicates(["doc_id"]), "shingles"
    )
    roots = _link(buckets, columns, settings)
    known = full.groupBy("content_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    named, named_path = write_shared(
        known.join(roots, "node", "left").select("content_key", "copies", F.coalesce("root", "node").alias("class_id")), "classes"
    )
    out = _spread_join(signed.withColumn("worded", F.col("bands").isNotNull()), named)
    linked = F.col("worded") & F.col("doc_id").isNotNull()
    class_id = F.when(linked, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")
    result = out.select("doc_id", "content_key", class_id)
    for used in (bucket_path, column_path):
        discard(docs.sparkSession, used)
    return result


def _spread_join(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with the class of their content; copies of one text do not meet in one task.

    Contents that hold more than 1 / ``HOT_SHARE`` of all copies, so fewer than ``HOT_SHARE`` contents, are looked up
    in a broadcast table where their rows lie; only the rows of all others are shuffled.
    """
    least = named.agg((F.sum("copies") / HOT_SHARE).alias("least")).scalar()
    hot = F.broadcast(named.where(F.col("copies") > least).select("content_key", "class_id"))
    rare = named.where(F.col("copies") <= least).select("content_key", "class_id")
    spread = rows.join(hot, "content_key")
    return spread.unionByName(rows.join(hot, "content_key", "left_anti").join(rare, "content_key", "left"))


def keep(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each class, all columns as they were: the row whose doc_id names the class.

    Of repeated rows (equal doc_id and text) one stays. Rows without doc_id stay. Columns of any name pass through.
    """
    chosen = classes(docs, settings).where("doc_id = class_id").select("doc_id", "content_key").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.where("doc_id is not null").select("doc_id", content_key(F.col("text")).alias("content_key"), row)
    once = rows.join(chosen, ["doc_id", "content_key"], "left_semi").dropDuplicates(["doc_id", "content_key"])
    return once.select("row.*").unionByName(docs.where("doc_id is null"))


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, degree) of the buckets that several nodes share.

    The degree of a node is the number of members of all its buckets: high for a text that many others resemble.
    """
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    several = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = spread.join(several, "bucket")
    return shared.join(shared.groupBy("node").agg(F.sum("members").alias("degree")), "node").drop("members")


def _link(buckets: DataFrame, columns: DataFrame, settings: Settings) -> DataFrame:
    """Roots (node, root) of all links between nodes of a bucket.

    Stars come first: every node is compared with one node of high degree from its buckets, then in each bucket the
    best node of every component with the best one of the largest. In what is left, the members of a bucket outside
    its largest component are compared with all its members, so no link between components is lost.
    """
    spark = buckets.sparkSession
    best = F.max(F.struct("degree", (-F.col("node")).alias("minus"))).alias("best")
    leads = buckets.groupBy("bucket").agg(best)
    first = buckets.join(leads, "bucket").where("node <> -best.minus").groupBy("node").agg(F.max("best").alias("best"))
    pairs = first.select("node", (-F.col("best.minus")).alias("other"))
    roots, roots_path = _joined(None, _verified(_ordered(pairs), columns, settings), "")
    for last in (False, True):
        placed = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"), best)
        home = parts.groupBy("bucket").agg(
            F.max(F.struct("n", "best", "root")).alias("home"), F.count("*").alias("parts"), F.sum("n").alias("members")
        )
        if last:
            found = _compared(placed, home.where("parts > 1 and members > 2"), columns, settings)
        else:
            mixed = parts.join(home.where("parts > 1"), "bucket").where("root <> home.root")
            pairs = mixed.select((-F.col("best.minus")).alias("node"), (-F.col("home.best.minus")).alias("other"))
            found = _verified(_ordered(pairs), columns, settings)
        roots, roots_path = _joined(roots, found, roots_path)
    return roots


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _joined(roots: DataFrame | None, found: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Roots after further links."""
    known = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(found) if roots else found
    out = write_shared(components(known), "roots")
    if path:
        discard(found.sparkSession, path)
    return out


def _compared(placed: DataFrame, home: DataFrame, columns: DataFrame, settings: Settings) -> DataFrame:
    """Links between components of a bucket: those outside its home component against all members.

    Both sides are dealt in blocks, and a task compares two blocks on an inverted list of shingles. A block of many
    members reaches as many tasks as there are blocks of outsiders, which are few after the stars. Buckets with equal
    members are compared once.
    """
    same = placed.join(home.select("bucket"), "bucket").groupBy("bucket").agg(
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n")
    )
    once = same.groupBy("sum", "n").agg(F.min("bucket").alias("bucket")).select("bucket")
    kept = home.join(once, "bucket").select(
        "bucket", F.col("home.root").alias("home_root"),
        F.ceil(F.col("members") / settings.block).cast("int").alias("inner_blocks"),
        F.ceil((F.col("members") - F.col("home.n")) / settings.block).cast("int").alias("outer_blocks"),
    )
    rows = placed.join(kept, "bucket")
    inner = rows.select(
        "bucket", "node", "root", F.lit(False).alias("outside"),
        F.pmod(F.xxhash64("node"), "inner_blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)).alias("j"),
    )
    outer = rows.where("root <> home_root").select(
        "bucket", "node", "root", F.lit(True).alias("outside"),
        F.explode(F.sequence(F.lit(0), F.col("inner_blocks") - 1)).alias("i"),
        F.pmod(F.xxhash64("node"), "outer_blocks").cast("int").alias("j"),
    )
    dealt = inner.unionByName(outer).join(columns.withColumnRenamed("doc_id", "node"), "node")

    def compare(table: pa.Table) -> pa.Table:
        return _compare(settings.similarity, table)

    return dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _compare(similarity: float, table: pa.Table) -> pa.Table:
    """One link from each outsider to each other component that has a member it resembles."""
    nodes, roots = table.column("node").to_numpy(), table.column("root").to_numpy()
    outside = table.column("outside").to_numpy(zero_copy_only=False)
    lists = [x.values.to_numpy() for x in table.column("columns")]
    inner = np.flatnonzero(~outside)
    sizes = np.array([len(lists[i]) for i in inner])
    everything = np.concatenate([lists[i] for i in inner]) if len(inner) else np.empty(0, np.int32)
    order = np.argsort(everything, kind="stable")
    shingles, owner = everything[order], np.repeat(np.arange(len(inner)), sizes)[order]
    found = []
    for o in np.flatnonzero(outside):
        low, high = (np.searchsorted(shingles, lists[o], side=side) for side in ("left", "right"))
        count = high - low
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(owner[at], minlength=len(inner))
        alike = common >= similarity * (sizes + len(lists[o]) - common)
        hits = inner[alike & (roots[inner] != roots[o])]
        _, one = np.unique(roots[hits], return_index=True)
        found += [(min(nodes[o], n), max(nodes[o], n)) for n in nodes[hits[one]]]
    columns = list(zip(*found)) if found else [[], []]
    return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})


def _verified(pairs: DataFrame, columns: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose shingle sets reach the similarity."""
    right = columns.select(F.col("doc_id").alias("b"), F.col("columns").alias("of_b"))
    left = columns.select(F.col("doc_id").alias("a"), F.col("columns").alias("of_a"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(common >= settings.similarity * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """Root, the least node, of every node of a graph (a, b), by alternating stars.

    The large star ties every node's greater neighbours to its least one, the small star ties the lesser ones; both
    keep the components, and a few alternations leave one star for each. Each step is a written table.
    """
    spark = links.sparkSession
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, path = write_shared(pairs.distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = tied.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        again, again_path = write_shared(small, "edges")
        discard(spark, path)
        edges, path = again, again_path
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _shingles(part: W.Words, size: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of each document of a slice, with repeats."""
    hashes, first = part.hashes(), part.first
    starts = W.full_starts(first, size)
    windows = W.windows(hashes, starts, size)
    edges = np.searchsorted(starts, first)
    for i in range(len(first) - 1):
        n = first[i + 1] - first[i]
        if n >= size:
            yield windows[edges[i] : edges[i + 1]]
        elif n:
            yield W.windows(hashes, first[i : i + 1], int(n), int(n))
        else:
            yield np.empty(0, np.uint64)


def unit_columns(shingles: np.ndarray) -> np.ndarray:
    """The region of each element cut into columns of weight one: a hash for every (shingle, occurrence)."""
    elements, weights = np.unique(shingles, return_counts=True)
    if len(elements) == len(shingles):
        return elements
    place = np.arange(len(shingles)) - np.repeat(np.cumsum(weights) - weights, weights)
    keys = np.repeat(elements, weights)
    return np.where(place == 0, keys, W.mix(keys + place.astype(np.uint64) * GOLDEN))


def cell(number: int) -> tuple[float, float]:
    """Start and width of a rank cell."""
    last = len(EDGES) - 1
    return (EDGES[number], EDGES[number + 1] - EDGES[number]) if number < last else (float(number - last + 1), 1.0)


def _counts(width: float) -> np.ndarray:
    """Thresholds on 64-bit hashes for the number of darts of a Poisson law of mean ``width``."""
    p, total, out = math.exp(-width), math.exp(-width), []
    for n in range(1, 20):
        out.append(min(int(total * 2**64), 2**64 - 1))
        p *= width / n
        total += p
    return np.array(out, np.uint64)


_LAWS = [_counts(cell(number)[1]) for number in range(len(EDGES))]


def signature(columns: np.ndarray, size: int) -> np.ndarray:
    """The earliest dart of each of ``size`` coordinates (a power of two), as the dart's hash."""
    rank = np.full(size, np.inf)
    dart = np.zeros(size, np.uint64)
    reach = size * (math.log(size) + 3) / len(columns)
    number = 0
    while not np.isfinite(rank).all():
        last = number + 1
        while sum(cell(last - 1)) < reach:
            last += 1
        cells = np.arange(number, last)
        keys = W.mix(columns[None, :] ^ W.mix((cells + 1).astype(np.uint64) * GOLDEN)[:, None])
        chance = W.mix(keys)
        for_cell = np.empty(keys.shape, np.int64)
        for i, c in enumerate(cells[: max(0, len(EDGES) - 1 - number)]):
            for_cell[i] = np.searchsorted(_LAWS[c], chance[i], side="right")
        done = min(len(cells), max(0, len(EDGES) - 1 - number))
        if done < len(cells):
            for_cell[done:] = np.searchsorted(_LAWS[-1], chance[done:], side="right")
        count = for_cell.reshape(-1)
        thrown = np.repeat(keys.reshape(-1), count)
        turn = np.arange(len(thrown)) - np.repeat(np.cumsum(count) - count, count)
        darts = W.mix(thrown + (turn + 1).astype(np.uint64) * GOLDEN)
        shape = np.array([cell(int(c)) for c in cells])
        start, width = (np.repeat(np.repeat(shape[:, j], len(columns)), count) for j in (0, 1))
        ranks = start + width * ((darts >> np.uint64(11)).astype(np.float64) / 2.0**53)
        at = (darts & np.uint64(size - 1)).astype(np.int64)
        order = np.argsort(-ranks, kind="stable")  # the last write to a coordinate is its earliest dart
        best, best_dart = np.full(size, np.inf), np.zeros(size, np.uint64)
        best[at[order]], best_dart[at[order]] = ranks[order], darts[order]
        fresh = best < rank
        rank[fresh], dart[fresh] = best[fresh], best_dart[fresh]
        number, reach = last, sum(cell(last - 1)) * 1.5
    return dart


def _signatures(settings: Settings, batches) -> Iterator[pa.RecordBatch]:
    size = settings.bands * settings.rows
    factors = W.mix(np.arange(1, settings.rows + 1).astype(np.uint64) * GOLDEN) | np.uint64(1)
    offsets = W.mix(np.arange(1, settings.bands + 1).astype(np.uint64))
    for batch in batches:
        for part in W.slices(batch.column(2)):
            bands = []
            for shingles in _shingles(part, settings.shingle):
                if not len(shingles):
                    bands.append(None)
                    continue
                darts = signature(unit_columns(shingles), size).reshape(settings.bands, settings.rows)
                bands.append(W.mix((darts * factors).sum(axis=1, dtype=np.uint64) + offsets).view(np.int64))
            rows = part.rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[rows], batch.column(1)[rows], pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "content_key", "bands"],
            )


def _columns(settings: Settings, batches) -> Iterator[pa.RecordBatch]:
    """Distinct columns of each document, folded to 32 bits: two texts of n columns share one by chance in n^2 / 2^32."""
    for batch in batches:
        for part in W.slices(batch.column(1)):
            folded = [
                np.unique((unit_columns(s) >> np.uint64(32)).astype(np.uint32).view(np.int32)) for s in _shingles(part, settings.shingle)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[part.rows], pa.array(folded, pa.list_(pa.int32()))], names=["doc_id", "columns"]
            )
