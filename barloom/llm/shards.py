"""Best-fit-decreasing bin packing of indivisible groups into shards.

Groups sorted by size, largest first, enter the bin with the tightest remaining capacity that holds them. The bins'
remaining capacities lie in a balanced tree. Groups below a small share of all bytes are first poured into parcels by
the hash of their key, so the list to sort has a fixed bound, however many groups there are, and a group still never
divides.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARCELS = 4096
SLOT_BUCKETS = 256
FANOUT = 64


class CapacityTree:
    """Ordered (remaining, bin) pairs in a two-level B-tree: leaves split at ``FANOUT`` entries."""

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.lows: list[tuple[int, int]] = [(0, 0)]

    def add(self, remaining: int, number: int) -> None:
        at = max(0, bisect_left(self.lows, (remaining, number + 1)) - 1)
        leaf = self.leaves[at]
        insort(leaf, (remaining, number))
        if len(leaf) > FANOUT:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.lows.insert(at + 1, leaf[half])

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry of least remaining capacity that is at least ``size``."""
        at = max(0, bisect_left(self.lows, (size, -1)) - 1)
        while at < len(self.leaves):
            leaf = self.leaves[at]
            i = bisect_left(leaf, (size, -1))
            if i < len(leaf):
                found = leaf.pop(i)
                if not leaf and len(self.leaves) > 1 and at:
                    del self.leaves[at], self.lows[at]
                return found
            at += 1
        return None


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item, bins numbered in order of opening; an item above the capacity has a bin to itself."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    tree, bins, opened = CapacityTree(), [0] * len(sizes), 0
    for i in order:
        found = tree.take_tightest(sizes[i])
        remaining, number = found if found else (max(capacity, sizes[i]), opened)
        opened += found is None
        bins[i] = number
        tree.add(remaining - sizes[i], number)
    return bins


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """Best-fit-decreasing at the least capacity that needs no more than ``shards`` bins, so that sizes come near equal.

    An item of more than an even share of what is left gets a shard of its own first.
    """
    out = [0] * len(sizes)
    rest = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    used, left = 0, sum(sizes)
    while rest and shards - used > 1 and sizes[rest[0]] * (shards - used) >= left:
        out[rest[0]] = used
        left -= sizes[rest[0]]
        used += 1
        rest = rest[1:]
    if not rest:
        return out
    amounts, bins = [sizes[i] for i in rest], shards - used
    low, high = -(-left // bins), 2 * -(-left // bins) + amounts[0]
    while low < high:
        middle = (low + high) // 2
        if max(best_fit_decreasing(amounts, middle)) < bins:
            high = middle
        else:
            low = middle + 1
    for i, number in zip(rest, best_fit_decreasing(amounts, low)):
        out[i] = used + number
    return out


def assign(docs: DataFrame, shards: int, parcels: int = PARCELS) -> DataFrame:
    """Shard and slot of every document: shard sizes in bytes near equal, equal texts always in one shard.

    Columns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, shard, slot. A NULL text counts as the empty
    one. Slots run gapless from 0 in each shard, by hash of doc_id in buckets, so no shard is sorted in one task.
    Repeated rows are equal texts; a NULL doc_id is a document like others; other columns are ignored; an empty
    input gives no row. Items on the driver: at most ``parcels`` parcels and ``parcels`` groups of more than
    1 / ``parcels`` of all bytes.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group_key"),
    ).withColumn("parcel", F.pmod(F.xxhash64("group_key"), F.lit(parcels)).cast("int"))
    groups = rows.groupBy("group_key", "parcel").agg(F.sum("size").alias("size"))
    least = groups.agg((F.sum("size") / parcels).alias("least")).scalar()
    named = groups.withColumn("large_key", F.when(F.col("size") > least, F.col("group_key")))
    items = named.groupBy("parcel", "large_key").agg(F.sum("size").alias("size")).collect()
    items.sort(key=lambda r: (r["parcel"], bytes(r["large_key"] or b"")))
    placed = into_shards([r["size"] for r in items], shards)
    spark = docs.sparkSession
    small = [(r["parcel"], s) for r, s in zip(items, placed) if r["large_key"] is None]
    large = [(bytes(r["large_key"]), s) for r, s in zip(items, placed) if r["large_key"] is not None]
    by_parcel = spark.createDataFrame(small, "parcel int, parcel_shard int")
    by_group = spark.createDataFrame(large, "group_key binary, group_shard int")
    placed_rows = (
        rows.join(F.broadcast(by_group), "group_key", "left")
        .join(F.broadcast(by_parcel), "parcel", "left")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.coalesce("group_shard", "parcel_shard").alias("shard"),
            F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_BUCKETS)).cast("int").alias("bucket"),
        )
    )
    return _slots(placed_rows)


def _slots(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32"))
    return (
        rows.withColumn("rank", rank)
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).alias("slot"))
    )
