import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import shards

SCHEMA = "doc_id long, text string, size string, shard string"


def plain_best_fit(sizes, capacity):
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fitting = [(room, b) for b, room in enumerate(bins) if room >= sizes[i]]
        if fitting:
            room, b = min(fitting)
        else:
            room, b = max(capacity, sizes[i]), len(bins)
            bins.append(room)
        bins[b] = room - sizes[i]
        out[i] = b
    return out


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 50), max_size=300), st.integers(1, 60))
def test_tree_gives_best_fit_decreasing(sizes, capacity):
    assert shards.best_fit_decreasing(sizes, capacity) == plain_best_fit(sizes, capacity)


def test_many_bins_split_the_leaves():
    rng = random.Random(1)
    sizes = [rng.randint(40, 100) for _ in range(1500)]
    assert shards.best_fit_decreasing(sizes, 100) == plain_best_fit(sizes, 100)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=200), st.integers(1, 24))
def test_shards_stay_within_their_number(sizes, n):
    placed = shards.into_shards(sizes, n)
    assert len(placed) == len(sizes) and set(placed) <= set(range(n))


def test_shards_come_near_equal():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1000) for _ in range(4000)]
    totals = [0] * 24
    for size, shard in zip(sizes, shards.into_shards(sizes, 24)):
        totals[shard] += size
    assert max(totals) - min(totals) <= 0.005 * sum(totals) / 24


def test_a_giant_does_not_unbalance_the_rest():
    placed = shards.into_shards([10_000, *[10] * 90], 4)
    assert placed[0] == 0 and sorted(placed[1:].count(s) for s in (1, 2, 3)) == [30, 30, 30]


def rows(n=400):
    rng = random.Random(5)
    texts = [None, "", "same " * 40, *["w" * rng.randint(1, 400) for _ in range(60)]]
    return [(i if i else None, rng.choice(texts), "x", "y") for i in range(n)] + [(7, "same " * 40, "x", "y")] * 3


@pytest.mark.parametrize("parcels", [1, 8, 4096])
def test_groups_stay_whole_and_slots_are_gapless(spark, parcels):
    data = rows()
    got = shards.assign(spark.createDataFrame(data, SCHEMA), 5, parcels).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in data
    )
    by_text, slots = {}, {}
    for r in got:
        by_text.setdefault(r.text_crc32, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(5))


def test_empty_table(spark):
    assert shards.assign(spark.createDataFrame([], SCHEMA), 24).count() == 0
