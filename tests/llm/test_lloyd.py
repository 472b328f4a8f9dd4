import hashlib
import math
import random
import struct

import pytest

from barloom.llm import lloyd
from barloom.llm.lloyd import Settings

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, chunk int, v int"


def plain(rows, clusters=16, rounds=3, dimensions=64, scale=64, seed="1"):
    """Ids and integer vectors of kept rows, their clusters and distances, the centroids."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(scale * struct.unpack("f", struct.pack("f", x))[0]) for x in vector]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [list(v) for _, v in sorted(kept, key=key)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, vs in groups.items():
            centres[i] = [sum(column) // len(vs) for column in zip(*vs)]
    return [(vec_id, *reversed(nearest(v))) for vec_id, v in kept], centres


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def found(spark, rows, **options):
    placed, centres = lloyd.cluster(frame(spark, rows), Settings(**options))
    return sorted(((r.vec_id, r.cluster, r.distance) for r in placed.collect()), key=str), centres


def check(spark, rows, **options):
    blocks = options.pop("blocks", 3)
    got, want = found(spark, rows, blocks=blocks, **options), plain(rows, **options)
    assert got == (sorted(want[0], key=str), want[1])


def vectors(n, dimensions, seed=0, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(rng.choice((-1, 0, 1)), spread) for _ in range(dimensions)]) for i in range(n)]


@pytest.mark.parametrize("blocks", [1, 3, 5])
def test_blocks_of_any_width_add_up_exactly(spark, blocks):
    check(spark, vectors(300, 5), blocks=blocks, clusters=7, rounds=4, dimensions=5)


def test_more_rows_than_a_chunk_and_wide_values(spark):
    check(spark, vectors(5000, 3, seed=2, spread=1e5), clusters=4, rounds=2, dimensions=3, scale=8)


def test_left_out_vectors_ties_repeats_and_null_ids(spark):
    rows = vectors(40, 4, seed=1)
    rows += [(50, None), (51, [1.0] * 3), (52, [1.0] * 5), (53, [1.0, None, 1.0, 1.0]), (54, [float("nan"), 0.0, 0.0, 0.0]), (55, [float("inf"), 0.0, 0.0, 0.0]), (56, [])]
    rows += [(7, [0.0] * 4), (7, [0.5] * 4), (None, [2.0] * 4), (None, [2.0] * 4)] + [(9, [3.0] * 4)] * 30
    check(spark, rows, clusters=6, rounds=3, dimensions=4)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, [(1, [1.0, 2.0]), (None, [5.0, 1.0]), (3, [1.0, 2.0])], clusters=16, dimensions=2, blocks=2)
    assert found(spark, []) == ([], [])
    assert found(spark, [(1, [1.0])]) == ([], [])


def test_an_empty_centroid_stays(spark):
    rows = [(i, [float(i // 10 * 10)]) for i in range(30)]
    got, centres = found(spark, rows, clusters=8, rounds=1, dimensions=1, blocks=1)
    assert (got, centres) == (sorted(plain(rows, 8, 1, 1)[0], key=str), plain(rows, 8, 1, 1)[1])
    assert len({c for _, c, _ in got}) < 8


def test_inertia_and_hashes(spark):
    rows = vectors(60, 4, seed=3)
    placed, centres = lloyd.cluster(frame(spark, rows), Settings(clusters=3, dimensions=4, blocks=2))
    table = lloyd.with_inertia(placed, centres).collect()
    assert len(table) == 60
    for r in table:
        assert r.cluster_inertia == sum(o.distance for o in table if o.cluster == r.cluster)
        assert r.inertia == sum(o.distance for o in table)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_components_too_large_for_exact_distances_raise(spark):
    with pytest.raises(Exception, match="exceeds"):
        found(spark, [(1, [1e30, 0.0])], dimensions=2, blocks=1)
