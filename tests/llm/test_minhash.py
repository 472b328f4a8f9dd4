import collections
import itertools
import random

import numpy as np
import pytest

from barloom.llm import minhash

SCHEMA = "doc_id long, text string, class_id string, bands int"


def weighted(text, size=5):
    words = (text or "").encode().split()
    return collections.Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else None


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(rows, limit=0.8):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None and weighted(text):
            sets.setdefault(text, []).append(doc_id)
    parent = {t: t for t in sets}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    shingles = {t: weighted(t) for t in sets}
    for a, b in itertools.combinations(sets, 2):
        if similarity(shingles[a], shingles[b]) >= limit:
            parent[find(a)] = find(b)
    least = {}
    for t, ids in sets.items():
        least[find(t)] = min(least.get(find(t), min(ids)), *ids)
    return sorted((d is None, d or 0, least[find(t)] if d is not None and t in parent else d) for d, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    rows, ids = [], itertools.count(1)
    for _ in range(12):
        base = make(rng.randint(6, 160))
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 99))
            rows.append((next(ids), " ".join(copy)))
    chain = make(120)  # neighbours are alike, the ends are not
    for step in range(8):
        rows.append((next(ids), " ".join(chain[step * 4 : step * 4 + 90])))
    rows += [(next(ids), t) for t in (None, "", " ", None, "one", "one", "a b c", "a b c d", "x " * 80, "x " * 84, "y")]
    rows += [rows[0], (None, "a lone text of some words"), (None, None), (rows[1][0], "another text under an id seen before")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = minhash.classes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got) == [
        (none, d, c) for none, d, c in brute(rows)
    ]


def test_keep_leaves_one_row_of_each_class(spark):
    rows = corpus(3)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = minhash.keep(frame)
    assert got.columns == frame.columns
    kept = [r.doc_id for r in got.collect()]
    expected = {c for none, _, c in brute(rows) if not none}
    assert set(k for k in kept if k is not None) == expected and kept.count(None) == 2


def test_keep_passes_columns_of_any_name(spark):
    rows = corpus(4)
    names = ["kept_id", "kept_key", "kept_row_key", "content_key", "row", "class_id", "copies", "a b", "key"]
    extra = [f"{n}-{i}" for i, n in enumerate(names)]
    frame = spark.createDataFrame([(*r, *extra) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = minhash.keep(frame)
    assert got.columns == frame.columns
    kept = got.collect()
    assert {tuple(r)[2:] for r in kept} == {tuple(extra)}
    assert {r.doc_id for r in kept} - {None} == {c for none, _, c in brute(rows) if not none}


def test_many_copies_of_one_text_are_classed_without_meeting(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text) for i in range(1, 400)] + [(1000 + i, f"other text number {i} stands here alone today") for i in range(30)] + [(None, text)]
    got = minhash.classes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got) == [(n, d, c) for n, d, c in brute(rows)]


def test_agreement_estimates_weighted_similarity():
    rng = random.Random(7)
    for _ in range(6):
        a = collections.Counter(rng.choices(range(60), k=rng.randint(5, 300)))
        b = collections.Counter({k: v for k, v in a.items() if rng.random() < 0.8}) + collections.Counter(rng.choices(range(90), k=20))
        key = {k: np.uint64(rng.getrandbits(63)) for k in range(90)}
        sides = [minhash.signature(minhash.unit_columns(np.array([key[k] for k in c.elements()], np.uint64)), 4096) for c in (a, b)]
        assert abs((sides[0] == sides[1]).mean() - similarity(a, b)) < 0.04


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert minhash.classes(empty).count() == 0 and minhash.keep(empty).count() == 0
