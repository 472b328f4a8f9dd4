import random

import pytest

from barloom.llm.substring import Settings, deduplicate

SCHEMA = "doc_id long, text string, kept string, starts int"


def brute(rows, window):
    """Words kept of each row, in the order of (doc_id, text), rows without doc_id last."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is None, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone |= set(range(p, p + window))
            seen.add(key)
        out[i] = (len(words), len(gone), b" ".join(w for p, w in enumerate(words) if p not in gone).decode())
    return sorted((rows[i][0] is None, rows[i][0] or 0, *out[i]) for i in order)


def run(spark, rows, settings):
    got = deduplicate(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), settings).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got)


def corpus(seed, n=60):
    rng = random.Random(seed)
    make = lambda k: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(k))
    shared = [make(rng.randint(5, 90)) for _ in range(5)]
    rows = [(i, " ".join([make(rng.randint(0, 30)), rng.choice(shared), make(rng.randint(0, 30)), rng.choice(shared)])) for i in range(n)]
    rows += [(100 + i, rows[3][1]) for i in range(15)]  # a group of copies
    rows += [(200, "a " * 150), (201, None), (202, ""), (203, " \n"), (5, rows[5][1]), (5, "another text of the same id")]
    rows += [(300, "tail " + shared[0]), (-4, shared[0]), (None, make(3)), (None, shared[1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [Settings(), Settings(chunk_bytes=300, bucket_bytes=200), Settings(window=16, least=2), Settings(window=7)])
def test_equals_brute_force(spark, settings):
    rows = corpus(settings.window)
    assert run(spark, rows, settings) == brute(rows, settings.window)


def test_levels_double_up_to_the_window():
    assert Settings().levels() == [10, 20] and Settings(window=7).levels() == [7]
    assert Settings(window=48, least=3).levels() == [3, 6, 12, 24, 48]


def test_no_candidate_and_empty_table(spark):
    assert run(spark, [(1, "a b c"), (2, None)], Settings()) == [(False, 1, 3, 0, "a b c"), (False, 2, 0, 0, "")]
    assert deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_without_doc_id_do_not_depend_on_the_partitions(spark):
    rng = random.Random(11)
    passage = " ".join(f"w{rng.randrange(99)}" for _ in range(60))
    rows = [(None, f"{i} {passage} end{i}") for i in range(6)] + [(2**63 - 1, f"last {passage}"), (3, None), (None, None), (None, "")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in (2, 3, 13):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(run(spark, rows, Settings()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    kept = [r for r in found[0] if r[2] > 60]
    assert [r[3] for r in kept if not r[0]] == [0] and all(r[3] == 60 for r in kept if r[0])


def test_texts_longer_than_a_slice(spark):
    rng = random.Random(12)
    passage = " ".join(f"p{rng.randrange(99)}" for _ in range(40))
    long = " ".join(str(rng.randrange(10**6)) for _ in range(200_000)) + " " + passage
    rows = [(1, long), (2, passage), (3, long)]
    assert run(spark, rows, Settings()) == brute(rows, 20)
