"""Bands fitted to a corpus: what they reject at every length, and what does not move them."""

import random
import string

import pytest

from barloom.llm import entries, quality

SCHEMA = "doc_id long, text string, reason string, step int"
LENGTHS = (560, 1580, 5300, 21_500)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def prose(rng, size):
    """Words of a limited stock, so that ratios of one length lie close together."""
    stock = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 7))) for _ in range(600)]
    out = []
    while sum(map(len, out)) + len(out) < size:
        out.append(rng.choice(stock))
    return " ".join(out)


def corpus(seed=3):
    rng = random.Random(seed)
    return [(i * 10 + k, prose(rng, int(n * rng.uniform(0.95, 1.05)))) for i in range(70) for k, n in enumerate(LENGTHS)]


def odd(rng, size):
    """A text with a tail on every word, one of random characters, both of so many different words that no base rule fails."""
    tailed = " ".join(w + "#$%&&%$#" for w in prose(rng, size // 2).split())
    noise = "".join(rng.choices(string.printable[:94], k=size))
    return tailed, " ".join(noise[i : i + 9] for i in range(0, len(noise), 9))


@pytest.fixture(scope="module")
def fitted(spark):
    return quality.fit(frame(spark, corpus()))


def test_repetitive_and_random_texts_of_every_length_are_rejected(spark, fitted):
    rng = random.Random(4)
    rows = [(i * 2 + k, text) for i, n in enumerate(LENGTHS) for k, text in enumerate(odd(rng, n))]
    rows += [(100 + i, prose(rng, n)) for i, n in enumerate(LENGTHS)]
    got = {r.doc_id: r for r in quality.judge(frame(spark, rows), fitted).collect()}
    # The longest one is longer than any text of the corpus, so its chunks give it away.
    assert [got[i * 2].reason for i in range(4)] == ["repetitive"] * 3 + ["repetitive_chunks"]
    assert [got[i * 2 + 1].reason for i in range(4)] == ["incompressible"] * 4
    assert all(got[100 + i].kept for i in range(4))
    assert all(r.kept for r in quality.judge(frame(spark, [(i * 2, r[1]) for i, r in enumerate(rows[:8])])).collect() if not r.base_failed and r.doc_id % 4 == 0)


def test_most_of_the_corpus_itself_stays(spark, fitted):
    got = quality.judge(frame(spark, corpus()), fitted)
    assert got.where("kept").count() >= 0.97 * got.count()


def test_copies_partitions_and_failed_texts_do_not_move_the_bands(spark, fitted):
    rows = corpus()
    copied = rows + [(9, rows[0][1])] * 900 + [(1, "short"), (2, None), (3, "same words here " * 400)]
    assert quality.fit(frame(spark, copied).repartition(7)) == fitted


def test_lengths_without_texts_borrow_only_safe_limits(fitted):
    rules = quality.Rules()
    longest, general = quality.band(fitted, 400_000), quality.band(rules, 400_000)
    assert longest[0] == general[0] and longest[1] <= general[1]
    assert quality.band(fitted, 140)[0] == quality.band(rules, 140)[0] or quality.band(fitted, 140)[0] <= quality.band(fitted, 600)[0] + 0.2
    assert all(low < high for _, low, high in fitted.bands)


def test_a_small_or_empty_corpus_keeps_the_general_bands(spark):
    assert quality.fit(frame(spark, [])) == quality.Rules()
    assert quality.fit(frame(spark, corpus()[:8])) == quality.Rules()


def test_low_quality_labels_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    got = entries.op2_compression_bands(spark, folder).where("not base_failed")
    labelled = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in labelled}
    assert n[0, False] / (n[0, False] + n[0, True]) > 0.5
    assert n[1, False] / (n[1, False] + n[1, True]) < 0.01
