import random
import zlib

import pytest
from pyspark.sql import functions as F

from barloom.llm import toxicity

DOCS, LABELS = "doc_id long, text string, score string, toxic string", "doc_id long, toxic int, text string"
BAD = ["blorgish", "snarkvile", "ugmuck", "grimlout"]


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("aeiourstlnmd", k=rng.randint(2, 8))) for _ in range(700)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 200))
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS),
        spark.createDataFrame([(*x, "z") for x in labels], LABELS),
    )


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    frame, marks = frames(spark, docs, labels)
    return docs, labels, frame, toxicity.fit(frame, marks)


def test_held_out_accuracy(fitted):
    docs, labels, frame, model = fitted
    truth = dict(labels)
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50 and all(0 <= s <= 1 for s in got.values())
    assert sum((got[i] >= 0.5) == truth[i] for i in held) / len(held) >= 0.97


def test_held_out_labels_are_not_learned(spark, fitted):
    docs, labels, frame, model = fitted
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    assert toxicity.fit(*frames(spark, docs, flipped)) == model
    expected = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r[0] for r in frame.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()} == expected


def test_edge_texts(spark, fitted):
    model = fitted[3]
    rows = [(1, None), (2, ""), (3, " \n"), (None, "blorgish snarkvile " * 9), (4, "snarkvile " * 20_000), (4, "snarkvile " * 20_000)]
    frame, _ = frames(spark, rows, [])
    got = toxicity.score(frame, model).collect()
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    assert got[0].score == got[1].score == got[2].score < 0.5 <= got[3].score and got[4].score == got[5].score
    kept = toxicity.keep(frame, model)
    assert kept.schema == frame.schema and [r.doc_id for r in kept.collect()] == [1, 2, 3]


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(i, 0) for i in range(50)], None), ([(1, None)], 0.0)])
def test_without_both_classes(spark, labels, score):
    frame, marks = frames(spark, [(i, f"text {i}") for i in range(60)], labels)
    scores = {r.score for r in toxicity.score(frame, toxicity.fit(frame, marks)).collect()}
    assert len(scores) == 1 and (scores == {score} if score is not None else 0 < scores.pop() < 0.1)


def test_empty_table(spark, fitted):
    frame, marks = frames(spark, [], [])
    assert toxicity.score(frame, fitted[3]).count() == 0
    assert toxicity.score(frame, toxicity.fit(frame, marks)).count() == 0


def test_a_string_that_does_not_fit_is_passed_over():
    assert toxicity._content(["x" * 50, "rare", "y" * 30, "word"], 20) == b" word rare"


def test_many_toxic_words_are_learned(spark):
    rng = random.Random(3)
    bad = ["zq" + "".join(rng.choices("bcfghjkvw", k=7)) for _ in range(700)]
    docs, labels = corpus(400, seed=5)
    for i, (d, text) in enumerate(docs):
        if labels[i][1]:
            docs[i] = (d, " ".join([text, "w" * 5000, *rng.sample(bad, 60)]))
    model = toxicity.fit(*frames(spark, docs, labels))
    learned = set(model.toxic.decode().split())
    counts = {w: 0 for w in bad}
    for (d, text), (_, t) in zip(docs, labels):
        if t and zlib.crc32(str(d).encode()) % 5:
            for w in set(text.split()) & counts.keys():
                counts[w] += 1
    frequent = {w for w, n in counts.items() if n >= 4}
    assert len(frequent) > 500 and frequent <= learned and "w" * 5000 in learned
