import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import entries, packing, token_files, tokenizer

SCHEMA = "doc_id long, text string, part string"


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=60), st.data())
def test_packing_round_trip_and_random_access(bits, values, data):
    ids = np.array([v & ((1 << bits) - 1) for v in values], np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    start = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(start, len(ids)))
    assert token_files.unpack(packed, bits, start, stop).tolist() == ids[start:stop].tolist()


def test_bits_and_range():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        token_files.pack(np.array([8], np.uint32), 3)


ROWS = [(5, "b c", "x"), (1, None, "x"), (None, "first", None), (3, "", ""), (5, "a", "x"), (5, "a", "x"), (9, "long " * 3000, "y")]


def test_files_hold_every_document_in_order(spark, tmp_path):
    path = entries.tokenizer()
    whole = Tokenizer.from_file(path)
    token_files.write(spark.createDataFrame(ROWS, SCHEMA).repartition(4), f"{tmp_path}/t", path, block_ids=2)
    got = token_files.documents(token_files.read(spark, f"{tmp_path}/t")).orderBy("start").collect()
    expected = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert [r.doc_id for r in got] == [r[0] for r in expected]
    for row, (_, text, _) in zip(got, expected):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


def test_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], SCHEMA), f"{tmp_path}/t", entries.tokenizer())
    assert token_files.digests(token_files.read(spark, f"{tmp_path}/t")).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Documents 0, 2, 4, ... in many small blocks, and the ids of the whole table."""
    path = f"{tmp_path_factory.mktemp('tokens')}/t"
    rows = [(2 * i, f"document {i} " + "some words " * (i % 7), "x") for i in range(300)] + [(40, "again", "x"), (None, "no id", "x")]
    token_files.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, entries.tokenizer(), block_ids=50)
    whole = token_files.documents(token_files.read(spark, path)).orderBy("start").collect()
    return path, whole


def test_lookup_of_documents(spark, stored):
    path, whole = stored
    for wanted in ([0], [598], [40], [2, 300, 302, 444], [1, 10**9], []):
        got = token_files.lookup(spark, path, wanted).collect()
        want = [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in whole if r.doc_id in wanted]
        assert sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in got) == sorted(want)


def test_lookup_of_one_document_reads_the_blocks_around_it(spark, stored):
    path, _ = stored
    found = token_files.lookup(spark, path, [300])
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(low_doc,300)" in plan and "GreaterThanOrEqual(high_doc,300)" in plan
    blocks = spark.read.schema(token_files.BLOCK_SCHEMA).parquet(path)
    assert blocks.count() > 30 and blocks.where("low_doc <= 300 and high_doc >= 300").count() <= 2


def test_spans_of_positions(spark, stored):
    path, whole = stored
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in whole])
    for start, stop in ((0, 1), (0, len(ids)), (49, 53), (777, 1555), (len(ids) - 1, len(ids) + 9), (5, 5), (len(ids), len(ids) + 4)):
        rows = sorted(token_files.span(spark, path, start, stop).collect())
        got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]) if rows else np.empty(0)
        assert got.tolist() == ids[start:stop].tolist()
        assert [r.start for r in rows[1:]] == [r.start + len(r.ids) // 4 for r in rows[:-1]]


def test_a_tokenizer_with_other_rules_encodes_whole_texts(spark, tmp_path):
    path = entries.tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    whole = Tokenizer.from_file(path)
    texts = ["Two  spaces\nand Case", " leading", "", None, "x" * 5000, "\u00e9\u0301 \u4f60"]
    token_files.write(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA), f"{tmp_path}/t", path)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.documents(token_files.read(spark, f"{tmp_path}/t")).collect()}
    assert got == {i: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert tokenizer.by_words(Tokenizer.from_file(entries.tokenizer())) and not tokenizer.by_words(whole)


def fits(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return by


@pytest.mark.parametrize("open_bins", [1, 3, 100])
def test_packing_places_every_piece(spark, open_bins):
    path = entries.tokenizer()
    whole = Tokenizer.from_file(path)
    rows = [(1000 + i, "word " * (i * 7 % 23), "x") for i in range(60)] + ROWS
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), path, capacity=16, open_bins=open_bins).collect()
    fits(got, 16)
    pieces = {}
    for r in got:
        assert r.length == len(r.ids) // 4
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for doc_id, text, _ in rows[:60]:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        assert sorted(pieces[doc_id]) == [(k, a, ids[a : a + 16]) for k, a in enumerate(range(0, len(ids), 16))]
    total = sum(r.length for r in got)
    assert total == sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # exactly full, so it leaves the open ones
    assert bins.place(8) == (2, 0)
    assert bins.place(9) == (3, 0)  # closes bin 2, the fullest
    assert bins.place(4) == (0, 6) and bins.place(1) == (3, 9)
    assert bins.count == 0


@given(st.integers(1, 40), st.integers(1, 6), st.lists(st.integers(1, 40), max_size=80))
def test_bins_equal_a_plain_list(capacity, most, lengths):
    """The tightest open bin, of equal ones the one longest at that space; beyond ``most`` the fullest closes."""
    bins, opened, free = packing.OpenBins(capacity, most), 0, []
    for length in (min(n, capacity) for n in lengths):
        fitting = [f for f in free if f[1] >= length]
        if fitting:
            number, space = chosen = min(fitting, key=lambda f: f[1])
            free.remove(chosen)
        else:
            if len(free) >= most:
                free.remove(min(free, key=lambda f: f[1]))
            number, space = opened, capacity
            opened += 1
        if space > length:
            free.append((number, space - length))
        assert bins.place(length) == (number, capacity - space)


def test_packing_of_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), entries.tokenizer()).count() == 0


def test_digests_of_pieces(spark):
    row = packing.digests(packing.pack(spark.createDataFrame([(1, "", "x")], SCHEMA), entries.tokenizer())).first()
    assert (row.length, row.ids_crc32) == (1, zlib.crc32(b"\0\0\0\0"))
