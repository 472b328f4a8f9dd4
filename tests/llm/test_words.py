import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barloom.llm import entries, words
from barloom.llm.tokenizer import WordIds, content, slices

TEXTS = [None, "", " \n\t", "a", "a b  c\x0bd\fe", "naïve x ünïcode", "one two one two one two", "　x y", "z" * 5000]


def reference(text):
    return re.findall(words.WORD, text or "")


def test_words_and_hashes_follow_the_pattern(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 16)  # several slices, some of one long text
    seen, rows = {}, []
    for part in words.slices(pa.array(TEXTS)):
        hashes = part.hashes()
        rows += range(len(TEXTS))[part.rows]
        for i, row in enumerate(range(len(TEXTS))[part.rows]):
            mine = hashes[part.first[i] : part.first[i + 1]]
            expected = reference(TEXTS[row])
            assert len(mine) == len(expected)
            for word, value in zip(expected, mine.tolist()):
                assert seen.setdefault(word, value) == value
    assert rows == list(range(len(TEXTS))) and len(set(seen.values())) == len(seen)


def test_sliced_arrays_keep_their_offsets():
    part = next(words.slices(pa.array(["drop me", "a b", "c"])[1:]))
    assert np.diff(part.first).tolist() == [2, 1]


def test_windows_are_equal_only_for_equal_words():
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(400))
    part = next(words.slices(pa.array([text])))
    starts = words.full_starts(part.first, 5)
    found = words.windows(part.hashes(), starts, 5)
    expected = [tuple(text.split()[i : i + 5]) for i in starts]
    assert len(set(found.tolist())) == len(set(expected))
    assert len(set(zip(found.tolist(), expected))) == len(set(expected))


def test_full_starts_stay_within_documents():
    assert words.full_starts(np.array([0, 2, 2, 7]), 3).tolist() == [2, 3, 4]


@pytest.mark.parametrize("remember", [3, 1000])
def test_word_ids_equal_whole_text_ids(remember):
    path = entries.tokenizer()
    whole, coder = Tokenizer.from_file(path), WordIds(content(path), remember)
    texts = ["It's <|endoftext|> THE.,.. \t\x0b 　Élan ΣΑΣ İ é a'LL 12,3 ﬁ", "don't, I'm!!! 'S", "a.b. c?!x", "x" * 300]
    for text in [*texts, *[t for t in TEXTS if t]]:
        ids = np.frombuffer(coder.encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("remember", [3, 1000])
def test_batches_of_texts_have_the_ids_of_each(remember):
    path = entries.tokenizer()
    whole, coder = Tokenizer.from_file(path), WordIds(content(path), remember)
    texts = ["\u00c9t\u00e9, DEMENT***", None, "", "the the\nthe \u00d7\u00f7 a\u00d7b \u00df'S", "T\u0308 J\u030c e\u0301", "abc<|endoftext|>def<|", "word&&& word"]
    for most in (1, 20, 10_000):
        got = []
        for low, high in slices(pa.array(texts), most):
            ids, starts = coder.encode_all(pa.array(texts).slice(low, high - low))
            got += [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
        assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_accented_and_marked_words_go_straight_to_the_merges(monkeypatch):
    path = entries.tokenizer()
    whole, coder, seen = Tokenizer.from_file(path), WordIds(content(path)), []
    encode = coder._whole
    monkeypatch.setattr(coder, "_whole", lambda text: seen.append(text) or encode(text))
    words_ = ["\u00c0\u00d6\u00de\u00ff", "ci\u00f3n***", "plain", "\u00e9t\u00e9,", "a1"]
    for word in words_:
        assert np.frombuffer(coder.encode(word), "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids
    assert seen == ["***", ",", "a1"]
