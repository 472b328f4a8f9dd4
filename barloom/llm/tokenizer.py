"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library, word by word.

This holds for a vocabulary that lower-cases, drops white space before merging and splits letters from punctuation: the
ids of a text are then those of its pieces between spaces and line feeds, one after the other, and those of a word
with trailing marks are the word's and the marks'. Words of Latin letters, accented ones included, go straight to the
merges; all other pieces take the whole encoder. Words repeat, so each worker remembers ids; a full memory is
emptied, which costs time and changes nothing. The file's own rules say whether this holds; texts of any other
tokenizer are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

REMEMBER = 600_000
BATCH_BYTES = 8 << 20
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # not the apostrophe, which can begin a piece with the letters behind it
ACCENTED = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"  # U+00C0 to U+00FF without the two signs: composed, with plain lower case
LETTERS = re.compile(rb"(?:[a-z]|" + ACCENTED + rb")+")
COMBINING = "[\u0300-\u033f]"
PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PLAIN)}

# The rules of a tokenizer whose ids can be put together from those of words.
LOWER_CASE = ["NFC", "Replace", "Lowercase"]
WHITE_SPACE = {"Regex": r"\s+"}
PIECES = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def by_words(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer lower-cases, drops white space, splits letters from the rest and merges within pieces."""

    def rules(part) -> dict:
        return json.loads(part.__getstate__()) if part else {}

    normal, split = rules(tokenizer.normalizer), rules(tokenizer.pre_tokenizer)
    steps = normal.get("normalizers", [])
    first, second = [*split.get("pretokenizers", []), {}, {}][:2]
    return (
        [s["type"] for s in steps] == LOWER_CASE
        and (steps[1]["pattern"], steps[1]["content"]) == (WHITE_SPACE, " ")
        and len(split.get("pretokenizers", [])) == 2
        and (first.get("pattern"), first.get("behavior"), first.get("invert")) == (PIECES, "Removed", True)
        and (second.get("type"), second.get("add_prefix_space"), second.get("use_regex")) == ("ByteLevel", False, False)
        and type(tokenizer.model).__name__ == "BPE"
        and not tokenizer.model.dropout
    )


class WordIds(dict):
    """Ids as little-endian unsigned 32-bit integers, remembered by lower-cased piece."""

    def __init__(self, content: str, remember: int = REMEMBER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__()
        self.tokenizer = Tokenizer.from_str(content)
        self.model = self.tokenizer.model
        self.by_words = by_words(self.tokenizer)
        self.remember = remember

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        if not self.by_words or b"\xcc" in raw:  # a mark to be composed with the letter before it, in its own case
            return self._whole(text or "")
        return b"".join(map(self.__getitem__, raw.lower().replace(b"\n", b" ").split(b" ")))

    def encode_all(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the offsets at which those of each begin and the last end.

        A piece that comes more than once among the texts is looked up once.
        """
        texts = pc.fill_null(texts, "")
        if not self.by_words or pc.any(pc.match_substring_regex(texts, COMBINING)).as_py():
            each = [self.encode(text) for text in texts.to_pylist()]
            return np.frombuffer(b"".join(each), "<u4"), _offsets(each)
        parts = pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        each = [self[part] for part in coded.dictionary.cast(pa.binary()).to_pylist()]
        ids, first = np.frombuffer(b"".join(each), "<u4"), _offsets(each)
        codes = coded.indices.to_numpy()
        lengths = np.diff(first)[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(ends[-1]) + np.repeat(first[codes] - ends[:-1], lengths)
        return ids[at], ends[parts.offsets.to_numpy()]

    def __missing__(self, part: bytes) -> bytes:
        word = part.rstrip(MARKS)
        if not (word.isalpha() or LETTERS.fullmatch(word)):
            ids = self._whole(part.decode())
        elif len(word) < len(part):
            marks = part[len(word) :]
            ids = self[word] + (self.get(marks) or self._marks(marks))
        elif word.isascii():
            ids = _little([token.id for token in self.model.tokenize(word.decode())])
        else:
            letters = word.decode().lower().encode().decode("latin-1").translate(BYTE_LEVEL)
            ids = _little([token.id for token in self.model.tokenize(letters)])
        return self._keep(part, ids)

    def _marks(self, marks: bytes) -> bytes:
        return self._keep(marks, self._whole(marks.decode()))

    def _keep(self, part: bytes, ids: bytes) -> bytes:
        if len(self) >= self.remember:
            self.clear()
        self[part] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _offsets(each: list[bytes]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) // 4)]).astype(np.int64)


def _little(ids) -> bytes:
    return array("I", ids).tobytes()


def content(path: str) -> str:
    """The tokenizer file, read on the driver: tasks get its content, so no executor needs the file."""
    return Path(path).read_text(encoding="utf-8")


def slices(texts: pa.StringArray, most_bytes: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Borders of runs of texts of about ``most_bytes``, a longer text alone: what is encoded at once."""
    total = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)])
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + most_bytes, "right")) - 1)
        yield start, stop
        start = stop


@cache
def word_ids(content: str) -> WordIds:
    """One encoder for each worker process."""
    return WordIds(content)


@cache
def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
