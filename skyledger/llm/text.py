"""Words and shingles of whole texts, for use inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

#: Fixed word class: what is neither ASCII punctuation, space nor control, after lower-casing A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same classes for Spark's regular expressions.
SPACE_SQL = r"[\x20\x09-\x0D]+"
NON_SPACE_SQL = r"[^\x20\x09-\x0D]+"

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


def lower_bytes(text) -> bytes:
    """UTF-8 bytes with A-Z lower-cased (``bytes.lower`` touches ASCII only); null is empty."""
    return text.encode("utf-8", "replace").lower() if isinstance(text, str) else b""


def space_words(text) -> list[bytes]:
    """Words between runs of space and \\t..\\r; ``bytes.split`` separates on exactly these."""
    return lower_bytes(text).split()


def label_words(text) -> list[bytes]:
    """Words of :data:`WORD`."""
    return WORD.findall(lower_bytes(text))


class WordHash(dict):
    """Word -> 64-bit hash, remembered; emptied when it holds ``limit`` words, so memory stays bounded."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit combination."""
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def shingle_set(text, words: WordHash, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, no words none."""
    tokens = space_words(text)
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=n)], np.uint64)
    a = words.array(tokens)
    m = n - width + 1
    h = a[:m] * _MIX[0]
    for i in range(1, width):
        h += a[i:i + m] * _MIX[i % len(_MIX)]
    return np.unique(finish(h))


def row_key(doc_id, text):
    """Id and text hash as one column, which tells rows apart that share an id; null where the id is."""
    return F.concat(F.col(doc_id).cast("long").cast("string"), F.lit(":"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def fresh(df, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base
