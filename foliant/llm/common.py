"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A maximal run of Unicode letters and digits.
WORD = re.compile(r"[^\W_]+")
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


_ASCII = {i: " " for i in range(128) if not chr(i).isalnum()}


def words_of(text: str | None) -> list[str]:
    """The words of a text, each lower-cased; plain ASCII texts need no regular expression.

    Lower-casing the whole text gives the same words but for the letters whose lower case holds a mark or depends on its neighbours.
    """
    if not text:
        return []
    if text.isascii():
        return text.lower().translate(_ASCII).split()
    if "\u0130" in text or "\u03a3" in text:
        return [w.lower() for w in WORD.findall(text)]
    return WORD.findall(text.lower())


def source_of(path: str | Column) -> Column:
    """The second label of a ``corpus.source.document`` path; a path without one is its own source."""
    c = F.col(path) if isinstance(path, str) else path
    return F.coalesce(F.get(F.split(c, r"\."), F.lit(1)), c)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; arrays of unsigned numbers wrap around silently."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def once(df: DataFrame, *keys: str) -> DataFrame:
    """Rows sent twice count once: one row per key."""
    return df.dropDuplicates(list(keys))


class WordHash(dict):
    """64-bit hashes of words, remembered by number; forgets everything when it holds too many words."""

    LIMIT = 400_000

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros(1024, np.uint64)

    def __missing__(self, w: str) -> int:
        import xxhash

        n = self[w] = len(self)
        if n >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros(len(self.table), np.uint64)])
        self.table[n] = xxhash.xxh64_intdigest(w)
        return n

    def hashes(self, words: list[str]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[at]  # the table may have grown
