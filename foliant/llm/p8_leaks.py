"""Evaluation texts leaking into training text.

The test items become a hash set of their word n-grams: sorted arrays of hashes, items and places, broadcast in blocks of at most
``BLOCK_NGRAMS`` n-grams (24 bytes each), one pass over the corpus for each block; the driver holds one block at a time. Every
document is scanned with rolling windows of words: words that no item has end a window at once, remaining windows are looked up by a
64-bit hash, and each hit is verified word by word (by the words' own hashes). Matches are by words, so case, punctuation and line breaks
between them do not matter; spans are places of the words in the text as it is. One map, no shuffle.

Defined cases: null, empty and short texts leak nothing, nor do items of fewer words than the window; items that share a
passage are all reported; rows sent twice are reported once; rows with a null id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import WORD, WordHash, mix, words_of

WINDOW = 12
#: Most words of items broadcast at once (24 bytes each at most, with their n-gram); more items are taken in several passes.
BLOCK_NGRAMS = 1_000_000
FIXED = "doc_id bigint, item_id bigint, first_word int, last_word int, start_char int, end_char int"
_P = np.uint64(0x100000001B3)


class Grams:
    """n-grams of a block of items as arrays: sorted hashes, with the item and the place in the block's words of each."""

    def __init__(self, items: list[tuple[int, list[str]]], n: int):
        known = WordHash()
        parts = [(i, known.hashes(ws)) for i, ws in items if len(ws) >= n]
        self.n, self.item = n, np.array([i for i, _ in parts], np.int64)
        self.words = np.concatenate([w for _, w in parts]) if parts else np.zeros(0, np.uint64)
        starts = np.cumsum([0, *(len(w) for _, w in parts)])
        places = [np.arange(a, z - n + 1) for a, z in zip(starts, starts[1:])]
        hashes = np.concatenate([self.roll(w) for _, w in parts]) if parts else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.place = hashes[order], (np.concatenate(places) if parts else np.zeros(0, np.int64))[order].astype(np.int32)
        self.owner = np.repeat(np.arange(len(parts)), [len(x) for x in places] if parts else []).astype(np.int32)[order]
        self.vocabulary = np.unique(self.words)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "memory"}

    def roll(self, w: np.ndarray) -> np.ndarray:
        m = len(w) - self.n + 1
        out = np.zeros(max(m, 0), np.uint64)
        if m > 0:
            for k in range(self.n):
                out = out * _P + w[k : k + m]
        return mix(out)

    def hits(self, words: list[str]) -> dict[int, set[int]]:
        """Item to the positions of its n-grams in the words."""
        n = self.n
        if len(words) < n or not len(self.hashes):
            return {}
        if not hasattr(self, "memory"):
            self.memory = _Known(self.vocabulary)
        w, own = self.memory.look(words)
        known = np.concatenate(([0], np.cumsum(own)))
        full = np.flatnonzero(known[n:] - known[:-n] == n)
        if not len(full):
            return {}
        h = self.roll(w)[full]
        low, high = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, side="right")
        out: dict[int, set[int]] = {}
        for pos, a, z in zip(full[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
            for k in range(a, z):
                at = self.place[k]
                if (self.words[at : at + n] == w[pos : pos + n]).all():
                    out.setdefault(int(self.item[self.owner[k]]), set()).add(pos)
        return out


class _Known(WordHash):
    """Hashes of words, and whether each is a word of the items, remembered by number."""

    def __init__(self, vocabulary: np.ndarray):
        super().__init__()
        self.vocabulary, self.flags = vocabulary, np.zeros(1024, bool)

    def __missing__(self, w: str) -> int:
        n = super().__missing__(w)
        if n >= len(self.flags):
            self.flags = np.concatenate([self.flags, np.zeros(len(self.flags), bool)])
        at = int(np.searchsorted(self.vocabulary, self.table[n]))
        self.flags[n] = at < len(self.vocabulary) and self.vocabulary[at] == self.table[n]
        return n

    def look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.LIMIT:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[at], self.flags[at]


def spans(at: set[int], n: int) -> list[tuple[int, int]]:
    """Runs of words covered by n-grams at the given positions."""
    out: list[list[int]] = []
    for p in sorted(at):
        if out and p <= out[-1][1]:
            out[-1][1] = p + n
        else:
            out.append([p, p + n])
    return [(a, b) for a, b in out]


def blocks(items: DataFrame, n: int = WINDOW, limit: int = BLOCK_NGRAMS) -> Iterator[list[tuple[int, list[str]]]]:
    """The items in blocks of a bounded number of n-grams, streamed to the driver one block at a time (an item longer than that is a block)."""
    block, size = [], 0
    for r in items.where("item_id is not null and text is not null").select("item_id", "text").distinct().orderBy("item_id").toLocalIterator():
        ws = words_of(r.text)
        if size and size + len(ws) > limit:
            yield block
            block, size = [], 0
        block.append((r.item_id, ws))
        size += len(ws)
    yield block


def _scan(shared, n: int):
    def run(batches):
        grams: Grams = shared.value
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if doc is None or not text:
                    continue
                found = grams.hits(words_of(text))
                if found:
                    places = [m.span() for m in WORD.finditer(text)]
                    rows += [(doc, item, a, z - 1, places[a][0], places[z - 1][1]) for item, at in found.items() for a, z in spans(at, n)]
            names = [f.split()[0] for f in FIXED.split(", ")]
            types = [pa.int64(), pa.int64()] + [pa.int32()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=names)

    return run


def leak_spans(spark: SparkSession, documents: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Every verified span: :data:`FIXED`; words count from 0, characters as in Python slices."""
    out = None
    for block in blocks(items, n):
        shared = spark.sparkContext.broadcast(Grams(block, n))
        part = documents.select("doc_id", "text").mapInArrow(_scan(shared, n), FIXED).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def leaks(spark: SparkSession, documents: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``doc_id, item_id`` of each document that holds ``n`` or more consecutive words of the item."""
    return leak_spans(spark, documents, items, n).select("doc_id", "item_id").distinct()


def clean(spark: SparkSession, documents: DataFrame, items: DataFrame, n: int = WINDOW, drop_share: float = 0.5) -> DataFrame:
    """The corpus without leaks: spans are cut out; a document whose spans hold ``drop_share`` of it is dropped.

    ``doc_id, text, n_removed`` (characters removed); texts without leaks, null ones too, stay as they are.
    """
    found = leak_spans(spark, documents, items, n).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start_char", "end_char"))).alias("spans"))
    merged = F.aggregate(
        "spans",
        F.expr("cast(array() as array<struct<start_char:int,end_char:int>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end_char"] >= s["start_char"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start_char"].alias("start_char"), F.greatest(F.element_at(acc, -1)["end_char"], s["end_char"]).alias("end_char")))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    cut = F.aggregate(
        "merged",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["text"], F.substring("text", acc["at"] + 1, s["start_char"] - acc["at"])).alias("text"), s["end_char"].alias("at")),
        lambda acc: F.concat(acc["text"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    gone = F.aggregate("merged", F.lit(0), lambda acc, s: acc + s["end_char"] - s["start_char"])
    return (
        documents.select("doc_id", "text")
        .join(found, "doc_id", "left")
        .withColumn("merged", merged)
        .withColumn("n_removed", F.coalesce(gone, F.lit(0)))
        .where((F.col("n_removed") == 0) | (F.col("n_removed") < drop_share * F.length("text")))
        .select("doc_id", F.when(F.col("n_removed") > 0, cut).otherwise(F.col("text")).alias("text"), "n_removed")
    )
