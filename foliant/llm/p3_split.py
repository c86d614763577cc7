"""Splitting oversized items at natural boundaries.

Each text becomes the sorted array of its word spans (prefix sums of words over characters) and the sorted array of
boundaries: the word counts after which a line or a sentence ends. A piece that starts at word ``s`` ends at the last
boundary in ``(s + overlap, s + limit]``, found by binary search; where there is none, it is cut hard at ``s + limit``. The
next piece steps back by the overlap. The kind of cut of an item is that of its splitting without overlap: a piece that starts at a
boundary is cut hard only if no boundary lies within the limit. One map over Arrow batches: no shuffle but for rows sent twice.

Defined cases: null, empty and blank texts and texts within the limit are not oversized and come out whole as one piece
(null and blank ones as none); rows sent twice count once; rows with a null id are left out; a text of one endless
word is one word. The share of oversized texts does not matter: every text is cut on its own.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 400
OVERLAP = 40
SPAN = re.compile(r"\S+")
PIECES = "table_name string, item_id bigint, chunk_number int, chunk_text string, word_count int, start_word int, ends string, cut string"


def boundaries(text: str) -> tuple[list[tuple[int, int]], list[int]]:
    """Word spans and the sorted word counts after which a line or sentence ends; the end of the text is one."""
    spans = [m.span() for m in SPAN.finditer(text)]
    n = len(spans)
    ends = [i + 1 for i in range(n - 1) if text[spans[i][1] - 1] in ".!?" or "\n" in text[spans[i][1] : spans[i + 1][0]]]
    return spans, [*ends, n]


def cuts(n: int, ends: list[int], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """``(start, end, how)`` of the pieces in words; how is ``natural``, ``hard`` or ``end``."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    out, start = [], 0
    while True:
        if n - start <= limit:
            return [*out, (start, n, "end")] if n > start else out
        at = bisect_right(ends, start + limit) - 1
        end, how = (ends[at], "natural") if at >= 0 and ends[at] > start + overlap else (start + limit, "hard")
        out.append((start, end, how))
        start = end - overlap


def kind_of(n: int, ends: list[int], limit: int = LIMIT) -> str:
    """``forced`` if the pieces can't all end naturally even without overlap: some stretch over the limit has no boundary."""
    return "forced" if any(how == "hard" for _, _, how in cuts(n, ends, limit, 0)) else "natural"


def _pieces(limit: int, overlap: int, only_kind: bool):
    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for name, i, text in zip(*(b.column(c).to_pylist() for c in ("table_name", "item_id", "text"))):
                spans, ends = boundaries(text)
                n = len(spans)
                if not n or only_kind and n <= limit:
                    continue
                kind = None if n <= limit else kind_of(n, ends, limit)
                if only_kind:
                    rows.append((name, i, 1, None, n, 0, "end", kind))
                    continue
                for k, (s, e, how) in enumerate(cuts(n, ends, limit, overlap), 1):
                    rows.append((name, i, k, text if n <= limit else text[spans[s][0] : spans[e - 1][1]], e - s, s, how, kind))
            names = [f.split()[0] for f in PIECES.split(", ")]
            types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            for at in range(0, len(rows), 4000) or [0]:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 4000]) if rows else [[]] * 8, types)], names=names)

    return run


def items(content: DataFrame, chunks: DataFrame) -> DataFrame:
    """Both tables as ``table_name, item_id, text``."""
    return content.select(F.lit("document_content").alias("table_name"), F.col("section_id").alias("item_id"), F.col("content_text").alias("text")).unionByName(
        chunks.select(F.lit("embedding_table").alias("table_name"), F.col("chunk_id").alias("item_id"), F.col("chunk_text").alias("text"))
    ).where("text is not null and item_id is not null")


def pieces(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Numbered pieces of every item (:data:`PIECES`)."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    one = rows.dropDuplicates(["table_name", "item_id"])
    return one.mapInArrow(_pieces(limit, overlap, False), PIECES)


def oversized(rows: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``table_name, item_id, cut`` of the items over the limit; a text needs two characters a word to be one."""
    cut = rows.where(F.length("text") > 2 * limit).mapInArrow(_pieces(limit, overlap, True), PIECES)
    return cut.select("table_name", "item_id", "cut").distinct()
