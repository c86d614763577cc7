"""Token-budgeted chunks with overlap."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import word_count, words

MAX_TOKENS, OVERLAP, SPECIAL = 500, 50, 2


def check(max_tokens: int, overlap: int) -> None:
    if max_tokens <= 0 or overlap < 0 or overlap >= max_tokens:
        raise ValueError("max_tokens must be positive, overlap at least 0 and below it")


def header_budget(max_tokens: int, overlap: int, header: str | Column, special: int = SPECIAL) -> Column:
    """What a header leaves of the budget; never less than one more than the overlap. Special tokens of the header count too."""
    left = F.lit(max_tokens) - (word_count(header) + special)
    return F.when(left <= overlap, F.lit(overlap + 1)).otherwise(left)


def additive(rows: DataFrame, text: str, max_tokens: int | Column = MAX_TOKENS, overlap: int = OVERLAP, special: int = SPECIAL) -> DataFrame:
    """``chunk_number, chunk_text, word_count`` added to the rows, for a counter of words plus ``special`` tokens.

    Closed form, no Python: a chunk holds ``cap`` words and the next starts ``stride`` words on. A text within the budget stays as it
    is, empty ones too; a split text is joined by single spaces. Null texts count as empty. The words are split
    once, and only slices of the array are kept.
    """
    if isinstance(max_tokens, int):
        check(max_tokens, overlap)
    budget = F.lit(max_tokens) if isinstance(max_tokens, int) else max_tokens
    cap = F.greatest(F.lit(1), budget - special)
    stride = cap - F.greatest(F.lit(0), F.least(F.lit(overlap - special), cap - 1))
    t = F.coalesce(F.col(text), F.lit(""))
    w = rows.withColumn("_w", words(t)).withColumn("_n", F.size("_w")).withColumn("_cap", cap.cast("int")).withColumn("_stride", stride.cast("int"))
    fits = F.col("_n") + special <= budget
    count = F.when(fits, 1).when(F.col("_n") == 0, 0).when(F.col("_n") <= F.col("_cap"), 1).otherwise(1 + F.ceil((F.col("_n") - F.col("_cap")) / F.col("_stride")).cast("int"))
    cut = w.withColumn("_fits", fits).withColumn("_count", count).where("_count > 0").withColumn("chunk_number", F.explode(F.sequence(F.lit(1), F.col("_count"))))
    own = F.slice("_w", (F.col("chunk_number") - 1) * F.col("_stride") + 1, F.col("_cap"))
    return cut.withColumn("chunk_text", F.when(F.col("_fits"), t).otherwise(F.array_join(own, " "))).withColumn("word_count", F.when(F.col("_fits"), F.col("_n")).otherwise(F.size(own))).drop("_w", "_n", "_cap", "_stride", "_fits", "_count")


def greedy(text: str, count: Callable[[str], int], max_tokens: int, overlap: int) -> list[tuple[str, int]]:
    """Chunks of one text under any token counter: ``(text, words)``.

    The end of a chunk is searched by doubling and bisection, as a counter grows with the words; a word over the budget goes
    alone. The next chunk steps back while the overlap allows, and always moves on.
    """
    check(max_tokens, overlap)
    ws = text.split()
    if count(text) <= max_tokens:
        return [(text, len(ws))]
    out, start, n = [], 0, len(ws)
    while start < n:
        low, step = start + 1, 1
        while low + step <= n and count(" ".join(ws[start : low + step])) <= max_tokens:
            low, step = low + step, step * 2
        high = min(low + step, n + 1)  # low fits or is one word; high doesn't fit
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if count(" ".join(ws[start:mid])) <= max_tokens else (low, mid)
        out.append((" ".join(ws[start:low]), low - start))
        if low >= n:
            break
        nxt = low
        while nxt > start + 1 and count(" ".join(ws[nxt - 1 : low])) <= overlap:
            nxt -= 1
        start = nxt
    return out


def words_counter() -> Callable[[str], int]:
    """A counter as a hook: words and the special tokens."""
    return lambda text: len(text.split()) + SPECIAL


def by_counter(rows: DataFrame, keys: list[str], text: str, make_counter: Callable[[], Callable[[str], int]], max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> DataFrame:
    """Like :func:`additive` for a tokenizer: ``make_counter`` runs once a worker task. An Arrow map, no shuffle."""
    check(max_tokens, overlap)
    kept = rows.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text") + ", chunk_number int, chunk_text string, word_count int"

    def run(batches):
        count = make_counter()
        for b in batches:
            at, number, texts, sizes = [], [], [], []
            for i, t in enumerate(b.column("_text").to_pylist()):
                for k, (chunk, n) in enumerate(greedy(t, count, max_tokens, overlap), 1):
                    at.append(i)
                    number.append(k)
                    texts.append(chunk)
                    sizes.append(n)
            own = b.select(keys).take(pa.array(at, pa.int64()))
            yield pa.record_batch([*own.columns, pa.array(number, pa.int32()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())], names=[*keys, "chunk_number", "chunk_text", "word_count"])

    return kept.mapInArrow(run, schema)


def with_prefix(rows: DataFrame, prefix: Column, text: str, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, special: int = SPECIAL) -> DataFrame:
    """Chunks of a column with a prefix and a line end in front of each; the budget is what the prefix leaves, the word count the body's."""
    check(max_tokens, overlap)
    cut = additive(rows.withColumn("_prefix", prefix), text, header_budget(max_tokens, overlap, F.col("_prefix"), special), overlap, special)
    return cut.withColumn("chunk_text", F.concat("_prefix", F.lit("\n"), "chunk_text")).drop("_prefix")


def with_header(rows: DataFrame, header: str, text: str, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, special: int = SPECIAL) -> DataFrame:
    """Chunks of ``text`` with ``header: value`` in front of each; the budget is what the header leaves, the word count the body's."""
    body = F.concat(F.lit(f"{text}: "), F.coalesce(F.col(text), F.lit("")))
    return with_prefix(rows.withColumn("_body", body), F.concat(F.lit(f"{header}: "), F.coalesce(F.col(header), F.lit(""))), "_body", max_tokens, overlap, special).drop("_body")
