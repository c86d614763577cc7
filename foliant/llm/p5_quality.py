"""Per-document text quality statistics and a verdict: prose, list, table or junk.

The statistics of lines and words are taken in one Arrow map (regular expressions of a line, counted per text; the same as
nested array expressions cost several times the CPU time). The verdict is an ordered rule list, induced by
incremental reduced-error pruning on labelled documents (``p5_seeds``: at most a thousand, made from a seed), whose
learned thresholds become one SQL CASE expression that Spark applies natively.

No shuffle but for rows sent twice; the common words are a fixed list of at most ``MAX_COMMON`` words.

Defined cases: null, empty and blank texts have zero words and zero shares and count as prose; texts of one or two sentences
or one short line are prose unless they are unreadable; rows sent twice count once; rows with a null section are left out.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.p5_seeds import seeds
from foliant.llm.rules import induce, to_sql

MAX_COMMON = 10_000
KINDS = ["table", "junk", "list"]
#: What the rules look at.
FEATURES = [
    "n_lines", "mean_line_words", "mean_word_length", "symbol_share", "punct_share", "common_share", "entry_share", "contents_share",
    "cell_share", "stop_share", "short_share", "single_share", "wordish_share", "foreign_share", "letter_share",
]
_ENTRY = re.compile(r"(?:[-•*–—▪◦·‣]|\(?(?:\d{1,3}|[A-Za-z]|[ivxlIVXL]{1,5})[.)])\s+\S")
_CONTENTS = re.compile(r"(?:\.{3,}|(?:\. ){3,}|\s{3,}|\t)\s*\d{1,4}$|^\d+(?:\.\d+)+\s+\D+\s\d{1,4}$")
_QUOTED = re.compile(r'"[^"]*"(?:[;,]"[^"]*")+')
_GAPS = re.compile(r"\S {3,}(?=\S)")
_STOP = re.compile(r"[^\W\d_]{2}[.?!][\"')\]]*(?!\S)")
_END = re.compile(r"[.?!][\"')\]]*$")
_TOKEN = re.compile(r"[^\W_]+")
_NOT_LETTERS = re.compile(r"[^A-Za-z]+")
_ALNUM_SPACE = re.compile(r"[^\W_]+|\s+")
_PLAIN = re.compile(r"[\x00-\x7f\s]+")
_RUN = re.compile(r"[bcdfghjklmnpqrstvwxz]{6}")
_VOWEL = re.compile(r"[aeiouyáéíóúü]")


def wordish(token: str) -> bool:
    """Whether a token looks like a word of a Latin-script language: one case, a vowel, no long run of consonants."""
    low = token.lower()
    return len(token) > 2 and token.isalpha() and (token[1:].islower() or token.isupper()) and bool(_VOWEL.search(low)) and not _RUN.search(low)


class _Wordish(dict):
    LIMIT = 300_000

    def __missing__(self, token: str) -> bool:
        if len(self) >= self.LIMIT:
            self.clear()
        v = self[token] = wordish(token)
        return v


def is_cells(line: str, n_words: int) -> bool:
    """Whether a line is a row of cells: bars, quoted cells, tabs or wide gaps between short cells."""
    s = line.strip()
    if s[0] == "|" and s[-1] == "|" and len(s) > 1:
        return s.count("|") > 2 or "-" in s or n_words > 2
    if s[0] == '"' and _QUOTED.fullmatch(s):
        return True
    if "\t" in line:
        cells = line.split("\t")
        if max(map(len, cells)) <= 60 and n_words <= 6 * len(cells) and not re.search(r"[a-z]{2}\.$", s):
            return True
    return (bool(_GAPS.search(s)) or line.startswith("        ")) and not re.search(r"[a-z]{2}\.$", s) and not _CONTENTS.search(s)


def features(text: str | None, common: frozenset[str], known: dict[str, bool]) -> list[float]:
    """Number of words, then :data:`FEATURES`."""
    t = text or ""
    words = t.split()
    n = len(words)
    if not n:
        return [0.0] * (1 + len(FEATURES))
    solid = sum(map(len, words))
    lines = entry = contents = cells = short = closed = 0
    for line in t.split("\n"):
        s = line.strip()
        if not s:
            continue
        lines += 1
        m = len(s.split())
        ends = bool(_END.search(s))
        closed += ends or s[-1] in ":;,"
        row = is_cells(line, m)
        cells += row
        if not ends:
            entry += bool(_ENTRY.match(s))
            contents += bool(_CONTENTS.search(s))
        short += m <= 6 and len(s) <= 60 and not ends and not row
    plain = [w for w in _NOT_LETTERS.split(t.lower()) if w]
    tokens = [w for w in _TOKEN.findall(t) if len(w) > 1 and not w.isdigit()]
    letters = sum(map(len, plain))
    return [
        float(n), float(lines), n / lines, solid / n, len(_ALNUM_SPACE.sub("", t)) / solid, closed / lines, sum(map(common.__contains__, plain)) / max(1, len(plain)), entry / lines, contents / lines,
        cells / lines, len(_STOP.findall(t)) / n, short / lines, sum(len(w) == 1 for w in words) / n, sum(map(known.__getitem__, tokens)) / max(1, len(tokens)), 0.0 if t.isascii() else len(_PLAIN.sub("", t)) / solid, letters / solid,
    ]


STATS = "section_id bigint, n_words int, miscount boolean, trusted boolean, " + ", ".join(f"{f} double" for f in FEATURES)


def _stats(common: frozenset[str]):
    def run(batches):
        known = _Wordish()
        for b in batches:
            told, heads = b.column("word_count").to_pylist(), b.column("heading_text").to_pylist()
            rows = [features(t, common, known) for t in b.column("content_text").to_pylist()]
            x = np.array(rows, np.float64).reshape(-1, 1 + len(FEATURES))
            real = [int(r[0]) + len((h or "").split()) for r, h in zip(rows, heads)]
            trusted = [None if c is None else c == n for c, n in zip(told, real)]
            yield pa.record_batch(
                [b.column("section_id"), pa.array(x[:, 0].astype(np.int32)), pa.array([t is False for t in trusted], pa.bool_()), pa.array(trusted, pa.bool_()), *(pa.array(x[:, k]) for k in range(1, x.shape[1]))],
                names=["section_id", "n_words", "miscount", "trusted", *FEATURES],
            )

    return run


@lru_cache(maxsize=4)
def rules(common: frozenset[str]) -> tuple[tuple[list, str], ...]:
    """The rule list learned on the labelled documents."""
    known = _Wordish()
    made = seeds()
    x = np.array([features(t, common, known)[1:] for _, t in made])
    return tuple(induce({f: x[:, k] for k, f in enumerate(FEATURES)}, np.array([k for k, _ in made]), KINDS))


def common_words(words: DataFrame) -> frozenset[str]:
    """The fixed list of common words, checked for its bound."""
    rows = words.where("word is not null").select("word").distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    return frozenset(r.word for r in rows)


def verdict_sql(common: frozenset[str]) -> str:
    """The learned rule list as a SQL CASE expression over :data:`FEATURES`."""
    return to_sql(list(rules(common)), "prose")


def stats(content: DataFrame, words: DataFrame) -> DataFrame:
    """:data:`STATS` and ``kind`` of every row."""
    common = common_words(words)
    rows = content.where("section_id is not null").select("section_id", "heading_text", F.col("word_count").cast("int").alias("word_count"), "content_text")
    return rows.mapInArrow(_stats(common), STATS).withColumn("kind", F.when(F.col("n_words") == 0, F.lit("prose")).otherwise(F.expr(verdict_sql(common))))


def quality(content: DataFrame, words: DataFrame) -> DataFrame:
    """``section_id``, all statistics, ``kind`` and ``trusted`` (null where no word count is stored)."""
    return stats(content, words).select("section_id", "n_words", *FEATURES, "kind", "trusted").dropDuplicates(["section_id"])


def found(content: DataFrame, words: DataFrame) -> DataFrame:
    """``section_id, kind``: what isn't prose, and ``miscount`` where the stored count is wrong."""
    kinds = F.array_compact(F.array(F.when(F.col("kind") != "prose", F.col("kind")), F.when(F.col("miscount"), F.lit("miscount"))))
    return stats(content, words).select("section_id", F.explode(kinds).alias("kind")).distinct()
