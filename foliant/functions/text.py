"""Text expressions with Python's notion of white space and words.

Java's ``\\s``, RE2's ``\\s`` and Python's ``str.split()`` differ; the class below is Python's and is used in
Spark and in the SQL counterparts alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's ``str.isspace`` accepts, as a regex class body.
WS = r" \t\n\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same as plain characters.
WS_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: A run of white space.
WS_RUN = f"[{WS}]+"
#: A token for coverage checks: a decimal number or a run of Unicode word characters.
TOKEN = r"\p{Nd}+\.\p{Nd}+|[\p{L}\p{N}_]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: str | Column) -> Column:
    """``str.split()`` as an array; null gives an empty array."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), WS_RUN), lambda x: x != "")


def word_count(c: str | Column) -> Column:
    """Number of words; null and blank texts have none."""
    s = F.btrim(F.coalesce(col(c), F.lit("")), F.lit(WS_CHARS))
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, WS_RUN)))


def py_strip(c: str | Column) -> Column:
    """``str.strip()``, without a regular expression."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def is_blank(c: str | Column) -> Column:
    return F.coalesce(py_strip(c) == "", F.lit(True))


def squash(c: str | Column) -> Column:
    """Trim and make each run of white space one space."""
    return F.trim(F.regexp_replace(col(c), WS_RUN, " "))


def tokens(c: str | Column) -> Column:
    """Distinct normalised tokens: lower case; decimals lose trailing zeros and a trailing point."""
    found = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))
    return F.array_distinct(
        F.transform(found, lambda x: F.when(x.rlike(r"\A\p{Nd}+\.\p{Nd}+\z"), F.regexp_replace(x, r"\.?0*\z", "")).otherwise(x))
    )


def low64_sha256(c: str | Column) -> Column:
    """Low 64 bits of the SHA-256 of a text as ``decimal(20,0)``."""
    return F.conv(F.right(F.sha2(col(c), 256), F.lit(16)), 16, 10).cast("decimal(20,0)")


def row_text(pairs: list[tuple[str, str | Column]]) -> Column:
    """``Header: value`` lines in the given order; a null value is an empty one."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{h}: "), F.coalesce(col(c).cast("string"), F.lit(""))) for h, c in pairs])
