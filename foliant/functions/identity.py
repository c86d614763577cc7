"""Identities: collection paths, stems, column names and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import col

PATH = r"\A[a-z0-9_]+(\.[a-z0-9_]+)*\z"
IDENTIFIER = r"\A[a-z_][a-z0-9_]*\z"
#: Longest generated column name, in characters, and longest derived index name, in bytes.
LONGEST_NAME = 63


def label(c: str | Column) -> Column:
    """Lower case, every other run than ASCII letters and digits one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def valid_path(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(PATH), F.lit(False))


def valid_identifier(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(IDENTIFIER), F.lit(False))


def stem(c: str | Column) -> Column:
    """File name without folders and without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(F.regexp_extract(col(c), r"([^/\\]*)\z", 1), r"(?<=.)\.[^.]*\z", "")


def sheet_path(file: str | Column, sheet: str | Column, override: str | Column | None = None, prefix: str | None = None) -> Column:
    """An authored path as it is, never prefixed; else ``[prefix.]stem.sheet`` of labels. Invalid results are null."""
    if prefix is not None and not re.fullmatch(PATH.replace(r"\z", r"\Z"), prefix):
        raise ValueError(f"invalid prefix {prefix!r}")
    parts = [label(stem(file)), label(sheet)]
    derived = F.concat_ws(".", *([F.lit(prefix)] if prefix else []), *parts)
    path = derived if override is None else F.coalesce(col(override), derived)
    return F.when(valid_path(path), path)


def column_name(header: str | Column, position: str | Column) -> Column:
    """``col_`` and the header's label, or its position where that is empty; at most 63 characters."""
    slug = label(header)
    named = F.concat(F.lit("col_"), F.when(slug == "", F.concat(F.lit("col_"), col(position).cast("string"))).otherwise(slug))
    return F.regexp_replace(F.substring(named, 1, LONGEST_NAME), "_+$", "")


def distinct_names(names: list[str], most: int = LONGEST_NAME) -> list[str]:
    """Later repetitions get ``_2``, ``_3`` and so on, shortened to fit; names are metadata, so this runs on the driver."""
    out, seen = [], set()
    for name in names:
        new, n = name, 2
        while new in seen:
            tail = f"_{n}"
            new, n = name[: most - len(tail)].rstrip("_") + tail, n + 1
        seen.add(new)
        out.append(new)
    return out


def header_columns(headers: list[str]) -> list[str]:
    """Column names of a list of headers, kept apart; the same rule as :func:`column_name`."""
    slugs = [re.sub("^_+|_+$", "", re.sub("[^a-z0-9]+", "_", h.lower())) for h in headers]
    return distinct_names([re.sub("_+$", "", f"col_{x or f'col_{i}'}"[:LONGEST_NAME]) for i, x in enumerate(slugs)])


def folder_name(title: str | Column, key: str | Column) -> Column:
    """``pub_<key>_<slug>`` of a title less its programme names in front and ``Manual`` at the end; an empty slug is null."""
    t = col(title)
    # fixed values: words taken off the front, in this order, each once
    for word in ("Medicare ", "Medicaid ", "CMS "):
        t = F.regexp_replace(t, f"^{word}", "")
    slug = label(F.regexp_replace(t, r" Manual\z", ""))
    return F.when(slug != "", F.concat(F.lit("pub_"), label(key), F.lit("_"), slug))


def rooted(c: str | Column) -> Column:
    """Whether a path has a drive or a root under either system."""
    return col(c).rlike(r"^(?:[A-Za-z]:|/|\\)")


def escapes(c: str | Column) -> Column:
    """Whether a destination leaves its folder: empty, rooted, or with a ``..`` part."""
    path = F.replace(col(c), F.lit("\\"), F.lit("/"))
    return F.coalesce(rooted(c) | F.array_contains(F.split(path, "/"), "..") | (F.trim(path) == ""), F.lit(True))


def column_index(letters: str) -> int:
    """Spreadsheet column letters to a number from 1."""
    if not re.fullmatch("[A-Za-z]+", letters):
        raise ValueError(f"not a column: {letters!r}")
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n


def file_names(urls: list[str]) -> list[str]:
    """One file name for each URL: its last part, on a clash with its folder in front, then numbered."""
    used, out = set(), []
    for url in urls:
        parts = [p for p in url.split("?")[0].split("/") if p]
        name = parts[-1]
        if name in used and len(parts) > 1:
            name = f"{parts[-2]}_{parts[-1]}"
        base, dot, ext = name.rpartition(".")
        base, n = (base, 2) if dot else (name, 2)
        while name in used:
            name, n = f"{base}_{n}{dot}{ext if dot else ''}", n + 1
        used.add(name)
        out.append(name)
    return out
