"""Workbooks to cells: one row per non-empty cell.

:func:`read_cells` takes ``binaryFile`` rows, so files may lie on any storage Spark reads; ``spark.read.format("workbook").load(path)`` is a
Python data source for local paths. A cell is the text of its value as Python prints it: numbers, booleans, dates by the cell's
format, and the text of a formula, of a shared one as it reads in its own cell.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from foliant.functions.identity import column_index

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"


#: Built-in number formats that show dates or times, and the one of them that shows a duration.
DATE_FORMATS, DURATION = {*range(14, 23), 45, 46, 47}, 46
SCHEMAS = {
    "cells": "file string, sheet string, r int, c int, value string",
    "merged": "file string, sheet string, min_col int, min_row int, max_col int, max_row int",
    "sheets": "file string, sheet string, position int",
}
Book = str | bytes


def _zip(book: Book) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(book) if isinstance(book, bytes) else book)


def sheet_list(path: Book) -> list[tuple[str, str]]:
    """Names of the sheets in workbook order and their parts; a file that is no workbook is a ValueError."""
    try:
        with _zip(path) as z:
            book = ET.fromstring(z.read("xl/workbook.xml"))
            rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(f"{_PKG}Relationship")}
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise ValueError(f"not a workbook: {path if isinstance(path, str) else len(path)}: {e}") from e
    place = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
    return [(s.get("name"), place(rels[s.get(f"{_REL}id")])) for s in book.iter(f"{_MAIN}sheet")]


def _shared(z: zipfile.ZipFile) -> list[str]:
    try:
        raw = z.read("xl/sharedStrings.xml")
    except KeyError:
        return []
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(raw).iter(f"{_MAIN}si")]


def _number(text: str) -> str:
    """A stored number as Python prints it."""
    try:
        return str(int(text))
    except ValueError:
        v = float(text)
        return str(int(v)) if v.is_integer() and "e" not in text.lower() and "." not in text else str(v)


def _date_styles(z: zipfile.ZipFile) -> dict[int, str]:
    """Styles that show a date (``date``) or a duration (``duration``), by their place in the list of cell formats."""
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except (KeyError, ET.ParseError):
        return {}
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    out = {}
    for i, x in enumerate(root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")):
        n = int(x.get("numFmtId", "0"))
        code = re.sub(r'"[^"]*"|\\.|_.|\*.', "", own.get(n, "").split(";")[0])
        if n == DURATION or re.search(r"\[(?:h+|m+|s+)\]", code, re.I):
            out[i] = "duration"
        elif n in DATE_FORMATS or re.search("[dmyhs]", re.sub(r"\[[^\]]*\]", "", code), re.I) and code.lower() != "general":
            out[i] = "date"
    return out


def date_text(number: str, kind: str, from_1904: bool = False) -> str:
    """A serial number as Python prints its date and time, time of day (below one) or duration; what is out of range stays a number."""
    v = float(number)
    try:
        if kind == "duration":
            return str(dt.timedelta(seconds=round(v * 86400)))
        if 0 <= v < 1:
            return str((dt.datetime(2000, 1, 1) + dt.timedelta(seconds=round(v * 86400))).time())
        # the format counts a 29 February 1900 that never was
        start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31 if v < 60 else 30)
        return str(start + dt.timedelta(days=int(v), seconds=round(v % 1 * 86400)))
    except (OverflowError, ValueError):
        return _number(number)


_REFERENCE = re.compile(r"""("[^"]*"|'[^']*'!?)|(?<![A-Za-z0-9_.$])(?:(\$?)([A-Z]{1,3})(\$?)([0-9]+)|(\$?)([A-Z]{1,3}):(\$?)([A-Z]{1,3})|(\$?)([0-9]+):(\$?)([0-9]+))(?![A-Za-z0-9_.(!])""")


def _letters(n: int) -> str:
    out = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def moved(formula: str, rows: int, cols: int) -> str:
    """A formula as it reads so many rows and columns on: references move unless they are fixed; one that leaves the sheet is ``#REF!``."""

    def col(fixed: str, name: str) -> str:
        n = column_index(name) + (0 if fixed else cols)
        return fixed + _letters(n) if n > 0 else "#REF!"

    def row(fixed: str, number: str) -> str:
        n = int(number) + (0 if fixed else rows)
        return fixed + str(n) if n > 0 else "#REF!"

    def put(m: re.Match) -> str:
        if m[1] is not None:
            return m[1]
        parts = [col(m[2], m[3]), row(m[4], m[5])] if m[3] else [col(m[6], m[7]), col(m[8], m[9])] if m[7] else [row(m[10], m[11]), row(m[12], m[13])]
        return "#REF!" if "#REF!" in parts else "".join(parts) if m[3] else ":".join(parts)

    return _REFERENCE.sub(put, formula)


def cells(path: Book, only: str | None = None) -> Iterator[tuple[str, int, int, str]]:
    """``sheet, r, c, value``; a formula gives its text, a boolean True or False; blank cells are left out."""
    with _zip(path) as z:
        strings, dates = _shared(z), _date_styles(z)
        settings = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
        from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
        for name, part in sheet_list(path):
            if only and name != only:
                continue
            shared: dict[str, tuple[int, int, str]] = {}
            with z.open(part) as f:
                for _, e in ET.iterparse(f):
                    if e.tag != f"{_MAIN}c":
                        continue
                    m = re.fullmatch(r"([A-Z]+)(\d+)", e.get("r"))
                    r, c = int(m[2]), column_index(m[1])
                    kind, v, formula = e.get("t"), e.find(f"{_MAIN}v"), e.find(f"{_MAIN}f")
                    of = shared.get(formula.get("si")) if formula is not None and formula.get("t") == "shared" else None
                    if formula is not None and formula.text:
                        value = "=" + formula.text
                        if formula.get("t") == "shared":
                            shared[formula.get("si")] = r, c, formula.text
                    elif of:
                        value = "=" + moved(of[2], r - of[0], c - of[1])
                    elif kind == "inlineStr":
                        value = "".join(t.text or "" for t in e.iter(f"{_MAIN}t"))
                    elif v is None or v.text is None:
                        value = ""
                    elif kind == "s":
                        value = strings[int(v.text)]
                    elif kind == "b":
                        value = {"1": "True", "0": "False"}.get(v.text, v.text)
                    elif kind in ("str", "e", "d"):
                        value = v.text
                    else:
                        shown = dates.get(int(e.get("s", "0")))
                        value = date_text(v.text, shown, from_1904) if shown else _number(v.text)
                    if value.strip():
                        yield name, r, c, value.strip()
                    e.clear()


def merged(path: Book) -> Iterator[tuple[str, int, int, int, int]]:
    """``sheet, min_col, min_row, max_col, max_row`` of merged ranges; a part that can't be read has none."""
    with _zip(path) as z:
        for name, part in sheet_list(path):
            try:
                root = ET.fromstring(z.read(part))
            except (KeyError, ET.ParseError):
                continue
            for e in root.iter(f"{_MAIN}mergeCell"):
                m = re.fullmatch(r"([A-Z]+)(\d+):([A-Z]+)(\d+)", e.get("ref", ""))
                if m:
                    yield name, column_index(m[1]), int(m[2]), column_index(m[3]), int(m[4])


def _rows(book: Book, what: str, sheet: str | None = None) -> Iterator[tuple]:
    if what == "cells":
        return cells(book, sheet)
    return merged(book) if what == "merged" else ((n, i) for i, (n, _) in enumerate(sheet_list(book), 1))


def read_cells(files: DataFrame, what: str = "cells", sheet: str | None = None) -> DataFrame:
    """``binaryFile`` rows to the rows of :data:`SCHEMAS`: ``cells``, ``merged`` ranges or ``sheets``. One task holds one file at a time; a file that is no workbook is an error."""
    fields = SCHEMAS[what].split(", ")
    names, types = [f.split()[0] for f in fields], [pa.string() if f.endswith("string") else pa.int32() for f in fields]

    def run(batches):
        for b in batches:
            for path, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows = [(path, *row) for row in _rows(raw, what, sheet)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return files.select("path", "content").mapInArrow(run, SCHEMAS[what])


class _Files(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.what, self.sheet = options["path"], options.get("what", "cells"), options.get("sheet")

    def partitions(self) -> list[_Files]:
        import glob

        found = sorted(glob.glob(self.path))
        if not found:
            raise FileNotFoundError(self.path)
        return [_Files(p) for p in found]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for row in _rows(partition.path, self.what, self.sheet):
            yield (partition.path, *row)


class WorkbookSource(DataSource):
    """Options: ``what`` (cells, merged or sheets) and ``sheet``. One partition for each file."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("what", "cells")]

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(WorkbookSource)


def input_failures(sheets: list[tuple[str, dict]], root: str = ".") -> list[tuple[str, str, str]]:
    """``file, sheet, reason`` of authored sheets that can't be read: no file, no workbook, no such sheet, no rows, or an invalid path. Each file is opened once for its names."""
    from pathlib import Path

    from foliant.functions.identity import PATH
    from foliant.sources.config import anchored

    names: dict[str, set[str] | str] = {}
    out = []
    for file, s in sheets:
        path = anchored(file, root)
        if file not in names:
            try:
                names[file] = {n for n, _ in sheet_list(str(path))} if Path(path).is_file() else "no file"
            except ValueError:
                names[file] = "no workbook"
        known, own = names[file], s.get("collection_path")
        if isinstance(known, str):
            out.append((file, s["sheet"], known))
        elif s["sheet"] not in known:
            out.append((file, s["sheet"], "no such sheet"))
        elif not any(r > s.get("header_row", 1) for _, r, _, _ in cells(str(path), s["sheet"])):
            out.append((file, s["sheet"], "no rows"))
        elif own is not None and not re.fullmatch(PATH.replace(r"\z", r"\Z"), own):
            out.append((file, s["sheet"], "invalid path"))
    return out
