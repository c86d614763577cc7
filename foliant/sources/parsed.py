"""Parsed document trees and cleaned records, from files to rows.

A parser is a plug-in: bytes to elements. Trees stored as JSON come with one built in. A file that fails is a row of the failures, not an
end of the run.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.identity import stem
from foliant.schemas import CLEANED, UINT64

#: One element: kind, label, text, caption, grid, pages.
Element = tuple[str, str | None, str | None, str | None, list[list[str | None]] | None, list[int]]
PARSED = "doc_id string, seq int, elem_type string, label string, text string, caption string, grid array<array<string>>, pages array<int>, binary_hash decimal(20,0), error string"
_KINDS = {"texts": "text", "tables": "table", "pictures": "picture", "groups": "group", "key_value_items": "group", "form_items": "group"}


def tree_elements(tree: dict) -> Iterator[Element]:
    """Elements of a stored document tree in reading order; captions belong to their table or picture."""

    def find(ref: dict) -> tuple[str, dict]:
        _, kind, at = ref["$ref"].split("/")
        return kind, tree[kind][int(at)]

    def caption(item: dict) -> str | None:
        parts = [find(c)[1].get("text") or "" for c in item.get("captions", [])]
        return " ".join(p for p in parts if p) or None

    todo = list(reversed(tree["body"].get("children", [])))
    while todo:
        kind, item = find(todo.pop())
        grid = None
        if kind == "tables":
            grid = [[c.get("text") for c in row] for row in (item.get("data") or {}).get("grid", [])]
        pages = [p["page_no"] for p in item.get("prov", []) if "page_no" in p]
        yield _KINDS.get(kind, kind), item.get("label"), item.get("text"), caption(item), grid, pages
        todo.extend(reversed(item.get("children", [])))


def tree_hash(tree: dict) -> int:
    return int(tree["origin"]["binary_hash"])


def parse_json(raw: bytes) -> tuple[int, list[Element]]:
    tree = json.loads(raw.decode("utf-8"))
    return tree_hash(tree), list(tree_elements(tree))


def parse(files: DataFrame, parser: Callable[[bytes], tuple[int, list[Element]]] = parse_json) -> DataFrame:
    """``binaryFile`` rows to :data:`PARSED`: a row for each element, or one with the error of a file that fails. One task holds one file at a time."""
    from decimal import Decimal

    names = [f.split()[0] for f in PARSED.replace("decimal(20,0)", "decimal").split(", ")]
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.list_(pa.string())), pa.list_(pa.int32()), pa.decimal128(20, 0), pa.string()]

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("content").to_pylist()):
                try:
                    h, elements = parser(raw)
                    if not 0 <= h < UINT64:
                        raise ValueError(f"hash out of range: {h}")
                    rows += [(doc, i, *e, Decimal(h), None) for i, e in enumerate(elements, 1)]
                except Exception as e:  # noqa: BLE001 - the failure is the file's own
                    rows.append((doc, 0, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return files.select(stem("path").alias("doc_id"), "content").mapInArrow(run, PARSED)


def elements(parsed: DataFrame) -> DataFrame:
    return parsed.where("error is null").drop("binary_hash", "error")


def parse_failures(parsed: DataFrame) -> DataFrame:
    return parsed.where("error is not null").select("doc_id", F.lit("parse").alias("stage"), F.col("error").alias("reason"))


def cleaned_records(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows of cleaned records as ``doc_id, record, raw``; the record is null where it isn't UTF-8 or not of the schema."""
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    shown = files.select(stem("path").alias("doc_id"), text.alias("raw"))
    return shown.withColumn("record", F.from_json("raw", CLEANED, {"mode": "PERMISSIVE"}))


def cleaned_failures(records: DataFrame) -> DataFrame:
    """Records that break the contract, with the first reason: ``doc_id, reason``.

    In order: not UTF-8; no object of document and sections; unknown keys; counts that are no whole numbers (a boolean is none); no sections; number
    of sections; order 1 to n; hash range; a section without heading and content; pages below 1 or out of order; words that differ.
    """
    from foliant.functions.text import words

    r, s = F.col("record"), F.col("record.sections")
    # each is parsed once, as columns of their own
    records = records.withColumns({
        "_top": F.json_object_keys("raw"),
        "_head": F.json_object_keys(F.get_json_object("raw", "$.document")),
        "_typed": F.from_json("raw", "document struct<n_parsed_sections:string,binary_hash:string>, sections array<map<string,string>>"),
    })
    top, head, typed = F.col("_top"), F.col("_head"), F.col("_typed")
    whole = lambda c: c.rlike(r"\A-?\d+\z")
    keys = F.array(*[F.lit(k) for k in ("sort_order", "heading_text", "content_text", "word_count", "page_start", "page_end")])
    odd = lambda name, null_ok: F.exists(typed["sections"], lambda x: (F.lit(not null_ok) & x[name].isNull()) | (x[name].isNotNull() & ~whole(x[name])))
    n = lambda c: F.size(words(c))
    reason = (
        F.when(F.col("raw").isNull(), "not UTF-8")
        .when(top.isNull() | r.isNull() | s.isNull() | F.col("record.document").isNull(), "malformed")
        .when((F.size(F.array_except(top, F.array(F.lit("document"), F.lit("sections")))) > 0) | (F.size(F.array_except(head, F.array(F.lit("n_parsed_sections"), F.lit("binary_hash")))) > 0) | F.exists(typed["sections"], lambda x: F.size(F.array_except(F.map_keys(x), keys)) > 0), "unknown key")
        .when(~F.coalesce(whole(typed["document"]["n_parsed_sections"]) & whole(typed["document"]["binary_hash"]), F.lit(False)) | odd("sort_order", False) | odd("word_count", False) | odd("page_start", True) | odd("page_end", True), "wrong type")
        .when(F.size(s) == 0, "no sections")
        .when(F.col("record.document.n_parsed_sections") != F.size(s), "number of sections")
        .when(F.transform(s, lambda x: x["sort_order"]) != F.sequence(F.lit(1), F.size(s)), "order")
        .when(F.col("record.document.binary_hash").isNull() | (F.col("record.document.binary_hash") < 0) | (F.col("record.document.binary_hash") >= F.lit(str(UINT64)).cast("decimal(20,0)")), "hash range")
        .when(F.exists(s, lambda x: x["heading_text"].isNull() & x["content_text"].isNull()), "nothing in a section")
        .when(F.exists(s, lambda x: F.coalesce((x["page_start"] < 1) | (x["page_end"] < 1) | (x["page_start"] > x["page_end"]), F.lit(False))), "pages")
        .when(F.exists(s, lambda x: x["word_count"] != n(x["heading_text"]) + n(x["content_text"])), "word count")
    )
    return records.withColumn("reason", reason).where("reason is not null").select("doc_id", "reason")


def paired(parsed: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Documents of either side: ``doc_id, error``; an error where the other side is missing."""
    a, b = parsed.select("doc_id").distinct().withColumn("p", F.lit(True)), cleaned.select("doc_id").distinct().withColumn("c", F.lit(True))
    return a.join(b, "doc_id", "full").select("doc_id", F.when(F.col("p").isNull(), "not parsed").when(F.col("c").isNull(), "not cleaned").alias("error"))
