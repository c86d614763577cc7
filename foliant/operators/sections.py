"""Document elements in reading order to sections, documents and cleaned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import is_blank, py_strip, word_count

#: Labels that never reach a section, labels that open one, and labels whose text is kept.
DROPPED = ("page_header", "page_footer", "caption")
HEADINGS = ("title", "section_header")
TEXTS = ("text", "paragraph", "list_item", "code", "formula", "footnote", "reference", "checkbox_selected", "checkbox_unselected", "handwritten_text", "empty_value", "field_item")


def markdown(grid: str | Column = "grid", caption: str | Column = "caption") -> Column:
    """A table as markdown with its caption in front; a blank grid is its caption, or null without one."""
    g = F.col(grid) if isinstance(grid, str) else grid
    c = F.col(caption) if isinstance(caption, str) else caption
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda x: F.coalesce(x, F.lit(""))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(F.element_at(g, 1))))
    lines = F.concat(F.array(row(F.element_at(g, 1)), rule), F.transform(F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0))), row))
    filled = F.exists(F.flatten(g), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    body = F.array_join(lines, "\n")
    cap = F.when(~is_blank(c), py_strip(c))
    return F.when(F.coalesce(filled, F.lit(False)), F.when(cap.isNotNull(), F.concat(cap, F.lit("\n\n"), body)).otherwise(body)).otherwise(cap)


def classified(elements: DataFrame) -> DataFrame:
    """Elements with ``role`` (heading, block, unknown, or null for what is dropped) and ``block``, the text they give.

    Rules in order: furniture and captions are dropped; tables give markdown; pictures their caption; headings open a section
    unless blank; other text is kept unless blank; anything else with text is unknown, which is an error of the document.
    """
    label, kind, text = F.col("label"), F.col("elem_type"), F.col("text")
    block = (
        F.when(label.isin(*DROPPED), None)
        .when(kind == "table", markdown())
        .when(kind == "picture", F.when(~is_blank("caption"), py_strip("caption")))
        .when(~is_blank(text), py_strip(text))
    )
    role = (
        F.when(F.col("block").isNull(), None)
        .when(kind.isin("table", "picture"), "block")
        .when(label.isin(*HEADINGS), "heading")
        .when((kind == "text") & label.isin(*TEXTS), "block")
        .otherwise("unknown")
    )
    return elements.withColumn("block", block).withColumn("role", role)


def unknown_elements(elements: DataFrame) -> DataFrame:
    """Elements that carry text but have no rule."""
    return classified(elements).where("role = 'unknown'").select("doc_id", "seq", "elem_type", "label")


def section_failures(elements: DataFrame) -> DataFrame:
    """Documents that can't be taken apart: ``doc_id, stage, reason`` with the first unknown element in reading order."""
    first = unknown_elements(elements).groupBy("doc_id").agg(F.min(F.struct("seq", "elem_type", "label"))["label"].alias("label"), F.count("*").alias("n"))
    return first.select("doc_id", F.lit("clean").alias("stage"), F.concat(F.lit("unknown element "), F.coalesce("label", F.lit("")), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("reason"))


def sections(elements: DataFrame) -> DataFrame:
    """``doc_id, sort_order, heading_text, content_text, word_count, page_start, page_end``.

    A document with an element that carries text but has no rule gives no sections; :func:`section_failures` names it.
    A running count of headings numbers the sections of a document; text before the first heading is a section without
    heading. Blocks join with a blank line; a section without blocks has a null content. Window and grouping share the
    document key, so there is one shuffle; a document is one file and bounded by it.
    """
    whole = Window.partitionBy("doc_id")
    known = classified(elements).withColumn("_odd", F.max(F.coalesce(F.col("role") == "unknown", F.lit(False))).over(whole)).where(~F.col("_odd"))
    kept = known.where("role is not null")
    w = whole.orderBy("seq")
    cut = kept.withColumn("part", F.sum(F.when(F.col("role") == "heading", 1).otherwise(0)).over(w))
    grouped = cut.groupBy("doc_id", "part").agg(
        F.max(F.when(F.col("role") == "heading", F.col("block"))).alias("heading_text"),
        F.array_sort(F.collect_list(F.when(F.col("role") != "heading", F.struct("seq", "block")))).alias("blocks"),
        F.min(F.array_min("pages")).alias("page_start"),
        F.max(F.array_max("pages")).alias("page_end"),
    )
    content = F.when(F.size("blocks") > 0, F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("part"))
    return grouped.withColumn("content_text", content).select(
        "doc_id", order.alias("sort_order"), "heading_text", "content_text", (word_count("heading_text") + word_count("content_text")).alias("word_count"), "page_start", "page_end"
    )


def documents(sections_: DataFrame) -> DataFrame:
    """One row per document: sections, words and pages."""
    return sections_.groupBy("doc_id").agg(F.count("*").cast("int").alias("n_parsed_sections"), F.sum("word_count").alias("words"), F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"))


def cleaned(sections_: DataFrame, hashes: DataFrame) -> DataFrame:
    """The cleaned record of each document as JSON: ``doc_id, record``; keys in schema order."""
    parts = sections_.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sort_order", "heading_text", "content_text", "word_count", "page_start", "page_end"))).alias("sections"))
    head = F.struct(F.size("sections").alias("n_parsed_sections"), F.col("binary_hash"))
    return parts.join(hashes, "doc_id").select("doc_id", F.to_json(F.struct(head.alias("document"), F.col("sections")), {"ignoreNullFields": "false"}).alias("record"))


def elements_of(documents_: DataFrame, per_page: int = 5) -> DataFrame:
    """Elements from plain texts: each line one; lines of one to six words are headings; ``per_page`` lines make a page."""
    lines = documents_.select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "text"))
    n = word_count("text")
    return lines.select(
        "doc_id",
        (F.col("pos") + 1).alias("seq"),
        F.lit("text").alias("elem_type"),
        F.when(n.between(1, 6), "section_header").otherwise("text").alias("label"),
        "text",
        F.lit(None).cast("string").alias("caption"),
        F.lit(None).cast("array<array<string>>").alias("grid"),
        F.array((1 + F.floor((F.col("pos") + 1) / per_page)).cast("int")).alias("pages"),
    )
