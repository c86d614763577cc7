"""Corpus quality: coverage, element census, page coverage, fragmentation, text health and section numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import col, is_blank, tokens, word_count, words
from foliant.operators.sections import DROPPED, classified
from foliant.runtime import materialize

#: A section is flagged beyond these.
SINGLE_LETTERS, BROKEN_WORDS = 0.15, 10
#: Digits to which ratios are rounded before they are compared, half to even.
DIGITS = 4
_BAD = r"[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\x{fffd}]+"


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.bround(part / whole, DIGITS))


def bad_characters(c: str | Column) -> Column:
    """Replacement and control characters other than tab and line ends."""
    return F.length(F.regexp_replace(F.coalesce(col(c), F.lit("")), _BAD, ""))


def text_health(sections: DataFrame, text: str = "content_text") -> DataFrame:
    """Adds ``bad_chars, single_ratio, broken, severity, flagged``: odd characters, share of single letters, words broken over tokens.

    The words are split once: everything about them is one expression over the array.
    """
    pairs = lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: a.endswith("-") & b.rlike(r"\A\p{Ll}"))
    of_words = F.transform(
        F.array(words(text)),
        lambda w: F.struct(
            F.coalesce(ratio(F.size(F.filter(w, lambda x: (F.length(x) <= 2) & x.rlike(r"\A\p{L}\z"))), F.size(w)), F.lit(0.0)).alias("single_ratio"),
            F.when(F.size(w) > 1, F.size(F.filter(pairs(w), lambda x: x))).otherwise(0).alias("broken"),
        ),
    )[0]
    shown = sections.withColumn("_m", of_words).withColumn("bad_chars", bad_characters(text)).withColumn("single_ratio", F.col("_m.single_ratio")).withColumn("broken", F.col("_m.broken")).drop("_m")
    return shown.withColumn("severity", F.col("bad_chars") * 100 + F.col("single_ratio") * 10 + F.col("broken")).withColumn("flagged", (F.col("bad_chars") > 0) | (F.col("single_ratio") > SINGLE_LETTERS) | (F.col("broken") > BROKEN_WORDS))


def without_tables(text: str | Column) -> Column:
    """Text without lines of markdown tables; blank lines stay."""
    lines = F.split(col(text), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]")
    return F.array_join(F.filter(lines, lambda x: ~(F.ltrim(x).startswith("|") | (x.rlike(r"\A[\s|:-]+\z") & (F.trim(x) != "")))), "\n")


def coverage_gap(parsed: DataFrame, cleaned: DataFrame, key: list[str], parsed_text: str, cleaned_text: str) -> DataFrame:
    """Tokens of the parsed texts that the cleaned ones of the same key lack: ``key, n_tokens, n_missing, sample`` (the first five in order).

    Texts become sets of tokens where they are read, and a key's sets meet as arrays, one row for each side: a key is a section or a
    document, and its tokens no more than its text.
    """
    merge = lambda d, t, name: d.select(*key, tokens(t).alias("_t")).groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list("_t"))).alias(name))
    joined = merge(parsed, parsed_text, "_a").join(merge(cleaned, cleaned_text, "_b"), key, "left")
    gone = F.array_except("_a", F.coalesce("_b", F.expr("cast(array() as array<string>)")))
    return joined.withColumn("_g", gone).select(*key, F.size("_a").alias("n_tokens"), F.size("_g").alias("n_missing"), F.slice(F.array_sort("_g"), 1, 5).alias("sample")).where("n_tokens > 0")


def table_gap(elements: DataFrame, cleaned: DataFrame) -> DataFrame:
    """For each table of a document, in order from 1: tokens of its cells (of its caption where the grid is blank) that the document's sections lack."""
    t = elements.where("elem_type = 'table'").withColumn("table_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")))
    cells = F.array_join(F.transform(F.flatten("grid"), lambda x: F.coalesce(x, F.lit(""))), " ")
    shown = t.select("doc_id", "table_no", F.explode(tokens(F.when(~is_blank(cells), cells).otherwise(F.coalesce("caption", F.lit(""))))).alias("token"))
    have = cleaned.select("doc_id", F.explode(tokens("content_text")).alias("token")).distinct()
    lost = shown.join(have, ["doc_id", "token"], "left_anti")
    return lost.groupBy("doc_id", "table_no").agg(F.array_sort(F.collect_set("token")).alias("missing"))


def census(elements: DataFrame) -> DataFrame:
    """``elem_type, label, n, n_docs, carries_text, unhandled``."""
    return classified(elements).groupBy("elem_type", "label").agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"), F.bool_or(~is_blank("text")).alias("carries_text"), F.bool_or(F.coalesce(F.col("role") == "unknown", F.lit(False))).alias("unhandled")
    )


def page_classes(elements: DataFrame) -> DataFrame:
    """``doc_id, page, kind``: body, blank_table, image_only, furniture_only or no_elements; pages run to the highest one seen."""
    shown = classified(elements).select("doc_id", F.explode("pages").alias("page"), "elem_type", "label", "role", "block")
    per = shown.groupBy("doc_id", "page").agg(
        F.bool_or(F.col("role").isNotNull()).alias("body"),
        F.bool_or((F.col("elem_type") == "table") & F.col("block").isNull()).alias("blank_table"),
        F.bool_or(F.col("elem_type") == "picture").alias("image"),
        F.bool_or(F.col("label").isin(*DROPPED)).alias("furniture"),
    )
    every = per.groupBy("doc_id").agg(F.max("page").alias("last")).select("doc_id", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("page"))
    kind = F.when(F.col("body"), "body").when(F.col("blank_table"), "blank_table").when(F.col("image"), "image_only").when(F.col("furniture"), "furniture_only").otherwise("no_elements")
    return every.join(per, ["doc_id", "page"], "left").select("doc_id", "page", kind.alias("kind"))


def page_coverage(sections: DataFrame, key: str) -> DataFrame:
    """``key, total_pages, covered_pages, coverage``: pages within the sections' ranges, of the pages to the highest one.

    Ranges are merged by a running maximum over their order, so a long range costs one row. A section with one page bound covers none.
    """
    spans = sections.where("page_start is not null and page_end is not null and page_start <= page_end").select(key, "page_start", "page_end").distinct()
    w = Window.partitionBy(key).orderBy("page_start", "page_end")
    seen = F.coalesce(F.max("page_end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = spans.withColumn("new", F.greatest(F.lit(0), F.col("page_end") - F.greatest(F.col("page_start") - 1, seen)))
    covered = new.groupBy(key).agg(F.sum("new").alias("covered"))
    total = sections.groupBy(key).agg(F.greatest(F.max("page_end"), F.max("page_start")).alias("total_pages"))
    return total.join(covered, key, "left").select(key, "total_pages", F.coalesce("covered", F.lit(0)).alias("covered_pages"), ratio(F.coalesce("covered", F.lit(0)), F.col("total_pages")).alias("coverage"))


def fragmentation(sections: DataFrame, key: str) -> DataFrame:
    """``key, section_count, total_pages, sections_per_page, median_words``; a document without pages counts as one page."""
    n = sections.withColumn("_n", word_count("content_text") + word_count("heading_text"))
    shown = n.groupBy(key).agg(F.count("*").alias("section_count"), F.coalesce(F.greatest(F.max("page_end"), F.max("page_start")), F.lit(0)).alias("total_pages"), F.coalesce(F.median("_n"), F.lit(0.0)).alias("median_words"))
    pages = F.when(F.col("total_pages") > 0, F.col("total_pages")).otherwise(1)
    return shown.withColumn("sections_per_page", F.bround(F.col("section_count") / pages, DIGITS))


def fences(df: DataFrame, value: str) -> Column:
    """``lo, hi`` as a scalar subquery: quartiles less and plus 1.5 of their distance (exact, linear between values); null without rows."""
    q = df.agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    lo, hi = F.col("q")[0], F.col("q")[1]
    return q.select(F.struct((lo - 1.5 * (hi - lo)).alias("lo"), (hi + 1.5 * (hi - lo)).alias("hi"))).scalar()


def fragmentation_flags(metrics: DataFrame) -> DataFrame:
    """Documents outside the fences: ``reasons`` of many_sections (per page, among paginated ones), long or short medians.

    The metrics, one row for each document, are written once: the frame and both fences read them.
    """
    metrics = materialize(metrics, "fragmentation")
    p, w = fences(metrics.where("total_pages > 0"), "sections_per_page"), fences(metrics, "median_words")
    paged = F.col("total_pages") > 0
    reasons = F.array_compact(
        F.array(
            F.when(paged & (F.col("sections_per_page") > p["hi"]), "many_sections"),
            F.when(paged & (F.col("sections_per_page") < p["lo"]), "few_sections"),
            F.when(F.col("median_words") > w["hi"], "long_sections"),
            F.when(F.col("median_words") < w["lo"], "short_sections"),
        )
    )
    return metrics.withColumn("reasons", reasons).where("size(reasons) > 0")


def coverage_fence(coverage: DataFrame) -> DataFrame:
    """One row ``fence``: the lower fence of the coverages, at least 0; 0 without any."""
    q = coverage.where("coverage is not null").agg(F.percentile("coverage", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    lo, hi = F.col("q")[0], F.col("q")[1]
    return q.select(F.greatest(F.lit(0.0), F.coalesce(F.bround(lo - 1.5 * (hi - lo), DIGITS), F.lit(0.0))).alias("fence"))


def number_gaps(sections: DataFrame, key: str, heading: str = "heading_text") -> DataFrame:
    """Section numbers missing between neighbouring leading numbers of headings, by the smallest step of the document: ``key, missing_number``."""
    n = sections.select(key, F.expr(f"try_cast(regexp_extract({heading}, '^\\\\s*(\\\\d+)(?:\\\\.\\\\d+)*\\\\b', 1) as bigint)").alias("n")).where("n is not null").distinct()
    w = Window.partitionBy(key).orderBy("n")
    step = n.withColumn("before", F.lag("n").over(w)).withColumn("jump", F.col("n") - F.col("before"))
    least = step.where("jump > 0").groupBy(key).agg(F.min("jump").alias("step"))
    wide = step.join(least, key).where("jump > step")
    return wide.select(key, F.explode(F.sequence(F.col("before") + F.col("step"), F.col("n") - F.lit(1), F.col("step"))).alias("missing_number"))


def ranked_flags(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Documents by the number of checks that flag them: ``key, n_flags, reasons``, most first; ties by key."""
    from functools import reduce

    rows = reduce(lambda a, b: a.unionByName(b), [df.select(key).distinct().withColumn("reason", F.lit(name)) for name, df in parts.items()])
    return rows.groupBy(key).agg(F.count("*").alias("n_flags"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons")).orderBy(F.desc("n_flags"), key)


def summary(sections: DataFrame, key: str) -> DataFrame:
    """Each document's sections, pages, coverage, medians, flagged sections and missing section numbers."""
    health = text_health(sections).groupBy(key).agg(F.count_if("flagged").alias("flagged_sections"), F.max("severity").alias("worst"))
    numbers = number_gaps(sections, key).groupBy(key).agg(F.count("*").alias("missing_numbers"))
    shown = fragmentation(sections, key).join(page_coverage(sections, key).select(key, "covered_pages", "coverage"), key, "left").join(health, key, "left").join(numbers, key, "left")
    return shown.select(key, "section_count", "total_pages", "sections_per_page", "median_words", "covered_pages", "coverage", "flagged_sections", "worst", F.coalesce("missing_numbers", F.lit(0)).alias("missing_numbers"))


def report(sections: DataFrame, key: str, parsed: tuple[DataFrame, str] | None = None, elements: DataFrame | None = None) -> DataFrame:
    """One JSON record for each document, most flagged first: its summary, what flags it, and what could not be checked.

    ``parsed`` (a frame with the key and its text column) adds the tokens that the sections lost; ``elements`` (with ``doc_id`` for the key) the tables'
    lost tokens and the elements without a rule. A check that fails is named in ``errors`` of every record and stops only itself.
    """
    checks = {
        "summary": lambda: summary(sections, key),
        "fragmentation": lambda: fragmentation_flags(fragmentation(sections, key)).select(key, "reasons"),
    }
    if parsed:
        checks["text"] = lambda: coverage_gap(parsed[0], sections, [key], parsed[1], "content_text").select(key, F.col("n_missing").alias("lost_tokens"), F.col("sample").alias("lost_sample"))
    if elements is not None:
        checks["tables"] = lambda: table_gap(elements, sections.withColumnRenamed(key, "doc_id")).groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("tables_with_losses"))
        checks["elements"] = lambda: classified(elements).where("role = 'unknown'").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("unhandled_elements"))
        checks["pages"] = lambda: page_classes(elements).where("kind <> 'body'").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("pages_without_body"))
    out, errors = sections.select(key).distinct(), []
    for name, check in checks.items():
        try:
            out = out.join(materialize(check(), f"report-{name}"), key, "left")
        except Exception as e:  # noqa: BLE001 - a failing check is part of the report
            errors.append(f"{name}: {type(e).__name__}")
    flag = lambda c, cond: F.when(F.coalesce(cond, F.lit(False)), F.lit(c)) if cond is not None else F.lit(None)
    has = lambda c: F.col(c) if c in out.columns else F.lit(None)
    flags = F.array_compact(F.array(
        flag("fragmentation", F.size(has("reasons")) > 0 if "reasons" in out.columns else None), flag("health", has("flagged_sections") > 0), flag("numbers", has("missing_numbers") > 0),
        flag("text", has("lost_tokens") > 0), flag("tables", has("tables_with_losses") > 0), flag("elements", has("unhandled_elements") > 0),
    ))
    shown = out.withColumn("flags", flags).withColumn("errors", F.lit(", ".join(errors)))
    values = [c for c in shown.columns if c != key]
    return shown.select(key, F.size("flags").alias("n_flags"), F.to_json(F.struct(*values)).alias("record")).orderBy(F.desc("n_flags"), key).select(key, "record")
