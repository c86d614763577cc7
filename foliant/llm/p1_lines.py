"""Lines repeated across the documents of one source.

Lines are masked (digits, dates), clustered within their source by locality-sensitive hashing of the masked
words, and clusters with a high document frequency give the candidates; an exact count of each normalised line
among the candidates follows. The cluster is a function of the normalised line, so equal lines never part and
the candidate step loses none of them. Lines are equal whatever their case, so this cluster can't mask names.

A second clustering does: of the line as it is written, with names, dates and numbers masked. The most frequent form of a
cluster stands for it, lines that share at least ``SIMILAR`` percent of their words with it belong to it, and a cluster that then
returns in as many documents as a repeated line must is taken out as well: a byline goes whoever wrote it. ``near=False`` leaves that out.

Sizes: one pass over the texts, which leaves a narrow table of line hashes; counts pre-aggregate (source, cluster,
document) before their shuffle, so that a source or a line that holds a third of everything is combined on the map side.
Only lines of frequent clusters go on to the exact count.

Defined cases: null, empty and blank texts have no lines that count; rows sent twice count once; a path without a
second label is its own source; rows with a null path or section are left out; a line whose masked form has fewer than 20 letters
left is in no near cluster; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import WS_RUN
from foliant.llm.common import source_of
from foliant.runtime import materialize

MIN_DOCUMENTS = 6
MIN_SHARE_PERCENT = 5
MIN_LETTERS = 20
#: Word hashes in the sketch of a line: lines that share nearly all their words share it.
SKETCH = 4
#: Words, in percent of those of both, that a line shares with the form that stands for its cluster.
SIMILAR = 80
#: Capitalised words that follow a word in small letters, a digit or a comma.
NAMES = r"([\p{Ll}\p{Nd},;] )\p{Lu}\p{Ll}\p{L}*(?: \p{Lu}\p{Ll}\p{L}*)*"
#: English month names, as far as they mark a date.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"


def cluster(key: str | Column) -> Column:
    """Locality-sensitive hash of a normalised line: the smallest word hashes (a bottom-k sketch) with dates and numbers masked."""
    c = F.col(key) if isinstance(key, str) else key
    hashes = F.transform(F.split(_dates_and_numbers(c), " "), lambda t: F.xxhash64(t))
    return F.xxhash64(F.slice(F.array_sort(hashes), 1, SKETCH))


def _dates_and_numbers(c: Column) -> Column:
    """A run of dates, numbers and their marks becomes one 0; digits are masked before."""
    return F.regexp_replace(c, rf"(?:\b(?:{MONTHS}) 0,? 0\b|\b0[-/]0[-/]0\b|[0.,$])+", "0")


def near_form(plain: str | Column) -> Column:
    """A line with single spaces, its names, dates and numbers masked; names are found by their capitals."""
    c = F.col(plain) if isinstance(plain, str) else plain
    return _dates_and_numbers(F.regexp_replace(F.lower(F.regexp_replace(c, NAMES, "$1#")), r"\p{Nd}+", "0"))


def near_cluster(form: str | Column) -> Column:
    """Locality-sensitive hash of a masked line: its smallest word digests."""
    c = F.col(form) if isinstance(form, str) else form
    return F.slice(F.array_sort(F.transform(F.array_distinct(F.split(c, " ")), lambda t: F.md5(t))), 1, SKETCH)


def _letters(c: str | Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]+", ""))


def section_lines(content: DataFrame) -> DataFrame:
    """Lines that can count. Lines are the same by their ``key``: trimmed, single spaces, lower case, one mark for each run of digits. Columns: ``source, doc, section_id, line_no, plain, key, line_key, cluster`` (hashes but for the line with single spaces and its key)."""
    lines = (
        content.where("content_text is not null and collection_path is not null and section_id is not null")
        .select(source_of("collection_path").alias("source"), F.xxhash64("collection_path").alias("doc"), "section_id", F.posexplode(F.split("content_text", "\n")).alias("pos", "line"))
        .where(F.length("line") >= MIN_LETTERS)
        .select("source", "doc", "section_id", (F.col("pos") + 1).alias("line_no"), F.trim(F.regexp_replace("line", WS_RUN, " ")).alias("plain"))
        .withColumn("key", F.regexp_replace(F.lower("plain"), r"\p{Nd}+", "0"))
        .where(_letters("key") >= MIN_LETTERS)
    )
    return lines.withColumn("line_key", F.xxhash64("source", "key")).withColumn("cluster", F.xxhash64("source", cluster("key")))


def source_sizes(content: DataFrame) -> DataFrame:
    """Documents with sections of each source."""
    return content.where("collection_path is not null and section_id is not null").select(source_of("collection_path").alias("source"), "collection_path").distinct().groupBy("source").agg(F.count("*").alias("n_docs"))


def _frequent(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    return counts.join(sizes, "source").where((F.col("docs") >= MIN_DOCUMENTS) & (F.col("docs") * 100 >= F.col("n_docs") * MIN_SHARE_PERCENT))


def frequent_clusters(lines: DataFrame, sizes: DataFrame, column: str = "cluster") -> DataFrame:
    """Clusters found in many documents of their source: ``source, cluster, docs, n_docs``."""
    per_doc = lines.select("source", column, "doc").distinct()
    return _frequent(per_doc.groupBy("source", column).agg(F.count("*").alias("docs")), sizes)


def repeated(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """``section_id, line_no`` of the lines that return exactly, looked for in frequent clusters only."""
    kept = materialize(frequent_clusters(lines, sizes).select("cluster"), "p1-clusters")
    found = lines.join(kept, "cluster", "left_semi")
    counts = found.select("source", "line_key", "doc").distinct().groupBy("source", "line_key").agg(F.count("*").alias("docs"))
    keys = materialize(_frequent(counts, sizes).select("line_key"), "p1-keys")
    return found.join(keys, "line_key", "left_semi").select("section_id", "line_no").distinct().select("section_id", F.col("line_no").cast("int").alias("line_no"))


def near_lines(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Lines of near-duplicate clusters that return in many documents: ``source, near, standing, form, doc, section_id, line_no``."""
    kept = materialize(frequent_clusters(lines.where("near is not null"), sizes, "near").select("near"), "p1-near")
    inside = lines.join(kept, "near", "left_semi").select("source", "near", "form", "doc", "section_id", "line_no")
    forms = inside.select("source", "near", "form", "doc").distinct().groupBy("source", "near", "form").agg(F.count("*").alias("docs"))
    heads = forms.groupBy("source", "near").agg(F.min(F.struct((-F.col("docs")).alias("d"), "form"))["form"].alias("standing"))
    own, head = F.array_distinct(F.split("form", " ")), F.array_distinct(F.split("standing", " "))
    both = F.size(F.array_intersect(own, head))
    # forms are compared, not lines: there are fewer of them
    alike = forms.join(heads, ["source", "near"]).where(both * 100 >= SIMILAR * (F.size(own) + F.size(head) - both)).select("source", "near", "form", "standing")
    members = materialize(inside.join(alike, ["source", "near", "form"]), "p1-members")
    often = _frequent(members.select("source", "near", "doc").distinct().groupBy("source", "near").agg(F.count("*").alias("docs")), sizes).select("source", "near")
    return members.join(often, ["source", "near"], "left_semi")


def _written(content: DataFrame, near: bool) -> DataFrame:
    """The lines' hashes, written and read several times: texts are taken apart once."""
    lines, own = section_lines(content), ["source", "doc", "section_id", "line_no", "line_key", "cluster"]
    if near:
        lines = lines.withColumn("form", near_form("plain")).withColumn("near", F.when(_letters("form") >= MIN_LETTERS, F.xxhash64("source", near_cluster("form"))))
        own += ["form", "near"]
    return materialize(lines.select(*own), "p1-lines")


def repeated_lines(content: DataFrame) -> DataFrame:
    """``section_id, line_no`` of each line repeated excessively within its source."""
    return repeated(_written(content, False), source_sizes(content))


def clean(content: DataFrame, near: bool = True) -> DataFrame:
    """Every section's text without those lines and, with ``near``, without the lines of near-duplicate clusters: ``section_id, content_text, n_removed``; null stays null."""
    lines, sizes = _written(content, near), source_sizes(content)
    bad = repeated(lines, sizes)
    if near:
        bad = bad.unionByName(near_lines(lines, sizes).select("section_id", F.col("line_no").cast("int").alias("line_no")))
    gone = bad.groupBy("section_id").agg(F.collect_set("line_no").alias("gone"))
    one = content.where("section_id is not null").select("section_id", "content_text").dropDuplicates(["section_id"])
    kept = F.filter(F.split("content_text", "\n"), lambda _, i: ~F.array_contains("gone", i + 1))
    return one.join(gone, "section_id", "left").select(
        "section_id",
        F.when(F.col("gone").isNull(), F.col("content_text")).otherwise(F.array_join(kept, "\n")).alias("content_text"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
    )


def clusters_report(content: DataFrame) -> DataFrame:
    """One row per near-duplicate cluster that is taken out: ``source, form`` (the one that stands for it)``, docs, lines, forms``."""
    found = near_lines(_written(content, True), source_sizes(content))
    lines = found.select("source", "near", "standing", "form", "doc", "section_id", "line_no").distinct()
    stats = lines.groupBy("source", "near", "standing").agg(F.count("*").alias("lines"), F.count_distinct("form").alias("forms"), F.count_distinct("doc").alias("docs"))
    return stats.select("source", F.col("standing").alias("form"), "docs", "lines", "forms")
