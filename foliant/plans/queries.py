"""Queries of the core over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import identity
from foliant.functions.text import low64_sha256, row_text, squash, tokens, word_count
from foliant.operators import acquire, chunks, documents, embed, quality, sections, sheets, validate
from foliant.runtime import table
from foliant.sources import parsed, slices

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}
KEY = {"collection_path": "fname", "sort_order": "so"}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# sheets


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as worksheets, one an order; numbers are rendered as decimals."""
    money = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    l = table(spark, d, "lineitem")
    return l.select(
        F.concat(F.lit("orders.order_"), F.col("l_orderkey").cast("string")).alias("collection_path"),
        F.col("l_linenumber").cast("int").alias("line"),
        row_text([("Part", "l_partkey"), ("Supplier", "l_suppkey"), ("Quantity", money("l_quantity")), ("Price", money("l_extendedprice")), ("Flag", "l_returnflag")]).alias("row_text"),
    )


def _order_rows(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("collection_path").orderBy("line", "row_text"))
    return _orders(spark, d).select("collection_path", order.alias("sort_order"), "row_text", word_count("row_text").alias("word_count"))


@query
def sheet_row_text(spark, d):
    return _order_rows(spark, d)


@query
def sheet_catalog_hash(spark, d):
    return sheets.catalog(table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]))


@query
def order_catalog_hash(spark, d):
    return sheets.catalog(_order_rows(spark, d))


@query
def header_normalize(spark, d):
    lines = table(spark, d, "sheet_content").select(F.posexplode(F.split("row_text", "\n")).alias("pos", "line")).where(F.contains("line", F.lit(":")))
    return lines.select(F.regexp_extract("line", "^([^:]*):", 1).alias("header"), "pos").distinct().select("header", "pos", identity.column_name("header", "pos").alias("column_name"))


def _long(spark: SparkSession, d: str) -> DataFrame:
    return sheets.long_form(table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]), table(spark, d, "sheet"))


@query
def structured_long(spark, d):
    return _long(spark, d)


#: Columns that the given sheets have; the test compares them with those in the data.
STRUCTURED = ["col_amount", "col_category", "col_code", "col_code_value", "col_description", "col_effective", "col_flag", "col_hc_code", "col_item", "col_label", "col_rule_ref", "col_service"]


@query
def structured_wide(spark, d):
    return sheets.wide(_long(spark, d), STRUCTURED, ["structured_table", "collection_path", "sort_order"])


@query
def structured_wide_all(spark, d):
    return sheets.wide_all(_long(spark, d))


@query
def structured_columns(spark, d):
    return _long(spark, d).groupBy("structured_table", "column").agg(F.count("*").alias("n"), F.count("value").alias("n_filled"), F.count_distinct("collection_path").alias("n_sheets"))


@query
def overlap_guard(spark, d):
    return sheets.drift(_long(spark, d))


@query
def structured_append_drift(spark, d):
    c = table(spark, d, "customer").select(F.concat(F.lit("customer."), F.col("c_custkey")).alias("collection_path"), F.col("c_name").alias("col_name"), F.col("c_nationkey").cast("string").alias("col_nation"), F.col("c_mktsegment").alias("col_segment"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("supplier."), F.col("s_suppkey")).alias("collection_path"), F.col("s_name").alias("col_name"), F.col("s_nationkey").cast("string").alias("col_nation"), F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("col_balance"))
    return sheets.append([c, s])


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """Sheet rows as cells: row, column and value; a blank value is an empty cell."""
    lines = table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]).select("collection_path", "sort_order", F.posexplode(F.split("row_text", "\n")).alias("pos", "line"))
    value = F.trim(F.regexp_replace("line", r"^[^:]*:", ""))
    return lines.select(F.lit("book").alias("file"), F.col("collection_path").alias("sheet"), F.col("sort_order").alias("r"), (F.col("pos") + 1).alias("c"), F.when(value != "", value).alias("value"))


def _heads(spark: SparkSession, d: str) -> DataFrame:
    """The header row of each sheet: the labels of the lines of its first row; data rows of :func:`_cells` follow from row 2 on.

    Some sheets repeat their first header at the end, in others it only gives the same column name.
    """
    lines = table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]).where("sort_order = 1").select("collection_path", F.posexplode(F.split("row_text", "\n")).alias("pos", "line"))
    name = F.trim(F.regexp_extract("line", r"^([^:]*):", 1))
    kind = F.length("sheet") % 4
    own = lines.select(F.lit("book").alias("file"), F.col("collection_path").alias("sheet"), F.lit(1).alias("r"), (F.col("pos") + 1).alias("c"), F.when(name != "", name).alias("value"))
    last = own.groupBy("file", "sheet", "r").agg((F.max("c") + 1).alias("c"), F.max(F.when(F.col("c") == 1, F.col("value"))).alias("value")).where(kind < 2)
    return own.unionByName(last.withColumn("value", F.when(kind == 0, F.col("value")).otherwise(F.concat("value", F.lit("!")))))


@query
def merged_range_fill(spark, d):
    cells = _cells(spark, d)
    rows = cells.select("file", "sheet", "r").distinct().where("r % 10 = 1")
    ranges = rows.select("file", "sheet", F.lit(2).alias("min_col"), F.col("r").alias("min_row"), F.lit(2).alias("max_col"), (F.col("r") + 2).alias("max_row"))
    return sheets.fill_merged(cells, ranges).select("sheet", "r", "c", "value")


@query
def sheet_data_rows(spark, d):
    """Rows by the cells of their grid: sheets whose headers are in order, blank rows left out and rows numbered."""
    cells = _cells(spark, d).withColumn("r", F.col("r") + 1).unionByName(_heads(spark, d))
    span = sheets.bounds(cells)
    heads = sheets.headers(cells, span)
    good = heads.join(sheets.header_problems(heads).select("file", "sheet").distinct(), ["file", "sheet"], "left_anti")
    return sheets.text_rows(sheets.data_rows(cells, span, good), "sheet")


@query
def header_problems(spark, d):
    cells = _heads(spark, d)
    return sheets.header_problems(sheets.headers(cells, sheets.bounds(cells))).select("sheet", "problem", "header")


@query
def sheet_grid(spark, d):
    cells = _cells(spark, d)
    span = sheets.bounds(cells)
    return span.select("sheet", "first_col", "last_col", "first_row", "last_row")


# identity


@query
def collection_path_derive(spark, d):
    p = identity.sheet_path(F.concat(F.lit("in/"), F.coalesce("source", F.lit("none")), F.lit(".xlsx")), F.concat(F.coalesce("title", F.lit("")), F.lit(" #"), F.col("doc_id")), prefix="corpus")
    return table(spark, d, "documents").select("doc_id", p.alias("path"), identity.label("title").alias("label"), identity.folder_name("title", "source").alias("folder"))


@query
def path_validity(spark, d):
    return table(spark, d, "document").select("collection_path", identity.valid_path("collection_path").alias("path_ok"), identity.valid_path("title").alias("title_ok"), identity.valid_identifier(identity.label("title")).alias("label_ok"), identity.rooted("title").alias("rooted")).distinct()


@query
def duplicate_stems(spark, d):
    return _judged(spark, d).where("problem = 'repeated_stem'").groupBy("stem").agg(F.count("*").alias("n"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Documents as authored entries: the chapter in the title makes the file, and its path is the title's where that is one word."""
    name = F.concat(F.lit("data/"), F.lower(F.regexp_extract("title", r"(Chapter \d+)", 1)), F.lit(".v1.pdf"))
    return documents.judged(table(spark, d, "document").where("title is not null").select(name.alias("file"), "collection_path").distinct())


@query
def judged_documents(spark, d):
    path = F.when(F.length("title") % 3 == 0, F.col("collection_path")).when(F.length("title") % 3 == 1, identity.label("title")).otherwise(F.col("title"))
    own = table(spark, d, "document").where("title is not null").select(F.concat(F.lit("in/"), F.col("collection_path"), F.lit(".pdf")).alias("file"), path.alias("path")).distinct()
    return documents.judged(own, "file", "path").select("stem", "path", "problem")


# sections


def _elements(spark: SparkSession, d: str) -> DataFrame:
    return sections.elements_of(table(spark, d, "documents"))


@query
def sections_from_elements(spark, d):
    return sections.sections(_elements(spark, d))


@query
def document_rollup(spark, d):
    return sections.documents(sections.sections(_elements(spark, d)))


@query
def element_census(spark, d):
    return quality.census(_elements(spark, d))


@query
def page_classification(spark, d):
    return quality.page_classes(_elements(spark, d))


@query
def cleaned_records(spark, d):
    own = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), low64_sha256(F.coalesce("text", F.lit(""))).alias("binary_hash"))
    return sections.cleaned(sections.sections(_elements(spark, d)), own)


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """Worksheets as documents of every kind of element, by the number of the row: headings, tables (some blank, some with captions), pictures, page
    headers, list items, and in some documents elements without a rule."""
    r = table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]).withColumn("k", F.pmod("sort_order", F.lit(7)))
    first = F.get(F.split("row_text", "\n"), F.lit(0))
    cut = F.transform(F.split("row_text", "\n"), lambda x: F.array(F.regexp_extract(x, "^([^:]*)", 1), F.regexp_replace(x, r"^[^:]*:? ?", "")))
    odd = (F.length("collection_path") % 5 == 0) & (F.col("k") == 5)
    k = F.col("k")
    label = F.when(odd, "marginalia").when(k == 1, "section_header").when(k == 2, "table").when(k == 3, "picture").when(k == 4, "page_header").when(k == 5, "list_item").otherwise("paragraph")
    blank = F.col("sort_order") % 4 == 2
    return r.select(
        F.col("collection_path").alias("doc_id"), F.col("sort_order").alias("seq"), F.when(k == 2, "table").when(k == 3, "picture").otherwise("text").alias("elem_type"), label.alias("label"),
        F.when(~k.isin(2, 3), first).alias("text"), F.when(k.isin(2, 3) & (F.col("sort_order") % 5 < 2), first).alias("caption"),
        F.when((k == 2) & ~blank, cut).when(k == 2, F.array(F.array(F.lit(" "), F.lit(None).cast("string")))).alias("grid"),
        F.array((1 + F.floor(F.col("sort_order") / 2)).cast("int")).alias("pages"),
    )


@query
def mixed_sections(spark, d):
    return sections.sections(_mixed(spark, d))


@query
def mixed_failures(spark, d):
    return sections.section_failures(_mixed(spark, d))


@query
def mixed_census(spark, d):
    return quality.census(_mixed(spark, d))


@query
def mixed_pages(spark, d):
    return quality.page_classes(_mixed(spark, d))


@query
def table_coverage(spark, d):
    """Tokens of the tables that sections without their tables' lines lack."""
    kept = sections.sections(_mixed(spark, d)).select("doc_id", quality.without_tables("content_text").alias("content_text"))
    return quality.table_gap(_mixed(spark, d), kept).select("doc_id", "table_no", F.size("missing").alias("n_missing"), F.slice("missing", 1, 5).alias("sample"))


@query
def cleaned_failures(spark, d):
    """Cleaned records as files, every seventh of them broken in one of six ways, read back and checked."""
    r = cleaned_records(spark, d).withColumn("k", F.when(F.col("doc_id").cast("bigint") % 7 == 0, F.pmod(F.col("doc_id").cast("bigint") / 7, F.lit(6)).cast("int")))
    first = lambda a, b: F.regexp_replace("record", a, b)
    broken = (
        F.when(F.col("k") == 0, F.substring("record", 1, 20)).when(F.col("k") == 1, first(r'^\{"document":\{', '{"document":{"more":1,')).when(F.col("k") == 2, first(r'"n_parsed_sections":(\d+)', '"n_parsed_sections":9$1'))
        .when(F.col("k") == 3, first(r'"n_parsed_sections":\d+', '"n_parsed_sections":true')).when(F.col("k") == 4, first(r'"binary_hash":\d+', '"binary_hash":18446744073709551616')).when(F.col("k") == 5, first(r'"sections":\[.*', '"sections":[]}'))
        .otherwise(F.col("record"))
    )
    files = r.select(F.concat(F.lit("in/"), F.col("doc_id"), F.lit(".json")).alias("path"), broken.cast("binary").alias("content"))
    return parsed.cleaned_failures(parsed.cleaned_records(files))


@query
def stream_ingest(spark, d):
    """Two ``availableNow`` runs over the same rows of embeddings, the second of which adds nothing; then what is stored."""
    from foliant.runtime import scratch
    from foliant.streaming.incremental import ingest

    folder, rows = scratch(spark, "stream"), table(spark, d, "embedding_table").select("fname", "so", "chunk_number", "chunk_id", "word_count")
    keys = {"fname": "fname", "so": "so", "chunk_number": "chunk_number"}
    for _ in range(2):
        rows.write.mode("append").parquet(f"{folder}/in")
        ingest(spark, f"{folder}/in", rows.schema, f"{folder}/out", f"{folder}/checkpoint", keys, lambda df: df).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out").groupBy("fname").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"))


# chunks and embeddings


def _content(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "document_content").dropDuplicates(["collection_path", "sort_order"])


@query
def chunks_passthrough_split(spark, d):
    return chunks.additive(table(spark, d, "documents"), "text", 64, 10).select("doc_id", "chunk_number", "chunk_text", "word_count")


@query
def chunks_with_header_budget(spark, d):
    cut = chunks.with_header(_content(spark, d), "heading_text", "content_text", 200, 30)
    return cut.select("section_id", "chunk_number", "chunk_text", "word_count")


@query
def source_filtered(spark, d):
    c = _content(spark, d)
    keep = embed.source_filter(c, {"collection_path": ["careman.man_0000%", "statcode.%"], "heading_text": "%claim%"}) & embed.has_text(["heading_text", "content_text"])
    return c.where(keep).select("collection_path", "sort_order")


@query
def resume_anti_join(spark, d):
    return embed.resume(_content(spark, d), table(spark, d, "embedding_table"), KEY).select("collection_path", "sort_order")


@query
def incremental_family(spark, d):
    """Documents loaded in three runs into stored tables: half of them, all of them skipping what is there, and a few replaced; then what is stored."""
    from foliant.operators import store
    from foliant.runtime import scratch

    folder = scratch(spark, "family")
    parents = table(spark, d, "document").where("collection_path is not null").groupBy("collection_path").agg(F.max("title").alias("title"))
    rows = _content(spark, d).select("collection_path", "sort_order", "word_count")
    half = F.length("collection_path") % 2 == 0
    store.load_family(parents.where(half), {"content": rows}, folder, "document", buckets=16)
    store.load_family(parents.withColumn("title", F.lit("second")), {"content": rows}, folder, "document")
    some = F.length("collection_path") % 5 == 0
    store.load_family(parents.where(some).withColumn("title", F.lit("third")), {"content": rows.where("sort_order = 1")}, folder, "document", overwrite=True)
    n = store.read(spark, f"{folder}/content").groupBy("collection_path").agg(F.count("*").alias("n_rows"), F.sum("word_count").alias("words"))
    return store.read(spark, f"{folder}/document").join(n, "collection_path", "left")


@query
def scoped_overwrite_survivors(spark, d):
    c = _content(spark, d)
    return embed.surviving(table(spark, d, "embedding_table").dropDuplicates(["chunk_id"]), c.where(embed.source_filter(c, {"collection_path": "careman.%"})), KEY).select("fname", "so", "chunk_number")


@query
def embedding_checks(spark, d):
    return embed.vector_checks(table(spark, d, "embedding_table").dropDuplicates(["chunk_id"]), "embedding", 64)


@query
def embedding_failures(spark, d):
    return validate.embeddings(_content(spark, d), table(spark, d, "embedding_table").dropDuplicates(["chunk_id"]), KEY, 64, 512, 400)


@query
def token_gate(spark, d):
    return embed.token_gate(table(spark, d, "embedding_table").dropDuplicates(["chunk_id"]), "chunk_text", "word_count", 512, 402)


@query
def cosine_topk(spark, d):
    e = table(spark, d, "embeddings")
    return embed.top_k(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding", 64, 5)


@query
def hashed_embedding(spark, d):
    rows = table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]).select("collection_path", "sort_order", F.col("row_text").alias("chunk_text"))
    return embed.encode(rows).drop("chunk_text")


@query
def term_index(spark, d):
    t = table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"])
    return t.select(F.explode(embed.terms("row_text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_rows"))


# validation


@query
def cascade_orphans(spark, d):
    part = table(spark, d, "document").where("n_parsed_sections > 2")
    return validate.orphans(_content(spark, d), part, {"collection_path": "collection_path"}).groupBy("collection_path").agg(F.count("*").alias("n"))


@query
def count_reconcile(spark, d):
    one = table(spark, d, "document").select("collection_path", "n_parsed_sections").distinct()
    return validate.counts_differ(one, _content(spark, d), "collection_path", "n_parsed_sections")


@query
def sheet_count_reconcile(spark, d):
    one = table(spark, d, "sheet").select("collection_path", "n_rows").distinct()
    return validate.counts_differ(one, table(spark, d, "sheet_content").dropDuplicates(["collection_path", "sort_order"]), "collection_path", "n_rows")


@query
def zero_children(spark, d):
    return validate.childless(table(spark, d, "document").select("collection_path").distinct(), _content(spark, d), {"collection_path": "collection_path"})


@query
def order_contiguity(spark, d):
    return validate.gaps(table(spark, d, "document_content"), "collection_path", "sort_order")


@query
def conditional_violations(spark, d):
    return validate.both([validate.constraint_counts(table(spark, d, t), t).withColumn("table_name", F.lit(t)) for t in ("document", "document_content", "sheet", "sheet_content", "embedding_table")])


@query
def constraint_rows(spark, d):
    return validate.constraint_failures(table(spark, d, "document_content"), "document_content").distinct()


@query
def expected_presence(spark, d):
    want = table(spark, d, "embedding_table").select(F.col("fname").alias("collection_path")).unionByName(table(spark, d, "sheet").select("collection_path"))
    return validate.missing(want, table(spark, d, "document"), "collection_path")


@query
def repeated_keys(spark, d):
    return validate.repeated_keys(table(spark, d, "document"), ["collection_path"])


@query
def word_count_check(spark, d):
    return validate.wrong_words(table(spark, d, "sheet_content"), ["row_text"]).select("collection_path", "sort_order", "word_count", "real_words").distinct()


@query
def document_failures(spark, d):
    f = validate.loaded_documents(table(spark, d, "document"), table(spark, d, "document_content"))
    return f.groupBy("check").agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"))


@query
def sheet_failures(spark, d):
    f = validate.loaded_sheets(table(spark, d, "sheet"), table(spark, d, "sheet_content"))
    return f.groupBy("check").agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"))


# quality


@query
def token_coverage_gap(spark, d):
    pieces = table(spark, d, "embedding_table").select(F.col("fname").alias("collection_path"), F.col("so").alias("sort_order"), "chunk_text")
    return quality.coverage_gap(_content(spark, d).where("content_text is not null"), pieces, ["collection_path", "sort_order"], "content_text", "chunk_text").where("n_missing > 0")


@query
def token_profile(spark, d):
    t = table(spark, d, "documents").select("doc_id", tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.array_min("t").alias("first_token"), F.array_max("t").alias("last_token"))


@query
def text_health(spark, d):
    return quality.text_health(table(spark, d, "document_content").dropDuplicates(["section_id"])).where("flagged").select("section_id", "bad_chars", "single_ratio", "broken", "severity")


@query
def markdown_table_strip(spark, d):
    t = table(spark, d, "document_content").where("content_text is not null").dropDuplicates(["section_id"])
    return t.select("section_id", quality.without_tables("content_text").alias("text")).select("section_id", F.length("text").alias("n_chars"), word_count("text").alias("n_words"), F.length(squash("text")).alias("n_squashed"))


@query
def page_coverage(spark, d):
    return quality.page_coverage(_content(spark, d), "collection_path")


@query
def fragmentation_flags(spark, d):
    return quality.fragmentation_flags(quality.fragmentation(_content(spark, d), "collection_path")).select("collection_path", "section_count", "total_pages", "sections_per_page", "median_words", F.array_join("reasons", ",").alias("reasons"))


@query
def coverage_fence(spark, d):
    return quality.coverage_fence(quality.page_coverage(_content(spark, d), "collection_path"))


@query
def flag_ranking(spark, d):
    c = _content(spark, d)
    parts = {
        "count": count_reconcile(spark, d),
        "fragmentation": quality.fragmentation_flags(quality.fragmentation(c, "collection_path")),
        "health": quality.text_health(c).where("flagged"),
        "order": order_contiguity(spark, d),
    }
    return quality.ranked_flags(parts, "collection_path")


@query
def section_number_gaps(spark, d):
    return quality.number_gaps(_content(spark, d), "collection_path")


@query
def quality_records(spark, d):
    return quality.summary(_content(spark, d), "collection_path")


# sources and acquisition


@query
def page_slices(spark, d):
    n = _content(spark, d).groupBy("collection_path").agg(F.max("page_end").alias("pages"))
    return slices.page_slices(n, "collection_path", "pages", 25)


@query
def templated_targets(spark, d):
    return acquire.templated_targets(table(spark, d, "document").select(F.col("collection_path").alias("path")).distinct(), "path", "https://example.org/{path}.pdf", "raw/{path}.pdf", "g_{path}")


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of two runs over the corpus: every text was fetched, later runs failed for some."""
    t = table(spark, d, "documents")
    url, path = F.concat(F.lit("https://example.org/"), F.col("doc_id")), F.concat(F.lit("raw/"), F.col("doc_id"), F.lit(".txt"))
    arts = F.when(F.col("n_chars") > 0, F.array(F.struct(path.alias("path"), F.col("n_chars").alias("size")))).otherwise(F.expr("cast(array() as array<struct<path:string,size:bigint>>)"))
    first = t.select(url.alias("url"), (F.col("doc_id") * 2).alias("pos"), F.lit("fetched").alias("status"), arts.alias("artifacts"))
    later = t.where("doc_id % 7 = 0").select(url.alias("url"), (F.col("doc_id") * 2 + 1).alias("pos"), F.lit("failed").alias("status"), arts.alias("artifacts"))
    return first.unionByName(later)


def _files(spark: SparkSession, d: str) -> DataFrame:
    """What lies on disk: texts whose stated length is wrong have another size, those of one language are gone."""
    return table(spark, d, "documents").where("coalesce(lang, '') <> 'es'").select(F.concat(F.lit("raw/"), F.col("doc_id"), F.lit(".txt")).alias("path"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("size"))


@query
def manifest_skip(spark, d):
    t = table(spark, d, "documents").select(F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("url"), F.concat(F.lit("raw/"), F.col("doc_id"), F.lit(".txt")).alias("destination"))
    return acquire.decisions(t, _entries(spark, d), _files(spark, d))


@query
def manifest_validation(spark, d):
    return acquire.manifest_failures(_entries(spark, d), _files(spark, d))
