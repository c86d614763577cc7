"""SQL counterparts of the core queries, for DuckDB over the same tables."""

from __future__ import annotations

from foliant.functions.text import WS

_RUN = f"[{WS}]+"
#: Columns of the given sheets' structured tables.
STRUCTURED = ["col_amount", "col_category", "col_code", "col_code_value", "col_description", "col_effective", "col_flag", "col_hc_code", "col_item", "col_label", "col_rule_ref", "col_service"]


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({c}, ''), '{_RUN}'), lambda x: x <> '')"


def n_words(c: str) -> str:
    return f"len({words(c)})"


def label(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def low64(c: str) -> str:
    return f"cast(cast('0x' || right(sha256({c}), 16) as ubigint) as decimal(20,0))"


def column_name(header: str, pos: str) -> str:
    return f"regexp_replace(substring('col_' || case when {label(header)} = '' then 'col_' || {pos} else {label(header)} end, 1, 63), '_+$', '')"


def tokens(c: str) -> str:
    return rf"list_distinct(list_transform(regexp_extract_all(lower(coalesce({c}, '')), '\p{{Nd}}+\.\p{{Nd}}+|[\p{{L}}\p{{N}}_]+'), lambda x: case when regexp_full_match(x, '\p{{Nd}}+\.\p{{Nd}}+') then regexp_replace(x, '\.?0*$', '') else x end))"


CONTENT = "c as (select distinct on (collection_path, sort_order) * from document_content)"
ROWS = "r as (select distinct on (collection_path, sort_order) * from sheet_content)"
LINES = f"{ROWS}, li as (select collection_path, sort_order, unnest(string_split(row_text, chr(10))) as line, unnest(range(len(string_split(row_text, chr(10))))) as pos from r)"
LONG = f"""{LINES}, tg as (select distinct collection_path, structured_table from sheet where structured_table is not null),
lf as (select structured_table, collection_path, sort_order, {column_name("regexp_extract(line, '^([^:]*):', 1)", "pos")} as "column", nullif(trim(regexp_replace(line, '^[^:]*:', '')), '') as value from li join tg using (collection_path) where contains(line, ':'))"""
CELLS = f"{LINES}, ce as (select collection_path as sheet, sort_order as r, pos + 1 as c, nullif(trim(regexp_replace(line, '^[^:]*:', '')), '') as value from li)"
ORDERS = f"""o as (select 'orders.order_' || l_orderkey as collection_path, l_linenumber as line,
 'Part: ' || l_partkey || chr(10) || 'Supplier: ' || l_suppkey || chr(10) || 'Quantity: ' || cast(l_quantity as decimal(18,2)) || chr(10) || 'Price: ' || cast(l_extendedprice as decimal(18,2)) || chr(10) || 'Flag: ' || l_returnflag as row_text from lineitem),
orows as (select collection_path, row_number() over (partition by collection_path order by line, row_text) as sort_order, row_text, {n_words('row_text')} as word_count from o)"""
ELEMENTS = f"""el0 as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as text, unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) as seq from documents),
el as (select cast(doc_id as varchar) as doc_id, seq, text, regexp_replace(text, '^{_RUN}|{_RUN}$', '', 'g') as body, case when {n_words('text')} between 1 and 6 then 'section_header' else 'text' end as label, 1 + seq // 5 as page from el0)"""
SECTIONS = f"""{ELEMENTS},
kept as (select *, sum(case when label = 'section_header' then 1 else 0 end) over (partition by doc_id order by seq) as part from el where body <> ''),
se0 as (select doc_id, part, max(case when label = 'section_header' then body end) as heading_text, string_agg(body, chr(10) || chr(10) order by seq) filter (where label <> 'section_header') as content_text, min(page) as page_start, max(page) as page_end from kept group by doc_id, part),
se as (select doc_id, row_number() over (partition by doc_id order by part) as sort_order, heading_text, content_text, {n_words('heading_text')} + {n_words('content_text')} as word_count, page_start, page_end from se0)"""
ENTRIES = """ent as (
 select 'https://example.org/' || doc_id as url, doc_id * 2 as pos, 'fetched' as status, case when n_chars > 0 then 'raw/' || doc_id || '.txt' end as path, case when n_chars > 0 then n_chars end as want from documents
 union all select 'https://example.org/' || doc_id, doc_id * 2 + 1, 'failed', case when n_chars > 0 then 'raw/' || doc_id || '.txt' end, case when n_chars > 0 then n_chars end from documents where doc_id % 7 = 0),
fi as (select 'raw/' || doc_id || '.txt' as path, coalesce(length(text), 0) as size from documents where coalesce(lang, '') <> 'es')"""
PAGES = f"""{CONTENT}, pc as (
 with tot as (select collection_path, greatest(max(page_end), max(page_start)) as total_pages from c group by 1),
 cov as (select collection_path, count(distinct p) as n from (select collection_path, unnest(range(page_start, page_end + 1)) as p from c where page_start is not null and page_end is not null and page_start <= page_end) group by 1)
 select tot.collection_path, total_pages, coalesce(n, 0) as covered_pages, case when total_pages > 0 then round_even(coalesce(n, 0) / total_pages, 4) end as coverage from tot left join cov using (collection_path))"""
FRAGMENTS = f"""{CONTENT}, fm as (select *, round_even(section_count / (case when total_pages > 0 then total_pages else 1 end), 4) as sections_per_page from (
 select collection_path, count(*) as section_count, coalesce(greatest(max(page_end), max(page_start)), 0) as total_pages, quantile_cont({n_words('content_text')} + {n_words('heading_text')}, 0.5) as median_words from c group by 1)),
fp as (select quantile_cont(sections_per_page, 0.25) as a, quantile_cont(sections_per_page, 0.75) as b from fm where total_pages > 0),
fw as (select quantile_cont(median_words, 0.25) as a, quantile_cont(median_words, 0.75) as b from fm),
ff as (select fm.*, concat_ws(',', case when total_pages > 0 and sections_per_page > fp.b + 1.5 * (fp.b - fp.a) then 'many_sections' end, case when total_pages > 0 and sections_per_page < fp.a - 1.5 * (fp.b - fp.a) then 'few_sections' end,
 case when median_words > fw.b + 1.5 * (fw.b - fw.a) then 'long_sections' end, case when median_words < fw.a - 1.5 * (fw.b - fw.a) then 'short_sections' end) as reasons from fm, fp, fw)"""
HEALTH = f"""hw as (select *, {words('content_text')} as w, length(coalesce(content_text, '')) - length(regexp_replace(coalesce(content_text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f\\x{{fffd}}]', '', 'g')) as bad_chars from hs),
h as (select *, coalesce(round_even(len(list_filter(w, lambda x: regexp_full_match(x, '\\p{{L}}'))) / nullif(len(w), 0), 4), 0.0) as single_ratio,
 len(list_filter(range(1, len(w)), lambda i: w[i][-1] = '-' and regexp_matches(w[i + 1], '^\\p{{Ll}}'))) as broken from hw),
hf as (select *, bad_chars * 100 + single_ratio * 10 + broken as severity from h where bad_chars > 0 or single_ratio > 0.15 or broken > 10)"""


_PATH = "regexp_full_match(collection_path, '[a-z0-9_]+(\\.[a-z0-9_]+)*')"
#: The constraints once more, written for SQL on their own.
BROKEN = {
    "document": {
        "key_missing": "collection_path is null", "path_invalid": f"collection_path is not null and not {_PATH}", "title_blank": "length(replace(coalesce(title, ''), ' ', '')) = 0",
        "sections_below_one": "n_parsed_sections <= 0", "hash_range": "not (source_binary_hash between 0 and 18446744073709551615)",
    },
    "document_content": {
        "key_missing": "collection_path is null or sort_order is null", "order_below_one": "sort_order <= 0", "words_below_zero": "sign(word_count) = -1", "page_below_one": "least(page_start, page_end) <= 0",
        "nothing_in_it": "length(replace(coalesce(heading_text, '') || coalesce(content_text, ''), ' ', '')) = 0", "page_order": "page_end < page_start",
    },
    "sheet": {"key_missing": "collection_path is null", "title_blank": "length(replace(coalesce(title, ''), ' ', '')) = 0", "rows_below_one": "n_rows <= 0", "hash_range": "not (source_binary_hash between 0 and 18446744073709551615)"},
    "sheet_content": {"key_missing": "collection_path is null or sort_order is null", "order_below_one": "sort_order <= 0", "text_empty": "row_text is null or length(row_text) = 0", "words_below_zero": "sign(word_count) = -1"},
    "embedding_table": {"key_missing": "fname is null or so is null or chunk_number is null", "number_below_one": "chunk_number <= 0", "words_below_zero": "sign(word_count) = -1"},
}


def _counts() -> str:
    return " union all ".join(f"select '{t}' as table_name, '{n}' as \"check\", count(*) filter (where {c}) as n from {t}" for t, cs in BROKEN.items() for n, c in cs.items())


def _rows(table: str, key: str, union: str = "union") -> str:
    return f" {union} ".join(f"select '{n}' as \"check\", concat_ws('/', {key}) as key, '{table}' as detail from {table} where {c}" for n, c in BROKEN[table].items())


def _family(parent: str, child: str, stated: str, none: str, repeated: str, real: str) -> str:
    """Failures of parents and children by check."""
    k = f"(select collection_path, count(*) as n, min(sort_order) as lo, max(sort_order) as hi, count(distinct sort_order) as nd from {child} group by 1)"
    return f"""with f as ({_rows(parent, 'collection_path', 'union all')} union all {_rows(child, 'collection_path, sort_order', 'union all')}
union all select 'hash_missing', collection_path, '' from {parent} where source_binary_hash is null
union all {repeated}
union all select 'count', p.collection_path, '' from {parent} p left join {k} k on k.collection_path = p.collection_path where p.{stated} <> coalesce(k.n, 0)
union all select '{none}', p.collection_path, '' from {parent} p where not exists (select 1 from {child} c where c.collection_path = p.collection_path)
union all select 'orphan', concat_ws('/', c.collection_path, c.sort_order), '' from {child} c where not exists (select 1 from {parent} p where p.collection_path = c.collection_path)
union all select 'order', collection_path, '' from {k} where lo <> 1 or hi <> n or nd <> n
union all select 'word_count', concat_ws('/', collection_path, sort_order), '' from {child} where word_count <> {real})
select "check", count(*) as n, count(distinct key) as n_keys from f group by 1"""


MIXED = f"""{ROWS}, mx0 as (select *, sort_order % 7 as k, string_split(row_text, chr(10)) as ls from r),
mx as (select collection_path as doc_id, sort_order as seq, k, case k when 2 then 'table' when 3 then 'picture' else 'text' end as elem_type,
  case when length(collection_path) % 5 = 0 and k = 5 then 'marginalia' else ['paragraph', 'section_header', 'table', 'picture', 'page_header', 'list_item', 'paragraph'][k + 1] end as label,
  case when k not in (2, 3) then ls[1] end as text, case when k in (2, 3) and sort_order % 5 < 2 then ls[1] end as caption,
  case when k = 2 and sort_order % 4 <> 2 then list_transform(ls, lambda x: [regexp_extract(x, '^([^:]*)', 1), regexp_replace(x, '^[^:]*:? ?', '')]) end as grid, 1 + sort_order // 2 as page from mx0),
mb as (select *, regexp_replace(coalesce(caption, ''), '^{_RUN}|{_RUN}$', '', 'g') as cap, regexp_replace(coalesce(text, ''), '^{_RUN}|{_RUN}$', '', 'g') as body,
  coalesce(len(list_filter(flatten(grid), lambda x: trim(x) <> '')), 0) > 0 as filled,
  array_to_string(list_concat(['| ' || array_to_string(grid[1], ' | ') || ' |', '|' || repeat(' --- |', len(grid[1]))], list_transform(grid[2:], lambda x: '| ' || array_to_string(x, ' | ') || ' |')), chr(10)) as md from mx),
ml as (select *, case when label = 'page_header' then null when k = 2 then case when filled then case when cap <> '' then cap || chr(10) || chr(10) || md else md end else nullif(cap, '') end when k = 3 then nullif(cap, '') else nullif(body, '') end as block from mb),
mr as (select *, case when block is null then null when k in (2, 3) then 'block' when label = 'section_header' then 'heading' when label = 'marginalia' then 'unknown' else 'block' end as role from ml)"""
MIXED_SECTIONS = f"""{MIXED}, mk as (select *, sum(case when role = 'heading' then 1 else 0 end) over (partition by doc_id order by seq) as part from mr where role is not null and doc_id not in (select doc_id from mr where role = 'unknown')),
ms0 as (select doc_id, part, max(case when role = 'heading' then block end) as heading_text, string_agg(block, chr(10) || chr(10) order by seq) filter (where role <> 'heading') as content_text, min(page) as page_start, max(page) as page_end from mk group by doc_id, part),
ms as (select doc_id, row_number() over (partition by doc_id order by part) as sort_order, heading_text, content_text, {n_words('heading_text')} + {n_words('content_text')} as word_count, page_start, page_end from ms0)"""
_KEPT = "array_to_string(list_filter(string_split(content_text, chr(10)), lambda x: not (starts_with(ltrim(x), '|') or (regexp_full_match(x, '[\\s|:-]+') and trim(x) <> ''))), chr(10))"
_HEADS = f"""{LINES}, hd0 as (select collection_path as sheet, pos + 1 as c, nullif(trim(regexp_extract(line, '^([^:]*):', 1)), '') as header from li where sort_order = 1),
hd1 as (select * from hd0 union all select sheet, max(c) + 1, max(header) filter (where c = 1) || case when length(sheet) % 4 = 0 then '' else '!' end from hd0 where length(sheet) % 4 < 2 group by sheet),
hd as (select *, {column_name("header", 'c - 1')} as col from hd1),
hs as (select sheet, max(c) as last_col from (select sheet, c, c - row_number() over (partition by sheet order by c) as g from hd where header is not null) where g = 0 group by 1),
hh as (select hd.* from hd join hs on hd.sheet = hs.sheet and c <= last_col),
hp as (select sheet, 'duplicate' as problem, header from hh group by sheet, header having count(*) > 1 union all select sheet, 'duplicate_name', min(header) from hh group by sheet, col having count(distinct header) > 1)"""


def _pieces(n: str, cap: str, stride: str, budget: str) -> str:
    return f"case when {n} + 2 <= {budget} then 1 when {n} = 0 then 0 when {n} <= {cap} then 1 else 1 + cast(ceil(({n} - {cap}) / {stride}) as bigint) end"


def oracle_sql() -> dict[str, str]:
    # the given sheets have just these columns, so the collected ones are the same
    wide = f"with {LONG} select structured_table, collection_path, sort_order, " + ", ".join(f"max(value) filter (where \"column\" = '{c}') as {c}" for c in STRUCTURED) + " from lf group by all"
    gaps = "select collection_path, count(*) as n, min(sort_order) as lowest, max(sort_order) as highest, count(distinct sort_order) as n_distinct from document_content group by 1 having min(sort_order) <> 1 or max(sort_order) <> count(*) or count(distinct sort_order) <> count(*)"
    count_diff = "select d.collection_path, d.n_parsed_sections as stated, coalesce(n, 0) as found from (select distinct collection_path, n_parsed_sections from document) d left join (select collection_path, count(*) as n from c group by 1) k using (collection_path) where d.n_parsed_sections <> coalesce(n, 0)"
    return {
        "sheet_row_text": f"with {ORDERS} select * from orows",
        "sheet_catalog_hash": f"with {ROWS} select collection_path, cast(count(*) as integer) as n_rows, sum(word_count) as words, {low64('string_agg(row_text, chr(10) order by sort_order)')} as source_binary_hash from r group by 1",
        "order_catalog_hash": f"with {ORDERS} select collection_path, cast(count(*) as integer) as n_rows, sum(word_count) as words, {low64('string_agg(row_text, chr(10) order by sort_order)')} as source_binary_hash from orows group by 1",
        "header_normalize": f"with {LINES}, h as (select distinct regexp_extract(line, '^([^:]*):', 1) as header, pos from li where contains(line, ':')) select header, pos, {column_name('header', 'pos')} as column_name from h",
        "structured_long": f"with {LONG} select * from lf",
        "structured_wide": wide,
        "structured_wide_all": wide,
        "structured_columns": f"with {LONG} select structured_table, \"column\", count(*) as n, count(value) as n_filled, count(distinct collection_path) as n_sheets from lf group by 1, 2",
        "overlap_guard": f"""with {LONG}, own as (select distinct structured_table, collection_path, "column" from lf), fi as (select structured_table, "column", min(collection_path) as fp from own group by 1, 2),
k as (select structured_table, collection_path, count(*) as n_incoming, count(*) filter (where fp < collection_path) as n_common, (select count(*) from fi g where g.structured_table = own.structured_table and g.fp < own.collection_path) as n_existing from own join fi using (structured_table, "column") group by own.structured_table, own.collection_path)
select structured_table, collection_path, n_incoming, n_existing, n_common, n_common / n_incoming as r_in, case when n_existing > 0 then n_common / n_existing else 0.0 end as r_ex, n_existing = 0 or n_common / n_incoming >= 0.5 or n_common / n_existing >= 0.5 as accepted from k""",
        "structured_append_drift": "select 'customer.' || c_custkey as collection_path, c_name as col_name, cast(c_nationkey as varchar) as col_nation, c_mktsegment as col_segment, null as col_balance from customer union all select 'supplier.' || s_suppkey, s_name, cast(s_nationkey as varchar), null, cast(cast(s_acctbal as decimal(18,2)) as varchar) from supplier",
        "merged_range_fill": f"""with {CELLS}, rg as (select distinct sheet, r from ce where r % 10 = 1), cov as (select rg.sheet, rg.r + k as r, 2 as c, a.value as anchor from rg join ce a on a.sheet = rg.sheet and a.r = rg.r and a.c = 2 and a.value is not null, range(0, 3) t(k))
select coalesce(ce.sheet, cov.sheet) as sheet, coalesce(ce.r, cov.r) as r, coalesce(ce.c, cov.c) as c, coalesce(cov.anchor, ce.value) as value from ce full join cov on ce.sheet = cov.sheet and ce.r = cov.r and ce.c = cov.c""",
        "sheet_grid": f"""with {CELLS}, hd as (select sheet, c - row_number() over (partition by sheet order by c) as g, c from ce where r = 1 and value is not null), sp as (select sheet, max(c) as last_col from hd where g = 0 group by 1)
select sp.sheet, 1 as first_col, sp.last_col, 2 as first_row, (select max(r) from ce where ce.sheet = sp.sheet and r >= 2 and c <= sp.last_col and value is not null) as last_row from sp""",
        "collection_path_derive": f"""select doc_id, 'corpus.' || {label("coalesce(source, 'none')")} || '.' || {label("coalesce(title, '') || ' #' || doc_id")} as path, {label('title')} as label,
case when source is not null and t <> '' then 'pub_' || {label('source')} || '_' || t end as folder from (select *, {label("regexp_replace(regexp_replace(regexp_replace(regexp_replace(title, '^Medicare ', ''), '^Medicaid ', ''), '^CMS ', ''), ' Manual$', '')")} as t from documents)""",
        "path_validity": f"select distinct collection_path, regexp_full_match(collection_path, '[a-z0-9_]+(\\.[a-z0-9_]+)*') as path_ok, coalesce(regexp_full_match(title, '[a-z0-9_]+(\\.[a-z0-9_]+)*'), false) as title_ok, coalesce(regexp_full_match({label('title')}, '[a-z_][a-z0-9_]*'), false) as label_ok, regexp_matches(title, '^(?:[A-Za-z]:|/|\\\\)') as rooted from document",
        "duplicate_stems": "select lower(regexp_extract(title, 'Chapter \\d+')) || '.v1' as stem, count(distinct collection_path) as n from document where title is not null group by 1 having count(distinct collection_path) > 1",
        "sections_from_elements": f"with {SECTIONS} select * from se",
        "document_rollup": f"with {SECTIONS} select doc_id, cast(count(*) as integer) as n_parsed_sections, sum(word_count) as words, min(page_start) as first_page, max(page_end) as last_page from se group by 1",
        "element_census": f"with {ELEMENTS} select 'text' as elem_type, label, count(*) as n, count(distinct doc_id) as n_docs, bool_or(body <> '') as carries_text, false as unhandled from el group by label",
        "page_classification": f"with {ELEMENTS} select doc_id, page, case when bool_or(body <> '') then 'body' else 'no_elements' end as kind from el group by 1, 2",
        "chunks_passthrough_split": f"""with d as (select doc_id, coalesce(text, '') as t, {words('text')} as w from documents), n as (select *, len(w) as n from d), k as (select *, {_pieces('n', '62', '54', '64')} as k from n)
select doc_id, i as chunk_number, case when n + 2 <= 64 then t else array_to_string(w[(i - 1) * 54 + 1 : (i - 1) * 54 + 62], ' ') end as chunk_text, case when n + 2 <= 64 then n else len(w[(i - 1) * 54 + 1 : (i - 1) * 54 + 62]) end as word_count from (select *, unnest(range(1, k + 1)) as i from k where k > 0)""",
        "chunks_with_header_budget": f"""with {CONTENT}, p as (select section_id, 'heading_text: ' || coalesce(heading_text, '') as h, 'content_text: ' || coalesce(content_text, '') as t from c),
b as (select *, case when 200 - ({n_words('h')} + 2) <= 30 then 31 else 200 - ({n_words('h')} + 2) end as budget, {words('t')} as w from p),
m as (select *, len(w) as n, greatest(1, budget - 2) as cap from b), s as (select *, cap - greatest(0, least(28, cap - 1)) as stride from m), k as (select *, {_pieces('n', 'cap', 'stride', 'budget')} as k from s)
select section_id, i as chunk_number, h || chr(10) || case when n + 2 <= budget then t else array_to_string(w[(i - 1) * stride + 1 : (i - 1) * stride + cap], ' ') end as chunk_text, case when n + 2 <= budget then n else len(w[(i - 1) * stride + 1 : (i - 1) * stride + cap]) end as word_count from (select *, unnest(range(1, k + 1)) as i from k where k > 0)""",
        "source_filtered": f"with {CONTENT} select collection_path, sort_order from c where (collection_path like 'careman.man_0000%' or collection_path like 'statcode.%') and heading_text like '%claim%'",
        "resume_anti_join": f"with {CONTENT} select collection_path, sort_order from c where not exists (select 1 from embedding_table e where e.fname = c.collection_path and e.so = c.sort_order)",
        "scoped_overwrite_survivors": f"with {CONTENT} select distinct fname, so, chunk_number from embedding_table e where not exists (select 1 from c where c.collection_path like 'careman.%' and c.collection_path = e.fname and c.sort_order = e.so)",
        "embedding_checks": "select count(*) as n, count(*) filter (where embedding is null) as n_null, count(*) filter (where len(embedding) <> 64) as n_other_size from (select distinct on (chunk_id) * from embedding_table)",
        "embedding_failures": f"""with {CONTENT}, e as (select distinct on (chunk_id) *, {n_words('chunk_text')} + 2 as t, concat_ws('/', fname, so, chunk_number) as key from embedding_table)
select 'unembedded' as "check", concat_ws('/', collection_path, sort_order) as key, '' as detail from c where not exists (select 1 from e where e.fname = c.collection_path and e.so = c.sort_order)
union all select 'vector_missing', key, '' from e where embedding is null union all select 'vector_size', key, cast(len(embedding) as varchar) from e where len(embedding) <> 64
union all select 'orphan', key, '' from e where not exists (select 1 from c where e.fname = c.collection_path and e.so = c.sort_order)
union all select 'over_model', key, cast(t as varchar) from e where t > 512 union all select 'over_budget', key, cast(t as varchar) from e where t > 400 and word_count > 1 union all select 'warning_single_word', key, cast(t as varchar) from e where t > 400 and word_count <= 1""",
        "token_gate": f"with e as (select distinct on (chunk_id) *, {n_words('chunk_text')} + 2 as t from embedding_table) select count(*) as n_chunks, coalesce(max(t), 0) as most_tokens, count(*) filter (where t > 512) as n_over_model, count(*) filter (where t > 402 and word_count > 1) as n_over_budget, count(*) filter (where t > 402 and word_count <= 1) as n_single_over from e",
        "cosine_topk": """with e as (select vec_id, cast(embedding as double[]) as v from embeddings), p as (select a.vec_id as query_id, b.vec_id as id, round_even(list_cosine_similarity(a.v, b.v), 6) as similarity from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by similarity desc, id) as rank from p) select query_id, rank, id, similarity from r where rank <= 5""",
        "cascade_orphans": f"with {CONTENT} select collection_path, count(*) as n from c where not exists (select 1 from document d where d.n_parsed_sections > 2 and d.collection_path = c.collection_path) group by 1",
        "count_reconcile": f"with {CONTENT} {count_diff}",
        "sheet_count_reconcile": f"with {ROWS} select d.collection_path, d.n_rows as stated, coalesce(n, 0) as found from (select distinct collection_path, n_rows from sheet) d left join (select collection_path, count(*) as n from r group by 1) k using (collection_path) where d.n_rows <> coalesce(n, 0)",
        "zero_children": "select distinct collection_path from document d where not exists (select 1 from document_content c where c.collection_path = d.collection_path)",
        "order_contiguity": gaps,
        "conditional_violations": _counts(),
        "constraint_rows": _rows("document_content", "collection_path, sort_order"),
        "expected_presence": "select collection_path from (select fname as collection_path from embedding_table union select collection_path from sheet) where collection_path not in (select collection_path from document where collection_path is not null)",
        "repeated_keys": "select collection_path, count(*) as n from document group by 1 having count(*) > 1",
        "word_count_check": f"select distinct collection_path, sort_order, word_count, {n_words('row_text')} as real_words from sheet_content where word_count <> {n_words('row_text')}",
        "token_coverage_gap": f"""with {CONTENT}, a as (select distinct collection_path, sort_order, unnest({tokens('content_text')}) as t from c where content_text is not null), b as (select distinct fname as collection_path, so as sort_order, unnest({tokens('chunk_text')}) as t, true as there from embedding_table),
j as (select a.*, there from a left join b using (collection_path, sort_order, t))
select collection_path, sort_order, count(*) as n_tokens, count(*) filter (where there is null) as n_missing, list_slice(list(t order by t) filter (where there is null), 1, 5) as sample from j group by 1, 2 having count(*) filter (where there is null) > 0""",
        "token_profile": f"select doc_id, len(t) as n_tokens, list_min(t) as first_token, list_max(t) as last_token from (select doc_id, {tokens('text')} as t from documents)",
        "text_health": f"with hs as (select distinct on (section_id) * from document_content), {HEALTH} select section_id, bad_chars, single_ratio, broken, severity from hf",
        "markdown_table_strip": f"""with d as (select distinct on (section_id) section_id, content_text from document_content where content_text is not null),
s as (select section_id, array_to_string(list_filter(regexp_split_to_array(content_text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: not (starts_with(ltrim(x), '|') or (regexp_full_match(x, '[\\s|:-]+') and trim(x) <> ''))), chr(10)) as text from d)
select section_id, length(text) as n_chars, {n_words('text')} as n_words, length(trim(regexp_replace(text, '{_RUN}', ' ', 'g'))) as n_squashed from s""",
        "page_coverage": f"with {PAGES} select * from pc",
        "fragmentation_flags": f"with {FRAGMENTS} select * from ff where reasons <> ''",
        "coverage_fence": f"with {PAGES}, q as (select quantile_cont(coverage, 0.25) as a, quantile_cont(coverage, 0.75) as b from pc where coverage is not null) select greatest(0.0, coalesce(round_even(a - 1.5 * (b - a), 4), 0.0)) as fence from q",
        "flag_ranking": f"""with {FRAGMENTS}, hs as (select * from c), {HEALTH}, fl as (select collection_path, 'count' as reason from ({count_diff}) union select collection_path, 'fragmentation' from ff where reasons <> '' union select collection_path, 'health' from hf union select collection_path, 'order' from ({gaps}))
select collection_path, count(*) as n_flags, string_agg(reason, ',' order by reason) as reasons from fl group by 1""",
        "section_number_gaps": f"""with {CONTENT}, n as (select distinct collection_path, try_cast(regexp_extract(heading_text, '^\\s*(\\d+)(?:\\.\\d+)*\\b', 1) as bigint) as n from c), l as (select *, lag(n) over (partition by collection_path order by n) as b from n where n is not null),
s as (select collection_path, min(n - b) as step from l where b is not null group by 1) select collection_path, unnest(range(b + step, n, step)) as missing_number from l join s using (collection_path) where n - b > step""",
        "page_slices": f"""with {CONTENT}, p as (select collection_path, max(page_end) as pages from c group by 1)
select collection_path, k as slice_no, (k - 1) * 25 + 1 as first_page, least(k * 25, pages) as last_page from (select *, unnest(range(1, 1 + case when pages > 25 then cast(ceil(pages / 25) as bigint) else 1 end)) as k from p where pages is not null) union all select collection_path, 1, 1, null from p where pages is null""",
        "document_failures": _family("document", "document_content", "n_parsed_sections", "no_sections", "select 'repeated', collection_path, '' from document where collection_path is not null group by 2 having count(*) > 1", f"{n_words('heading_text')} + {n_words('content_text')}"),
        "sheet_failures": _family("sheet", "sheet_content", "n_rows", "no_rows", "select 'repeated', concat_ws('/', collection_path, sort_order), '' from sheet_content group by collection_path, sort_order having count(*) > 1", n_words("row_text")),
        "cleaned_records": f"""with {SECTIONS}, h as (select cast(doc_id as varchar) as doc_id, {low64("coalesce(text, '')")} as binary_hash from documents),
p as (select doc_id, count(*) as n, string_agg('{{"sort_order":' || sort_order || ',"heading_text":' || coalesce(cast(to_json(heading_text) as varchar), 'null') || ',"content_text":' || coalesce(cast(to_json(content_text) as varchar), 'null') || ',"word_count":' || word_count || ',"page_start":' || page_start || ',"page_end":' || page_end || '}}', ',' order by sort_order) as s from se group by 1)
select doc_id, '{{"document":{{"n_parsed_sections":' || n || ',"binary_hash":' || binary_hash || '}},"sections":[' || s || ']}}' as record from p join h using (doc_id)""",
        "cleaned_failures": f"with {SECTIONS} select doc_id, ['malformed', 'unknown key', 'number of sections', 'wrong type', 'hash range', 'no sections'][cast((cast(doc_id as bigint) // 7) % 6 as integer) + 1] as reason from (select distinct doc_id from se) where cast(doc_id as bigint) % 7 = 0",
        "stream_ingest": "select fname, count(*) as n, sum(word_count) as words from (select distinct on (fname, so, chunk_number) * from embedding_table) group by 1",
        "quality_records": f"""with {FRAGMENTS}, {PAGES.replace(CONTENT + ',', '')}, hs as (select * from c), {HEALTH},
hk as (select collection_path, count(*) as flagged_sections from hf group by 1), hw2 as (select collection_path, max(bad_chars * 100 + single_ratio * 10 + broken) as worst from h group by 1),
n as (select distinct collection_path, try_cast(regexp_extract(heading_text, '^\\s*(\\d+)(?:\\.\\d+)*\\b', 1) as bigint) as n from c), l as (select *, lag(n) over (partition by collection_path order by n) as b from n where n is not null),
st as (select collection_path, min(n - b) as step from l where b is not null group by 1), mg as (select collection_path, sum(len(range(b + step, n, step))) as missing_numbers from l join st using (collection_path) where n - b > step group by 1)
select collection_path, section_count, fm.total_pages, sections_per_page, median_words, covered_pages, coverage, coalesce(flagged_sections, 0) as flagged_sections, worst, coalesce(missing_numbers, 0) as missing_numbers
from fm left join pc using (collection_path) left join hk using (collection_path) left join hw2 using (collection_path) left join mg using (collection_path)""",
        "judged_documents": f"""with e as (select distinct collection_path as file, case length(title) % 3 when 0 then collection_path when 1 then {label('title')} else title end as path from document where title is not null),
s as (select *, count(*) over (partition by file) as ns, coalesce(regexp_full_match(path, '[a-z0-9_]+(\\.[a-z0-9_]+)*'), false) as ok from e),
m as (select path, count(*) as np from s where ok group by 1)
select file as stem, s.path, case when ns > 1 then 'repeated_stem' when not ok then 'invalid_path' when np > 1 then 'repeated_path' end as problem from s left join m on m.path = s.path""",
        "mixed_sections": f"with {MIXED_SECTIONS} select * from ms",
        "mixed_failures": f"with {MIXED} select doc_id, 'clean' as stage, 'unknown element ' || min(label) || ' (' || count(*) || ')' as reason from mr where role = 'unknown' group by doc_id",
        "mixed_census": f"with {MIXED} select elem_type, label, count(*) as n, count(distinct doc_id) as n_docs, bool_or(body <> '') as carries_text, bool_or(coalesce(role = 'unknown', false)) as unhandled from mr group by 1, 2",
        "mixed_pages": f"""with {MIXED}, pg as (select doc_id, page, case when bool_or(role is not null) then 'body' when bool_or(k = 2 and block is null) then 'blank_table' when bool_or(k = 3) then 'image_only' when bool_or(label = 'page_header') then 'furniture_only' else 'no_elements' end as kind from mr group by 1, 2)
select e.doc_id, e.page, coalesce(pg.kind, 'no_elements') as kind from (select doc_id, unnest(range(1, max(page) + 1)) as page from mr group by doc_id) e left join pg on pg.doc_id = e.doc_id and pg.page = e.page""",
        "table_coverage": f"""with {MIXED_SECTIONS}, tb as (select doc_id, seq, row_number() over (partition by doc_id order by seq) as table_no, case when filled then array_to_string(flatten(grid), ' ') else coalesce(caption, '') end as t from mr where k = 2),
tt as (select distinct doc_id, table_no, unnest({tokens('t')}) as token from tb), kt as (select distinct doc_id, unnest({tokens(_KEPT)}) as token from ms)
select doc_id, table_no, count(*) as n_missing, list_slice(list(token order by token), 1, 5) as sample from tt where not exists (select 1 from kt where kt.doc_id = tt.doc_id and kt.token = tt.token) group by 1, 2""",
        "header_problems": f"with {_HEADS} select sheet, problem, header from hp",
        "sheet_data_rows": f"""with {_HEADS}, cv as (select collection_path as sheet, sort_order as r, pos + 1 as c, nullif(trim(regexp_replace(line, '^[^:]*:', '')), '') as value from li),
g as (select cv.* from cv join hs on hs.sheet = cv.sheet and c <= last_col where value is not null and cv.sheet not in (select sheet from hp)),
k as (select sheet, r, row_number() over (partition by sheet order by r) as n from (select distinct sheet, r from g)),
t as (select k.sheet, k.n, string_agg(h.header || ': ' || coalesce(g.value, ''), chr(10) order by h.c) as row_text from k join hh h on h.sheet = k.sheet left join g on g.sheet = k.sheet and g.r = k.r and g.c = h.c group by 1, 2)
select sheet as collection_path, n as sort_order, row_text, {n_words('row_text')} as word_count from t""",
        "incremental_family": f"""with {CONTENT}, p as (select collection_path, case when length(collection_path) % 5 = 0 then 'third' when length(collection_path) % 2 = 0 then max(title) else 'second' end as title from document where collection_path is not null group by 1),
n as (select collection_path, count(*) as n_rows, sum(word_count) as words from c where length(collection_path) % 5 <> 0 or sort_order = 1 group by 1)
select p.collection_path, p.title, n.n_rows, n.words from p left join n on n.collection_path = p.collection_path""",
        "templated_targets": "select distinct 'https://example.org/' || collection_path || '.pdf' as url, 'raw/' || collection_path || '.pdf' as destination, 'g_' || collection_path as \"group\", cast(null as bigint) as expected_size from document",
        "manifest_skip": f"""with {ENTRIES}, la as (select url, max_by(status, pos) as status, max_by(path, pos) as path, max_by(want, pos) as want from ent group by 1)
select 'https://example.org/' || doc_id as url, 'raw/' || doc_id || '.txt' as destination, coalesce(la.status in ('fetched', 'skipped') and fi.size = la.want, false) as skip from documents left join la on la.url = 'https://example.org/' || doc_id left join fi on fi.path = la.path""",
        "manifest_validation": f"""with {ENTRIES}, p as (select url, ent.path, case when status = 'failed' then 'failed' when ent.path is null then 'no_artifacts' when size is null then 'missing' when size = 0 then 'empty' when size <> want then 'size' end as problem from ent left join fi on fi.path = ent.path) select * from p where problem is not null""",
    }
