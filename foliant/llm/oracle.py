"""SQL counterparts, for DuckDB, of those queries that SQL can express over whole tables."""

from __future__ import annotations

from foliant.functions.text import WS
from foliant.llm.p1_lines import MONTHS, NAMES

_LINES = f"""
one as (select distinct section_id, collection_path, content_text from document_content where content_text is not null and collection_path is not null and section_id is not null),
cut as (select section_id, collection_path, split_part(collection_path, '.', 2) as source, string_split(content_text, chr(10)) as ls from one),
lines as (select section_id, collection_path, source, unnest(ls) as line, generate_subscripts(ls, 1) as line_no from cut),
keyed as (select *, regexp_replace(trim(regexp_replace(lower(line), '[{WS}]+', ' ', 'g')), '\\p{{Nd}}+', '0', 'g') as k from lines),
counted as (select * from keyed where length(regexp_replace(k, '[^\\p{{L}}]+', '', 'g')) >= 20),
sizes as (select split_part(collection_path, '.', 2) as source, count(distinct collection_path) as n from document_content where section_id is not null group by 1),
often as (select c.source, c.k from counted c join sizes s on c.source = s.source group by c.source, c.k, s.n having count(distinct collection_path) >= 6 and count(distinct collection_path) * 100 >= 5 * s.n)
"""

_NEAR = f"""{_LINES},
masked as (select c.*, regexp_replace(regexp_replace(
  regexp_replace(trim(regexp_replace(lower(regexp_replace(trim(regexp_replace(line, '[{WS}]+', ' ', 'g')), '{NAMES}', '\\1#', 'g')), '[{WS}]+', ' ', 'g')), '\\p{{Nd}}+', '0', 'g'),
  '\\b(?:{MONTHS}) 0,? 0\\b|\\b0[-/]0[-/]0\\b', '0', 'g'), '[0.,$]+', '0', 'g') as form from counted c),
clustered as (select *, list_distinct(string_split(form, ' ')) as ws, list_sort(list_distinct(list_transform(string_split(form, ' '), lambda x: md5(x))))[1:4] as near from masked where length(regexp_replace(form, '[^\\p{{L}}]+', '', 'g')) >= 20),
dense as (select c.source, near from clustered c join sizes s on c.source = s.source group by c.source, near, s.n having count(distinct collection_path) >= 6 and count(distinct collection_path) * 100 >= 5 * s.n),
forms as (select c.source, c.near, form, any_value(ws) as ws, count(distinct collection_path) as docs from clustered c join dense d on c.source = d.source and c.near = d.near group by all),
heads as (select source, near, form as standing, ws as hs from forms qualify row_number() over (partition by source, near order by docs desc, form) = 1),
alike as (select f.source, f.near, form, standing from forms f join heads h on f.source = h.source and f.near = h.near where len(list_intersect(ws, hs)) * 100 >= 80 * (len(ws) + len(hs) - len(list_intersect(ws, hs)))),
member as (select c.section_id, c.line_no, c.collection_path, c.source, c.near, c.form, a.standing from clustered c join alike a on c.source = a.source and c.near = a.near and c.form = a.form),
near_often as (select m.source, near from member m join sizes s on m.source = s.source group by m.source, near, s.n having count(distinct collection_path) >= 6 and count(distinct collection_path) * 100 >= 5 * s.n),
near_gone as (select m.* from member m join near_often o on m.source = o.source and m.near = o.near)
"""

_OVER = f"""
items as (
  select distinct 'document_content' as table_name, section_id as item_id, content_text as t from document_content where content_text is not null and section_id is not null
  union select distinct 'embedding_table', chunk_id, chunk_text from embedding_table where chunk_text is not null and chunk_id is not null),
counts as (select *, len(list_filter(regexp_split_to_array(t, '[{WS}]+'), lambda x: x <> '')) as n from items where length(t) > 800),
big as (select * from counts where n > 400),
parts as (select table_name, item_id, len(list_filter(regexp_split_to_array(unnest(regexp_split_to_array(regexp_replace(t, '([.!?])([{WS}])', '\\1' || chr(10), 'g'), chr(10))), '[{WS}]+'), lambda x: x <> '')) as m from big)
"""


_SPLIT = "list_filter(regexp_split_to_array({0}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _words(table: str, key: str, text: str) -> str:
    return f"select {key} as id, list_transform({_SPLIT.format(text)}, lambda x: lower(x)) as w from (select distinct {key}, {text} from {table} where {text} is not null and {key} is not null)"


def _near(table: str, key: str, text: str) -> str:
    return f"""
select '{table}' as table_name, a.id as id_a, b.id as id_b from
  (select id, s, count(*) over (partition by id) as n from (select distinct id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as s from ({_words(table, key, text)}) where len(w) >= 20)) a
  join (select id, s, count(*) over (partition by id) as n from (select distinct id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as s from ({_words(table, key, text)}) where len(w) >= 20)) b
  on a.s = b.s and a.id < b.id
group by a.id, b.id having count(*) * 2 >= max(a.n) + max(b.n) - count(*)"""


def _grams(n: int) -> str:
    return "concat_ws(' ', " + ", ".join(f"w[i + {k}]" for k in range(n)) + ")"


def _spans() -> str:
    """Spans of leaked items as in the operator: overlapping and touching windows are one."""
    own = lambda table, key: f"select id, unnest(gs) as g, generate_subscripts(gs, 1) as p from (select id, list_transform(range(1, len(w) - 10), lambda i: {_grams(12)}) as gs from ({_words(table, key, 'text')}) where len(w) >= 12)"
    return f"""
dg as ({own('documents', 'doc_id')}), eg as ({own('eval_items', 'item_id')}),
hits as (select distinct dg.id as doc_id, eg.id as item_id, dg.p from dg join eg on dg.g = eg.g),
cut as (select *, case when p - lag(p) over (partition by doc_id, item_id order by p) <= 12 then 0 else 1 end as fresh from hits),
runs as (select doc_id, item_id, min(p) as a, max(p) + 11 as z from (select *, sum(fresh) over (partition by doc_id, item_id order by p) as k from cut) group by doc_id, item_id, k),
texts as (select distinct doc_id, text, {_SPLIT.format('text')} as ws, regexp_split_to_array(text, '[\\p{{L}}\\p{{N}}]+') as gaps from documents where doc_id in (select doc_id from hits)),
sizes as (select doc_id, k, len(gaps[k]) as gap, len(ws[k]) as size from (select *, unnest(range(1, len(ws) + 1)) as k from texts)),
places as (select doc_id, k, size, sum(gap + size) over (partition by doc_id order by k) as stop from sizes),
spans as (
  select r.doc_id, r.item_id, cast(r.a - 1 as integer) as first_word, cast(r.z - 1 as integer) as last_word, cast(s.stop - s.size as integer) as start_char, cast(e.stop as integer) as end_char
  from runs r join places s on s.doc_id = r.doc_id and s.k = r.a join places e on e.doc_id = r.doc_id and e.k = r.z)
"""


def _groups(table: str, key: str, text: str) -> str:
    """Groups of one table: links between the smallest ids of records with the same words, closed over."""
    return f"""
select '{table}' as table_name, c.id, g.group_id, coalesce(l.links, 0) as links, c.copies from
  (select id, min(id) over (partition by w) as rep, count(*) over (partition by w) as copies from ({_words(table, key, text)}) where len(w) >= 20) c
  join (with recursive p as ({_near(table, key, text)}),
    r as (select id, min(id) over (partition by w) as rep from ({_words(table, key, text)}) where len(w) >= 20),
    e as (select distinct a.rep as a, b.rep as b from p join r a on a.id = p.id_a join r b on b.id = p.id_b where a.rep <> b.rep),
    both_ways as (select a, b from e union select b, a from e),
    reach as (select distinct rep as a, rep as b from r union select x.a, y.b from reach x join both_ways y on x.b = y.a)
    select a, min(b) as group_id from reach group by a) g on g.a = c.rep
  left join (with p as ({_near(table, key, text)}), r as (select id, min(id) over (partition by w) as rep from ({_words(table, key, text)}) where len(w) >= 20),
    e as (select distinct a.rep as a, b.rep as b from p join r a on a.id = p.id_a join r b on b.id = p.id_b where a.rep <> b.rep)
    select a, count(distinct b) as links from (select a, b from e union select b, a from e) group by a) l on l.a = c.rep
where c.copies > 1 or l.links is not null"""


_PIECES = f"""
items as (
  select distinct 'document_content' as table_name, section_id as item_id, content_text as t from document_content where content_text is not null and section_id is not null
  union select distinct 'embedding_table', chunk_id, chunk_text from embedding_table where chunk_text is not null and chunk_id is not null),
split as (select *, list_filter(regexp_split_to_array(t, '[{WS}]+'), lambda x: x <> '') as ws from items),
small as (select * from split where len(ws) between 1 and 400),
large as (select table_name, item_id, t, ws, len(ws) as n, regexp_split_to_array(t, '[^{WS}]+') as gaps from split where len(ws) > 400),
bounds as (select *, list_append(list_filter(range(1, n), lambda k: ws[k][-1] in ('.', '!', '?') or contains(gaps[k + 1], chr(10))), n) as ends from large),
kinds as (select table_name, item_id, n, ends, case when list_max(list_transform(range(1, len(ends) + 1), lambda i: ends[i] - case when i = 1 then 0 else ends[i - 1] end)) > 400 then 'forced' else 'natural' end as cut from bounds),
cuts as (
  select table_name, item_id, 1 as k, cast(0 as bigint) as s,
    case when coalesce(list_max(list_filter(ends, lambda e: e <= 400)), 0) > 40 then list_max(list_filter(ends, lambda e: e <= 400)) else 400 end as e,
    case when coalesce(list_max(list_filter(ends, lambda e: e <= 400)), 0) > 40 then 'natural' else 'hard' end as how from kinds
  union all
  select c.table_name, c.item_id, c.k + 1, c.e - 40,
    case when b.n - (c.e - 40) <= 400 then b.n when coalesce(list_max(list_filter(ends, lambda x: x <= c.e + 360)), 0) > c.e then list_max(list_filter(ends, lambda x: x <= c.e + 360)) else c.e + 360 end,
    case when b.n - (c.e - 40) <= 400 then 'end' when coalesce(list_max(list_filter(ends, lambda x: x <= c.e + 360)), 0) > c.e then 'natural' else 'hard' end
  from cuts c join kinds b on b.table_name = c.table_name and b.item_id = c.item_id where c.how <> 'end'),
places as (select table_name, item_id, k, size, sum(gap + size) over (partition by table_name, item_id order by k) as stop
  from (select table_name, item_id, k, len(gaps[k]) as gap, len(ws[k]) as size from (select *, unnest(range(1, n + 1)) as k from large)))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"with {_LINES} select distinct c.section_id, cast(c.line_no as integer) as line_no from counted c join often o on c.source = o.source and c.k = o.k",
        "p1_clean": f"""with {_NEAR},
gone as (select distinct c.section_id, c.line_no from counted c join often o on c.source = o.source and c.k = o.k union select section_id, line_no from near_gone),
kept as (select l.section_id, string_agg(l.line, chr(10) order by l.line_no) filter (where g.line_no is null) as t, count(g.line_no) as n from lines l left join gone g on g.section_id = l.section_id and g.line_no = l.line_no group by l.section_id)
select d.section_id, case when k.n > 0 then coalesce(k.t, '') else d.content_text end as content_text, cast(coalesce(k.n, 0) as integer) as n_removed
from (select distinct section_id, content_text from document_content where section_id is not null) d left join kept k on k.section_id = d.section_id""",
        "p1_clusters": f"with {_NEAR} select source, standing as form, count(distinct collection_path) as docs, count(distinct (section_id, line_no)) as lines, count(distinct form) as forms from near_gone group by source, near, standing",
        "p3_found": f"with {_OVER} select table_name, item_id, case when max(m) > 400 then 'forced' else 'natural' end as cut from parts group by table_name, item_id",
        "p3_pieces": f"""with recursive {_PIECES}
select table_name, item_id, cast(1 as integer) as chunk_number, t as chunk_text, cast(len(ws) as integer) as word_count, cast(0 as integer) as start_word, 'end' as ends, null as cut from small
union all
select c.table_name, c.item_id, cast(c.k as integer), substr(l.t, cast(a.stop - a.size + 1 as bigint), cast(z.stop - a.stop + a.size as bigint)), cast(c.e - c.s as integer), cast(c.s as integer), c.how, b.cut
from cuts c join kinds b on b.table_name = c.table_name and b.item_id = c.item_id join large l on l.table_name = c.table_name and l.item_id = c.item_id
  join places a on a.table_name = c.table_name and a.item_id = c.item_id and a.k = c.s + 1 join places z on z.table_name = c.table_name and z.item_id = c.item_id and z.k = c.e""",
        "p4_groups": _groups("document_content", "section_id", "content_text") + " union all " + _groups("embedding_table", "chunk_id", "chunk_text"),
        "p4_found": _near("document_content", "section_id", "content_text") + " union all " + _near("embedding_table", "chunk_id", "chunk_text"),
        "p8_found": f"""with d as ({_words('documents', 'doc_id', 'text')}), e as ({_words('eval_items', 'item_id', 'text')}),
dg as (select id, unnest(list_transform(range(1, len(w) - 10), lambda i: {_grams(12)})) as g from d where len(w) >= 12),
eg as (select id, unnest(list_transform(range(1, len(w) - 10), lambda i: {_grams(12)})) as g from e where len(w) >= 12)
select distinct dg.id as doc_id, eg.id as item_id from dg join eg on dg.g = eg.g""",
        "p8_spans": f"with {_spans()} select * from spans",
        "p8_clean": f"""with {_spans()},
steps as (select *, max(end_char) over (partition by doc_id order by start_char, end_char rows between unbounded preceding and 1 preceding) as reach from (select distinct doc_id, start_char, end_char from spans)),
merged as (select doc_id, min(start_char) as a, max(end_char) as z from (select *, sum(case when start_char <= reach then 0 else 1 end) over (partition by doc_id order by start_char, end_char) as k from steps) group by doc_id, k),
parts as (select *, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from merged),
kept as (select p.doc_id, string_agg(substr(t.text, cast(p.before + 1 as bigint), cast(p.a - p.before as bigint)), '' order by p.a) || substr(any_value(t.text), cast(max(p.z) + 1 as bigint)) as text, sum(p.z - p.a) as n from parts p join texts t on t.doc_id = p.doc_id group by p.doc_id)
select d.doc_id, case when k.n > 0 then k.text else d.text end as text, cast(coalesce(k.n, 0) as integer) as n_removed
from documents d left join kept k on k.doc_id = d.doc_id where k.n is null or k.n < 0.5 * length(d.text)""",
        "p9_found": f"""with d as ({_words('documents', 'doc_id', 'text')}),
g as (select id, n, unnest(gs) as g, generate_subscripts(gs, 1) as i from (select id, len(w) as n, list_transform(range(1, len(w) - 3), lambda i: {_grams(5)}) as gs from d where len(w) >= 20)),
again as (select id, n, i from (select id, n, i, min(i) over (partition by id, g) as first from g) where i > first),
covered as (select distinct id, n, i + k as p from again, range(0, 5) r(k))
select id as doc_id from covered group by id, n having count(*) * 100 >= 30 * n""",
        "p9_shares": f"""with one as (select distinct doc_id, text from documents where doc_id is not null),
d as (select doc_id as id, coalesce(list_transform({_SPLIT.format('text')}, lambda x: lower(x)), []) as w,
  list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^[{WS}]+|[{WS}]+$', '', 'g')), lambda x: x <> '') as lines from one),
g as (select id, unnest(gs) as g, generate_subscripts(gs, 1) as i from (select id, list_transform(range(1, len(w) - 3), lambda i: {_grams(5)}) as gs from d)),
again as (select id, i from (select id, i, min(i) over (partition by id, g) as first from g) where i > first),
covered as (select id, count(distinct i + k) as n from again, range(0, 5) r(k) group by id),
tops as (select id, max(n) as n from (select id, g, count(*) as n from (select id, unnest(list_transform(range(1, len(w) - 1), lambda i: {_grams(3)})) as g from d) group by id, g) group by id)
select d.id as doc_id, cast(len(w) as integer) as n_words, cast(coalesce(c.n, 0) as integer) as repeated_words, case when len(w) > 0 then coalesce(c.n, 0) / len(w) else 0.0 end as share,
  case when len(lines) > 0 then 1 - len(list_distinct(lines)) / len(lines) else 0.0 end as line_share, case when t.n is not null then t.n / (len(w) - 2) else 0.0 end as top_share
from d left join covered c on c.id = d.id left join tops t on t.id = d.id""",
    }
