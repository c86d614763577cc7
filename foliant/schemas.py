"""Schemas of the stored tables, as DDL, and the constraints that a commit checks.

Parquet tables have neither keys nor checks, so each constraint is a predicate over rows; null means it holds.
"""

from __future__ import annotations

UINT64 = 2**64

DOCUMENT = "collection_path string, title string, n_parsed_sections int, source_binary_hash decimal(20,0), ingested_at timestamp"
CONTENT = "collection_path string, sort_order int, heading_text string, content_text string, word_count int, page_start int, page_end int"
SHEET = "collection_path string, title string, n_rows int, source_binary_hash decimal(20,0), structured_table string, ingested_at timestamp"
SHEET_CONTENT = "collection_path string, sort_order int, row_text string, word_count int"
ELEMENTS = "doc_id string, seq int, elem_type string, label string, text string, caption string, grid array<array<string>>, pages array<int>"
CELLS = "file string, sheet string, r int, c int, value string"
RANGES = "file string, sheet string, min_col int, min_row int, max_col int, max_row int"
TARGETS = "url string, destination string, `group` string, expected_size bigint"
MANIFEST = "generated_at string, entries array<struct<url:string,destination:string,`group`:string,status:string,error:string,artifacts:array<struct<path:string,size:bigint>>>>"
CLEANED = "document struct<n_parsed_sections:int,binary_hash:decimal(20,0)>, sections array<struct<sort_order:int,heading_text:string,content_text:string,word_count:int,page_start:int,page_end:int>>"

KEYS = {"document": ["collection_path"], "document_content": ["collection_path", "sort_order"], "sheet": ["collection_path"], "sheet_content": ["collection_path", "sort_order"], "embedding_table": ["fname", "so", "chunk_number"]}

_BLANK = "coalesce(trim({0}), '') = ''"
#: Table to the name of a check and the condition under which a row breaks it.
CHECKS: dict[str, dict[str, str]] = {
    "document": {
        "key_missing": "collection_path is null",
        "path_invalid": r"not rlike(collection_path, '\\A[a-z0-9_]+(\\.[a-z0-9_]+)*\\z')",
        "title_blank": _BLANK.format("title"),
        "sections_below_one": "n_parsed_sections < 1",
        "hash_range": f"source_binary_hash < 0 or source_binary_hash >= {UINT64}BD",
    },
    "document_content": {
        "key_missing": "collection_path is null or sort_order is null",
        "order_below_one": "sort_order < 1",
        "words_below_zero": "word_count < 0",
        "page_below_one": "page_start < 1 or page_end < 1",
        "nothing_in_it": f"{_BLANK.format('heading_text')} and {_BLANK.format('content_text')}",
        "page_order": "page_start > page_end",
    },
    "sheet": {
        "key_missing": "collection_path is null",
        "title_blank": _BLANK.format("title"),
        "rows_below_one": "n_rows < 1",
        "hash_range": f"source_binary_hash < 0 or source_binary_hash >= {UINT64}BD",
    },
    "sheet_content": {
        "key_missing": "collection_path is null or sort_order is null",
        "order_below_one": "sort_order < 1",
        "text_empty": "coalesce(row_text, '') = ''",
        "words_below_zero": "word_count < 0",
    },
    "embedding_table": {"key_missing": "fname is null or so is null or chunk_number is null", "number_below_one": "chunk_number < 1", "words_below_zero": "word_count < 0"},
}
