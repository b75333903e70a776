"""SQL for the queries that plain SQL can express over whole tables."""

from __future__ import annotations

_TOKENS = "greatest(1, length({0})//4)"

_P5_FOUND = f"""
select 'chunks' tbl, chunk_row row_id from chunks where token_count is distinct from {_TOKENS.format('"text"')}
union all
select 'flat_documents', flat_id from flat_documents
where word_count is distinct from len(list_filter(string_split_regex(full_text, '[\\s\\x{{00a0}}]+'), lambda x: x <> ''))
"""

_P6_FOUND = f"""
select 'flat_documents' tbl, flat_id row_id, 0::bigint turn_no from flat_documents join size_limits on slice_name = collection
where {_TOKENS.format('full_text')} > max_tokens
union all
select 'session_documents', session_id, k::bigint from (select session_id, unnest(turns) t, generate_subscripts(turns, 1) k from session_documents)
where {_TOKENS.format('t.text')} > (select max_tokens from size_limits where slice_name = 'sessions')
"""

_P8_FOUND = f"""
select doc_id from documents where {_TOKENS.format('"text"')} > (select max_tokens from size_limits where slice_name = 'container')
"""

_P9_FOUND = """
with d as (select doc_id, regexp_extract_all(lower("text"), '[\\p{L}\\p{N}]+') w from documents),
i as (select item_id, regexp_extract_all(lower("text"), '[\\p{L}\\p{N}]+') w from eval_passages),
gi as (select distinct item_id, array_to_string(w[k:k+11], ' ') g from (select item_id, w, unnest(generate_series(1, len(w)-11)) k from i where len(w) >= 12)),
gd as (select doc_id, array_to_string(w[k:k+11], ' ') g from (select doc_id, w, unnest(generate_series(1, len(w)-11)) k from d where len(w) >= 12))
select distinct doc_id, item_id from gd join gi using (g)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {"p5_found": _P5_FOUND, "p6_found": _P6_FOUND, "p8_found": _P8_FOUND, "p9_found": _P9_FOUND}
