"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LM_SCORING = r"""
with words as (
  select doc_id, unnest(list) as w, generate_subscripts(list, 1) as i
  from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as list from documents)
), pairs as (
  select doc_id, i, w, lag(w) over (partition by doc_id order by i) as v from words
), counted as (
  select doc_id, i, w, v,
    count(*) over () - count(*) over (partition by doc_id) as n,
    count(*) over (partition by w) - count(*) over (partition by doc_id, w) as c1,
    count(*) over (partition by v, w) - count(*) over (partition by doc_id, v, w) as c2
  from pairs
), scored as (
  select *, lag(c1) over (partition by doc_id order by i) as h from counted
), logs as (
  select doc_id, case
      when i > 1 and c2 > 0 and h > 0 then log10(c2::double / h)
      when c1 > 0 and n > 0 then log10(c1::double / n) + (case when i > 1 then log10(0.4::double) else 0 end)
      else log10(1.0::double / (n + 1)) + (case when i > 1 then log10(0.4::double) else 0 end) end as s,
    case when i > 1 then not (c2 > 0 and h > 0) else not (c1 > 0 and n > 0) end as backed_off
  from scored
)
select d.doc_id, cast(count(l.s) as bigint) as n_words,
  cast(count(*) filter (l.backed_off) as bigint) as n_backed_off,
  cast(coalesce(sum(cast(round(1e6 * l.s) as bigint)), 0) as bigint) as score_micro
from documents d left join logs l on l.doc_id = d.doc_id group by d.doc_id
"""

_CHAT = r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), texts as (
  select *, replace(replace(text, '\', '\\'), '<|', '<\|') as body, replace(replace(role, '\', '\\'), '<|', '<\|') as head from turns
), joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
    sum(8 + length(head) + 8 + length(body) + 7) as formatted_chars
  from texts group by conv_id
)
select conv_id, cast(n_turns as bigint) as n_turns, sha256(turns) as turns_sha256,
  cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from joined
"""

_WARC = r"""
with digests as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
  select *, min(page_id) over (partition by payload_digest) as original from digests
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and original <> page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and original <> page_id then original end as refers_to
from firsts
"""

ORACLES = {
    "op1_lm_scoring": _LM_SCORING,
    "op5_chat_formatting": _CHAT,
    "op7_warc": _WARC,
}
