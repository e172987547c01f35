"""The same queries in plain SQL over the tables, for DuckDB."""

from __future__ import annotations

from workload.queries import FEED_LIMIT, LOOKBACK_DAYS

ORACLES: dict[str, str] = {}

# White space as a class that DuckDB's regular expressions know.
WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# The tracking parameters that canonical URLs lose.
TRACKED = (
    "'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid', 'msclkid', '_ga',"
    " 'mc_cid', 'mc_eid', 'ref', 'source', 'campaign_id', 'ad_id'"
)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def iso(ts: str) -> str:
    """A timestamp as text with microseconds only where there are any."""
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
        f" || case when microsecond({ts}) % 1000000 = 0 then ''"
        f" else '.' || lpad(cast(microsecond({ts}) % 1000000 as varchar), 6, '0') end || '+00:00'"
    )


def canonical(u: str) -> str:
    query = rf"regexp_extract({u}, '\?([^#]*)', 1)"
    kept = (
        f"array_to_string(list_sort(list_filter(string_split({query}, '&'),"
        f" lambda x: x <> '' and lower(split_part(x, '=', 1)) not in ({TRACKED}))), '&')"
    )
    return (
        f"lower(regexp_extract({u}, '^[^/]*//[^/?#]*')) || regexp_extract({u}, '^[^/]*//[^/?#]*([^?#]*)', 1)"
        f" || case when {kept} = '' then '' else '?' || {kept} end"
    )


def host(u: str) -> str:
    return f"regexp_extract({u}, '^[^/]*//([^/?#]*)', 1)"


def domain(u: str) -> str:
    return rf"regexp_extract({host(u)}, '([^.]+\.[^.]+)$', 1)"


ENTRIES = f"""
n as (select (select count(*) from pages) p, (select count(*) from documents) d,
             (select count(*) from events) e, (select count(*) from embeddings) v),
entries as (
  select d.doc_id as seq, d.source as source_name,
    cast(50 + 5 * (cast(substr(d.source, 4) as int) % 10) as double) / 100 as source_weight,
    {strip("split_part(d.text, chr(10), 1)")} as title,
    {strip("case when instr(d.text, chr(10)) > 0 then substr(d.text, instr(d.text, chr(10)) + 1) else '' end")} as summary,
    concat(split_part(p.url, '/', 1), '//', split_part(p.url, '/', 3), '/d', d.doc_id // (2 * n.p),
           substr(p.url, length(split_part(p.url, '/', 1)) + length(split_part(p.url, '/', 3)) + 3)) as link,
    cast(e.ts as timestamp) as published_at, v.label - 1 as topic_id
  from documents d cross join n
  join pages p on p.page_id = d.doc_id % n.p
  join events e on e.event_id = d.doc_id * (n.e // n.d)
  join embeddings v on v.vec_id = d.doc_id % n.v)"""

ITEMS = f"""{ENTRIES},
addressed as (
  select * exclude (summary), 'run-1' as run_id, {canonical("link")} as canonical_url, summary <> '' as has_summary,
    case when summary <> '' then summary else title end as summary
  from entries),
items as (
  select *, substr(sha256(canonical_url), 1, 16) as item_id,
    cast(length(title) + length(summary) as int) as text_len,
    sha256({squeeze("lower(title || ' ' || summary)")}) as content_hash,
    {domain("canonical_url")} as publisher_domain
  from addressed)"""

DEDUPED = f"""{ITEMS},
url_ranked as (
  select *, min(seq) over (partition by canonical_url) as pos1,
    row_number() over (partition by canonical_url order by source_weight desc, published_at desc, seq) as url_rank
  from items),
hash_ranked as (
  select *, min(pos1) over (partition by content_hash) as pos,
    row_number() over (partition by content_hash order by source_weight desc, published_at desc, pos1) as hash_rank
  from url_ranked where url_rank = 1),
kept as (select * from hash_ranked where hash_rank = 1)"""

STATS = """
stats as (
  select topic_id, count(*) as topic_volume, count(distinct publisher_domain) as unique_domains,
    avg(source_weight) as avg_source_weight, 1 - count(distinct content_hash) / count(*) as duplicate_ratio,
    min(pos) as first_pos, min(published_at) as first_seen_at, max(published_at) as last_seen_at
  from kept where topic_id <> -1 group by topic_id)"""


def term_tables(source: str) -> str:
    """Terms weighed inside each run."""
    return rf"""
words as (
  select run_id, topic_id, unnest(regexp_extract_all(lower(title || ' ' || summary), '[\p{{L}}\p{{N}}_]{{2,}}')) as term
  from {source} where topic_id <> -1),
tf as (select run_id, topic_id, term, count(*) as n from words group by all),
totals as (select run_id, term, cast(sum(n) as bigint) as total from tf group by all),
sizes as (select run_id, topic_id, cast(sum(n) as bigint) as words from tf group by all),
average as (select run_id, floor(sum(words) / count(*)) as a from sizes group by run_id),
weights as (
  select tf.run_id, tf.topic_id, tf.term, tf.n, tf.n * ln(1 + average.a / totals.total) as weight
  from tf join totals using (run_id, term) join average using (run_id)),
ranked_terms as (
  select w.run_id, w.topic_id, w.term, w.weight / s.words as score,
    row_number() over (partition by w.run_id, w.topic_id order by w.weight desc, w.term) as rank
  from weights w join sizes s using (run_id, topic_id))"""


REPRESENTATIVES = """
representatives as (
  select topic_id, canonical_url as url, title, publisher_domain as domain, published_at, substr(summary, 1, 200) as summary,
    row_number() over (partition by topic_id order by source_weight desc, published_at desc, pos) as rank
  from kept where topic_id <> -1)"""


def domain_ranks(key: str) -> str:
    return f"""
domain_ranks as (
  select *, row_number() over (partition by topic_id order by n desc, first_pos) as rank
  from (select topic_id, {key} as publisher_domain, count(*) as n, min(pos) as first_pos
        from kept where topic_id <> -1 group by 1, 2))"""


RECORDS = f"""{DEDUPED},{STATS},{term_tables("kept")},{REPRESENTATIVES},{domain_ranks("publisher_domain")},
keyword_lists as (
  select topic_id, list(term order by rank) as keywords from ranked_terms where rank <= 15 group by topic_id),
domain_lists as (
  select topic_id, list(publisher_domain order by rank) filter (rank <= 5) as domains,
    string_agg(publisher_domain || '=' || n, ' ' order by publisher_domain) as domain_counts
  from domain_ranks where rank <= 10 group by topic_id),
bucket_lists as (
  select topic_id, string_agg(bucket_start || '=' || n, ' ' order by bucket_start) as counts_by_bucket
  from (select topic_id, strftime(published_at, '%Y-%m-%d') as bucket_start, count(*) as n from kept group by 1, 2)
  group by topic_id),
chosen as (
  select topic_id, string_agg(url, ' ' order by rank) as representative_urls, list(lower(title)) as titles
  from representatives where rank <= 5 group by topic_id),
records as (
  select 'run-1' as run_id, s.*,
    sha256('{{"kw": [' || array_to_string(list_transform(k.keywords[1:10], lambda x: '"' || x || '"'), ', ')
      || '], "pub": [' || array_to_string(list_transform(d.domains, lambda x: '"' || x || '"'), ', ') || ']}}')
      as topic_signature,
    k.keywords, d.domains, d.domain_counts, b.counts_by_bucket, c.representative_urls, c.titles
  from stats s join keyword_lists k using (topic_id) join domain_lists d using (topic_id)
  join bucket_lists b using (topic_id) join chosen c using (topic_id))"""

SCORED = f"""{RECORDS},
parts as (
  select *, least(100, 20 * log10(topic_volume + 1) + 20) as volume_score,
    least(100, 100 * exp(-(epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_seen_at)) / 3.6e9 / 24))
      as velocity_score,
    least(100, 60 * avg_source_weight
      + case when unique_domains > 1 then least(40, 15 * log10(unique_domains) + 15) else 0 end) as source_score,
    cast(case when list_has_any(keywords, ['las', 'und', 'quega'])
      or len(list_filter(titles, lambda t: contains(t, 'las') or contains(t, 'und') or contains(t, 'quega'))) > 0
      then 80 else 0 end as double) as watchlist_bonus
  from records),
scored as (
  select *, round(volume_score * 0.25 + velocity_score * 0.35 + source_score * 0.30 + watchlist_bonus * 0.10, 2)
    as narrative_signal_score
  from parts)"""

ORACLES["canonical_urls"] = f"""
with c as (select page_id, url, {canonical("url")} as canonical_url from pages)
select page_id, canonical_url, {host("canonical_url")} as netloc, substr(sha256(canonical_url), 1, 16) as item_id,
  lower(regexp_extract(url, '^[^/]*//[^/?#]*')) || regexp_extract(url, '^[^/]*//[^/?#]*([^#]*)', 1) as with_params
from c"""

ORACLES["publisher_domains"] = f"""
select page_id, lower({domain("url")}) as publisher_domain from pages"""

ORACLES["content_hashes"] = f"""
with {ENTRIES}
select seq, sha256({squeeze("lower(title || ' ' || summary)")}) as content_hash from entries"""

ORACLES["feed_dates"] = f"""
with e as (select event_id, ts, date_trunc('second', ts) as s from events)
select event_id, {iso("s + interval 5 hour")} as from_rfc822, {iso("s - interval 8 hour")} as from_iso8601,
  {iso("ts - interval 8 hour")} as exact, {iso("ts - interval 8 hour")} as from_taipei, true as unparsed
from e"""

ORACLES["item_rows"] = f"""
with {ITEMS}
select seq, run_id, item_id, canonical_url, publisher_domain, {iso("published_at")} as published_at, source_name,
  source_weight, title, summary, has_summary, text_len, content_hash, topic_id
from items"""

ORACLES["lookback_items"] = f"""
with {ENTRIES}
select seq, source_name, {iso("published_at")} as published_at from entries
where published_at >= timestamp '2024-01-31 00:00:00' - interval {LOOKBACK_DAYS} day"""

ORACLES["first_items_per_feed"] = f"""
with {ENTRIES}
select seq, source_name, title
from (select *, row_number() over (partition by source_name order by seq) as place from entries)
where place <= {FEED_LIMIT}"""

ORACLES["items_per_feed"] = "select source as source_name, count(*) as n_items from documents group by source"

ORACLES["deduplicated_items"] = f"""
with {DEDUPED}
select seq, pos, item_id, canonical_url, content_hash, source_weight, {iso("published_at")} as published_at, title, summary
from kept"""

ORACLES["dedupe_statistics"] = f"""
with {DEDUPED}
select (select count(*) from items) as original_count,
  (select count(*) from url_ranked where url_rank > 1) as duplicates_by_url,
  (select count(*) from hash_ranked where hash_rank > 1) as duplicates_by_hash,
  (select count(*) from kept) as final_count"""

ORACLES["topic_statistics"] = f"""
with {DEDUPED},{STATS}
select topic_id, topic_volume, unique_domains, round(avg_source_weight, 9) as avg_source_weight,
  round(duplicate_ratio, 9) as duplicate_ratio, first_pos, {iso("first_seen_at")} as first_seen_at,
  {iso("last_seen_at")} as last_seen_at
from stats"""

ORACLES["duplicate_ratios"] = f"""
with {ITEMS}
select topic_id, count(*) as topic_volume, round(1 - count(distinct content_hash) / count(*), 9) as duplicate_ratio
from items where topic_id <> -1 group by topic_id"""

ORACLES["daily_buckets"] = f"""
with {DEDUPED}
select topic_id, strftime(published_at, '%Y-%m-%d') as bucket_start, count(*) as n
from kept where topic_id <> -1 group by 1, 2"""

ORACLES["hourly_buckets"] = f"""
with {DEDUPED}
select topic_id, strftime(published_at, '%Y-%m-%dT%H:00:00+00:00') as bucket_start, count(*) as n
from kept where topic_id <> -1 group by 1, 2"""

ORACLES["top_domains"] = f"""
with {DEDUPED},{domain_ranks(host("canonical_url"))}
select topic_id, publisher_domain, n, cast(rank as int) as rank from domain_ranks where rank <= 10"""

ORACLES["representative_items"] = f"""
with {DEDUPED},{REPRESENTATIVES}
select topic_id, cast(rank as int) as rank, url, title, domain, {iso("published_at")} as published_at, summary
from representatives where rank <= 5"""

ORACLES["term_frequencies"] = f"""
with {ITEMS},{term_tables("items")}
select term, total from totals"""

ORACLES["word_pairs"] = rf"""
with {ITEMS},
tokens as (
  select seq, unnest(words) as word, generate_subscripts(words, 1) as pos
  from (select seq, regexp_extract_all(lower(title || ' ' || summary), '[\p{{L}}\p{{N}}_]{{2,}}') as words from items)),
known as (select word from tokens group by word having count(*) >= 2),
pairs as (
  select least(x.word, y.word) as a, greatest(x.word, y.word) as b, count(*) as n
  from tokens x join tokens y on x.seq = y.seq and y.pos between x.pos + 1 and x.pos + 5
  where x.word in (from known) and y.word in (from known) group by all),
cells as (
  select a, b, case when a = b then 2 * n else n end as n from pairs
  union all select b, a, n from pairs where a <> b),
sums as (select a as word, sum(n) as n from cells group by a),
total as (select sum(n) as n from cells)
select p.a, p.b, p.n, round(ln(c.n * cast(t.n as double) / (cast(x.n as double) * y.n)), 9) as weight
from pairs p join cells c using (a, b) join sums x on x.word = a join sums y on y.word = b cross join total t
where c.n * cast(t.n as double) / (cast(x.n as double) * y.n) > 1"""

ORACLES["topic_keywords"] = f"""
with {ITEMS},{term_tables("items")}
select topic_id, cast(rank as int) as rank, term, round(score, 9) as score from ranked_terms where rank <= 15"""

ORACLES["reduced_topics"] = f"""
with {ITEMS},{term_tables("items")},
stays as (select topic_id from sizes order by words desc, topic_id limit 4),
norms as (select topic_id, sqrt(sum(weight * weight)) as norm from weights group by topic_id),
close as (
  select a.topic_id, b.topic_id as merged_id, round(sum(a.weight * b.weight) / any_value(m.norm), 12) as closeness
  from weights a join weights b using (term) join norms m on m.topic_id = b.topic_id
  where a.topic_id not in (from stays) and b.topic_id in (from stays) group by 1, 2),
nearest as (
  select *, row_number() over (partition by topic_id order by closeness desc, merged_id) as place from close)
select s.topic_id, case when s.topic_id in (from stays) then s.topic_id
  else coalesce(n.merged_id, (select min(topic_id) from stays)) end as merged_id
from sizes s left join nearest n on n.topic_id = s.topic_id and n.place = 1"""

ORACLES["topic_records"] = f"""
with {RECORDS}
select run_id, topic_id, topic_signature, array_to_string(keywords, ' ') as top_keywords, topic_volume, unique_domains,
  array_to_string(domains, ' ') as top_domains, domain_counts, counts_by_bucket, representative_urls
from records"""

ORACLES["items_with_signature"] = f"""
with {RECORDS}
select k.seq, k.item_id, k.topic_id, coalesce(r.topic_signature, '') as topic_signature
from kept k left join records r using (topic_id)"""

ORACLES["score_breakdown"] = f"""
with {SCORED}
select topic_id, topic_signature, narrative_signal_score, round(volume_score, 6) as volume_score,
  round(velocity_score, 6) as velocity_score, round(source_score, 6) as source_score,
  round(watchlist_bonus, 6) as watchlist_bonus
from scored"""

ORACLES["top_topics"] = f"""
with {SCORED}
select topic_id, topic_signature, topic_volume, narrative_signal_score, array_to_string(keywords, ' ') as top_keywords
from scored order by narrative_signal_score desc, first_pos limit 5"""

WATCHED = "watched as (select distinct lower(w) as term from (select unnest(string_split(text, ' ')) as w from benchmark) where w <> '')"

ORACLES["watched_items"] = f"""
with {ITEMS},{WATCHED}
select seq, count(*) as n_terms from items join watched on contains(lower(title), term) group by seq"""

ORACLES["watched_scores"] = f"""
with {SCORED},{WATCHED},
flags as (
  select topic_id, list_has_any(keywords, (select list(term) from watched)) as in_keywords,
    exists (select 1 from watched w where len(list_filter(titles, lambda t: contains(t, w.term))) > 0) as in_titles,
    volume_score * 0.25 + velocity_score * 0.35 + source_score * 0.30 as others
  from scored)
select topic_id, in_keywords, in_titles, cast(case when in_keywords or in_titles then 80 else 0 end as double) as watchlist_bonus,
  round(others + case when in_keywords or in_titles then 80 else 0 end * 0.10, 2) as narrative_signal_score
from flags"""

CLUSTERS = """
points as (
  select vec_id as id, [list_avg(embedding[1:13]::double[]), list_avg(embedding[14:26]::double[]),
    list_avg(embedding[27:39]::double[]), list_avg(embedding[40:52]::double[]),
    list_avg(embedding[53:64]::double[])] as vector
  from embeddings),
near as (
  select a.id as a, b.id as b from points a cross join points b
  where list_distance(a.vector, b.vector) <= 0.026),
core as (select a as id from near group by a having count(*) >= 3),
edges as (select a, b from near where a in (from core) and b in (from core)),
reached(id, root) as (
  select id, id from core
  union
  select e.b, r.root from reached r join edges e on e.a = r.id where r.root < e.b),
roots as (select id, min(root) as root from reached group by id),
sizes as (select root, count(*) as size from roots group by root having count(*) >= 3),
topic_ids as (select root, row_number() over (order by size desc, root) - 1 as topic_id from sizes),
assigned as (
  select p.id, cast(coalesce(t.topic_id, -1) as int) as topic_id
  from points p left join roots r using (id) left join topic_ids t using (root))"""

ORACLES["density_topics"] = f"with recursive {CLUSTERS} select id, topic_id from assigned"

ORACLES["nearest_neighbours"] = """
with pairs as (
  select a.vec_id, b.vec_id as other_id, list_distance(a.embedding::double[], b.embedding::double[]) as distance
  from embeddings a join embeddings b on a.vec_id <> b.vec_id),
ranked as (select *, row_number() over (partition by vec_id order by distance, other_id) as place from pairs)
select vec_id, cast(place as int) as place, other_id, round(distance, 6) as distance, 1.0::double as recall
from ranked where place <= 10"""

ORACLES["cluster_statistics"] = f"""
with recursive {CLUSTERS}
select count(*) as n_items, count(distinct topic_id) filter (topic_id <> -1) as n_topics,
  count(*) filter (topic_id = -1) as noise_count,
  round(count(*) filter (topic_id = -1) / count(*), 9) as noise_ratio, false as degraded
from assigned"""

LINES = f"""{ENTRIES},
lines as (
  select d.doc_id, d.source, e.published_at, unnest(string_split(d.text, chr(10))) as line,
    generate_subscripts(string_split(d.text, chr(10)), 1) - 1 as i, len(string_split(d.text, chr(10))) as n_lines
  from documents d join entries e on e.seq = d.doc_id),
read as (
  select *, {strip("line")} as title, 'https://www.example.co.uk/' || doc_id || '/' || i || '?b=2' as canonical_url,
    doc_id % 2 = 1 or i % 2 = 0 as has_summary
  from lines where not (doc_id % 5 = 0 and i = n_lines - 1))"""

# The place of an entry is counted over all documents of its feed.
PLACED = """
sizes as (select source, doc_id, max(i) + 1 as size from read group by source, doc_id),
starts as (
  select *, coalesce(sum(size) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as start
  from sizes),
placed as (
  select r.*, cast(s.start + r.i as bigint) as place,
    cast(cast(substr(r.source, 4) as bigint) * 4294967296 + s.start + r.i as bigint) as seq
  from read r join starts s using (source, doc_id))"""

ORACLES["feed_scan"] = f"""
with {LINES},
{PLACED},
filled as (select *, case when has_summary then 'line ' || i else title end as summary from placed where title <> '')
select seq, substr(sha256(canonical_url), 1, 16) as item_id, canonical_url, 'example.co.uk' as publisher_domain,
  source as source_name, 1.0::double as source_weight, title, summary, has_summary,
  cast(length(title) + length(summary) as int) as text_len,
  {iso("date_trunc('second', published_at)")} as published_at,
  case when doc_id % 2 = 0 then source else 'writer ' || (doc_id % 7) end as publisher_name, 'en' as language
from filled"""

ORACLES["split_feed_scan"] = f"""
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i
  from documents)
select source as feed, 'http://example.com/' || doc_id || '/' || i as link, {strip("line")} as title from lines"""

ORACLES["collected_items"] = f"""
with {LINES},{PLACED}
select seq, substr(sha256(canonical_url), 1, 16) as item_id, source as source_name, title,
  {iso("date_trunc('second', published_at)")} as published_at
from placed where title <> '' and source <> 'src3' and place < {FEED_LIMIT}
  and date_trunc('second', published_at) >= timestamp '2024-01-31 00:00:00' - interval {4 * LOOKBACK_DAYS} day"""

ORACLES["deduplicated_feed_items"] = f"""
with {LINES},{PLACED},
full_rows as (
  select *, date_trunc('second', published_at) as published, case when has_summary then 'line ' || i else title end as summary
  from placed where title <> ''),
hashed as (
  select *, sha256({squeeze("lower(title || ' ' || summary)")}) as content_hash from full_rows),
by_hash as (
  select *, min(seq) over (partition by content_hash) as pos,
    row_number() over (partition by content_hash order by published desc, seq) as place_in_hash
  from hashed)
select seq, pos, substr(sha256(canonical_url), 1, 16) as item_id from by_hash where place_in_hash = 1"""

ORACLES["unregistered_feeds"] = f"""
with {LINES}
select source as feed, count(*) as n_entries from read where source = 'src3' group by source"""

ORACLES["unreadable_feeds"] = """
select doc_id, source as feed from documents where doc_id % 5 = 0 and len(string_split(text, chr(10))) = 1"""


def signature(label: str) -> str:
    return f"""sha256('{{"kw": ["topic' || {label} || '"], "pub": []}}')"""


RUN_ITEMS = f"""{DEDUPED},
run_items as (
  select * exclude (run_id), source_name as run_id, {signature("topic_id")} as topic_signature,
    published_at < timestamp '2024-01-16 00:00:00' as early
  from kept)"""


def runs_of(name: str, where: str, status: str) -> str:
    return f"""
{name} as (
  select run_id, max(published_at) as generated_at, cast(7 as int) as lookback_days,
    substr(sha256('{{"dedupe_strategy": "url_then_hash", "lookback_days": 7}}'), 1, 16) as config_hash,
    '{status}' as status, count(*) as fetched_count, nullif(count(*) filter (not has_summary), 0) as without_summary
  from run_items where {where} group by run_id)"""


def topics_of(name: str, where: str) -> str:
    return f"""
{name}_stats as (
  select run_id, topic_id, count(*) as topic_volume, count(distinct publisher_domain) as unique_domains,
    avg(source_weight) as avg_source_weight, max(published_at) as last_seen_at, min(pos) as first_pos
  from run_items where topic_id <> -1 and {where} group by 1, 2),
{name} as (
  select run_id, {signature("topic_id")} as topic_signature, topic_id, topic_volume, unique_domains, first_pos,
    round(0.25 * least(100, 20 * log10(topic_volume + 1) + 20)
      + 0.35 * least(100, 100 * exp(-(epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_seen_at)) / 3.6e9 / 24))
      + 0.30 * least(100, 60 * avg_source_weight
        + case when unique_domains > 1 then least(40, 15 * log10(unique_domains) + 15) else 0 end), 2)
      as narrative_signal_score
  from {name}_stats)"""


def buckets_of(name: str, ts: str) -> str:
    return f"""
{name} as (
  select run_id, {signature("topic_id")} as topic_signature, date_trunc('day', {ts}) as bucket_start, count(*) as n
  from run_items where topic_id <> -1 group by 1, 2, 3)"""


BUCKET_START = iso("cast(bucket_start as timestamp)")

ORACLES["upserted_runs"] = f"""
with {RUN_ITEMS},{runs_of("before", "early", "running")},{runs_of("after", "not early", "completed")}
select run_id, {iso("coalesce(b.generated_at, a.generated_at)")} as generated_at,
  coalesce(b.lookback_days, a.lookback_days) as lookback_days, coalesce(b.config_hash, a.config_hash) as config_hash,
  coalesce(a.status, b.status) as status, coalesce(a.fetched_count, b.fetched_count) as fetched_count,
  case when a.status is null then b.without_summary else a.without_summary end as without_summary
from before b full outer join after a using (run_id)"""

ORACLES["inserted_items"] = f"""
with {RUN_ITEMS}
select run_id, item_id, case when early then title else 'again: ' || title end as title from run_items"""

ORACLES["upserted_topics"] = f"""
with {RUN_ITEMS},{topics_of("before", "early")},{topics_of("after", "not early")}
select run_id, topic_signature, coalesce(b.topic_id, a.topic_id) as topic_id,
  coalesce(a.topic_volume, b.topic_volume) as topic_volume,
  coalesce(b.unique_domains, a.unique_domains) as unique_domains,
  coalesce(a.narrative_signal_score, b.narrative_signal_score) as narrative_signal_score
from before b full outer join after a using (run_id, topic_signature)"""

ORACLES["upserted_buckets"] = f"""
with {RUN_ITEMS},{buckets_of("before", "published_at")},{buckets_of("after", "published_at + interval 10 day")}
select run_id, topic_signature, {BUCKET_START} as bucket_start, coalesce(a.n, b.n) as n
from before b full outer join after a using (run_id, topic_signature, bucket_start)"""

ORACLES["purged_items"] = f"""
with {RUN_ITEMS}
select run_id, item_id, topic_id from run_items
where run_id not in (select run_id from run_items where source_weight < 0.6)"""

ORACLES["orphan_buckets"] = f"""
with {RUN_ITEMS},{topics_of("parents", "early")},{buckets_of("children", "published_at")}
select run_id, topic_signature, {BUCKET_START} as bucket_start, n
from children anti join parents using (run_id, topic_signature)"""

ORACLES["latest_runs"] = f"""
with {RUN_ITEMS},{runs_of("runs", "true", "completed")}
select run_id, status, {iso("generated_at")} as generated_at
from (select * from runs order by generated_at desc, run_id limit 5)"""

ORACLES["items_per_run"] = f"""
with {RUN_ITEMS}
select run_id, count(*) as item_count from run_items group by run_id"""

ORACLES["best_topics"] = f"""
with {RUN_ITEMS},{topics_of("found", "true")}
select run_id, topic_signature, topic_volume, narrative_signal_score from found
order by narrative_signal_score desc, run_id, topic_signature limit 10"""

ORACLES["bucket_summary"] = f"""
with {RUN_ITEMS},{buckets_of("buckets", "published_at")}
select run_id, count(distinct topic_signature) as topic_count, count(*) as bucket_count from buckets group by run_id"""

ORACLES["topic_history"] = f"""
with {RUN_ITEMS},{topics_of("found", "true")}
select run_id, topic_volume, narrative_signal_score from found where topic_signature = {signature("'3'")}"""

ORACLES["items_published"] = f"""
with {RUN_ITEMS}
select run_id, item_id, {iso("published_at")} as published_at from run_items
where published_at >= timestamp '2024-01-10' and published_at < timestamp '2024-01-12'"""

ORACLES["run_statistics"] = f"""
with {DEDUPED}
select (select count(*) from items) as fetched_count, count(*) as deduped_count,
  count(distinct topic_id) filter (topic_id <> -1) as topic_count,
  round(count(*) filter (topic_id = -1) / count(*), 9) as noise_ratio,
  round(count(*) filter (topic_id <> -1 and not has_summary) / count(*) filter (topic_id <> -1), 9)
    as missing_summary_ratio
from kept"""

ORACLES["run_summary"] = f"""
with {SCORED}
select topic_id, format('{{:.1f}}', narrative_signal_score) as score, topic_volume,
  array_to_string(keywords[1:5], ', ') as keywords
from scored order by narrative_signal_score desc, first_pos limit 5"""

# The chain from items through clusters: items share the vectors of the embeddings.
CHAIN = f"""{DEDUPED},
points as (
  select k.seq as id, [list_avg(embedding[1:13]::double[]), list_avg(embedding[14:26]::double[]),
    list_avg(embedding[27:39]::double[]), list_avg(embedding[40:52]::double[]),
    list_avg(embedding[53:64]::double[])] as vector
  from documents d join kept k on k.seq = d.doc_id
  join embeddings e on e.vec_id = d.doc_id % (select count(*) from embeddings)),
near as (
  select a.id as a, b.id as b from points a cross join points b
  where list_distance(a.vector, b.vector) <= 0.036),
core as (select a as id from near group by a having count(*) >= 3),
edges as (select a, b from near where a in (from core) and b in (from core)),
reached(id, root) as (
  select id, id from core
  union
  select e.b, r.root from reached r join edges e on e.a = r.id where r.root < e.b),
roots as (select id, min(root) as root from reached group by id),
root_sizes as (select root, count(*) as size from roots group by root having count(*) >= 4),
topic_ids as (select root, row_number() over (order by size desc, root) - 1 as topic_id from root_sizes),
assigned as (
  select k.* exclude (topic_id), cast(coalesce(t.topic_id, -1) as int) as topic_id
  from kept k left join roots r on r.id = k.seq left join topic_ids t using (root))"""

ORACLES["clustered_items_with_noise"] = f"with recursive {CHAIN} select seq, item_id, topic_id from assigned"

ORACLES["clustered_items"] = f"with recursive {CHAIN} select seq, item_id, topic_id from assigned where topic_id <> -1"

ORACLES["degraded_clusters"] = f"""
with {DEDUPED}
select cast(1 as bigint) as n, count(*) as in_topic_0, count(*) as n_items, cast(1 as bigint) as n_topics,
  cast(0 as bigint) as noise_count, 0.0::double as noise_ratio, true as degraded
from kept"""

REDUCED = f"""{CHAIN},{term_tables("assigned")},
stays as (
  select topic_id from assigned where topic_id <> -1 group by topic_id order by count(*) desc, topic_id limit 3),
norms as (select topic_id, sqrt(sum(weight * weight)) as norm from weights group by topic_id),
close as (
  select a.topic_id, b.topic_id as merged_id, round(sum(a.weight * b.weight) / any_value(m.norm), 12) as closeness
  from weights a join weights b using (term) join norms m on m.topic_id = b.topic_id
  where a.topic_id not in (from stays) and b.topic_id in (from stays) group by 1, 2),
nearest as (
  select *, row_number() over (partition by topic_id order by closeness desc, merged_id) as place from close),
merged as (
  select s.topic_id, case when s.topic_id in (from stays) then s.topic_id
    else coalesce(n.merged_id, (select min(topic_id) from stays)) end as merged_id
  from sizes s left join nearest n on n.topic_id = s.topic_id and n.place = 1),
joined as (select a.*, m.merged_id from assigned a join merged m using (topic_id)),
renumbered as (
  select merged_id, cast(row_number() over (order by count(*) desc, min(pos)) - 1 as int) as new_id from joined group by 1)"""

ORACLES["reduced_run"] = f"""
with recursive {REDUCED}
select seq, item_id, new_id as topic_id from joined join renumbered using (merged_id)"""

ORACLES["reduced_run_statistics"] = f"""
with recursive {REDUCED}
select (select count(*) from items) as fetched_count, count(*) as deduped_count,
  (select count(*) from renumbered) as topic_count,
  round(count(*) filter (topic_id = -1) / count(*), 9) as noise_ratio,
  coalesce(round(count(*) filter (topic_id <> -1 and not has_summary) / nullif(count(*) filter (topic_id <> -1), 0), 9), 0)
    as missing_summary_ratio
from assigned"""

ORACLES["run_keywords"] = f"""
with {RUN_ITEMS},{term_tables("run_items")}
select run_id, topic_id, cast(rank as int) as rank, term, round(score, 9) as score from ranked_terms where rank <= 15"""

ORACLES["run_top_topics"] = f"""
with {RUN_ITEMS},{topics_of("found", "true")},
ranked as (
  select *, row_number() over (partition by run_id order by narrative_signal_score desc, first_pos, topic_id) as rank from found)
select run_id, cast(rank as int) as rank, topic_id, topic_volume, narrative_signal_score from ranked where rank <= 2"""

ORACLES["items_by_hash"] = f"""
with {RUN_ITEMS}
select run_id, item_id, content_hash from run_items where content_hash = (select min(content_hash) from run_items)"""

ORACLES["items_by_signature"] = f"""
with {RUN_ITEMS} select run_id, item_id from run_items where topic_id = 5"""

ORACLES["runs_by_status"] = f"""
with {RUN_ITEMS}
select run_id, 'completed' as status, count(*) as fetched_count from run_items
where run_id in (select run_id from run_items where not early) group by run_id"""

ORACLES["buckets_in_range"] = f"""
with {RUN_ITEMS},{buckets_of("buckets", "published_at")}
select run_id, topic_signature, {BUCKET_START} as bucket_start, n from buckets
where bucket_start >= timestamp '2024-01-10' and bucket_start < timestamp '2024-01-12'"""

ORACLES["orphan_items"] = f"""
with {RUN_ITEMS}
select run_id, item_id from run_items where run_id not in (select run_id from run_items where source_weight >= 0.6)"""

ORACLES["orphan_topics"] = f"""
with {RUN_ITEMS},{topics_of("found", "true")}
select run_id, topic_signature, topic_volume from found
where run_id not in (select run_id from run_items where source_weight >= 0.6)"""

STORED_ITEMS = f"""
with {RUN_ITEMS}
select item_id, run_id, canonical_url, {iso("published_at")} as published_at, '2024-01-31T00:00:00+00:00' as fetched_at,
  source_weight, case when early then title else 'again: ' || title end as title, summary, has_summary, text_len,
  content_hash, topic_id, topic_signature, source_name as publisher_name, cast(null as varchar) as market
from run_items where run_id = 'src3'"""
ORACLES["stored_items"] = ORACLES["stored_items_json"] = STORED_ITEMS

# Topic records of every run; the signature has the first ten keywords and five domains.
RUN_RECORDS = f"""{RUN_ITEMS},{topics_of("found", "true")},{term_tables("run_items")},
keyword_lists as (
  select run_id, topic_id, list(term order by rank) as keywords from ranked_terms where rank <= 15 group by all),
domain_ranks as (
  select *, row_number() over (partition by run_id, topic_id order by n desc, first_pos) as rank
  from (select run_id, topic_id, publisher_domain, count(*) as n, min(pos) as first_pos
        from run_items where topic_id <> -1 group by all)),
domain_lists as (
  select run_id, topic_id, list(publisher_domain order by rank) as domains from domain_ranks where rank <= 5 group by all),
chosen as (
  select run_id, topic_id, string_agg(canonical_url, ' ' order by place) as representative_urls
  from (select *, row_number() over (
          partition by run_id, topic_id order by source_weight desc, published_at desc, pos) as place
        from run_items where topic_id <> -1)
  where place <= 5 group by all),
records as (
  select s.run_id, s.topic_id, s.topic_volume, s.unique_domains, s.avg_source_weight, s.last_seen_at,
    sha256('{{"kw": [' || coalesce(array_to_string(list_transform(k.keywords[1:10], lambda x: '"' || x || '"'), ', '), '')
      || '], "pub": [' || array_to_string(list_transform(d.domains, lambda x: '"' || x || '"'), ', ') || ']}}')
      as topic_signature,
    coalesce(array_to_string(k.keywords, ' '), '') as top_keywords, array_to_string(d.domains, ' ') as top_domains,
    c.representative_urls, f.narrative_signal_score
  from found_stats s join found f using (run_id, topic_id) left join keyword_lists k using (run_id, topic_id)
  join domain_lists d using (run_id, topic_id) join chosen c using (run_id, topic_id)),
unique_records as (
  select * from records
  qualify row_number() over (partition by run_id, topic_signature order by narrative_signal_score desc, topic_id) = 1)"""

STORED_TOPICS = f"""
with {RUN_RECORDS}
select run_id, topic_id, topic_signature, top_keywords,
  topic_volume + case when topic_volume > 3 then 1000 else 0 end as topic_volume, unique_domains,
  round(avg_source_weight, 9) as avg_source_weight, {iso("last_seen_at")} as last_seen_at, representative_urls, top_domains,
  narrative_signal_score
from unique_records where run_id = 'src3'"""
ORACLES["stored_topics"] = ORACLES["stored_topics_json"] = STORED_TOPICS

STORED_BUCKETS = """
stored_buckets as (
  select run_id, u.topic_signature, date_trunc('day', published_at) as bucket_start, count(*) as n
  from run_items i join unique_records u using (run_id, topic_id) group by all)"""

ORACLES["stored_buckets"] = f"""
with {RUN_RECORDS},{STORED_BUCKETS}
select run_id, topic_signature, {BUCKET_START} as bucket_start, n from stored_buckets"""

ORACLES["exported_items"] = f"""
with {RUN_ITEMS}
select item_id, title, replace({iso("published_at")}, 'T', ' ') as published_at, topic_id from run_items where run_id = 'src3'"""

ORACLES["exported_topics"] = f"""
with {RUN_RECORDS}
select cast(row_number() over (order by narrative_signal_score desc, topic_id) - 1 as int) as place, run_id, topic_id,
  topic_signature, topic_volume, replace({iso("last_seen_at")}, 'T', ' ') as last_seen_at, narrative_signal_score
from records where run_id = 'src3' order by narrative_signal_score desc, topic_id limit 3"""

ORACLES["purged_tables"] = f"""
with {RUN_RECORDS},{STORED_BUCKETS},
everything as (
  select 'runs' as stored_in, run_id from run_items group by all
  union all select 'items', run_id from run_items
  union all select 'topics', run_id from unique_records
  union all select 'topic_buckets', run_id from stored_buckets)
select stored_in, run_id, count(*) as n_rows from everything where run_id not in ('src1', 'src2') group by all"""

ORACLES["flat_topics"] = f"""
with {RUN_RECORDS},
days as (
  select run_id, topic_id, strftime(published_at, '%Y-%m-%d') as bucket_start, count(*) as n from run_items group by all),
listed as (
  select run_id, topic_id, '[' || string_agg('{{"bucket_start":"' || bucket_start || '","count":' || n || '}}', ',' order by bucket_start)
    || ']' as counts_by_bucket
  from days group by all)
select run_id, topic_signature, counts_by_bucket from records join listed using (run_id, topic_id)"""

# The keyed tables hold what the plain ones do.
ORACLES["file_upserted_topics"] = ORACLES["upserted_topics"]
ORACLES["file_items_by_hash"] = ORACLES["items_by_hash"]
ORACLES["stored_items_files"] = STORED_ITEMS
ORACLES["stored_topics_files"] = ORACLES["stored_topics"]
ORACLES["purged_tables_files"] = ORACLES["purged_tables"]

ORACLES["stored_items_by_url"] = f"""
with {RUN_ITEMS}
select run_id, item_id, canonical_url, topic_id from run_items
where canonical_url = (select min(canonical_url) from run_items)"""

ORACLES["exported_run_items"] = f"""
with {RUN_ITEMS}
select item_id, title, replace({iso("published_at")}, 'T', ' ') as published_at, topic_id, run_id from run_items"""

ORACLES["exported_run_topics"] = f"""
with {RUN_RECORDS},
placed as (
  select *, cast(row_number() over (partition by run_id order by narrative_signal_score desc, topic_id) - 1 as int) as place
  from records)
select place, run_id, topic_id, topic_signature, topic_volume, replace({iso("last_seen_at")}, 'T', ' ') as last_seen_at,
  narrative_signal_score
from placed where place < 3"""
