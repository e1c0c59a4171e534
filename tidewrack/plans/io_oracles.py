"""SQL of the queries of sources and sinks: what must come out, straight from the tables."""

from __future__ import annotations

from tidewrack.operators.feeds import DEFAULT_FEEDS
from tidewrack.operators.quality import ADULT_WORDS, ADULT_WORDS_DOMAIN

from .oracles import _VERS, SQL, _postings, _shard

_GOOD_DOMAIN = rf"length(t) > 0 and length(t) <= 253 and not regexp_matches(t, '[^a-z0-9.-]') and not starts_with(t, '.') and not ends_with(t, '.') and not regexp_matches(t, '(?i)\b({ADULT_WORDS_DOMAIN})\b')"
_GOOD_HOST = rf"length(t) > 0 and length(t) <= 253 and not starts_with(t, '*.') and not regexp_matches(t, '(?i)\.(onion|zip|invalid|local|localhost|test|example)$') and not regexp_matches(t, '(?i)\b({ADULT_WORDS})\b') and contains(t, '.')"

SQL["ndjson_read"] = "select u, t, d, c, l, s from raw_docs where u is not null and u <> ''"
SQL["warc_pages"] = "select u as uri, '<p>' || coalesce(c, '') || '</p>' || chr(10) || chr(10) as html, count(*) as n from raw_docs where u is not null group by 1, 2"
SQL["path_list"] = "select 'data/' || coalesce(warc, 'none') || '.warc.gz' as path, count(*) as n from raw_docs group by 1"
SQL["object_listing"] = "select unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'raw_docs', 'crawled_docs', 'ct_seeds', 'gdelt_mentions', 'site_hosts', 'toxicity_labels', 'lang_samples', 'common_words']) as name"
SQL["listing_slices"] = """with n as (select distinct 'raw/' || warc as path from raw_docs where warc is not null), m as (select path || '.ndjson.gz' as path from n)
 select * from (select 'cursor' as part, path from n order by path limit 5 offset 3) union all select * from (select 'newest', path from m order by path desc limit 12)
 union all select * from (select 'first', path from n order by path limit 4) union all select * from (select 'second', path from m order by path limit 6)"""
SQL["sample_scan"] = "select rec_id, u, src from raw_docs where src in (select distinct src from raw_docs where src is not null order by src limit 2)"
SQL["conversion"] = "select tier, lang, status, count(*) as n, count(text) as texts, sum(length(text))::bigint as chars from crawled_docs, (select unnest(['warm', 'cold']) as tier) where u is not null and u <> '' group by 1, 2, 3"
SQL["conversion_candidates"] = "select 'shards/' || lpad(o_orderkey::varchar, 10, '0') as key, o_orderdate::timestamp as ts from orders where o_orderdate::timestamp < timestamp '1998-05-25' order by 1 limit 500"
SQL["mention_archives"] = "select u, coalesce(host, '') as host, round(coalesce(tone, 0), 6) as tone, count(*) as n from gdelt_mentions where regexp_matches(u, '^https?://') and batch_ts is not null group by 1, 2, 3"
SQL["mention_master_list"] = "select distinct 'http://m.example.org/v2/' || strftime(batch_ts, '%Y%m%d%H%M') || '00.mentions.CSV.zip' as url from gdelt_mentions where batch_ts <= (select min(batch_ts) + interval 2 days from gdelt_mentions)"
SQL["feed_links"] = "with x as (select crawl_id, list_filter(links, lambda l: regexp_matches(l, '^https?:'))[1:40] as l from crawled_docs), y as (select crawl_id, unnest(l) as u from x) select crawl_id, u, count(*) as n from y group by 1, 2"
SQL["feed_list"] = "select unnest([" + ", ".join(f"'{u}'" for u in DEFAULT_FEEDS) + "]) as url"
_ROBOTS = "r as (select host, incoming % 3 as k from site_hosts), s as (select host, 'https://' || host || '/sitemap.xml' as sitemap, 1 as p from r where k <> 2 union all select host, 'https://' || host || '/' || unnest(['index.xml', 'more.xml']), unnest([0, 1]) from r where k = 2)"
SQL["robots_sitemaps"] = f"with {_ROBOTS} select host, sitemap from s"
SQL["sitemap_harvest"] = f"""with {_ROBOTS}, x as (select host, 'only' as p from r where k <> 2 union all select host, 'p' || unnest(range(6, 26)) || 'a' from r where k = 2 union all select host, 'common' from r where k = 2)
 select host, 'https://' || host || '/' || p as u from x"""
SQL["sitemap_simple"] = "select host, 'https://' || host || '/only' as u from site_hosts where incoming % 2 = 0"
_LAST2 = "array_to_string(string_split(lower(t), '.')[-2:], '.')"
SQL["zone_domains"] = rf"select distinct {_LAST2} as domain from ct_seeds where regexp_full_match(t, '(?i)[a-z0-9-]+(\.[a-z0-9-]+)*') and ends_with(lower(t), 'org') and contains(t, '.')"
SQL["certificate_rows"] = f"with n as (select distinct unnest([lower(t), '*.' || t, 'nodot']) as t from ct_seeds) select t as domain from n where {_GOOD_DOMAIN}"
SQL["certificate_fallback"] = f"with n as (select distinct t from ct_seeds), h as (select t as host from n where {_GOOD_DOMAIN}), e as ({SQL['registered_names']}) select distinct etld1 as domain from h join e using (host) where etld1 is not null"
SQL["active_logs"] = """select trim(n_name) || ' log 2026!' as name, 'operator-' || n_regionkey || '-' || trim(regexp_replace(lower(trim(n_name) || ' log 2026!'), '[^a-z0-9]+', '-', 'g'), '-') as slug,
 'https://log' || n_nationkey || '.example.org' as url, 'Operator ' || n_regionkey as operator from nation where n_nationkey % 3 <> 2"""
_SEEDS = rf"select regexp_replace(coalesce(log, 'none'), '\W+', '-', 'g') as log, lower(t) as t, date_trunc('milliseconds', ts) as ts from ct_seeds where t is not null and ts is not null"
_NAMED = rf"from ({_SEEDS}) where regexp_full_match(t, '[a-z0-9*][a-z0-9.*-]*[a-z0-9]') and length(t) >= 3 and {_GOOD_HOST}"
SQL["log_seeds"] = f"select log, t, ts, count(*) as n {_NAMED} group by 1, 2, 3"
SQL["log_stream"] = f"select log, t, count(*) as n {_NAMED} group by 1, 2"
SQL["log_newest"] = f"select log, least(count(*), 2048) as n, greatest(count(*) - 2048, 0) as first, count(*) - 1 as last from ({_SEEDS}) group by 1"
SQL["log_heads"] = f"select log, case when count(*) <= 1024 then 0 else count(*) end as entry from ({_SEEDS}) group by 1"
SQL["sharded_write"] = f"""with f as (select u, min_by(c, rec_id) as c from (select u, rec_id, coalesce(c, chr(0)) as c from raw_docs where u is not null) group by u), g as (select {_shard("u", 128)} as shard, count(*) as docs, sum(case when c = chr(0) then 0 else strlen(c) end)::bigint as bytes from f group by 1)
 select k::int as shard, coalesce(docs, 0) as docs, coalesce(bytes, 0) as bytes from range(128) r(k) left join g on g.shard = k"""
SQL["sharded_json"] = f"with f as (select u, max(rec_id) as rec_id from raw_docs where u is not null group by u) select {_shard('u', 8)} as shard, count(*) as docs, sum(rec_id)::bigint as ids from f group by 1"
SQL["prune_sources"] = "select case when d <= 180 then 'warm' else 'cold' end as tier, count(*) as objects, sum(size)::bigint as bytes from (select trunc(o_totalprice)::bigint as size, epoch(timestamp '1998-08-01' - o_orderdate::timestamp) / 86400.0 as d from orders) where d > 7 group by 1"
SQL["file_times"] = "select o_orderkey, case o_orderkey % 4 when 2 then date_trunc('minute', o_orderdate::timestamp) when 3 then null else o_orderdate::timestamp end as at from orders"
SQL["number_prefixes"] = "select l_orderkey, l_linenumber, round(case l_linenumber % 4 when 1 then (l_extendedprice::decimal(12, 2)::varchar || 'e2')::double else l_extendedprice::decimal(12, 2)::double end, 4) as x, null::double as none from lineitem"
SQL["list_items"] = "select rec_id, array_to_string(list_filter(['a', coalesce(trim(warc), ''), 'b', trim(src)], lambda x: x <> ''), '|') as items from raw_docs"
_PART = lambda k, where: f"select {k} as batch_id, bucket, count(*) as postings, sum(tf)::bigint as tf from {_postings('raw_docs', 'rec_id', where)} group by bucket"
SQL["stored_index"] = _PART(0, "src = 'warc'") + " union all " + _PART(1, "coalesce(src, '') <> 'warc'")
SQL["versions_written"] = f"with {_VERS} select 'added' as op, count(*) as n from cur where (shard, hash) not in (select shard, hash from prev) union all select 'removed', count(*) from prev where (shard, hash) not in (select shard, hash from cur) union all select 'docs', count(*) from cur"
SQL["dated_batches"] = "select strftime(written_at, '%Y-%m-%d') as day, hour(written_at)::int as hour, count(*) as n, sum(crawl_id)::bigint as ids, 1::bigint as batches from crawled_docs where written_at is not null group by 1, 2"
SQL["run_counters"] = "select count(*) as rows, count(c) as texts, sum(length(c))::bigint as chars from raw_docs"
SQL["kept_table"] = "select src, count(*) as n, count(distinct u) as addresses from raw_docs where src is not null group by 1"
SQL["claims_left"] = "with s as (select warc as id, min(fetched_at) as claimed_at from raw_docs where warc is not null group by 1) select * from s where claimed_at >= timestamp '2025-06-01' - interval 60 days and ('0x' || substr(sha1(id), 1, 2))::int % 2 <> 0"
SQL["lookback_rebuild"] = f"""with f as (select u, min_by(coalesce(c, ''), rec_id) as c from raw_docs where fetched_at > timestamp '2025-06-20' - interval 30 days and fetched_at <= timestamp '2025-06-20' and u is not null group by u), g as (select {_shard("u", 16)} as shard, count(*) as docs, sum(strlen(c))::bigint as bytes from f group by 1)
 select k::int as shard, coalesce(docs, 0) as docs, coalesce(bytes, 0) as bytes from range(16) r(k) left join g on g.shard = k"""
SQL["capped_hosts"] = "select host, score from site_hosts order by score desc, host limit 3000"
SQL["file_cursor"] = "select 0 as run, count(*) filter (src = 'warc') as n, count(distinct rec_id) filter (src = 'warc') as ids from raw_docs union all select 1, count(*), count(distinct rec_id) from raw_docs"
SQL["flushed_seeds"] = "select strftime(ts, '%Y-%m-%d') as day, hour(ts)::int as hour, count(*) as n from ct_seeds where ts is not null group by 1, 2"
