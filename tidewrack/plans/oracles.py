"""SQL that gives the same rows as the core queries, written on its own from the definitions."""

from __future__ import annotations

from tidewrack.functions.text import STOP_WORDS
from tidewrack.functions.urls import TWO_LEVEL
from tidewrack.operators.quality import ADULT_WORDS, ADULT_WORDS_DOMAIN, ALLOWED_LANGS

SQL: dict[str, str] = {}


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


WS = r"[\s\v\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
U32 = "('0x' || substr(sha1({0}), 1, 8))::bigint"


def _shard(u: str, n: int) -> str:
    return f"({U32.format(u)} % {n})::int"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def _no_markup(x: str) -> str:
    for p in (r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", "<[^>]+>"):
        x = f"regexp_replace({x}, '{p}', ' ', 'g')"
    return x


def _decode(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _strip(x: str) -> str:
    return _collapse(_decode(_no_markup(x), [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")]))


def _strip_crawl(x: str) -> str:
    return _collapse(_decode(_no_markup(x), [("&nbsp;", " "), ("&#160;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&apos;", "''"), ("&quot;", '"')]))


_ESC = "replace(replace(coalesce({0}, ''), '&', '&amp;'), '<', '&lt;')"
_QUOTED = "replace(coalesce({0}, ''), '\"', '''')"
PAGES = f"""pages as (select rec_id, u as url, '<HTML dir="ltr" lang="' || coalesce(l, '') || '"><head><title class="x"> ' || {_ESC.format("t")} ||
 ' </title><meta charset="utf-8"><meta name="description" content="' || {_QUOTED.format("d")} || '"><meta property="og:title" content="' || {_QUOTED.format("t")} ||
 '"><style>p{{}}</style></head><body class="b"><script>var a="<p>";</script><nav><a href="/start#top">&nbsp;Start</a></nav><p>' || {_ESC.format("c")} ||
 '</p><a class="y" href="//cdn.example.org/a?b=1#c">x</a><a href="' || {_QUOTED.format("u")} || '">&quot;self&quot;</a><a href="mailto:x">m</a></body></HTML>' as html from raw_docs)"""

_SCHEME = "lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
_HOST = "lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)', 1))"


def host_port(u: str) -> str:
    h, s = _HOST.format(u), _SCHEME.format(u)
    return f"case {s} when 'http' then regexp_replace({h}, ':80$', '') when 'https' then regexp_replace({h}, ':443$', '') else {h} end"


def host_name(u: str) -> str:
    return f"regexp_replace({host_port(u)}, ':\\d*$', '')"


def bare_host(u: str) -> str:
    return f"regexp_replace({host_name(u)}, '^www\\.', '')"


def _resolve(href: str, base: str) -> str:
    s = f"lower(regexp_extract({base}, '^([A-Za-z]+):', 1))"
    full = f"case when regexp_matches({href}, '^(?i:https?)://') then {href} when starts_with({href}, '//') then {s} || ':' || {href} when starts_with({href}, '/') then {s} || '://' || {host_port(base)} || {href} end"
    return f"regexp_replace({full}, '#.*$', '')"


def _good(langs) -> str:
    adult = rf"(?i)\b({ADULT_WORDS})\b"
    return f"coalesce(length(t) >= 5 and length(c) >= 120 and coalesce(l, '') in ('', {_list(langs)}) and not regexp_matches(u, '(?i)\\.(zip|onion)$') and not regexp_matches(u, '{adult}') and not regexp_matches(t, '{adult}'), false)"


def _digest(source: str, key: str, body: str) -> str:
    """Digests of texts: signs of bit sums over tokens."""
    bits = ", ".join(f"sum(case when (b[{i // 8 + 1}] >> {i % 8}) & 1 = 1 then 1 else -1 end) > 0 as v{i}" for i in range(64))
    word = lambda a: " + ".join(f"(case when v{a + i} then {1 << (31 - i)}::bigint else 0 end)" for i in range(32))
    return f"""tok as (select {key}, unnest(list_filter(regexp_split_to_array(lower({body}), '[^A-Za-z0-9_]+'), lambda w: length(w) > 2)) as w from {source}),
 bytes as (select {key}, list_transform(range(8), lambda k: ('0x' || substr(md5(w), (2 * k + 1)::int, 2))::int) as b from tok),
 sums as (select {key}, {bits} from bytes group by {key}),
 digests as (select s0.{key}, coalesce(printf('%08x', {word(0)}) || printf('%08x', {word(32)}), '0000000000000000') as digest from {source} s0 left join sums using ({key}))"""


_TC = "concat_ws(' ', t, c)"
SQL["flagship"] = f"""with good as (select rec_id, u, t, c from raw_docs where {_good(ALLOWED_LANGS)}), {_digest("good", "rec_id", _TC)}
 select {_shard("u", 128)} as shard, count(*) as docs, sum(strlen(c))::bigint as bytes, max(digest) as max_digest from good join digests using (rec_id) group by 1"""
SQL["simhash_docs"] = f"with {_digest('raw_docs', 'rec_id', _TC)} select rec_id, digest from digests"


def _values(name: str, key: str, label: tuple[str, str] | None = None) -> str:
    """Values of an attribute of tags, by looking for ``key=`` in each opened tag; ``label`` is another attribute and its value."""
    opened = f"regexp_extract_all(html, '(?i)<{name}\\s[^<>]*>')"
    held = lambda k: f"""regexp_extract(tag, '(?i)\\s{k}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1)"""
    bare = lambda x: f"case when substr({x}, 1, 1) in ('\"', '''') then substr({x}, 2, length({x}) - 2) else {x} end"
    fit = f"list_filter({opened}, lambda tag: lower({bare(held(label[0]))}) = '{label[1]}')" if label else opened
    return f"list_filter(list_transform({fit}, lambda tag: {bare(held(key))}), lambda v: v <> '')"


_one = lambda x: f"coalesce({x}[1], '')"
_CANON, _DESC, _LANG = _values("link", "href", ("rel", "canonical")), _values("meta", "content", ("name", "description")), _values("html", "lang")
_OG = lambda k: _values("meta", "content", ("property", f"og:{k}"))
_TITLE = "case when strpos(lower(html), '</title') > 0 then split_part(substr(html, strpos(lower(html), '<title'), strpos(lower(html), '</title') - strpos(lower(html), '<title')), '>', 2) else '' end"
SQL["extract_pages"] = f"""with {PAGES} select coalesce({_CANON}[1], url) as u, substr({_strip(_TITLE)}, 1, 200) as t, substr({_one(_DESC)}, 1, 400) as d,
 substr({_strip("substr(html, greatest(1, strpos(lower(html), '<body')), 40000)")}, 1, 2000) as c, split_part(lower({_one(f"list_filter({_LANG}, lambda v: regexp_full_match(v, '[A-Za-z-]+'))")}), '-', 1) as l from pages"""
_pick = lambda *x: "coalesce(" + ", ".join(f"nullif({_collapse(v)}, '')" for v in x) + ", '')"
SQL["crawl_extract"] = f"""with {PAGES}, x as (select url as u, {_pick(_one(_OG("title")), _TITLE)} as t, {_pick(_one(_DESC), _one(_OG("description")))} as d, substr({_strip_crawl("html")}, 1, 2000) as text,
 nullif({_pick(_one(_CANON))}, '') as canonical, nullif({_pick(_one(_OG("image")))}, '') as image, nullif({_pick(_one(_LANG))}, '') as lang,
 list_filter(list_transform({_values("a", "href")}, lambda h: {_resolve("h", "url")}), lambda h: h is not null) as r from pages),
 y as (select u, row_number() over () as n, t, d, text, canonical, image, lang, r from x where t <> '' or text <> ''),
 z as (select n, unnest(r[1:128]) as link, generate_subscripts(r[1:128], 1) as k from y), f as (select n, link, min(k) as k from z group by n, link), g as (select n, list(link order by k)[1:64] as links from f group by n)
 select u, t, d, text, canonical, image, lang, coalesce(array_to_string(links, ' '), '') as links from y left join g using (n)"""
SQL["strip_tags"] = f"with {PAGES} select rec_id, {_strip('html')} as plain, {_strip_crawl('html')} as plain_crawl from pages"
_index_tokens = lambda x: f"list_filter(regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9]{{2,32}}'), lambda w: w not in ({_list(STOP_WORDS)}))"
SQL["tokens"] = f"""select rec_id, array_to_string({_index_tokens("c")}, ' ') as index_tokens, len(regexp_extract_all(lower(coalesce(c, '')), '[a-z0-9]{{3,}}'))::int as bloom_tokens,
 len(list_filter(regexp_split_to_array(lower(coalesce(t, '')), '[^A-Za-z0-9_]+'), lambda w: length(w) > 2))::int as digest_tokens, trim(regexp_replace(coalesce(u, ''), '[^A-Za-z0-9]+', ' ', 'g')) as words from raw_docs"""
SQL["quality_filter"] = f"select rec_id, u from raw_docs where {_good(ALLOWED_LANGS)}"
SQL["quality_filter_en"] = f"select rec_id, u from raw_docs where {_good(['en'])}"
SQL["quality_counts"] = f"select count(*) as seen, count(*) filter ({_good(ALLOWED_LANGS)}) as kept, count(*) filter (not {_good(ALLOWED_LANGS)}) as dropped from raw_docs"
SQL["cap_per_segment"] = "select warc, least(count(*), 60000) as n from raw_docs where warc is not null group by warc"
SQL["good_hosts"] = rf"""select distinct t as host from ct_seeds where length(t) > 0 and length(t) <= 253 and not starts_with(t, '*.') and not regexp_matches(t, '(?i)\.(onion|zip|invalid|local|localhost|test|example)$')
 and not regexp_matches(t, '(?i)\b({ADULT_WORDS})\b') and contains(t, '.')"""
SQL["seed_hosts"] = SQL["good_hosts"]
SQL["good_domains"] = rf"""select distinct t as host from ct_seeds where length(t) > 0 and length(t) <= 253 and not regexp_matches(t, '[^a-z0-9.-]') and not starts_with(t, '.') and not ends_with(t, '.')
 and not regexp_matches(t, '(?i)\b({ADULT_WORDS_DOMAIN})\b')"""

SQL["host_variants"] = f"select rec_id, {host_port('u')} as host_port, {host_name('u')} as host_name, {bare_host('u')} as bare_host from raw_docs"
SQL["registered_names"] = f"""with h as (select distinct t as host from ct_seeds), p as (select host, string_split(host, '.') as p from h)
 select host, case when len(p) < 2 then null when len(p) >= 3 and array_to_string(p[-2:], '.') in ({_list(TWO_LEVEL)}) then array_to_string(p[-3:], '.') else array_to_string(p[-2:], '.') end as etld1,
 case when len(p) >= 2 then array_to_string(p[-2:], '.') end as registrable from p"""
SQL["url_ids"] = f"""select rec_id, lower(to_base({U32.format("u")}, 36)) as hash, {_shard("u", 128)} as s128, {_shard("u", 16)} as s16, {_shard("u", 8)} as s8, substr(sha1(u), 1, 10) as key,
 lpad({_shard("u", 128)}::varchar, 3, '0') as shard_name, regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') as slug from raw_docs"""
SQL["resolved_links"] = f"""with x as (select crawl_id, u, unnest(links) as l from crawled_docs),
 y as (select crawl_id, u, case length(l) % 3 when 0 then regexp_replace(l, '^https?://[^/]*', '') when 1 then regexp_replace(l, '^https?:', '') else l || '#frag' end as href from x)
 select crawl_id, {_resolve("href", "u")} as link from y"""

SQL["dedup_exact_first"] = "select u, rec_id, t from raw_docs qualify row_number() over (partition by u order by rec_id) = 1"
SQL["dedup_last_wins"] = "select u, rec_id, t from raw_docs qualify row_number() over (partition by u order by rec_id desc) = 1"
SQL["dedup_prefix"] = "select rec_id, s from raw_docs qualify row_number() over (partition by substr(coalesce(s, ''), 1, 5) order by rec_id) = 1"
SQL["neardup_classes"] = """with c as (select s, count(*) as n, ('0x' || substr(s, 1, 8))::bigint as hi, ('0x' || substr(s, 9, 8))::bigint as lo from raw_docs where s is not null group by s),
 near as (select a.s, sum(b.n) as m from c a join c b on a.s <> b.s and bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 3 group by a.s)
 select rec_id, r.s as class_id, coalesce(c.n - 1 + coalesce(near.m, 0), 0)::bigint as n_links from raw_docs r left join c on c.s = r.s left join near on near.s = r.s"""

SQL["reshard_counts"] = f"select {_shard('u', 128)} as shard, count(*) as docs, coalesce(sum(strlen(c)), 0)::bigint as bytes from raw_docs group by 1"


def _hot(n: int, order: str) -> str:
    return f"""with one as (select u, c from raw_docs qualify row_number() over (partition by u order by rec_id {order}) = 1),
 k as (select {_shard("u", n)} as shard, count(*) as docs, coalesce(sum(strlen(c)), 0)::bigint as bytes from one group by 1)
 select r.range::int as shard, coalesce(docs, 0) as docs, coalesce(bytes, 0) as bytes from range({n}) r left join k on k.shard = r.range"""


SQL["hot_shards_16"], SQL["hot_shards_8"] = _hot(16, "asc"), _hot(8, "desc")
SQL["shard_manifest"] = f"""with k as (select {_shard("u", 128)} as shard, (rec_id % 3)::int as b, count(*) as docs from raw_docs group by all),
 l as (select shard, count(*) as n, string_agg('shards/batches/' || lpad(b::varchar, 6, '0') || '/shard-' || lpad(shard::varchar, 3, '0') || ':' || docs::varchar, ' ' order by b) as paths from k group by shard)
 select r.range::int as shard, coalesce(n, 0)::int as batches, coalesce(paths, '') as paths from range(128) r left join l on l.shard = r.range"""


def _postings(table: str, key: str, where: str = "true", k: str = "''") -> str:
    f = {"t": ("t", 1), "d": ("d", 2), "u": ("regexp_replace(coalesce(u, ''), '[^A-Za-z0-9]+', ' ', 'g')", 4), "k": (k, 8)}
    rows = " union all ".join(f"select u, substr(coalesce(t, ''), 1, 200) as t, substr(coalesce(d, ''), 1, 300) as d, unnest({_index_tokens(x)}) as term, {bit} as bit from last" for x, bit in f.values())
    return f"""(with last as (select * from {table} where u is not null and u <> '' and {where} qualify row_number() over (partition by u order by {key} desc) = 1), rows as ({rows})
 select ('0x' || substr(sha1(term), 1, 2))::int as bucket, term, u, count(*)::int as tf, bit_or(bit)::int as mask, any_value(t) as t, any_value(d) as d from rows group by term, u)"""


_RAW = _postings("raw_docs", "rec_id")
SQL["inverted_postings"] = f"select * from {_RAW}"
SQL["crawled_postings"] = f"""select bucket, term, u, tf, mask from {_postings("crawled_docs", "crawl_id", k="concat_ws(' ', coalesce(k, ''), substr(coalesce(text, ''), 1, 4000))")}"""
SQL["term_df"] = f"select bucket, term, count(*) as df, sum(tf)::bigint as cf from {_RAW} group by all"
SQL["bucket_stats"] = f"select bucket, count(distinct term) as terms, count(*) as postings from {_RAW} group by bucket"
SQL["search_and"] = f"select u, sum(tf)::bigint as tf, bit_or(mask) as mask from {_RAW} where term in ('guide', 'market') group by u having count(*) = 2"
SQL["search_ranked"] = f"""with p as {_RAW}, len as (select u, sum(tf) as len from p group by u), tot as (select count(*) as n, avg(len) as a from len), h as (select * from p where term in ('guide', 'market')),
 df as (select term, count(*) as df from h group by term),
 w as (select h.u, any_value(h.t) as t, count(*) as k, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))) as s from h join df using (term) join len using (u), tot group by h.u having count(*) = 2)
 select u, t, round(s * (1 + coalesce(score, 0) / 30.0), 6) as rank_score from w left join site_hosts on host = {bare_host("u")} order by rank_score desc, u limit 15"""
SQL["search_tier_merge"] = """with hot as (select u, t from crawled_docs qualify row_number() over (partition by u order by crawl_id) = 1), deep as (select u, t from raw_docs qualify row_number() over (partition by u order by rec_id) = 1)
 select u, t, 0 as tier from hot union all select u, t, 1 as tier from deep where u not in (select u from hot)"""
SQL["batch_union"] = "with p as (" + " union all ".join(f"select *, {k} as batch_id from {_postings('raw_docs', 'rec_id', f'rec_id % 3 = {k}')}" for k in range(3)) + ") select term, u, tf, mask, batch_id from p qualify row_number() over (partition by term, u order by batch_id desc) = 1"

_BLOOM = f"""terms as (select distinct {_shard("u", 128)} as shard, unnest(list_distinct((regexp_extract_all(lower(coalesce(t, '')), '[a-z0-9]{{3,}}') || regexp_extract_all(lower(coalesce(d, '')), '[a-z0-9]{{3,}}') || regexp_extract_all(lower(coalesce(c, '')), '[a-z0-9]{{3,}}'))[1:40])) as term from raw_docs),
 pos as (select distinct shard, ('0x' || substr(md5(term), (8 * i + 5)::int, 4))::bigint as p from terms, range(4) r(i))"""
SQL["bloom_words"] = f"with {_BLOOM} select shard, (p >> 6)::int as word, (sum(case when p & 63 < 63 then (1::hugeint << (p & 63)::int) else -(1::hugeint << 63) end))::bigint as bits from pos group by 1, 2"
SQL["bloom_fill"] = f"with {_BLOOM} select shard, count(*) as set_bits, round(count(*) / 65536.0::double, 8) as fill, round(pow(count(*) / 65536.0::double, 4), 8) as false_positive from pos group by shard"
SQL["bloom_probe"] = f"""with {_BLOOM}, w as (select distinct word as term from common_words), q as (select distinct term, ('0x' || substr(md5(term), (8 * i + 5)::int, 4))::bigint as p from w, range(4) r(i)),
 need as (select term, count(*) as n from q group by term) select q.term, shard from q join pos using (p) join need using (term) group by q.term, shard, n having count(*) = n"""

_IN = f"(select {bare_host('l')} as host from (select unnest(links) as l from crawled_docs)) where host <> ''"
_SCORE = "least(30, round(log2(1 + incoming) / log2(greatest(2, max(incoming) over ())) * 30)::int)"
SQL["link_graph_scores"] = f"with k as (select host, count(*) as incoming from {_IN} group by host) select host, incoming, {_SCORE} as score from k"
SQL["link_graph_merge"] = f"with k as (select host, sum(incoming)::bigint as incoming from (select host, incoming from site_hosts union all select host, 1 from {_IN}) group by host) select host, incoming, {_SCORE} as score from k"
SQL["top_hosts"] = f"select {host_name('u')} as host, count(*) as docs from raw_docs where {host_name('u')} <> '' group by 1 order by docs desc, host limit 20"


def _edges(hosts: str, source: str) -> str:
    return f"""x as (select row_number() over () as n, {host_port("u")} as src, {hosts} as h from {source}), y as (select n, src, unnest(h) as dst, generate_subscripts(h, 1) as k from x),
 f as (select n, src, dst, min(k) as k from y where dst <> src and dst <> '' group by n, src, dst), g as (select *, row_number() over (partition by n order by k) as r from f where src <> ''),
 e as (select src, dst, count(*) as cnt from g where r <= 20 group by src, dst)"""


SQL["host_edges"] = f"with {_edges(f'list_transform(links, lambda v: {host_port(chr(118))})', 'crawled_docs')} select * from e"
SQL["text_edges"] = f"""with {_edges("regexp_extract_all(concat_ws(' ', text, array_to_string(links, ' ')), '(?i)https?://([a-z0-9.-]+)', 1)", "crawled_docs")} select * from e"""


def _rank(iterations: int = 20) -> str:
    steps = [f"r{k} as materialized (select h.host, 0.15 / n + 0.85 * coalesce(m, 0) as r from h cross join t left join (select dst, sum(r / deg) as m from e join o using (src) join r{k - 1} p on p.host = e.src group by dst) q on q.dst = h.host)" for k in range(1, iterations + 1)]
    return f"""with {_edges(f'list_transform(links, lambda v: {host_port(chr(118))})', 'crawled_docs')}, o as (select src, count(*) as deg from e group by src), h as (select src as host from e union select dst from e), t as (select count(*) as n from h),
 r0 as (select host, 1.0::double / n as r from h, t), {", ".join(steps)}, c as (select r as cut from (select r, row_number() over (order by r desc) as k from r{iterations}), t where k = floor(n * 0.05) + 1)
 select host, round(case when cut > 0 then least(1.0, r / cut) else 0 end, 6) as rank from r{iterations}, c"""


SQL["pagerank"] = _rank()

_VERS = f"""cur as (select {_shard("u", 128)} as shard, lower(to_base({U32.format("u")}, 36)) as hash, max(u) as u from raw_docs where rec_id % 10 <> 1 group by 1, 2),
 prev as (select {_shard("u", 128)} as shard, lower(to_base({U32.format("u")}, 36)) as hash, max(u) as u from raw_docs where rec_id % 10 <> 0 group by 1, 2)"""
SQL["delta_added"] = f"with {_VERS} select * from cur where (shard, hash) not in (select shard, hash from prev)"
SQL["delta_removed"] = f"with {_VERS} select shard, hash from prev where (shard, hash) not in (select shard, hash from cur)"
SQL["delta_summary"] = f"""with {_VERS}, k as (select coalesce(c.shard, p.shard) as shard, count(c.hash) as docs, count(*) filter (p.hash is null) as added, count(*) filter (c.hash is null) as removed from cur c full join prev p on c.shard = p.shard and c.hash = p.hash group by 1)
 select r.range::int as shard, coalesce(docs, 0) as docs, coalesce(added, 0) as added, coalesce(removed, 0) as removed, coalesce(docs, 0) = 0 as missing from range(128) r left join k on k.shard = r.range"""

_OBJ = "objects as (select 'shards/' || o_orderkey::varchar as key, trunc(o_totalprice)::bigint as size, o_orderdate as ts from orders)"
SQL["age_tiers"] = f"with {_OBJ} select case when d <= 30 then 'hot' when d <= 180 then 'warm' else 'cold' end as tier, count(*) as objects, sum(size)::bigint as bytes from (select *, epoch(timestamp '1998-06-01' - ts) / 86400.0 as d from objects) group by 1"
SQL["warm_budget"] = f"with {_OBJ} select key, size, ts from (select *, sum(size) over (order by ts, key) as s from objects where size % 7 <> 0) where s <= 500000000"
SQL["prune_plan"] = f"with {_OBJ}, n as (select case when sum(size) > 800000000 then sum(size) - 760000000 else 0 end as need from objects) select key, size, ts from (select *, sum(size) over (order by ts, key) - size as b from objects), n where b < need"
_PACK = f"""{_OBJ}, o as materialized (select key, size, row_number() over (order by ts, key) as n from objects),
 w as (select n, key, size, 0::bigint as bin, size as used from o where n = 1 union all select o.n, o.key, o.size, case when used > 0 and used + o.size > 5000000 then bin + 1 else bin end, case when used > 0 and used + o.size > 5000000 then o.size else used + o.size end from w join o on o.n = w.n + 1)"""
SQL["bin_pack"] = f"with recursive {_PACK} select key, size, bin from w"
SQL["archive_run"] = f"with recursive {_PACK}, b as (select bin, sum(size)::bigint as size, count(*) as objects from w group by bin) select bin, size, objects from (select *, sum(size) over (order by bin) as s from b) where s <= 400000000"
SQL["saved_bytes"] = "select b as before, a as after, b - a as saved, round(100.0 * (b - a) / b, 4)::double as saved_pct from (select sum(strlen(coalesce(c, '')))::bigint as b, sum(strlen(coalesce(d, '')))::bigint as a from raw_docs)"

_BUCKET = "('0x' || substr(sha1({0}), 1, 2))::int"
SQL["frontier_pending"] = f"select distinct warc as id from raw_docs where warc is not null and {_BUCKET.format('warc')} % 3 <> 0 and {_BUCKET.format('warc')} % 5 <> 0"
SQL["segment_list"] = """with l as (select 0 as dump, rec_id as line_no, 'data/' || coalesce(warc, 'none') || '.warc.gz' as path from raw_docs where coalesce(src, '') <> 'rss' union all select 1, rec_id, 'data/' || coalesce(warc, 'none') || '.warc.gz' from raw_docs where coalesce(src, '') <> 'warc')
 select regexp_extract(path, '([^/]+)\\.warc\\.gz$', 1) as id, path, dump, line_no from l qualify row_number() over (partition by path order by dump, line_no) = 1""".replace("\\\\", "\\")
SQL["crawl_candidates"] = "select distinct u from raw_docs where regexp_matches(u, '^https?://') and u not in (select u from crawled_docs where status = 200 and u is not null)"
SQL["crawl_schedule"] = f"with x as (select distinct u from raw_docs), y as (select {host_port('u')} as host, (row_number() over (partition by {host_port('u')} order by u) - 1) * 800 as s from x) select host, count(*) as fetches, max(s)::bigint as last_start_ms, sum(s)::bigint as sum_start_ms from y group by host"
SQL["stale_hosts"] = f"select distinct host from site_hosts where host not in (select {bare_host('u')} from crawled_docs where u is not null and fetched_at > timestamp '2025-06-20' - interval 7 days)"
SQL["random_sample"] = "select rec_id, u from raw_docs order by md5('1337:' || rec_id::varchar), rec_id limit 100"

SQL["mention_urls"] = "select u, coalesce(host, '') as host, coalesce(tone, 0) as tone, batch_ts from gdelt_mentions where regexp_matches(u, '^https?://') qualify row_number() over (partition by u order by batch_ts, coalesce(host, ''), coalesce(tone, 0)) = 1"
SQL["host_ttl_dedup"] = """with recursive x as materialized (select distinct t as host, ts from ct_seeds where t is not null and ts is not null),
 w as (select host, min(ts) as ts from x group by host union all select w.host, (select min(x.ts) from x where x.host = w.host and x.ts >= w.ts + interval 24 hours) as ts from w where ts is not null) select host, ts as emitted_at from w where ts is not null"""
SQL["hot_tier_union"] = "select src, count(*) as urls from (select u, src from raw_docs where src in ('rss', 'sitemap') union select u, src from gdelt_mentions union select u, src from ct_seeds) where u is not null group by src"
SQL["union_raw_crawled"] = "select u, count(*) as rows, count(text) as texts from (select u, null as text from raw_docs union all select u, text from crawled_docs) group by u"
SQL["hourly_batches"] = "select strftime(written_at, '%Y/%m/%d/%H') as folder, count(*) as rows, min(fetched_at) as first_fetch, count(*) filter (fetched_at < written_at - interval 1 day) as late from crawled_docs group by 1"

SQL["signals_rollup"] = """with x as (select p_name as url, l_returnflag || '-' || l_linestatus || '-' || l_linenumber::varchar as tech, l_discount as perf, l_tax as seo, p_size > 25 as https, l_linestatus = 'O' as mobile, case when l_shipdate < timestamp '1995-01-01' then '1994' else '1998' end as date from lineitem join part on l_partkey = p_partkey),
 n as (select * from x where date = (select max(date) from x)), m as (select url, round(avg(perf) + 1.3e-8, 6) as perf, round(avg(seo) + 1.3e-8, 6) as seo, bool_or(https) as https, bool_or(mobile) as mobile from n group by url),
 k as (select url, tech, count(*) as c from n group by url, tech qualify row_number() over (partition by url order by c desc, tech) <= 8), g as (select url, string_agg(tech || ':' || c::varchar, ' ' order by c desc, tech) as tech from k group by url)
 select m.*, g.tech from m left join g using (url)"""
_SAMPLES = "s as (select trunc(value)::bigint as dur, event_type <> 'error' as ok, user_id % 10 as results from events), o as (select dur, row_number() over (order by dur) as k, count(*) over () as n from s where dur is not null)"
_LAT = """l as (select count(*) as requests, count(*) filter (not ok) as errors, count(*) filter (ok and results > 0) as non_empty, round(avg(dur), 6) as mean,
 (select dur from o where k = least(floor(n * 50 / 100), n - 1) + 1) as p50, (select dur from o where k = least(floor(n * 95 / 100), n - 1) + 1) as p95, (select dur from o where k = least(floor(n * 99 / 100), n - 1) + 1) as p99 from s)"""
SQL["latency_percentiles"] = f"with {_SAMPLES}, {_LAT} select * from l"
SQL["readiness"] = f"with {_SAMPLES}, {_LAT} select round(errors / requests, 6) as error_rate, round(non_empty / greatest(1, requests - errors), 6) as non_empty_rate, p95, p95 < 800 and errors / requests < 0.01 and non_empty / greatest(1, requests - errors) >= 0.85 as ready from l"
SQL["progress_report"] = f"""with seg as (select distinct warc as id from raw_docs where warc is not null), dn as (select warc as id, sum(strlen(coalesce(c, ''))) as b from raw_docs where warc is not null and {_BUCKET.format("warc")} % 3 = 0 group by warc)
 select count(*) as total, count(b) as done, count(*) filter (b is null and {_BUCKET.format("seg.id")} % 5 = 0) as claimed, count(*) - count(b) - count(*) filter (b is null and {_BUCKET.format("seg.id")} % 5 = 0) as remaining, printf('%.2f%%', 100.0::double * count(b) / count(*)) as pct, coalesce(sum(b), 0)::bigint as raw_bytes from seg left join dn using (id)"""
SQL["run_rates"] = """with p as (select log, count(distinct t) as n, max(floor(epoch(ts))) - min(floor(epoch(ts))) + 1 as s from ct_seeds group by log)
 select log, n, round(n * 96.0::double / 250000 * 100, 4) as share_quarter_hourly, round(n / 30.0::double / 250000 * 100, 4) as share_30_days, round(n * 86400.0::double / s, 4) as per_day, round(n * 3600.0::double / s, 4) as per_hour, round(100.0::double * n / 100000, 4) as sweep_pct from p"""

_MAN = """(with p as {p}, b as (select p.*, (rec_id % 3)::int as batch_id from p join (select u, max(rec_id) as rec_id from raw_docs group by u) using (u)) select batch_id, count(distinct u) as docs, count(distinct term) as terms, count(*) as postings from b group by batch_id)"""
SQL["index_manifest"] = "select * from " + _MAN.format(p=_RAW)
SQL["fetched_pages"] = """with x as (select status, case when crawl_id % 7 = 0 then 'image/png' else content_type end as ct, text from crawled_docs), y as (select status, status between 200 and 299 as ok, regexp_matches(coalesce(ct, ''), '(?i)html|xml|text/plain') as page, text from x)
 select case when ok and not page then 415 else status end as status, count(*) as pages, count(text) filter (ok and page) as bodies from y group by 1"""
SQL["batch_samples"] = """with x as (select distinct strftime(written_at, '%Y-%m-%d') as batch, u from crawled_docs), y as (select * from x qualify row_number() over (partition by batch order by md5(u), u) <= 50) select batch, string_agg(u, ' ' order by u) as sample from y group by batch"""
SQL["batch_history"] = "select strftime(written_at, '%Y-%m-%d-%H') as batch, count(*) as rows from crawled_docs group by 1 order by 1 desc limit 30"
SQL["bloom_files"] = f"""with {_BLOOM}, k as (select shard, (p // 8) as byte, sum(1 << (p % 8)::int) as v from pos group by 1, 2), s as (select distinct shard from pos),
 f as (select s.shard, string_agg(printf('%02x', coalesce(v, 0)::int), '' order by r.range) as h from s cross join range(8192) r left join k on k.shard = s.shard and k.byte = r.range group by s.shard) select shard, md5(unhex(h)) as digest, (length(h) / 2)::int as bytes from f"""
SQL["robots_rules"] = f"""with k as (select host, {_BUCKET.format("host")} % 8 as k from site_hosts),
 v(k, body, allow, delay_ms) as (values (0, 'User-agent: *\nDisallow: /', false, 0), (1, 'User-agent: *\nDisallow:', true, 0), (2, 'User-agent: bot\nDisallow: /', true, 0), (3, 'User-agent: *\nCrawl-delay: 3', true, 3000), (4, '', true, 0), (5, 'User-agent: *\n\nDisallow: /', true, 0), (6, '# c\nUser-agent: *\nCrawl-delay: 99\nDisallow: /', false, 10000), (7, 'User-agent: *\nDisallow: /private', true, 0))
 select body, allow, delay_ms::bigint as delay_ms, count(*) as hosts from k join v using (k) group by all"""
SQL["stream_ttl_dedup"], SQL["stream_once"] = SQL["host_ttl_dedup"], SQL["good_hosts"]
SQL["mention_windows"] = "select time_bucket(interval 6 hours, batch_ts, timestamp '2000-01-01') as from_ts, src, count(*) as n from gdelt_mentions group by 1, 2"


from . import io_oracles  # noqa: E402, F401  (adds the SQL of sources and sinks)
