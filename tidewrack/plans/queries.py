"""Registry of the core queries: every operator over the whole tables it is meant for."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions import hashing, text, urls
from tidewrack.operators import bloom, dedup, delta, extract, feeds, frontier, graph, index, metrics, quality, runs, search, shards, signals, tiers
from tidewrack.session import scratch, table
from tidewrack.streaming import dedup as stream_dedup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The time that ages refer to in these queries.
AS_OF = "1998-06-01 00:00:00"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def raw(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "raw_docs")


def crawled(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "crawled_docs")


def html_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages made of extracted records, so that extraction has mark-up to undo."""
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    quoted = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit("'"))
    html = F.concat(
        F.lit('<HTML dir="ltr" lang="'), F.coalesce("l", F.lit("")), F.lit('"><head><title class="x"> '), esc(F.col("t")), F.lit(' </title><meta charset="utf-8"><meta name="description" content="'), quoted(F.col("d")),
        F.lit('"><meta property="og:title" content="'), quoted(F.col("t")), F.lit('"><style>p{}</style></head><body class="b"><script>var a="<p>";</script><nav><a href="/start#top">&nbsp;Start</a></nav><p>'), esc(F.col("c")),
        F.lit('</p><a class="y" href="//cdn.example.org/a?b=1#c">x</a><a href="'), quoted(F.col("u")), F.lit('">&quot;self&quot;</a><a href="mailto:x">m</a></body></HTML>'),
    )
    return raw(s, d).select("rec_id", F.col("u").alias("url"), html.alias("html"))


def objects(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.concat(F.lit("shards/"), F.col("o_orderkey").cast("string")).alias("key"), F.col("o_totalprice").cast("bigint").alias("size"), F.col("o_orderdate").alias("ts"))


def samples(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    return e.select(F.col("value").cast("bigint").alias("dur"), (F.col("event_type") != "error").alias("ok"), (F.col("user_id") % 10).alias("results"))


@query
def flagship(s: SparkSession, d: str) -> DataFrame:
    good = raw(s, d).where(quality.is_good(quality.ALLOWED_LANGS)).select("u", hashing.simhash(F.concat_ws(" ", "t", "c")).alias("s"), "c")
    return shards.with_shard(good).groupBy("shard").agg(F.count("*").alias("docs"), F.sum(F.octet_length("c")).cast("bigint").alias("bytes"), F.max("s").alias("max_digest"))


# --- extraction and text ---


@query
def extract_pages(s: SparkSession, d: str) -> DataFrame:
    return extract.extract_doc(html_pages(s, d), with_digest=False)


@query
def crawl_extract(s: SparkSession, d: str) -> DataFrame:
    return extract.crawl_doc(html_pages(s, d)).withColumn("links", F.array_join("links", " "))


@query
def strip_tags(s: SparkSession, d: str) -> DataFrame:
    return html_pages(s, d).select("rec_id", text.strip_tags(F.col("html")).alias("plain"), text.strip_tags_crawl(F.col("html")).alias("plain_crawl"))


@query
def tokens(s: SparkSession, d: str) -> DataFrame:
    return raw(s, d).select("rec_id", F.array_join(text.index_tokens(F.col("c")), " ").alias("index_tokens"), F.size(text.bloom_tokens(F.col("c"))).alias("bloom_tokens"), F.size(text.simhash_tokens(F.col("t"))).alias("digest_tokens"), F.trim(text.url_words(F.col("u"))).alias("words"))


@query
def simhash_docs(s: SparkSession, d: str) -> DataFrame:
    return raw(s, d).select("rec_id", hashing.simhash(F.concat_ws(" ", "t", "c")).alias("digest"))


@query
def quality_filter(s: SparkSession, d: str) -> DataFrame:
    return raw(s, d).where(quality.is_good(quality.ALLOWED_LANGS)).select("rec_id", "u")


@query
def quality_filter_en(s: SparkSession, d: str) -> DataFrame:
    return raw(s, d).where(quality.is_good(["en"])).select("rec_id", "u")


@query
def quality_counts(s: SparkSession, d: str) -> DataFrame:
    return quality.kept_dropped(raw(s, d), quality.is_good(quality.ALLOWED_LANGS))


@query
def cap_per_segment(s: SparkSession, d: str) -> DataFrame:
    """The cap is the feature: at most 60,000 rows of a segment."""
    return quality.cap_per_file(raw(s, d).where("warc is not null"), "warc", "rec_id").groupBy("warc").agg(F.count("*").alias("n"))


@query
def good_hosts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ct_seeds").select(F.col("t").alias("host")).distinct().where(quality.good_host(F.col("host")))


@query
def good_domains(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ct_seeds").select(F.col("t").alias("host")).distinct().where(quality.good_domain(F.col("host")))


# --- addresses ---


@query
def host_variants(s: SparkSession, d: str) -> DataFrame:
    u = F.col("u")
    return raw(s, d).select("rec_id", urls.host_port(u).alias("host_port"), urls.host_name(u).alias("host_name"), urls.bare_host(u).alias("bare_host"))


@query
def registered_names(s: SparkSession, d: str) -> DataFrame:
    h = F.col("t")
    return table(s, d, "ct_seeds").select("t").distinct().select(F.col("t").alias("host"), urls.etld1(h).alias("etld1"), urls.registrable(h).alias("registrable"))


@query
def url_ids(s: SparkSession, d: str) -> DataFrame:
    u = F.col("u")
    return raw(s, d).select("rec_id", hashing.url_hash(u).alias("hash"), hashing.shard_of(u, 128).alias("s128"), hashing.shard_of(u, 16).alias("s16"), hashing.shard_of(u, 8).alias("s8"), hashing.content_key(u).alias("key"), hashing.padded(hashing.shard_of(u), 3).alias("shard_name"), text.slugify(F.col("t")).alias("slug"))


@query
def resolved_links(s: SparkSession, d: str) -> DataFrame:
    rel = F.transform(F.coalesce("links", F.array().cast("array<string>")), lambda x: F.when(F.length(x) % 3 == 0, F.regexp_replace(x, "^https?://[^/]*", "")).when(F.length(x) % 3 == 1, F.regexp_replace(x, "^https?:", "")).otherwise(F.concat(x, F.lit("#frag"))))
    return crawled(s, d).select("crawl_id", "u", F.explode(rel).alias("href")).select("crawl_id", urls.resolve(F.col("href"), F.col("u")).alias("link"))


# --- duplicates ---


@query
def dedup_exact_first(s: SparkSession, d: str) -> DataFrame:
    return dedup.keep_one(raw(s, d).select("u", "rec_id", "t"), ["u"], [F.col("rec_id")])


@query
def dedup_last_wins(s: SparkSession, d: str) -> DataFrame:
    return dedup.keep_one(raw(s, d).select("u", "rec_id", "t"), ["u"], [F.col("rec_id")], last=True)


@query
def dedup_prefix(s: SparkSession, d: str) -> DataFrame:
    return dedup.prefix_gate(raw(s, d).select("rec_id", "s"), [F.col("rec_id")])


@query
def neardup_classes(s: SparkSession, d: str) -> DataFrame:
    return dedup.near_classes(raw(s, d), "rec_id")


# --- shards ---


@query
def reshard_counts(s: SparkSession, d: str) -> DataFrame:
    return shards.shard_counts(raw(s, d))


@query
def hot_shards_16(s: SparkSession, d: str) -> DataFrame:
    hot = dedup.keep_one(raw(s, d).select("u", "rec_id", "c"), ["u"], [F.col("rec_id")])
    return shards.with_empty(shards.shard_counts(hot, 16), 16)


@query
def hot_shards_8(s: SparkSession, d: str) -> DataFrame:
    hot = dedup.keep_one(raw(s, d).select("u", "rec_id", "c"), ["u"], [F.col("rec_id")], last=True)
    return shards.with_empty(shards.shard_counts(hot, 8), 8)


@query
def shard_manifest(s: SparkSession, d: str) -> DataFrame:
    m = shards.batch_manifest(raw(s, d).withColumn("batch_id", (F.col("rec_id") % 3).cast("int")))
    return m.select("shard", F.size("entries").alias("batches"), F.array_join(F.transform("entries", lambda e: F.concat(e["path"], F.lit(":"), e["docs"].cast("string"))), " ").alias("paths"))


# --- index and search ---


def _raw_postings(s: SparkSession, d: str) -> DataFrame:
    return index.postings(raw(s, d), "rec_id")


@query
def inverted_postings(s: SparkSession, d: str) -> DataFrame:
    return _raw_postings(s, d)


@query
def crawled_postings(s: SparkSession, d: str) -> DataFrame:
    return index.postings(crawled(s, d), "crawl_id", k="k", body="text").drop("t", "d")


@query
def term_df(s: SparkSession, d: str) -> DataFrame:
    return index.term_stats(_raw_postings(s, d))


@query
def bucket_stats(s: SparkSession, d: str) -> DataFrame:
    return index.bucket_stats(_raw_postings(s, d))


def _index(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A written index of all records."""
    out = scratch(s, "index")
    index.write_index(_raw_postings(s, d), out, 0)
    return search.open_index(s, out)


@query
def search_and(s: SparkSession, d: str) -> DataFrame:
    return search.match_all(_index(s, d)[0], ["guide", "market"])


@query
def search_ranked(s: SparkSession, d: str) -> DataFrame:
    """The top 15 is the feature."""
    return search.ranked(*_index(s, d), ["guide", "market"], table(s, d, "site_hosts"))


@query
def search_tier_merge(s: SparkSession, d: str) -> DataFrame:
    one = lambda df, k: dedup.keep_one(df.select("u", "t", k), ["u"], [F.col(k)]).select("u", "t")
    return search.merge_tiers(one(crawled(s, d), "crawl_id"), one(raw(s, d), "rec_id"))


@query
def batch_union(s: SparkSession, d: str) -> DataFrame:
    """Postings of three batches; the newest batch of a term and address stays."""
    r = raw(s, d).withColumn("batch_id", (F.col("rec_id") % 3).cast("int"))
    each = None
    for k in range(3):
        p = index.postings(r.where(F.col("batch_id") == k), "rec_id").withColumn("batch_id", F.lit(k))
        each = p if each is None else each.unionByName(p)
    return search.newest_batch(each).select("term", "u", "tf", "mask", "batch_id")


# --- bloom filters ---


@query
def bloom_words(s: SparkSession, d: str) -> DataFrame:
    return bloom.filters(bloom.doc_terms(raw(s, d)))


@query
def bloom_fill(s: SparkSession, d: str) -> DataFrame:
    return bloom.fill(bloom.filters(bloom.doc_terms(raw(s, d))))


@query
def bloom_probe(s: SparkSession, d: str) -> DataFrame:
    terms = table(s, d, "common_words").select(F.col("word").alias("term")).distinct()
    return bloom.probe(bloom.filters(bloom.doc_terms(raw(s, d))), terms)


# --- host graph ---


@query
def link_graph_scores(s: SparkSession, d: str) -> DataFrame:
    return graph.scores(graph.inlinks(crawled(s, d)))


@query
def link_graph_merge(s: SparkSession, d: str) -> DataFrame:
    return graph.scores(graph.merge_counts(table(s, d, "site_hosts"), graph.inlinks(crawled(s, d))))


@query
def top_hosts(s: SparkSession, d: str) -> DataFrame:
    """The top 20 is the feature."""
    return graph.top_hosts(graph.host_docs(raw(s, d)), "docs", 20)


@query
def host_edges(s: SparkSession, d: str) -> DataFrame:
    return graph.edges_from_links(crawled(s, d))


@query
def text_edges(s: SparkSession, d: str) -> DataFrame:
    linked = crawled(s, d).select("u", F.concat_ws(" ", "text", F.array_join("links", " ")).alias("c"))
    return graph.edges_from_text(linked)


@query
def pagerank(s: SparkSession, d: str) -> DataFrame:
    return graph.pagerank(graph.edges_from_links(crawled(s, d))).select("host", F.round("rank", 6).alias("rank"))


# --- versions ---


def _versions(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = raw(s, d).select("rec_id", "u", F.coalesce("t", F.lit("")).alias("t"))
    return delta.hashed(r.where("rec_id % 10 <> 1").select("u", "t")), delta.hashed(r.where("rec_id % 10 <> 0").select("u", "t"))


@query
def delta_added(s: SparkSession, d: str) -> DataFrame:
    return delta.added(*_versions(s, d))


@query
def delta_removed(s: SparkSession, d: str) -> DataFrame:
    return delta.removed(*_versions(s, d))


@query
def delta_summary(s: SparkSession, d: str) -> DataFrame:
    return delta.summary(*_versions(s, d))


# --- tiers ---


@query
def age_tiers(s: SparkSession, d: str) -> DataFrame:
    return tiers.age_tier(objects(s, d), AS_OF).groupBy("tier").agg(F.count("*").alias("objects"), F.sum("size").cast("bigint").alias("bytes"))


@query
def warm_budget(s: SparkSession, d: str) -> DataFrame:
    done = objects(s, d).where("size % 7 = 0")
    return tiers.within_budget(objects(s, d), 500_000_000, done)


@query
def prune_plan(s: SparkSession, d: str) -> DataFrame:
    return tiers.prune_plan(objects(s, d), 800_000_000)


@query
def bin_pack(s: SparkSession, d: str) -> DataFrame:
    return tiers.next_fit(objects(s, d), 5_000_000)


@query
def archive_run(s: SparkSession, d: str) -> DataFrame:
    return tiers.whole_bins(tiers.next_fit(objects(s, d), 5_000_000), 400_000_000)


@query
def saved_bytes(s: SparkSession, d: str) -> DataFrame:
    return tiers.savings(raw(s, d).select(F.octet_length(F.coalesce("c", F.lit(""))).alias("b"), F.octet_length(F.coalesce("d", F.lit(""))).alias("a")), "b", "a")


# --- frontier ---


@query
def frontier_pending(s: SparkSession, d: str) -> DataFrame:
    paths = raw(s, d).select(F.col("warc").alias("id")).where("id is not null").distinct()
    return frontier.pending(paths, paths.where(hashing.bucket_of(F.col("id")) % 3 == 0), paths.where(hashing.bucket_of(F.col("id")) % 5 == 0))


@query
def segment_list(s: SparkSession, d: str) -> DataFrame:
    lines = lambda src: raw(s, d).where(F.coalesce("src", F.lit("")) != src).select(F.col("rec_id").alias("line_no"), F.concat(F.lit(" data/"), F.coalesce("warc", F.lit("none")), F.lit(".warc.gz ")).alias("path"))
    return frontier.segments(lines("rss"), lines("warc")).select("id", "path", "dump", "line_no")


@query
def crawl_candidates(s: SparkSession, d: str) -> DataFrame:
    hot, maps = raw(s, d).where("src <> 'sitemap'"), raw(s, d).where("src = 'sitemap'")
    return frontier.candidates(hot, maps, crawled(s, d).where("status = 200"))


@query
def crawl_schedule(s: SparkSession, d: str) -> DataFrame:
    return frontier.schedule(raw(s, d).select("u").distinct()).groupBy("host").agg(F.count("*").alias("fetches"), F.max("start_ms").alias("last_start_ms"), F.sum("start_ms").cast("bigint").alias("sum_start_ms"))


@query
def stale_hosts(s: SparkSession, d: str) -> DataFrame:
    tried = crawled(s, d).select(urls.bare_host(F.col("u")).alias("host"), F.col("fetched_at").alias("tried_at"))
    return frontier.stale_hosts(table(s, d, "site_hosts"), tried, "2025-06-20 00:00:00")


@query
def random_sample(s: SparkSession, d: str) -> DataFrame:
    """Sampling is the feature: 100 rows in an order fixed by key and seed."""
    return frontier.sample(raw(s, d).select("rec_id", "u"), "rec_id", 100)


# --- feeds and live sources ---


@query
def mention_urls(s: SparkSession, d: str) -> DataFrame:
    return feeds.first_mentions(table(s, d, "gdelt_mentions").select("u", "d", "src", "host", "tone", "batch_ts"), [F.col("batch_ts"), F.coalesce("host", F.lit("")), F.coalesce("tone", F.lit(0.0))]).select("u", "host", "tone", "batch_ts")


@query
def seed_hosts(s: SparkSession, d: str) -> DataFrame:
    """Run-scoped: a host is taken once."""
    return table(s, d, "ct_seeds").select(F.col("t").alias("host")).where(quality.good_host(F.col("host"))).distinct()


@query
def host_ttl_dedup(s: SparkSession, d: str) -> DataFrame:
    return metrics.ttl_emissions(table(s, d, "ct_seeds").select(F.col("t").alias("host"), "ts"), "host", "ts")


@query
def hot_tier_union(s: SparkSession, d: str) -> DataFrame:
    """Feeds, mentions and certificate seeds in one tier, per source."""
    r = raw(s, d).where("src in ('rss', 'sitemap')").select("u", "src")
    m, c = table(s, d, "gdelt_mentions").select("u", "src"), table(s, d, "ct_seeds").select("u", "src")
    return r.unionByName(m).unionByName(c).where("u is not null").distinct().groupBy("src").agg(F.count("*").alias("urls"))


@query
def union_raw_crawled(s: SparkSession, d: str) -> DataFrame:
    a = raw(s, d).select("u", "t", "d", "c", "l")
    b = crawled(s, d).select("u", "t", "d", "c", "text", F.col("lang").alias("l"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("u").agg(F.count("*").alias("rows"), F.count("text").alias("texts"))


@query
def hourly_batches(s: SparkSession, d: str) -> DataFrame:
    """What a batch folder of date and hour holds."""
    c = crawled(s, d)
    return c.groupBy(F.date_format("written_at", "yyyy/MM/dd/HH").alias("folder")).agg(F.count("*").alias("rows"), F.min("fetched_at").alias("first_fetch"), F.count_if(F.col("fetched_at") < F.col("written_at") - F.expr("interval 1 day")).alias("late"))


# --- signals and metrics ---


def _signal_pages(s: SparkSession, d: str) -> DataFrame:
    """Line items stand in for crawled signals: a part is an address, ship modes of it are its technologies."""
    li, p = table(s, d, "lineitem"), table(s, d, "part")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(F.col("p_name").alias("url"), F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("tech"), F.col("l_discount").alias("perf"), F.col("l_tax").alias("seo"), (F.col("p_size") > 25).alias("https"), (F.col("l_linestatus") == "O").alias("mobile"), F.when(F.col("l_shipdate") < "1995-01-01", "1994").otherwise("1998").alias("date"))


@query
def signals_rollup(s: SparkSession, d: str) -> DataFrame:
    out = signals.rollup(_signal_pages(s, d))
    for c in ("perf", "seo"):  # moved off the ties, which engines round differently
        out = out.withColumn(c, F.round(F.col(c) + 1.3e-8, 6))
    return out.withColumn("tech", F.array_join(F.transform("tech", lambda e: F.concat(e["item"], F.lit(":"), e["count"].cast("string"))), " "))


@query
def latency_percentiles(s: SparkSession, d: str) -> DataFrame:
    return metrics.latency(samples(s, d))


@query
def readiness(s: SparkSession, d: str) -> DataFrame:
    return metrics.readiness(metrics.latency(samples(s, d)))


@query
def progress_report(s: SparkSession, d: str) -> DataFrame:
    seg = raw(s, d).select(F.col("warc").alias("id")).where("id is not null").distinct()
    done = raw(s, d).where(F.col("warc").isNotNull() & (hashing.bucket_of(F.col("warc")) % 3 == 0)).select(F.col("warc").alias("id"), F.octet_length(F.coalesce("c", F.lit(""))).alias("bytes"))
    return metrics.progress(seg, done, seg.where(hashing.bucket_of(F.col("id")) % 5 == 0))


@query
def run_rates(s: SparkSession, d: str) -> DataFrame:
    per = table(s, d, "ct_seeds").groupBy("log").agg(F.countDistinct("t").alias("n"), (F.max(F.unix_timestamp("ts")) - F.min(F.unix_timestamp("ts")) + 1).alias("seconds"))
    return per.select("log", "n", *metrics.run_rates(F.col("n"), F.col("seconds"), F.lit(100_000)))


# --- runs ---


@query
def index_manifest(s: SparkSession, d: str) -> DataFrame:
    r = raw(s, d).withColumn("batch_id", (F.col("rec_id") % 3).cast("int"))
    return runs.index_manifest(index.postings(r, "rec_id", extra=["batch_id"]))


@query
def fetched_pages(s: SparkSession, d: str) -> DataFrame:
    got = runs.fetched_pages(crawled(s, d).select("crawl_id", "status", F.when(F.col("crawl_id") % 7 == 0, "image/png").otherwise(F.col("content_type")).alias("content_type"), F.col("text").alias("html")))
    return got.groupBy("status").agg(F.count("*").alias("pages"), F.count("html").alias("bodies"))


@query
def batch_samples(s: SparkSession, d: str) -> DataFrame:
    """At most 50 addresses of a batch: a sample is the feature."""
    out = runs.batch_samples(crawled(s, d).select(F.date_format("written_at", "yyyy-MM-dd").alias("batch"), "u").distinct(), "batch", "u")
    return out.withColumn("sample", F.array_join("sample", " "))


@query
def batch_history(s: SparkSession, d: str) -> DataFrame:
    """The last 30 batches: a bounded history is the feature."""
    per = crawled(s, d).groupBy(F.date_format("written_at", "yyyy-MM-dd-HH").alias("batch")).agg(F.count("*").alias("rows"))
    return runs.history(per, "batch")


@query
def bloom_files(s: SparkSession, d: str) -> DataFrame:
    return bloom.to_binary(bloom.filters(bloom.doc_terms(raw(s, d)))).select("shard", F.md5("filter").alias("digest"), F.length("filter").alias("bytes"))


@query
def robots_rules(s: SparkSession, d: str) -> DataFrame:
    """Rules of made-up robots texts, one of eight kinds by host."""
    kinds = ["User-agent: *\nDisallow: /", "User-agent: *\nDisallow:", "User-agent: bot\nDisallow: /", "User-agent: *\nCrawl-delay: 3", "", "User-agent: *\n\nDisallow: /", "# c\nUser-agent: *\nCrawl-delay: 99\nDisallow: /", "User-agent: *\nDisallow: /private"]
    texts = table(s, d, "site_hosts").select("host", F.element_at(F.array(*map(F.lit, kinds)), (hashing.bucket_of(F.col("host")) % 8 + 1)).alias("body"))
    return frontier.robots(texts).groupBy("body", "allow", "delay_ms").agg(F.count("*").alias("hosts"))


# --- bounded streaming runs ---


def _arriving(s: SparkSession, df: DataFrame, arrival: str, key: str, ts: str, files: int = 5) -> tuple[DataFrame, str]:
    """A stream of a table's rows in files that came one after the other in order of arrival, one a micro-batch, closed by an
    end mark; and how long rows come after their own time at most.
    """
    out = scratch(s, "arriving")
    seconds = F.unix_timestamp(arrival).cast("double")
    cuts = df.select(F.percentile_approx(seconds, [k / files for k in range(1, files)], 1000)).first()[0]
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = df.where((F.lit(True) if lo is None else seconds > lo) & (F.lit(True) if hi is None else seconds <= hi))
        part.drop(arrival).coalesce(1).write.mode("append").parquet(out)
    # a row is late by the latest time that came before it
    first, last = df.agg(F.min(ts).cast("timestamp"), F.max(ts).cast("timestamp")).first()
    days = (last - first).days + 1
    schema = df.drop(arrival).schema
    stream_dedup.closed(s, out, schema, key, ts, str(last + datetime.timedelta(days=2 * days + 400)))
    return s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(out), f"{days} days"


def _drained(s: SparkSession, stream: DataFrame) -> DataFrame:
    """What a stream gives when it has read all of its files."""
    out = scratch(s, "stream")
    stream_dedup.drain(stream, f"{out}/rows", f"{out}/offsets").awaitTermination()
    return s.read.parquet(f"{out}/rows")


def _seeds(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "ct_seeds")
    return c.select(F.col("t").alias("host"), F.col("ts").cast("timestamp").alias("ts"), F.col("received_at").cast("timestamp").alias("received_at")).where("ts is not null and received_at is not null")


@query
def stream_ttl_dedup(s: SparkSession, d: str) -> DataFrame:
    """The streaming form of the rolling duplicates, over files in order of arrival with late rows among them."""
    stream, delay = _arriving(s, _seeds(s, d), "received_at", "host", "ts")
    return _drained(s, stream_dedup.rolling(stream, delay)).select("host", F.col("ts").alias("emitted_at"))


@query
def stream_once(s: SparkSession, d: str) -> DataFrame:
    """Each acceptable host once a run."""
    stream, _ = _arriving(s, _seeds(s, d), "received_at", "host", "ts")
    return _drained(s, stream_dedup.once(stream.select("host").where(quality.good_host(F.col("host")))))


@query
def mention_windows(s: SparkSession, d: str) -> DataFrame:
    """Mentions per source and window of six hours, as a stream."""
    m = table(s, d, "gdelt_mentions").select("src", F.col("batch_ts").cast("timestamp").alias("batch_ts"), F.col("batch_ts").cast("timestamp").alias("came")).where("batch_ts is not null")
    stream, delay = _arriving(s, m, "came", "src", "batch_ts")
    return _drained(s, stream_dedup.windows(stream, delay, "batch_ts", "src")).where(F.coalesce(F.col("src") != stream_dedup.END, F.lit(True)))


from . import io_queries  # noqa: E402, F401  (registers the queries of sources and sinks)
