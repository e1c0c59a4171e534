"""Queries of sources and sinks: inputs are written from the tables, then read by the source under test."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack import schemas
from tidewrack.functions import hashing, text
from tidewrack.operators import delta, feeds, frontier, index, runs, search, shards, tiers
from tidewrack.operators.dedup import keep_one
from tidewrack.session import scratch, table
from tidewrack.sources import ctlog, files
from tidewrack.streaming import dedup as stream_dedup

from .queries import crawled, query, raw


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


# --- files ---


@query
def ndjson_read(s: SparkSession, d: str) -> DataFrame:
    """Records written as gzip NDJSON, with malformed lines and rows without address among them."""
    out = scratch(s, "ndjson")
    files.write_ndjson(raw(s, d).select("u", "t", "d", "c", "l", "s"), f"{out}/rows")
    s.createDataFrame([("not json",), ('{"t": "no address"}',), ('{"u": ""}',), ('{"u": "cut',)], "value string").coalesce(1).write.text(f"{out}/bad", lineSep="\n")
    return files.read_ndjson(s, f"{out}/*", schemas.RAW_DOC)


@query
def warc_pages(s: SparkSession, d: str) -> DataFrame:
    """Response records of gzip archives, requests among them left out, with the text behind the HTTP header."""
    out = scratch(s, "warc")
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>"), F.coalesce("c", F.lit("")), F.lit("</p>\n\n"))
    record = lambda kind: F.concat(F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: <"), F.col("u"), F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)
    raw(s, d).where("u is not null").select(F.explode(F.array(record("request"), record("response"))).alias("value")).write.mode("append").option("compression", "gzip").text(out, lineSep="\r\n\r\n")
    ctlog.register(s)
    return s.read.format("warc").load(f"{out}/*.gz").groupBy("uri", "html").agg(F.count("*").alias("n"))


@query
def path_list(s: SparkSession, d: str) -> DataFrame:
    """Trimmed lines of a list with blanks and blank lines."""
    out = scratch(s, "paths")
    lines = raw(s, d).select(F.concat(F.lit("  data/"), F.coalesce("warc", F.lit("none")), F.lit(".warc.gz \t")).alias("value")).unionByName(raw(s, d).select(F.lit("   ").alias("value")))
    lines.write.mode("append").option("compression", "gzip").text(out, lineSep="\n")
    return files.read_lines(s, out).withColumn("path", F.regexp_replace("path", r"\s+$", "")).groupBy("path").agg(F.count("*").alias("n"))


@query
def object_listing(s: SparkSession, d: str) -> DataFrame:
    """Names of the tables' files; bodies are not read."""
    return files.listing(s, d, "*.parquet").select(F.regexp_extract("path", r"([^/]+)\.parquet", 1).alias("name")).distinct()


@query
def listing_slices(s: SparkSession, d: str) -> DataFrame:
    """A cursor's slice, the newest names and both parts of a divided budget of one listing of segments."""
    names = raw(s, d).select(F.concat(F.lit("raw/"), "warc").alias("path")).where("path is not null").distinct()
    made = names.withColumn("path", F.concat("path", F.lit(".ndjson.gz")))
    first, second = files.split_budget(10)
    newest = made.orderBy(F.desc("path")).limit(12)
    parts = {"cursor": files.slice_of(names, 3, 5), "newest": newest, "first": files.slice_of(names, 0, first), "second": files.slice_of(made, 0, second)}
    out = None
    for name, df in parts.items():
        part = df.select(F.lit(name).alias("part"), "path")
        out = part if out is None else out.unionByName(part)
    return out


@query
def sample_scan(s: SparkSession, d: str) -> DataFrame:
    """Rows of the first two folders of a listing by name: a bounded sample is the feature."""
    out = scratch(s, "sample")
    raw(s, d).select("rec_id", "u", "src").write.mode("append").partitionBy("src").parquet(out)
    folders = files.listing(s, out, "*.parquet").select(F.regexp_extract("path", "/(src=[^/]+)/", 1).alias("path"))
    first = [r.path for r in files.slice_of(folders.distinct(), 0, 2).collect()]
    return s.read.option("basePath", out).parquet(*[f"{out}/{p}" for p in first])


@query
def conversion(s: SparkSession, d: str) -> DataFrame:
    """NDJSON to Zstandard Parquet, and again at the highest level, with malformed lines left out."""
    out = scratch(s, "convert")
    files.write_ndjson(crawled(s, d).select("u", "t", "d", "c", "text", "lang", "status"), f"{out}/in")
    kind = "u string, t string, d string, c string, text string, lang string, status int"
    files.to_parquet(files.read_ndjson(s, f"{out}/in", s.createDataFrame([], kind).schema), f"{out}/warm")
    files.cold_rewrite(s, f"{out}/in", f"{out}/cold", s.createDataFrame([], kind).schema)
    both = s.read.parquet(f"{out}/warm").withColumn("tier", F.lit("warm")).unionByName(s.read.parquet(f"{out}/cold").withColumn("tier", F.lit("cold")))
    return both.groupBy("tier", "lang", "status").agg(F.count("*").alias("n"), F.count("text").alias("texts"), F.sum(F.length("text")).cast("bigint").alias("chars"))


@query
def conversion_candidates(s: SparkSession, d: str) -> DataFrame:
    """The first 500 objects in order of name that are old enough: the cap of a conversion run is the feature."""
    o = table(s, d, "orders").select(F.concat(F.lit("shards/"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("key"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    return feeds.run_cap(o.where("ts < timestamp '1998-05-25 00:00:00'"), ["key"], 500)


# --- archives of mentions, feeds, sitemaps, zones, certificates ---


def _zips(s: SparkSession, d: str) -> str:
    """One archive per quarter hour of the mentions, as the mention feed has them."""
    out = scratch(s, "zips")
    where = _local(out)
    m = table(s, d, "gdelt_mentions").where("u is not null and batch_ts is not null")
    cells = [F.lit(str(k)) for k in range(4)] + [F.coalesce("host", F.lit("")), F.col("u")] + [F.lit(str(k)) for k in range(6, 13)] + [F.coalesce(F.col("tone").cast("string"), F.lit("none"))]
    lines = m.select(F.date_format("batch_ts", "yyyyMMddHHmm").alias("at"), F.concat_ws("\t", *cells).alias("line"))

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{key[0]}00.mentions.CSV", "\n".join(pdf["line"]) + "\n")
        with open(f"{where}/{key[0]}00.mentions.CSV.zip", "wb") as f:
            f.write(held.getvalue())
        return pd.DataFrame({"at": [key[0]], "lines": [len(pdf)]})

    lines.groupBy("at").applyInPandas(write, "at string, lines bigint").agg(F.sum("lines")).collect()
    return out


@query
def mention_archives(s: SparkSession, d: str) -> DataFrame:
    """Rows of zipped mention tables, with the time of the archive's name."""
    got = files.mention_lines(s, _zips(s, d))
    return feeds.mentions(got.withColumn("at", F.date_format("batch_ts", "yyyyMMddHHmm")), "value").groupBy("u", "host", F.round("tone", 6).alias("tone")).agg(F.count("*").alias("n"))


@query
def mention_master_list(s: SparkSession, d: str) -> DataFrame:
    """Archives of a master list within a window of time."""
    at = table(s, d, "gdelt_mentions").where("batch_ts is not null").select(F.date_format("batch_ts", "yyyyMMddHHmm").alias("at")).distinct()
    lines = at.select(F.explode(F.array(*[F.concat(F.lit("1234 abcd  http://m.example.org/v2/"), "at", F.lit(f"00.{k}")) for k in ("mentions.CSV.zip", "export.CSV.zip", "gkg.csv.zip")])).alias("value"))
    first = table(s, d, "gdelt_mentions").agg(F.date_format(F.min("batch_ts"), "yyyy-MM-dd HH:mm:ss").alias("a"), F.date_format(F.min("batch_ts") + F.expr("interval 2 days"), "yyyy-MM-dd HH:mm:ss").alias("b")).first()
    return files.mention_files(lines, first.a, first.b).select("url")


@query
def feed_links(s: SparkSession, d: str) -> DataFrame:
    """Links of feeds of both kinds: at most 40 a feed, which is the feature."""
    links = F.filter(F.coalesce("links", F.array().cast("array<string>")), lambda x: x.isNotNull())
    rss = F.concat(F.lit("<rss><channel><link>https://feed.example.org/</link>"), F.array_join(F.transform(links, lambda x: F.concat(F.lit("<item><title>t</title>\n<link> "), x, F.lit(" </link></item>"))), ""), F.lit("</channel></rss>"))
    atom = F.concat(F.lit("<feed>"), F.array_join(F.transform(links, lambda x: F.concat(F.lit('<entry><link rel="alternate" href="'), x, F.lit('"/></entry>'))), ""), F.lit("<entry><link href='ftp://no.example.org/'/></entry></feed>"))
    xml = crawled(s, d).select("crawl_id", F.when(F.col("crawl_id") % 2 == 0, rss).otherwise(atom).alias("xml"))
    return feeds.feed_items(xml).groupBy("crawl_id", "u").agg(F.count("*").alias("n"))


@query
def feed_list(s: SparkSession, d: str) -> DataFrame:
    """The default feeds, as the list given is empty."""
    return feeds.feed_list(s, raw(s, d).where("false").select(F.col("u").alias("url")))


def _robots(s: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit("User-agent: *\nDisallow: /x\nSitemap: https://"), "host", F.lit("/index.xml\r\n  sitemap:https://"), "host", F.lit("/more.xml # second\n"))
    return table(s, d, "site_hosts").select("host", F.when(F.col("incoming") % 3 == 0, None).when(F.col("incoming") % 3 == 1, "# nothing\nDisallow:").otherwise(body).alias("body"))


@query
def robots_sitemaps(s: SparkSession, d: str) -> DataFrame:
    return feeds.robots_sitemaps(_robots(s, d))


def _maps(s: SparkSession, d: str) -> DataFrame:
    """Indexes with 25 children in falling order, children with two pages each, and plain sitemaps."""
    h = table(s, d, "site_hosts").select("host")
    child = F.transform(F.sequence(F.lit(25), F.lit(1), F.lit(-1)), lambda k: F.concat(F.lit("<sitemap><loc>https://"), "host", F.lit("/s"), k.cast("string"), F.lit(".xml</loc></sitemap>")))
    idx = h.select(F.concat(F.lit("https://"), "host", F.lit("/index.xml")).alias("url"), F.concat(F.lit("<sitemapindex>"), F.array_join(child, ""), F.lit("</sitemapindex>")).alias("xml"))
    k = F.explode(F.sequence(F.lit(1), F.lit(25))).alias("k")
    leaf = h.select("host", k).select(F.concat(F.lit("https://"), "host", F.lit("/s"), F.col("k").cast("string"), F.lit(".xml")).alias("url"), F.concat(F.lit("<urlset><url><LOC>\n https://"), "host", F.lit("/p"), F.col("k").cast("string"), F.lit("a </LOC></url><url><loc>https://"), "host", F.lit("/common</loc></url><url><loc>ftp://x</loc></url></urlset>")).alias("xml"))
    usual = h.select(F.concat(F.lit("https://"), "host", F.lit("/sitemap.xml")).alias("url"), F.concat(F.lit("<urlset><loc>https://"), "host", F.lit("/only</loc></urlset>")).alias("xml"))
    return idx.unionByName(leaf).unionByName(usual)


@query
def sitemap_harvest(s: SparkSession, d: str) -> DataFrame:
    """Locations of the sitemaps that hosts' robots texts name: four roots, twenty children in document order."""
    roots = feeds.robots_sitemaps(_robots(s, d)).select("host", F.col("sitemap").alias("url"), F.when(F.col("sitemap").endswith("/index.xml"), 0).otherwise(1).alias("place"))
    return feeds.sitemap_urls(roots, _maps(s, d))


@query
def sitemap_simple(s: SparkSession, d: str) -> DataFrame:
    """The first of two usual places that answers; the first 20 locations."""
    return feeds.simple_sitemaps(table(s, d, "site_hosts").where("incoming % 2 = 0").select("host"), _maps(s, d).where(F.col("url").endswith("/sitemap.xml")))


@query
def zone_domains(s: SparkSession, d: str) -> DataFrame:
    """Registrable names of a zone file, gzip, with other records among its lines."""
    out = scratch(s, "zone")
    t = table(s, d, "ct_seeds").select("t").distinct()
    lines = t.select(F.explode(F.array(F.concat("t", F.lit(".\t3600  in ns ns1.example.org.")), F.concat("t", F.lit(". 60 IN A 192.0.2.1")), F.concat(F.lit("; "), "t"))).alias("value"))
    lines.write.mode("append").option("compression", "gzip").text(out, lineSep="\n")
    return feeds.zone_domains(s.read.text(out), "org")


@query
def certificate_rows(s: SparkSession, d: str) -> DataFrame:
    """Domains of certificate rows read from JSON whose names stand one per line."""
    out = scratch(s, "crt")
    t = table(s, d, "ct_seeds").select("t").distinct()
    t.select(F.concat(F.upper("t"), F.lit("\n*."), "t", F.lit("\nnodot\n")).alias("name_value")).write.mode("append").json(out)
    return feeds.certificate_names(s.read.schema("name_value string").json(out), keep_subdomains=True)


@query
def certificate_fallback(s: SparkSession, d: str) -> DataFrame:
    """The second source, of names in arrays, as the first has no row."""
    t = table(s, d, "ct_seeds").select("t").distinct()
    first = lambda: feeds.certificate_names(t.where("false").select(F.col("t").alias("name_value")))
    second = lambda: feeds.issuance_names(t.select(F.array(F.col("t"), F.concat(F.lit("*."), "t")).alias("dns_names")))
    return runs.first_with_rows(s, [first, second])


@query
def active_logs(s: SparkSession, d: str) -> DataFrame:
    """Usable and qualified logs of a list, a list entry per nation."""
    n = table(s, d, "nation").select("n_name", "n_nationkey", "n_regionkey")
    state = F.struct(F.when(F.col("n_nationkey") % 3 == 0, F.struct(F.lit("t").alias("timestamp"))).alias("usable"), F.when(F.col("n_nationkey") % 3 == 1, F.struct(F.lit("t").alias("timestamp"))).alias("qualified"))
    log = F.struct(F.concat("n_name", F.lit(" log 2026!")).alias("description"), F.concat(F.lit("https://log"), F.col("n_nationkey").cast("string"), F.lit(".example.org/")).alias("url"), state.alias("state"))
    doc = n.groupBy("n_regionkey").agg(F.collect_list(log).alias("logs")).agg(F.collect_list(F.struct(F.concat(F.lit("Operator "), F.col("n_regionkey").cast("string")).alias("name"), "logs")).alias("operators"))
    return feeds.active_logs(doc)


# --- certificate logs ---


def _leaves(s: SparkSession, d: str) -> DataFrame:
    """``(log, leaf)``: every seed as a leaf of one of both kinds, its host behind tag 0x82, with bytes that look like one."""
    c = table(s, d, "ct_seeds").where("t is not null and ts is not null").select(F.coalesce("log", F.lit("none")).alias("log"), F.col("t").alias("host"), F.col("ts").cast("timestamp").alias("ts"))
    name = F.concat(F.lit("82"), F.lpad(F.hex(F.length("host")), 2, "0"), F.hex(F.encode("host", "UTF-8")))
    der = F.concat(F.lit("30820182026162"), name, F.lit("8203612E01"), name, F.lit("8205"))
    pre = F.pmod(F.crc32("host"), F.lit(2)) == 1
    head = F.concat(F.lit("0000"), F.lpad(F.hex(F.unix_millis("ts")), 16, "0"), F.when(pre, F.lit("0001")).otherwise(F.lit("0000")), F.when(pre, F.repeat(F.lit("82"), 32)).otherwise(F.lit("")))
    # the engine's base64 comes in lines
    return c.select("log", F.regexp_replace(F.base64(F.unhex(F.concat(head, F.lpad(F.hex((F.length(der) / 2).cast("int")), 6, "0"), der))), r"\s", "").alias("leaf"))


def _log_folder(s: SparkSession, d: str) -> str:
    """Folders of certificate logs with files of at most 3,000 entries, named by their first entry."""
    out = scratch(s, "logs")
    where = _local(out)
    from pyspark.sql import Window

    numbered = _leaves(s, d).withColumn("entry", F.row_number().over(Window.partitionBy("log").orderBy("leaf")) - 1)

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import os

        os.makedirs(f"{where}/{key[0]}", exist_ok=True)
        pdf = pdf.sort_values("entry")
        with open(f"{where}/{key[0]}/{int(pdf['entry'].iloc[0])}.txt", "w") as f:
            f.writelines(f"{x}\n" for x in pdf["leaf"])
        return pd.DataFrame({"n": [len(pdf)]})

    numbered.groupBy(F.regexp_replace("log", r"\W+", "-").alias("log"), (F.col("entry") / 3000).cast("int").alias("part")).applyInPandas(write, "n bigint").agg(F.sum("n")).collect()
    ctlog.register(s)
    return where


@query
def log_seeds(s: SparkSession, d: str) -> DataFrame:
    """Seed records of all entries of the certificate logs: leaf time and host names of the certificates."""
    entries = s.read.format("ctlog").option("path", _log_folder(s, d)).load()
    return stream_dedup.seeds(entries).groupBy("log", "t", "ts").agg(F.count("*").alias("n"))


@query
def log_newest(s: SparkSession, d: str) -> DataFrame:
    """The newest 2,048 entries of each log: a bounded read is the feature."""
    entries = s.read.format("ctlog").option("path", _log_folder(s, d)).option("lastentries", 2048).load()
    return entries.groupBy("log").agg(F.count("*").alias("n"), F.min("entry").alias("first"), F.max("entry").alias("last"))


@query
def log_stream(s: SparkSession, d: str) -> DataFrame:
    """The logs as a stream by offsets, from the start, in a bounded run."""
    out = scratch(s, "log-stream")
    stream = s.readStream.format("ctlog").option("path", _log_folder(s, d)).option("from", "start").load()
    stream_dedup.drain(stream_dedup.seeds(stream), f"{out}/rows", f"{out}/offsets").awaitTermination()
    return s.read.parquet(f"{out}/rows").groupBy("log", "t").agg(F.count("*").alias("n"))


@query
def log_heads(s: SparkSession, d: str) -> DataFrame:
    """Where first contact with each log starts: at its head if it is long."""
    reader = ctlog._Stream({"path": _log_folder(s, d)})
    return s.createDataFrame(sorted(reader.initialOffset().items()), "log string, entry bigint")


# --- sinks ---


@query
def sharded_write(s: SparkSession, d: str) -> DataFrame:
    """Documents written by shard, with the manifest of all shards that comes after them."""
    first = keep_one(raw(s, d).select("u", "rec_id", "c").where("u is not null"), ["u"], [F.col("rec_id")])
    return shards.write_sharded(first, f"{scratch(s, 'shards')}/hot", 128)


@query
def sharded_json(s: SparkSession, d: str) -> DataFrame:
    """Eight shards of gzip NDJSON, read back."""
    out = f"{scratch(s, 'shards')}/json"
    last = keep_one(raw(s, d).select("u", "rec_id", "c").where("u is not null"), ["u"], [F.col("rec_id")], last=True)
    shards.write_sharded(last, out, 8, fmt="json")
    return s.read.schema("u string, rec_id bigint, c string, shard int").json(out).groupBy("shard").agg(F.count("*").alias("docs"), F.sum("rec_id").cast("bigint").alias("ids"))


@query
def prune_sources(s: SparkSession, d: str) -> DataFrame:
    """Source files to delete after a merge: those whose name's time is over seven days old."""
    o = table(s, d, "orders").select(F.concat(F.lit("hot/rss-"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH-mm-ss"), F.lit("-000Z.ndjson.gz")).alias("key"), F.col("o_totalprice").cast("bigint").alias("size"))
    aged = tiers.age_tier(o.withColumn("ts", tiers.file_time(F.col("key"))), "1998-08-01 00:00:00", warm=7)
    return aged.where("tier <> 'hot'").groupBy("tier").agg(F.count("*").alias("objects"), F.sum("size").cast("bigint").alias("bytes"))


@query
def file_times(s: SparkSession, d: str) -> DataFrame:
    """Times in the names of objects, in three notations."""
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    kinds = [F.concat(F.lit("hot/rss-"), F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss"), F.lit("-123Z.ndjson.gz")), F.concat(F.lit("hot/ct-"), F.lpad(F.unix_millis("ts").cast("string"), 13, "0"), F.lit(".ndjson.gz")), F.concat(F.lit("m/"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit(".mentions.CSV.zip")), F.lit("x/none")]
    name = F.element_at(F.array(*kinds), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", tiers.file_time(name).alias("at"))


@query
def number_prefixes(s: SparkSession, d: str) -> DataFrame:
    """Numbers at the start of texts, as lenient parsers take them."""
    v = F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.element_at(F.array(F.lit("abc"), F.lit("e2x"), F.lit(".5"), F.lit("")), (F.col("l_linenumber") % 4 + 1)))
    li = table(s, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(text.parse_float(v), 4).alias("x"), text.parse_float(F.lit("none")).alias("none"))


@query
def list_items(s: SparkSession, d: str) -> DataFrame:
    """Items of lists divided by commas and line ends."""
    v = F.concat(F.lit(" a, "), F.coalesce("warc", F.lit("")), F.lit("\n,, b\n"), F.col("src"))
    return raw(s, d).select("rec_id", F.array_join(text.split_list(v), "|").alias("items"))


@query
def stored_index(s: SparkSession, d: str) -> DataFrame:
    """Postings read back from an index of two batches, per bucket folder."""
    out = scratch(s, "index")
    r = raw(s, d)
    index.write_index(index.postings(r.where("src = 'warc'"), "rec_id"), out, 0)
    index.write_index(index.postings(r.where("src <> 'warc' or src is null"), "rec_id"), out, 1)
    p = search.open_index(s, out)[0]
    return p.groupBy("batch_id", "bucket").agg(F.count("*").alias("postings"), F.sum("tf").cast("bigint").alias("tf"))


@query
def versions_written(s: SparkSession, d: str) -> DataFrame:
    """Deltas and the snapshot of the newest version, read back."""
    from .queries import _versions

    out = scratch(s, "versions")
    cur, prev = _versions(s, d)
    delta.write_version(prev, prev.where("false"), out, "2025-01-01")
    delta.write_version(cur, prev, out, "2025-02-01")
    got = delta.latest(s, out, "deltas").groupBy("op").agg(F.count("*").alias("n"))
    whole = delta.latest(s, out, "versions").agg(F.lit("docs").alias("op"), F.count("*").alias("n"))
    return got.unionByName(whole)


@query
def dated_batches(s: SparkSession, d: str) -> DataFrame:
    """Batches in folders of date and hour, named by their content, read back by folder."""
    out = scratch(s, "batches")
    c = crawled(s, d).select("crawl_id", "u", F.col("written_at").cast("timestamp").alias("written_at")).where("written_at is not null")
    runs.write_dated(c, out, "written_at")
    return s.read.parquet(out).groupBy(F.col("day").cast("string").alias("day"), "hour").agg(F.count("*").alias("n"), F.sum("crawl_id").cast("bigint").alias("ids"), F.countDistinct("batch").alias("batches"))


@query
def run_counters(s: SparkSession, d: str) -> DataFrame:
    """Counters made on the way of a write."""
    seen, counters = runs.counted(raw(s, d), "raw docs", texts=F.count("c"), chars=F.sum(F.length("c")))
    seen.write.format("noop").mode("overwrite").save()
    got = counters.get
    return s.createDataFrame([(got["rows"], got["texts"], got["chars"])], "rows bigint, texts bigint, chars bigint")


@query
def kept_table(s: SparkSession, d: str) -> DataFrame:
    """A table kept for repeated reads, read twice."""
    t = runs.read_through(raw(s, d).select("src", "u"), reliable=True)
    return t.groupBy("src").agg(F.count("*").alias("n")).join(t.groupBy("src").agg(F.countDistinct("u").alias("addresses")), "src")


@query
def claims_left(s: SparkSession, d: str) -> DataFrame:
    """Claims after those of segments that are done, and those older than a run, were reset."""
    seg = raw(s, d).where("warc is not null").groupBy(F.col("warc").alias("id")).agg(F.min(F.col("fetched_at").cast("timestamp")).alias("claimed_at"))
    return frontier.reset_claims(seg, seg.where(hashing.bucket_of(F.col("id")) % 2 == 0), "2025-06-01 00:00:00", hours=24 * 60)


@query
def lookback_rebuild(s: SparkSession, d: str) -> DataFrame:
    """The hot tier made anew from the sources of the last thirty days, whole."""
    r = raw(s, d).withColumn("ts", F.col("fetched_at").cast("timestamp"))
    return shards.with_empty(shards.shard_counts(shards.lookback(r, "rec_id", "2025-06-20 00:00:00"), 16), 16)


@query
def capped_hosts(s: SparkSession, d: str) -> DataFrame:
    """A run's cap of 3,000 hosts, best scores first: the cap is the feature."""
    return table(s, d, "site_hosts").orderBy(F.desc("score"), "host").limit(3000).select("host", "score")


@query
def shuffled_segments(s: SparkSession, d: str) -> DataFrame:
    """Segment names in the order of the seeded generator; the list of segments is small and known to the driver."""
    names = [r.warc for r in raw(s, d).where("warc is not null").select("warc").distinct().orderBy("warc").collect()]
    return s.createDataFrame(list(enumerate(frontier.lcg_shuffle(names))), "place int, warc string")


@query
def file_cursor(s: SparkSession, d: str) -> DataFrame:
    """Files that came since the last run: two bounded runs with one checkpoint take each file once."""
    out = scratch(s, "cursor")
    total = []
    for k in range(2):
        raw(s, d).where((F.col("src") == "warc") == (k == 0)).select("rec_id", "src").coalesce(1).write.mode("append").json(f"{out}/in")
        stream = stream_dedup.new_files(s, f"{out}/in", "rec_id bigint, src string", per_batch=1)
        stream_dedup.drain(stream, f"{out}/rows", f"{out}/offsets").awaitTermination()
        total.append(s.read.parquet(f"{out}/rows").agg(F.count("*").alias("n"), F.countDistinct("rec_id").alias("ids")).first())
    return s.createDataFrame([(k, r.n, r.ids) for k, r in enumerate(total)], "run int, n bigint, ids bigint")


@query
def flushed_seeds(s: SparkSession, d: str) -> DataFrame:
    """Seeds flushed to folders of date and hour every few minutes; stopped when all are written."""
    out = scratch(s, "flush")
    table(s, d, "ct_seeds").select(F.col("t").alias("host"), F.col("ts").cast("timestamp").alias("ts")).where("ts is not null").write.parquet(f"{out}/in")
    stream = s.readStream.schema("host string, ts timestamp").parquet(f"{out}/in")
    q = stream_dedup.flush_every(stream, f"{out}/rows", f"{out}/offsets")
    q.processAllAvailable()
    q.stop()
    return s.read.parquet(f"{out}/rows").groupBy(F.col("day").cast("string").alias("day"), F.col("hour").cast("int").alias("hour")).agg(F.count("*").alias("n"))
