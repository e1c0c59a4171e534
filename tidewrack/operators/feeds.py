"""Feeds, sitemaps, zone files, mention tables and certificate lists, parsed by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewrack.functions import text, urls

from .dedup import keep_one
from .quality import good_domain

ITEM = r"""<(?:item|entry)[\s\S]*?</(?:item|entry)>"""
ITEM_LINK = r"""<link[^>]*?(?:href=["']([^"']+)["']|>([^<]+)</link)"""
LOC = r"(?i)<loc>\s*([^<]+?)\s*</loc>"
#: Feeds read where no list is given: public examples of the documentation domains.
DEFAULT_FEEDS = tuple(f"https://feeds.example.{d}/{p}" for d in ("org", "com", "net") for p in ("news.xml", "science.xml", "technology.xml"))


def feed_list(spark: SparkSession, feeds: DataFrame | None) -> DataFrame:
    """``url`` of the feeds of a list, or the default ones where there is no list or it is empty."""
    if feeds is not None and not feeds.isEmpty():
        return feeds.select("url")
    return spark.createDataFrame([(u,) for u in DEFAULT_FEEDS], "url string")


def feed_items(feeds: DataFrame, xml: str = "xml", most: int = 40) -> DataFrame:
    """Adds ``u``: links of the first ``most`` items or entries with an http(s) link, attribute or text."""
    blocks = F.regexp_extract_all(F.coalesce(F.col(xml), F.lit("")), F.lit(ITEM), F.lit(0))
    link = lambda b: F.trim(F.coalesce(F.nullif(F.regexp_extract(b, ITEM_LINK, 1), F.lit("")), F.regexp_extract(b, ITEM_LINK, 2)))
    found = F.filter(F.transform(blocks, link), lambda u: u.rlike("^https?:"))
    return feeds.withColumn("u", F.explode(F.slice(found, 1, most))).drop(xml)


def sitemap_locs(maps: DataFrame, xml: str = "xml") -> DataFrame:
    """``u``, ``place`` (in document order) and ``is_index`` of all locations that start with http."""
    locs = F.filter(F.regexp_extract_all(F.coalesce(F.col(xml), F.lit("")), F.lit(LOC), F.lit(1)), lambda u: u.startswith("http"))
    return maps.select("*", F.coalesce(F.col(xml).rlike("(?i)<sitemapindex"), F.lit(False)).alias("is_index"), F.posexplode(locs).alias("place", "u")).drop(xml)


def _first_of(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in an order, counted in 32 pieces of the group, so that no group is one task's sort."""
    pieces = df.withColumn("_p", F.pmod(F.xxhash64(*order), F.lit(32)))
    first = pieces.withColumn("_n", F.row_number().over(Window.partitionBy(group, "_p").orderBy(*order))).where(F.col("_n") <= n)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n).drop("_p", "_n")


def sitemap_urls(roots: DataFrame, maps: DataFrame, url: str = "url", xml: str = "xml", most_roots: int = 4, children: int = 20, per_host: int = 5000) -> DataFrame:
    """``(host, u)``: distinct locations of a host's sitemaps, at most ``per_host`` a host in the order they are met.

    ``roots`` (host, url, place) are the sitemaps a host names; the first ``most_roots`` of them are read, and of an index
    among them the first ``children`` children in document order. ``maps`` (url, xml) are stored answers.
    """
    begun = _first_of(roots.select("host", F.col("url").alias("_root"), F.col("place").alias("_r")), "host", ["_r", "_root"], most_roots)
    found = sitemap_locs(maps.select(F.col(url).alias("_map"), F.col(xml).alias("xml")), "xml")
    at_root = begun.join(found, begun["_root"] == found["_map"]).select("host", "_r", "is_index", "place", "u")
    follow = at_root.where("is_index").where(F.col("place") < children).select("host", "_r", F.col("place").alias("_c"), F.col("u").alias("_map"))
    below = follow.join(found.where("not is_index"), "_map").select("host", "_r", "_c", "place", "u")
    every = at_root.where("not is_index").select("host", "_r", F.lit(-1).alias("_c"), "place", "u").unionByName(below)
    met = every.groupBy("host", "u").agg(F.min(F.struct("_r", "_c", "place")).alias("m")).select("host", "u", "m.*")
    return _first_of(met, "host", ["_r", "_c", "place", "u"], per_host).select("host", "u")


def simple_sitemaps(hosts: DataFrame, maps: DataFrame, most: int = 200, first: int = 20) -> DataFrame:
    """``(host, u)``: the first ``first`` of a host's first ``most`` locations, from the first of two usual places that answers."""
    places = hosts.select("host", F.posexplode(F.array(F.concat(F.lit("https://"), "host", F.lit("/sitemap.xml")), F.concat(F.lit("https://"), "host", F.lit("/sitemap_index.xml")))).alias("_r", "url"))
    answered = places.join(maps.where("xml is not null and xml <> ''"), "url").groupBy("host").agg(F.min_by("xml", "_r").alias("xml"))
    return sitemap_locs(answered).where(F.col("place") < min(most, first)).select("host", "u")


def robots_sitemaps(robots: DataFrame, host: str = "host", body: str = "body") -> DataFrame:
    """``(host, sitemap)``: the sitemap lines of robots texts, or the usual place."""
    found = F.regexp_extract_all(F.coalesce(F.col(body), F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))
    usual = F.array(F.concat(F.lit("https://"), F.col(host), F.lit("/sitemap.xml")))
    return robots.select(host, F.explode(F.when(F.size(found) > 0, found).otherwise(usual)).alias("sitemap"))


def zone_domains(lines: DataFrame, suffix: str, line: str = "value", most: int | None = None) -> DataFrame:
    """Distinct registrable names of NS lines of a zone file whose name ends in ``suffix`` (taken literally, without dot); a run
    cap ``most`` takes the first in order of name.
    """
    name = F.lower(F.regexp_extract(F.col(line), r"(?i)^([a-z0-9-]+(?:\.[a-z0-9-]+)*)\.\s+(?:\d+\s+)?IN\s+NS(?![A-Za-z0-9_])", 1))
    found = lines.select(name.alias("n")).where((F.col("n") != "") & F.col("n").contains(".") & F.col("n").endswith(suffix)).select(urls.registrable(F.col("n")).alias("domain")).distinct()
    return found if most is None else run_cap(found, ["domain"], most)


def run_cap(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """The cap of a run: the first rows in an order."""
    return df.orderBy(*order).limit(most)


def mentions(lines: DataFrame, line: str = "value") -> DataFrame:
    """Mentions of tab-separated lines: address, host and tone (0 if no number); rows without http(s) address are left out."""
    c = F.split(F.col(line), "\t")
    return lines.select(F.try_element_at(c, F.lit(6)).alias("u"), F.lit("gdelt").alias("src"), F.coalesce(F.try_element_at(c, F.lit(5)), F.lit("")).alias("host"), F.coalesce(text.parse_float(F.try_element_at(c, F.lit(14))), F.lit(0.0)).alias("tone")).where(F.col("u").rlike("^https?://"))


def first_mentions(df: DataFrame, order: list[Column]) -> DataFrame:
    """Valid mentions, the first of each address."""
    fit = df.where(F.col("u").rlike("^https?://")).withColumn("host", F.coalesce("host", F.lit(""))).withColumn("tone", F.coalesce("tone", F.lit(0.0)))
    return keep_one(fit, ["u"], order)


def certificate_names(rows: DataFrame, names: str = "name_value", keep_subdomains: bool = False) -> DataFrame:
    """Distinct domains of certificate rows whose names stand in one text, one per line."""
    each = rows.select(F.explode(F.split(F.lower(F.col(names)), "\n")).alias("n")).select(F.trim("n").alias("n")).where(good_domain(F.col("n")))
    name = F.col("n") if keep_subdomains else urls.etld1(F.col("n"))
    return each.select(name.alias("domain")).where("domain is not null").distinct()


def issuance_names(rows: DataFrame, names: str = "dns_names", keep_subdomains: bool = False) -> DataFrame:
    """Distinct domains of certificate rows whose names stand in an array."""
    return certificate_names(rows.select(F.array_join(F.coalesce(F.col(names), F.array().cast("array<string>")), "\n").alias("name_value")), keep_subdomains=keep_subdomains)


def active_logs(doc: DataFrame) -> DataFrame:
    """Certificate logs of a log list (``operators`` of ``name`` and ``logs``) that are usable or qualified."""
    op = doc.select(F.explode("operators").alias("op")).select(F.col("op.name").alias("operator"), F.explode("op.logs").alias("log"))
    alive = op.where("log.state.usable is not null or log.state.qualified is not null")
    slug = text.slugify(F.concat_ws("-", "operator", "log.description"))
    return alive.select(F.col("log.description").alias("name"), slug.alias("slug"), F.regexp_replace("log.url", "/$", "").alias("url"), "operator")
