"""Fields of HTML pages by declarative expressions: one projection, no shuffle, no Python.

One scanner gives the tags of interest in page order, each with its name and its attributes; all fields are looked up in
that list. A value ends at its own quotation mark or, unquoted, at a blank; of repeated attributes the first counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions import hashing, text, urls

SCANNED = ("html", "meta", "link", "a")
_OPENED = rf"(?i)<(?:{'|'.join(SCANNED)})\s[^<>]*>"
_ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def tags(html: Column) -> Column:
    """``array<struct<name, attributes: array<struct<key, value>>>>`` of the scanned tags of a page."""

    def bare(value: Column) -> Column:
        return F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    def one(tag: Column) -> Column:
        keys = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
        values = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2)), bare)
        pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
        return F.struct(F.lower(F.regexp_extract(tag, "^<([A-Za-z]+)", 1)).alias("name"), pairs.alias("attributes"))

    return F.transform(F.regexp_extract_all(html, F.lit(_OPENED), F.lit(0)), one)


def attribute(tag: Column, key: str) -> Column:
    """The value of an attribute of a tag; null if it has none."""
    return F.get(F.filter(tag["attributes"], lambda a: a["key"] == key), F.lit(0))["value"]


def values(found: Column, name: str, key: str, where: Callable[[Column], Column] | None = None) -> Column:
    """Values of an attribute that are not empty, of all tags of a name (that fit), in page order."""
    fit = F.filter(found, lambda t: (t["name"] == name) & (where(t) if where else F.lit(True)))
    return F.filter(F.transform(fit, lambda t: attribute(t, key)), lambda v: F.coalesce(v != "", F.lit(False)))


def labelled(key: str, label: str) -> Callable[[Column], Column]:
    """Tags in which an attribute has a value, whatever its case."""
    return lambda t: F.coalesce(F.lower(attribute(t, key)) == label, F.lit(False))


def between(html: Column, name: str) -> Column:
    """What the first element of a name holds; '' if it is not there or not closed."""
    low = F.lower(html)
    opened = F.locate(f"<{name}", low)
    start = _locate(F.lit(">"), html, opened)
    end = _locate(F.lit(f"</{name}"), low, start)
    return F.when((opened > 0) & (start > 0) & (end > 0), F.substring(html, start + 1, end - start - 1)).otherwise("")


def _locate(part: Column, whole: Column, start: Column) -> Column:
    """Place of a part from a place on; 0 if it is not there."""
    return F.call_function("locate", part, whole, F.greatest(start, F.lit(1)))


def _first(*lists: Column) -> Column:
    """The first value of the first list that has one, else ''."""
    return F.coalesce(*[F.get(x, F.lit(0)) for x in lists], F.lit(""))


def extract_doc(pages: DataFrame, url: str = "url", html: str = "html", with_digest: bool = True) -> DataFrame:
    """``u, t, d, c, l, s`` of pages: title, raw description, text of the first 40,000 characters from the body tag on,
    language without region, similarity digest of title and text. Null html counts as empty.
    """
    scanned = pages.withColumn("_h", F.coalesce(F.col(html), F.lit(""))).withColumn("_tags", tags(F.col("_h")))
    h, found = F.col("_h"), F.col("_tags")
    window = F.substring(h, F.greatest(F.locate("<body", F.lower(h)), F.lit(1)), F.lit(40_000))
    lang = F.filter(values(found, "html", "lang"), lambda v: v.rlike("^[A-Za-z-]+$"))
    out = scanned.select(
        F.coalesce(F.nullif(_first(values(found, "link", "href", labelled("rel", "canonical"))), F.lit("")), F.col(url)).alias("u"),
        F.substring(text.strip_tags(between(h, "title")), 1, 200).alias("t"),
        F.substring(_first(values(found, "meta", "content", labelled("name", "description"))), 1, 400).alias("d"),
        F.substring(text.strip_tags(window), 1, 2000).alias("c"),
        F.split(F.lower(_first(lang)), "-")[0].alias("l"),
    )
    return out.withColumn("s", hashing.simhash(F.concat_ws(" ", "t", "c"))) if with_digest else out


def crawl_doc(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Fields of the crawler's pages; og values first, language as it stands, text of the whole page, at most 64 links.

    Of the first 128 links that resolve, distinct ones in page order are kept.
    """
    scanned = pages.withColumn("_h", F.substring(F.coalesce(F.col(html), F.lit("")), 1, 400_000)).withColumn("_tags", tags(F.col("_h")))
    h, found = F.col("_h"), F.col("_tags")
    og = lambda what: text.collapse(_first(values(found, "meta", "content", labelled("property", f"og:{what}"))))
    plain = lambda *lists: text.collapse(_first(*lists))
    either = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c], F.lit(""))
    resolved = F.filter(F.transform(values(found, "a", "href"), lambda x: urls.resolve(x, F.col(url))), lambda x: x.isNotNull())
    return scanned.select(
        F.col(url).alias("u"), either(og("title"), text.collapse(between(h, "title"))).alias("t"), either(plain(values(found, "meta", "content", labelled("name", "description"))), og("description")).alias("d"), F.substring(text.strip_tags_crawl(h), 1, 2000).alias("text"),
        F.nullif(plain(values(found, "link", "href", labelled("rel", "canonical"))), F.lit("")).alias("canonical"), F.nullif(og("image"), F.lit("")).alias("image"), F.nullif(plain(values(found, "html", "lang")), F.lit("")).alias("lang"),
        F.slice(F.array_distinct(F.slice(resolved, 1, 128)), 1, 64).alias("links"),
    ).where("t <> '' or text <> ''")
