"""Text functions on columns. Regular expressions follow one rule: no ``\\b`` (its meaning differs between engines)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks that scripting engines of browsers fold (fixed values).
WS = r"[\s\u000B   -     　﻿]"

#: Words an index leaves out (fixed values).
STOP_WORDS = (
    "the a an and or but of in on at to for from by with is are was were be been being have has had do does did will would should could may might must can "
    "this that these those it its he she they we you i as if not no yes so up out new one all any"
).split()


def collapse(c: Column) -> Column:
    """Runs of blanks to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def _without_markup(c: Column) -> Column:
    """Scripts, styles and tags become blanks (fixed behaviour: what is text decides tokens, digests and cuts at lengths)."""
    for pattern in (r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    return c


def _entities(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for entity, char in pairs:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_tags(c: Column) -> Column:
    """Visible text of mark-up; entities are decoded in this order (fixed behaviour), so a doubly escaped one is decoded twice."""
    return collapse(_entities(_without_markup(c), [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]))


def strip_tags_crawl(c: Column) -> Column:
    """Visible text as the crawler takes it: numeric blanks and ``&apos;`` too, quotes last."""
    pairs = [("&nbsp;", " "), ("&#160;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&apos;", "'"), ("&quot;", '"')]
    return collapse(_entities(_without_markup(c), pairs))


def index_tokens(c: Column) -> Column:
    """Runs of 2 to 32 letters and digits, lower case; longer runs are cut into pieces; no stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]{2,32}"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*STOP_WORDS))


def bloom_tokens(c: Column) -> Column:
    """Runs of at least 3 letters and digits, lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]{3,}"), F.lit(0))


def simhash_tokens(c: Column) -> Column:
    """Pieces between other than ASCII word characters, longer than 2."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^A-Za-z0-9_]+"), lambda t: F.length(t) > 2)


def url_words(c: Column) -> Column:
    """An address as text: everything but letters and digits becomes a blank."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", " ")


def parse_float(c: Column) -> Column:
    """The number a text starts with, else null."""
    return F.regexp_extract(c, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1).try_cast("double")


def split_list(c: Column) -> Column:
    """Pieces between commas or line ends, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, "[,\n]"), lambda x: F.trim(x)), lambda x: x != "")


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")
