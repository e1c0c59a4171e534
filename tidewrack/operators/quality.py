"""Predicates on documents and host names, and counters of what they drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Languages kept by default, name endings and words left out (fixed values).
ALLOWED_LANGS = "en es fr de pt it nl ja zh ko ru ar hi tr pl sv id vi".split()
BAD_URL_END = r"(?i)\.(zip|onion)$"
BAD_HOST_END = r"(?i)\.(onion|zip|invalid|local|localhost|test|example)$"
ADULT_WORDS = "porn|xxx|escort|nsfw|hentai|cams?"
ADULT_WORDS_DOMAIN = "porn|xxx|escort|hentai|cams?"
MIN_TEXT = 120


def whole_word(words: str) -> str:
    """A pattern of words between other than ASCII word characters."""
    return rf"(?i)(?<![A-Za-z0-9_])({words})(?![A-Za-z0-9_])"


def is_good(langs: list[str] = ("en",), min_text: int = MIN_TEXT, u: str = "u", t: str = "t", c: str = "c", l: str = "l") -> Column:  # noqa: E741
    """Title of 5, text of ``min_text`` characters or more, language empty or allowed, no bad ending, no adult word."""
    adult = whole_word(ADULT_WORDS)
    fit = (F.length(t) >= 5) & (F.length(c) >= min_text) & (F.coalesce(l, F.lit("")).isin("", *langs)) & ~F.col(u).rlike(BAD_URL_END) & ~F.col(u).rlike(adult) & ~F.col(t).rlike(adult)
    return F.coalesce(fit, F.lit(False))


def good_host(h: Column) -> Column:
    """Host names worth crawling: no wildcard, no local or blocked ending, no adult word, two labels or more."""
    ok = (F.length(h) > 0) & (F.length(h) <= 253) & ~h.startswith("*.") & ~h.rlike(BAD_HOST_END) & ~h.rlike(whole_word(ADULT_WORDS)) & h.contains(".")
    return F.coalesce(ok, F.lit(False))


def good_domain(d: Column) -> Column:
    """Lower-case host names of letters, digits, dots and hyphens, without dots at the ends or adult words."""
    ok = (F.length(d) > 0) & (F.length(d) <= 253) & ~d.rlike("[^a-z0-9.-]") & ~d.startswith(".") & ~d.endswith(".") & ~d.rlike(whole_word(ADULT_WORDS_DOMAIN))
    return F.coalesce(ok, F.lit(False))


def cap_per_file(df: DataFrame, file: str, order: str, most: int = 60_000) -> DataFrame:
    """The first ``most`` rows of each source file."""
    w = Window.partitionBy(file).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def kept_dropped(df: DataFrame, kept: Column) -> DataFrame:
    """Rows seen, kept and dropped by a predicate."""
    return df.agg(F.count("*").alias("seen"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))
