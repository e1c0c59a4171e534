"""Functions on addresses and host names, by regular expression: parsers of the engines reject or change some of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered (fixed values).
TWO_LEVEL = "co.uk org.uk ac.uk gov.uk co.jp or.jp ne.jp ac.jp com.au net.au org.au com.br com.mx com.ar com.cn co.in co.nz co.za co.kr com.tr com.tw com.hk com.sg".split()


def host_port(u: Column) -> Column:
    """Lower-case host, with the port unless it is the scheme's own; '' if none."""
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1))
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    own = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    return own


def host_name(u: Column) -> Column:
    """Lower-case host without port; '' if none."""
    return F.regexp_replace(host_port(u), r":\d*$", "")


def bare_host(u: Column) -> Column:
    """Host name without a leading ``www.``."""
    return F.regexp_replace(host_name(u), r"^www\.", "")


def etld1(host: Column) -> Column:
    """The registrable name, with the two-level suffixes above; null for a single label."""
    parts = F.split(host, r"\.", -1)
    last = lambda n: F.array_join(F.slice(parts, -n, n), ".")
    return F.when(F.size(parts) < 2, F.lit(None)).when((F.size(parts) >= 3) & last(2).isin(*TWO_LEVEL), last(3)).otherwise(last(2))


def registrable(host: Column) -> Column:
    """The last two labels; null for a single label."""
    parts = F.split(host, r"\.", -1)
    return F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), "."))


def resolve(href: Column, base: Column) -> Column:
    """A link of a page as absolute address without fragment; null unless http(s), protocol-relative or root-relative.

    Dot segments and percent escapes stay as they are.
    """
    scheme = F.lower(F.regexp_extract(base, "^([A-Za-z]+):", 1))
    origin = F.concat(scheme, F.lit("://"), host_port(base))
    full = F.when(href.rlike(r"^(?i:https?)://"), href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(href.startswith("/"), F.concat(origin, href))
    return F.regexp_replace(full, "#.*$", "")


def segment_id(path: Column) -> Column:
    """The name of an archive segment, or the start of the path's digest."""
    name = F.regexp_extract(path, r"([^/]+)\.warc\.gz$", 1)
    return F.when(name != "", name).otherwise(F.substring(F.sha1(path), 1, 16))
