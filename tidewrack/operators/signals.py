"""Per-address signals of the newest crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup(pages: DataFrame, date: str = "date", url: str = "url", tech: str = "tech", k: int = 8, exact: bool = True, limit: int | None = None) -> DataFrame:
    """Of the newest date: per address the ``k`` most frequent technologies, mean performance and SEO, https and mobile.

    Exact counts are made per address and technology before addresses are put together; a bounded approximation uses the
    built-in top-k sketch.
    """
    newest = pages.agg(F.max(date).alias(date))
    now = pages.join(F.broadcast(newest), date)  # one row
    means = now.groupBy(url).agg(F.avg("perf").alias("perf"), F.avg("seo").alias("seo"), F.max("https").alias("https"), F.max("mobile").alias("mobile"))
    if exact:
        per = now.where(F.col(tech).isNotNull()).groupBy(url, tech).agg(F.count("*").alias("n"))
        top = per.groupBy(url).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(tech).alias("item")))), 1, k).alias("x"))
        top = top.select(url, F.transform("x", lambda e: F.struct(e["item"].alias("item"), (-e["m"]).alias("count"))).alias("tech"))
    else:
        top = now.groupBy(url).agg(F.expr(f"approx_top_k({tech}, {int(k)})").alias("tech"))
    out = means.join(top, url, "left")
    return out if limit is None else out.orderBy(url).limit(limit)
