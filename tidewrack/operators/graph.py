"""Host graph: in-links, scores, edges and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions import urls
from tidewrack.session import cut

from .rank import order_statistics

DAMPING = 0.85
ITERATIONS = 20
MAX_DST = 20


def inlinks(pages: DataFrame, links: str = "links") -> DataFrame:
    """Every link occurrence counts for the bare host it leads to. Partial sums run before the shuffle: a hot host is one
    row per task.
    """
    out = pages.select(F.explode(F.col(links)).alias("link")).select(urls.bare_host(F.col("link")).alias("host")).where("host <> ''")
    return out.groupBy("host").agg(F.count("*").alias("incoming"))


def scores(counts: DataFrame) -> DataFrame:
    """Counts on a logarithmic scale of 0 to 30, relative to the largest."""
    top = counts.agg(F.max("incoming").alias("top"))
    scaled = F.round(F.log2(1 + F.col("incoming")) / F.log2(F.greatest(F.lit(2), F.col("top"))) * 30)
    return counts.crossJoin(F.broadcast(top)).select("host", "incoming", F.least(F.lit(30), scaled.cast("int")).alias("score"))  # one row


def merge_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Raw counts of two runs; scores are made of raw counts only."""
    return old.select("host", "incoming").unionByName(new.select("host", "incoming")).groupBy("host").agg(F.sum("incoming").cast("bigint").alias("incoming"))


def edges_from_text(docs: DataFrame, u: str = "u", c: str = "c", most: int = MAX_DST) -> DataFrame:
    """``(src, dst, cnt)`` of absolute addresses in texts: per document the first ``most`` hosts other than its own."""
    found = F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(r"(?i)https?://([a-z0-9.-]+)"), F.lit(1))
    src = urls.host_port(F.col(u))
    dst = F.slice(F.array_distinct(F.filter(found, lambda h: h != src)), 1, most)
    return docs.select(src.alias("src"), F.explode(dst).alias("dst")).where("src <> ''").groupBy("src", "dst").agg(F.count("*").alias("cnt"))


def edges_from_links(pages: DataFrame, u: str = "u", links: str = "links", most: int = MAX_DST) -> DataFrame:
    """``(src, dst, cnt)`` of link lists: per page the first ``most`` hosts other than its own."""
    src = urls.host_port(F.col(u))
    hosts = F.transform(F.coalesce(F.col(links), F.array().cast("array<string>")), lambda x: urls.host_port(x))
    dst = F.slice(F.array_distinct(F.filter(hosts, lambda h: (h != src) & (h != ""))), 1, most)
    return pages.select(src.alias("src"), F.explode(dst).alias("dst")).where("src <> ''").groupBy("src", "dst").agg(F.count("*").alias("cnt"))


def pagerank(edges: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING, redistribute: bool = False, cut_every: int = 5) -> DataFrame:
    """``(host, rank)`` with rank cut at the 95th percentile and scaled to 0..1.

    Edges carry 1/out-degree and stay partitioned by source; each step joins ranks of equal partitioning, sums shares per
    target with partial aggregation, and every fifth step's ranks are checkpointed to the shared folder, so that neither
    plans grow nor the loss of an executor ends the run. Dangling mass is lost unless ``redistribute``.
    """
    out = edges.groupBy("src").agg(F.count("*").alias("deg"))
    e = cut(edges.join(out, "src").select("src", "dst", (F.lit(1.0) / F.col("deg")).alias("w")))
    hosts = cut(e.select(F.col("src").alias("host")).unionByName(e.select(F.col("dst").alias("host"))).distinct().join(out.select(F.col("src").alias("host"), "deg"), "host", "left"))
    n = hosts.count()
    if not n:
        return hosts.select("host", F.lit(0.0).alias("rank"))
    ranks = hosts.select("host", F.lit(1.0 / n).alias("r"), F.col("deg").isNull().alias("dangling"))
    base = (1.0 - damping) / n
    for k in range(1, iterations + 1):
        mass = e.join(ranks.select(F.col("host").alias("src"), "r"), "src").groupBy("dst").agg(F.sum(F.col("w") * F.col("r")).alias("m"))
        step = hosts.select("host", F.col("deg").isNull().alias("dangling")).join(mass.withColumnRenamed("dst", "host"), "host", "left")
        if redistribute:
            lost = ranks.where("dangling").agg(F.coalesce(F.sum("r"), F.lit(0.0)).alias("lost"))
            step = step.crossJoin(F.broadcast(lost)).withColumn("m", F.coalesce("m", F.lit(0.0)) + F.col("lost") / n)  # one row
        ranks = step.select("host", (F.lit(base) + F.lit(damping) * F.coalesce("m", F.lit(0.0))).alias("r"), "dangling")
        if k % cut_every == 0 or k == iterations:
            ranks = cut(ranks)
    k = int(n * 0.05)
    top = F.lit(float(order_statistics(ranks, "r", [k], descending=True)[k]))
    return ranks.select("host", F.when(top > 0, F.least(F.lit(1.0), F.col("r") / top)).otherwise(0.0).alias("rank"))


def host_docs(df: DataFrame, u: str = "u") -> DataFrame:
    """Documents per host."""
    return df.select(urls.host_name(F.col(u)).alias("host")).where("host <> ''").groupBy("host").agg(F.count("*").alias("docs"))


def top_hosts(counts: DataFrame, by: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc(by), "host").limit(n)
