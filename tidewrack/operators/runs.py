"""What runs report and remember: manifests, counters, histories, fallbacks between sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewrack.session import cut

PAGE_TYPES = r"(?i)html|xml|text/plain"
MAX_PAGE_BYTES = 512_000


def index_manifest(postings: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: documents, terms and postings. Terms and documents are counted from groups, without a wide distinct."""
    terms = postings.groupBy(batch, "term").agg(F.count("*").alias("n")).groupBy(batch).agg(F.count("*").alias("terms"), F.sum("n").cast("bigint").alias("postings"))
    docs = postings.groupBy(batch, "u").agg(F.lit(1).alias("one")).groupBy(batch).agg(F.count("*").alias("docs"))
    return docs.join(terms, batch).select(batch, "docs", "terms", "postings")


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """The same rows, with counters that are made on the way when an action runs; read them from the observation."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counters.items()]), seen


def fetched_pages(replay: DataFrame, status: str = "status", content_type: str = "content_type", body: str = "html") -> DataFrame:
    """Stored answers worth parsing: success, a page's content type, the body cut at the size cap; others get status 415."""
    ok = F.col(status).between(200, 299) & F.coalesce(F.col(content_type), F.lit("")).rlike(PAGE_TYPES)
    return replay.withColumn(status, F.when(F.col(status).between(200, 299) & ~ok, 415).otherwise(F.col(status))).withColumn(body, F.when(ok, F.substring(body, 1, MAX_PAGE_BYTES)))


def first_with_rows(spark: SparkSession, sources: list[Callable[[], DataFrame]]) -> DataFrame:
    """The rows of the first source that has any; later ones are not read."""
    df = None
    for source in sources:
        df = source()
        if not df.isEmpty():
            break
    if df is None:
        raise ValueError("no source")
    return df


def history(batches: DataFrame, order: str, keep: int = 30, samples: str | None = None, most: int = 50) -> DataFrame:
    """The last ``keep`` batches of a run table (one row a batch), with at most ``most`` samples each."""
    last = batches.orderBy(F.desc(order)).limit(keep)
    return last if samples is None else last.withColumn(samples, F.slice(samples, 1, most))


def batch_samples(df: DataFrame, batch: str, u: str, most: int = 50) -> DataFrame:
    """At most ``most`` addresses of each batch, by digest; counted in pieces, so that no batch is a single sort."""
    pieces = df.select(batch, u, F.md5(u).alias("_h")).withColumn("_p", F.pmod(F.xxhash64(u), F.lit(32)))
    first = pieces.withColumn("_n", F.row_number().over(Window.partitionBy(batch, "_p").orderBy("_h", u))).where(F.col("_n") <= most)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(batch).orderBy("_h", u))).where(F.col("_n") <= most).groupBy(batch).agg(F.array_sort(F.collect_list(u)).alias("sample"))


def read_through(df: DataFrame, reliable: bool = False) -> DataFrame:
    """A table kept for repeated reads: in memory and on disk, or (``reliable``) in the shared checkpoint folder."""
    return cut(df) if reliable else df.persist(StorageLevel.MEMORY_AND_DISK)


def write_dated(df: DataFrame, path: str, ts: str) -> None:
    """Rows in folders of date and hour; the batch of a folder is named by its content, so that the same rows written again
    are the same batch.
    """
    dated = df.withColumn("day", F.date_format(ts, "yyyy-MM-dd")).withColumn("hour", F.date_format(ts, "HH"))
    names = dated.groupBy("day", "hour").agg(F.substring(F.sha1(F.concat_ws(":", F.bit_xor(F.xxhash64(*df.columns)).cast("string"), F.count("*").cast("string"))), 1, 10).alias("batch"))
    dated.join(names, ["day", "hour"]).hint("rebalance", "day", "hour").write.mode("append").partitionBy("day", "hour", "batch").parquet(path)
