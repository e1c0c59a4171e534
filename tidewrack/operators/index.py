"""Inverted index: postings with term frequency and field mask, in 256 buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions import hashing, text

#: Bits of the fields a term stands in (fixed values).
FIELD_BITS = {"t": 1, "d": 2, "u": 4, "k": 8}


def fields(t: Column, d: Column, u: Column, k: Column | None = None, body: Column | None = None) -> dict[str, Column]:
    """Indexed fields; keywords are joined by the first 4,000 characters of the body."""
    kw = F.concat_ws(" ", F.coalesce(k, F.lit("")) if k is not None else F.lit(""), F.substring(F.coalesce(body, F.lit("")), 1, 4000) if body is not None else F.lit(""))
    return {"t": t, "d": d, "u": text.url_words(u), "k": kw}


def postings(docs: DataFrame, ordinal: str, k: str | None = None, body: str | None = None, extra: list[str] = ()) -> DataFrame:
    """``(bucket, term, u, tf, mask, t, d)``: one row per term and address, of the last document of the address.

    The documents of an address are reduced to one before tokens are exploded, so no token of others is shuffled.
    """
    from .dedup import keep_one

    last = keep_one(docs.where("u is not null and u <> ''"), ["u"], [F.col(ordinal)], last=True)
    parts = fields(F.col("t"), F.col("d"), F.col("u"), F.col(k) if k else None, F.col(body) if body else None)

    def with_bit(tokens: Column, bit: int) -> Column:
        return F.transform(tokens, lambda w: F.struct(w.alias("term"), F.lit(bit).alias("bit")))

    tagged = F.concat(*[with_bit(text.index_tokens(c), FIELD_BITS[f]) for f, c in parts.items()])
    rows = last.select("u", F.substring(F.coalesce("t", F.lit("")), 1, 200).alias("t"), F.substring(F.coalesce("d", F.lit("")), 1, 300).alias("d"), *extra, F.explode(tagged).alias("x"))
    # an address has one document here, so its terms are grouped without its title in the key
    grouped = rows.groupBy("u", F.col("x.term").alias("term")).agg(F.count("*").cast("int").alias("tf"), F.bit_or("x.bit").alias("mask"), F.first("t").alias("t"), F.first("d").alias("d"), *[F.first(e).alias(e) for e in extra])
    return grouped.select(hashing.bucket_of(F.col("term")).alias("bucket"), "term", "u", "tf", "mask", "t", "d", *extra)


def term_stats(p: DataFrame) -> DataFrame:
    """Documents and occurrences per term."""
    return p.groupBy("bucket", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def bucket_stats(p: DataFrame) -> DataFrame:
    """Terms and postings per bucket, from term counts: no distinct over postings."""
    return term_stats(p).groupBy("bucket").agg(F.count("*").alias("terms"), F.sum("df").cast("bigint").alias("postings"))


def write_index(p: DataFrame, path: str, batch_id: int) -> None:
    """Postings in one folder per batch and bucket, and beside them the length of each document, so that a search reads
    folders of its terms only. The engine splits large buckets and joins small ones.
    """
    own = p.drop("batch_id")
    own.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").withColumn("batch_id", F.lit(batch_id)).write.mode("append").partitionBy("batch_id", "bucket").option("compression", "zstd").parquet(f"{path}/postings")
    lengths = open_postings(p.sparkSession, path).where(F.col("batch_id") == batch_id).groupBy("u").agg(F.sum("tf").cast("bigint").alias("len"))
    lengths.withColumn("batch_id", F.lit(batch_id)).write.mode("append").partitionBy("batch_id").option("compression", "zstd").parquet(f"{path}/lengths")


def open_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/postings")


def chunked(p: DataFrame, chunks: int = 64) -> DataFrame:
    """Postings of a term as arrays, in ``chunks`` pieces by address, so that a term of all documents is no single row."""
    piece = F.pmod(F.xxhash64("u"), F.lit(chunks)).cast("int").alias("chunk")
    return p.groupBy("bucket", "term", piece).agg(F.sort_array(F.collect_list(F.struct("u", "tf", "mask", "t", "d"))).alias("d"))
