"""Queries over postings: all terms, ranked, over tiers."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions.urls import bare_host

from .index import open_postings

K1, B = 1.2, 0.75


def open_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(postings, lengths)`` of a written index."""
    return open_postings(spark, path), spark.read.parquet(f"{path}/lengths")


def _terms(p: DataFrame, terms: list[str]) -> DataFrame:
    """Postings of the terms. Of a written index only the folders of their buckets are read."""
    return p.where(F.col("bucket").isin(*sorted({term_bucket(t) for t in terms})) & F.col("term").isin(*terms))


def match_all(p: DataFrame, terms: list[str]) -> DataFrame:
    """Addresses that hold every term, with summed frequency and field mask."""
    want = sorted(set(terms))
    got = _terms(p, want).groupBy("u").agg(F.count("*").alias("n"), F.sum("tf").cast("bigint").alias("tf"), F.bit_or("mask").alias("mask"))
    return got.where(F.col("n") == len(want)).drop("n")


def ranked(p: DataFrame, lengths: DataFrame, terms: list[str], scores: DataFrame | None = None, limit: int = 15) -> DataFrame:
    """The best addresses that hold every term, by BM25 times one plus the host's score share.

    Document lengths are stored with the index (one row a document); the terms' own counts are a few rows.
    ``scores`` (host, score 0..30) is a table of hosts, joined by a shuffle unless the engine measures it as small.
    """
    want = sorted(set(terms))
    whole = lengths.agg(F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"))
    hit = _terms(p, want)
    df = hit.groupBy("term").agg(F.count("*").alias("df"))
    # only documents that hold every term take part in the joins
    full = hit.groupBy("u").agg(F.count("*").alias("n"), F.collect_list(F.struct("term", "tf")).alias("x"), F.first("t").alias("t")).where(F.col("n") == len(want))
    per = full.join(lengths.select("u", "len"), "u").select("u", "t", "len", F.explode("x").alias("x")).select("u", "t", "len", "x.*")
    per = per.join(F.broadcast(df), "term").crossJoin(F.broadcast(whole))  # one row per term, one row of totals
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    docs = per.groupBy("u").agg(F.sum(weight).alias("bm25"), F.first("t").alias("t"))
    if scores is not None:
        docs = docs.withColumn("host", bare_host(F.col("u"))).join(scores.select("host", "score"), "host", "left")
        final = F.col("bm25") * (1 + F.coalesce("score", F.lit(0)) / 30.0)
    else:
        final = F.col("bm25")
    return docs.select("u", "t", F.round(final, 6).alias("rank_score")).orderBy(F.desc("rank_score"), "u").limit(limit)


def merge_tiers(hot: DataFrame, deep: DataFrame, key: str = "u") -> DataFrame:
    """Rows of both tiers, the hot one first where both have a key."""
    both = hot.withColumn("tier", F.lit(0)).unionByName(deep.withColumn("tier", F.lit(1)))
    return both.groupBy(key).agg(F.min_by(F.struct(*[c for c in hot.columns if c != key], "tier"), "tier").alias("r")).select(key, "r.*")


def newest_batch(p: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Postings of all batches; of a term and address, those of the newest batch."""
    rest = [c for c in p.columns if c not in ("term", "u")]
    return p.groupBy("term", "u").agg(F.max_by(F.struct(*rest), F.col(batch)).alias("r")).select("term", "u", "r.*")


def term_bucket(term: str) -> int:
    """The bucket of one term, for pruning."""
    return int(hashlib.sha1(term.encode()).hexdigest()[:2], 16)


__all__ = ["match_all", "open_index", "ranked", "merge_tiers", "newest_batch", "term_bucket"]
