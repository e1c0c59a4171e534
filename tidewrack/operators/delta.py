"""Differences of two versions of the shards, on 32-bit address hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions import hashing

from .shards import all_shards


def hashed(df: DataFrame, n: int = 128, u: str = "u") -> DataFrame:
    """One row per shard and hash; of several addresses with one hash the last in order of address stays."""
    rows = df.select(hashing.shard_of(F.col(u), n).alias("shard"), hashing.url_hash(F.col(u)).alias("hash"), F.col(u).alias("u"), F.xxhash64(*df.columns).alias("content"))
    return rows.groupBy("shard", "hash").agg(F.max("u").alias("u"), F.max_by("content", "u").alias("content"))


def added(cur: DataFrame, prev: DataFrame) -> DataFrame:
    return cur.join(prev, ["shard", "hash"], "left_anti").select("shard", "hash", "u")


def removed(cur: DataFrame, prev: DataFrame) -> DataFrame:
    return prev.join(cur, ["shard", "hash"], "left_anti").select("shard", "hash")


def changed(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Addresses of both versions whose content differs."""
    return cur.join(prev.select("shard", "hash", F.col("content").alias("old")), ["shard", "hash"]).where("content <> old").select("shard", "hash", "u")


def summary(cur: DataFrame, prev: DataFrame, n: int = 128) -> DataFrame:
    """Per shard documents, added and removed, with ``missing`` for shards that the new version lacks. One full join."""
    both = cur.select("shard", "hash", F.lit(1).alias("c")).join(prev.select("shard", "hash", F.lit(1).alias("p")), ["shard", "hash"], "full")
    per = both.groupBy("shard").agg(F.count("c").alias("docs"), F.count_if(F.col("p").isNull()).alias("added"), F.count_if(F.col("c").isNull()).alias("removed"))
    return all_shards(cur.sparkSession, n).join(per, "shard", "left").select("shard", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("added", F.lit(0)).alias("added"), F.coalesce("removed", F.lit(0)).alias("removed"), (F.coalesce("docs", F.lit(0)) == 0).alias("missing"))


def write_version(cur: DataFrame, prev: DataFrame, path: str, version: str) -> None:
    """Added and removed rows and the snapshot under one version; the newest version is the largest name."""
    ops = added(cur, prev).withColumn("op", F.lit("added")).unionByName(removed(cur, prev).withColumn("u", F.lit(None).cast("string")).withColumn("op", F.lit("removed")))
    ops.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/deltas/version={version}")
    cur.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/versions/version={version}")


def latest(spark: SparkSession, path: str, what: str = "versions") -> DataFrame:
    """The rows of the newest version; the engine prunes folders to it."""
    every = spark.read.parquet(f"{path}/{what}")
    newest = every.agg(F.max("version").alias("v")).first().v  # from folder names
    return every.where(F.col("version") == F.lit(newest))
