"""Hash shards: counts, manifests with empty shards, partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions import hashing


def with_shard(df: DataFrame, n: int = 128, u: str = "u") -> DataFrame:
    return df.withColumn("shard", hashing.shard_of(F.col(u), n))


def shard_counts(df: DataFrame, n: int = 128, u: str = "u", payload: str = "c") -> DataFrame:
    """Documents and payload bytes per shard."""
    return with_shard(df, n, u).groupBy("shard").agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)).cast("bigint").alias("bytes"))


def all_shards(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("shard"))


def with_empty(counts: DataFrame, n: int) -> DataFrame:
    """Counts with a row of zeros for every empty shard; the lookup side is the counts, at most ``n`` rows."""
    return all_shards(counts.sparkSession, n).join(counts, "shard", "left").fillna(0, ["docs", "bytes"])


def batch_manifest(df: DataFrame, n: int = 128, batch: str = "batch_id", u: str = "u") -> DataFrame:
    """Per shard the batches that hold documents of it: ``entries`` = sorted (batch, docs, path); [] for empty shards."""
    per = with_shard(df, n, u).groupBy("shard", batch).agg(F.count("*").alias("docs"))
    path = F.concat(F.lit("shards/batches/"), hashing.padded(F.col(batch), 6), F.lit("/shard-"), hashing.padded(F.col("shard"), 3))
    lists = per.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct(F.col(batch).alias("batch"), "docs", path.alias("path")))).alias("entries"))
    return all_shards(df.sparkSession, n).join(lists, "shard", "left").withColumn("entries", F.coalesce("entries", F.expr("array()")))


def write_sharded(df: DataFrame, path: str, n: int = 128, u: str = "u", payload: str = "c", fmt: str = "parquet", max_records: int = 0) -> DataFrame:
    """Write one folder per shard; the engine splits hot shards and joins small ones, and the manifest comes after the data.

    Parquet is written with zstd, json with gzip. Returns the manifest: documents and bytes of the column ``payload`` of every
    shard, empty ones included, counted from what was written.
    """
    out = with_shard(df, n, u).hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").option("maxRecordsPerFile", max_records)
    (out.option("compression", "zstd") if fmt == "parquet" else out.option("compression", "gzip")).format(fmt).save(path)
    back = df.sparkSession.read.schema(with_shard(df, n, u).schema).format(fmt).load(path)
    counts = back.groupBy("shard").agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)).cast("bigint").alias("bytes"))
    where = path.rstrip("/") + "-manifest"
    with_empty(counts, n).coalesce(1).write.mode("overwrite").json(where)
    return df.sparkSession.read.schema("shard int, docs bigint, bytes bigint").json(where)


def lookback(df: DataFrame, ordinal: str, as_of: str, days: int = 30, ts: str = "ts", u: str = "u") -> DataFrame:
    """What a rebuild from the last ``days`` before ``as_of`` holds: the first record of each address."""
    from .dedup import keep_one

    recent = df.where((F.col(ts) > F.expr(f"timestamp '{as_of}' - interval {int(days)} days")) & (F.col(ts) <= F.expr(f"timestamp '{as_of}'")) & F.col(u).isNotNull())
    return keep_one(recent, [u], [F.col(ordinal)])
