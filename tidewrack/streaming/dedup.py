"""Streaming operators: rolling and run-scoped duplicates, incremental files, seed records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewrack.operators.quality import good_host


def rolling(stream: DataFrame, delay: str, key: str = "host", ts: str = "ts", hours: int = 24) -> DataFrame:
    """``(key, ts)``: the first event of a key and each first event ``hours`` or more after the last emission, in event time.

    An event is decided when the watermark, ``delay`` behind the latest time seen, has passed it, so the result does not
    depend on how events fall into micro-batches; events later than ``delay`` are left out. A suppressed event does not
    renew the time. The state of a key is its last emission and the distinct times that are not decided yet: it is dropped
    when the watermark is ``hours`` past the last emission, and bounded by the times within ``delay``. A run that ends
    emits what the watermark has passed; :func:`closed` adds the mark that lets it pass all.
    """
    gap = hours * 3_600_000_000

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, b"")
        times = set(np.frombuffer(held, dtype=np.int64).tolist())
        if not state.hasTimedOut:
            for b in batches:
                times.update(b["us"].tolist())
        mark = state.getCurrentWatermarkMs()
        out, rest = [], []
        for v in sorted(times):
            if v >= mark * 1000:
                rest.append(v)
            elif last is None or v - last >= gap:
                out.append(v)
                last = v
        if rest or (last is not None and last + gap >= mark * 1000):
            state.update((last, np.array(rest, dtype=np.int64).tobytes()))
            state.setTimeoutTimestamp(max((rest[0] if rest else last + gap) // 1000 + 1, mark + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({key: [k[0]] * len(out), "us": out})

    src = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    src = src.select(key, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    found = src.groupBy(key).applyInPandasWithState(fold, f"{key} string, us bigint", "last bigint, held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return found.where(F.col(key) != END).select(key, F.timestamp_micros("us").alias(ts))


#: The key of the mark that ends a bounded run.
END = "\x00end"


def closed(spark: SparkSession, path: str, schema, key: str, ts: str, at: str) -> None:
    """Add a file with one row of key :data:`END` at a time behind all others and their delay, so that a bounded run decides all."""
    row = spark.createDataFrame([(END,)], f"{key} string").withColumn(ts, F.lit(at).cast("timestamp"))
    row.select(*[(F.col(c.name) if c.name in (key, ts) else F.lit(None)).cast(c.dataType).alias(c.name) for c in schema]).write.mode("append").parquet(path)


def windows(stream: DataFrame, delay: str, ts: str, by: str, length: str = "6 hours") -> DataFrame:
    """``(from_ts, by, n)``: events per window of event time, final when the watermark has passed the window."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, length).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("from_ts"), by, "n")


def once(stream: DataFrame, key: str = "host") -> DataFrame:
    """Each key once a run, for ever."""
    return stream.dropDuplicates([key])


def seeds(entries: DataFrame) -> DataFrame:
    """Seed records of certificate log entries ``(log, entry, leaf)``: one row per acceptable host name."""
    from tidewrack.sources import ctlog

    leaf = F.unbase64("leaf")
    hosts = entries.select("log", ctlog.leaf_time(leaf).alias("ts"), F.explode(ctlog.certificate_hosts(ctlog.leaf_certificate(leaf))).alias("host"))
    return hosts.where(good_host(F.col("host"))).select(F.concat(F.lit("https://"), "host", F.lit("/")).alias("u"), F.col("host").alias("t"), F.lit("").alias("d"), F.lit("").alias("c"), F.lit("ct").alias("src"), "log", "ts")


def new_files(spark: SparkSession, path: str, schema, per_batch: int = 200, fmt: str = "json") -> DataFrame:
    """Files that came since the last run, at most ``per_batch`` a batch; the checkpoint is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(fmt).load(path)


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition: list[str] = (), max_records: int = 100_000) -> StreamingQuery:
    """Process what is there and end: a bounded run, exactly once into files by the checkpoint."""
    out = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_records).trigger(availableNow=True)
    return (out.partitionBy(*partition) if partition else out).start(path)


def flush_every(stream: DataFrame, path: str, checkpoint: str, minutes: int = 5) -> StreamingQuery:
    """Files every few minutes, in folders of date and hour; a failed flush is repeated from the checkpoint."""
    dated = stream.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("hour", F.date_format("ts", "HH"))
    return dated.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("maxRecordsPerFile", 100_000).partitionBy("day", "hour").trigger(processingTime=f"{minutes} minutes").start(path)
