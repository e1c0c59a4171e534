"""Progress, latency, readiness and run rates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut

from .rank import order_statistics

#: Registered domains per day that shares refer to (fixed value).
NEW_DOMAINS_A_DAY = 250_000


def progress(segments: DataFrame, done: DataFrame, claimed: DataFrame) -> DataFrame:
    """Totals of segments, done, claimed and remaining, with the share done and the bytes made."""
    d = segments.select("id").join(done.groupBy("id").agg(F.sum("bytes").alias("bytes")), "id", "left").join(claimed.select("id").distinct().withColumn("c", F.lit(1)), "id", "left")
    got = d.agg(F.count("*").alias("total"), F.count("bytes").alias("done"), F.count_if(F.col("bytes").isNull() & F.col("c").isNotNull()).alias("claimed"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("raw_bytes"))
    return got.select("total", "done", "claimed", (F.col("total") - F.col("done") - F.col("claimed")).alias("remaining"), F.format_string("%.2f%%", 100.0 * F.col("done") / F.col("total")).alias("pct"), "raw_bytes")


def latency(samples: DataFrame, dur: str = "dur", points: tuple[int, ...] = (50, 95, 99)) -> DataFrame:
    """Requests, errors, non-empty answers, mean and percentiles (the value at position floor(n*p/100), capped at the last).

    Percentiles come from counts of equal values in range partitions; no task orders all of them.
    """
    whole = samples.agg(F.count("*").alias("requests"), F.count_if(~F.col("ok")).alias("errors"), F.count_if(F.col("ok") & (F.col("results") > 0)).alias("non_empty"), F.round(F.avg(dur), 6).alias("mean"))
    timed = samples.agg(F.count(dur)).first()[0]
    at = {p: timed * p // 100 for p in points}
    got = order_statistics(samples, dur, at.values())
    kind = samples.schema[dur].dataType
    return whole.select("*", *[F.lit(got[at[p]]).cast(kind).alias(f"p{p}") for p in points])


def readiness(stats: DataFrame, p95_ms: float = 800, error_rate: float = 0.01, non_empty: float = 0.85) -> DataFrame:
    """Whether a load test meets its aims."""
    err, full = F.col("errors") / F.col("requests"), F.col("non_empty") / F.greatest(F.lit(1), F.col("requests") - F.col("errors"))
    return stats.select(F.round(err, 6).alias("error_rate"), F.round(full, 6).alias("non_empty_rate"), "p95", ((F.col("p95") < p95_ms) & (err < error_rate) & (full >= non_empty)).alias("ready"))


def run_rates(n: Column, seconds: Column, total: Column) -> list[Column]:
    """Shares of the day's new domains by quarter-hour runs and by 30 days, projection to a day, pages an hour, sweep."""
    return [
        F.round(n * 96.0 / NEW_DOMAINS_A_DAY * 100, 4).alias("share_quarter_hourly"), F.round(n / 30.0 / NEW_DOMAINS_A_DAY * 100, 4).alias("share_30_days"), F.round(n * 86400.0 / seconds, 4).alias("per_day"),
        F.round(n * 3600.0 / seconds, 4).alias("per_hour"), F.round(100.0 * n / total, 4).alias("sweep_pct"),
    ]


def ttl_emissions(events: DataFrame, key: str, ts: str, hours: int = 24) -> DataFrame:
    """``(key, emitted_at)``: the first event of a key, then each first event at least ``hours`` after the last emission.

    Distinct events are range-partitioned by key and time, so a key with a tenth of all rows is many partitions. A
    partition depends on earlier ones only by the last emission of the key it begins with. One that holds other keys too
    ends with a state of its own; one inside a key tells the state it ends with for each event that could be the first
    to be emitted (those within ``hours`` of its first event; equal ends are joined). The driver chains one such function
    a partition, and a second pass emits in all partitions at once.
    """
    gap = hours * 3600 * 1_000_000
    kind = events.schema[key].dataType.simpleString()
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    src = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("k"), us.alias("us")).distinct()
    parts = cut(src.repartitionByRange("k", "us").sortWithinPartitions("k", "us").withColumn("_p", F.spark_partition_id()))

    def chain(us: np.ndarray) -> np.ndarray:
        """For each event the last emission of a chain that begins with it."""
        after = np.searchsorted(us, us + gap, side="left")
        last = us.copy()
        for i in range(len(us) - 1, -1, -1):
            if after[i] < len(us):
                last[i] = last[after[i]]
        return last

    def gather(batches: Iterator[pa.RecordBatch]) -> tuple[list, np.ndarray, int] | None:
        names, times, p = [], [], 0
        for b in batches:
            if b.num_rows:
                names += b.column(0).to_pylist()
                times.append(b.column(1).to_numpy())
                p = b.column(2)[0].as_py()
        return (names, np.concatenate(times), p) if names else None

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches)
        if got is None:
            return
        names, us, p = got
        tail = len(names) - 1
        while tail and names[tail - 1] == names[-1]:
            tail -= 1
        ends = chain(us[tail:])
        rows = [(p, names[0], names[-1], bool(tail), -1, int(ends[0]))]  # entered without a state
        if not tail:
            reach = int(np.searchsorted(us, us[0] + gap, side="right")) + 1
            for i in range(min(len(us), reach)):
                if rows[-1][4] < 0 or rows[-1][5] != int(ends[i]):
                    rows.append((p, names[0], names[-1], False, int(us[i]), int(ends[i])))
                else:
                    rows[-1] = (*rows[-1][:4], int(us[i]), rows[-1][5])
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()))], names=["p", "first", "last", "own", "upto", "end"])

    told: dict[int, list] = {}
    for r in parts.select(F.col("k").cast("string").alias("k"), "us", "_p").mapInArrow(tell, "p bigint, first string, last string, own boolean, upto bigint, end bigint").collect():
        told.setdefault(r.p, []).append(r)
    entry: dict[int, int | None] = {}
    now: tuple[str | None, int] = (None, 0)
    for p in sorted(told):
        rows = sorted(told[p], key=lambda r: r.upto)
        state = now[1] if now[0] == rows[0].first else None
        entry[p] = state
        if rows[0].own or state is None:
            end = rows[0].end
        else:  # the first event at least a gap after the last emission; none leaves the state as it is
            end = next((r.end for r in rows[1:] if r.upto >= state + gap), state)
        now = (rows[0].last, end)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = None, None
        begun = False
        for b in batches:
            if not b.num_rows:
                continue
            names, us = b.column(0).to_pylist(), b.column(1).to_pylist()
            if not begun:
                begun, name, last = True, names[0], entry[b.column(2)[0].as_py()]
            keep = []
            for i, (k, v) in enumerate(zip(names, us)):
                if k != name:
                    name, last = k, None
                if last is None or v >= last + gap:
                    last = v
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], names=["k", "us"])

    found = parts.select(F.col("k").cast("string").alias("k"), "us", "_p").mapInArrow(emit, "k string, us bigint")
    return found.select(F.col("k").cast(kind).alias(key), F.timestamp_micros("us").alias("emitted_at"))
