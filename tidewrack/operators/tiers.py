"""Storage tiers over object listings ``(key, size, ts)``: ages, budgets, pruning and packing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut

from .rank import Steps

GIB = 1 << 30


def file_time(key: Column) -> Column:
    """The time in an object's name: dashed ISO, milliseconds of the epoch before the ending, or yyyymmddHHMM; else null."""
    iso = F.regexp_extract(key, r"(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})", 1)
    ms = F.regexp_extract(key, r"-(\d{13})\.ndjson\.gz$", 1)
    minute = F.regexp_extract(key, r"(?:^|/)(\d{12})(?:\d{2})?\.", 1)
    return F.coalesce(F.try_to_timestamp(F.nullif(iso, F.lit("")), F.lit("yyyy-MM-dd'T'HH-mm-ss")), F.timestamp_millis(F.nullif(ms, F.lit("")).try_cast("bigint")), F.try_to_timestamp(F.nullif(minute, F.lit("")), F.lit("yyyyMMddHHmm")))


def age_tier(objects: DataFrame, as_of: str, ts: str = "ts", warm: int = 30, cold: int = 180) -> DataFrame:
    """Tier by age at a given time: hot up to ``warm`` days, warm up to ``cold``, then cold; unknown ages stay hot."""
    days = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(ts)) / 86400.0
    return objects.withColumn("tier", F.when(F.col(ts).isNull() | (days <= warm), "hot").when(days <= cold, "warm").otherwise("cold"))


def _running(df: DataFrame, order: list[Column], size: str) -> DataFrame:
    """Adds ``before``: the sum of sizes of all earlier rows in a total order, without one task seeing all rows.

    Rows are range-partitioned by the order; partition sums (one row a partition) are added up, and the running sum within
    a partition starts from them.
    """
    parts = cut(df.withColumn("_o", F.struct(*order)).repartitionByRange("_o").withColumn("_p", F.spark_partition_id()))
    sums = parts.groupBy("_p").agg(F.sum(size).alias("_s"), F.min("_o").alias("_lo"))
    offset = sums.withColumn("_base", F.coalesce(F.sum("_s").over(Window.orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_base")
    w = Window.partitionBy("_p").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    return parts.join(F.broadcast(offset), "_p").withColumn("before", F.col("_base") + F.coalesce(F.sum(size).over(w), F.lit(0))).drop("_p", "_o", "_base")  # one row a partition


def within_budget(objects: DataFrame, budget: int, done: DataFrame | None = None, size: str = "size", order: tuple[str, ...] = ("ts", "key")) -> DataFrame:
    """Oldest objects first until the next would exceed the budget; objects already copied do not use it up."""
    todo = objects if done is None else objects.join(done.select("key"), "key", "left_anti")
    return _running(todo, [F.col(c) for c in order], size).where(F.col("before") + F.col(size) <= budget).drop("before")


def prune_plan(objects: DataFrame, cap: int, target_share: float = 0.95, size: str = "size", order: tuple[str, ...] = ("ts", "key")) -> DataFrame:
    """Objects to delete, oldest first, until the total is at most the share of the cap; none if it is under the cap."""
    total = objects.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total"))
    need = total.select(F.when(F.col("total") > cap, F.col("total") - int(cap * target_share)).otherwise(0).alias("need"))
    return _running(objects, [F.col(c) for c in order], size).crossJoin(F.broadcast(need)).where("before < need").drop("before", "need")  # one row


def _bin_starts(sizes: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a stretch of sizes: prefix sums, and for a bin begun at each place the bins begun after it and the last one's
    use at the end of the stretch.
    """
    m = len(sizes)
    c = np.zeros(m + 1, dtype=np.int64)
    np.cumsum(sizes, out=c[1:])
    fits = np.searchsorted(c, c[:-1] + target, side="right") - 1  # the bin holds places up to here
    some = np.searchsorted(c, c[:-1], side="right")  # one past the first size that is not zero: it is taken in any case
    after = np.maximum(fits, np.minimum(some, m)).tolist()
    begun, last = [0] * (m + 1), [0] * (m + 1)
    ends = c.tolist()
    for i in range(m - 1, -1, -1):
        j = after[i]
        if j < m:
            begun[i], last[i] = begun[j] + 1, last[j]
        else:
            last[i] = ends[m] - ends[i]
    return c, np.array(begun[:m], dtype=np.int64), np.array(last[:m], dtype=np.int64)


GROUP = 64  # partitions whose steps are put together in one task


def _steps(sizes: np.ndarray, target: int) -> Steps:
    """What a stretch of sizes does to an open bin: bins begun in it, and the use of the last one at its end."""
    c, begun, last = _bin_starts(sizes, target)
    m = len(sizes)
    # a bin of use u > 0 is left at the first place whose end passes the target: u > target - c[place + 1]
    reach = min(m, int(np.searchsorted(c, target, side="right")))
    steps = [(max(0, target - int(c[i + 1])), int(begun[i]) + 1, int(last[i])) for i in range(reach - 1, -1, -1)]
    kept: dict[int, tuple[int, int, int]] = {}
    for x in steps:  # of equal bounds the first place
        kept[x[0]] = x
    first = int(np.searchsorted(c, 0, side="right")) - 1  # an empty bin takes in the first size that is not zero
    over = np.flatnonzero(c[first + 2 :] > target) if first < m else np.zeros(0, int)
    zero = (int(begun[first + 1 + over[0]]) + 1, int(last[first + 1 + over[0]])) if len(over) else (0, int(c[m]))
    return Steps(zero, int(c[m]), list(kept.values()))


def next_fit(objects: DataFrame, target: int, size: str = "size", order: tuple[str, ...] = ("ts", "key")) -> DataFrame:
    """``(key, size, bin)``: objects in order go into the open bin; one that does not fit opens the next.

    The scan is cut at range partitions. What a partition does depends on the use of the open bin alone, and is a function
    with few steps, as bins begun at different places soon meet: each task tells the steps, equal ones joined. ``GROUP``
    partitions at a time are put together by tasks; the driver chains the groups, tasks then enter their partitions, and
    a last pass numbers the bins of all partitions at once. The driver gets the steps of groups and one row a partition.
    Null sizes count as zero.
    """
    kind = {f.name: f.dataType.simpleString() for f in objects.schema.fields}
    src = objects.select("key", F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)])
    keys = [f"_o{k}" for k in range(len(order))]
    parts = cut(src.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_p", F.spark_partition_id()).select("_p", "key", "size"))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = [], 0
        for b in batches:
            if b.num_rows:
                number = b.column(0)[0].as_py()
                found.append(b.column(1).to_numpy())
        if found:
            rows = _steps(np.concatenate(found), target).rows()
            columns = [[number] * len(rows), *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], names=["p", "lo", "begun", "last"])

    kinds = "p bigint, lo bigint, begun bigint, last bigint"
    told = cut(parts.select("_p", "size").mapInArrow(tell, kinds)).withColumn("g", (F.col("p") / GROUP).cast("int"))

    def of(pdf: pd.DataFrame) -> list[tuple[int, Steps]]:
        return [(int(p), Steps.of(zip(x["lo"].tolist(), x["begun"].tolist(), x["last"].tolist()))) for p, x in pdf.groupby("p", sort=True)]

    def together(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, x in of(pdf):
            whole = x if whole is None else whole.then(x)
        return pd.DataFrame([(key[0], *r) for r in whole.rows()], columns=["p", "lo", "begun", "last"])

    groups: dict[int, list] = {}
    for r in told.groupBy("g").applyInPandas(together, kinds).collect():
        groups.setdefault(r.p, []).append((r.lo, r.begun, r.last))
    begin: dict[int, tuple[int, int]] = {}
    number, used = 0, 0
    for g in sorted(groups):
        begin[g] = (number, used)
        n, used = Steps.of(groups[g]).at(used)
        number += n

    def enter(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out, (at, full) = [], begin[key[0]]
        for p, x in of(pdf):
            out.append((p, at, full))
            n, full = x.at(full)
            at += n
        return pd.DataFrame(out, columns=["p", "number", "used"])

    entry = {r.p: (r.number, r.used) for r in told.groupBy("g").applyInPandas(enter, "p bigint, number bigint, used bigint").collect()}  # one row a partition

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            if not b.num_rows:
                continue
            at, full = state or entry[b.column(0)[0].as_py()]
            bins = []
            for s in b.column(2).to_pylist():
                if full and full + s > target:
                    at, full = at + 1, 0
                full += s
                bins.append(at)
            state = at, full
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(bins, pa.int64())], names=["key", "size", "bin"])

    return parts.mapInArrow(deal, f"key {kind['key']}, size bigint, bin bigint")


def whole_bins(packed: DataFrame, budget: int) -> DataFrame:
    """Bins of a run: whole ones, in order, while their total fits the budget."""
    sizes = packed.groupBy("bin").agg(F.sum("size").alias("size"), F.count("*").alias("objects"))
    return _running(sizes, [F.col("bin")], "size").where(F.col("before") + F.col("size") <= budget).drop("before")


def savings(df: DataFrame, before: str, after: str) -> DataFrame:
    """Bytes before and after, and the share saved."""
    return df.agg(F.sum(before).cast("bigint").alias("before"), F.sum(after).cast("bigint").alias("after")).withColumn("saved", F.col("before") - F.col("after")).withColumn("saved_pct", F.round(100.0 * F.col("saved") / F.col("before"), 4))
