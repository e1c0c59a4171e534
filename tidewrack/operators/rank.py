"""Positions in a total order, and scans in order that are cut at range partitions."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut


def order_statistics(df: DataFrame, col: str, positions: Iterable[int], descending: bool = False) -> dict[int, object]:
    """The values at positions (from 0) of an order, by counts of equal values; positions beyond the end give the last value.

    Values are range-partitioned and counted per partition (one row a partition comes to the driver); only the partitions
    that hold a position are ranked, each by itself.
    """
    way = F.desc if descending else F.asc
    counts = cut(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n")).repartitionByRange(way("v")).withColumn("p", F.spark_partition_id()))
    per = counts.groupBy("p").agg(F.sum("n").alias("n"), F.max("v").alias("at")).orderBy(way("at")).collect()
    ends, total = [], 0
    for r in per:
        total += r.n
        ends.append(total)
    if not total:
        return dict.fromkeys(positions)
    want = {k: min(k, total - 1) for k in positions}
    held = {k: bisect_right(ends, at) for k, at in want.items()}
    upto = F.sum("n").over(Window.partitionBy("p").orderBy(way("v")))
    ranked = counts.where(F.col("p").isin(*{per[i].p for i in held.values()})).withColumn("upto", upto)
    begin = {i: ends[i] - per[i].n for i in set(held.values())}
    best = F.max if descending else F.min
    row = ranked.agg(*[best(F.when((F.col("p") == per[held[k]].p) & (F.col("upto") + begin[held[k]] > at), F.col("v"))).alias(f"k{n}") for n, (k, at) in enumerate(want.items())]).first()
    return dict(zip(want, row))


class Steps:
    """What a stretch of a scan does to the number it is entered with: ``(begun, exit)``.

    Entered with 0 it is ``zero``. Entered with more than ``lo`` of a step (the greatest that is less) it begins and leaves
    as the step says; below all steps it only adds ``total``. Equal neighbours are one step.
    """

    def __init__(self, zero: tuple[int, int], total: int, steps: list[tuple[int, int, int]]):
        self.zero, self.total, self.steps = zero, total, []
        for lo, begun, last in sorted(steps):
            if self.steps and self.steps[-1][1:] == (begun, last):
                continue  # the lower bound stands for both
            self.steps.append((lo, begun, last))

    def at(self, entry: int) -> tuple[int, int]:
        if entry == 0:
            return self.zero
        k = bisect_right(self.steps, (entry - 1, float("inf"), 0)) - 1
        return self.steps[k][1:] if k >= 0 else (0, entry + self.total)

    def then(self, after: Steps) -> Steps:
        """Both stretches, one after the other."""

        def run(begun: int, last: int) -> tuple[int, int]:
            n, out = after.at(last)
            return begun + n, out

        steps = [(lo, *run(begun, last)) for lo, begun, last in self.steps]
        least = self.steps[0][0] if self.steps else None
        for lo, begun, last in after.steps:
            low = max(0, lo - self.total)
            if least is None or low < least:
                steps.append((low, begun, last))
        # of several that are clipped to the same bound the last, which begins the soonest, is the one that is met
        kept: dict[int, tuple[int, int, int]] = {}
        for x in steps:
            kept[x[0]] = x
        return Steps(run(*self.zero), self.total + after.total, list(kept.values()))

    def rows(self) -> list[tuple[int, int, int]]:
        """As rows ``(lo, begun, last)``; -1 marks what 0 does, -2 the total."""
        return [(-1, *self.zero), (-2, self.total, 0), *self.steps]

    @classmethod
    def of(cls, rows: Iterable[tuple[int, int, int]]) -> Steps:
        zero, total, steps = (0, 0), 0, []
        for lo, begun, last in rows:
            if lo == -1:
                zero = (begun, last)
            elif lo == -2:
                total = begun
            else:
                steps.append((lo, begun, last))
        return cls(zero, total, steps)
