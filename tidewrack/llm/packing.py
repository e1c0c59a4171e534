"""Problem 9: best-two-fit packing of texts, measured in tokens, into containers of one fixed capacity.

Each task packs slabs of its own rows, so there is no shuffle, no hot group and no task that holds more than
``slab`` items; the room lost to slabs is less than one container a slab. Within a slab the state is the number of
unpacked items of each size, which has at most ``capacity`` entries.

Method: a container is filled greedily, each time with the largest unpacked item that fits. If a gap is left, its
smallest item is taken out again and, if there are two unpacked items that fit the expanded gap and fill more of it
than the one item did, the two replace the one. This repeats while it tightens the container.

Items longer than the capacity are divided: full pieces have a container each, the rest is an item like others.

Container numbers depend on how the input is split into partitions; what a container holds at most does not.

Defined results: null and empty texts have size 0, are one piece and share a container of their slab with others;
repeated rows are packed as rows of their own; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import DEFAULT_RANKS, load_ranks, shared_encoder

CAPACITY = 2048
SLAB = 50_000
_LARGEST_PARTITION = 1 << 20  # containers of one partition of the input, for unique container numbers
SCHEMA = "doc_id {kind}, piece int, token_from bigint, n_tokens int, container bigint"


def best_two_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container number of every item (sizes of 0 to ``capacity``) and the number of containers.

    Items of one size are interchangeable: the plan is made over counts of sizes and dealt to items in input order.
    """
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int64), 0
    if sizes.min() < 0 or sizes.max() > capacity:
        raise ValueError("sizes must be between 0 and the capacity")
    count = np.bincount(sizes, minlength=capacity + 1)
    zeros, count[0] = int(count[0]), 0
    # below[g]: the largest size of 1..g with unpacked items, or 0
    present = np.where(count > 0, np.arange(capacity + 1), 0)
    below = np.maximum.accumulate(present)
    distinct = np.flatnonzero(count)

    def take(s: int) -> None:
        nonlocal distinct
        count[s] -= 1
        if count[s] == 0:
            end = s + 1 + int(np.searchsorted(below[s + 1 :], s, side="right"))
            below[s:end] = below[s - 1]
            distinct = distinct[distinct != s]

    def give(s: int) -> None:
        nonlocal distinct
        count[s] += 1
        if count[s] == 1:
            end = s + int(np.searchsorted(below[s:], s, side="left"))
            below[s:end] = s
            distinct = np.insert(distinct, int(np.searchsorted(distinct, s)), s)

    bins: list[list[int]] = []
    left = n - zeros
    while left:
        items: list[int] = []
        gap = capacity
        while gap and (s := int(below[gap])):
            items.append(s)
            gap -= s
            take(s)
        while gap and len(distinct) and items:
            small = items[-1] if items[-1] == min(items) else min(items)
            room = gap + small
            firsts = distinct[: int(np.searchsorted(distinct, room, side="right"))]
            if not len(firsts):
                break
            seconds = below[room - firsts].copy()
            twice = (seconds == firsts) & (count[firsts] < 2)  # the only item of its size can't be both
            if twice.any():
                seconds[twice] = below[np.maximum(firsts[twice] - 1, 0)]
            total = np.where(seconds > 0, firsts + seconds, 0)
            k = int(total.argmax())
            if total[k] <= small:
                break
            a, b = int(firsts[k]), int(seconds[k])
            take(a)
            take(b)
            items.remove(small)
            give(small)
            items += [a, b]
            gap = room - a - b
        left = int(count.sum())
        bins.append(items)
    flat = np.array([s for b in bins for s in b], dtype=np.int64)
    owner = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    out = np.zeros(n, dtype=np.int64)
    slots = np.argsort(flat, kind="stable")
    order = np.argsort(sizes, kind="stable")[zeros:]
    out[order] = owner[slots]
    return out, max(1, len(bins))


def pack_corpus(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, slab: int = SLAB, ranks_path: str = DEFAULT_RANKS
) -> DataFrame:
    """One row per piece: its tokens ``token_from`` to ``token_from + n_tokens`` of the text, and its container."""
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    shared = df.sparkSession.sparkContext.broadcast((load_ranks(ranks_path), ([], [])))
    key = shared._jbroadcast.id()
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def packed(ids: list, sizes: np.ndarray, base: int) -> tuple[pa.RecordBatch, int]:
        full, rest = sizes // capacity, sizes % capacity
        pieces = full + ((rest > 0) | (sizes == 0))
        row = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.where(piece < full[row], capacity, rest[row])
        own = piece < full[row]
        container = np.zeros(len(row), dtype=np.int64)
        container[~own], n = best_two_fit(length[~own], capacity) if (~own).any() else (container[~own], 0)
        container[own] = n + np.arange(int(own.sum()))
        arrays = [pa.array(ids).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array(length, pa.int32()), pa.array(container + base, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "token_from", "n_tokens", "container"]), n + int(own.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared_encoder(key, shared)
        base = TaskContext.get().partitionId() * _LARGEST_PARTITION * 1024
        ids: list = []
        sizes: list[np.ndarray] = []
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                s = b.slice(lo, 2000)
                ids += s.column(0).to_pylist()
                sizes.append(enc.sizes(s.column(1).to_pylist()))
                if len(ids) >= slab:
                    out, n = packed(ids, np.concatenate(sizes), base)
                    base += n
                    ids, sizes = [], []
                    yield out
        if ids:
            yield packed(ids, np.concatenate(sizes), base)[0]

    return src.mapInArrow(run, SCHEMA.format(kind=src.schema["doc_id"].dataType.simpleString()))


def container_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per container: pieces, tokens and unused room."""
    return packed.groupBy("container").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"), (F.lit(capacity) - F.sum("n_tokens")).alias("unused"))
