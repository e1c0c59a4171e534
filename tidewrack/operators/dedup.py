"""Duplicates by address, by digest prefix and by digest distance."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in an order. Partial aggregation runs before the shuffle, so a key that holds
    a third of all rows costs one row a task; rows of equal order are ranked by their whole content.
    """
    row = F.struct(*df.columns)
    rank = F.struct(*order, F.xxhash64(*df.columns))
    best = (F.max_by if last else F.min_by)(row, rank).alias("_row")
    return df.groupBy(*[F.col(k) for k in keys]).agg(best).select("_row.*")


def prefix_gate(df: DataFrame, order: list[Column], digest: str = "s", digits: int = 5) -> DataFrame:
    """The first document of each digest prefix survives; documents without digest share one prefix."""
    prefix = F.substring(F.coalesce(F.col(digest), F.lit("")), 1, digits)
    return keep_one(df.withColumn("_prefix", prefix), ["_prefix"], order).drop("_prefix")


BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))  # bits of a digest: start, length


CHOICES = tuple(combinations(range(len(BLOCKS)), 3))
HOT = 256  # digests of one key from which its rest is keyed too


def _long(bits: int) -> int:
    """64 bits as a signed number."""
    return bits - (1 << 64) if bits >> 63 else bits


def _mask(start: int, length: int) -> int:
    return ((1 << length) - 1) << (64 - start - length)


def _rest_masks(choice: tuple[int, ...]) -> list[int]:
    """The bits outside a choice in four pieces: three differing bits leave one of them untouched."""
    places = [BLOCKS[k][0] + i for k in range(len(BLOCKS)) if k not in choice for i in range(BLOCKS[k][1])]
    size = -(-len(places) // 4)
    return [sum(1 << (63 - p) for p in places[n : n + size]) for n in range(0, len(places), size)]


def near_links(digests: DataFrame, most: int = 3, hot: int = HOT) -> DataFrame:
    """``(a, b, distance)`` of distinct digests (column ``s``) at most ``most`` (up to 3) bits apart, a < b.

    Of six blocks of bits, three differing bits leave three untouched: digests are joined on each of the 20 choices of
    three blocks, keys of 31 to 33 bits. A pair is kept only by the first choice that both agree on, which their
    differing bits tell, so that no pair is made twice and none is shuffled again. Keys of more than ``hot`` digests (a
    family of templates) are joined on one of four pieces of the other bits besides, by the first that agrees.
    """
    if not 0 <= most <= 3:
        raise ValueError("at most 3 bits")
    d = digests.select("s").where("s is not null").distinct().withColumn("v", F.conv("s", 16, -10).cast("bigint"))
    masks = [F.lit(_long(sum(_mask(*BLOCKS[k]) for k in c))) for c in CHOICES]
    keyed = d.select("s", "v", F.posexplode(F.array(*[F.col("v").bitwiseAND(m) for m in masks])).alias("choice", "key"))
    large = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("choice", "key", F.lit(True).alias("large"))
    pieces = F.array(*[F.array(*[F.lit(_long(m)) for m in _rest_masks(c)]) for c in CHOICES])
    mine = F.transform(F.get(pieces, F.col("choice")), lambda m: F.col("v").bitwiseAND(m))
    fine = keyed.join(large, ["choice", "key"], "left").select("s", "v", "choice", "key", F.posexplode(F.when(F.col("large"), mine).otherwise(F.array(F.lit(0).cast("bigint")))).alias("piece", "rest"), F.coalesce("large", F.lit(False)).alias("large"))
    on = ["choice", "key", "large", "piece", "rest"]
    a, b = fine.withColumnsRenamed({"s": "a", "v": "va"}), fine.withColumnsRenamed({"s": "b", "v": "vb"})
    x = F.col("va").bitwiseXOR(F.col("vb"))
    pairs = a.join(b, on).where("a < b").withColumn("x", x).withColumn("distance", F.bit_count("x").cast("int")).where(F.col("distance") <= most)
    same = [F.col("x").bitwiseAND(F.lit(_long(_mask(*block)))) == 0 for block in BLOCKS]
    first = F.lit(None).cast("int")
    for n, c in reversed(list(enumerate(CHOICES))):
        first = F.when(same[c[0]] & same[c[1]] & same[c[2]], n).otherwise(first)
    agreed = F.array_position(F.transform(F.get(pieces, F.col("choice")), lambda m: F.col("x").bitwiseAND(m)), F.lit(0).cast("bigint")) - 1
    return pairs.where((F.col("choice") == first) & (~F.col("large") | (F.col("piece") == agreed))).select("a", "b", "distance")


def near_classes(df: DataFrame, id_col: str, digest: str = "s", most: int = 3) -> DataFrame:
    """One row per document: its class of equal digests and the number of other documents within ``most`` bits.

    Links are found between distinct digests only and weighted by the sizes of their classes, so copies are never
    expanded into pairs.
    """
    sizes = df.where(F.col(digest).isNotNull()).groupBy(F.col(digest).alias("s")).agg(F.count("*").alias("n"))
    links = near_links(sizes, most)
    both = links.select(F.col("a").alias("s"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("s"), F.col("a").alias("other")))
    near = both.join(sizes.withColumnRenamed("s", "other").withColumnRenamed("n", "m"), "other").groupBy("s").agg(F.sum("m").alias("near"))
    per = sizes.join(near, "s", "left").select("s", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return df.select(id_col, F.col(digest).alias("s")).join(per, "s", "left").select(id_col, F.col("s").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
