"""Bloom filters per shard, kept as 64-bit words, and their use to skip shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions import hashing, text

MAX_TERMS = 40


def doc_terms(df: DataFrame, n_shards: int = 128, u: str = "u", most: int = MAX_TERMS) -> DataFrame:
    """``(shard, term)`` of the first ``most`` tokens of title, description and text, in that order, then distinct."""
    tokens = F.concat(*[text.bloom_tokens(F.col(c)) for c in ("t", "d", "c")])
    return df.select(hashing.shard_of(F.col(u), n_shards).alias("shard"), F.explode(F.array_distinct(F.slice(tokens, 1, most))).alias("term"))


def filters(terms: DataFrame, bits: int = hashing.BLOOM_BITS) -> DataFrame:
    """``(shard, word, bits)``: the non-zero 64-bit words of each shard's filter. At most bits/64 words a shard."""
    # a term of a shard is hashed once, whatever documents hold it
    pos = terms.select("shard", "term").distinct().select("shard", F.explode(hashing.bloom_positions(F.col("term"), bits)).alias("p"))
    word = pos.select("shard", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, p & 63)").alias("bit"))
    return word.groupBy("shard", "word").agg(F.bit_or("bit").alias("bits"))


def fill(f: DataFrame, bits: int = hashing.BLOOM_BITS) -> DataFrame:
    """Set bits and fill ratio per shard, and the false-positive rate this fill gives with four hashes."""
    per = f.groupBy("shard").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("set_bits"))
    ratio = F.col("set_bits") / F.lit(float(bits))
    return per.select("shard", "set_bits", F.round(ratio, 8).alias("fill"), F.round(F.pow(ratio, F.lit(float(hashing.BLOOM_HASHES))), 8).alias("false_positive"))


def probe(f: DataFrame, terms: DataFrame, bits: int = hashing.BLOOM_BITS) -> DataFrame:
    """``(term, shard)`` of the shards whose filter may hold the term: all of its distinct bits are set."""
    want = terms.select("term", F.explode(F.array_distinct(hashing.bloom_positions(F.col("term"), bits))).alias("p"))
    want = want.select("term", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, p & 63)").alias("bit"))
    need = want.groupBy("term").agg(F.count("*").alias("need"))
    hit = f.join(want, "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy("term", "shard").agg(F.count("*").alias("got"))
    return hit.join(need, "term").where("got = need").select("term", "shard")


def to_binary(f: DataFrame, bits: int = hashing.BLOOM_BITS) -> DataFrame:
    """One filter per shard as binary, lowest bit of a byte first; a shard's words are at most bits/64."""
    words = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    little = lambda w: F.concat(*[F.substring(F.lpad(F.hex(w), 16, "0"), 15 - 2 * k, 2) for k in range(8)])
    every = F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda k: little(F.coalesce(F.element_at(F.col("m"), k), F.lit(0).cast("bigint"))))
    return f.groupBy("shard").agg(words.alias("m")).select("shard", F.unhex(F.array_join(every, "")).alias("filter"))
