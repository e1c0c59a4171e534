"""Digests, shards and bits on columns, and the 64-bit similarity digest."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOOM_HASHES = 4
BLOOM_BITS = 65_536


def sha1_32(c: Column) -> Column:
    """The first 32 bits of SHA-1, unsigned, as bigint."""
    return F.conv(F.substring(F.sha1(c), 1, 8), 16, 10).cast("bigint")


def bucket_of(term: Column) -> Column:
    """The first byte of SHA-1: 256 buckets."""
    return F.conv(F.substring(F.sha1(term), 1, 2), 16, 10).cast("int")


def shard_of(u: Column, n: int = 128) -> Column:
    return (sha1_32(u) % F.lit(n)).cast("int")


def url_hash(u: Column) -> Column:
    """The first 32 bits of SHA-1 to base 36, lower case."""
    return F.lower(F.conv(F.substring(F.sha1(u), 1, 8), 16, 36))


def bloom_positions(term: Column, bits: int = BLOOM_BITS) -> Column:
    """Bits a term sets: four 32-bit words of MD5 modulo the filter's size."""
    h = F.md5(term)
    return F.array(*[(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") % F.lit(bits)).cast("int") for i in range(BLOOM_HASHES)])


def content_key(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 10)


def padded(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def half(s: Column, which: int) -> Column:
    """One 32-bit half of a digest of 16 hex digits, as bigint."""
    return F.conv(F.substring(s, 1 + 8 * which, 8), 16, 10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two digests of 16 hex digits."""
    return F.bit_count(half(a, 0).bitwiseXOR(half(b, 0))) + F.bit_count(half(a, 1).bitwiseXOR(half(b, 1)))


_ZERO = "0" * 16


def simhash_texts(texts: list[str | None]) -> list[str]:
    """Similarity digests: the signs of the sums, over all tokens, of the bits of their MD5; a zero sum gives 0.

    Bits of a byte count from its lowest; each half of the result has its first bit as the highest.
    """
    arr = pc.fill_null(pa.array(texts, pa.string()), "")
    lists = pc.split_pattern_regex(pc.utf8_lower(arr), "[^A-Za-z0-9_]+")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    keep = pc.greater(pc.utf8_length(flat), 2).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), sizes)[keep]
    code = flat.filter(pa.array(keep)).dictionary_encode()
    words = code.dictionary.to_pylist()
    if not words:
        return [_ZERO] * len(texts)
    raw = b"".join(hashlib.md5(w.encode("utf-8", "replace")).digest()[:8] for w in words)
    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
    at = code.indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sums = np.zeros((len(texts), 64), dtype=np.int64)
    for lo in range(0, len(starts), 2000):  # bounded memory
        hi = min(len(starts), lo + 2000)
        a, z = starts[lo], starts[hi] if hi < len(starts) else len(owner)
        sums[owner[starts[lo:hi]]] = np.add.reduceat(bits[at[a:z]], starts[lo:hi] - a, axis=0)
    packed = np.packbits(sums > 0, axis=1)
    return [row.tobytes().hex() for row in packed]


def simhash(c: Column) -> Column:
    """Similarity digest of a text as 16 hex digits. One pass over Arrow batches, without a shuffle of tokens."""

    @F.pandas_udf("string")
    def digest(s: pd.Series) -> pd.Series:
        return pd.Series(simhash_texts([x if isinstance(x, str) else None for x in s]))

    return digest(c)
