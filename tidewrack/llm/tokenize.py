"""Problem 8: encode a corpus with a public byte-level BPE tokenizer by corpus-level merge replay.

1. All texts are cut into words; tasks count their words before the shuffle, which gives one row per distinct word of the
   corpus, partitioned by its hash.
2. The words of a partition are replayed together, each once in the corpus. Every adjacent token pair that has a merge rank
   is kept in an inverted index from rank to the word positions where the pair stands. Ranks are replayed in ascending
   order from a heap; a merge touches only the two neighbours of each position, whose new pairs are put into the index.
   Because a merge result can only take part in merges of a higher rank, replaying ranks in order over all words at once
   gives each word exactly what greedy per-word merging gives it.
3. The ids of the ``MOST_WORDS`` most frequent words go to all tasks, which write the texts' ids without shuffling texts.
   A corpus of more distinct words has the exact way for the rest: a slab of texts replays those of its words that are not
   among them, in the same way.

The merge table is read once on the driver (its size is that of the vocabulary file, 50,256 entries) and broadcast; so are
the frequent words, at most ``MOST_WORDS`` rows. The words' table is checkpointed in the shared folder.

Defined results: a null or empty text gives the empty list; repeated ids and rows are kept; extra columns of the input
are ignored, only the id and text columns are read; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pre-tokenisation pattern of this family of byte-level BPE vocabularies (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Frequent words whose ids go to every task, and rare words that a worker keeps between slabs.
MOST_WORDS = 300_000
CACHE_WORDS = 200_000
_SLAB = 2000
_REPLAYED = 200_000  # words replayed together


def load_ranks(path: str = DEFAULT_RANKS) -> dict[bytes, int]:
    """Read a vocabulary of base64 token and rank lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge_table(ranks: dict[bytes, int]) -> tuple[list[int], dict[int, int]]:
    """Token id of each byte, and (left id << 32 | right id) -> merged id.

    The file names tokens, not merges: a pair merges whenever the joined bytes are a token, and the token's own id is
    the rank of the merge. All splits of each token into two tokens are listed.
    """
    byte_ids = [ranks[bytes([b])] for b in range(256)]
    pairs: dict[int, int] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left = ranks.get(token[:cut])
            if left is not None and (right := ranks.get(token[cut:])) is not None:
                pairs[left << 32 | right] = rank
    return byte_ids, pairs


def replay(words: list[bytes], byte_ids: list[int], pairs: dict[int, int]) -> list[list[int]]:
    """Encode distinct words together: all merges in rank order over an inverted index of pairs."""
    tok: list[int] = []
    ends: list[int] = []
    for w in words:
        tok.extend([byte_ids[b] for b in w])
        tok.append(-1)  # a wall between words
        ends.append(len(tok))
    n = len(tok)
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    where: dict[int, list[int]] = {}
    get = pairs.get
    for i in range(n - 1):
        a, b = tok[i], tok[i + 1]
        if a >= 0 and b >= 0 and (r := get(a << 32 | b)) is not None:
            if r in where:
                where[r].append(i)
            else:
                where[r] = [i]
    heap = list(where)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        spots = where.pop(rank)
        spots.sort()  # overlapping pairs merge from the left
        for i in spots:
            j = nxt[i]
            a = tok[i]
            if a < 0 or j >= n or tok[j] < 0 or get(a << 32 | tok[j]) != rank:
                continue  # a neighbour was merged away since
            k = nxt[j]
            tok[i], tok[j] = rank, -2
            nxt[i] = k
            if k < n:
                prv[k] = i
                b = tok[k]
                if b >= 0 and (r := get(rank << 32 | b)) is not None:
                    if r in where:
                        where[r].append(i)
                    else:
                        where[r] = [i]
                        heapq.heappush(heap, r)
            h = prv[i]
            if h >= 0:
                b = tok[h]
                if b >= 0 and (r := get(b << 32 | rank)) is not None:
                    if r in where:
                        where[r].append(h)
                    else:
                        where[r] = [h]
                        heapq.heappush(heap, r)
    out, start = [], 0
    for end in ends:
        out.append([t for t in tok[start : end - 1] if t >= 0])
        start = end
    return out


class Encoder:
    """Encodes slabs of texts; ``known`` are words with their ids, others are replayed and kept in a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], known: dict[str, list[int]] | None = None, cache_words: int = CACHE_WORDS):
        import regex

        self.byte_ids, self.pairs = merge_table(ranks)
        self.split = regex.compile(PATTERN).findall
        self.known = known or {}
        self.cache: dict[str, list[int]] = {}
        self.cache_words = cache_words

    def replay(self, words: list[str]) -> list[list[int]]:
        """The ids of distinct words."""
        out: list[list[int]] = []
        for k in range(0, len(words), _REPLAYED):
            out += replay([w.encode("utf-8", "replace") for w in words[k : k + _REPLAYED]], self.byte_ids, self.pairs)
        return out

    def encode(self, texts: list[str | None]) -> list[list[list[int]]]:
        """The ids of each word of each text."""
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        split, known, cache = self.split, self.known, self.cache
        words = [split(t) if t else [] for t in texts]
        fresh = list({w for ws in words for w in ws if w not in known and w not in cache})
        cache.update(zip(fresh, self.replay(fresh)))
        if not cache:
            return [[known[w] for w in ws] for ws in words]
        return [[known[w] if w in known else cache[w] for w in ws] for ws in words]

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.array([x for w in ws for x in w], dtype=np.int32) for ws in self.encode(texts)]

    def sizes(self, texts: list[str | None]) -> np.ndarray:
        return np.array([sum(map(len, ws)) for ws in self.encode(texts)], dtype=np.int64)


_ENCODERS: dict[int, Encoder] = {}


def shared_encoder(key: int, shared) -> Encoder:
    """One encoder for all tasks of a reused Python worker; ``shared`` broadcasts the ranks and the known words, ``key`` is its id."""
    if key not in _ENCODERS:
        _ENCODERS.clear()  # the words of another corpus are not kept
        ranks, words = shared.value
        _ENCODERS[key] = Encoder(ranks, dict(zip(*words)))
    return _ENCODERS[key]


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all distinct words of the corpus; tasks count theirs before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, seen = regex.compile(PATTERN).findall, Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for lo in range(0, b.num_rows, _SLAB):
                for t in b.column(0).slice(lo, _SLAB).to_pylist():
                    seen.update(split(t))
                if len(seen) > _REPLAYED:
                    yield rows()
                    seen.clear()
        yield rows()

    src = texts.select(F.col(text_col).cast("string").alias("text")).where("text is not null and text <> ''")
    return src.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encoded_words(counts: DataFrame, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """``(word, n, ids)``: every distinct word replayed once, with the other words of its hash partition."""
    ranks = counts.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(ranks.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(enc.replay(b.column(0).to_pylist()), pa.list_(pa.int32()))], names=["word", "n", "ids"])

    return counts.mapInArrow(run, "word string, n bigint, ids array<int>")


def corpus_encoder(texts: DataFrame, text_col: str = "text", ranks_path: str = DEFAULT_RANKS, most: int = MOST_WORDS):
    """Broadcast ranks and frequent words of a corpus, and the key for :func:`shared_encoder`."""
    sc = texts.sparkSession.sparkContext
    table = cut(encoded_words(word_counts(texts, text_col), ranks_path))
    got = table.orderBy(F.desc("n"), "word").limit(most).select("word", "ids").toArrow()  # the documented bound of what is broadcast
    shared = sc.broadcast((load_ranks(ranks_path), (got.column("word").to_pylist(), got.column("ids").to_pylist())))
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) is not None else id(shared)
    return shared, key


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = DEFAULT_RANKS, most: int = MOST_WORDS) -> DataFrame:
    """``(id, ids array<int>)`` of every row, without special tokens."""
    shared, key = corpus_encoder(df, text_col, ranks_path, most)
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared_encoder(key, shared)
        for b in batches:
            for lo in range(0, b.num_rows, _SLAB):
                s = b.slice(lo, _SLAB)
                ids = enc.ids(s.column(1).to_pylist())
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([s.column(0), lists], names=["doc_id", "ids"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>")
