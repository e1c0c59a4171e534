import base64
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewrack.llm import packing, tokenize

RANKS = tokenize.load_ranks()
ENC = tokenize.Encoder(RANKS)
OTHER = tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_same_as_greedy_merging(t):
    assert list(ENC.ids([t])[0]) == OTHER.encode_ordinary(t)


@pytest.mark.parametrize("t", ["a" * 20_000, "ab" * 9000, " \n\t  x", "🌾👩‍🌾" * 300, "<|endoftext|>", "\x00﻿"])
def test_long_and_odd_texts(t):
    assert list(ENC.ids([t])[0]) == OTHER.encode_ordinary(t)


def test_operator(spark):
    df = spark.createDataFrame([(1, "Hello world", 5), (2, None, 5), (3, "", 5), (1, "Hello world", 5)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in tokenize.encode_corpus(df).collect())
    assert got == [(1, OTHER.encode_ordinary("Hello world"))] * 2 + [(2, []), (3, [])]
    assert tokenize.encode_corpus(df.where("false")).count() == 0


def test_small_cache_gives_the_same():
    enc = tokenize.Encoder(RANKS, cache_words=3)
    for t in ["one two three four", "five six one", "two two"]:
        assert list(enc.ids([t])[0]) == OTHER.encode_ordinary(t)


def test_table_of_file(tmp_path):
    p = tmp_path / "r"
    p.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)) + b"\n" + base64.b64encode(b"ab") + b" 256\n")
    enc = tokenize.Encoder(tokenize.load_ranks(str(p)))
    assert list(enc.ids(["abab"])[0]) == [256, 256]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(30, 45))
def test_packing_holds_all_items_once(sizes, capacity):
    bins, n = packing.best_two_fit(np.array(sizes, dtype=np.int64), capacity)
    load = Counter()
    for s, b in zip(sizes, bins.tolist()):
        load[b] += s
    assert len(bins) == len(sizes) and all(v <= capacity for v in load.values())
    if sizes:
        assert set(bins.tolist()) <= set(range(n)) and n <= max(1, 2 * -(-sum(sizes) // capacity) + 1)


def test_packing_is_tight():
    rng = random.Random(1)
    sizes = np.array([rng.randint(1, 500) for _ in range(5000)])
    _, n = packing.best_two_fit(sizes, 2048)
    assert n <= 1.01 * sizes.sum() / 2048 + 1


def test_pack_corpus(spark):
    text = "word " * 25
    df = spark.createDataFrame([(i, text * (i % 4)) for i in range(40)] + [(99, None), (100, "x " * 500)], "doc_id bigint, text string")
    got = packing.pack_corpus(df, capacity=128).collect()
    n = {i: len(OTHER.encode_ordinary(t)) for i, t in [(r.doc_id, r.text or "") for r in df.collect()]}
    by_doc, by_box = Counter(), Counter()
    for r in got:
        by_doc[r.doc_id] += r.n_tokens
        by_box[r.container] += r.n_tokens
        assert r.token_from == r.piece * 128
    assert by_doc == Counter(n) and max(by_box.values()) <= 128
    assert len([r for r in got if r.doc_id == 100]) == -(-n[100] // 128) and all(len([r for r in got if r.doc_id == i]) == 1 for i in range(3))
    assert packing.pack_corpus(df.where("false")).count() == 0


def test_distinct_words_are_replayed_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    texts = [r.text for r in docs.collect() if r.text]
    words = Counter(w for t in texts for w in ENC.split(t))
    got = tokenize.encoded_words(tokenize.word_counts(docs)).collect()
    assert len(got) == len(words) and {r.word: r.n for r in got} == words  # one row, thus one replay, for each
    assert all(r.ids == OTHER.encode_ordinary(r.word) for r in got)


@pytest.mark.parametrize("most", [0, 7, 10**6])
def test_any_number_of_frequent_words_gives_the_same(spark, small, most):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(3)
    got = {r.doc_id: r.ids for r in tokenize.encode_corpus(docs, most=most).collect()}
    assert got == {r.doc_id: OTHER.encode_ordinary(r.text or "") for r in docs.collect()}


def test_little_room_is_left_over(spark, small):
    from tidewrack.llm.queries import QUERIES

    r = QUERIES["p9_fill"](spark, small.replace("0.001", "0.1")).first()
    assert r.unused_share < 0.01 and r.tokens > 1_000_000
