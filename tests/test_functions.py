import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewrack.functions import hashing, text, urls
from tidewrack.operators import frontier


def one(spark, value, *cols):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first()


def test_strip_tags_order_and_double_decoding(spark):
    r = one(spark, "<p>A&amp;lt;b&nbsp;  c</p><SCRIPT>x<y</SCRIPT><style>p{}</style>&quot;&#39;&#160;&apos;", text.strip_tags(F.col("x")), text.strip_tags_crawl(F.col("x")))
    assert r.c0 == "A<b c \"'&#160;&apos;"
    assert r.c1 == "A<b c \"' '"


def test_tokens(spark):
    r = one(spark, "The Quick-brown a1 " + "z" * 40 + " été", text.index_tokens(F.col("x")), text.bloom_tokens(F.col("x")), text.simhash_tokens(F.col("x")))
    assert r.c0 == ["quick", "brown", "a1", "z" * 32, "z" * 8]  # the rest of é words is one letter
    assert r.c1 == ["the", "quick", "brown", "z" * 40]
    assert r.c2 == ["the", "quick", "brown", "z" * 40]


@pytest.mark.parametrize(
    "u, port, name, bare",
    [
        ("HTTPS://User@WWW.Example.ORG:443/a|b", "www.example.org", "www.example.org", "example.org"),
        ("http://a_b.example.com:8080?x", "a_b.example.com:8080", "a_b.example.com", "a_b.example.com"),
        ("mailto:x@y.z", "", "", ""),
    ],
)
def test_hosts(spark, u, port, name, bare):
    assert tuple(one(spark, u, urls.host_port(F.col("x")), urls.host_name(F.col("x")), urls.bare_host(F.col("x")))) == (port, name, bare)


def test_registered_names(spark):
    for host, want, two in [("a.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.example.org", "example.org", "example.org"), ("single", None, None)]:
        assert tuple(one(spark, host, urls.etld1(F.col("x")), urls.registrable(F.col("x")))) == (want, two)


def test_resolve(spark):
    base = F.lit("http://Example.org:80/dir/page")
    for href, want in [("//cdn.example.net/a#b", "http://cdn.example.net/a"), ("/r?x=1#y", "http://example.org/r?x=1"), ("https://z.example.com/#top", "https://z.example.com/"), ("mailto:a", None), ("rel/x", None), (None, None)]:
        assert one(spark, href, urls.resolve(F.col("x"), base)).c0 == want


def test_hashes(spark):
    r = one(spark, "https://example.org/", hashing.sha1_32(F.col("x")), hashing.bucket_of(F.col("x")), hashing.shard_of(F.col("x"), 16), hashing.bloom_positions(F.col("x")))
    d, m = hashlib.sha1(b"https://example.org/").digest(), hashlib.md5(b"https://example.org/").digest()
    assert (r.c0, r.c1, r.c2) == (int.from_bytes(d[:4], "big"), d[0], int.from_bytes(d[:4], "big") % 16)
    assert r.c3 == [int.from_bytes(m[4 * i : 4 * i + 4], "big") % 65536 for i in range(4)]


def slow_simhash(t):
    import re

    v = [0] * 64
    for w in re.split("[^A-Za-z0-9_]+", t.lower()):
        if len(w) > 2:
            h = hashlib.md5(w.encode()).digest()
            for b in range(64):
                v[b] += 1 if (h[b >> 3] >> (b & 7)) & 1 else -1
    return "".join(f"{int(''.join('1' if x > 0 else '0' for x in v[a:a + 32]), 2):08x}" for a in (0, 32))


@given(st.lists(st.text(alphabet="ab cdé_\n", max_size=60), min_size=1, max_size=8))
def test_simhash_matches_definition(texts):
    assert hashing.simhash_texts(texts) == [slow_simhash(t) for t in texts]


def test_simhash_of_nothing():
    assert hashing.simhash_texts([None, "", "a b"]) == ["0" * 16] * 3


@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1))
def test_hamming_is_symmetric_by_definition(a, b):
    assert bin(a ^ b).count("1") == bin(b ^ a).count("1")


def test_parse_float_and_lists(spark):
    for x, want in [("1.5abc", 1.5), (" -2e3", -2000.0), ("x", None), ("", None), (None, None), (".5", 0.5)]:
        assert one(spark, x, text.parse_float(F.col("x"))).c0 == want
    assert one(spark, "a, b\n\n c,", text.split_list(F.col("x"))).c0 == ["a", "b", "c"]


def test_segment_id(spark):
    assert one(spark, "x/y/seg-00042.warc.gz", urls.segment_id(F.col("x"))).c0 == "seg-00042"
    assert one(spark, "plain", urls.segment_id(F.col("x"))).c0 == hashlib.sha1(b"plain").hexdigest()[:16]


def test_shuffle_is_a_fixed_permutation():
    items = [f"s{i}" for i in range(500)]
    a, b = frontier.lcg_shuffle(items), frontier.lcg_shuffle(items)
    assert a == b != items and sorted(a) == sorted(items)
    assert frontier.lcg_shuffle([]) == [] and frontier.lcg_shuffle(["x"]) == ["x"]
    random.seed(0)
