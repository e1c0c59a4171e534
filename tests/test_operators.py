import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from tidewrack.functions import hashing
from tidewrack.operators import bloom, dedup, delta, extract, feeds, frontier, graph, index, metrics, quality, search, shards, signals, tiers


def test_extract_doc(spark):
    html = '<html lang="en-GB"><head><TITLE> A &amp; B </TITLE><meta content="d&amp;e" name="description"><link rel="canonical" href="https://c.example.org/"></head><BODY><p>Hi</p>' + "x" * 3000
    r = extract.extract_doc(spark.createDataFrame([("https://u.example.org/", html), ("https://v.example.org/", None)], "url string, html string")).orderBy("u").collect()
    assert (r[0].u, r[0].t, r[0].d, r[0].l, len(r[0].c)) == ("https://c.example.org/", "A & B", "d&amp;e", "en", 2000)
    assert (r[1].u, r[1].t, r[1].c, r[1].s) == ("https://v.example.org/", "", "", "0" * 16)


def test_crawl_doc(spark):
    links = "".join(f'<a href="/p{i}">x</a><a href="/p{i}#y">x</a>' for i in range(100))
    html = '<title>T</title><meta property="og:title" content="OG  t"><meta property="og:description" content="od"><html lang="De-AT">' + links + '<a href="mailto:q">'
    r = extract.crawl_doc(spark.createDataFrame([("http://h.example.org/a", html), ("http://e.example.org/", "<p></p>")], "url string, html string")).collect()
    assert len(r) == 1 and (r[0].t, r[0].d, r[0].lang) == ("OG t", "od", "De-AT")
    assert r[0].links == [f"http://h.example.org/p{i}" for i in range(64)]


def test_quality(spark):
    rows = [("https://a.example.org/", "Title", "x" * 120, "en"), ("https://a.example.org/x.zip", "Title", "x" * 120, "en"), ("https://a.example.org/", "Some webcams here", "x" * 120, ""), ("https://a.example.org/", "Live cams", "x" * 120, None), ("https://a.example.org/", "Title", "x" * 119, "en"), ("https://a.example.org/", "Title", "x" * 120, "xx"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "u string, t string, c string, l string")
    assert [r.g for r in df.select(quality.is_good(["en"]).alias("g")).collect()] == [True, False, True, False, False, False, False]
    hosts = spark.createDataFrame([("a.b",), ("*.a.b",), ("a.local",), ("xxx.example.org",), ("nodot",), (None,), ("x" * 254 + ".org",)], "h string")
    assert [r.g for r in hosts.select(quality.good_host(F.col("h")).alias("g")).collect()] == [True] + [False] * 6
    assert [r.g for r in hosts.select(quality.good_domain(F.col("h")).alias("g")).collect()] == [True, False, True, False, True, False, False]


def test_keep_one_and_prefix_gate(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "y"), ("b", 3, None)], "u string, n int, s string")
    first = {tuple(r) for r in dedup.keep_one(df, ["u"], [F.col("n")]).collect()}
    last = {tuple(r) for r in dedup.keep_one(df, ["u"], [F.col("n")], last=True).collect()}
    assert first == {("a", 1, "y"), ("b", 3, None)} and last == {("a", 2, "x"), ("b", 3, None)}
    gate = dedup.prefix_gate(spark.createDataFrame([(1, "abcde1"), (2, "abcde2"), (3, None), (4, None)], "n int, s string"), [F.col("n")])
    assert sorted(r.n for r in gate.collect()) == [1, 3]


def test_near_links_find_every_pair(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)})
    df = spark.createDataFrame([(f"{c:016x}",) for c in codes], "s string")
    got = {(r.a, r.b, r.distance) for r in dedup.near_links(df).collect()}
    want = {(f"{a:016x}", f"{b:016x}", bin(a ^ b).count("1")) for a, b in combinations(codes, 2) if bin(a ^ b).count("1") <= 3}
    assert got == want
    for hot in (0, 3, 10**6):  # with and without the finer keys
        rows = [(r.a, r.b, r.distance) for r in dedup.near_links(df, hot=hot).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want  # each pair is made once
    for choice in dedup.CHOICES:
        rest = dedup._rest_masks(choice)
        assert len(rest) == 4 and sum(rest) == (1 << 64) - 1 - sum(dedup._mask(*dedup.BLOCKS[k]) for k in choice)


def test_near_classes_weigh_copies(spark):
    df = spark.createDataFrame([(1, "0" * 16), (2, "0" * 16), (3, "0" * 15 + "7"), (4, "f" * 16), (5, None)], "id int, s string")
    assert {r.id: r.n_links for r in dedup.near_classes(df, "id").collect()} == {1: 2, 2: 2, 3: 2, 4: 0, 5: 0}


def test_shards_are_complete_and_written(spark, tmp_path):
    df = spark.createDataFrame([(f"https://h{i}.example.org/", "text") for i in range(50)], "u string, c string")
    counts = shards.with_empty(shards.shard_counts(df, 8), 8).collect()
    assert len(counts) == 8 and sum(r.docs for r in counts) == 50
    for fmt in ("parquet", "json"):
        m = shards.write_sharded(df, str(tmp_path / fmt), 8, fmt=fmt)
        assert m.count() == 8 and spark.read.format(fmt).load(str(tmp_path / fmt)).count() == 50
        assert tuple(m.agg(F.sum("docs"), F.sum("bytes")).first()) == (50, 200)  # bytes of the payload
        assert spark.read.json(str(tmp_path / f"{fmt}-manifest")).agg(F.sum("docs")).first()[0] == 50


def test_index_last_write_wins_and_masks(spark):
    docs = spark.createDataFrame([(1, "https://a.example.org/", "Old words", ""), (2, "https://a.example.org/", "New mill mill", "mill"), (3, None, "x", "y")], "n int, u string, t string, d string")
    p = {r.term: (r.tf, r.mask) for r in index.postings(docs, "n").collect()}
    assert p["mill"] == (3, 3) and "old" not in p and p["example"] == (1, 4) and "new" not in p


def test_index_write_and_chunks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"https://a.example.org/{i}", "mill pond", "") for i in range(20)], "n int, u string, t string, d string")
    p = index.postings(docs, "n")
    index.write_index(p, str(tmp_path / "i"), 1)
    back, lengths = search.open_index(spark, str(tmp_path / "i"))
    assert back.count() == p.count() and lengths.count() == 20
    plan = search.match_all(back, ["mill", "pond"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]  # folders of other buckets are not read
    assert index.chunked(p, 4).where("term = 'mill'").agg(F.sum(F.size("d"))).first()[0] == 20
    assert search.match_all(p, ["mill", "pond"]).count() == 20 and search.match_all(p, ["mill", "none"]).count() == 0
    assert search.ranked(back, lengths, ["mill"]).count() == 15 and search.match_all(back, ["mill", "pond"]).count() == 20


def test_bloom_has_no_false_negatives(spark):
    docs = spark.createDataFrame([(f"https://h{i}.example.org/", f"title{i} alpha", "beta", "gamma delta") for i in range(30)], "u string, t string, d string, c string")
    terms = bloom.doc_terms(docs, 4)
    f = bloom.filters(terms)
    hit = {(r.term, r.shard) for r in bloom.probe(f, terms.select("term").distinct()).collect()}
    assert {(r.term, r.shard) for r in terms.distinct().collect()} <= hit
    sizes = bloom.to_binary(f).select(F.length("filter").alias("n")).distinct().collect()
    assert [r.n for r in sizes] == [8192]
    row = bloom.to_binary(f).orderBy("shard").first()
    bits = {r.word * 64 + k for r in f.where(F.col("shard") == row.shard).collect() for k in range(64) if (r.bits >> k) & 1}
    assert bits == {8 * i + k for i, b in enumerate(row.filter) for k in range(8) if (b >> k) & 1}


def test_delta_is_a_partition(spark):
    prev = delta.hashed(spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "u string, t string"), 4)
    cur = delta.hashed(spark.createDataFrame([("b", "1"), ("c", "2"), ("d", "1")], "u string, t string"), 4)
    assert [r.u for r in delta.added(cur, prev).collect()] == ["d"] and delta.removed(cur, prev).count() == 1 and [r.u for r in delta.changed(cur, prev).collect()] == ["c"]
    s = delta.summary(cur, prev, 4).agg(F.sum("docs"), F.sum("added"), F.sum("removed"), F.count("*")).first()
    assert tuple(s) == (3, 1, 1, 4)


def objs(spark, sizes):
    return spark.createDataFrame([(f"k{i:03}", s, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i, s in enumerate(sizes)], "key string, size bigint, ts timestamp")


def test_tiers(spark):
    assert [r.key for r in tiers.within_budget(objs(spark, [5, 3, 4, 1]), 8).orderBy("key").collect()] == ["k000", "k001"]
    assert [r.key for r in tiers.within_budget(objs(spark, [5, 3, 4, 1]), 8, objs(spark, [5]).select("key")).orderBy("key").collect()] == ["k001", "k002", "k003"]
    assert [r.key for r in tiers.prune_plan(objs(spark, [10, 10, 10, 10]), 30, 0.5).orderBy("key").collect()] == ["k000", "k001", "k002"]
    assert tiers.prune_plan(objs(spark, [10]), 30).count() == 0
    bins = {r.key: r.bin for r in tiers.next_fit(objs(spark, [4, 6, 1, 12, 3]), 10).collect()}
    assert bins == {"k000": 0, "k001": 0, "k002": 1, "k003": 2, "k004": 3}
    assert [r.bin for r in tiers.whole_bins(tiers.next_fit(objs(spark, [4, 6, 1, 12, 3]), 10), 11).orderBy("bin").collect()] == [0, 1]


def test_next_fit_over_partitions(spark):
    import random

    rng = random.Random(8)
    for n, target, sizes in [(0, 5, [1]), (300, 20, range(0, 9)), (200, 10, [0, 0, 1, 14, 25]), (150, 1000, [0, 3])]:
        x = [rng.choice(list(sizes)) for _ in range(n)]
        want, at, used = {}, 0, 0
        for k, v in enumerate(x):
            if used and used + v > target:
                at, used = at + 1, 0
            used += v
            want[f"k{k:03}"] = at
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert {r.key: r.bin for r in tiers.next_fit(objs(spark, x), target).collect()} == want
            got = {r.key for r in tiers.within_budget(objs(spark, x), 4 * target).collect()}
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        total = 0
        for k, v in enumerate(x):
            total += v
            assert (f"k{k:03}" in got) == (total <= 4 * target)


def test_steps_compose():
    import random

    import numpy as np

    from tidewrack.operators.rank import Steps

    def scan(sizes, target, used):
        begun = 0
        for s in sizes:
            if used and used + s > target:
                begun, used = begun + 1, 0
            used += s
        return begun, used

    rng = random.Random(4)
    for _ in range(400):
        target = rng.randint(1, 30)
        parts = [[rng.choice([0, 0, 1, 2, 5, 9, 40]) if rng.random() < 0.7 else rng.randint(0, target) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 5))]
        steps = [tiers._steps(np.array(p, dtype=np.int64), target) for p in parts]
        whole = steps[0]
        for x in steps[1:]:
            whole = whole.then(Steps.of(x.rows()))
        for used in range(0, target + 45):
            for p, x in zip(parts, steps):
                assert x.at(used) == scan(p, target, used), (p, target, used)
            assert whole.at(used) == scan([s for p in parts for s in p], target, used), (parts, target, used)


def test_next_fit_tells_the_driver_little():
    """Bins begun at different places meet: the steps of stretches put together are few, though a thousand places can begin a bin."""
    import random

    import numpy as np

    rng = random.Random(6)
    parts = [np.array([rng.choice([0, 1, 2, 3]) for _ in range(20_000)], dtype=np.int64) for _ in range(16)]
    steps = [tiers._steps(x, 2_000) for x in parts]
    whole = steps[0]
    for x in steps[1:]:
        whole = whole.then(x)
    assert max(len(x.steps) for x in steps) < 700 and len(whole.steps) < 100 and len(tiers._steps(np.zeros(50_000, dtype=np.int64), 10).steps) <= 1


def test_order_statistics(spark):
    import random

    from tidewrack.operators.rank import order_statistics

    rng = random.Random(5)
    v = [rng.choice([1, 2, 2, 3, rng.randint(0, 500)]) for _ in range(700)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v int").repartition(5)
    assert order_statistics(df, "v", [0, 350, 699, 5000]) == {0: min(v), 350: sorted(v)[350], 699: max(v), 5000: max(v)}
    assert order_statistics(df, "v", [3, 35], descending=True) == {k: sorted(v, reverse=True)[k] for k in (3, 35)}
    assert order_statistics(df.where("false"), "v", [2]) == {2: None}


def test_file_times(spark):
    names = spark.createDataFrame([("hot/rss-2024-03-01T10-20-30-000Z.ndjson.gz",), ("hot/ct-1709288430000.ndjson.gz",), ("x/202403011020.mentions",), ("x/none",)], "k string")
    got = [str(r.t) if r.t else None for r in names.select(tiers.file_time(F.col("k")).alias("t")).collect()]
    assert got == ["2024-03-01 10:20:30", "2024-03-01 10:20:30", "2024-03-01 10:20:00", None]


def test_robots(spark):
    cases = [
        ("User-agent: *\nDisallow: /", False, 0), ("User-agent: other\nDisallow: /", True, 0), ("User-agent: *\n\nDisallow: /", True, 0), ("User-agent: *\nDisallow: /\nDisallow:", True, 0), ("User-agent: *\n# c\nDisallow: /", True, 0),
        ("User-Agent: Tidewrack\nCrawl-delay: 99\nDisallow: /x", True, 10000), (None, True, 0), ("User-agent: *\r\nCrawl-delay: 1.5\r\nDisallow: / # all", False, 1500),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, body string")
    assert [(r.allow, r.delay_ms) for r in frontier.robots(df).orderBy("i").collect()] == [(c[1], c[2]) for c in cases]


def test_schedule_spaces_fetches(spark):
    df = spark.createDataFrame([(f"https://a.example.org/{i}",) for i in range(40)] + [("https://b.example.org/",)], "u string")
    got = frontier.schedule(df).groupBy("host").agg(F.sort_array(F.collect_list("start_ms")).alias("s")).collect()
    assert {r.host: r.s for r in got} == {"a.example.org": [800 * i for i in range(40)], "b.example.org": [0]}


def test_feeds(spark):
    xml = "<rss>" + "".join(f"<item><title>t</title><link>https://f.example.org/{i}</link></item>" for i in range(45)) + "</rss>"
    atom = '<feed><entry><link rel="x" href="https://a.example.org/1"/></entry><entry><link href="ftp://no"/></entry></feed>'
    df = spark.createDataFrame([("r", xml), ("a", atom), ("n", None)], "id string, xml string")
    assert {r["id"]: r["n"] for r in feeds.feed_items(df).groupBy("id").agg(F.count("*").alias("n")).collect()} == {"r": 40, "a": 1}
    maps = spark.createDataFrame([("https://h.example.org/sitemap.xml", "<sitemapindex><loc> https://h.example.org/s1.xml </loc></sitemapindex>"), ("https://h.example.org/s1.xml", "<urlset><loc>https://h.example.org/p</loc><loc>ftp://x</loc></urlset>"), ("https://o.example.org/s.xml", "<urlset><loc>https://o.example.org/q</loc></urlset>")], "url string, xml string")
    roots = spark.createDataFrame([("h", "https://h.example.org/sitemap.xml", 0), ("o", "https://o.example.org/s.xml", 0), ("x", "https://none.example.org/", 0)], "host string, url string, place int")
    assert {(r.host, r.u) for r in feeds.sitemap_urls(roots, maps).collect()} == {("h", "https://h.example.org/p"), ("o", "https://o.example.org/q")}
    index = "<sitemapindex>" + "".join(f"<loc>https://i.example.org/{k}.xml</loc>" for k in range(30, 0, -1)) + "</sitemapindex>"
    maps = spark.createDataFrame([("https://i.example.org/i.xml", index)] + [(f"https://i.example.org/{k}.xml", f"<urlset><loc>https://i.example.org/p{k}</loc></urlset>") for k in range(31)] + [(f"https://i.example.org/r{k}", f"<urlset><loc>https://i.example.org/q{k}</loc></urlset>") for k in range(6)], "url string, xml string")
    roots = spark.createDataFrame([("i", "https://i.example.org/i.xml", 0)] + [("i", f"https://i.example.org/r{k}", 6 - k) for k in range(6)], "host string, url string, place int")
    got = {r.u.rsplit("/", 1)[1] for r in feeds.sitemap_urls(roots, maps).collect()}
    assert got == {f"p{k}" for k in range(11, 31)} | {"q5", "q4", "q3"}  # children in document order, four roots
    assert [r.u.rsplit("/", 1)[1] for r in feeds.sitemap_urls(roots, maps, per_host=3).orderBy("u").collect()] == ["p28", "p29", "p30"]
    plain = spark.createDataFrame([("https://a.org/sitemap_index.xml", "<loc>https://a.org/2</loc>"), ("https://b.org/sitemap.xml", "<loc>https://b.org/1</loc>"), ("https://b.org/sitemap_index.xml", "<loc>https://b.org/9</loc>")], "url string, xml string")
    assert {r.u for r in feeds.simple_sitemaps(spark.createDataFrame([("a.org",), ("b.org",), ("c.org",)], "host string"), plain).collect()} == {"https://a.org/2", "https://b.org/1"}
    assert feeds.feed_list(spark, None).count() == feeds.feed_list(spark, plain.where("false")).count() == len(feeds.DEFAULT_FEEDS) and feeds.feed_list(spark, plain).count() == 3
    rb = spark.createDataFrame([("h", "Sitemap: https://h/x.xml\nsitemap:https://h/y.xml"), ("g", None)], "host string, body string")
    assert {r.sitemap for r in feeds.robots_sitemaps(rb).collect()} == {"https://h/x.xml", "https://h/y.xml", "https://g/sitemap.xml"}
    zone = spark.createDataFrame([("Foo.ch. 3600 IN NS ns1.x.",), ("a.foo.ch. IN NS ns.x.",), ("bar.ch. 3600 in a 1.2.3.4",), ("baz.org. IN NS ns.x.",)], "value string")
    assert [r.domain for r in feeds.zone_domains(zone, "ch").collect()] == ["foo.ch"] and [r.domain for r in feeds.zone_domains(zone, "", most=1).collect()] == ["baz.org"]
    many = spark.createDataFrame([(["*.a.co.uk", "b.a.co.uk", "c.example.org"],), (None,)], "dns_names array<string>")
    assert {r.domain for r in feeds.issuance_names(many).collect()} == {"a.co.uk", "example.org"}
    tsv = "\t".join(["0", "1", "2", "3", "src", "https://m.example.org/", "6", "7", "8", "9", "10", "11", "12", "1.5abc"])
    got = feeds.mentions(spark.createDataFrame([(tsv,), (tsv.replace("https", "ftp"),), ("short",), ("\t\t\t\t\thttp://x.example.org/",)], "value string")).collect()
    assert [(r.u, r.host, r.tone) for r in got] == [("https://m.example.org/", "src", 1.5), ("http://x.example.org/", "", 0.0)]
    crt = spark.createDataFrame([("*.a.co.uk\nb.a.co.uk\nXX.example.org",)], "name_value string")
    assert {r.domain for r in feeds.certificate_names(crt).collect()} == {"a.co.uk", "example.org"}


def test_active_logs(spark):
    from tidewrack.schemas import LOG_LIST

    doc = spark.createDataFrame([([("Op A", [("Log 1!", "https://l.example.org/", (("t",), None)), ("Log 2", "https://m", (None, None))])],)], LOG_LIST)
    assert [tuple(r) for r in feeds.active_logs(doc).collect()] == [("Log 1!", "op-a-log-1", "https://l.example.org", "Op A")]


def test_pagerank_small_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "src string, dst string").withColumn("cnt", F.lit(1))
    r = {x.host: x.rank for x in graph.pagerank(e).collect()}
    assert r["a"] == 1.0 and r["a"] > r["b"] > r["c"] > 0
    full = {x.host: x.rank for x in graph.pagerank(spark.createDataFrame([("a", "b")], "src string, dst string").withColumn("cnt", F.lit(1)), redistribute=True).collect()}
    assert full["b"] == 1.0
    assert graph.pagerank(e.where("false")).count() == 0


def test_signals_sketch(spark):
    rows = [("u", t, 0.5, 0.5, True, True, "2") for t in "aaabbc"] + [("u", "z", 1.0, 1.0, True, True, "1")]
    df = spark.createDataFrame(rows, "url string, tech string, perf double, seo double, https boolean, mobile boolean, date string")
    assert [(x.item, x["count"]) for x in signals.rollup(df).first().tech] == [("a", 3), ("b", 2), ("c", 1)]
    assert signals.rollup(df, exact=False).count() == 1


def test_ttl_exact_boundary(spark):
    t = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 3, 6)]
    got = metrics.ttl_emissions(spark.createDataFrame([("h", x) for x in t] + [(None, t[0]), ("g", None)], "host string, ts timestamp"), "host", "ts")
    assert sorted(r.emitted_at for r in got.collect()) == [t[0], t[2], t[4]]


def test_ttl_over_many_partitions_of_a_hot_key(spark):
    import random

    rng = random.Random(9)
    rows = [("hot", rng.randrange(40 * 86_400)) for _ in range(3000)] + [(f"h{k % 7}", rng.randrange(40 * 86_400)) for k in range(200)]
    want = set()
    for k in {k for k, _ in rows}:
        last = None
        for v in sorted({v for n, v in rows if n == k}):
            if last is None or v >= last + 86_400:
                want.add((k, v))
                last = v
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, start + dt.timedelta(seconds=v)) for k, v in rows] * 2, "host string, ts timestamp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.host, int((r.emitted_at - start).total_seconds())) for r in metrics.ttl_emissions(df, "host", "ts").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(want) and set(got) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "rec_id bigint, u string, t string, d string, c string, l string, s string")
    assert dedup.near_classes(docs, "rec_id").count() == 0
    assert index.postings(docs, "rec_id").count() == 0
    assert bloom.filters(bloom.doc_terms(docs)).count() == 0
    assert graph.scores(graph.inlinks(spark.createDataFrame([], "links array<string>"))).count() == 0
    assert tiers.next_fit(objs(spark, []), 5).count() == 0
