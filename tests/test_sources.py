import base64
import datetime as dt
import gzip
import io
import json
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tidewrack import schemas
from tidewrack.sources import ctlog, files
from tidewrack.streaming import dedup


def record(kind, uri, body, length=True):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n" + (f"Content-Length: {len(body)}\r\n" if length else "") + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_warc(spark, tmp_path):
    ctlog.register(spark)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>caf\xe9</p>"
    members = [record("warcinfo", "", b"x"), record("request", "https://a.example.org/", b"GET"), record("response", "https://a.example.org/", http)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members) + gzip.compress(record("response", "https://b.example.org/", b"no blank line")))
    (tmp_path / "b.warc").write_bytes(record("response", "https://c.example.org/", http) + record("response", "https://d.example.org/", http, length=False))
    got = {r.uri: r.html for r in spark.read.format("warc").load(str(tmp_path)).collect()}
    assert got == {"https://a.example.org/": "<p>caf�</p>", "https://b.example.org/": "", "https://c.example.org/": "<p>caf�</p>"}
    with pytest.raises(Exception, match="without length"):
        spark.read.format("warc").option("strict", "true").load(str(tmp_path)).collect()


def name(host):
    return b"\x82" + bytes([len(host)]) + host


def leaf(kind, der, ms=1_700_000_000_000):
    head = b"\x00\x00" + ms.to_bytes(8, "big") + kind.to_bytes(2, "big")
    return head + (b"k" * 32 if kind == 1 else b"") + len(der).to_bytes(3, "big") + der


def test_certificate_leaves(spark):
    der = b"\x30\x82\x01" + name(b"A.Example.org") + name(b"nodot") + name(b"*.b.example.org") + b"\x82\x05a\x01.bc" + name(b"c.example.org") + b"pad.."
    rows = [(base64.b64encode(leaf(0, der)).decode(),), (base64.b64encode(leaf(1, der)).decode(),), (base64.b64encode(leaf(2, der)).decode(),), ("AAAA",), (None,)]
    got = dedup.seeds(spark.createDataFrame([("log", 1, r[0]) for r in rows], "log string, entry bigint, leaf string")).collect()
    assert sorted(r.t for r in got) == ["a.example.org"] * 2 + ["c.example.org"] * 2
    assert {r.ts for r in got} == {dt.datetime(2023, 11, 14, 22, 13, 20)}
    assert ctlog.dns_names(None) == [] and ctlog.dns_names(b"\x82") == []


def test_log_stream_resumes_by_offset(spark, tmp_path):
    ctlog.register(spark)
    logs, out, cp = tmp_path / "logs", tmp_path / "out", tmp_path / "cp"
    (logs / "one").mkdir(parents=True)
    (logs / "one" / "0.txt").write_text("".join(f"l{i}\n" for i in range(600)))
    run = lambda: dedup.drain(spark.readStream.format("ctlog").option("path", str(logs)).option("from", "start").load(), str(out), str(cp)).awaitTermination(120)
    run()
    assert spark.read.parquet(str(out)).count() == 600
    (logs / "one" / "600.txt").write_text("l600\n")
    run()
    assert spark.read.parquet(str(out)).agg(F.count("*"), F.countDistinct("entry"), F.max("entry")).first()[:] == (601, 601, 600)
    (logs / "two").mkdir()
    read = lambda n: sorted((r.log, r.entry, r.leaf) for r in spark.read.format("ctlog").option("path", str(logs)).option("lastentries", n).load().collect())
    assert read(3) == [("one", k, f"l{k}") for k in (598, 599, 600)] and len(read(-1)) == 601
    parts = ctlog._Logs(str(logs)).parts({"one": 599}, {"one": 601})
    assert [(p.first, p.start, p.end) for p in parts] == [(0, 599, 600), (600, 600, 601)]  # a file is read by one task, once
    assert ctlog._Logs(str(logs)).parts({"one": 600}, {"one": 601})[0].first == 600  # older files are not opened


def rolled(spark, folder, batches, delay, end=None):
    """Emissions of a stream over one file a micro-batch; ``end`` is the hour of the closing mark."""
    import os

    start = dt.datetime(2024, 1, 1)
    (folder / "src").mkdir(parents=True)
    for k, b in enumerate([*batches, *([[(dedup.END, end)]] if end else [])]):
        (folder / "src" / f"{k}.json").write_text("".join(json.dumps({"host": h, "ts": (start + dt.timedelta(hours=x)).isoformat()}) + "\n" for h, x in b))
        os.utime(folder / "src" / f"{k}.json", (time.time() - 100 + k, time.time() - 100 + k))
    stream = dedup.new_files(spark, str(folder / "src"), "host string, ts timestamp", per_batch=1)
    dedup.drain(dedup.rolling(stream, delay), str(folder / "o"), str(folder / "c")).awaitTermination(240)
    return sorted((r.host, int((r.ts - start).total_seconds() // 3600)) for r in spark.read.parquet(str(folder / "o")).collect())


def test_rolling_dedup_stream(spark, tmp_path):
    batches = [[("h", 0), ("h", 1), ("g", 2)], [("h", 23), ("h", 24)], [("h", 47), ("h", 48), ("g", 60)]]
    want = [("g", 2), ("g", 60), ("h", 0), ("h", 24), ("h", 48)]
    assert rolled(spark, tmp_path / "a", batches, "1 hour", 1000) == want
    # late rows within the delay give the rows of the batch form, in whatever batches they come
    late = [[("h", 47), ("h", 24), ("g", 60)], [("h", 1), ("g", 2)], [("h", 0), ("h", 48), ("h", 23)]]
    assert rolled(spark, tmp_path / "b", late, "70 hours", 1000) == want
    from tidewrack.operators import metrics

    start = dt.datetime(2024, 1, 1)
    flat = spark.createDataFrame([(h, start + dt.timedelta(hours=x)) for b in late for h, x in b], "host string, ts timestamp")
    assert sorted((r.host, int((r.emitted_at - start).total_seconds() // 3600)) for r in metrics.ttl_emissions(flat, "host", "ts").collect()) == want
    # without the end mark, what the watermark has not passed stays undecided; rows later than the delay are left out
    assert rolled(spark, tmp_path / "c", batches, "30 hours") == [("g", 2), ("h", 0), ("h", 24)]
    assert rolled(spark, tmp_path / "d", [[("h", 100)], [("h", 200)], [("h", 10)]], "1 hour", 1000) == [("h", 100), ("h", 200)]


def test_once_stream(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.json").write_text('{"host":"a"}\n{"host":"a"}\n{"host":"b"}\n')
    dedup.drain(dedup.once(dedup.new_files(spark, str(tmp_path / "s"), "host string")), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_files(spark, tmp_path):
    p = tmp_path / "x.ndjson.gz"
    p.write_bytes(gzip.compress(b'{"u":"https://a/","t":"x"}\nnot json\n{"t":"no key"}\n{"u":""}\n'))
    assert [r.u for r in files.read_ndjson(spark, str(p), schemas.RAW_DOC).collect()] == ["https://a/"]
    files.cold_rewrite(spark, str(p), str(tmp_path / "cold"), schemas.RAW_DOC)
    assert spark.read.parquet(str(tmp_path / "cold")).count() == 1
    assert files.listing(spark, str(tmp_path), "*.gz").count() == 1 and len(files.first_files(spark, str(tmp_path), 5)) >= 2
    assert files.split_budget(10) == (4, 6)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m.csv", "a\tb\nc\n")
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "20240301102000.mentions.CSV.zip").write_bytes(buf.getvalue())
    (tmp_path / "z" / "20240301103500.mentions.CSV.zip").write_bytes(b"no zip")
    got = files.mention_lines(spark, str(tmp_path / "z")).collect()
    assert [(r.value, r.batch_ts) for r in got] == [("a\tb", dt.datetime(2024, 3, 1, 10, 20)), ("c", dt.datetime(2024, 3, 1, 10, 20))]
    master = spark.createDataFrame([("1 h http://x.example.org/20240301102000.mentions.CSV.zip",), ("1 h http://x.example.org/20240301102000.export.CSV.zip",), ("1 h http://x.example.org/20240302102000.mentions.CSV.zip",)], "value string")
    assert files.mention_files(master, "2024-03-01 00:00:00", "2024-03-01 23:00:00").count() == 1
