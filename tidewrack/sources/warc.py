"""Web archive files as a data source: one partition per file, response records only."""

from __future__ import annotations

import glob
import gzip
import logging
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def records(stream, name: str = "", strict: bool = False) -> Iterator[tuple[str, bytes]]:
    """``(target address, HTTP message)`` of the response records of a decompressed archive stream.

    A record has header lines up to a blank line and a body of Content-Length bytes. Without a length the rest of the
    stream can't be cut into records: it is left, and the number of its bytes is reported (or, ``strict``, an error).
    """
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        head: dict[bytes, bytes] = {}
        while line and line.strip():
            key, sep, value = line.partition(b":")
            if sep:
                head[key.strip().lower()] = value.strip()
            line = stream.readline()
        length = head.get(b"content-length")
        if length is None or not length.isdigit():
            left = sum(len(block) for block in iter(lambda: stream.read(1 << 20), b""))
            if strict:
                raise ValueError(f"{name}: a record without length, {left} bytes after its header")
            logging.getLogger(__name__).warning("%s: a record without length, %d bytes after its header are left", name, left)
            return
        body = stream.read(int(length))
        if head.get(b"warc-type", b"").lower() == b"response" and (uri := head.get(b"warc-target-uri")):
            yield uri.decode("utf-8", "replace").strip("<>"), body


def http_body(message: bytes) -> str:
    """The text after the first blank line of an HTTP message, as UTF-8; '' if there is none."""
    for end in (b"\r\n\r\n", b"\n\n"):
        head, sep, body = message.partition(end)
        if sep:
            return body.decode("utf-8", "replace")
    return ""


class _Reader(DataSourceReader):
    def __init__(self, path: str, strict: bool = False):
        self.path, self.strict = path.replace("file://", "").replace("file:", ""), strict

    def partitions(self) -> list[_File]:
        found = [p for part in self.path.split(",") for p in (sorted(glob.glob(os.path.join(part, "**", "*.warc*"), recursive=True)) if os.path.isdir(part) else sorted(glob.glob(part)))]
        return [_File(p) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open(partition.path, "rb") as raw:
            zipped = raw.read(2) == b"\x1f\x8b"
            raw.seek(0)
            stream = gzip.open(raw) if zipped else raw
            for uri, message in records(stream, partition.path, self.strict):
                yield uri, http_body(message)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``: path is a file, a pattern, a folder or several with commas between.

    Paths must be readable on every executor (a mounted store). Members of a gzip archive are read one after the other.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return "uri string, html string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("strict", "false") == "true")
