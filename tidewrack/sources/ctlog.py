"""Certificate logs: leaf parsing and an offset-addressed streaming source."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NEW_LOG = 1024
_HOST = re.compile(rb"^[a-z0-9*][a-z0-9.\-*]*[a-z0-9]$")


def leaf_time(leaf: Column) -> Column:
    """The time of a binary leaf; null if it is too short."""
    ms = F.conv(F.hex(F.substring(leaf, 3, 8)), 16, 10).try_cast("bigint")
    return F.when(F.length(leaf) >= 12, F.timestamp_millis(ms))


def leaf_certificate(leaf: Column) -> Column:
    """The certificate bytes of a leaf: entry type 0 (length at 12) or 1 (a key hash of 32 bytes first); else null."""
    number = lambda at, n: F.conv(F.hex(F.substring(leaf, at, n)), 16, 10).cast("int")
    kind = number(11, 2)
    cert = F.when((F.length(leaf) >= 15) & (kind == 0), F.substring(leaf, F.lit(16), F.when(F.length(leaf) >= 15, number(13, 3))))
    return F.coalesce(cert, F.when((F.length(leaf) >= 47) & (kind == 1), F.substring(leaf, F.lit(48), F.when(F.length(leaf) >= 47, number(45, 3)))))


def dns_names(der: bytes | None) -> list[str]:
    """Host names behind tag 0x82 of a certificate: printable, of 3 to 253 bytes, with a dot; a hit is skipped as a whole."""
    out: dict[str, None] = {}
    i, n = 0, len(der or b"")
    while i < n - 4:
        if der[i] != 0x82:
            i += 1
            continue
        size = der[i + 1]
        name = bytes(der[i + 2 : i + 2 + size])
        if 3 <= size <= 253 and len(name) == size and all(0x20 <= b <= 0x7E for b in name):
            low = name.lower()
            if b"." in low and _HOST.match(low):
                out[low.decode("ascii")] = None
                i += size + 2
                continue
        i += 1
    return list(out)


def certificate_hosts(der: Column) -> Column:
    """Host names of certificates (Arrow batches; a byte scan that no expression gives)."""

    @F.pandas_udf("array<string>")
    def scan(s: pd.Series) -> pd.Series:
        return s.map(dns_names)

    return scan(der)


class _File(InputPartition):
    """The entries from ``start`` to ``end`` of one file of a log."""

    def __init__(self, log: str, path: str, first: int, start: int, end: int):
        self.log, self.path, self.first, self.start, self.end = log, path, first, start, end


class _Logs:
    """A folder of logs. A log is a folder of files of one base64 leaf per line, named by their first entry.

    A file ends where the next begins, so that only the newest file of a log is counted, and only again when it has grown.
    """

    def __init__(self, path: str):
        self.path = path.removeprefix("file://").removeprefix("file:")
        self.counted: dict[str, tuple[int, int]] = {}

    def _lines(self, path: str) -> int:
        size = os.path.getsize(path)
        if self.counted.get(path, (-1, 0))[0] != size:
            with open(path, "rb") as f:
                self.counted[path] = size, sum(block.count(b"\n") for block in iter(lambda: f.read(1 << 20), b""))
        return self.counted[path][1]

    def files(self, log: str) -> list[tuple[int, str]]:
        folder = os.path.join(self.path, log)
        return sorted((int(f.split(".")[0]), os.path.join(folder, f)) for f in os.listdir(folder) if f.split(".")[0].isdigit())

    def sizes(self) -> dict[str, int]:
        out = {}
        for log in sorted(os.listdir(self.path)):
            if os.path.isdir(os.path.join(self.path, log)):
                files = self.files(log)
                out[log] = files[-1][0] + self._lines(files[-1][1]) if files else 0
        return out

    def parts(self, start: dict, end: dict) -> list[_File]:
        """One partition per file that holds entries of the ranges."""
        out = []
        for log, last in end.items():
            first, files = start.get(log, 0), self.files(log) if last > start.get(log, 0) else []
            for k, (begin, path) in enumerate(files):
                until = files[k + 1][0] if k + 1 < len(files) else last
                if begin < last and until > first:
                    out.append(_File(log, path, begin, max(begin, first), min(until, last)))
        return out

    @staticmethod
    def read(part: _File) -> Iterator[tuple]:
        with open(part.path) as lines:
            for k, line in enumerate(lines, part.first):
                if k >= part.end:
                    return
                if k >= part.start:
                    yield part.log, k, line.strip()


class _Batch(DataSourceReader):
    """The last ``lastentries`` entries of each log, or all."""

    def __init__(self, options: dict):
        self.logs, self.last = _Logs(options["path"]), int(options.get("lastentries", -1))

    def partitions(self) -> list[_File]:
        end = self.logs.sizes()
        return self.logs.parts({k: max(0, v - self.last) if self.last >= 0 else 0 for k, v in end.items()}, end)

    def read(self, partition: _File) -> Iterator[tuple]:
        return self.logs.read(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are ``{log: next entry}``. A micro-batch takes all that is new, a task per file, so that a run which
    resumes needs to know no more than the offsets that the engine saved.
    """

    def __init__(self, options: dict):
        self.logs, self.from_start = _Logs(options["path"]), options.get("from", "head") == "start"

    def initialOffset(self) -> dict:
        """First contact starts at the head of a long log."""
        return {k: 0 if self.from_start or v <= NEW_LOG else v for k, v in self.logs.sizes().items()}

    def latestOffset(self) -> dict:
        return self.logs.sizes()

    def partitions(self, start: dict, end: dict) -> list[_File]:
        return self.logs.parts(start, end)

    def read(self, partition: _File) -> Iterator[tuple]:
        return self.logs.read(partition)

    def commit(self, end: dict) -> None:
        pass


class CtLogDataSource(DataSource):
    """``spark.readStream.format("ctlog").option("path", ...)``: entries of all logs below a folder that executors share.

    ``spark.read`` reads them once: all, or with ``lastentries`` the newest of each log.
    """

    @classmethod
    def name(cls) -> str:
        return "ctlog"

    def schema(self) -> str:
        return "log string, entry bigint, leaf string"

    def reader(self, schema) -> _Batch:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> _Stream:
        return _Stream(dict(self.options))


def register(spark) -> None:
    """Make both own formats known to a session."""
    from .warc import WarcDataSource

    spark.dataSource.register(WarcDataSource)
    spark.dataSource.register(CtLogDataSource)


__all__ = ["CtLogDataSource", "certificate_hosts", "dns_names", "leaf_certificate", "leaf_time", "register"]
