"""File sources and sinks: NDJSON, listings, archives in ZIP, Parquet conversion."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, key: str = "u") -> DataFrame:
    """Lines of JSON (gzip by name), with a fixed schema; malformed lines and rows without key are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(f"{key} is not null and {key} <> ''")


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines that are not blank, with the file and the offset order kept as ``line_no`` within a file."""
    lines = spark.read.text(path).select(F.trim("value").alias("path"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"))
    return lines.where("path <> ''")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, length, modificationTime)`` of all files below a folder; bodies are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")


def first_files(spark: SparkSession, path: str, n: int, newest: bool = False) -> list[str]:
    """The first (or last) ``n`` paths of a listing in order of name; ``n`` is the bound of what the driver gets."""
    names = listing(spark, path).select("path")
    return [r.path for r in names.orderBy(F.desc("path") if newest else F.asc("path")).limit(n).collect()]


def slice_of(names: DataFrame, start: int, n: int, col: str = "path") -> DataFrame:
    """Rows ``start`` to ``start + n`` in order of name: a cursor over a listing."""
    return names.orderBy(col).offset(start).limit(n)


def split_budget(budget: int, share: float = 0.4) -> tuple[int, int]:
    """A budget divided between two listings."""
    first = int(budget * share)
    return first, budget - first


def unzip_first(body: Column) -> Column:
    """The first member of a ZIP archive as text; null if it is none."""

    @F.pandas_udf("string")
    def member(s: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> str | None:
            try:
                with zipfile.ZipFile(io.BytesIO(b)) as z:
                    return z.read(z.namelist()[0]).decode("utf-8", "replace")
            except (zipfile.BadZipFile, IndexError, TypeError):
                return None

        return s.map(one)

    return member(body)


def mention_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of zipped mention tables, with the time in the file name (seconds are ignored)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    at = F.to_timestamp(F.regexp_extract("path", r"(\d{12})\d{0,2}\.", 1), "yyyyMMddHHmm")
    return files.select(at.alias("batch_ts"), F.explode(F.split(unzip_first(F.col("content")), "\n")).alias("value")).where("value <> ''")


def mention_files(master: DataFrame, since: str, until: str, line: str = "value") -> DataFrame:
    """Addresses of mention archives of a master list whose name's time lies in a window."""
    url = F.element_at(F.split(F.trim(line), r"\s+"), -1)
    at = F.try_to_timestamp(F.nullif(F.regexp_extract(url, r"/(\d{12})\d{2}\.", 1), F.lit("")), F.lit("yyyyMMddHHmm"))
    return master.select(url.alias("url"), at.alias("at")).where(F.lower("url").endswith(".mentions.csv.zip") & F.col("at").between(F.lit(since).cast("timestamp"), F.lit(until).cast("timestamp")))


def to_parquet(df: DataFrame, path: str, level: int = 3) -> None:
    """Zstandard Parquet; row groups are sized in bytes by the writer."""
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)


def cold_rewrite(spark: SparkSession, src: str, dst: str, schema: T.StructType, level: int = 19) -> None:
    """Rewrite NDJSON at the highest useful compression; deleting the source is the caller's step after a check."""
    to_parquet(read_ndjson(spark, src, schema), dst, level)
