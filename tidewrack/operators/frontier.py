"""What to fetch next: pending segments, crawl candidates, robots rules, politeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions import urls

HOST_DELAY_MS = 800
MAX_DELAY_S = 10
AGENT = "tidewrack"


def pending(paths: DataFrame, done: DataFrame, claimed: DataFrame) -> DataFrame:
    """Segments (``id``) that are neither done nor claimed."""
    return paths.join(done.select("id"), "id", "left_anti").join(claimed.select("id"), "id", "left_anti")


def segments(*dumps: DataFrame) -> DataFrame:
    """The lists of several dumps, without repeated segment names: the first dump's line wins. Inputs: (line_no, path)."""
    from .dedup import keep_one

    union = None
    for k, d in enumerate(dumps):
        part = d.select(F.lit(k).alias("dump"), "line_no", F.trim("path").alias("path")).where("path <> ''").withColumn("id", urls.segment_id(F.col("path")))
        union = part if union is None else union.unionByName(part)
    return keep_one(union, ["id"], [F.col("dump"), F.col("line_no")])


def candidates(hot: DataFrame, sitemap: DataFrame, recent: DataFrame, u: str = "u") -> DataFrame:
    """Distinct addresses of both sources that were not fetched lately."""
    return hot.select(u).unionByName(sitemap.select(u)).where(F.col(u).rlike("^https?://")).distinct().join(recent.select(u).distinct(), u, "left_anti")


def stale_hosts(hosts: DataFrame, tried: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Hosts not tried within ``days`` before ``as_of``; tried: (host, tried_at)."""
    recent = tried.where(F.col("tried_at") > F.expr(f"timestamp '{as_of}' - interval {int(days)} days")).select("host").distinct()
    return hosts.select("host").distinct().join(recent, "host", "left_anti")


def sample(df: DataFrame, key: str, n: int, seed: int = 1337) -> DataFrame:
    """``n`` rows in an order fixed by key and seed; the same on every engine."""
    return df.withColumn("_o", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).orderBy("_o", key).limit(n).drop("_o")


def schedule(df: DataFrame, u: str = "u", delay_ms: Column | None = None) -> DataFrame:
    """Earliest start of each fetch in milliseconds: per host one after the other, ``delay`` apart.

    The position within a host is counted in two levels (hash pieces of the host, then within the piece), so a host that
    holds a third of all rows is no single sort.
    """
    pieces = 64
    h = df.withColumn("host", urls.host_port(F.col(u))).withColumn("_piece", F.pmod(F.xxhash64(u), F.lit(pieces)).cast("int"))
    sizes = h.groupBy("host", "_piece").agg(F.count("*").alias("_n"))
    base = sizes.select("host", "_piece", F.coalesce(F.sum("_n").over(Window.partitionBy("host").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))  # at most 64 rows a host
    within = h.withColumn("_k", F.row_number().over(Window.partitionBy("host", "_piece").orderBy(u)) - 1)
    delay = F.greatest(F.lit(HOST_DELAY_MS), delay_ms if delay_ms is not None else F.lit(0))
    return within.join(base, ["host", "_piece"]).withColumn("start_ms", ((F.col("_base") + F.col("_k")) * delay).cast("bigint")).drop("_piece", "_k", "_base")


def robots(texts: DataFrame, body: str = "body", agent: str = AGENT) -> DataFrame:
    """Adds ``allow`` and ``delay_ms`` of robots rules, folded line by line within the row.

    Rules count in blocks for ``*`` or the agent; a blank or comment line ends a block; only ``/`` and an empty Disallow
    matter, the last one wins; delays are at most ten seconds; a missing text allows all.
    """
    lines = F.transform(F.split(F.substring(F.coalesce(F.col(body), F.lit("")), 1, 30_000), "\r?\n"), lambda x: F.trim(F.regexp_replace(x, "#.*", "")))
    start = F.struct(F.lit(False).alias("inside"), F.lit(True).alias("allow"), F.lit(0).cast("bigint").alias("delay_ms"))

    def step(acc: Column, line: Column) -> Column:
        key, value = F.lower(F.regexp_extract(line, r"^([A-Za-z-]+):\s*(.*)$", 1)), F.trim(F.regexp_extract(line, r"^([A-Za-z-]+):\s*(.*)$", 2))
        inside = F.when(line == "", F.lit(False)).when(key == "user-agent", (value == "*") | (F.lower(value) == agent)).otherwise(acc["inside"])
        active = acc["inside"] & (line != "")
        allow = F.when(active & (key == "disallow") & value.isin("/", ""), value != "/").otherwise(acc["allow"])
        number = value.try_cast("double")
        delay = F.when(active & (key == "crawl-delay") & number.isNotNull(), (F.least(F.lit(float(MAX_DELAY_S)), number) * 1000).cast("bigint")).otherwise(acc["delay_ms"])
        return F.struct(inside.alias("inside"), allow.alias("allow"), delay.alias("delay_ms"))

    folded = F.aggregate(lines, start, step)
    return texts.withColumn("_r", folded).withColumn("allow", F.col("_r.allow")).withColumn("delay_ms", F.col("_r.delay_ms")).drop("_r")


def lcg_shuffle(items: list[str], seed: int = 1337) -> list[str]:
    """A list (of segment names: driver-sized) in the order of a linear congruential generator on doubles.

    The product passes 2^53, so it is rounded to a double before it is masked to 31 bits.
    """
    out, x = list(items), float(seed)
    for i in range(len(out) - 1, 0, -1):
        x = float(int(x * 1103515245.0 + 12345.0) & 0x7FFFFFFF)
        j = min(i, int(x / 0x7FFFFFFF * (i + 1)))
        out[i], out[j] = out[j], out[i]
    return out


def reset_claims(claims: DataFrame, done: DataFrame, as_of: str, hours: int = 6) -> DataFrame:
    """Claims (``id``, ``claimed_at``) that stay: of segments not done, and not older than a run may take."""
    young = claims.where(F.col("claimed_at") >= F.expr(f"timestamp '{as_of}' - interval {int(hours)} hours"))
    return young.join(done.select("id").distinct(), "id", "left_anti")
