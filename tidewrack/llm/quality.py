"""Problem 5: per-document text statistics, mergeable quantile sketches of them per language, and distribution tails.

1. Arrow batches give each document its statistics: words, mean word length, symbol and digit ratios, share of lines
   and blocks ended by punctuation, share of common words, repeated-word share, and the shares of its content (page
   furniture set aside) in sentences and in rows, code or junk.
2. Each statistic is sketched per language as counts over fixed logarithmic or linear bins. Adding counts merges
   sketches exactly; a quantile is off by at most one bin (1 % for logarithmic bins). A sketch has at most ``BINS`` bins,
   a task at most languages x statistics of them, and only summed bins reach the driver.
3. Each value becomes a percentile and a robust z-score (median and median absolute deviation from the sketch of its
   language, drawn towards that of all languages as ``SHRINK`` documents would draw it).
4. A document is a candidate if it lies in the tails of its language: in the lower one of the sentence share, and in
   those of at least ``OUTLYING`` of the thirteen statistics that do not judge sentences. The sketches are of distinct
   texts (:func:`distinct_texts`), and the sentence share is judged by its language or by all languages, whichever has the
   more prose-like median, so that neither copies nor a majority of junk can make junk the rule. A candidate is no prose
   if, checked exactly, more than half of its content is rows, code or junk and not sentences.

Defined results: null and empty texts have null statistics and are never flagged; repeated rows count once each in the
quantiles and percentiles; text of no language is judged by the sketch of all; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, CommonWords, class_counts, doubled
from .boilerplate import Chain, tag

BINS = 2048
SHRINK = 50  # documents that the sketch of all languages counts for beside that of a language
TAIL = 3.0  # robust z-scores of the sentence share
OUTLYING, OUTER = 2, 1.5  # other statistics of a candidate beyond so many robust z-scores, at least
LEAST_SPREAD = 0.02  # of shares, so that a language of equal values has no tail at rounding errors
_SLAB = 4000
ALL = "*"

#: Statistics in [0, 1] have linear bins, the others logarithmic ones.
SHARES = ("symbol_ratio", "digit_ratio", "lines_ended", "blocks_ended", "common_share", "distinct_share", "upper_ratio", "sentence_share", "junk_share")
SIZES = ("n_chars", "n_words", "mean_word", "longest_word", "n_lines", "mean_block")
STATS = SIZES + SHARES
_LOG = np.log(1.01)


def to_bin(name: str, x: np.ndarray) -> np.ndarray:
    if name in SHARES:
        return np.clip(np.round(x * 1000), 0, 1000).astype(np.int32)
    return np.clip(np.round(np.log(np.maximum(x, 0) + 1.0) / _LOG), 0, BINS - 1).astype(np.int32)


def from_bin(name: str, b: np.ndarray) -> np.ndarray:
    return np.asarray(b) / 1000.0 if name in SHARES else np.exp(np.asarray(b) * _LOG) - 1.0


class Sketch:
    """Counts over bins; ``merge`` adds them."""

    def __init__(self, name: str, counts: dict[int, int] | None = None):
        self.name, self.counts = name, dict(counts or {})

    def merge(self, other: Sketch) -> Sketch:
        out = dict(self.counts)
        for b, n in other.counts.items():
            out[b] = out.get(b, 0) + n
        return Sketch(self.name, out)

    @property
    def n(self) -> int:
        return sum(self.counts.values())

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        b = np.array(sorted(self.counts), dtype=np.int64)
        return b, np.cumsum([self.counts[k] for k in b.tolist()])

    def quantile(self, q: float) -> float:
        b, c = self.table()
        return float(from_bin(self.name, b[min(len(b) - 1, int(np.searchsorted(c, q * c[-1], side="left")))])) if len(b) else float("nan")

    def percentile(self, x: np.ndarray) -> np.ndarray:
        """Share of documents below, half of those in the same bin included."""
        b, c = self.table()
        if not len(b):
            return np.full(len(x), np.nan)
        at = to_bin(self.name, x)
        below = np.r_[0, c][np.searchsorted(b, at, side="left")]
        upto = np.r_[0, c][np.searchsorted(b, at, side="right")]
        return (below + upto) / 2.0 / c[-1]

    def spread(self) -> tuple[float, float]:
        """Median and scaled median absolute deviation."""
        b, _ = self.table()
        if not len(b):
            return float("nan"), float("nan")
        mid = self.quantile(0.5)
        off = np.abs(from_bin(self.name, b) - mid)
        order = np.argsort(off)
        c = np.cumsum([self.counts[k] for k in b[order].tolist()])
        return mid, 1.4826 * float(off[order][min(len(b) - 1, int(np.searchsorted(c, 0.5 * c[-1], side="left")))])


def text_key(c: Column) -> Column:
    """Hash of a text with addresses and numbers masked and blanks folded; copies of a template that vary in these share it."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(c.cast("string")), r"(?:https?://|www\.)\S+", "@"), r"[\d\s]+", " "))


def weight(n: Column) -> Column:
    """Of a text with n copies: 1 for each doubling, so that copies hardly tell in a sketch."""
    return F.lit(1) + F.floor(F.log2(n)).cast("bigint")


def _languages(b: Blocks, common: CommonWords) -> np.ndarray:
    """The language with the most common words in each page, or '' for none."""
    low = doubled(b.text)
    hits = np.zeros((len(common.languages), b.n_docs))
    for k, lang in enumerate(common.languages):
        import re

        words = "|".join(re.escape(w) for w in sorted(common.words[lang], key=len, reverse=True))
        n = pc.count_substring_regex(low, rf"(?:^|[^\p{{L}}])(?:{words})(?:[^\p{{L}}]|$)").to_numpy(zero_copy_only=False)
        hits[k] = b.sum_by_doc(n.astype(np.float64))
    best = hits.argmax(axis=0)
    return np.where(hits.max(axis=0) > 0, np.array(common.languages, dtype=object)[best], "")


def measure(pages: pa.Array, titles: pa.Array | None, chain: Chain, common: CommonWords) -> dict[str, np.ndarray]:
    """All statistics of a batch of pages, with the language and the non-prose share."""
    pages = pc.fill_null(pages.cast(pa.string()), "")
    b, state, s = tag(pages, titles, chain, common)
    n = b.n_docs
    chars = pc.utf8_length(pages).to_numpy(zero_copy_only=False).astype(np.float64)
    kinds = class_counts(pages)
    letters, digits, blanks, upper = b.sum_by_doc(s["letters"]), kinds["numbers"].astype(np.float64), kinds["blanks"].astype(np.float64), kinds["capitals"].astype(np.float64)
    words = b.sum_by_doc(s["words"])
    solid = np.maximum(1, chars - blanks)
    body = state == 0
    content = np.where(body, s["chars"], 0).astype(np.float64)
    # a short line without end, in letters and with a capital, may be a heading: neither sentence nor row
    heading = ~s["sentence"] & ~s["ended"] & s["upper"] & (s["words"] >= 2) & (s["words"] <= 12) & (s["lettered"] > 0.9) & ~s["code"] & (s["frequent"] >= 1)
    # headings head something: where they outnumber the sentences they are the rows of a list
    listed = b.sum_by_doc(heading & body) > 2 * b.sum_by_doc(s["sentence"] & body) + 1
    heading &= ~listed[b.doc]
    good = b.sum_by_doc(np.where(s["sentence"], content, 0))
    bad = b.sum_by_doc(np.where(s["sentence"] | heading, 0, content))
    n_blocks = np.bincount(b.doc, minlength=n)
    line_ends = np.r_[(b.doc[1:] != b.doc[:-1]) | (b.line[1:] != b.line[:-1]), True] if len(b) else np.zeros(0, bool)
    n_lines = b.sum_by_doc(line_ends)
    distinct = np.ones(n)
    longest = np.zeros(n)
    lists = pc.split_pattern_regex(pc.utf8_lower(pages), r"[^\p{L}\p{M}'’-]+")
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat):
        owner = np.repeat(np.arange(n), sizes)
        size = pc.utf8_length(flat).to_numpy(zero_copy_only=False)
        real = size > 0
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique(owner[real] * np.int64(1 << 32) + code[real])
        total = np.bincount(owner[real], minlength=n)
        distinct = np.bincount(pairs >> 32, minlength=n) / np.maximum(1, total)
        np.maximum.at(longest, owner, size)
    return {
        "n_chars": chars, "n_words": words, "mean_word": letters / np.maximum(1, words), "longest_word": longest, "n_lines": n_lines, "mean_block": b.sum_by_doc(s["chars"]) / np.maximum(1, n_blocks),
        "symbol_ratio": np.clip((solid - letters - digits) / solid, 0, 1), "digit_ratio": digits / solid, "lines_ended": b.sum_by_doc(line_ends & s["ended"]) / np.maximum(1, n_lines),
        "blocks_ended": b.sum_by_doc(s["ended"]) / np.maximum(1, n_blocks), "common_share": np.minimum(1, b.sum_by_doc(s["frequent"]) / np.maximum(1, words)), "distinct_share": distinct,
        "upper_ratio": np.minimum(1, upper / np.maximum(1, letters)), "sentence_share": good / np.maximum(1, good + bad), "junk_share": bad / np.maximum(1, good + bad),
        "lang": _languages(b, common), "content": good + bad,
    }


_FIELDS = "id bigint, key bigint, lang string, content double, " + ", ".join(f"{s} double" for s in STATS)


def statistics(df: DataFrame, tbl: str, id_col: str, text_col: str, title_col: str | None, chain: Chain, common: CommonWords) -> DataFrame:
    """One row per document with a text: ``tbl, id, key, lang, content`` and all statistics."""
    shared = df.sparkSession.sparkContext.broadcast((chain, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                m = measure(s.column(1), s.column(2), model, words)
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(3), pa.array(m["lang"], pa.string()), pa.array(m["content"]), *(pa.array(m[k].astype(np.float64)) for k in STATS)], names=["id", "key", "lang", "content", *STATS])

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(title_col) if title_col else F.lit(None)).cast("string").alias("title"), text_key(F.col(text_col)).alias("key")).where("text is not null and text <> ''")
    return src.mapInArrow(run, _FIELDS).select(F.lit(tbl).alias("tbl"), "*")


def distinct_texts(stats: DataFrame, names: tuple[str, ...] = STATS) -> DataFrame:
    """``(w, lang, *names)``: one row per distinct text (:func:`text_key`), which weighs by the doublings of its copies."""
    return stats.groupBy("key", "lang").agg(weight(F.count("*")).alias("w"), *(F.min(n).alias(n) for n in names)).drop("key")


def sketches(stats: DataFrame, names: tuple[str, ...] = STATS) -> DataFrame:
    """``(lang, stat, bin, n)``: tasks add up their own bins before the shuffle. Rows count by ``w`` where there is one."""
    fields = [F.col("lang"), *map(F.col, names), (F.col("w") if "w" in stats.columns else F.lit(1)).cast("bigint").alias("w")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], np.ndarray] = {}
        for b in batches:
            langs, w = b.column(0).to_numpy(zero_copy_only=False), b.column(len(names) + 1).to_numpy(zero_copy_only=False)
            for k, name in enumerate(names):
                at = to_bin(name, b.column(k + 1).to_numpy(zero_copy_only=False))
                for lang in {*langs.tolist(), ALL}:
                    own = slice(None) if lang == ALL else langs == lang
                    c = np.bincount(at[own], w[own], minlength=BINS).astype(np.int64)
                    total[lang, name] = total[lang, name] + c if (lang, name) in total else c
        rows = [(lang, name, int(i), int(c[i])) for (lang, name), c in total.items() for i in np.flatnonzero(c)]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())], names=["lang", "stat", "bin", "n"])

    return stats.select(*fields).mapInArrow(run, "lang string, stat string, bin int, n bigint").groupBy("lang", "stat", "bin").agg(F.sum("n").alias("n"))


def collect_sketches(bins: DataFrame) -> dict[tuple[str, str], Sketch]:
    """Sketches on the driver: languages x statistics x ``BINS`` rows at most."""
    out: dict[tuple[str, str], Sketch] = {}
    for r in bins.toArrow().to_pylist():
        out.setdefault((r["lang"], r["stat"]), Sketch(r["stat"])).counts[r["bin"]] = r["n"]
    return out


class Reference:
    """What a language's values are compared with: its own sketch, drawn towards that of all languages."""

    def __init__(self, sk: dict[tuple[str, str], Sketch], lang: str, name: str):
        self.name, self.whole = name, sk.get((ALL, name), Sketch(name))
        self.own = sk.get((lang, name), Sketch(name)) if lang and lang != ALL else Sketch(name)
        self.share = self.own.n / (self.own.n + SHRINK)

    def _drawn(self, own, whole):
        return self.share * own + (1 - self.share) * whole if self.own.n else whole

    def spread(self) -> tuple[float, float]:
        """Median and spread, the latter not below a least one."""
        (m, d), (m_all, d_all) = self.own.spread(), self.whole.spread()
        mid = self._drawn(m, m_all)
        return mid, max(self._drawn(d, d_all), LEAST_SPREAD if self.name in SHARES else 0.02 * max(1.0, mid))

    def percentile(self, x: np.ndarray) -> np.ndarray:
        return self._drawn(self.own.percentile(x), self.whole.percentile(x))


#: Statistics that do not judge sentences.
OTHERS = tuple(n for n in STATS if n not in ("sentence_share", "junk_share"))


def flag(stats: DataFrame, sk: dict[tuple[str, str], Sketch]) -> DataFrame:
    """Statistics with the robust z-scores of all of them, the number of other statistics in their tails, and ``non_prose``."""
    rows = []
    for lang in sorted({lang for lang, _ in sk} | {""}):
        refs = {n: Reference(sk, lang, n).spread() for n in STATS}
        whole = Reference(sk, "", "sentence_share").spread()
        refs["sentence_share"] = max(refs["sentence_share"], whole)  # a language of mostly junk is judged by all
        rows.append((lang, *(float(x) for n in STATS for x in refs[n])))
    spark = stats.sparkSession
    ref = spark.createDataFrame(rows, "_lang string, " + ", ".join(f"_mid_{n} double, _spread_{n} double" for n in STATS))
    joined = stats.join(F.broadcast(ref), F.col("lang") == F.col("_lang"), "left")  # one row per language
    z = {n: (F.col(n) - F.col(f"_mid_{n}")) / F.col(f"_spread_{n}") for n in STATS}
    scored = joined.select(*stats.columns, *(z[n].alias(f"z_{n}") for n in STATS))
    outlying = sum((F.abs(F.col(f"z_{n}")) > OUTER).cast("int") for n in OTHERS)
    candidate = (F.col("z_sentence_share") <= -TAIL) & (F.col("outlying") >= OUTLYING)
    return scored.withColumn("outlying", outlying).withColumn("non_prose", candidate & (F.col("junk_share") > 0.5) & (F.col("content") > 0))


def standing(stats: DataFrame, sk: dict[tuple[str, str], Sketch], names: tuple[str, ...] = STATS) -> DataFrame:
    """Every statistic as percentile and robust z-score within its language: ``(tbl, id, lang, stat, value, pct, z)``."""
    shared = stats.sparkSession.sparkContext.broadcast({k: v.counts for k, v in sk.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = {k: Sketch(k[1], v) for k, v in shared.value.items()}
        cache: dict[tuple[str, str], tuple[Reference, float, float]] = {}
        for b in batches:
            langs = b.column(2).to_numpy(zero_copy_only=False)
            for k, name in enumerate(names):
                x = b.column(k + 3).to_numpy(zero_copy_only=False)
                pct, z = np.zeros(len(x)), np.zeros(len(x))
                for lang in set(langs.tolist()):
                    if (lang, name) not in cache:
                        r = Reference(have, lang, name)
                        cache[lang, name] = (r, *r.spread())
                    r, mid, spread = cache[lang, name]
                    at = langs == lang
                    pct[at] = r.percentile(x[at])
                    z[at] = (x[at] - mid) / spread
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([name] * len(x)), pa.array(x), pa.array(pct), pa.array(z)], names=["tbl", "id", "lang", "stat", "value", "pct", "z"])

    return stats.select("tbl", "id", "lang", *names).mapInArrow(run, "tbl string, id bigint, lang string, stat string, value double, pct double, z double")
