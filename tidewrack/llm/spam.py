"""Problem 4: keyword-stuffed and link-list pages, by block-wise compression ratio normalised by length and language.

A page's text (addresses without scheme and host unless most of the page is addresses, hashtags and compound slugs taken
apart, lower case) is deflated in blocks of ``BLOCK`` characters; a short last block is joined to the one before. The ratio of
compressed to plain size falls with length and differs between languages, so each page is compared with the median and
median absolute deviation of *natural* pages of its language and length class: pages with the sentence ends of prose and
without a repeated keyword, whatever share of the corpus they are. Their mergeable sketches are of distinct texts (numbers
and addresses masked, so that copies of a template that vary in them are one text; a text of n copies weighs
1 + floor(log2(n))). They are made twice: the second time without the pages that the first references flag. Classes of
other lengths count less by ``DECAY`` a step, and a language's reference is drawn towards that of all languages as
``SHRINK`` pages would draw it, so that few pages of a language and length need no other rule than many.

Extreme redundancy is then confirmed: by a low density of sentence punctuation; where the text has sentences, by a word
that most of them repeat; or by a page of addresses. Between ``TAIL`` and ``FAR_TAIL`` a list must show one sign more: a
keyword, words of the title throughout the text, or more links than a page of its length has. Tables, parts lists and
code are redundant as well: their shares of number tokens and signs tell them apart. No page is flagged without redundancy.

One pass measures, one shuffles a row per distinct text and task and then sketch bins (languages x length classes x bins at
most), one joins them as a bounded lookup. Nothing grows with hosts or groups of copies.

Defined results: null and empty texts are measured as nothing and never flagged; null ``links`` and titles count as
none; repeated rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, CommonWords, readable
from .quality import ALL, Sketch, _languages, text_key, weight

BLOCK = 600  # characters
SHORT_BLOCK = 80  # a last block of fewer joins the one before
DECAY = 0.1  # weight of a length class against that of the class next to it
SHRINK = 50  # pages that the reference of all languages counts for in that of a language
TAIL, FAR_TAIL = 1.5, 3.0  # robust z-scores of the ratio
FLOOR = 0.03  # least spread
LOW_PUNCTUATION = 0.035  # sentence ends per token
MOST_NUMBERS = 0.2
LEAST_LETTERS = 0.65
KEYWORD_SHARE = 0.1
TITLE_SHARE = 0.15  # of a text's words, in its title
LINK_RATE = 0.25  # links per token
CODE_SIGNS = 0.03  # braces and equals signs per character
ADDRESS_SHARE = 0.6
_SLAB = 2000

_ADDRESS = re.compile(r"(?:https?://|www\.)\S+")
_HOST = re.compile(r"(?:https?://)?(?:www\.)?[\w.-]+\.[a-z]{2,}/?", re.I)
_CAMEL = re.compile(r"(?<=[a-zà-ÿа-я0-9])(?=[A-ZÀ-ÞА-Я])")
_GLUE = re.compile(r"[#\-_/]+")
_END = re.compile(r"[.!?…](?=[\"”»’)]*(?:\s|$))")
_COUNT = re.compile(r"\(\d+\)")
_WORD = re.compile(r"[^\W\d_]+")


def plain_words(text: str, whole: bool = False) -> str:
    """The text that is deflated; ``whole`` leaves addresses whole."""
    short = text if whole else _ADDRESS.sub(lambda m: _HOST.sub(" ", m.group(), count=1), text)
    return _GLUE.sub(" ", _CAMEL.sub(" ", short)).lower()


def block_ratio(text: str, whole: bool = False) -> tuple[float, int]:
    """Compressed over plain size, summed over blocks, and the plain size. All characters are in a block.

    Every character is one byte (beyond ASCII its code modulo 128), so that scripts of two bytes a letter compare.
    """
    codes = np.frombuffer(plain_words(text, whole).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    raw = np.where(codes < 128, codes, 128 | codes & 127).astype(np.uint8).tobytes()
    cuts = [*range(0, len(raw), BLOCK), len(raw)]
    if len(cuts) > 2 and cuts[-1] - cuts[-2] < SHORT_BLOCK:
        del cuts[-2]
    packed = 0
    for lo, hi in zip(cuts, cuts[1:]):
        z = zlib.compressobj(9, zlib.DEFLATED, -15)
        packed += len(z.compress(raw[lo:hi])) + len(z.flush())
    return (packed / len(raw) if raw else 1.0), len(raw)


def measure(texts: list[str | None], titles: list[str | None], common: set[str]) -> dict[str, np.ndarray]:
    """Redundancy and confirming figures of pages."""
    rows = []
    for t, title in zip(texts, titles):
        t = t or ""
        if "&" in t:
            t = html.unescape(t)
        t = readable(t)  # garbled text is judged by what it says
        tokens = t.split()
        solid = sum(map(len, tokens))
        address = sum(len(m) for m in _ADDRESS.findall(t)) / max(1, solid)
        ratio, size = block_ratio(t, address >= ADDRESS_SHARE)
        bare = [x for x in (_COUNT.sub(" ", _ADDRESS.sub(" ", t)).split() if address or "(" in t else tokens) if x[0].isalpha() or any(map(str.isalnum, x))]
        numbers = sum(not (x[0].isalpha() or any(map(str.isalpha, x))) for x in bare) / max(1, len(bare))
        every = _WORD.findall(t.lower())
        letters = sum(map(len, every)) / max(1, solid)
        sentences = [s for s in re.split(r"(?<=[.!?…])\s+|\n+", t) if s.strip()]
        words = [w for w in every if len(w) > 3 and w not in common]
        times = Counter(words)
        top, most = times.most_common(1)[0] if words else ("", 0)
        with_top = sum(top in s.lower() for s in sentences) if top else 0
        told = sum(times[w] for w in set(_WORD.findall((title or "").lower()))) / max(1, len(words))
        rows.append((ratio, size, len(_END.findall(t)) / max(1, len(tokens)), numbers, address, letters, most / max(1, len(tokens)), with_top / max(1, len(sentences)), most, len(sentences), sum(map(t.count, "{}=")) / max(1, solid), told, len(tokens)))
    return dict(zip(MEASURED, np.array(rows, dtype=np.float64).reshape(len(texts), len(MEASURED)).T))


MEASURED = ("ratio", "size", "ends", "numbers", "address", "letters", "keyword", "in_sentences", "times", "sentences", "code_signs", "titled", "tokens")


def measured(df: DataFrame, id_col: str, text_col: str, title_col: str | None, links_col: str | None, common: CommonWords) -> DataFrame:
    """One row per page with a text: id, key of like texts, language, length class, figures, number of links."""
    shared = df.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        frequent = {w for v in words.words.values() for w in v}
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                m = measure(s.column(1).to_pylist(), s.column(4).to_pylist(), frequent)
                lang = _languages(Blocks(s.column(1), html=False), words)
                cls = np.floor(np.log2(np.maximum(m["size"], 1)) * 2).astype(np.int32)
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(2), s.column(3), pa.array(lang, pa.string()), pa.array(cls), *(pa.array(m[k]) for k in MEASURED)], names=["id", "n_links", "key", "lang", "cls", *MEASURED])

    links = F.coalesce(F.size(F.col(links_col)), F.lit(0)) if links_col else F.lit(0)
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), F.greatest(links, F.lit(0)).alias("n_links"), text_key(F.col(text_col)).alias("key"), (F.col(title_col) if title_col else F.lit(None)).cast("string").alias("title")).where("text is not null and trim(text) <> ''")
    return src.mapInArrow(run, "id bigint, n_links int, key bigint, lang string, cls int, " + ", ".join(f"{k} double" for k in MEASURED))


def ratio_bins(pages: DataFrame) -> DataFrame:
    """``(lang, cls, bin, n)`` of compression ratios of natural pages, weights of distinct texts; one counts for its language and for all."""
    bin_ = F.least(F.lit(1000), F.round(F.col("ratio") * 1000)).cast("int").alias("bin")
    natural = pages.where((F.col("ends") >= LOW_PUNCTUATION) & (F.col("keyword") < KEYWORD_SHARE) & (F.col("address") < ADDRESS_SHARE))
    # one number a page, so that a key's least one is kept in a hash table without sorting
    coded = natural.select("key", "lang", (F.col("cls").cast("bigint") * 1001 + bin_).alias("coded"))
    texts = coded.groupBy("key", "lang").agg(F.min("coded").alias("coded"), weight(F.count("*")).alias("w"))
    bins = texts.select(F.explode(F.array("lang", F.lit(ALL))).alias("lang"), F.floor(F.col("coded") / 1001).cast("int").alias("cls"), (F.col("coded") % 1001).cast("int").alias("bin"), "w")
    return bins.groupBy("lang", "cls", "bin").agg(F.sum("w").alias("n"))


def references(bins: DataFrame, classes: range = range(0, 64)) -> list[tuple[str, int, float, float]]:
    """``(lang, cls, median, spread)`` for every length class of every language and of all languages together.

    A class takes the bins of other classes by ``DECAY`` to the power of their distance. A language is drawn towards all
    languages by ``SHRINK`` pages. ``classes`` covers lengths up to 2**32.
    """
    sk: dict[str, dict[int, Sketch]] = {}
    for r in bins.toArrow().to_pylist():
        sk.setdefault(r["lang"], {}).setdefault(r["cls"], Sketch("common_share")).counts[r["bin"]] = r["n"]

    def near(lang: str, cls: int) -> tuple[float, float, float]:
        counts: dict[int, float] = {}
        for other, s in sk[lang].items():
            share = DECAY ** abs(other - cls)
            for b, n in s.counts.items():
                counts[b] = counts.get(b, 0.0) + share * n
        s = Sketch("common_share", counts)
        return (s.n, *s.spread())

    out = []
    for cls in classes if ALL in sk else ():
        _, mid_all, spread_all = near(ALL, cls)
        for lang in sorted(filter(None, sk)):  # text of no language is judged by that of all
            n, mid, spread = near(lang, cls)
            own = 1.0 if lang == ALL else n / (n + SHRINK)
            out.append((lang, cls, own * mid + (1 - own) * mid_all, own * spread + (1 - own) * spread_all))
    return out


def flag(pages: DataFrame, refs: list[tuple[str, int, float, float]]) -> DataFrame:
    """Pages with robust z-score of the ratio, the confirming test that held, and ``spam``; without any reference none is."""
    spark = pages.sparkSession
    table = spark.createDataFrame(refs, "lang string, cls int, mid double, spread double")
    own = table.where(F.col("lang") != ALL)
    whole = table.where(F.col("lang") == ALL).select("cls", F.col("mid").alias("mid_all"), F.col("spread").alias("spread_all"))
    # at most languages x length classes rows: a bounded lookup
    joined = pages.join(F.broadcast(own), ["lang", "cls"], "left").join(F.broadcast(whole), "cls", "left")
    z = (F.col("ratio") - F.coalesce("mid", "mid_all")) / F.greatest(F.coalesce("spread", "spread_all"), F.lit(FLOOR))
    redundant, extreme = F.col("z") <= -TAIL, F.col("z") <= -FAR_TAIL
    prose_like = (F.col("numbers") < MOST_NUMBERS) & (F.col("letters") >= LEAST_LETTERS) & (F.col("code_signs") < CODE_SIGNS)
    sign = (F.col("keyword") >= KEYWORD_SHARE) | (F.col("titled") >= TITLE_SHARE) | (F.col("n_links") >= LINK_RATE * F.col("tokens"))
    listed = redundant & prose_like & (F.col("ends") < LOW_PUNCTUATION) & (extreme | sign)
    stuffed = redundant & prose_like & (F.col("keyword") >= KEYWORD_SHARE) & (F.col("in_sentences") >= 0.6) & (F.col("times") >= 4) & (F.col("sentences") >= 2)
    addresses = redundant & (F.col("address") >= ADDRESS_SHARE)
    why = F.when(addresses, "addresses").when(listed, "no sentences").when(stuffed, "keyword sentences")
    return joined.withColumn("z", z).withColumn("why", why).withColumn("spam", F.col("why").isNotNull()).drop("mid", "spread", "mid_all", "spread_all")


def judge(pages: DataFrame) -> DataFrame:
    """:func:`flag` by references that are made again without the pages flagged at first."""
    first = flag(pages, references(ratio_bins(pages)))
    return flag(pages, references(ratio_bins(first.where(~F.col("spam"))))).drop("key")
