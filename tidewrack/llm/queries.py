"""Queries of the training-data problems, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.session import cut, table

from . import boilerplate, langid, mojibake, packing, pii, quality, residue, spam, tokenize, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, d, "documents"))


@query
def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_corpus(table(spark, d, "documents"))


@query
def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and the share of room left over."""
    per = packing.container_report(packing.pack_corpus(table(spark, d, "documents")))
    return per.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.round(F.sum("unused") / (F.count("*") * packing.CAPACITY), 6).alias("unused_share"))


def _p1_fields(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.fields_of([("documents", table(spark, d, "documents"), "doc_id", ["text", "title"]), ("crawled_docs", table(spark, d, "crawled_docs"), "crawl_id", ["text"])])


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.repair(_p1_fields(spark, d)).select("tbl", "id", "field").distinct()


@query
def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    """Affected fields with their restored text; ``lost`` places could not be restored."""
    return mojibake.repair(_p1_fields(spark, d))


def _chain(spark: SparkSession, d: str):
    return boilerplate.load(table(spark, d, "lang_samples"), table(spark, d, "common_words"))


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    model = _chain(spark, d)
    raw = boilerplate.furniture_lines(table(spark, d, "raw_docs"), "raw_docs", "rec_id", "c", "t", *model)
    return raw.unionByName(boilerplate.furniture_lines(table(spark, d, "crawled_docs"), "crawled_docs", "crawl_id", "text", "t", *model)).distinct()


@query
def p3_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The main body of every page."""
    model = _chain(spark, d)
    raw = boilerplate.main_bodies(table(spark, d, "raw_docs"), "raw_docs", "rec_id", "c", "t", *model)
    return raw.unionByName(boilerplate.main_bodies(table(spark, d, "crawled_docs"), "crawled_docs", "crawl_id", "text", "t", *model))


@query
def p3_html_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The main body of HTML pages: every document in an article element, amid boxes whose words are on no list of phrases."""
    text = F.regexp_replace(F.regexp_replace(F.col("text"), "&", "&amp;"), "<", "&lt;")
    title = F.regexp_replace(F.regexp_replace(F.coalesce("title", F.lit("")), "&", "&amp;"), "<", "&lt;")
    page = F.concat(
        F.lit("<html><head><title>"), title, F.lit("</title><script>var a = 1;</script></head><body><header><a>Overview</a><a>Departments</a></header><nav><ul><li><a>Our harbour</a></li><li><a>Timetables</a></li></ul></nav><article><h1>"),
        title, F.lit("</h1><p>"), F.regexp_replace(text, r"[\r\n]+", "</p><p>"), F.lit("</p></article><aside><h2>Elsewhere</h2><a>Boats and people</a></aside><footer><p>Harbour office, quay 3</p></footer></body></html>"),
    )
    pages = table(spark, d, "documents").where("text is not null").select("doc_id", page.alias("page"), "title")
    return boilerplate.main_bodies(pages, "documents", "doc_id", "page", "title", *_chain(spark, d))


def _p5_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of all pages, written once to the shared checkpoint folder as two passes read them."""
    model = _chain(spark, d)
    raw = quality.statistics(table(spark, d, "raw_docs"), "raw_docs", "rec_id", "c", "t", *model)
    return cut(raw.unionByName(quality.statistics(table(spark, d, "crawled_docs"), "crawled_docs", "crawl_id", "text", "t", *model)))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    stats = _p5_statistics(spark, d)
    sk = quality.collect_sketches(quality.sketches(quality.distinct_texts(stats)))
    return quality.flag(stats, sk).where("non_prose").select("tbl", "id").distinct()


@query
def p5_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Every statistic of every document with its percentile and robust z-score within its language."""
    stats = _p5_statistics(spark, d)
    return quality.standing(stats, quality.collect_sketches(quality.sketches(stats)))


@query
def p5_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of each statistic per language, from the merged sketches."""
    sk = quality.collect_sketches(quality.sketches(_p5_statistics(spark, d)))
    rows = [(lang, stat, s.n, *(s.quantile(q) for q in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99))) for (lang, stat), s in sorted(sk.items())]
    return spark.createDataFrame(rows, "lang string, stat string, n bigint, p01 double, p05 double, p25 double, p50 double, p75 double, p95 double, p99 double")


def _p7_identified(spark: SparkSession, d: str, texts: bool = True) -> DataFrame:
    model = langid.load(table(spark, d, "lang_samples"))
    return langid.identify(table(spark, d, "raw_docs"), "rec_id", "c", "t", "l", model, *_chain(spark, d), texts=texts)


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.mislabelled(_p7_identified(spark, d, texts=False)).select(F.col("id").alias("rec_id"), "lang").distinct()


@query
def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every document's passages: language, confidence and text of each."""
    each = _p7_identified(spark, d).select(F.col("id").alias("rec_id"), "label", F.col("lang").alias("doc_lang"), F.col("confidence").alias("doc_confidence"), F.posexplode_outer("passages").alias("passage_no", "p"))
    return each.select("rec_id", "label", "doc_lang", "doc_confidence", "passage_no", F.col("p.lang").alias("lang"), F.col("p.confidence").alias("confidence"), F.col("p.text").alias("text"))


def _p4_flagged(spark: SparkSession, d: str) -> DataFrame:
    common = boilerplate.word_lists(table(spark, d, "common_words"))
    return spam.judge(cut(spam.measured(table(spark, d, "crawled_docs"), "crawl_id", "text", "t", "links", common)))


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _p4_flagged(spark, d).where("spam").select(F.col("id").alias("crawl_id")).distinct()


@query
def p4_scores(spark: SparkSession, d: str) -> DataFrame:
    """Redundancy and confirming figures of every page."""
    return _p4_flagged(spark, d)


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.classify(residue.fields_of(table(spark, d, "documents"))).select(F.col("id").alias("doc_id"), "field").distinct()


@query
def p6_messages(spark: SparkSession, d: str) -> DataFrame:
    """Recurring messages and slots over sources, in normal form."""
    return residue.messages(residue.fields_of(table(spark, d, "documents")))


@query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_details(table(spark, d, "documents")).select("doc_id", "kind", "surface").distinct()


@query
def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text with typed placeholders."""
    return pii.replace_details(table(spark, d, "documents"))


@query
def p10_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """Every text with keyed surrogates; a deployment passes its own secret key."""
    return pii.replace_details(table(spark, d, "documents"), key=b"public demonstration key")


def _p2_scores(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "raw_docs")
    model = toxicity.train(toxicity.labelled(records, table(spark, d, "toxicity_labels"), "rec_id"))
    return toxicity.score(records, model)


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _p2_scores(spark, d).where(F.col("score") >= toxicity.THRESHOLD).select("rec_id").distinct()


@query
def p2_scores(spark: SparkSession, d: str) -> DataFrame:
    """The score of every record."""
    return _p2_scores(spark, d)


@query
def p2_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates of such records per source and per host."""
    return toxicity.rates(_p2_scores(spark, d))
