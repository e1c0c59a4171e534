import pytest

from tidewrack.llm.queries import QUERIES, SQL

SMALL = {"p1_found": {"tbl": "string", "id": "bigint", "field": "string"}, "p2_found": {"rec_id": "bigint"}, "p3_found": {"tbl": "string", "id": "bigint", "line_no": "int"}, "p4_found": {"crawl_id": "bigint"}, "p5_found": {"tbl": "string", "id": "bigint"}, "p6_found": {"doc_id": "bigint", "field": "string"}, "p7_found": {"rec_id": "bigint", "lang": "string"}, "p8_ids": {"doc_id": "bigint", "ids": "array<int>"}, "p10_found": {"doc_id": "bigint", "kind": "string", "surface": "string"}}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    if name in SMALL:
        assert dict(df.dtypes) == SMALL[name]
    rows = df.collect()
    assert rows or name == "p6_messages"  # few messages recur in so small a table
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)


def test_every_problem_has_queries():
    assert {int(n.split("_")[0][1:]) for n in QUERIES} == set(range(1, 11)) and set(SQL) <= set(QUERIES)


def test_ids_of_null_and_empty_texts(spark, small):
    from pyspark.sql import functions as F

    ids = QUERIES["p8_ids"](spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert ids.count() == docs.count()
    none = docs.where("text is null or text = ''").select("doc_id")
    assert ids.join(none, "doc_id").where(F.size("ids") > 0).count() == 0 and ids.where("ids is null").count() == 0
