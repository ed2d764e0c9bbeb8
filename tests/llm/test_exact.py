import duckdb

from churnlab.llm.exact import exact_decisions, exact_kept
from churnlab.llm.oracle import EXACT_DEDUP


def test_decisions_on_odd_rows_match_sql(odd_docs):
    documents = odd_docs.select("doc_id", "text").toPandas()  # noqa: F841  (read by DuckDB)
    expected = duckdb.sql(EXACT_DEDUP.replace("doc_id, keep_id,", "doc_id AS id, keep_id,")).fetchall()
    found = [tuple(r) for r in exact_decisions(odd_docs).collect()]
    order = lambda rows: sorted((tuple(None if x != x else x for x in r) for r in rows), key=str)
    assert order(found) == order(expected)


def test_kept_rows_keep_columns_and_drop_repeats(odd_docs):
    kept = exact_kept(odd_docs)
    assert kept.columns == odd_docs.columns
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()))
    # 2 has the longest form of the prose; 6 is the longest empty text; one row of each id stays.
    assert found == [2, 3, 6, 7, 8, 9, 11, 11, 12]


def test_repeats_of_the_kept_row_are_one(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (3, "c"), (3, "c")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in exact_kept(docs).collect()) == [(1, "a b"), (3, "c")]
    assert sorted((r["id"], r["kept"]) for r in exact_decisions(docs).collect()) == [(1, False), (1, True), (2, False), (3, False), (3, True)]


def test_texts_that_agree_in_length_and_prefix_stay_apart(spark):
    docs = spark.createDataFrame([(i, "p" * 300 + str(i % 4)) for i in range(8)], "doc_id long, text string")
    found = {r["id"]: (r["keep_id"], r["group_size"]) for r in exact_decisions(docs).collect()}
    assert found == {i: (i % 4, 2) for i in range(8)}


def test_no_rows(no_docs):
    assert exact_decisions(no_docs).count() == 0
    assert exact_kept(no_docs).count() == 0
