"""Near copies where ids repeat."""

import corpus_pipeline
from tests.llm.test_operators import SCHEMA, some_text


def row(id_, text):
    return (id_, text, "en", "s1", len(text), 1, "clash", 0)


def test_near_copies_of_one_id_leave_one_document(spark):
    base = some_text(200, 10**6)
    docs = spark.createDataFrame([row(5, base + " a"), row(5, base + " b"), row(7, base + " c"), row(8, "other words here"), row(8, base + " d")], SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(k for k, _ in kept) == [5, 8] and (8, "other words here") in kept
