"""Positions of the fingerprints."""

from marketvane.llm import winnowing
from tests.llm.test_operators import SCHEMA, corpus


def test_positions_of_fingerprints(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    want = {r[0]: winnowing.winnow(winnowing.code_points(r[1] or "")) for r in corpus()}
    for r in winnowing.fingerprints(docs).collect():
        assert (r["hashes"], r["positions"]) == tuple(x.tolist() for x in want[r["doc_id"]])
    texts = [r[1] or "" for r in corpus()]
    for k, r in enumerate(sorted(winnowing.compare_with_next(docs).collect())):
        other = winnowing.edited(texts[k], texts[(k + 1) % len(texts)])
        assert r["positions"] == want[k][1].tolist()
        assert r["edited_positions"] == winnowing.winnow(winnowing.code_points(other))[1].tolist()
