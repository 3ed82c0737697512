"""Cores that are too large for one suffix array."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketvane.llm import suffix_dedup
from tests.llm.test_operators import brute_repeats, corpus, some_text


def rows():
    """A passage that many documents have in different surroundings, besides the corpus."""
    rng = np.random.default_rng(4)
    passage = some_text(20, 10**6, rng)[: suffix_dedup.LENGTH + 5]
    around = [(100 + k, f"{some_text(30, 10**6, rng)} {passage if k % 2 else passage[:80]} {some_text(30, 10**6, rng)}") for k in range(60)]
    return [*((r[0], r[1]) for r in corpus()), *around]


@pytest.mark.parametrize("limit", [0, 2000])
def test_large_cores_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", limit)
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(4)
    got = {r["row"]["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == brute_repeats(rows())


def test_a_null_id_comes_first_among_windows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 0)
    text = {r[0]: r[1] for r in corpus()}
    given = [(8, "a " + text[8]), (None, "b " + text[8]), (9, text[9])]
    got = {r["row"]["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert got == brute_repeats(sorted(given, key=lambda r: -1 if r[0] is None else r[0]))


def test_no_core_of_an_array_is_above_the_limit(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 2000)
    blocks = spark.createDataFrame([(k % 3, bytes(100 + k)) for k in range(3, 60) if k % 3 or k < 10], "core long, text binary")
    small, large = suffix_dedup._by_size(blocks)
    sizes = {r["core"]: r["n"] for r in small.groupBy("core").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert sizes and max(sizes.values()) <= 2000 and large.select("core").distinct().count() == 2
