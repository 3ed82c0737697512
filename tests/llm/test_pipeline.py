"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
import pytest

from tests.llm.test_operators import SCHEMA, corpus, words


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, "")
        docs = spark.createDataFrame(result.collect(), result.schema)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "BPE":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert not {4, 5, 6, 7, 10, 13, 14, 15, 17} & set(kept["quality rules"])
    assert {0, 8, 12} <= set(kept["n-gram Jaccard join"]) and not {1, 2} & set(kept["n-gram Jaccard join"])
    assert set(kept["suffix-array dedup"]) == set(kept["n-gram Jaccard join"])
    assert len(kept["suffix-array dedup"][9]["text"]) < len(kept["n-gram Jaccard join"][9]["text"])
    mixed = kept["mixing sources"]
    assert all(len(words(r["text"])) <= 2 * len(words(kept["suffix-array dedup"][k]["text"])) for k, r in mixed.items())
    assert set(kept["BPE"]) == set(mixed)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, name):
    empty = spark.createDataFrame([], SCHEMA)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, "").count() == 0
