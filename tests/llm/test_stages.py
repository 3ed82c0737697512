"""The pipeline's stages and its whole run against plain Python."""

import hashlib

import corpus_pipeline
from marketvane.llm.queries import WORD_VOCABULARY, vocabulary
from tests.llm.test_operators import SCHEMA, brute_repeats, corpus, shingle_sets, some_text, words


def plain_quality(text):
    w, text = words(text), text or ""
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    repeated = len({j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)})
    lines = [x for x in text.split("\n") if words(x)]
    letters = sum(map(len, w))
    return not (
        len(w) < 50 or 2 * repeated > len(w) or 10 * sum(text.count(c) for c in "#*$%&|<>") > len(w)
        or 2 * (len(lines) - len(set(lines))) > len(lines) or not 2 * len(w) <= letters <= 25 * len(w)
    )


def plain_near(texts):
    """Of each group that links of likeness 0.8 connect, the least id."""
    sets, root = shingle_sets(), {k: k for k in texts}

    def find(k):
        return k if root[k] == k else find(root[k])

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                first, second = sorted((find(a), find(b)))
                root[second] = first
    return {k: t for k, t in texts.items() if find(k) == k}


def test_stages_and_run_equal_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [r for r in corpus() if r[0] != 12] + [(12, some_text(900, 5000), *corpus()[12][2:])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = {r[0]: r[1] for r in rows if plain_quality(r[1])}
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.quality(spark, docs, "").collect()} == good
    near = plain_near(good)
    assert near != good
    held = corpus_pipeline.near_duplicates(spark, docs.where(docs["doc_id"].isin(list(good))), "")
    assert {r["doc_id"]: r["text"] for r in held.collect()} == near
    left = {k: t.decode("utf-8", "ignore") for k, t in brute_repeats(sorted(near.items())).items()}
    cut = corpus_pipeline.repeated_passages(spark, held, "")
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == left and left != near
    mixed = {r["doc_id"]: r["text"] for r in corpus_pipeline.mix(spark, cut, "").collect()}
    library = Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    want = {}
    for k, text in mixed.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want[k] = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want
