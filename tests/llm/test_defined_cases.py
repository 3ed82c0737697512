"""Every operator, writer and stage on a table whose further columns have the names that the operators use inside."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketvane.llm import (
    bpe, decontamination, fill_in_middle, language_model, mixing, ngram_join, quality_rules, sharding, spelling, suffix_dedup, token_counts, toxicity, winnowing,
)
from marketvane.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary
from tests.llm.test_operators import corpus

CLASHES = (
    "toxic label_id shard _row _document document id tag key given row stays size words word n form block items spans text_ draws output "
    "part guest before line failed node bands number bucket left right score ids decoded hash position"
).split()


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(r[0], r[1], r[3], r[4]) for r in corpus()]
    rows += [(None, rows[8][1], None, 5), (2, "another text " * 30, "s0", 3), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    clashed = docs.withColumns({name: F.lit("clash") for name in CLASHES}).repartition(3).cache()
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(10)], "doc_id long, toxic int, label_id int")
    bench = spark.createDataFrame([(1, "one two three", 1), (None, None, 1)], "item_id long, text string, name int")
    return docs.cache(), clashed, labels, bench


def taken(mixed):
    return mixed.taken()


OPERATORS = {
    "op1": lambda d, t: ngram_join.near_duplicates(d),
    "op2": lambda d, t: taken(mixing.mix_sources(d)),
    "op3": lambda d, t: language_model.train_and_score(d),
    "op4": lambda d, t: sharding.assign_shards(d, limit=3000),
    "op5": lambda d, t: winnowing.compare_with_next(d),
    "op5 all": lambda d, t: winnowing.fingerprints(d),
    "op6": lambda d, t: suffix_dedup.remove_repeats(d).select("row.doc_id", "kept", "spans"),
    "op7": lambda d, t: toxicity.score(d, toxicity.train(d, t[2])),
    "op8": lambda d, t: bpe.encode_decode(d, vocabulary(WORD_VOCABULARY)),
    "op9": lambda d, t: quality_rules.ledger(d),
    "op10": lambda d, t: token_counts.count_tokens(d, vocabulary(BYTE_VOCABULARY)),
    "op11": lambda d, t: fill_in_middle.restore(fill_in_middle.transform(d)),
    "op12": lambda d, t: decontamination.search(decontamination.index(d), t[3]),
    "op13": lambda d, t: spelling.variants(spelling.word_counts(d)),
}


def sorted_rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_further_columns_change_nothing(tables, name):
    docs, clashed = tables[:2]
    want = sorted_rows(OPERATORS[name](docs, tables))
    assert sorted_rows(OPERATORS[name](clashed, tables)) == want
    assert OPERATORS[name](clashed.limit(0), tables).count() == 0


def test_stages_keep_further_columns(spark, tables):
    docs, clashed = tables[:2]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want, got = stage(spark, docs, ""), stage(spark, clashed, "")
        assert got.columns == clashed.columns, name
        assert sorted_rows(got.select(*docs.columns)) == sorted_rows(want), name
        assert got.where(" OR ".join(f"`{c}` <> 'clash'" for c in CLASHES)).count() == 0
        assert stage(spark, clashed.limit(0), "").count() == 0


def test_written_shards_keep_further_columns(spark, tables, tmp_path):
    clashed = tables[1]
    name = sharding.write_shards(clashed, f"{tmp_path}/shards", limit=3000)
    assert name == "shard_"
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted_rows(back.select(*clashed.columns)) == sorted_rows(clashed)


def test_texts_of_every_unicode_version(spark):
    """Ids and digests through the registered query's own path equal the library's."""
    from hashlib import sha256

    from tokenizers import Tokenizer

    from marketvane.llm.queries import digests

    rng = random.Random(4)
    points = [k for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    texts = [f"a{''.join(map(chr, points[k : k + 1]))}b" for k in range(0, len(points), 7)]
    texts += [chr(k) for k in (0x558, 0x88F, 0xC5C, 0x1C89, 0xA7CB, 0x10D50, 0x187F8, 0x18E00)] + ["a՘b", "x\U00010d50y ́é", "İIı ſ Σς", None, ""]
    texts += ["".join(chr(rng.choice(points[: rng.choice((128, 600, 0x3000, 0x20000))])) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    library = Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    coded = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: tuple(r)[1:] for r in digests(bpe.encode_decode(frame, vocabulary(WORD_VOCABULARY))).collect()}
    for k, own in enumerate(coded):
        decoded = library.decode(own.ids, skip_special_tokens=False)
        assert got[k] == (len(own.ids), sha256(" ".join(map(str, own.ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest())
    settled = bpe.Bpe(vocabulary(WORD_VOCABULARY))
    assert all(settled.encode(t) == own.ids for t, own in zip((t or "" for t in texts), coded))


def test_memory_of_pairs_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 5)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small, plain = bpe.Bpe(vocabulary(WORD_VOCABULARY)), bpe.load(vocabulary(WORD_VOCABULARY))[0]
    text = "some ordinary words, unusually extraordinary ones among them"
    assert small.encode(text) == plain.encode(text) and len(small._fits) <= 5


def test_token_counts_through_the_query(spark, tmp_path):
    from tokenizers import Tokenizer

    from marketvane.llm.queries import QUERIES

    texts = {r[0]: r[1] for r in corpus()}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_token_counts"](spark, str(tmp_path)).collect()}
    for k, text in texts.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[k] == (len((text or "").encode()), n, n > 512)
