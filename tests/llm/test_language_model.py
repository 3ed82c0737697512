"""The language model's scores against plain dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketvane.llm import elias_fano, language_model
from tests.llm.test_operators import corpus, some_text, words


def plain_scores(rows):
    """Interpolated absolute discounting over all n-grams that occur twice, by dictionaries."""
    least, discount = 2, 0.75
    texts = [(k, [None, *(w.translate({c: c + 32 for c in range(65, 91)}) for w in words(t)), ""]) for k, t in rows]
    learned = [t for k, t in texts if zlib.crc32(("" if k is None else str(k)).encode()) % 7 != 2]
    n = [Counter(tuple(t[i : i + size]) for t in learned for i in range(len(t) - size + 1)) for size in (1, 2, 3)]
    kept = [n[0], *({g: c for g, c in level.items() if c >= least} for level in n[1:])]
    starts = n[0].get((None,), 0)
    tokens, distinct = sum(n[0].values()) - starts, len(n[0]) - (starts > 0)
    weight = [{}, {}]
    for level in (1, 2):
        for g, c in kept[level].items():
            weight[level - 1][g[:-1]] = weight[level - 1].get(g[:-1], 1) - (c - discount) / n[level - 1][g[:-1]]

    def p(gram):
        if len(gram) == 1:
            return (n[0].get(gram, 0) + 1) / (tokens + distinct + 1)
        level = len(gram) - 1
        lower = weight[level - 1].get(gram[:-1], 1) * p(gram[1:])
        return lower + ((kept[level][gram] - discount) / n[level - 1][gram[:-1]] if gram in kept[level] else 0)

    return Counter((k, round(sum(math.log10(p(tuple(t[max(0, i - 2) : i + 1]))) for i in range(1, len(t))), 6)) for k, t in texts)


def scores(spark, rows, schema="doc_id long, text string"):
    return Counter((r["doc_id"], round(r["score"], 6)) for r in language_model.train_and_score(spark.createDataFrame(rows, schema)).collect())


@pytest.mark.parametrize("part,block", [(language_model.PART_BYTES, language_model.BLOCK_TOKENS), (1 << 12, 1000), (1 << 14, 300)])
def test_scores_equal_plain_dictionaries(spark, monkeypatch, part, block):
    monkeypatch.setattr(language_model, "PART_BYTES", part)
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", block)
    rows = [*((r[0], r[1]) for r in corpus()), (2, "another text " * 20), (0, corpus()[0][1]), (None, "w1 w2 w3 w1 w2 w3 w4")]
    assert scores(spark, rows) == plain_scores(rows)


def test_a_phrase_stays_in_a_large_corpus(spark):
    rng = np.random.default_rng(8)
    phrase = "a phrase of seldom words that stands twice"
    rows = [(k, f"{some_text(2000, 500, rng)} {phrase if k in (3, 4) else ''}") for k in range(100)] + [(1000, phrase)]
    got, want = dict(scores(spark, rows)), dict(plain_scores(rows))
    assert {k for k, _ in got} == {k for k, _ in want}
    by, plain = dict(got.keys()), dict(want.keys())
    assert all(math.isclose(by[k], plain[k], rel_tol=1e-4) for k in plain)
    assert by[1000] > -12


def test_no_training_documents(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    assert scores(spark, [(held, "one two")]) == Counter({(held, 0.0): 1})


def test_repeated_rows_are_dealt_to_slices(spark, monkeypatch):
    monkeypatch.setattr(language_model, "PART_BYTES", 1 << 10)
    rows = [(1, "again and again the same row")] * 200
    found = language_model.slices(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert found.count() >= 5 and found.agg({"ids": "count"}).first()[0] == found.count()
    assert scores(spark, rows) == plain_scores(rows)


def test_successor_equals_a_search():
    rng = np.random.default_rng(3)
    for size, top in ((0, 5), (1, 1), (7, 3), (900, 40), (900, 10**6), (5000, 2**60), (500, 2**64 - 1)):
        values = np.sort(rng.integers(0, top, size, dtype=np.uint64, endpoint=True))
        own = elias_fano.EliasFano.of(values)
        asked = np.concatenate([values, rng.integers(0, top, 2000, dtype=np.uint64, endpoint=True)])
        start = rng.integers(0, size + 1, len(asked))
        end = np.maximum(start, rng.integers(0, size + 1, len(asked)))
        at, known = own.successor(asked, start, end)
        want = np.clip(np.searchsorted(values, asked), start, end)
        assert (at == want).all()
        assert known.tolist() == [w < e and values[w] == a for w, e, a in zip(want.tolist(), end.tolist(), asked.tolist())]


def test_a_mapped_block_answers_as_a_dictionary(tmp_path):
    rng = np.random.default_rng(4)
    deal = language_model.Blocks(1)
    words = np.unique(rng.integers(0, 2**64 - 1, 300, dtype=np.uint64))
    entries = {(k, int(left), int(right)): float(rng.integers(-50, 50)) / 8 for k in (2, 3) for left in words[:40] for right in rng.choice(words, 9)}
    entries |= {(1, int(w), int(w)): float(rng.integers(-50, 50)) / 8 for w in words[:200]}
    level, left, right = (np.array(x, kind) for x, kind in zip(zip(*entries), (np.int64, np.uint64, np.uint64)))
    value, n = np.array(list(entries.values())), np.arange(len(entries))
    rows = pa.table({"block": np.zeros(len(n), np.int32), "level": level, "left": left.view(np.int64), "right": right.view(np.int64), "value": value, "n": n})
    (tmp_path / "trie").write_bytes(language_model._block(rows, deal).column("trie")[0].as_py())
    trie = language_model.Trie(str(tmp_path / "trie"), deal)
    assert isinstance(trie.parts["pointers2"].low.base, np.memmap) or isinstance(trie.parts["pointers2"].low, np.memmap)
    got, counts, known = trie.word(words)
    assert known.tolist() == [(1, int(w), int(w)) in entries for w in words]
    assert got.tolist() == [entries.get((1, int(w), int(w)), 0.0) for w in words]
    numbers = dict(zip(entries, n.tolist()))
    assert counts.tolist() == [numbers.get((1, int(w), int(w)), 0) for w in words]
    for k in (2, 3):
        pairs = sorted((int(a), int(b)) for a in words[20:60] for b in words)
        a, b = (np.array(x, np.uint64) for x in zip(*pairs))
        got, known = trie.child(k, a, b)
        assert known.tolist() == [(k, *p) in entries for p in pairs] and known.sum() > 100
        assert got.tolist() == [entries.get((k, *p), 0.0) for p in pairs]


def test_entries_meet_only_what_their_contexts_lost(spark, monkeypatch):
    """No level's entries are joined to the lower ones, whose copies filled the disk: three joins in all."""
    plans, settled = [], language_model._settled

    def seen(frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return settled(frame, name)

    monkeypatch.setattr(language_model, "_settled", seen)
    rows = [(k, "one two three one two three four") for k in range(9)]
    assert scores(spark, rows) == plain_scores(rows)
    assert sum(plan.count("Join ") for plan in plans) == 3


def test_a_block_gives_counts_beside_values():
    deal, rng = language_model.Blocks(1), np.random.default_rng(5)
    left, right = (np.sort(rng.integers(0, 2**64 - 1, 400, dtype=np.uint64)) for _ in "ab")
    n = rng.integers(1, 10**6, 400)
    rows = pa.table({"block": np.zeros(400, np.int32), "level": np.full(400, 3), "left": left.view(np.int64), "right": right.view(np.int64), "value": n / 8, "n": n})
    trie = language_model._opened(language_model._block(rows, deal).column("trie")[0].as_py(), deal)
    value, count = trie.counted(3, left, np.where(np.arange(400) % 2, right, ~right))
    assert count.tolist() == np.where(np.arange(400) % 2, n, 0).tolist()
    assert value.tolist() == (count / 8).tolist()
