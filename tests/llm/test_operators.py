"""The operators against brute force, on small tables with every awkward case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketvane.llm import (
    bpe, elias_fano, language_model, mixing, ngram_join, quality_rules, sharding, suffix_dedup, token_counts, toxicity, winnowing,
)
from marketvane.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary

WORD = re.compile("[^\x20\x09-\x0d]+")
RNG = np.random.default_rng(5)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, size string, row long"


def some_text(n, words=400, rng=RNG):
    return " ".join(f"w{k}" for k in rng.integers(0, words, n))


def corpus():
    rng = np.random.default_rng(11)
    base = some_text(200, 400, rng)
    passage = some_text(60, 10**6, rng)
    texts = {
        0: base, 1: base, 2: base + " tail", 3: "x " + base.partition(" ")[2], 4: None, 5: "", 6: " \n\t ", 7: "one two three",
        8: some_text(80, 400, rng) + "\n" + passage + "\n" + some_text(50, 400, rng), 9: passage + " " + some_text(30, 400, rng), 10: "ab " * 300,
        11: "é漢🙂" * 120, 12: some_text(9000, 5000, rng), 13: "x" * 3000, 14: "line one here\n" * 30, 15: "### $$$ %%% " * 40,
        16: "Σας <|endoftext|> it's 12 ｆ", 17: "one two three",
    }
    return [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", len(t or ""), 1, "clash", k) for k, t in texts.items()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, repeated ids, a null id."""
    rows = corpus()
    return spark.createDataFrame([*rows[:4], rows[0], (2, "another text " * 20, *rows[2][2:]), (None, rows[8][1], *rows[8][2:]), rows[8]], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingle_sets():
    out = {}
    for k, t, *_ in corpus():
        w = words(t)
        out[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def test_near_duplicates_have_every_link(docs):
    sets, texts = shingle_sets(), {r[0]: r[1] for r in corpus()}
    got = {r["doc_id"]: r for r in ngram_join.near_duplicates(docs).collect()}
    assert set(got) == set(texts)
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            if texts[a] != texts[b] and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(texts[b])
    assert {k: r["n_links"] for k, r in got.items()} == {k: len(links[k]) for k in texts}
    assert got[1]["class_id"] == got[2]["class_id"] == 0 and got[1]["n_copies"] == 2
    assert got[17]["class_id"] == 7 and [got[k]["class_id"] for k in (4, 5, 6)] == [4, 5, 6]


def test_posterior_pruning_keeps_what_reaches_the_threshold():
    needed = ngram_join.least_matches(0.8, 1e-9)
    assert all(needed[n] < 0.8 * n for n in needed) and needed[128] > 0.5 * 128
    sets = [np.unique(RNG.integers(0, 1000, 400).astype(np.uint64)) for _ in range(12)]
    sets += [np.unique(np.append(s[: len(s) - 10], s[:5] + np.uint64(5000))) for s in sets]
    first, second = ngram_join.linked_pairs(sets, None)
    want = {
        (a, b) for a in range(24) for b in range(a + 1, 24)
        if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))
    }
    assert set(zip(first.tolist(), second.tolist(), strict=True)) == want and len(want) >= 12


def test_many_near_copies_are_compared_in_cells(spark):
    base = some_text(300, 10**6).split()
    rows = [(k, " ".join([*base[:k], "edit", *base[k + 1 :]])) for k in range(300)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["n_links"] for r in got} == {299} and {r["class_id"] for r in got} == {0}


def brute_repeats(texts, length=suffix_dedup.LENGTH):
    seen, out = set(), {}
    for key, text in texts:
        data = (text or "").encode()
        cover = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            if data[at : at + length] in seen:
                cover[at : at + length] = True
            seen.add(data[at : at + length])
        out[key] = bytes(np.frombuffer(data, np.uint8)[~cover])
    return out


def test_suffix_dedup_equals_brute_force(docs, odd):
    want = brute_repeats([(r[0], r[1]) for r in corpus()])
    got = {r["row"]["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == want and len(want[13]) == 1 and want[1] == b""
    again = suffix_dedup.remove_repeats(odd).collect()
    assert len(again) == odd.count()
    kept = {r["row"]["doc_id"]: bytes(r["kept"]) for r in again}
    assert len(kept[None]) > 0 and kept[8] == b""  # the null id comes first


def test_suffix_order_is_the_order_of_suffixes():
    for letters in (1, 2, 20):
        text = RNG.integers(0, letters, 400).astype(np.uint8)
        wanted = RNG.random(400) < 0.5
        order = suffix_dedup.suffix_order(text + 1, wanted, 401)
        data = (text + 1).tobytes()
        assert order.tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: data[i:])


def test_mix_meets_targets(docs):
    sized = [(r[0], r[3], len(words(r[1]))) for r in corpus()]
    mixed = mixing.mix_sources(docs)
    rows = mixed.taken().collect()
    assert len(rows) == len(sized) and all(r["taken"] <= 2 * r["size"] for r in rows)
    totals, taken = Counter(), Counter()
    for r in rows:
        totals[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[r["source"]] - r["target"]) <= mixing.BLOCK_WORDS for r in rows)
    assert {r["id"]: r["size"] for r in rows} == {k: n for k, _, n in sized}
    again = mixing.mix_sources(docs).taken().collect()
    assert {r["id"]: r["taken"] for r in again} == {r["id"]: r["taken"] for r in rows}
    made = {r["row"]["doc_id"]: len(words(r["mixed"])) for r in mixing.assemble(docs, mixed).collect()}
    assert made == {r["id"]: r["taken"] for r in rows if r["taken"]}


def test_targets_and_permutations():
    assert mixing.targets([100, 100, 100]) == [200.0, 500 / 3, 250 / 3]
    assert mixing.targets([0, 10]) == [0.0, 15.0] and mixing.targets([]) == []
    for n in (1, 2, 3, 17, 100):
        count = np.full(n, n)
        assert sorted(mixing.permuted(np.arange(n), count, np.full(n, 9, np.uint64))) == list(range(n))


def test_language_model_counts_and_beats_word_frequencies(spark, docs):
    def tokens(t):
        return [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(t)] + [None]

    texts = {r[0]: tokens(r[1]) for r in corpus()}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    count = Counter(w for k, t in texts.items() if not out[k] for w in t)
    n, v = sum(count.values()), len(count)
    for r in language_model.train_and_score(docs).collect():
        t = texts[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), abs_tol=1e-6)
        assert r["score"] <= 0


def test_elias_fano_round_trip(tmp_path):
    for n, top in ((0, 1), (1, 9), (500, 300), (500, 2**62)):
        values = np.sort(RNG.integers(0, top, n).astype(np.uint64))
        elias_fano.write(str(tmp_path / "m"), {"v": elias_fano.EliasFano.of(values), "q": elias_fano.Quantised.of(values.astype(float), 16)})
        parts = elias_fano.read(str(tmp_path / "m"))
        assert (parts["v"].get(np.arange(n)) == values).all() and (parts["q"].get(np.arange(n)) == values).all()


def test_shards_fit_and_split_only_where_needed(docs):
    rows = sharding.assign_shards(docs, limit=3000).collect()
    size, by = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
        by[r["shard"]].append(r)
    assert len(rows) == len(corpus()) and all(size[s] <= 3000 or len(by[s]) == 1 for s in by)
    prefix = Counter()
    for r in rows:
        prefix[r["shard"][:-1]] += 0
    for parent in prefix:  # the parent of a shard was too large
        below = [r for r in rows if r["shard"].startswith(parent)]
        assert sum(r["n_bytes"] for r in below) > 3000


def test_rows_of_one_id_still_fit(spark):
    rows = [(1, "y" * 900)] * 20
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), limit=2000).collect()
    assert len(got) == 20 and max(r["shard_bytes"] for r in got) <= 2000


def test_winnowing_by_definition(docs):
    text = some_text(300)
    codes = winnowing.code_points(text)
    grams = winnowing.gram_hashes(codes, winnowing.GRAM) >> np.uint64(32)
    w, chosen = winnowing.WINDOW, set()
    for at in range(len(grams) - w + 1):
        window = grams[at : at + w].tolist()
        chosen.add(at + max(k for k, x in enumerate(window) if x == min(window)))
    hashes, positions = winnowing.winnow(codes)
    assert positions.tolist() == sorted(chosen) and hashes.tolist() == grams[positions].tolist()
    texts = [r[1] or "" for r in corpus()]
    got = sorted(winnowing.compare_with_next(docs).collect())
    assert len(got) == len(texts)
    for k, r in enumerate(got):
        following = texts[(k + 1) % len(texts)]
        other = winnowing.edited(texts[k], following)
        own, changed = (winnowing.winnow(winnowing.code_points(t))[0] for t in (texts[k], other))
        assert r["n_chars"] == len(texts[k]) and r["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        assert r["fingerprint"] == winnowing.as_text(own) and r["near_edited"] == winnowing.likeness(own, changed)
    assert got[0]["near_next"] == 1.0 and got[4]["near_next"] == 1.0


def test_toxicity_finds_held_out_toxic_documents(spark):
    bad = ["scum", "moron", "trash", "vile"]
    rows, labels, rng = [], [], np.random.default_rng(3)
    for k in range(600):
        text = some_text(100, 400, rng).split()
        if k % 5 == 0:
            text[3], text[50], text[70] = rng.choice(bad, 3)
        rows.append((k, " ".join(text) if k != 1 else None))
        labels.append((k, 1, int(k % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    right = [got[k]["toxic"] == (k % 5 == 0) for k in range(300, 600)]
    assert np.mean(right) >= 0.95 and not got[1]["toxic"]
    assert np.all(np.diff(model.thresholds) > 0) and got[300]["severity"] > 0.5 > got[301]["severity"]
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert not any(r["toxic"] for r in toxicity.score(docs, none).collect())


ODD_TEXTS = ["", " ", "a" * 900, "Σας ΣΑΣ İstanbul ﬁ it's we'll", "\x1c\x85　 x", "<|endoftext|><|startoftext|>b", "漢字🙂é é", "a  b\n\n c "]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    library, (own, decoder) = Tokenizer.from_file(vocabulary(WORD_VOCABULARY)), bpe.load(vocabulary(WORD_VOCABULARY))
    for text in [*ODD_TEXTS, *(r[1] or "" for r in corpus()), *("".join(RNG.choice(list("abcdeinorst'É "), 60)) for _ in range(300))]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert decoder.decode(np.array(ids, np.int32)).decode() == library.decode(ids, skip_special_tokens=False)


def test_token_counts_equal_the_library_at_any_chunk():
    from tokenizers import Tokenizer

    path = vocabulary(BYTE_VOCABULARY)
    library = Tokenizer.from_file(path)
    whole, cut = token_counts.Counter(path), token_counts.Counter(path, chunk=64, overlap=4)
    for text in [*ODD_TEXTS, *(r[1] or "" for r in corpus())]:
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert whole.count(text) == cut.count(text) == want
    assert cut.widened


def test_ledger_measures_and_policies(docs):
    got = {r["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    for k, text, *_ in corpus():
        w = words(text)
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
        assert got[k]["n_dup_lines"] == len(lines) - len(set(lines))
    kept = {r["doc_id"] for r in quality_rules.passing(docs, "v1").collect()}
    assert kept == {k for k, r in got.items() if not r["failed"] & quality_rules.policy_mask("v1")}
    alone = {r["rule"]: r for r in quality_rules.ablation(quality_rules.ledger(docs), "v1").collect()}
    few = [r for r in got.values() if r["n_words"] < 50]
    assert alone["few_words"]["n_failed"] == len(few)
    assert alone["few_words"]["n_kept_without"] == len(kept) + alone["few_words"]["n_only"]


def test_empty_and_odd_tables(spark, nothing, odd):
    path = vocabulary(WORD_VOCABULARY)
    operators = [
        ngram_join.near_duplicates, lambda d: mixing.mix_sources(d).taken(), language_model.train_and_score, sharding.assign_shards,
        winnowing.compare_with_next, suffix_dedup.remove_repeats, lambda d: bpe.encode_decode(d, path), quality_rules.ledger,
        lambda d: token_counts.count_tokens(d, vocabulary(BYTE_VOCABULARY)),
        lambda d: toxicity.score(d, toxicity.train(d, d.select("doc_id", F.lit(0).alias("toxic")))),
    ]
    for operator in operators:
        assert operator(nothing).count() == 0
        assert operator(odd).count() == odd.count()
