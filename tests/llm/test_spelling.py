"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from marketvane.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, form string"


def some_words(count, letters, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 9))) for _ in range(count)]
    out = list(base)
    for word in base:
        at = rng.randrange(len(word))
        out += [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + "é" + word[at + 1 :]]
    return sorted(set(out))


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def test_acceptor_gives_each_pair_once():
    words = some_words(120, "abc", 1) + ["z" * 3000, "z" * 3001, "z" * 2999 + "y"]
    words = sorted(set(words))
    got = [tuple(sorted((words[i], words[j]))) for i, j in spelling.Acceptor(words).pairs().tolist()]
    want = {(a, b) for k, a in enumerate(words) for b in words[k + 1 :] if is_near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_acceptor_is_minimal():
    words = some_words(100, "ab", 3)
    machine = spelling.Acceptor(words)
    # a minimal acceptor has one state for each set of endings that some beginning can have
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for x in words for p in (x[:k] for k in range(len(x) + 1))}
    assert machine.count[machine.start] == len(words) and len(machine.arcs) == len(endings)
    assert spelling.Acceptor([]).pairs().shape == (0, 2)


@pytest.mark.parametrize("part_words", [1, 5, 60, 10**6])
def test_parts_of_any_size_give_the_same_pairs(spark, part_words):
    words = some_words(60, "ab", 2) + ["hotprefix", "hotprefixa", "hotprefixab", "hotprefi", "xhotprefi", "y" * 40, "y" * 41]
    frame = spark.createDataFrame([(w, 2) for w in sorted(set(words))], "word string, n long")
    found = spelling.near_pairs(frame, part_words).collect()
    got = [tuple(sorted((r["a"], r["b"]))) for r in found]
    want = {(a, b) for a in set(words) for b in set(words) if a < b and is_near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, near = {}, {}
    for w, n in counts.items():
        near[w] = [x for x in counts if is_near(w, x)]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return out


def corpus():
    rng = random.Random(7)
    base = ["frequent", "réponses", "ÿmlauted", "ordinary", "ORDINARY", "extremely", "÷×÷×÷×÷", "short", "Éclairée"]
    rows = []
    for k in range(400):
        words = [rng.choice(base) for _ in range(rng.randint(0, 60))]
        if k % 9 == 0:
            words += ["frequenz", "frequenzy", "frequenzyy", "ordinarx"] * (1 + k % 2)
        rows.append((k, rng.choice([" ", "\n", "-", "漢"]).join(words)))
    rows += [(None, "frequent frequent"), (None, None), (401, ""), (402, "a" * 50_000 + " " + "a" * 50_000), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(403, "frequent " * 4000), (404, "x" + "漢" * 3 + "frequent")]
    return rows


def test_variants_equal_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(4)
    for part_words in (3, spelling.PART_WORDS):
        found = spelling.variants(spelling.word_counts(frame), part_words)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        got = [tuple(r) for r in found.collect()]
        want = brute(rows)
        assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] and r[2] != r[1] for r in want), "some chain has two steps"


def test_empty_table_and_no_slips(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(spelling.word_counts(empty)).count() == 0
    frame = spark.createDataFrame([(1, "Frequent frequent")], "doc_id long, text string")
    assert [tuple(r) for r in spelling.word_counts(frame, slip=None).collect()] == [("frequent", 2)]
    assert spelling.variants(spelling.word_counts(frame, slip=None)).where(F.col("root") == "frequent").count() == 1
