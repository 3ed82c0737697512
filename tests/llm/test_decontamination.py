"""Exact phrases and proximity from the index against plain scans of every text."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketvane.llm import decontamination as dc
from marketvane.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, block string, id string, items string, item_id long"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(few=30):
    rng = random.Random(3)

    def some(n):
        return " ".join(rng.choice(["w%d" % rng.randrange(few), "É漢"]) for _ in range(n))

    items = [(k, some(rng.randint(10, 40))) for k in range(12)]
    items += [(20, "three little words"), (21, None), (22, ""), (23, "!!! ..."), (5, items[5][1]), (24, "three, LITTLE... words"), (None, some(12))]
    rows = [(k, some(rng.randint(0, 200))) for k in range(60)]
    for k, (_, text) in enumerate(items[:12]):
        own = text.split()
        at = rng.randrange(max(1, len(own) - 10))
        rows.append((100 + k, some(5) + " - " + " ".join(own[at : at + rng.randint(8, 14)]).upper().replace("W", "w") + ", " + some(5)))
        rows.append((200 + k, " ".join(rng.sample(own[:10], 10))))
    rows += [(300, "Three LITTLE\nwords"), (301, "three little"), (302, "words three little"), (303, None), (304, ""), (305, "\n\t"), (None, items[0][1])]
    rows += [(306, ("three little words " * 3000) + items[1][1]), (300, "Three LITTLE\nwords"), (307, "x" * 40_000), (308, "little three filler words")]
    # a text may not go on in the next one
    own = items[2][1].split()
    return rows + [(400, " ".join(own[:5])), (401, " ".join(own[5:]))], items


def exact(rows, items, length=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                own = wanted.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((str(doc_id), len(w), len(hit), ",".join(sorted(found))))
    return sorted(out)


def near(rows, items, reach, length=10):
    out = []
    for doc_id, text in rows:
        w, found = words(text), set()
        for item, own in items:
            t = words(own)
            n = min(length, len(t))
            for k in range(len(t) - n + 1 if n else 0):
                need, size = set(t[k : k + n]), max(reach, n)
                if any(need <= set(w[j : j + size]) for j in range(max(1, len(w) - size + 1))):
                    found.add("" if item is None else str(item))
                    break
        out.append((str(doc_id), ",".join(sorted(found))))
    return sorted(out)


@pytest.fixture(scope="module")
def tables(spark):
    rows, items = corpus()
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", 1) for r in rows], SCHEMA)
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, name string")
    return rows, items, docs, bench


def exact_rows(found):
    shown = found.select("id", "n_words", dc.covered(F.col("spans")).alias("n_hit"), F.array_join("items", ",").alias("items"))
    return sorted((str(r["id"]), *r[1:]) for r in shown.collect())


@pytest.mark.parametrize("partitions", [1, 7])
def test_phrases_equal_a_plain_scan(tables, partitions):
    rows, items, docs, bench = tables
    got = exact_rows(dc.search(dc.index(docs.repartition(partitions)), bench))
    assert got == exact(rows, items) and sum(r[2] > 0 for r in got) >= 12


def test_parts_and_small_steps_change_nothing(tables, monkeypatch):
    rows, items, docs, bench = tables
    postings = dc.index(docs.repartition(2))
    monkeypatch.setattr(dc, "PART_BYTES", 300)
    assert exact_rows(dc.search(postings, bench)) == exact(rows, items)


def test_a_task_holds_one_block_at_a_time(spark):
    docs = spark.range(3500).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")).coalesce(1)
    files = [pq.read_metadata(f.removeprefix("file://")) for f in dc.index(docs).inputFiles()]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert sum(groups) == 4 and max(groups) == 1


def test_proximity_equals_a_plain_scan(tables):
    rows, items, docs, bench = tables
    for reach in (4, 20):
        found = dc.search(dc.index(docs.repartition(3)), bench, reach=reach).select("id", F.array_join("items", ",")).collect()
        assert sorted((str(r[0]), r[1]) for r in found) == near(rows, items, reach)


def test_seeds_in_many_steps(monkeypatch):
    rows, items = corpus()
    monkeypatch.setattr(dc, "AT_ONCE", 3)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["id", "text"])
    wanted = dc.windows([("" if k is None else str(k), t) for k, t in items])
    found = dc._searched(dc._block(batch), wanted, None).to_pylist()
    assert [(str(r["id"]), ",".join(r["items"])) for r in found] == [(str(d), x) for d, x in _in_order(rows, items)]


def _in_order(rows, items):
    return [(r[0], exact([r], items)[0][3]) for r in rows]


def test_words_and_their_places():
    found, before = dc.split_words(pa.array(["A bc", None, "", "d", "É0-Z", "e"])[0:5])
    assert found.to_pylist() == [b"a", b"bc", b"d", "É0".encode(), b"z"] and before.tolist() == [0, 2, 2, 2, 3, 5]
    assert np.diff(before).tolist() == [2, 0, 0, 1, 2]


def test_empty_tables(spark, tables):
    _, _, docs, bench = tables
    postings = dc.index(docs)
    assert {r["items"] for r in dc.search(postings, bench.limit(0)).select(F.size("items").alias("items")).collect()} == {0}
    assert dc.search(dc.index(docs.limit(0)), bench).count() == 0


def test_query_columns(spark):
    frame = QUERIES["op12_decontamination"](spark, "/root/testdata/sf0.001")
    assert frame.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert QUERIES["op12_proximity"](spark, "/root/testdata/sf0.001").where("near_items <> ''").count() > 0
