"""Fill-in-middle: cuts, forms and digests against plain strings, and round trips."""

import re
from hashlib import sha256

import pytest

from marketvane.llm import fill_in_middle as fim
from marketvane.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, output string, form string, n long, row long, id string"


def corpus():
    texts = [
        "one\ntwo\nthree", "one line", "ends\n", "\n\n\n", "é漢🙂\n" * 50, None, "", "has <P> in it\nline", "a<S>b", "<M>", "<P\n>S>", "<<S\n>M",
        "x" * 200_000, "line\n" * 40_000, "\r\n\r\n", "same\ntext\n", "same\ntext\n",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(k, "".join(f"line {j} é\n" for j in range(k % 13)) + "tail" * (k % 2)) for k in range(20, 120)]
    return rows + [(None, "null\nid\nhere"), (15, "same\ntext\n"), (15, "another\ntext")]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", "clash", 5, 6, "clash") for r in corpus()], SCHEMA).repartition(3)


def test_outputs_equal_plain_strings_and_are_restored(docs):
    outputs = fim.transform(docs)
    assert outputs.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    got = fim.restore(outputs).collect()
    found = sorted(
        (str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"], r["output_sha256"], r["restored"], r["restored_sha256"])
        for r in got
    )
    want = []
    for doc_id, text in corpus():
        n, form, prefix, middle, output = plain(doc_id, text)
        want.append((
            str(doc_id), n, form, str(prefix), str(middle), output, sha256(output.encode()).hexdigest(), text or "", sha256((text or "").encode()).hexdigest(),
        ))
    assert found == sorted(want) and {w[2] for w in want} == {"plain", "psm", "spm"}


def test_rates_and_other_sentinels(docs):
    marks = fim.Sentinels("[pre]", "[mid]", "[suf]")
    outputs = fim.transform(docs, rate=50, spm_rate=0, sentinels=marks)
    forms = {r["form"]: r["n"] for r in outputs.groupBy("form").agg({"doc_id": "count"}).toDF("form", "n").collect()}
    assert set(forms) == {"plain", "psm"} and 30 < forms["psm"] < 80
    texts = {k: t or "" for k, t in corpus() if k not in (None, 15)}
    got = fim.restore(outputs, marks).where("doc_id <> 15").collect()
    assert {r["doc_id"]: r["restored"] for r in got} == texts


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<S>"), ("", "a", "b"), ("ab", "bc", "x"), ("<P>", "<P>x", "y"), ("aa", "b", "c")])
def test_sentinels_that_cannot_be_told_apart_are_refused(marks):
    with pytest.raises(ValueError):
        fim.Sentinels(*marks)


def test_pieces_only_describe():
    text = memoryview(b"abcdef")
    marks = fim.Marks(fim.Sentinels())
    table = fim.PieceTable.of(text, marks.buffer)
    table.cut(2)
    table.cut(4)
    assert table.pieces == [(0, 0, 2), (0, 2, 4), (0, 4, 6)] and table.buffers[0] is text
    for order in ((0, 1, 2), (2, 0, 1), (1, 2, 0), (2, 1, 0)):
        assert table.permuted(order).restored(order).pieces == table.pieces
    assert table.permuted((2, 0, 1)).joined() == b"efabcd" and table.digest() == sha256(b"abcdef").hexdigest()
    with pytest.raises(ValueError):
        table.cut(7)
    with pytest.raises(ValueError):
        fim.undo(memoryview(b"no sentinel"), marks, "psm")


def test_empty_table(spark, docs):
    assert fim.restore(fim.transform(docs.limit(0)), texts=False).count() == 0


def test_query_columns(spark):
    frame = QUERIES["op11_fill_in_middle"](spark, "/root/testdata/sf0.001")
    assert frame.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
