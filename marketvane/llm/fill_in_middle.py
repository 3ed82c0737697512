"""Fill-in-middle transformation by piece tables.

A document is a table of pieces, each a descriptor (buffer, start, end) over buffers that never change: the bytes of
its text and those of the sentinels. Cutting splits a descriptor in two, an arrangement permutes descriptors and puts
sentinel descriptors before them, and the inverse permutation restores the text. A hash streams over the descriptors;
a text is put together only where the output itself is wanted.

`transform` cuts every text at two line ends that its id's hash draws, and arranges the three parts. `restore` reads
nothing but an output and its form: it cuts the output at the sentinels, leaves these out and undoes the permutation.

Defined cases: a null text is an empty one; an empty text, or one that holds a sentinel, stays as it is (`plain`). The
draw of a null id is that of an empty id. Rows are taken one by one, so repeated rows and ids, in any order, give equal
results and ties can't arise; an empty table gives an empty result. A text of any length is cut through descriptors; a
task holds a slice of rows, or one longer row. Other columns are neither read nor returned, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, map_slices

#: Order of the parts prefix (0), middle (1), suffix (2) in each form.
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"
TEXT, MARKS = 0, 1

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class Sentinels:
    """The strings that stand before prefix, middle and suffix."""

    prefix: str = "<P>"
    middle: str = "<M>"
    suffix: str = "<S>"

    def strings(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.middle.encode(), self.suffix.encode()

    def __post_init__(self):
        marks = self.strings()
        if len(set(marks)) < 3 or any(a in b for a in marks for b in marks if a is not b) or not all(marks):
            raise ValueError("sentinels must be three strings, none empty or inside another")
        if any(a.endswith(b[:k]) for a in marks for b in marks for k in range(1, len(b)) if k < len(a)):
            raise ValueError("no sentinel may end as one begins: an output could not be cut")


class PieceTable:
    """A text as descriptors over immutable buffers."""

    def __init__(self, buffers: tuple[memoryview, ...], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: memoryview, marks: memoryview) -> PieceTable:
        return cls((text, marks), [(TEXT, 0, len(text))])

    def cut(self, at: int) -> None:
        """Split the descriptor that holds place `at` of the table's text; at 0, nothing stands before it."""
        before = 0
        for k, (buffer, start, end) in enumerate(self.pieces):
            if at <= before + end - start:
                middle = start + at - before
                self.pieces[k : k + 1] = [(buffer, start, middle), (buffer, middle, end)]
                return
            before += end - start
        raise ValueError("a cut beyond the text")

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def restored(self, order: tuple[int, ...]) -> PieceTable:
        """The table of which `permuted(order)` gave this one."""
        inverse = sorted(range(len(order)), key=order.__getitem__)
        return self.permuted(tuple(inverse))

    def marked(self, marks: list[Piece]) -> PieceTable:
        """A sentinel's descriptor before each descriptor."""
        return PieceTable(self.buffers, [x for pair in zip(marks, self.pieces, strict=True) for x in pair])

    def unmarked(self) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[1::2])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def digest(self) -> str:
        state = sha256()
        for part in self.stream():
            state.update(part)
        return state.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.stream())


class Marks:
    """The sentinels in one buffer, and a descriptor for each part's."""

    def __init__(self, sentinels: Sentinels):
        self.strings = sentinels.strings()
        self.buffer = memoryview(b"".join(self.strings))
        ends = np.cumsum([len(s) for s in self.strings]).tolist()
        self.pieces: list[Piece] = [(MARKS, end - len(s), end) for s, end in zip(self.strings, ends, strict=True)]

    def before(self, form: str) -> list[Piece]:
        return [self.pieces[part] for part in ARRANGEMENTS[form]]


def line_ends(text: memoryview) -> np.ndarray:
    """The end of each unit: a line with its line feed, or what is left after the last one."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if len(text) == (ends[-1] if len(ends) else 0) else np.append(ends, len(text))


def code_points(text: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def arrange(text: memoryview, marks: Marks, form: str, first: int, second: int) -> tuple[PieceTable, PieceTable]:
    """The text cut at two places, and the output of its form."""
    cut = PieceTable.of(text, marks.buffer)
    cut.cut(first)
    cut.cut(second)
    return cut, cut.permuted(ARRANGEMENTS[form]).marked(marks.before(form))


def undo(output: memoryview, marks: Marks, form: str) -> PieceTable:
    """The text that an output of this form was made of."""
    if form == PLAIN:
        return PieceTable.of(output, marks.buffer)
    held, at = bytes(output), 0
    table = PieceTable.of(output, marks.buffer)
    for k, part in enumerate(ARRANGEMENTS[form]):
        mark = marks.strings[part]
        at = held.find(mark, at)
        if at < 0 or (k == 0 and at > 0):
            raise ValueError(f"no output of form {form}")
        if k:
            table.cut(at)
        table.cut(at + len(mark))
        at += len(mark)
    return table.unmarked().restored(ARRANGEMENTS[form])


def _views(column: pa.Array) -> list[memoryview]:
    """Each value's bytes in place; a null has none."""
    return [memoryview(value.as_buffer()) if value.is_valid else memoryview(b"") for value in as_binary(column)]


def draws(id_: Column, seed: int) -> Column:
    """The first four 8-digit groups of the hex SHA-256 of `seed:id`, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    sentinels: Sentinels = Sentinels(),
) -> DataFrame:
    """One row a document: its id, n (units), form, prefix_chars, middle_chars (null if plain), the output and its SHA-256.

    Of 100 documents about `rate` are transformed, and of those `spm_rate` take the form suffix-prefix-middle.
    """

    def transformed(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = Marks(sentinels)
        rows = []
        for text, (h1, h2, h3, h4) in zip(_views(batch.column("text")), batch.column("draws").to_pylist(), strict=True):
            ends = line_ends(text)
            n = len(ends)
            held = bytes(text)
            if not held or h3 % 100 >= rate or any(mark in held for mark in marks.strings):
                plain = PieceTable.of(text, marks.buffer)
                rows.append((n, PLAIN, None, None, held, plain.digest()))
                continue
            form = "spm" if h4 % 100 < spm_rate else "psm"
            first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
            cut, output = arrange(text, marks, form, first, second)
            prefix, middle, _ = cut.stream()
            rows.append((n, form, code_points(prefix), code_points(middle), output.joined(), output.digest()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[4] = arrays[4].cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names])

    names = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), draws(F.col(id_col), seed).alias("draws"))
    kind = frame.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, output_sha256 string"
    return map_slices(frame, transformed, schema, "text").withColumnRenamed("id", id_col)


def restore(outputs: DataFrame, sentinels: Sentinels = Sentinels(), texts: bool = True) -> DataFrame:
    """`outputs` (with columns `output` and `form`) with the text each was made of, if `texts`, and its SHA-256."""

    def restored(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = Marks(sentinels)
        tables = [undo(o, marks, f) for o, f in zip(_views(batch.column("output")), batch.column("form").to_pylist(), strict=True)]
        out = [batch.column("row"), pa.array([t.digest() for t in tables], pa.string())]
        if texts:
            out.append(pa.array([t.joined() for t in tables], pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(out, ["row", "restored_sha256", "restored"][: len(out)])

    others = [F.col(f"`{c}`") for c in outputs.columns if texts or c != "output"]
    frame = outputs.select(F.struct(*others).alias("row"), "output", "form")
    schema = f"row {frame.schema['row'].dataType.simpleString()}, restored_sha256 string" + ", restored string" * texts
    return map_slices(frame, restored, schema, "output").select("row.*", *["restored"] * texts, "restored_sha256")
