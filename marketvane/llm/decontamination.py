"""Benchmark decontamination by a distributed positional inverted index.

`index` turns a slice of documents into one block: for each term of the slice its posting list, the ascending places
of its words, with the documents' places one after another and a hole between two documents. A block holds whole
documents and is written as one row, so no posting moves between machines, and a word that every document has is a
long list in many blocks and not one list.

`search` takes test items as windows of consecutive words. In every block each distinct window starts from the list of
its rarest term there. The lists of the others, by rising length and shifted by their offset in the window, are
intersected with what is left: a phrase is where all agree. For proximity the same lists are asked for a word within
reach instead of one at the offset.

Items meet the index in parts of about PART_BYTES of text: a part is what is sent to all tasks and what the driver holds
at one time, whatever the size of the benchmark. Several parts are several passes over the index, not over the texts.

Defined cases: a null or empty text has no words and no hits; an item without words has no window, one with fewer words
than a window is one window. Rows are documents: repeated rows and ids are each judged alone, and a null id is returned
as it is. Items are told apart by their id (null: the empty string); repeated items count once. An empty table on either
side gives no hits. A text longer than a slice is a block of its own. Other columns are not read. The result has one row
a document and no order, so ties can't arise.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, map_slices, stored

WINDOW = 10
#: Words of a stretch that must hold all words of a window, for proximity.
REACH = 20
#: Bytes of item texts that one pass over the index looks for.
PART_BYTES = 8 << 20
#: Places of rarest terms looked at in one go.
AT_ONCE = 1 << 20
#: Rows of a row group of the stored index. A block is megabytes: Parquet's writer would look at its buffer after 100 rows
#: only, and its reader opens up to 4096 rows of a row group together.
GROUP_BLOCKS = 1

_IS_WORD = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IS_WORD[_low : _high + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, A-Z lower-cased, and the number of words before each text and in all."""
    texts = pc.fill_null(as_binary(texts), b"").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = ends[:-1][ends[:-1] < len(data)]
    begins[borders] = inside[borders]
    letters = _LOWER[data[inside]]
    offsets = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    before = np.searchsorted(np.flatnonzero(begins), ends).astype(np.int64)
    return words, before


def _lists(arrays: list[np.ndarray | pa.Array]) -> list[pa.Array]:
    """Each array as the only value of a list column."""
    return [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a if isinstance(a, pa.Array) else pa.array(a)) for a in arrays]


def _block(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The posting lists of a slice's words."""
    words, before = split_words(batch.column("text"))
    coded = words.dictionary_encode()
    term = coded.indices.to_numpy(zero_copy_only=False)
    # between two documents lies one place without a word
    place = np.arange(len(words)) + np.repeat(np.arange(batch.num_rows), np.diff(before))
    order = np.argsort(term, kind="stable")
    steps = np.diff(place[order], prepend=0)  # small within a list
    counts = np.bincount(term, minlength=len(coded.dictionary)).astype(np.int32)
    starts = before + np.arange(batch.num_rows + 1)
    columns = [batch.column("id"), starts, coded.dictionary.cast(pa.binary()), counts, steps.astype(np.int32)]
    return pa.RecordBatch.from_arrays(
        [pa.array([uuid.uuid4().hex]), *_lists(columns)], ["block", "ids", "starts", "terms", "counts", "steps"]
    )


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of the documents, one row a block. A task holds a block at a time, however many it writes or reads."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    schema = f"block string, ids array<{kind}>, starts array<bigint>, terms array<binary>, counts array<int>, steps array<int>"
    options = {"compression": "zstd", "parquet.block.row.count.limit": str(GROUP_BLOCKS)}
    return stored(map_slices(frame, _block, schema, "text"), "postings", **options)


@dataclass
class Windows:
    """Distinct windows of items: their terms' numbers in `terms`, one array a length, and the items that have each."""

    terms: list[bytes]
    rows: dict[int, np.ndarray]
    items: dict[int, list[np.ndarray]]
    names: list[str]


def windows(items: list[tuple[str, str | None]], length: int = WINDOW) -> Windows:
    numbers: dict[bytes, int] = {}
    names = sorted({name for name, _ in items})
    place = {name: k for k, name in enumerate(names)}
    found: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = [numbers.setdefault(w, len(numbers)) for w in split_words(pa.array([text], pa.string()))[0].to_pylist()]
        own = min(length, len(words))
        for at in range(len(words) - own + 1 if own else 0):
            found[own][tuple(words[at : at + own])].add(place[name])
    rows = {n: np.array(list(by_window), np.int64).reshape(-1, n) for n, by_window in found.items()}
    have = {n: [np.array(sorted(x), np.int64) for x in by_window.values()] for n, by_window in found.items()}
    return Windows(list(numbers), rows, have, names)


class Block:
    """One block of the index, opened for the terms of some windows."""

    def __init__(self, starts: np.ndarray, terms: pa.Array, counts: np.ndarray, steps: np.ndarray, wanted: list[bytes]):
        self.starts, self.counts = starts, counts.astype(np.int64)
        self.place = np.cumsum(steps, dtype=np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        #: Term and place in one number, ascending: a search in it is a search in the term's list.
        self.keys = np.repeat(np.arange(len(counts), dtype=np.int64) << 32, self.counts) | self.place
        own = pc.index_in(pa.array(wanted, pa.binary()), value_set=terms)
        self.number = pc.fill_null(own, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def seeds(self, rows: np.ndarray):
        """(windows, their terms by rising list length, those terms' offsets, window of each seed, its place): the
        windows all of whose terms occur, each with every place of its rarest term, some at a time."""
        here = self.number[rows]
        alive = np.flatnonzero((here >= 0).all(axis=1))
        here = here[alive]
        order = np.argsort(self.counts[here], axis=1, kind="stable")
        here = np.take_along_axis(here, order, axis=1)
        upto = np.cumsum(self.counts[here[:, 0]]) if len(here) else np.zeros(0, np.int64)
        for low in range(0, int(upto[-1]) if len(upto) else 0, AT_ONCE):
            number = np.arange(low, min(low + AT_ONCE, int(upto[-1])))
            window = np.searchsorted(upto, number, "right")
            rarest = here[window, 0]
            nth = number - (upto[window] - self.counts[rarest])
            yield alive, here, order, window, self.place[self.first[rarest] + nth]

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray | None = None) -> np.ndarray:
        """Whether the term's list has the place `low`, or one from `low` to `high`."""
        at = np.searchsorted(self.keys, term << 32 | low)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found <= (term << 32 | (low if high is None else high)))

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1

    def phrases(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its first word) wherever a window's words stand one after another."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for alive, here, order, window, place in self.seeds(rows):
            start = place - order[window, 0]
            keep = start >= 0
            window, start = window[keep], start[keep]
            for k in range(1, rows.shape[1]):
                keep = self.has(here[window, k], start + order[window, k])
                window, start = window[keep], start[keep]
            out.append((alive[window], start))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def near(self, rows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, document), repeated, wherever `reach` words in a row of a document hold all words of a window."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        n = rows.shape[1]
        for alive, here, _, window, place in self.seeds(rows):
            for k in range(1, n):
                own = self.document(place)
                low, high = np.maximum(place - reach + 1, self.starts[own]), np.minimum(place + reach - 1, self.starts[own + 1] - 2)
                keep = self.has(here[window, k], low, high)
                window, place = window[keep], place[keep]
            own = self.document(place)
            for back in range(reach):  # the stretch that begins so far before the rarest word
                begin = place - back
                fits = np.flatnonzero(begin >= self.starts[own])
                end = np.minimum(begin + reach - 1, self.starts[own + 1] - 2)
                for k in range(1, n):
                    fits = fits[self.has(here[window[fits], k], begin[fits], end[fits])]
                out.append((alive[window[fits]], own[fits]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _spans(place: np.ndarray, length: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows merged where they meet or overlap: (document, first place, place after the last)."""
    order = np.argsort(place, kind="stable")
    place, end, document = place[order], np.maximum.accumulate((place + length)[order]), document[order]
    first = np.ones(len(place), bool)
    first[1:] = place[1:] > end[:-1]
    heads = np.flatnonzero(first)
    lasts = np.append(heads[1:], len(place))[: len(heads)] - 1
    return document[heads], place[heads], end[lasts]


def _by_document(document: np.ndarray, window: np.ndarray, items: list[np.ndarray]) -> dict[int, set[int]]:
    """The items of each document's windows."""
    out: dict[int, set[int]] = defaultdict(set)
    for d, w in np.unique(np.stack([document, window], axis=1), axis=0).tolist():
        out[d].update(items[w].tolist())
    return out


def _open(batch: pa.RecordBatch, row: int, wanted: list[bytes]) -> tuple[Block, pa.Array]:
    def values(name):
        return batch.column(name)[row].values

    starts, counts, steps = (values(c).to_numpy(zero_copy_only=False) for c in ("starts", "counts", "steps"))
    return Block(starts, values("terms").cast(pa.binary()), counts, steps, wanted), values("ids")


def _searched(batch: pa.RecordBatch, wanted: Windows, reach: int | None) -> pa.RecordBatch:
    """A row for each document of the blocks: id, n_words, spans and names of the items found."""
    out = []
    for row in range(batch.num_rows):
        block, ids = _open(batch, row, wanted.terms)
        n_docs = len(ids)
        found: dict[int, set[int]] = defaultdict(set)
        spans = [[] for _ in range(n_docs)]
        places, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length, rows in wanted.rows.items():
            if reach is None:
                window, place = block.phrases(rows)
                document = block.document(place)
                places.append(place)
                lengths.append(np.full(len(place), length))
            else:
                window, document = block.near(rows, max(reach, length))
            for d, own in _by_document(document, window, wanted.items[length]).items():
                found[d] |= own
        place, length = np.concatenate(places), np.concatenate(lengths)
        for d, start, end in zip(*(x.tolist() for x in _spans(place, length, block.document(place))), strict=True):
            spans[d].append({"at": start - int(block.starts[d]), "end": end - int(block.starts[d])})
        out.append(pa.RecordBatch.from_arrays(
            [
                pa.array([batch.column("block")[row].as_py()] * n_docs, pa.string()), pa.array(range(n_docs), pa.int32()), ids,
                pa.array(np.diff(block.starts) - 1, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64())]))),
                pa.array([[wanted.names[k] for k in sorted(found.get(d, ()))] for d in range(n_docs)], pa.list_(pa.string())),
            ],
            ["block", "ordinal", "id", "n_words", "spans", "items"],
        ))
    return pa.concat_batches(out)


def search(postings: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = WINDOW, reach: int | None = None) -> DataFrame:
    """One row a document of the index: id, n_words, spans (places of words in windows found, merged) and items, the
    sorted ids of the items found. With `reach`, items whose windows are near one another, and no spans."""
    spark = postings.sparkSession
    texts = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // PART_BYTES))
    kind = postings.schema["ids"].dataType.elementType.simpleString()
    schema = f"block string, ordinal int, id {kind}, n_words bigint, spans array<struct<at: bigint, end: bigint>>, items array<string>"
    found = []
    for part in range(parts):
        mine = texts.where(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part)
        wanted = spark.sparkContext.broadcast(windows([tuple(r) for r in mine.collect()], length))

        def run(batches, wanted=wanted):
            for batch in batches:
                for row in range(batch.num_rows):
                    yield _searched(batch.slice(row, 1), wanted.value, reach)

        hits = postings.mapInArrow(run, schema)
        if parts > 1:
            found.append(stored(hits, "hits"))
            wanted.destroy()
        else:
            return hits.drop("block", "ordinal")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    return together.groupBy("block", "ordinal").agg(
        F.any_value("id").alias("id"), F.any_value("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).drop("block", "ordinal")


def covered(spans: Column) -> Column:
    """How many places the spans cover."""
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def add(sums, span):
        at = F.greatest(span["at"], sums["upto"])
        return F.struct(
            F.greatest(span["end"], sums["upto"]).alias("upto"), (sums["n"] + F.greatest(span["end"] - at, F.lit(0).cast("bigint"))).alias("n")
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda sums: sums["n"])
