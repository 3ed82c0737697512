"""Language-model scoring with an Elias-Fano n-gram trie.

The model is interpolated absolute discounting over n-grams of one to three words. A word, pair or triple is in the
trie if the training documents hold it LEAST_COUNT times, whatever the corpus' size; words alone need one occurrence.

An n-gram is named by its left and its right part, the n-grams without its last and without its first word: the left
one is its context, the right one the lower n-gram that it backs off to. Under the back-off rule

    p(n-gram) = (n - DISCOUNT) / n(left) + weight(left) p(right),  or weight(left) p(right) where it is not in the trie,

an entry needs no more than its own count and its weight as a context. A text asks for those of its own words, pairs and
triples, which are all that its probabilities rest on, so no entry is ever joined to the lower ones.

1. Documents are read once, into a stored table of slices of about PART_BYTES of text: the tokens as numbers into the
   slice's own list of word hashes. All later steps read slices, whose rows are as many as the corpus has PART_BYTES,
   however often a document is repeated.
2. A slice sends fingerprints of its distinct pairs and triples to blocks by leading bits of their hash; a block answers
   which ones reach LEAST_COUNT among training documents, as a bitmap.
3. The slices send the parts and counts of those, and of all words, one level at a time. They are counted exactly, by
   64-bit hash. A triple's count is all that the trie has of it, so its block is made as it is counted; words and pairs
   are joined with what the entries after them as a context add up to, and so get their weights.
4. The trie is stored in the shared folder in blocks, each level's apart. A block holds contexts in order, for each a
   monotone pointer to its first child, and the children in order within their context, all in Elias-Fano form, with
   counts and quantised weights beside them. A block is named by leading bits of the context and some of the child, so a
   frequent context's children lie in many blocks, each with a pointer range of its own.
5. Slices ask for their n-grams, in TURNS: a block is memory-mapped, the context found by successor search among the contexts, and
   the child by successor search in the context's range alone. The slice works out its texts' probabilities by the rule.

What a step has left on disk goes before the next one. No step holds more than a slice or a block; both are of fixed
size, but for a longer single text. The messages of steps 2, 3 and 5 have a row for each slice and block that it has an
n-gram for.

A word unseen in training has the add-one probability of none. Defined cases: a null text is an empty one: one token, the
end. The document's id is taken as text to choose the held-out ones; a null id counts as the empty string. Without
training documents every probability is 1. Rows are scored one by one, repeated or not, and repeated rows in training
count again. An empty table has no scores. A text of any length is a slice of its own. Other columns are not read.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import elias_fano
from .common import as_binary, stored
from .elias_fano import EliasFano, Quantised
from .rolling import BASE, mix, span_hashes, word_bounds

LEAST_COUNT = 2
DISCOUNT = 0.75
#: Bytes of text of a slice, and tokens of the texts that one block serves.
PART_BYTES = 4 << 20
BLOCK_TOKENS = 3 << 20
#: Slices ask the trie in so many turns, of which one at a time has its messages on disk.
TURNS = 5
#: Bits of a fingerprint: of its bucket below its block, and below its bucket.
FINE_BITS = 8
LOW_BITS = 24
#: Stand for the end and the start of a text among the words' hashes.
END = np.uint64(0x5D1E5D1E5D1E5D1F)
START = np.uint64(0x57A257A257A257A3)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """START, the hashes of the words, A-Z lower-cased, and END of every text, and how many these are in each."""
    codes = _LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    starts, ends = word_bounds(codes)
    begin = np.cumsum([0, *(len(text) + 1 for text in texts)])
    sizes = np.diff(np.searchsorted(starts, begin)) + 2
    last = np.cumsum(sizes) - 1
    out = np.zeros(sizes.sum(), np.uint64)
    inner = np.ones(len(out), bool)
    inner[last], inner[last - sizes + 1] = False, False
    out[inner] = span_hashes(codes, starts, ends)
    out[last], out[last - sizes + 1] = END, START
    return out, sizes


def held_out(id_: F.Column) -> F.Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of the n-gram of two parts."""
    return mix(left * np.uint64(BASE) + mix(right))


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])


def _narrowed(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in one, two, four or eight bytes each."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(k for k in ("u1", "u2", "u4", "u8") if top < 256 ** int(k[1])))


def _narrow(values: np.ndarray) -> bytes:
    return _narrowed(values).tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // size}" if size else "u1").astype(np.int64)




class Blocks:
    """How hashes are dealt: a block by `bits` leading bits, of an n-gram with a context by some bits of either part."""

    def __init__(self, tokens: int):
        self.bits = max(1, math.ceil(math.log2(max(1, tokens / BLOCK_TOKENS))))
        self.fine = self.bits + FINE_BITS
        self.dropped = np.uint64(64 - self.fine - LOW_BITS)
        #: Bits of a block's number that the child gives.
        self.child_bits = self.bits // 2

    def of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def of_parts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        context = left >> np.uint64(64 - self.bits + self.child_bits)
        if not self.child_bits:
            return context.astype(np.int64)
        return ((context << np.uint64(self.child_bits)) | (right >> np.uint64(64 - self.child_bits))).astype(np.int64)

    def column(self, key: str) -> F.Column:
        return F.shiftrightunsigned(key, 64 - self.bits).cast("int")

    def column_of_parts(self, left: str, right: str) -> F.Column:
        context = F.shiftrightunsigned(left, 64 - self.bits + self.child_bits)
        if not self.child_bits:
            return context.cast("int")
        child = F.shiftrightunsigned(right, 64 - self.child_bits)
        return F.shiftleft(context, self.child_bits).bitwiseOR(child).cast("int")


def _slice_row(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """One slice of (id, held out, text): its tokens as numbers into its list of words."""
    found, sizes = tokens([text or b"" for _, _, text in rows])
    words, numbers, times = np.unique(found, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")  # frequent words get low numbers, which take less room
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    words, numbers = words[order], place[numbers]

    def one(values, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    return pa.RecordBatch.from_arrays(
        [
            pa.array([uuid.uuid4().int >> 65], pa.int64()), one([r[0] for r in rows], id_type), one([r[1] for r in rows], pa.bool_()),
            one(sizes.astype(np.int32), pa.int32()), pa.array([words.tobytes()], pa.binary()),
            pa.array([numbers.astype(np.int32).tobytes()], pa.binary()),
        ],
        ["slice", "ids", "held", "sizes", "words", "tokens"],
    )


def slices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored slices of the documents."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, kind = [], 0, None
        for batch in batches:
            kind = batch.column("id").type
            for id_, held, text in zip(batch.column("id").to_pylist(), batch.column("held").to_pylist(), as_binary(batch.column("text")), strict=True):
                rows.append((id_, held, text.as_py()))
                size += len(rows[-1][2] or b"")
                if size >= PART_BYTES:
                    yield _slice_row(rows, kind)
                    rows, size = [], 0
        if rows:
            yield _slice_row(rows, kind)

    frame = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    schema = f"slice bigint, ids array<{kind}>, held array<boolean>, sizes array<int>, words binary, tokens binary"
    return stored(frame.mapInArrow(sliced, schema), "slices", compression="zstd")


class Slice:
    """A row of `slices`, opened."""

    def __init__(self, batch: pa.RecordBatch, row: int = 0):
        def values(name: str) -> np.ndarray:
            return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

        self.number = batch.column("slice")[row].as_py()
        self.held, sizes = values("held").astype(bool), values("sizes")
        #: Distinct words, and the text as their numbers.
        self.distinct = np.frombuffer(batch.column("words")[row].as_buffer(), np.uint64)
        self.tokens = np.frombuffer(batch.column("tokens")[row].as_buffer(), np.int32)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        #: By level and block the bitmaps of the fingerprints found often enough.
        self.found: dict[tuple[int, int], bytes] = {}
        if "found" in batch.schema.names:
            self.found = {(x["level"], x["block"]): x["bits"] for x in batch.column("found")[row].as_py() or ()}

    @property
    def words(self) -> np.ndarray:
        return self.distinct[self.tokens]

    def level(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, left, right, doc) of all words (START among them), pairs or triples, in order."""
        words, doc = self.words, self.doc
        if level == 1:
            return words, words, words, doc
        pairs, inner = joined(words[:-1], words[1:]), doc[:-1] == doc[1:]
        if level == 2:
            return pairs[inner], words[:-1][inner], words[1:][inner], doc[1:][inner]
        both = inner[:-1] & inner[1:]
        return joined(pairs[:-1], pairs[1:])[both], pairs[:-1][both], pairs[1:][both], doc[2:][both]

    def ends(self, level: int) -> np.ndarray:
        """The places in the text where the level's n-grams end, in order."""
        inside = self.doc[level - 1 :] == self.doc[: len(self.doc) - level + 1]
        return np.flatnonzero(inside) + level - 1

    def chosen(self, level: int, deal: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The level's distinct n-grams that may be in the trie, dealt to blocks: (left, right, block) by block and
        left, and for every occurrence of one its (number, place where it ends)."""
        if level == 1:
            order = np.argsort(self.distinct)
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            words = self.distinct[order]
            return words, words, deal.of(words), np.stack([number[self.tokens], self.ends(1)])
        key, left, right, _ = self.level(level)
        order = np.argsort(key)
        key = key[order]
        often = self._often(key, level, deal)
        order, key = order[often], key[often]
        first = _firsts(key)
        own = order[first]
        left, right = left[own], right[own]
        block = deal.of_parts(left, right)
        # By block, then left: the block's bits before what is left of the context's. Stable, so a slice has one order.
        rest = (left << np.uint64(deal.bits - deal.child_bits)) >> np.uint64(deal.bits)
        place = np.argsort((block.astype(np.uint64) << np.uint64(64 - deal.bits)) | rest, kind="stable")
        number = np.empty(len(own), np.int32)
        number[place] = np.arange(len(own), dtype=np.int32)
        each = np.repeat(number, np.diff(np.append(first, len(key))))
        return left[place], right[place], block[place], np.stack([each, self.ends(level)[order]])

    def _often(self, key: np.ndarray, level: int, deal: Blocks) -> np.ndarray:
        """Which of the sorted n-grams have a fingerprint that the blocks found often enough."""
        prints = key >> deal.dropped
        first = _firsts(prints)
        many = np.bincount(deal.of(key[first]), minlength=1 << deal.bits)
        bits = [np.unpackbits(np.frombuffer(self.found[level, b], np.uint8), count=many[b]) for b in np.flatnonzero(many).tolist()]
        return np.repeat(np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool), np.diff(np.append(first, len(prints))))


def _cuts(block: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each block of a sorted column with its rows."""
    first = np.append(_firsts(block), len(block))
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield int(block[low]), slice(low, high)


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _shown(batches: Iterator[pa.RecordBatch], deal: Blocks) -> Iterator[pa.RecordBatch]:
    """The fingerprints of each slice's pairs and triples by block, each with its training occurrences, 2 for more."""
    for batch in batches:
        for row in range(batch.num_rows):
            own, out = Slice(batch, row), []
            for level in (2, 3):
                key, _, _, doc = own.level(level)
                marked = np.sort(((key >> deal.dropped) << np.uint64(1)) | ~own.held[doc])
                prints = marked >> np.uint64(1)
                first = _firsts(prints)
                n = np.minimum(np.add.reduceat(marked & np.uint64(1), first), LEAST_COUNT) if len(first) else first
                prints = prints[first]
                bucket = (prints >> np.uint64(LOW_BITS)).astype(np.int64) & ((1 << FINE_BITS) - 1)
                low = prints.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : LOW_BITS // 8]
                for block, part in _cuts(deal.of(prints << deal.dropped)):
                    many = np.bincount(bucket[part], minlength=1 << FINE_BITS)
                    out.append((own.number, block, level, _narrow(many), low[part].tobytes(), _narrow(n[part])))
            yield from _table(out, _SHOWN.names, _SHOWN.types).to_batches() if out else ()


_SHOWN = pa.schema([("slice", pa.int64()), ("block", pa.int32()), ("level", pa.int32()), ("many", pa.binary()), ("low", pa.binary()), ("n", pa.binary())])


def _frequent(rows: pa.Table) -> pa.Table:
    """For each slice's fingerprints of one block and level, which reach LEAST_COUNT in all."""
    names = ["slice", "block", "level", "bits"]
    width = 1 << FINE_BITS
    lows = [np.pad(np.frombuffer(x, np.uint8).reshape(-1, LOW_BITS // 8), ((0, 0), (0, 1))).view("<u4").ravel() for x in rows.column("low").to_pylist()]
    many = [_wide(x, width) for x in rows.column("many").to_pylist()]
    n = np.concatenate([_wide(x, len(low)) for x, low in zip(rows.column("n").to_pylist(), lows, strict=True)])
    prints = np.concatenate([(np.repeat(np.arange(width), m).astype(np.uint64) << np.uint64(LOW_BITS)) | low for m, low in zip(many, lows, strict=True)])
    order = np.argsort(prints)
    first = _firsts(prints[order])
    total = np.add.reduceat(n[order], first) if len(first) else first
    often = np.zeros(len(prints), bool)
    often[order] = np.repeat(total >= LEAST_COUNT, np.diff(np.append(first, len(prints))))
    bits = [np.packbits(x).tobytes() for x in np.split(often, np.cumsum([len(x) for x in lows])[:-1])]
    return pa.table([*(rows.column(c) for c in names[:3]), pa.array(bits, pa.binary())], names)


def _contexts(left: np.ndarray) -> tuple[bytes, bytes]:
    """Runs of equal contexts: the contexts, and how many children each has."""
    first = _firsts(left)
    return left[first].tobytes(), _narrow(np.diff(np.append(first, len(left))))


def _lefts(lefts: bytes, many: bytes) -> np.ndarray:
    contexts = np.frombuffer(lefts, np.uint64)
    return np.repeat(contexts, _wide(many, len(contexts)))


def _sent(own: Slice, level: int, deal: Blocks) -> pa.Table:
    """The parts and training counts of a slice's n-grams that training documents hold, by block."""
    left, right, block, (each, end) = own.chosen(level, deal)
    n = np.bincount(each, ~own.held[own.doc[end]], len(left)).astype(np.int64)
    kept = n > 0
    left, right, block, n = left[kept], right[kept], block[kept], n[kept]
    rows = [(b, *_contexts(left[k]), right[k].tobytes() if level > 1 else b"", _narrow(n[k])) for b, k in _cuts(block)]
    return _table(rows, ["block", "lefts", "many", "rights", "n"], [pa.int32(), *[pa.binary()] * 4])


def _entries(rows: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, left, right, training count) of the entries of one block that are in the trie, by key."""
    left, right, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for row in rows.to_pylist():
        left.append(_lefts(row["lefts"], row["many"]))
        right.append(np.frombuffer(row["rights"], np.uint64) if level > 1 else left[-1])
        n.append(_wide(row["n"], len(left[-1])))
    left, right, n = (np.concatenate(x) for x in (left, right, n))
    key = joined(left, right) if level > 1 else left
    order = np.argsort(key)
    first = _firsts(key[order])
    total = np.add.reduceat(n[order], first) if len(first) else n[:0]
    kept = total >= (LEAST_COUNT if level > 1 else 1)
    at = order[first][kept]
    return key[at], left[at], right[at], total[kept]


def _counted(rows: pa.Table, level: int) -> pa.Table:
    """The words or pairs of one block that are in the trie, with their training counts."""
    key, left, right, n = _entries(rows, level)
    columns = {"key": key} if level == 1 else {"key": key, "left": left, "right": right}
    return pa.table({name: pa.array(x.view(np.int64)) for name, x in columns.items()} | {"n": pa.array(n)})


def _leaves(rows: pa.Table, deal: Blocks) -> pa.Table:
    """One block of triples: a row with its trie, then one for each context with the mass that its children here take."""
    _, left, right, n = _entries(rows, 3)
    block, contexts = rows.column("block")[0].as_py(), np.zeros(0, np.uint64)
    tries, mass = [], np.zeros(0)
    if len(n):
        columns = [np.full(len(n), block), np.full(len(n), 3), left.view(np.int64), right.view(np.int64), np.zeros(len(n)), n]
        tries = _block(pa.table(columns, ["block", "level", "left", "right", "value", "n"]), deal).column("trie").to_pylist()
        order = np.argsort(left)
        first = _firsts(left[order])
        contexts, mass = left[order][first], np.add.reduceat(n[order] - DISCOUNT, first)
    none = len(tries)
    return pa.table(
        [
            pa.array([block] * (none + len(contexts)), pa.int32()), pa.array(tries + [None] * len(contexts), pa.binary()),
            pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(contexts.view(np.int64))]), pa.concat_arrays([pa.nulls(none, pa.float64()), pa.array(mass)]),
        ],
        ["block", "trie", "left", "mass"],
    )


def _block(rows: pa.Table, deal: Blocks) -> pa.Table:
    """One block of the trie.

    Words: hashes in order, values and counts. Pairs and triples: contexts in order, pointers to their first child, and
    the children in order within each context, each told by its context's number and the leading bits of its right part
    below the block's. Values and counts stand in the children's order.
    """
    level, left, right, value, n = (rows.column(c).to_numpy() for c in ("level", "left", "right", "value", "n"))
    left, right, parts = left.view(np.uint64), right.view(np.uint64), {}
    for k in (1, 2, 3):
        of = np.flatnonzero(level == k)
        if k == 1:
            of = of[np.argsort(left[of])]
            parts |= {"words": EliasFano.of(left[of]), "values1": Quantised.of(value[of], 16), "counts": _narrowed(n[of])}
            continue
        of = of[np.lexsort((right[of], left[of]))]
        first = _firsts(left[of])
        contexts = left[of][first]
        pointers = np.append(first, len(of))
        number = np.repeat(np.arange(len(contexts)), np.diff(pointers))
        parts |= {
            f"contexts{k}": EliasFano.of(contexts), f"pointers{k}": EliasFano.of(pointers),
            f"children{k}": EliasFano.of(_label(number, right[of], len(contexts), deal)), f"values{k}": Quantised.of(value[of], 16), f"counts{k}": _narrowed(n[of]),
        }
    return pa.table([pa.array([rows.column("block")[0].as_py()], pa.int32()), pa.array([elias_fano.packed(parts)], pa.binary())], ["block", "trie"])


def _label(context: np.ndarray, right: np.ndarray, contexts: int, deal: Blocks) -> np.ndarray:
    """A child by its context's number, so that the labels rise over all contexts, and its right part's leading bits."""
    width = np.uint64(63 - contexts.bit_length())
    return (context.astype(np.uint64) << width) | ((right << np.uint64(deal.child_bits)) >> (np.uint64(64) - width))


class Trie:
    """A block of the trie in a memory-mapped file."""

    def __init__(self, path: str, deal: Blocks):
        self.parts, self.deal = elias_fano.read(path), deal

    def word(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(value, count, known) of words."""
        words = self.parts["words"]
        at, known = words.successor(keys, np.zeros(len(keys), np.int64), np.full(len(keys), words.size))
        value, count = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
        value[known], count[known] = self.parts["values1"].get(at[known]), self.parts["counts"][at[known]]
        return value, count, known

    def child(self, level: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, known) of n-grams."""
        asked, place, found = self._place(level, left, right)
        value = np.zeros(len(left))
        value[asked] = self.parts[f"values{level}"].get(place)
        return value, found

    def counted(self, level: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, count) of n-grams, 0 where unknown."""
        asked, place, _ = self._place(level, left, right)
        value, count = np.zeros(len(left)), np.zeros(len(left), np.int64)
        value[asked], count[asked] = self.parts[f"values{level}"].get(place), self.parts[f"counts{level}"][place]
        return value, count

    def _place(self, level: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which n-grams are known, their places, and for each whether it is known: the context among the contexts, then
        the child in the context's range."""
        contexts, pointers, children = (self.parts[f"{x}{level}"] for x in ("contexts", "pointers", "children"))
        first = _firsts(left)
        at, known = contexts.successor(left[first], np.zeros(len(first), np.int64), np.full(len(first), contexts.size))
        begin, end = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        begin[known], end[known] = pointers.get(at[known]).astype(np.int64), pointers.get(at[known] + 1).astype(np.int64)
        runs = np.diff(np.append(first, len(left)))
        asked = np.flatnonzero(np.repeat(known, runs))
        label = _label(np.repeat(at, runs)[asked], right[asked], contexts.size, self.deal)
        place, hit = children.successor(label, np.repeat(begin, runs)[asked], np.repeat(end, runs)[asked])
        found = np.zeros(len(left), bool)
        found[asked] = hit
        return asked[hit], place[hit], found


def _asked(own: Slice, deal: Blocks) -> pa.Table:
    """The parts of a slice's n-grams that may be in the trie, by level and block."""
    rows = []
    for level in (1, 2, 3):
        left, right, block, _ = own.chosen(level, deal)
        rows += [(own.number, level, b, *_contexts(left[k]), right[k].tobytes() if level > 1 else b"") for b, k in _cuts(block)]
    return _table(rows, ["slice", "level", "block", "lefts", "many", "rights"], [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3])


def _opened(data: bytes, deal: Blocks) -> Trie:
    handle, path = tempfile.mkstemp(prefix="trie-")
    try:
        with os.fdopen(handle, "wb") as file:
            file.write(data)
        return Trie(path, deal)
    finally:
        os.unlink(path)  # the map keeps it until the block is done


def _answered(rows: pa.Table, model: pa.Table, deal: Blocks) -> pa.Table:
    """For each slice's n-grams of one block their counts in the trie, 0 where it has none; for words and pairs that it
    has also their weights as contexts."""
    names, kinds, out = ["slice", "level", "block", "counts", "weights"], [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()], []
    tries, asked = {x["level"]: x["trie"] for x in model.to_pylist()} if rows.num_rows else {}, rows.to_pylist()
    for level in (1, 2, 3):
        own = [row for row in asked if row["level"] == level]
        if not own:
            continue
        # all slices' n-grams at once: a message alone is too short to be worth a search
        lefts = [_lefts(row["lefts"], row["many"]) for row in own]
        left = np.concatenate(lefts)
        weight, count = np.zeros(len(left)), np.zeros(len(left), np.int64)
        if level in tries:
            trie = _opened(tries[level], deal)
            weight, count = trie.word(left)[:2] if level == 1 else trie.counted(level, left, np.frombuffer(b"".join(row["rights"] for row in own), np.uint64))
        at = np.cumsum([len(x) for x in lefts])[:-1]
        for row, n, w in zip(own, np.split(count, at), np.split(weight, at), strict=True):
            out.append((row["slice"], level, row["block"], _narrow(n), w[n > 0].tobytes() if level < 3 else b""))
    return _table(out, names, kinds)


def _scored(rows: pa.Table, answers: pa.Table, deal: Blocks, every: float, kind: pa.DataType) -> pa.Table:
    """One row a document of a slice. `every` is what the words' probabilities are shares of."""
    batch = rows.combine_chunks().to_batches()[0]
    own, given = Slice(batch), {(x["level"], x["block"]): x for x in answers.to_pylist()}
    size = len(own.tokens)
    # at the place where an n-gram ends: its count, and its weight as a context
    n, weight = np.zeros((4, size), np.int64), np.ones((3, size))
    for level in (1, 2, 3):
        left, _, block, (each, end) = own.chosen(level, deal)
        counts, weights = np.zeros(len(left), np.int64), np.ones(len(left))
        for b, part in _cuts(block):
            answer = given[level, b]
            counts[part] = _wide(answer["counts"], part.stop - part.start)
            if level < 3:
                weights[part][counts[part] > 0] = np.frombuffer(answer["weights"])
        n[level, end] = counts[each]
        if level < 3:
            weight[level, end] = weights[each]
    p = (n[1] + 1) / every
    for level in (2, 3):
        end, lower = own.ends(level), p
        p = lower.copy()
        own_n, left_n = n[level, end], n[level - 1, end - 1]
        p[end] = weight[level - 1, end - 1] * lower[end] + np.where(own_n > 0, own_n - DISCOUNT, 0) / np.maximum(left_n, 1)
    word = own.words != START
    doc, known = own.doc[word], n[1, word]
    docs = len(own.held)
    sums = [np.bincount(doc, minlength=docs), np.bincount(doc[known > 0], minlength=docs), np.bincount(doc, np.log10(known + 1), docs), np.bincount(doc, np.log10(p[word]), docs)]
    ids, held = batch.column("ids")[0].values, batch.column("held")[0].values
    return pa.table([ids.cast(kind), held, *map(pa.array, sums)], ["id", "held_out", "n_tokens", "n_known", "logs", "value"])


def _settled(frame: DataFrame, name: str) -> DataFrame:
    """`frame` stored, and the files of the shuffles that made it dropped."""
    conf, key = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return stored(frame, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def _dropped(frame: DataFrame) -> None:
    """Removes the folder of a stored table."""
    jvm = frame.sparkSession.sparkContext._jvm
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _weighed(own: DataFrame, mass: DataFrame) -> DataFrame:
    """With `value`: the weight of an entry as a context, what the entries after it leave to their lower n-grams."""
    taken = mass.select(F.col("left").alias("key"), "mass")
    return own.join(taken.hint("shuffle_hash"), "key", "left").withColumn("value", 1 - F.coalesce("mass", F.lit(0.0)) / F.col("n"))


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the documents that are not held out and scores all. One row a document: id, held_out, n_tokens,
    n_known, train_tokens, base_score (add-one word frequencies) and score (the model's log10 probability of the text)."""
    all_ = slices(docs, id_col, text_col)
    sizes = all_.select(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
    deal = Blocks(sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    kind = docs.schema[id_col].dataType
    shown = all_.drop("ids").mapInArrow(partial(_shown, deal=deal), "slice bigint, block int, level int, many binary, low binary, n binary")
    found = _settled(shown.groupBy("block", "level").applyInArrow(_frequent, "slice bigint, block int, level int, bits binary"), "frequent")
    bits = found.groupBy("slice").agg(F.collect_list(F.struct("level", "block", "bits")).alias("found"))
    known = _settled(all_.join(bits.hint("shuffle_hash"), "slice", "left"), "known")
    for table in (all_, found):
        _dropped(table)
    of_words = known.drop("ids")

    def each_slice(of_words: DataFrame, function: Callable[[Slice], pa.Table], schema: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    yield from function(Slice(batch, row)).to_batches()

        return of_words.mapInArrow(run, schema)

    def sent(level: int):
        return each_slice(of_words, partial(_sent, level=level, deal=deal), "block int, lefts binary, many binary, rights binary, n binary").groupBy("block")

    def counted(level: int) -> DataFrame:
        names = {1: "key bigint, n bigint", 2: "key bigint, left bigint, right bigint, n bigint"}[level]
        return _settled(sent(level).applyInArrow(lambda rows: _counted(rows, level), names), f"counted-{level}")

    def placed(level: int, entries: DataFrame, block: F.Column) -> DataFrame:
        """The level's blocks of the trie."""
        found = entries.select(F.lit(level).alias("level"), "left", "right", "value", "n", block.alias("block"))
        return _settled(found.groupBy("block").applyInArrow(lambda rows: _block(rows, deal), "block int, trie binary"), f"trie-{level}")

    leaves = _settled(sent(3).applyInArrow(lambda rows: _leaves(rows, deal), "block int, trie binary, left bigint, mass double"), "leaves")
    pairs, words = counted(2), counted(1)
    start = int(START.view(np.int64))
    total = words.where(F.col("key") != start).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    mass = pairs.groupBy("left").agg((F.sum("n") - DISCOUNT * F.count("*")).alias("mass"))
    weighed = _weighed(words, mass).select(F.col("key").alias("left"), F.lit(0).cast("bigint").alias("right"), "value", "n")
    tries = [placed(1, weighed, deal.column("left"))]
    _dropped(words)
    mass = leaves.where("trie IS NULL").groupBy("left").agg(F.sum("mass").alias("mass"))
    tries.append(placed(2, _weighed(pairs, mass), deal.column_of_parts("left", "right")))
    _dropped(pairs)
    tries.append(leaves.where("trie IS NOT NULL").select("block", "trie"))
    model = reduce(DataFrame.unionByName, [trie.select(F.lit(k).alias("level"), "block", "trie") for k, trie in enumerate(tries, 1)])
    id_type, every = to_arrow_type(kind), float(total["n"] + total["words"] + 1)

    def scored_in(turn: int) -> DataFrame:
        mine = known.where(F.pmod("slice", F.lit(TURNS)) == turn)
        asked = each_slice(mine.drop("ids"), partial(_asked, deal=deal), "slice bigint, level int, block int, lefts binary, many binary, rights binary")
        answers = asked.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(
            lambda rows, blocks: _answered(rows, blocks, deal), "slice bigint, level int, block int, counts binary, weights binary"
        )
        met = mine.groupBy("slice").cogroup(answers.groupBy("slice"))
        out = f"id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, logs double, value double"
        return _settled(met.applyInArrow(lambda rows, given: _scored(rows, given, deal, every, id_type), out), "scored")

    scored = reduce(DataFrame.unionByName, [scored_in(turn) for turn in range(TURNS)])
    for table in (known, *tries):
        _dropped(table)
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(every))
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total["n"]).cast("bigint").alias("train_tokens"),
        F.round(base, 9).alias("base_score"),
        F.round("value", 9).alias("score"),
    )
