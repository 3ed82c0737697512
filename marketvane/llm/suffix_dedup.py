"""Removal of long repeated byte strings by suffix arrays.

Every byte covered by a string of `LENGTH` bytes that also starts earlier (in a document of a smaller id,
or earlier in the same document) is removed; strings are judged on the input.

One suffix array over all texts can't be dealt out, so equal strings are brought together by content:

1. Each window of LENGTH bytes belongs to its anchor, the least-hashed gram of GRAM bytes in it. Equal
   windows have equal anchors at equal offsets. Windows in a row with one anchor make a stretch, so a text
   is a short list of stretches: anchor, hash of the stretch's bytes, place.
2. Equal stretches are collapsed before and after the shuffle by anchor: the earliest stays, the others are
   repeats as a whole. An anchor with one kind of stretch is settled. Where several kinds of stretches
   share an anchor, their texts decide.
3. These stretches are cut to blocks of at most BLOCK window offsets from the anchor; all windows of a block
   share a core of LENGTH - BLOCK + 1 bytes, which is the key they are dealt by. So a common anchor in
   in many contexts spreads out, and equal windows still meet.
4. A core with more than ARRAY_BYTES of blocks (a passage that many documents have in different surroundings) is
   told apart by whole windows: each goes by 128 bits of its hash, equal ones collapsed to the earliest before and
   after the shuffle, so only equal windows share a key.
5. Of all other cores, in each task the blocks' texts form strings of about ARRAY_BYTES. Its suffixes that are smaller than their successors are
   sorted directly, the others induced from them bucket by bucket, and windows whose neighbour in that order
   shares LENGTH bytes are repeats, but for the earliest of each run.

Defined cases: a null text is an empty one; texts under LENGTH bytes lose nothing. Rows of one id with
different texts are separate documents, in the order of a hash of their texts; rows equal in id and text are
one document, whose result each of them gets. A null id comes first. An empty table gives an empty result, and a text
of any length is cut into stretches. Other columns pass through untouched in `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, byte_lengths, slices, stored, with_tag
from .rolling import PIECE, gram_hashes, inner_hashes

LENGTH = 100
GRAM = 28
#: Window offsets from the anchor in one block.
BLOCK = 32
#: Bytes of text after which a suffix array takes no further core, and the most that a core may bring.
ARRAY_BYTES = 1 << 20

_LOW = np.uint64((1 << 18) - 1)


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, told apart by `depth` bytes at least.

    Two stages: the suffixes smaller than their successors are sorted directly; a larger one comes right
    after its successor's place is known, so a scan of the buckets by first byte, in order, places all
    larger suffixes. Only the wanted ones, and those that lead to them, are placed.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    differs = np.append(text[:-1] != text[1:], True)
    rises = np.append(text[:-1] < text[1:], False)
    at = np.arange(n)
    run_end = np.minimum.accumulate(np.where(differs, at, n)[::-1])[::-1]
    smaller = rises[run_end]
    next_smaller = np.minimum.accumulate(np.where(smaller, at, n - 1)[::-1])[::-1]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.flatnonzero(wanted), 1)
    np.add.at(cover, next_smaller[wanted] + 1, -1)
    needed = np.cumsum(cover[:-1]) > 0

    direct = np.flatnonzero(needed & smaller)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(heads).view(f"S{depth}").ravel(), kind="stable")]
    limits = np.searchsorted(text[direct], np.arange(257))

    larger = needed & ~smaller
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if larger[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))
    placed = []
    for c in range(256):
        scanned = []
        fresh = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(fresh):
            scanned.append(fresh)
            before = fresh[fresh > 0] - 1
            fresh = before[larger[before] & (text[before] == c)]
        scanned.append(direct[limits[c] : limits[c + 1]])
        bucket = np.concatenate(scanned)
        placed.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (text[before] > c)]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            bounds = np.flatnonzero(np.diff(text[before])) + 1
            for part in np.split(before, bounds):
                waiting[text[part[0]]].append(part)
    order = np.concatenate(placed)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place but the first: bytes that the suffix shares with the one before it, up to depth."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(padded, depth)
    out = np.empty(max(0, len(order) - 1), np.int64)
    for at in range(0, len(out), 1 << 14):
        differ = heads[order[at : at + (1 << 14)][: len(out) - at]] != heads[order[at + 1 : at + 1 + (1 << 14)]]
        out[at : at + len(differ)] = np.where(differ.any(1), differ.argmax(1), depth)
    return out


def repeated_starts(text: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """The valid positions whose next `length` bytes also start at an earlier valid position."""
    order = suffix_order(text, valid, length)
    if not len(order):
        return order
    run = np.concatenate([[0], np.cumsum(common_prefixes(text, order, length) < length)])
    first = np.full(run[-1] + 1, len(text))
    np.minimum.at(first, run, order)
    return np.sort(order[order != first[run]])


def stretches(text: bytes) -> tuple[np.ndarray, ...]:
    """(anchor hash, hash of the bytes, start, windows, offset of the anchor) of each stretch of a text."""
    codes = np.frombuffer(text, np.uint8)
    total = len(codes) - LENGTH + 1
    if total <= 0:
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    found = []
    span = LENGTH - GRAM + 1
    for base in range(0, total, PIECE):  # a stretch that crosses the edge of a piece is cut there, in any text
        piece = codes[base : base + PIECE + LENGTH - 1]
        grams = gram_hashes(piece, GRAM)
        least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        end = np.append(start[1:], len(least))
        anchor = (least[start] & _LOW).astype(np.int64)
        content = inner_hashes(piece, start, end + LENGTH - 1)
        found.append((grams[anchor], content, start + base, end - start, anchor - start))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pack(start: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (start << 14) | (windows << 7) | offset


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 14, (at >> 7) & 127, at & 127


def _joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted by (doc, start), overlapping or touching ones made one."""
    if not len(doc):
        return doc, start, end
    reach = np.maximum.accumulate(end + doc * (int(end.max()) + 1)) - doc * (int(end.max()) + 1)
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    return doc[new], start[new], reach[last]


_FOUND = ["repeat", "anchor", "content", "id", "tag", "at"]


def _stretched(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The stretches of some documents, equal ones collapsed; and the spans of the repeats among them."""
    order = pc.sort_indices(batch.select(["id", "tag"]), sort_keys=[("id", "ascending"), ("tag", "ascending")], null_placement="at_start")
    batch = batch.take(order)
    parts = [stretches(text or b"") for text in as_binary(batch.column("text")).to_pylist()]
    anchor, content, start, windows, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.lexsort((content, anchor))  # stable, so the earliest of equal ones comes first
    a, c = anchor[order], content[order]
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])[: len(order)]
    kept, again = order[first], np.sort(order[~first])
    r_doc, r_start, r_end = _joined(doc[again], start[again], start[again] + windows[again] + LENGTH - 1)
    who = np.concatenate([doc[kept], r_doc])
    columns = [
        pa.array(np.arange(len(who)) >= len(kept)),
        pa.array(np.concatenate([anchor[kept].view(np.int64), r_start * 7919 + r_doc])),
        pa.array(np.concatenate([content[kept].view(np.int64), r_end])),
        batch.column("id").take(pa.array(who)),
        batch.column("tag").take(pa.array(who)),
        pa.array(np.concatenate([_pack(start[kept], windows[kept], offset[kept]), r_start])),
    ]
    return pa.RecordBatch.from_arrays(columns, _FOUND)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From stretches sorted by (anchor, content, id, tag, at): spans of repeats (`end` set), and the first
    stretches of each content where an anchor has several (`end` null). Holds one earlier row."""
    names = ["id", "tag", "at", "end"]
    held: pa.RecordBatch | None = None  # the first row of the last anchor, while its anchor has one content
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        repeat = batch.column("repeat").to_numpy(zero_copy_only=False)
        if repeat.all():
            stretch = batch.slice(0, 0)
        else:
            stretch = batch.filter(pa.array(~repeat)) if repeat.any() else batch
        spans = batch.filter(pa.array(repeat)) if repeat.any() else batch.slice(0, 0)
        yield pa.RecordBatch.from_arrays([spans.column(c) for c in ("id", "tag", "at", "content")], names)
        n = stretch.num_rows
        if not n:
            continue
        a, c = (stretch.column(x).to_numpy() for x in ("anchor", "content"))
        same_a = np.concatenate([[last is not None and last[0] == a[0]], a[1:] == a[:-1]])
        same_c = same_a & np.concatenate([[last is not None and last[1] == c[0]], c[1:] == c[:-1]])
        later = ~same_c & same_a  # the first of a further content of its anchor
        group = np.cumsum(~same_a)  # 0: the anchor that the last batch ended with
        several = np.bincount(group[later], minlength=group[-1] + 1) > 0
        if several[0] and held is not None:
            yield held
            held = None
        emit = later | (~same_a & several[group])
        chosen = stretch.filter(pa.array(emit))
        nulls = pa.nulls(chosen.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(chosen.column(x) for x in ("id", "tag", "at")), nulls], names)
        if group[-1] > 0:
            if several[-1]:
                held = None
            else:
                row = stretch.slice(int(np.flatnonzero(~same_a)[-1]), 1)
                held = pa.RecordBatch.from_arrays([*(row.column(x) for x in ("id", "tag", "at")), pa.nulls(1, pa.int64())], names)
        last = a[-1], c[-1]
        copies = stretch.filter(pa.array(same_c))
        start, windows, _ = _unpack(copies.column("at").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [copies.column("id"), copies.column("tag"), pa.array(start), pa.array(start + windows + LENGTH - 1)], names
        )


def _blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The blocks of the stretches that each document has to show."""
    rows: list[tuple] = []
    for k, (text, places) in enumerate(zip(as_binary(batch.column("text")), batch.column("places").to_pylist(), strict=True)):
        if not places:
            continue
        text = text.as_py()
        codes = np.frombuffer(text, np.uint8)
        start, windows, offset = _unpack(np.sort(np.array(places, np.int64)))
        anchor = start + offset
        for block in range((LENGTH - GRAM) // BLOCK + 1):
            low, high = block * BLOCK, block * BLOCK + BLOCK - 1  # offsets of the anchor in the block's windows
            first = np.maximum(start, anchor - high)
            last = np.minimum(start + windows - 1, anchor - low)
            has = first <= last
            if has.any():
                core = anchor[has] - low
                size = LENGTH - BLOCK + 1  # the bytes that windows of all these offsets share
                for f, t, x in zip(first[has].tolist(), last[has].tolist(), core.tolist(), strict=True):
                    key = int.from_bytes(blake2b(text[x : x + size], digest_size=8).digest(), "little", signed=True)
                    rows.append((key, k, f, text[f : t + LENGTH]))
    if not rows:
        rows_k = pa.array([], pa.int64())
        cores = starts = texts = []
    else:
        cores, who, starts, texts = zip(*rows, strict=True)
        rows_k = pa.array(who, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(cores, pa.int64()), batch.column("id").take(rows_k), batch.column("tag").take(rows_k), pa.array(starts, pa.int64()), pa.array(texts, pa.binary())],
        ["core", "id", "tag", "at", "text"],
    )


def _array_spans(rows: pa.Table) -> pa.RecordBatch:
    """The spans of repeats among blocks that are sorted by (core, id, tag, at), by one suffix array."""
    texts = rows.column("text").to_pylist()
    lengths = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(lengths)])
    text = np.frombuffer(b"".join(texts), np.uint8)
    valid = np.ones(len(text), bool)
    for k in range(1, LENGTH):
        valid[begin[1:] - k] = False
    found = repeated_starts(text, valid, LENGTH)
    row = np.searchsorted(begin, found, "right") - 1
    start = rows.column("at").to_numpy()[row] + found - begin[row]
    row, start, end = _joined(row, start, start + LENGTH)
    who = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [rows.column("id").combine_chunks().take(who), rows.column("tag").combine_chunks().take(who), pa.array(start), pa.array(end)],
        ["id", "tag", "at", "end"],
    )


def _by_size(blocks: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The blocks of the cores that a suffix array can hold, and those of all others, if any."""
    sizes = blocks.groupBy("core").agg(F.sum(F.octet_length("text")).alias("size"))
    large = stored(sizes.where(F.col("size") > ARRAY_BYTES).select("core"), "large-cores")
    if not large.limit(1).count():
        return blocks, None
    return blocks.join(large, "core", "left_anti"), blocks.join(large, "core", "left_semi")


_WINDOWS = ["high", "low", "id", "tag", "at", "end"]


def _windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The windows of some blocks, by hash, of equal ones the earliest (`end` null); and spans of the others."""
    keys = [(c, "ascending") for c in ("id", "tag", "at")]
    batch = batch.take(pc.sort_indices(batch.select(["id", "tag", "at"]), sort_keys=keys, null_placement="at_start"))
    seen: set[bytes] = set()
    windows: list[tuple] = []
    spans: list[tuple] = []
    for k, (text, start) in enumerate(zip(batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True)):
        reach = -1
        for at in range(len(text) - LENGTH + 1):
            name = blake2b(text[at : at + LENGTH], digest_size=16).digest()
            if name not in seen:
                seen.add(name)
                windows.append((name, k, start + at))
            elif at <= reach:
                reach = at + LENGTH
                spans[-1] = k, spans[-1][1], start + reach
            else:
                reach = at + LENGTH
                spans.append((k, start + at, start + reach))
    names = np.frombuffer(b"".join(w[0] for w in windows), np.int64).reshape(-1, 2)
    who = pa.array([w[1] for w in windows] + [x[0] for x in spans], pa.int64())
    nothing = pa.nulls(len(spans), pa.int64())
    columns = [pa.concat_arrays([pa.array(np.ascontiguousarray(names[:, k])), nothing]) for k in (0, 1)]
    columns += [batch.column("id").take(who), batch.column("tag").take(who)]
    columns.append(pa.array([w[2] for w in windows] + [x[1] for x in spans], pa.int64()))
    columns.append(pa.array([None] * len(windows) + [x[2] for x in spans], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, _WINDOWS)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From windows sorted by (high, low, id, tag, at): spans of all but the earliest of equal ones."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low = (batch.column(c).to_numpy() for c in ("high", "low"))
        same = np.concatenate([[last == (high[0], low[0])], (high[1:] == high[:-1]) & (low[1:] == low[:-1])])
        last = high[-1], low[-1]
        again = batch.filter(pa.array(same))
        at = again.column("at").to_numpy()
        yield pa.RecordBatch.from_arrays([again.column("id"), again.column("tag"), pa.array(at), pa.array(at + LENGTH)], ["id", "tag", "at", "end"])


def _arrayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of one core, as many as an array may hold."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for whole in batches:
        for batch in slices(whole, "text"):
            at = 0
            lengths = byte_lengths(batch.column("text")).tolist()
            for k, core in enumerate(batch.column("core").to_pylist()):
                if core != last and size >= ARRAY_BYTES:
                    yield _array_spans(pa.Table.from_batches([*held, batch.slice(at, k - at)]))
                    held, size, at = [], 0, k
                last = core
                size += lengths[k]
            held.append(batch.slice(at))
    if held:
        yield _array_spans(pa.Table.from_batches(held))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """`text` without its sorted spans."""
    upto, left = 0, []
    for start, end in spans:
        left.append(text[upto:start])
        upto = end
    return b"".join([*left, text[upto:]])


def _removed(batches: Iterator[pa.RecordBatch], as_text: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            kept, spans = [], []
            for text, found in zip(as_binary(batch.column("text")).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if found:
                    pairs = np.array(sorted((x["at"], x["end"]) for x in found))
                    _, start, end = _joined(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                    found = list(zip(start.tolist(), end.tolist(), strict=True))
                spans.append([{"at": a, "end": b} for a, b in found or ()])
                left = cut(text or b"", found or [])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            kind = pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(spans, kind)],
                ["row", "kept", "spans"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """One row a document: `row` (its columns as given, but the text), `kept` (the bytes left, or with `as_text`
    the text without code points that were cut) and `spans` (what was removed, as byte offsets [at, end), in order
    and apart)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    frame = with_tag(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*others).alias("row")))
    kind = frame.schema["id"].dataType.simpleString()

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _stretched(batch)

    found = frame.select("id", "tag", "text").mapInArrow(
        stretched, f"repeat boolean, anchor bigint, content bigint, id {kind}, tag bigint, at bigint"
    )
    settled = stored(
        found.repartition("anchor")
        .sortWithinPartitions("anchor", "content", "id", "tag", "at")
        .mapInArrow(_settled, f"id {kind}, tag bigint, at bigint, end bigint"),
        "stretches",
    )

    # Both joins read one shuffle of the texts: the same columns and rows, dealt the same way.
    doc = F.struct("id", "tag").cast(f"struct<id: {kind}, tag: bigint>")  # as nullable as the other side's
    dealt = frame.select(doc.alias("doc"), "text", "row").repartition("doc")
    places = settled.where("end is null").groupBy(F.struct("id", "tag").alias("doc")).agg(F.collect_list("at").alias("places"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _blocks(batch)

    shown = dealt.join(places, "doc", "left").select("doc.id", "doc.tag", "text", "row", "places")
    cut_out = stored(shown.mapInArrow(blocks, f"core bigint, id {kind}, tag bigint, at bigint, text binary"), "blocks")
    small, large = _by_size(cut_out)
    arrayed = (
        small.repartition("core")
        .sortWithinPartitions("core", "id", "tag", "at")
        .mapInArrow(_arrayed, f"id {kind}, tag bigint, at bigint, end bigint")
    )
    if large is not None:
        # Both branches read the same windows; stored, they are hashed once.
        windows = stored(
            large.mapInArrow(
                lambda batches: (_windows(b) for b in batches),
                f"high bigint, low bigint, id {kind}, tag bigint, at bigint, end bigint",
            ),
            "windows",
        )
        later = (
            windows.where("end is null")
            .select(*_WINDOWS[:-1])
            .repartition("high", "low")
            .sortWithinPartitions(*_WINDOWS[:-1])
            .mapInArrow(_collapsed, f"id {kind}, tag bigint, at bigint, end bigint")
        )
        arrayed = arrayed.unionByName(later).unionByName(windows.where("end is not null").select("id", "tag", "at", "end"))
    spans = (
        settled.where("end is not null")
        .unionByName(arrayed)
        .groupBy(F.struct("id", "tag").alias("doc"))
        .agg(F.collect_list(F.struct("at", "end")).alias("spans"))
    )
    row_kind = frame.schema["row"].dataType.simpleString()
    return (
        dealt.join(spans, "doc", "left")
        .select("row", "text", "spans")
        .mapInArrow(
            lambda batches: _removed(batches, as_text),
            f"row {row_kind}, kept {'string' if as_text else 'binary'}, spans array<struct<at: bigint, end: bigint>>",
        )
    )
