"""Document fingerprints by winnowing.

Every GRAM code points are hashed; of each WINDOW consecutive hashes the least is chosen, the rightmost of equal
ones, and kept with its position. Two texts that share GRAM + WINDOW - 1 code points in a row share a chosen hash,
at places that their positions give.

`compare_with_next` deals the documents out by ranges of their ids. The ranges begin at ids that occur, so the one
document that a range needs of its successor is known beforehand and dealt to both: one shuffle of the texts
serves all, and a task holds two texts at a time.

Defined cases: a null text is an empty one; an empty text has no hash, a shorter one than GRAM a single hash of
all of it. Two fingerprints without a hash are alike (1.0), one with and one without are not (0.0). Null ids come
before all others, rows of one id in the order of their texts; rows equal in both are separate documents. An empty table gives an empty
result. A text of any length is hashed in pieces. Other columns are not read, so their names don't matter.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import map_slices, slices
from .rolling import PIECE, gram_hashes, inner_hashes

GRAM = 24
WINDOW = 40
#: About so many documents between two bounds; each begins a range of its own.
RANGE_DOCS = 2000

_LAST = np.uint64(0xFFFFFFFF)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def winnow(codes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the chosen grams, by position."""
    if len(codes) <= gram:
        whole = inner_hashes(codes, np.array([0]), np.array([len(codes)]))[: len(codes)] >> np.uint64(32)
        return whole.astype(np.uint32), np.zeros(len(whole), np.int64)
    hashes = gram_hashes(codes, gram) >> np.uint64(32)
    window = min(window, len(hashes))
    chosen = []
    for base in range(0, len(hashes) - window + 1, PIECE):
        part = hashes[base : base + PIECE + window - 1]
        # the lower half counts down, so of equal hashes the rightmost is least
        least = (part << np.uint64(32)) | (_LAST - np.arange(len(part), dtype=np.uint64))
        width = 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        least = least[np.concatenate([[True], least[1:] != least[:-1]])]
        at = (_LAST - (least & _LAST)).astype(np.int64) + base
        if chosen and chosen[-1][1][-1] == at[0]:
            least, at = least[1:], at[1:]
        if len(at):
            chosen.append(((least >> np.uint64(32)).astype(np.uint32), at))
    return tuple(np.concatenate(x) for x in zip(*chosen, strict=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes."""
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a or b else 1.0


def as_text(hashes: np.ndarray) -> str:
    """The hashes by position, eight hex digits each."""
    return hashes.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, `hashes` and their `positions` in code points."""

    def winnowed(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [winnow(code_points(t or "")) for t in batch.column("text").to_pylist()]
        lists = [pa.array([f[k].astype(np.int64) for f in found], pa.list_(pa.int64())) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column("id"), *lists], ["id", "hashes", "positions"])

    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return map_slices(frame, winnowed, f"id {kind}, hashes array<bigint>, positions array<bigint>", "text").withColumnRenamed("id", id_col)


_COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions", "edited_positions"]


def _compared(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Each document with the one after it, from rows sorted by range; a range's guest comes last in it."""
    held = None  # range, id, text, hashes and positions of the document that waits for the next one
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = []
            for part, guest, id_, text in zip(
                *(batch.column(c).to_pylist() for c in ("part", "guest", "id", "text")), strict=True
            ):
                if guest and (held is None or held[0] != part):
                    continue  # a further row of the guest's id
                text = text or ""
                hashes, positions = winnow(code_points(text))
                if held is not None and held[0] == part:
                    other = edited(held[2], text)
                    changed, places = winnow(code_points(other))
                    rows.append((
                        held[1], len(held[2]), sha256(other.encode()).hexdigest(), as_text(held[3]), as_text(changed),
                        likeness(held[3], changed), likeness(held[3], hashes), held[4], places,
                    ))
                held = None if guest else (part, id_, text, hashes, positions)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_COLUMNS)
            kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), *[pa.list_(pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _COLUMNS)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: the fingerprints of its text and of its text with the last quarter taken from the next
    document (after the last: the first), how like its own are that one and the next document's, and the positions of
    both fingerprints' hashes in code points."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType
    ids = frame.select("id")
    ends = ids.agg(F.min("id").alias("least"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    sampled = ids.where((F.pmod(F.xxhash64("id"), F.lit(RANGE_DOCS)) == 0) & F.col("id").isNotNull()).distinct()
    # one bound for about RANGE_DOCS documents: ids alone, 8 bytes for some megabytes of text
    bounds = sorted({*([] if ends["least"] is None else [ends["least"]]), *(r["id"] for r in sampled.collect())})

    # The range of an id: of the bounds not above it, the last. Found by a search in each task's copy of the bounds.
    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(bounds)
        for batch in batches:
            own = batch.column("id").to_pylist()
            part = [0 if i is None else bisect_right(bounds, i) for i in own]
            before = []
            for i, p in zip(own, part, strict=True):
                first = i is None if ends["nulls"] else i == bounds[0]
                to = [p - 1] if i is not None and i in known and (p > 1 or ends["nulls"]) else []
                before.append([*to, *([len(bounds)] if first else [])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), pa.array(part, pa.int32()), pa.array(before, pa.list_(pa.int32()))],
                ["id", "text", "part", "before"],
            )

    dealt = frame.mapInArrow(ranged, f"id {kind.simpleString()}, text string, part int, before array<int>")
    homes = F.concat(
        F.array(F.struct(F.col("part"), F.lit(False).alias("guest"))),
        F.transform("before", lambda p: F.struct(p.alias("part"), F.lit(True).alias("guest"))),
    )
    rows = dealt.select("id", "text", F.inline(homes)).repartition("part").sortWithinPartitions("part", "guest", "id", "text")
    schema = (
        f"id {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, positions array<bigint>, edited_positions array<bigint>"
    )
    id_type = to_arrow_type(kind)
    return rows.mapInArrow(lambda batches: _compared(batches, id_type), schema).withColumnRenamed("id", id_col)
