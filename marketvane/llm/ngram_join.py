"""N-gram Jaccard join with Bayesian pruning of MinHash candidates.

Texts are sets of five-word shingles; two texts are linked from a Jaccard similarity of 0.8.

1. Equal texts become one class, so copies are never compared with each other.
2. Every class gets a MinHash signature. Classes that share a band of it are candidates; a band's classes
   all hang on its least one, and the connected components of these stars are neighbourhoods. Every
   candidate pair lies within one neighbourhood, and no pair is ever written as a row.
3. Neighbourhoods are compared in cells of bounded size: a large one is cut into blocks, a cell holds two
   of them. Within a cell the signatures are compared some values at a time, and a pair is dropped as soon
   as the posterior probability (uniform prior) that its similarity reaches the threshold, given the
   matches so far, falls below the tolerance. What is left is verified on the whole shingle sets.
4. A cell returns a row for each linked class: its number of links, and a spanning star of the links.

With 32 bands of 4 values a pair at exactly 0.8 shares no band with probability 5e-8, and less above.

Defined cases: a null text, an empty one and one of spaces have no shingles: such documents are linked to
nothing and are a class each. A text of one to four words is one shingle of all its words. Rows with equal
ids are separate documents; of equal texts or linked classes the least id speaks for all, so ties need no rule. An
empty table has no classes. A text of any length is sketched whole, by one task. Other columns are neither read nor
returned, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, map_slices, use_checkpoints
from .components import components
from .rolling import mix, shingles

WORDS = 5
THRESHOLD = 0.8
BANDS = 32
BAND_VALUES = 4
VALUES = BANDS * BAND_VALUES
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-9
#: Signature values compared between two looks at the posterior.
STEP = 16
#: Classes in a block; a cell compares two blocks at most.
BLOCK = 256


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, (2, VALUES), np.uint64)
    return numbers[0] | np.uint64(1), numbers[1]


def signature(grams: np.ndarray) -> np.ndarray:
    """The MinHash values of a shingle set."""
    factor, shift = _permutations()
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 512):
        np.minimum(least, (grams[at : at + 512, None] * factor + shift).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands(values: np.ndarray) -> np.ndarray:
    """A key for each band of a signature; equal keys of different bands are apart."""
    wide = values.reshape(BANDS, BAND_VALUES).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_VALUES):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, k])
    return key.view(np.int64)


@cache
def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """Values compared -> the fewest matches that leave the posterior at or above the tolerance.

    With a uniform prior, m matches of n give similarity a Beta(m + 1, n - m + 1) posterior; its upper
    tail is a binomial sum.
    """
    out = {}
    for n in range(STEP, VALUES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def candidate_pairs(left: np.ndarray, right: np.ndarray | None, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of signature rows that outlive the posterior test; within `left` if `right` is None."""
    needed = least_matches(threshold, tolerance)
    other = left if right is None else right
    firsts, seconds = [], []
    for row in range(len(left)):
        rest = np.arange(row + 1 if right is None else 0, len(other))
        matches = np.zeros(len(rest), np.int64)
        for n, least in needed.items():
            matches += (other[rest, n - STEP : n] == left[row, n - STEP : n]).sum(1)
            alive = matches >= least
            rest, matches = rest[alive], matches[alive]
            if not len(rest):
                break
        firsts.append(np.full(len(rest), row))
        seconds.append(rest)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *firsts]), np.concatenate([empty, *seconds])


def linked_pairs(
    left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of shingle sets at or above the threshold: pruned by signatures, then verified exactly."""
    signed = np.array([signature(s) for s in left]), None if right is None else np.array([signature(s) for s in right])
    first, second = candidate_pairs(*signed, threshold, tolerance)
    other = left if right is None else right
    used = np.unique(second)
    numbers = np.unique(np.concatenate([np.zeros(0, np.uint64), *(other[k] for k in used)]))
    local = {k: np.searchsorted(numbers, other[k]) for k in used}
    mark = np.zeros(len(numbers), bool)
    keep = np.zeros(len(first), bool)
    for row in np.unique(first):
        at = np.searchsorted(numbers, left[row])
        at = at[numbers[np.minimum(at, len(numbers) - 1)] == left[row]]
        mark[at] = True
        lo, hi = np.searchsorted(first, [row, row + 1])
        for pair in range(lo, hi):
            partner = second[pair]
            shared = int(mark[local[partner]].sum())
            union = len(left[row]) + len(other[partner]) - shared
            keep[pair] = shared >= ceil(threshold * union - 1e-9)
        mark[at] = False
    return first[keep], second[keep]


def _compare(nodes: list[bytes], sides: list[int], texts: list[bytes], cell: tuple) -> Iterator[tuple]:
    """(node, links, hub) for each linked class of a cell."""
    _, low, high = cell
    grams = [shingles(t, WORDS) for t in texts]
    at = [[k for k, side in enumerate(sides) if side == block] for block in ((low,) if low == high else (low, high))]
    first, second = linked_pairs([grams[k] for k in at[0]], None if low == high else [grams[k] for k in at[1]])
    first, second = np.array(at[0], np.int64)[first], np.array(at[-1], np.int64)[second]
    links = np.bincount(np.concatenate([first, second]), minlength=len(nodes)) if len(first) else np.zeros(len(nodes), int)
    parent = list(range(len(nodes)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in zip(first.tolist(), second.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            a, b = (a, b) if nodes[a] < nodes[b] else (b, a)
            parent[b] = a
    for k in np.flatnonzero(links).tolist():
        yield nodes[k], int(links[k]), nodes[find(k)]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of rows that are sorted by cell; one cell is held at a time."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        node, links, hub = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.array(links, pa.int64()), pa.array(hub, pa.binary())], ["node", "links", "hub"]
        )

    cell, held, done = None, ([], [], []), []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high")), strict=True)
        rows = (batch.column("node").to_pylist(), batch.column("side").to_pylist(), as_binary(batch.column("text")))
        for k, key in enumerate(keys):
            if key != cell:
                if len(held[0]) > 1:
                    done += _compare(*held, cell)
                cell, held = key, ([], [], [])
            held[0].append(rows[0][k])
            held[1].append(rows[1][k])
            held[2].append(rows[2][k].as_py())
        if len(done) > 5000:
            yield out(done)
            done = []
    if len(held[0]) > 1:
        done += _compare(*held, cell)
    yield out(done)


def _sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys = []
    for text in as_binary(batch.column("text")).to_pylist():
        grams = shingles(text or b"", WORDS)
        keys.append(bands(signature(grams)) if len(grams) else None)
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["id", "node", "bands"]
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, `class_id` (the least id of all documents that links and copies connect),
    `copy_of` (the least id with this very text), `n_copies` (documents with this text) and `n_links`
    (different texts at or above the threshold)."""
    use_checkpoints(docs.sparkSession)
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    frame = frame.select("id", "text", F.unhex(F.sha2("text", 256)).substr(1, 16).alias("node"))
    kind = frame.schema["id"].dataType.simpleString()
    rows = map_slices(frame, _sketched, f"id {kind}, node binary, bands array<bigint>", "text").checkpoint()

    classes = rows.where("bands is not null").groupBy("node").agg(
        F.min("id").alias("copy_of"), F.count("*").alias("n_copies"), F.first("bands").alias("bands")
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    stars = banded.join(hubs, "band").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    near = components(stars).checkpoint()

    sizes = near.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = near.join(sizes, "root").select(
        "root", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("side")
    )
    texts = frame.where("text is not null").groupBy("node").agg(F.first("text").alias("text"))
    cells = (
        dealt.join(texts, "node")
        .select("root", "node", "side", "text", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
        .select("root", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "node", "side", "text")
    )
    compared = (
        cells.repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high")
        .mapInArrow(_compared, "node binary, links bigint, hub binary")
        .checkpoint()
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("n_links"))
    linked = components(compared.select(F.col("node").alias("a"), F.col("hub").alias("b")))

    copies = classes.select("node", "copy_of", "n_copies")
    classed = (
        copies.join(links, "node", "left")
        .join(linked, "node", "left")
        .select("node", "copy_of", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    least = classed.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    known = classed.join(least, "root").drop("root")
    found = rows.where("bands is not null").select("id", "node").join(known, "node")
    alone = rows.where("bands is null")
    columns = ("class_id", "copy_of", "n_copies", "n_links")
    return found.select(F.col("id").alias(id_col), *columns).unionByName(
        alone.select(
            F.col("id").alias(id_col), F.col("id").alias("class_id"), F.col("id").alias("copy_of"),
            F.lit(1).cast("bigint").alias("n_copies"), F.lit(0).cast("bigint").alias("n_links"),
        )
    )
