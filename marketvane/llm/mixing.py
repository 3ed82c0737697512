"""Mixing sources to target weights.

The words of each source are packed end to end into blocks of fixed length. Output shards have a fixed number
of block slots; a shard draws from the multinomial of the source targets how many of its slots each source
gets. The k-th slot of a source over all shards takes the block that a pseudorandom permutation, a new one for
each pass over the source, maps k to; slots and blocks are joined by that index.

Free draws would miss the targets by chance and could exceed a source's limit, so the slots that a source draws
beyond its quota go to the sources that drew too few. Quotas are the targets in whole blocks.

Documents are packed by hash bucket and id: bucket totals give each bucket's place, and only a bucket's
documents are ordered by a window, so no source is ever in one task.

Defined cases: a null text has no words; a null source is a source of its own, the last one; ids may repeat or
be null, each row is a document. A source without words has target 0. Rows equal in id and size may take each other's words, rows equal altogether are
separate. An empty table gives an empty mix. A text of any length is packed by its number of words. Other columns are
not read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_binary, map_slices, stored
from .rolling import mix, word_bounds

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
LIMIT = 2.0
BLOCK_WORDS = 64
SHARD_BLOCKS = 4096
#: Shards whose slots one task makes, about: few rows become many here, which Spark can't foresee.
TASK_SHARDS = 16
#: Documents that one window orders, about.
BUCKET_DOCS = 2000
SEED = 7


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, limit: float = LIMIT) -> list[float]:
    """Words wanted of each source: the budget shared by weight, none above its limit, the excess shared again."""
    left, open_, out = budget * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[k % len(weights)] for k in open_)
        share = {k: left * weights[k % len(weights)] / total for k in open_}
        full = [k for k in open_ if share[k] > limit * sizes[k]]
        if not full:
            for k in open_:
                out[k] = share[k]
            break
        for k in full:
            out[k] = limit * sizes[k]
            left -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def permuted(index: np.ndarray, count: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row, where the keyed permutation of 0..count-1 sends the index: a Feistel network on the next
    power of four, walked until the value is below count."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(count, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    value = index.astype(np.uint64)
    walking = np.ones(len(value), bool)
    while walking.any():
        v, h, m, k = value[walking], half[walking], low[walking], key[walking]
        left, right = v >> h, v & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + k * np.uint64(4) + np.uint64(turn)) & m)
        value[walking] = (left << h) | right
        walking[walking] = value[walking] >= count[walking].astype(np.uint64)
    return value.astype(np.int64)


@dataclass(frozen=True)
class Plan:
    """One row a source, in order: the driver's part of a mix. It grows with the number of sources alone."""

    names: list
    sizes: list[int]
    targets: list[float]
    blocks: np.ndarray
    quota: np.ndarray

    @property
    def shards(self) -> int:
        return -(-int(self.quota.sum()) // SHARD_BLOCKS)


def plan(sized: DataFrame) -> Plan:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    wanted = targets(sizes)
    blocks = np.array([-(-s // BLOCK_WORDS) for s in sizes], np.int64)
    quota = np.array([round(t * b / s) if s else 0 for t, b, s in zip(wanted, blocks, sizes, strict=True)], np.int64)
    return Plan([r["source"] for r in rows], sizes, wanted, blocks, np.minimum(quota, np.int64(LIMIT) * blocks))


def _sized(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = [len(text.split()) if text else 0 for text in as_binary(batch.column("text")).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), pa.array(words, pa.int64())], ["id", "source", "size"])


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size) of each document, stored."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return stored(map_slices(frame, _sized, f"id {kind}, source string, size bigint", "text"), "sizes")


def placed(sized: DataFrame, mixed: Plan) -> DataFrame:
    """(id, source, size, number of the source, offset of the first word in the source's packed words)."""
    spark = sized.sparkSession
    buckets = max(1, -(-sized.count() // BUCKET_DOCS))
    numbers = spark.createDataFrame(list(enumerate(mixed.names)), "number int, name string")
    rows = sized.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    totals = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("number", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("number", "bucket").orderBy("id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, ["number", "bucket"])
        .select("id", "source", "size", "number", (F.col("start") + F.col("offset")).alias("offset"))
    )


def draws(spark: SparkSession, mixed: Plan, seed: int = SEED) -> DataFrame:
    """(shard, number, n): how many slots of each shard each source draws."""
    total, shards = int(mixed.quota.sum()), mixed.shards
    odds = mixed.quota / max(total, 1)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                slots = min(SHARD_BLOCKS, total - shard * SHARD_BLOCKS)
                n = np.random.Generator(np.random.PCG64([seed, shard])).multinomial(slots, odds / odds.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard)), pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n.astype(np.int64))],
                    ["shard", "number", "n"],
                )

    return spark.range(shards).mapInArrow(drawn, "shard bigint, number int, n bigint")


def slots(spark: SparkSession, mixed: Plan, seed: int = SEED) -> DataFrame:
    """(shard, place, number, epoch, block) of every slot; `place` orders a shard's slots."""
    drawn = draws(spark, mixed, seed)
    got = np.zeros(len(mixed.names), np.int64)
    for row in drawn.groupBy("number").agg(F.sum("n").alias("n")).collect():
        got[row["number"]] = row["n"]
    over, under = np.maximum(got - mixed.quota, 0), np.maximum(mixed.quota - got, 0)
    over_start, under_end = np.cumsum(over) - over, np.cumsum(under)
    quota, blocks = mixed.quota, mixed.blocks
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = drawn.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 0")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                rank = run["start"] + np.arange(run["n"])
                number = np.full(len(rank), run["number"])
                beyond = rank >= quota[number]
                if beyond.any():
                    turn = over_start[run["number"]] + rank[beyond] - quota[run["number"]]
                    to = np.searchsorted(under_end, turn, "right")
                    number[beyond] = to
                    rank[beyond] = got[to] + turn - (under_end[to] - under[to])
                count = blocks[number]
                epoch = rank // count
                key = mix(np.uint64(seed) + number.astype(np.uint64) * np.uint64(1 << 20) + epoch.astype(np.uint64))
                block = permuted(rank % count, count, key)
                place = mix(key + rank.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rank), run["shard"])), pa.array(place), pa.array(number.astype(np.int32)), pa.array(epoch), pa.array(block)],
                    ["shard", "place", "number", "epoch", "block"],
                )

    runs = runs.repartition(mixed.shards // TASK_SHARDS + 1, "shard")
    return runs.mapInArrow(dealt, "shard bigint, place bigint, number int, epoch bigint, block bigint")


def block_spans(where: DataFrame) -> DataFrame:
    """(number, block, offset, id, first, words): the part of each document that lies in each block."""
    size = F.lit(BLOCK_WORDS)
    first_block = F.expr(f"offset div {BLOCK_WORDS}")
    last_block = F.expr(f"(offset + size - 1) div {BLOCK_WORDS}")
    spans = where.where("size > 0").select("number", "id", "offset", "size", F.explode(F.sequence(first_block, last_block)).alias("block"))
    first = F.greatest(F.col("block") * size - F.col("offset"), F.lit(0))
    end = F.least((F.col("block") + 1) * size - F.col("offset"), F.col("size"))
    return spans.select("number", "block", "offset", "id", first.alias("first"), (end - first).alias("words"))


@dataclass(frozen=True)
class Mix:
    plan: Plan
    placed: DataFrame  #: where each document lies
    pieces: DataFrame  #: (shard, place, number, epoch, block, offset, id, first, words): the mixed text, as parts of documents

    def taken(self) -> DataFrame:
        """One row a document: id, size, its source's size and target, and the words the mix takes of it."""
        per = self.pieces.groupBy("number", "offset").agg(F.sum("words").alias("taken"))
        spark = self.placed.sparkSession
        sources = spark.createDataFrame(
            [(k, s, float(t)) for k, (s, t) in enumerate(zip(self.plan.sizes, self.plan.targets, strict=True))],
            "number int, source_size bigint, target double",
        )
        full = self.placed.where("size > 0").join(per, ["number", "offset"], "left")
        rows = full.unionByName(self.placed.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")))
        return rows.join(F.broadcast(sources), "number").select(
            "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> Mix:
    sized = sizes(docs, id_col, text_col, source_col)
    mixed = plan(sized)
    where = placed(sized, mixed)
    # Both sides grow with the corpus, whatever Spark expects of a range: never broadcast one.
    pieces = slots(docs.sparkSession, mixed, seed).hint("merge").join(block_spans(where), ["number", "block"])
    return Mix(mixed, where, pieces)


def _assembled(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = []
    for text, pieces in zip(as_binary(batch.column("text")).to_pylist(), batch.column("pieces").to_pylist(), strict=True):
        starts, ends = word_bounds(np.frombuffer(text, np.uint8))
        runs: list[list[int]] = []
        for piece in sorted((p["epoch"], p["first"], p["words"]) for p in pieces):
            epoch, first, words = piece
            if runs and runs[-1][0] == epoch and runs[-1][2] == first:
                runs[-1][2] += words
            else:
                runs.append([epoch, first, first + words])
        texts.append(b"\n".join(text[starts[a] : ends[b - 1]] for _, a, b in runs).decode())
    return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "mixed"])


def assemble(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with the text that the mix takes of them, in text order, a pass after the other; a document
    the mix takes nothing of goes. One row a document: `row` (its columns as given, but the text) and `mixed`.
    Ids must be unique here."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    frame = docs.select(F.col(id_col).alias("id"), F.struct(*others).alias("row"), F.col(text_col).alias("text"))
    pieces = mixed.pieces.groupBy("id").agg(F.collect_list(F.struct("epoch", "first", "words")).alias("pieces"))
    kind = frame.schema["row"].dataType.simpleString()
    return map_slices(frame.join(pieces, "id").select("row", "text", "pieces"), _assembled, f"row {kind}, mixed string", "text")
