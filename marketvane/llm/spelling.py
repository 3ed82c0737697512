"""Spelling variants by composing the vocabulary's acceptor with a one-edit transducer and the acceptor again.

The composed machine has the states (p, q, e): what the two words have read, and whether the edit is made. Before the
edit both words have read the same, so these states are the vocabulary's prefixes. After it both read the same to
their ends. A prefix with more than PART_WORDS words is opened by Spark: the vocabulary goes on to the states after it,
and words whose edit falls right there meet by an equi-join on what is left, which both must read alike. A group of
that join has one word an inserted letter at most. Every other prefix is an initial state of its own: one task
minimises the acceptor of its words and runs the composition from there, following both words through the acceptor's
states until they are one state, whose words all match. However many words share a prefix, a part stays small.

An edit is taken where two words first differ, so each pair is found once. Words are told by their rank among a part's
sorted words, which the acceptor's counts give; no step is recursive, so a word may be of any length.

`variants` then takes each word's most frequent near word, and follows these to the last by doubling.

Defined cases: a null or empty text has no runs. Repeated rows count again, and a null id stands for an empty one.
Equal counts are settled by code-point order. Empty tables give empty results. A text of any length is counted whole, in
parts of FLUSH different words. Other columns are not read, so their names don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A word's form is this many times as frequent.
FORM_RATIO = 10
#: A deletion is made in one of so many (document, run) pairs.
SLIP = 31
#: Words of one part of the composition, at most.
PART_WORDS = 2048
#: Different words that a task counts before it passes them on.
FLUSH = 200_000
#: Prefix lengths counted in the first round; each further round counts as many as all before.
DEPTHS = 4

# Letters in Latin-1, where each code point is a byte: A-Z lower-cased, all that is no letter a space.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256)
)


def runs(text: str, least: int) -> Counter[bytes]:
    """The maximal runs of letters with at least `least` code points, lower-cased, in Latin-1."""
    return Counter(w for w in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(w) >= least)


def slipped(run: bytes, before: int, slip: int) -> bytes:
    """The run, less the code point that its checksum names if that says so; `before` is the checksum of the id part."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int | None = SLIP, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): the runs of all documents, with one code point lost in one of `slip` (document, run) pairs."""

    def passed(counts: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for whole in batches:
            for batch in slices(whole, "text"):
                for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    if not text:
                        continue
                    own = runs(text, least)
                    before = crc32(f"{id_}:".encode())
                    for run, n in own.items():
                        word = slipped(run, before, slip) if slip else run
                        if len(word) >= least:
                            counts[word] += n
                    if len(counts) >= FLUSH:
                        yield passed(counts)
                        counts.clear()
        yield passed(counts)

    frame = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    found = frame.mapInArrow(counted, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """The minimal acyclic acceptor of sorted words.

    A state has its arcs (symbol, next state, rank of the first word through the arc), whether it ends a word, how many
    words it accepts, and a mask of their lengths (the last bit: all lengths from 63).
    """

    LONG = 1 << 63

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self.mask: list[int] = []
        known: dict[tuple, int] = {}
        path: list[tuple[list[tuple[str, int]], list[bool]]] = [([], [False])]  # open states of the last word
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._state(known, *path.pop())
                path[-1][0].append((last[len(path) - 1], state))

        for word in words:
            shared = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                shared += 1
            close(shared)
            path.extend(([], [False]) for _ in word[shared:])
            path[-1][1][0] = True
            last = word
        close(0)
        self.start = self._state(known, *path.pop())

    def _state(self, known: dict[tuple, int], arcs: list[tuple[str, int]], final: list[bool]) -> int:
        key = (final[0], *arcs)
        state = known.get(key)
        if state is None:
            state = known[key] = len(self.arcs)
            rank, mask, own = int(final[0]), int(final[0]), {}
            for symbol, to in arcs:
                own[symbol] = (to, rank)
                rank += self.count[to]
                mask |= self.mask[to] << 1
            self.arcs.append(own)
            self.final.append(final[0])
            self.count.append(rank)
            self.mask.append(mask if mask < 2 * self.LONG else mask & (2 * self.LONG - 1) | self.LONG)
        return state

    def shared(self, out: list[tuple[int, int, int]], p: int, q: int, i: int, j: int) -> None:
        """Words that both states accept, as (rank from p, rank from q, number of ranks on)."""
        stack = [(p, q, i, j)]
        while stack:
            p, q, i, j = stack.pop()
            if p == q:
                out.append((i, j, self.count[p]))
                continue
            if self.final[p] and self.final[q]:
                out.append((i, j, 1))
            ours, theirs = self.arcs[p], self.arcs[q]
            if len(ours) <= len(theirs):
                for symbol, (to, at) in ours.items():
                    other = theirs.get(symbol)
                    if other is not None and self.mask[to] & self.mask[other[0]]:
                        stack.append((to, other[0], i + at, j + other[1]))
            else:
                for symbol, (to, at) in theirs.items():
                    other = ours.get(symbol)
                    if other is not None and self.mask[to] & self.mask[other[0]]:
                        stack.append((other[0], to, i + other[1], j + at))

    def edits(self, state: int) -> np.ndarray:
        """Pairs of the state's words whose edit is made at once: rows (rank, rank, number of ranks on)."""
        out: list[tuple[int, int, int]] = []
        arcs = list(self.arcs[state].items())
        mask, final = self.mask, self.final
        for k, (symbol, (to, at)) in enumerate(arcs):
            for _, (other, there) in arcs[k + 1 :]:  # another symbol in its place
                if mask[to] & mask[other]:
                    self.shared(out, to, other, at, there)
            if mask[to] & mask[state]:  # the symbol left out; the next one is another, or the pair were found later
                if final[to] and final[state]:
                    out.append((at, 0, 1))
                inner = self.arcs[to]
                for next_, (other, there) in arcs:
                    if next_ != symbol and next_ in inner and mask[inner[next_][0]] & mask[other]:
                        self.shared(out, inner[next_][0], other, at + inner[next_][1], there)
        return np.array(out, np.int64).reshape(-1, 3)

    def pairs(self) -> np.ndarray:
        """All pairs of words with exactly one edit between them, as rows of two ranks."""
        made: dict[int, np.ndarray] = {}
        out = []
        stack = [(self.start, 0)]
        while stack:
            state, rank = stack.pop()
            if self.count[state] < 2:
                continue
            if state not in made:
                made[state] = self.edits(state)
            if len(made[state]):
                out.append(made[state] + np.array([rank, rank, 0]))
            stack.extend((to, rank + at) for to, at in self.arcs[state].values())
        if not out:
            return np.zeros((0, 2), np.int64)
        found = np.concatenate(out)
        n = found[:, 2]
        on = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.stack([np.repeat(found[:, 0], n) + on, np.repeat(found[:, 1], n) + on], axis=1)


def open_prefixes(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(prefix): the prefixes with more than `part_words` words, the empty one among them."""
    from_, to, found = 0, DEPTHS, None
    alive = words.select("word")
    while True:
        lengths = F.sequence(F.lit(from_), F.least(F.length("word"), F.lit(to - 1)))
        spread = alive.where(F.length("word") >= from_).select(F.explode(F.transform(lengths, lambda k: F.substring("word", 1, k))).alias("prefix"))
        more = spread.groupBy("prefix").count().where(F.col("count") > part_words).select("prefix")
        more = stored(more, "prefixes")
        found = more if found is None else found.unionByName(more)
        deepest = more.where(F.length("prefix") == to - 1)
        if deepest.isEmpty():
            return found
        alive = alive.join(deepest, F.expr(f"substring(word, 1, {to - 1}) = prefix"), "left_semi")
        from_, to = to, 2 * to


def with_depth(words: DataFrame, opened: DataFrame) -> DataFrame:
    """`words` with the number of their prefixes that are open: prefixes of 0, 1, ... depth - 1 code points."""
    most = opened.agg(F.coalesce(F.max(F.length("prefix")), F.lit(-1))).first()[0]
    lengths = F.sequence(F.lit(0), F.least(F.length("word"), F.lit(most)))
    if most < 0:
        return words.withColumn("depth", F.lit(0))
    spread = words.select("word", "n", F.explode(F.transform(lengths, lambda k: F.substring("word", 1, k))).alias("prefix"))
    marked = spread.join(opened.withColumn("open", F.lit(1)), "prefix", "left")
    return marked.groupBy("word", "n").agg(F.coalesce(F.sum("open"), F.lit(0)).cast("int").alias("depth"))


def _met(words: DataFrame) -> DataFrame:
    """Pairs whose edit falls right after an open prefix: words that are alike but for the code point there."""
    places = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("depth")), lambda d: d < F.col("depth")),
        lambda d: F.struct(
            d.alias("at"),
            F.concat(F.substring("word", 1, d), F.substr(F.col("word"), d + 2)).alias("rest"),
            F.substr(F.col("word"), d + 1, F.lit(1)).alias("symbol"),
        ),
    )
    wholes = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("depth")), lambda d: d < F.col("depth")),
        lambda d: F.struct(d.alias("at"), F.col("word").alias("rest"), F.lit("").alias("symbol")),
    )
    # a word that ends at the place has nothing to leave out there
    less = F.filter(places, lambda x: x["symbol"] != "")
    states = words.select("word", "n", F.inline(F.concat(less, wholes)))
    group = F.array_sort(F.collect_list(F.struct("symbol", "word", "n")))
    groups = states.groupBy("at", "rest").agg(group.alias("group")).where(F.size("group") > 1)
    # the symbol left out must differ from the one that follows, or the edit were made later
    follows = F.substr(F.col("rest"), F.col("at") + 1, F.lit(1))
    first = groups.select("group", follows.alias("follows"), F.posexplode("group").alias("k", "one"))
    second = first.select("one", "follows", F.explode(F.slice("group", F.col("k") + 2, F.size("group"))).alias("two"))
    fits = (F.col("one.symbol") != "") | (F.col("two.symbol") != F.col("follows"))
    return second.where(fits).select(
        F.col("one.word").alias("a"), F.col("one.n").alias("n_a"), F.col("two.word").alias("b"), F.col("two.n").alias("n_b")
    )


def _composed(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("word", ignore_index=True)
    found = Acceptor(part["word"].tolist()).pairs()
    words, n = part["word"].to_numpy(object), part["n"].to_numpy(np.int64)
    a, b = found[:, 0], found[:, 1]
    return pd.DataFrame({"a": words[a], "n_a": n[a], "b": words[b], "n_b": n[b]})


def near_pairs(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(a, n_a, b, n_b) of (word, n), words being distinct: each pair with exactly one edit between them, once."""
    kept = stored(with_depth(words, open_prefixes(words, part_words)), "depths")
    inside = kept.where(F.length("word") >= F.col("depth"))
    parts = inside.select(F.substring("word", 1, F.col("depth")).alias("state"), "word", "n")
    found = parts.groupBy("state").applyInPandas(_composed, "a string, n_a bigint, b string, n_b bigint")
    return found.unionByName(_met(kept.where("depth > 0")))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of (word, form): the forms followed to the last, in chains of at most `steps`."""
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = stored(found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return found


def variants(words: DataFrame, part_words: int = PART_WORDS, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n), words being distinct.

    A form is at least `ratio` times as frequent as its word, so a chain of forms has few steps, whatever the data.
    """
    words = stored(words, "vocabulary")
    pairs = near_pairs(words, part_words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = pairs.select(F.inline(sides)).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    is_form = form_n >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, form_n).alias("form_n"),
    )
    judged = stored(judged, "forms")
    ends = judged.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    steps = math.floor(math.log(ends["most"] / ends["least"], ratio) + 1e-9) if ends["least"] else 0
    last = roots(judged.where("form IS NOT NULL").select("word", "form"), steps)
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
