"""Quality rules as a bitmask ledger.

Every document is measured once and every rule judged once; the ledger keeps the measurements and one
failure bit a rule. Policies are versioned bit masks over the ledger, so applying another policy, or
asking what a policy would do without one of its rules, reads the ledger and never a text.

Defined cases: a null text has no words and no lines, an empty text neither; both fail `few_words`.
Rows are judged one by one, so repeated rows and repeated or null ids each get their own line and no tie can arise. An
empty table has no lines. A text of any length is measured whole, by one task. Other columns of the input are neither
read nor returned by `ledger`, and pass through `passing` untouched, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, map_slices

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Bytes that continue a code point: what is left after deleting them has one byte a code point.
CONTINUED = bytes(range(0x80, 0xC0))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


def rules() -> tuple[Rule, ...]:
    """The rules in bit order. A bit never changes its meaning; a changed rule gets a new bit."""
    words, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    return (
        Rule("few_words", 0, words < 50),
        Rule("repeated_windows", 1, 100 * F.col("n_repeat_words") > 50 * words),
        Rule("many_symbols", 2, 10 * symbols > words),
        Rule("repeated_lines", 3, 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("short_words", 4, chars < 2 * words),
        Rule("long_words", 5, chars > 25 * words),
    )


#: Version -> names of the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "many_symbols", "repeated_lines", "short_words", "long_words"),
}


def policy_mask(version: str) -> int:
    masks = {rule.name: rule.mask for rule in rules()}
    return reduce(lambda a, b: a | b, (masks[name] for name in POLICIES[version]), 0)


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()  # bytes split at exactly the ASCII spaces
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, CONTINUED + SPACES)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [measure(text) for text in as_binary(batch.column("text")).to_pylist()]
    columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(len(MEASURES))]
    return pa.RecordBatch.from_arrays([batch.column("line"), *columns], ["line", *MEASURES])


def _ledger(docs: DataFrame, line: Column, text_col: str) -> DataFrame:
    """The measurements and `failed` beside `line`, which is whatever names the document."""
    frame = docs.select(line.alias("line"), F.col(text_col).alias("text"))
    kind = frame.schema["line"].dataType.simpleString()
    measured = map_slices(frame, _measured, f"line {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES), "text")
    bits = [F.when(rule.fails, F.lit(rule.mask)).otherwise(0) for rule in rules()]
    failed = reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint")
    return measured.select("line", *MEASURES, failed.alias("failed"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One line a document: its id, the measurements, and `failed`, the bits of the rules it fails."""
    return _ledger(docs, F.col(id_col), text_col).withColumnRenamed("line", id_col)


def passing(docs: DataFrame, version: str, text_col: str = "text") -> DataFrame:
    """The documents that pass a policy, with all their columns; the texts are not shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _ledger(docs, whole, text_col).where(passes(version)).select("line.*")


def passes(version: str, failed: Column | None = None) -> Column:
    """True where the ledger line passes the policy."""
    failed = F.col("failed") if failed is None else failed
    return failed.bitwiseAND(F.lit(policy_mask(version))) == 0


def ablation(lines: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that would be kept without it.

    The ledger is first summed by failure mask (at most 2^rules rows); all the rest is bit arithmetic
    on those few rows.
    """
    mask = policy_mask(version)
    by_mask = lines.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).agg(F.count("*").alias("n"))
    named = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("bigint").alias("mask")) for r in rules() if r.mask & mask]
    )
    each = by_mask.select("failed", "n", F.inline(named))
    hit = F.col("failed").bitwiseAND(F.col("mask")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("mask"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.bitwise_not(F.col("mask"))) == 0, F.col("n")).otherwise(0)).alias(
            "n_kept_without"
        ),
    )
