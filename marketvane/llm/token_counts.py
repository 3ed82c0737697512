"""Token counts, huge documents in overlapping chunks.

A byte-level vocabulary first cuts a text into pieces by a pattern that reads left to right and keeps no state, so
two readings that begin a piece at one place go on alike. A huge document is encoded in overlapping chunks, with
the offsets of pieces and tokens. A chunk's piece ends are sure where the chunk began at a sure place and the
reading saw LOOKAHEAD code points beyond them. Where the next chunk begins a piece at a sure end of the chunk
before, the two are spliced, and from there on the next chunk's pieces are sure. If they share no such place the
overlap is widened, up to a chunk that starts at the last sure place; if a chunk has none, it is lengthened.

Special strings count as one token each, as the library has it.

Defined cases: a null or empty text has no bytes and no tokens, an empty table no rows. Rows are counted one by one, so
repeated rows and ids do no harm and no tie can arise; other columns are not read, so their names don't matter.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_symbols
from .common import byte_lengths, map_slices

#: Code points in a chunk and in an overlap; texts longer than a chunk are cut.
CHUNK = 1 << 15
OVERLAP = 256
#: The pattern looks this far beyond the end of a piece.
LOOKAHEAD = 2
#: Letters that all versions of Unicode since 3.2 class alike; other texts go to the reference library.
SETTLED = regex.compile("[^\x00-ȳ]")


PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Counts as the `tokenizers` library does for one byte-level vocabulary file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        byte = {c: b for b, c in enumerate(byte_symbols())}
        vocab, special = spec["model"]["vocab"], [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)))
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        if any(vocab[left + right] != 256 + rank for rank, (left, right) in enumerate(merges)):
            raise ValueError(f"{path}: ids are not ranks")
        #: The same vocabulary and pattern in a faster encoder, for texts on whose letters both agree.
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0

    def count(self, text: str) -> int:
        marks = list(self.special.finditer(text)) if "<" in text else []
        starts = [0, *(m.end() for m in marks)]
        ends = [*(m.start() for m in marks), len(text)]
        return len(marks) + sum(self._plain(text[a:b]) for a, b in zip(starts, ends, strict=True))

    def _plain(self, text: str) -> int:
        if len(text) > self.chunk:
            return self._spliced(text)
        if SETTLED.search(text):
            return len(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        return len(self.fast.encode_ordinary(text))

    def _read(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the pieces of text[start:end], and the number of tokens before each; both with an end entry."""
        found = self.library.encode(text[start:end], add_special_tokens=False)
        word, offsets = np.array(found.word_ids, np.int64), found.offsets
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        begins = np.fromiter((offsets[k][0] for k in first.tolist()), np.int64, len(first))
        return np.append(begins, end - start) + start, np.append(first, len(word))

    def _spliced(self, text: str) -> int:
        total, sure, size = 0, 0, self.chunk
        end = min(len(text), size)
        begins, before = self._read(text, 0, end)
        while end < len(text):
            # this chunk's sure starts: from the splice on, as far as the reading saw enough beyond them
            known = begins[np.searchsorted(begins, sure) : np.searchsorted(begins, end - LOOKAHEAD, "right")]
            overlap = self.overlap
            next_end = min(len(text), end + size - overlap)
            while True:
                start = max(end - overlap, sure)
                next_begins, next_before = self._read(text, start, next_end)
                shared = np.intersect1d(known, next_begins[:-1], assume_unique=True)
                if len(shared):
                    break
                overlap *= 2
                self.widened += 1
            splice = shared[0]
            total += int(before[np.searchsorted(begins, splice)] - before[np.searchsorted(begins, sure)])
            size = 2 * (next_end - start) if start == sure else self.chunk  # one piece fills the chunk: a longer one
            sure, end, begins, before = int(splice), next_end, next_begins, next_before
        return total + int(before[-1] - before[np.searchsorted(begins, sure)])


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def _counter(path: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        tokens = [own.count(text) if text else 0 for text in batch.column("text").to_pylist()]
        sizes = byte_lengths(batch.column("text")).astype(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return counted


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_bytes and n_tokens."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return map_slices(frame, _counter(path), f"id {kind}, n_bytes bigint, n_tokens bigint", "text").withColumnRenamed("id", id_col)
