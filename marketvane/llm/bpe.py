"""BPE encoding and decoding.

Encoding finds all tokens that occur in a word with one Aho-Corasick scan and then walks the word: it takes the
longest token that starts at the current place and fits the one before it, steps back where none does, and never
tries a place twice that led nowhere. Two tokens fit if the merges would leave exactly these two, which their
merge trees decide; a table remembers the answer for each pair. A token sequence whose neighbours all fit is what
the merges give, so the result is exact, in time linear in the word's length.

Decoding looks up each id's text in one byte string by an offset table.

How a text is cut into words depends on Unicode classes, and versions of Unicode class new characters differently. Texts
whose characters stand as they are since Unicode 3.2 are cut here. Any other text is normalized and cut by the
`tokenizers` library itself, and only its words are encoded here, so the ids follow the library's version.

Defined cases: a null text encodes as an empty one, to no ids, and an empty table to an empty one. Rows are encoded one
by one, so repeated rows and ids do no harm and no tie can arise; other columns are not read, so their names don't
matter. A text of any length is encoded whole, in one task. The vocabulary is a file of the `tokenizers` library (BPE, byte level,
words cut by its pattern, with an end-of-word suffix or none), given by its path.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_slices

#: Words whose ids, and token pairs whose fit, a worker remembers.
REMEMBERED = 200_000
REMEMBERED_PAIRS = 2_000_000
#: The last symbol of a word carries the suffix; it is told apart by this offset.
FINAL = 0x10000
NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 0x100
    for byte in range(256):
        if byte in plain:
            out.append(chr(byte))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@lru_cache(maxsize=1)
def unsettled() -> re.Pattern[str]:
    """Any character that Unicode 3.2 lacked or classed otherwise than the version at hand."""
    old, ranges = unicodedata.ucd_3_2_0, []
    for point in map(chr, range(0x80, sys.maxunicode + 1)):
        kind = old.category(point)
        if kind in ("Cn", "Cs") or kind != unicodedata.category(point):
            if ranges and ord(ranges[-1][1]) == ord(point) - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return re.compile("[" + "".join(f"\\U{ord(a):08x}-\\U{ord(b):08x}" for a, b in ranges) + "]")


class Bpe:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.rank[self.vocab[left], self.vocab[right]] = rank, self.vocab[left + right]
        self.symbols = byte_symbols()
        self.byte = {symbol: byte for byte, symbol in enumerate(self.symbols)}
        self._spines: dict[int, tuple[list, list] | None] = {}
        self._fits: dict[int, bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._scan = ahocorasick.Automaton()
        for text, i in self.vocab.items():
            marked = self._marked(text)
            if marked:
                self._scan.add_word(marked, (i, len(marked)))
        self._scan.make_automaton()
        self._read_steps(spec)

    def _read_steps(self, spec: dict) -> None:
        """How a text becomes words, from the file's normalizer and its cutting pattern."""

        def flat(part: dict | None, inner: str) -> list[dict]:
            return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

        self.normal = [p["type"] for p in flat(spec["normalizer"], "normalizers")]
        cut = next(p for p in flat(spec["pre_tokenizer"], "pretokenizers") if p["type"] == "Split")
        # \s here is Unicode white space
        self.pattern = regex.compile(cut["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _marked(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            token = token.removesuffix(self.suffix)
            return token[:-1] + chr(ord(token[-1]) + FINAL) if token else ""
        return token

    def _named(self, marked: str) -> list[int]:
        """The ids of single symbols."""
        return [self.vocab[c if ord(c) < FINAL else chr(ord(c) - FINAL) + self.suffix] for c in marked]

    def _spine(self, token: int) -> tuple[list, list] | None:
        """What stands at the token's left and right edge while it is merged, each with the rank of the merge that
        ends it; None if the merges don't give the token."""
        if token not in self._spines:
            parts = self._named(self._marked(self.names[token]))
            left, right = [], []
            while len(parts) > 1:
                rank, at = min((self.rank.get(p, (NEVER, 0))[0], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == NEVER:
                    break
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at : at + 2] = [self.rank[parts[at], parts[at + 1]][1]]
            whole = parts == [token]
            self._spines[token] = ([*left, (token, NEVER)], [*right, (token, NEVER)]) if whole else None
        return self._spines[token]

    def fits(self, first: int, second: int) -> bool:
        """Whether the merges leave these two tokens side by side."""
        key = first << 32 | second
        found = self._fits.get(key)
        if found is None:
            found = self._decide(first, second)
            if len(self._fits) >= REMEMBERED_PAIRS:
                self._fits.clear()
            self._fits[key] = found
        return found

    def _decide(self, first: int, second: int) -> bool:
        a, b = self._spine(first), self._spine(second)
        if a is None or b is None:
            return False
        a, b, i, j = a[1], b[0], 0, 0
        while True:
            (x, ends_x), (y, ends_y) = a[i], b[j]
            joined = self.rank.get((x, y), (NEVER, 0))[0]
            # of merges of one rank the leftmost goes first
            if joined < ends_x and joined <= ends_y and joined != NEVER:
                return False
            if ends_x == ends_y == NEVER:
                return True
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def encode_word(self, word: str) -> tuple[int, ...]:
        found = self._words.get(word)
        if found is None:
            found = self._walk(word)
            if len(self._words) >= REMEMBERED:
                self._words.clear()
            self._words[word] = found
        return found

    def _walk(self, word: str) -> tuple[int, ...]:
        marked = "".join(self.symbols[b] for b in word.encode())
        if self.suffix:
            marked = marked[:-1] + chr(ord(marked[-1]) + FINAL)
        n = len(marked)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (token, length) in self._scan.iter(marked):  # by end, so the longest of each start comes last
            starting[end - length + 1].append((token, length))
        dead = bytearray(n + 1)
        taken: list[tuple[int, int, int]] = []  # token, its start, its turn among those that start there
        at, turn = 0, len(starting[0]) - 1
        while at < n:
            while turn >= 0:
                token, length = starting[at][turn]
                if not dead[at + length] and (self.fits(taken[-1][0], token) if taken else self._spine(token) is not None):
                    break
                turn -= 1
            if turn >= 0:
                taken.append((token, at, turn))
                at += length
                turn = len(starting[at]) - 1 if at < n else -1
            elif taken:  # the prefix up to here has one encoding only, so this place leads nowhere
                dead[at] = 1
                _, at, turn = taken.pop()
                turn -= 1
            else:
                raise ValueError(f"no tokens for {word!r}")
        return tuple(token for token, _, _ in taken)

    def words(self, text: str) -> list[str]:
        if not text.isascii() and unsettled().search(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte.__getitem__, piece)).decode() for piece, _ in pieces]
        for step in self.normal:
            if step == "NFC":
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text)
            elif step == "Lowercase":
                text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()  # one code point at a time: no final sigma
            elif step != "Replace":  # white space for white space, which the pattern drops
                raise ValueError(f"unknown normalizer {step}")
        return self.pattern.findall(text)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        parts = self.cuts.split(text) if "<|" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
                continue
            known = self._words
            for word in self.words(part):
                out += known.get(word) or self.encode_word(word)
        return out


class Decoder:
    """Texts of ids by an offset table: entry i of `text` is the id's token and a space."""

    def __init__(self, names: dict[int, str]):
        entries = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(e) for e in entries])])
        self.text = np.frombuffer(b"".join(entries), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        end = np.cumsum(size)
        if not len(end):
            return b""
        return self.text[np.repeat(start - (end - size), size) + np.arange(end[-1])][:-1].tobytes()


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Bpe, Decoder]:
    bpe = Bpe(path)
    return bpe, Decoder(bpe.names)


def _coder(path: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, decoder = load(path)
        ids, texts = [], []
        for text in batch.column("text").to_pylist():
            own = np.array(bpe.encode(text or ""), np.int32)
            ids.append(own)
            texts.append(decoder.decode(own))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["id", "ids", "decoded"]
        )

    return coded


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, `ids` and `decoded`, the text of the ids, special tokens and all."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    coded = map_slices(frame, _coder(path), f"id {kind}, ids array<int>, decoded string", "text")
    return coded.withColumnRenamed("id", id_col)
