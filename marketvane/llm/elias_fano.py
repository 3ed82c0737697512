"""Monotone integer sequences in Elias-Fano form, and values in few bits, as flat arrays that can be memory-mapped."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)
_WORD = np.uint64(63)


def _bits_before() -> np.ndarray:
    """For each byte and k: the position of its k-th set bit."""
    out = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        set_bits = [b for b in range(8) if byte >> b & 1]
        out[byte, : len(set_bits)] = set_bits
    return out


_SELECT = _bits_before()


def _place_of(bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """For each word of bits, the place of its `rest`-th set bit."""
    shift = np.zeros(len(bits), np.uint64)
    for width in (32, 16, 8):  # drop halves before the wanted bit
        part = (bits >> shift) & np.uint64((1 << width) - 1)
        many = np.bitwise_count(part).astype(np.int64)
        skip = rest >= many
        rest = np.where(skip, rest - many, rest)
        shift = np.where(skip, shift + np.uint64(width), shift)
    return shift + _SELECT[((bits >> shift) & np.uint64(255)).astype(np.int64), np.minimum(rest, 7)].astype(np.uint64)


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence: the low bits of each value packed, the high bits in unary."""

    size: int
    width: int  #: low bits
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray  #: set bits before each word of `high`

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if n and width:
            part = values & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            np.bitwise_or.at(low, (at >> np.uint64(6)).astype(np.int64), part << (at & _WORD))
            spill = (at & _WORD) + np.uint64(width) > np.uint64(64)
            np.bitwise_or.at(low, (at[spill] >> np.uint64(6)).astype(np.int64) + 1, part[spill] >> (np.uint64(64) - (at[spill] & _WORD)))
        place = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(place[-1]) if n else 0) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), _ONE << (place & _WORD))
        counts = np.bitwise_count(high).astype(np.int64)
        return EliasFano(n, width, low, high, np.concatenate([[0], np.cumsum(counts)[:-1]]))

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at the indexes."""
        word = np.searchsorted(self.ones, index, "right") - 1
        rest = (index - self.ones[word]).astype(np.int64)
        at = _place_of(self.high[word], rest)
        high = word.astype(np.uint64) * np.uint64(64) + at - index.astype(np.uint64)
        if not self.width:
            return high
        place = index.astype(np.uint64) * np.uint64(self.width)
        first, inner = (place >> np.uint64(6)).astype(np.int64), place & _WORD
        part = self.low[first] >> inner
        more = (self.low[first + 1] << _ONE) << (_WORD - inner)
        return (high << np.uint64(self.width)) | ((part | more) & np.uint64((1 << self.width) - 1))

    def _begin(self, part: np.ndarray) -> np.ndarray:
        """The first index whose high part is not below the given one: where the unary code's zero before it ends."""
        zeros = np.arange(len(self.high), dtype=np.int64) * 64 - self.ones  # unset bits before each word
        wanted = part.astype(np.int64) - 1  # number of the zero that ends the part before
        word = np.searchsorted(zeros, wanted, "right") - 1
        inside = (part > 0) & (wanted < zeros[-1] + 64 - int(np.bitwise_count(self.high[-1])))
        word = np.where(inside, word, 0)
        rest = np.where(inside, wanted - zeros[word], 0)
        place = word.astype(np.uint64) * np.uint64(64) + _place_of(~self.high[word], rest)
        begin = place.astype(np.int64) - wanted
        return np.where(part == 0, 0, np.where(inside, begin, self.size))

    def successor(self, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In index ranges [start, end): the first index whose value is not below, and whether it is equal.

        The value's high part names a short run of indexes; only that run is searched.
        """
        part = value >> np.uint64(self.width)
        lo = np.clip(self._begin(part), start, end)
        hi = np.clip(self._begin(part + _ONE), start, end)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            middle = (lo[open_] + hi[open_]) // 2
            below = self.get(middle) < value[open_]
            lo[open_] = np.where(below, middle + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], middle)
        found = lo < end
        found[found] = self.get(lo[found]) == value[found]
        return lo, found


@dataclass(frozen=True)
class Quantised:
    """Values by codes of a codebook whose entries are means of equally filled bins."""

    codes: np.ndarray
    book: np.ndarray

    @staticmethod
    def of(values: np.ndarray, bits: int) -> Quantised:
        kind = np.uint8 if bits <= 8 else np.uint16
        distinct = np.unique(values)
        if len(distinct) <= 1 << bits:
            return Quantised(np.searchsorted(distinct, values).astype(kind), distinct if len(distinct) else np.zeros(1))
        order = np.argsort(values, kind="stable")
        bins = np.array_split(order, 1 << bits)
        codes = np.empty(len(values), kind)
        for code, members in enumerate(bins):
            codes[members] = code
        return Quantised(codes, np.array([values[m].mean() for m in bins]))

    def get(self, index: np.ndarray) -> np.ndarray:
        return self.book[self.codes[index]]


def packed(parts: dict[str, EliasFano | Quantised | np.ndarray]) -> bytes:
    """A line that lists the arrays, then the arrays, each at a multiple of 64 bytes."""
    arrays, index = [], {}
    for name, part in parts.items():
        fields = {"": part} if isinstance(part, np.ndarray) else {k: v for k, v in vars(part).items() if isinstance(v, np.ndarray)}
        plain = {} if isinstance(part, np.ndarray) else {k: v for k, v in vars(part).items() if not isinstance(v, np.ndarray)}
        index[name] = {"kind": type(part).__name__, "plain": plain, "arrays": {}}
        for field, array in fields.items():
            index[name]["arrays"][field] = [len(arrays), array.dtype.str, len(array)]
            arrays.append(np.ascontiguousarray(array))
    places, at = [], 0
    for array in arrays:
        places.append(at)
        at += -(-array.nbytes // 64) * 64
    for entry in index.values():
        for item in entry["arrays"].values():
            item[0] = places[item[0]]
    head = json.dumps(index).encode()
    head += b" " * (-(len(head) + 1) % 64) + b"\n"
    return b"".join([head, *(array.tobytes() + bytes(-array.nbytes % 64) for array in arrays)])


def write(path: str, parts: dict[str, EliasFano | Quantised | np.ndarray]) -> None:
    with open(path, "wb") as file:
        file.write(packed(parts))


def read(path: str) -> dict[str, EliasFano | Quantised | np.ndarray]:
    """The parts of a file, memory-mapped."""
    return unpacked(np.memmap(path, np.uint8, "r", offset=0))


def unpacked(data: np.ndarray | bytes) -> dict[str, EliasFano | Quantised | np.ndarray]:
    """The parts that `packed` made one, as views."""
    data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    upto = 1 << 12
    while not (ends := np.flatnonzero(data[:upto] == ord("\n"))).size:
        upto *= 2
    head = data[: int(ends[0]) + 1].tobytes()
    out = {}
    for name, entry in json.loads(head).items():
        views = {}
        for field, (place, kind, length) in entry["arrays"].items():
            start = len(head) + place
            views[field] = data[start : start + length * np.dtype(kind).itemsize].view(kind)
        made = {"EliasFano": EliasFano, "Quantised": Quantised}.get(entry["kind"])
        out[name] = made(**entry["plain"], **views) if made else views[""]
    return out
