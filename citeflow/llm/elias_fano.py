"""Elias-Fano sequences in numpy, and files of named arrays that are memory-mapped."""

from __future__ import annotations

import json

import numpy as np

from citeflow.llm.files import open_read, open_write

class EliasFano:
    """A non-decreasing sequence: low bits packed side by side, high bits in unary.

    ``upto[i]`` is the number of ones in the first ``i`` words of the unary part.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, upto: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.upto = n, low_bits, low, high, upto
        self.mask = (1 << low_bits) - 1
        self.zeros = np.arange(len(upto), dtype=np.int64) * 64 - upto

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros(-(-(n + (top >> low_bits) + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        packed = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(packed).astype(np.int64)
        return cls(n, low_bits, cls._pack(values & np.uint64((1 << low_bits) - 1), low_bits), packed,
                   np.concatenate(([0], np.cumsum(ones))))

    @staticmethod
    def _pack(low: np.ndarray, width: int) -> np.ndarray:
        packed = np.zeros(len(low) * width // 64 + 2, np.uint64)
        if width:
            at = np.arange(len(low), dtype=np.uint64) * np.uint64(width)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(packed, word, low << shift)
            spill = shift + np.uint64(width) > np.uint64(64)
            np.bitwise_or.at(packed, word[spill] + 1, low[spill] >> (np.uint64(64) - shift[spill]))
        return packed

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.size": np.array([self.n, self.low_bits], np.int64), f"{name}.low": self.low,
                f"{name}.high": self.high, f"{name}.upto": self.upto}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, low_bits = arrays[f"{name}.size"].tolist()
        return cls(n, low_bits, arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.upto"])

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        left = self.low[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
        return (self.low[word] >> shift | left) & np.uint64(self.mask)

    @staticmethod
    def _place(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the set bit of each word before which ``rank`` others are set."""
        words, rank = words.copy(), rank.astype(np.int64)
        place = np.zeros(len(words), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halves, then quarters, and so on
            ones = np.bitwise_count(words & np.uint64((1 << width) - 1))
            step = (rank >= ones) * np.int64(width)
            rank -= ones * (step > 0)
            words >>= step.view(np.uint64)
            place += step
        return place

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at places."""
        at = np.asarray(at, np.int64)
        word = np.searchsorted(self.upto, at, side="right") - 1
        place = word * 64 + self._place(self.high[word], at - self.upto[word])
        return (place - at).astype(np.uint64) << np.uint64(self.low_bits) | self._lows(at)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """Number of values whose high part is less."""
        found = np.zeros(len(high), np.int64)
        some = high > 0
        rank = np.minimum(high[some], int(self.zeros[-1])) - 1  # the zero that ends the part before
        word = np.searchsorted(self.zeros, rank, side="right") - 1
        found[some] = word * 64 + self._place(~self.high[word], rank - self.zeros[word]) - rank
        return np.minimum(found, self.n)

    def successor(self, values: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """First place in ``[first, last)`` whose value is not less; ``last`` if there is none."""
        values = np.asarray(values).astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low, high_end = self._start(high), self._start(high + 1)
        if first is not None:
            low, high_end = np.clip(low, first, last), np.clip(high_end, first, last)
        wanted = values & np.uint64(self.mask)
        active = np.flatnonzero(low < high_end)
        while len(active):
            middle = (low[active] + high_end[active]) >> 1
            less = self._lows(middle) < wanted[active]
            low[active[less]] = middle[less] + 1
            high_end[active[~less]] = middle[~less]
            active = active[low[active] < high_end[active]]
        return low


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A length, a JSON index, and the arrays, each on a multiple of eight bytes."""
    index, at, parts = {}, 0, []
    for name, values in arrays.items():
        data = np.ascontiguousarray(values).astype(values.dtype.newbyteorder("<")).tobytes()
        index[name] = [values.dtype.newbyteorder("<").str, at, len(values)]
        parts.append(data + bytes(-len(data) % 8))
        at += len(parts[-1])
    head = json.dumps(index).encode()
    head += b" " * (-len(head) % 8)
    with open_write(path) as file:
        file.write(len(head).to_bytes(8, "little") + head)
        for part in parts:
            file.write(part)


def read_arrays(path: str) -> dict[str, np.ndarray]:
    """Views of the mapped file; read whole where the file system cannot map."""
    with open_read(path) as file:
        data = file.read_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    index = json.loads(data[8:8 + size].to_pybytes())
    return {name: np.frombuffer(data, kind, n, 8 + size + at) for name, (kind, at, n) in index.items()}
