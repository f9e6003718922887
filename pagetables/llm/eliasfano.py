"""Monotone sequences in Elias-Fano form, as arrays that can lie in a memory-mapped file."""

from __future__ import annotations

import json

import numpy as np

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: Where the k-th one (and zero) of a byte is.
_ONE, _ZERO = (
    np.array([(np.flatnonzero(row == bit).tolist() + [0] * 8)[:8] for row in _BITS], np.int64) for bit in (1, 0)
)


class EliasFano:
    """A rising sequence: the low bits of each value packed, the high bits as unary gaps.

    ``ones`` and ``zeros`` count the bits set and not set before each byte of the high part, so that the i-th value and
    the first value of a bucket are found by one binary search. All lies in the file; nothing is derived in memory.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones, self.zeros = n, width, low, high, ones, zeros

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        low = _pack(values & np.uint64((1 << width) - 1), width)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(places[-1]) if n else 0) // 8 * 8 + 16, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little")
        counts = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        ones, kind = np.concatenate(([0], counts[:-1])), np.uint32 if n < 1 << 28 else np.int64
        return cls(n, width, low, high, ones.astype(kind), (np.arange(len(ones)) * 8 - ones).astype(kind))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.shape": np.array([self.n, self.width], np.int64), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def from_arrays(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = arrays[f"{name}.shape"].tolist()
        return cls(n, width, *(arrays[f"{name}.{part}"] for part in ("low", "high", "ones", "zeros")))

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        byte = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        place = byte * 8 + _ONE[self.high[byte], i - self.ones[byte].astype(np.int64)]
        return (place - i).astype(np.uint64) << np.uint64(self.width) | _unpack(self.low, self.width, i)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``h``: the ones before the h-th zero, for h from 1 on."""
        want = np.maximum(h - 1, 0)
        most = np.iinfo(self.zeros.dtype).max  # beyond all that are there
        byte = np.searchsorted(self.zeros, np.minimum(want, most).astype(self.zeros.dtype), side="right") - 1
        inner = want - self.zeros[byte].astype(np.int64)
        beyond = inner > 7
        place = byte * 8 + _ZERO[self.high[byte], np.minimum(inner, 7)]
        found = np.minimum(place - want, self.n)
        return np.where(h <= 0, 0, np.where(beyond, self.n, found))

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each value ``x``, -1 where it isn't: the successor within the bucket of its high bits."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.full(len(x), -1, np.int64)
        h = (x >> np.uint64(self.width)).astype(np.int64)
        at, end = self._bucket(h), self._bucket(h + 1)
        low = x & np.uint64((1 << self.width) - 1)
        out = np.full(len(x), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):  # halve the buckets that are left
            middle = (at[open_] + end[open_]) // 2
            value = _unpack(self.low, self.width, middle)
            want = low[open_]
            out[open_[value == want]] = middle[value == want]
            less = value < want
            at[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[(value != want) & (at[open_] < end[open_])]
        return out


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits side by side in 64-bit words, with one word to spare."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width:
        bit = np.arange(len(values), dtype=np.int64) * width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = shift.astype(np.int64) + width > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpack(words: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(i), np.uint64)
    bit = i.astype(np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    value = words[word] >> shift
    # a shift by 64 is none at all, so the upper part goes in two steps
    value |= (words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
    return value & np.uint64((1 << width) - 1)


def dump(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays in one block: a header, then each at a multiple of 64 bytes."""
    at, index, parts = 0, {}, []
    for name, array in arrays.items():
        data = np.ascontiguousarray(array).tobytes()
        index[name] = [array.dtype.str, len(array), at]
        pad = -len(data) % 64
        parts += [data, b"\0" * pad]
        at += len(data) + pad
    header = json.dumps(index).encode()
    header += b" " * (-(len(header) + 8) % 64)
    return b"".join([len(header).to_bytes(8, "little"), header, *parts])


def load(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file: memory-mapped where it is on a mounted file system, read otherwise."""
    from pyarrow import fs

    from .files import filesystem

    system, path = filesystem(uri)
    if isinstance(system, fs.LocalFileSystem):
        data = np.memmap(path, np.uint8, mode="r")
    else:
        with system.open_input_file(path) as file:
            data = np.frombuffer(file.read(), np.uint8)
    size = int.from_bytes(data[:8].tobytes(), "little")
    index = json.loads(data[8:8 + size].tobytes())
    first = 8 + size
    return {
        name: data[first + at:first + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in index.items()
    }
