"""Sets of word shingles as 64-bit numbers, made for whole Arrow batches at once."""

from __future__ import annotations

import numpy as np

from .worker import held

_PIECE = 1 << 20  # bytes whose words are hashed at once
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def randoms(seed: int, count: int) -> np.ndarray:
    """Fixed 64-bit numbers: the first outputs of a counter run through ``mix``."""
    return mix((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits each hang on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShingleCoder:
    """64-bit numbers of the words and ``size``-word shingles of texts, A-Z lower-cased.

    A word's number is a polynomial over its bytes in one odd base, taken from running sums, so that words of any length
    cost a few array steps per byte. A shingle joins the numbers of its words with one multiplier per place.
    """

    def __init__(self, size: int, seed: int):
        made = randoms(seed, 257 + size + 1)
        self.size, self.values = size, made[:256]
        self.base = int(made[256]) | 1
        self.places = made[257:257 + size] | np.uint64(1)
        self.numbers = made[-1] * np.arange(size + 1, dtype=np.uint64)  # tells sequences of other lengths apart
        self._powers(2 * _PIECE)

    def _powers(self, length: int) -> None:
        def rising(base: int) -> np.ndarray:
            steps = np.full(length, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        self.powers, self.inverse = rising(self.base), rising(pow(self.base, -1, 1 << 64))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts ``data[offsets[k]:offsets[k + 1]]`` end to end, and how many each text has."""
        inner = ~_SPACE[data]
        first = np.empty(len(data) + 1, bool)  # a word's byte after white space or at the begin of a text
        first[1:-1] = ~inner[:-1]
        first[offsets] = True
        starts = np.flatnonzero(inner & first[:-1])
        last = np.empty(len(data), bool)
        last[:-1] = ~inner[1:]
        if len(data):
            last[-1] = True
        last[offsets[(offsets > 0) & (offsets <= len(data))] - 1] = True
        ends = np.flatnonzero(inner & last) + 1
        out = np.empty(len(starts), np.uint64)
        k = 0
        while k < len(starts):
            begin = starts[k]
            to = max(k + 1, int(np.searchsorted(starts, begin + _PIECE)))
            part = self.values[_LOWER[data[begin:ends[to - 1]]]]
            if len(part) > len(self.powers):
                self._powers(2 * len(part))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * self.powers[:len(part)])))
            own = starts[k:to] - begin
            out[k:to] = (sums[ends[k:to] - begin] - sums[own]) * self.inverse[own]
            k = to
        return mix(out), np.diff(np.searchsorted(starts, offsets))

    def sets(self, texts) -> list[np.ndarray]:
        """The distinct shingles of each text of an Arrow string column, rising; a text of fewer words is one shingle, one without words none."""
        import pyarrow as pa

        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return []
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, np.uint8)
        words, counts = self.words(data, offsets - offsets[0])
        ends = np.cumsum(counts)
        whole = max(0, len(words) - self.size + 1)
        shingles = np.full(whole, self.numbers[-1], np.uint64)
        for k, place in enumerate(self.places):
            shingles += words[k:k + whole] * place
        shingles = mix(shingles)
        out = []
        for n, end in zip(counts.tolist(), ends.tolist()):
            if n >= self.size:
                out.append(np.unique(shingles[end - n:end - self.size + 1]))
            elif n:
                few = (words[end - n:end] * self.places[:n]).sum(dtype=np.uint64, keepdims=True)
                out.append(mix(few + self.numbers[n]))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def shingle_coder(size: int, seed: int) -> ShingleCoder:
    return held(lambda: ShingleCoder(size, seed), size, seed)
