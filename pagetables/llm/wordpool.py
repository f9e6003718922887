"""Numbers derived from words, made once per word and kept while a worker lives."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class _Known(dict):
    def __missing__(self, key):
        return -1


class WordPool:
    """Maps words to runs of numbers by ``make(words) -> (numbers end to end, how many each word has)``.

    ``keep`` bounds the memory: when so many words are known, all are forgotten. It changes no result.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], keep: int = 400_000, longest: int = 40):
        self.make, self.keep, self.longest = make, keep, longest
        self._forget()

    def _forget(self) -> None:
        self.known, self.count, self.used = _Known(), 0, 0
        self.starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool = None

    def numbers(self, words: list[str]) -> np.ndarray:
        """The place of each word; see ``gather``."""
        if self.count > self.keep:
            self._forget()
        out = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        missing = np.flatnonzero(out < 0).tolist()
        if missing:
            new = list(dict.fromkeys([words[k] for k in missing]))
            values, lengths = self.make(new)
            self._add(values, lengths)
            own = dict(zip(new, range(self.count - len(new), self.count)))
            self.known.update((w, k) for w, k in own.items() if len(w) <= self.longest)
            out[missing] = [own[words[k]] for k in missing]
        return out

    def _add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        n, m = len(lengths), len(values)
        while self.count + n > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lengths))
        if self.pool is None:
            self.pool = np.zeros(1 << 14, values.dtype)
        while self.used + m > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used:self.used + m] = values
        self.lengths[self.count:self.count + n] = lengths
        self.starts[self.count:self.count + n] = self.used + np.cumsum(lengths) - lengths
        self.count, self.used = self.count + n, self.used + m

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of the words with these places end to end, and their lengths."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return np.zeros(0, np.int64 if self.pool is None else self.pool.dtype), lengths
        return self.pool[np.repeat(self.starts[numbers] - (ends - lengths), lengths) + np.arange(total)], lengths


def windows(words: list[str], size: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the windows of ``size`` characters within each word, and how many each word has.

    A word begins with ``pad`` marks and ends with one. A character is 12 bits (its code point modulo 4093, so that only
    characters beyond those of alphabets share codes), ``size`` at most 5.
    """
    text = "".join(["\x01" * pad + w + "\x02" for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) % 4093
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + pad + 1
    counts = np.maximum(lengths - size + 1, 0)
    starts = np.cumsum(lengths) - lengths
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - counts), counts) + np.arange(total)
    codes = np.zeros(total, np.int64)
    for k in range(size):
        codes = codes << 12 | points[at + k]
    return codes, counts
