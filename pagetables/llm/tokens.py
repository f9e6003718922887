"""Token ids of whole texts, by the tokenizers library, with the words that recur encoded once."""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import repeat

import numpy as np

from .worker import held

_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: Pieces of Latin words, marks and single line ends. The pre-tokenizers known here cut between all of these.
_SIMPLE = re.compile(rf"([{_LETTERS}]++|[.,;:!?]++)(?:[{_LETTERS}]++|[.,;:!?]++|\n(?=[{_LETTERS}]))*+")
_MARKS = frozenset(".,;:!?")
_SEGMENT = re.compile(rf"[{_LETTERS}]+|[.,;:!?]+|\n")


#: Stands before a piece that follows the one before without a space; texts that hold it are not cut so.
_GLUED = "\x01"
#: Marks after a letter, and a single line end between a mark or letter and a letter, are pieces of their own in any case.
_MARK = (rf"([{_LETTERS}])([.,;:!?])", rf"\1 {_GLUED}\2")
_LINE = (rf"([{_LETTERS}.,;:!?])\n([{_LETTERS}])", f"\\1 {_GLUED}\n {_GLUED}\\2")


# The normalizer and the cuts of word tokenizers that are known here.
_WORD_FORM = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_CUTS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]

#: White space right after a space belongs to the piece before.
_ODD = r"^(?:$|[\s\x1c-\x1f\x{85}\p{Z}])"


class WordCoder:
    """Encodes texts as ``Tokenizer.encode_batch(..., add_special_tokens=False)`` does, piece by piece.

    Byte-pair merges never cross the pre-tokenizer's cuts. For the two kinds of file known here a
    space followed by anything but white space always is such a cut, so the pieces between spaces
    can be encoded on their own and remembered; new pieces of plain words and marks are made of
    remembered words. Files of other kinds are encoded text by text.

    ``keep`` bounds the memory: with twice as many pieces known, the most frequent are kept. A piece longer than ``longest`` is encoded and not kept.
    """

    def __init__(self, path: str, keep: int = 200_000, longest: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keep, self.longest = keep, longest
        pre, normal = shape.get("pre_tokenizer") or {}, shape.get("normalizer")
        #: the space belongs to the word after it
        self.prefixed = pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not normal and not pre.get("add_prefix_space")
        cuts = [{k: v for k, v in p.items() if k != "trim_offsets"} for p in pre.get("pretokenizers") or []]
        #: white space is dropped, and letters are in lower case
        self.dropped = pre.get("type") == "Sequence" and cuts == _WORD_CUTS and normal == _WORD_FORM
        if shape["model"].get("type") != "BPE" or shape["model"].get("dropout") or not all(t["special"] for t in shape.get("added_tokens") or []):
            self.prefixed = self.dropped = False
        self.lead = " " if self.prefixed else ""
        vocab = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        suffix = shape["model"].get("end_of_word_suffix")
        for word, k in vocab.items():
            # a word joined by spaces shows in its ids where it begins, or where it ends
            self.edge[k] = word.startswith("\u0120") if self.prefixed else bool(suffix) and word.endswith(suffix)
        self.marked = self.prefixed or bool(suffix)
        #: plain words come cut and, where white space is dropped, in lower case: the model alone has to act
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "merged_with_next") if self.prefixed else pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        self.tokenizer.model._resize_cache(0)  # words are remembered here
        self._forget()

    def _forget(self) -> None:
        #: pieces with the space before them, and pieces without
        self.tables = {name: {} for name in ("after", "bare")}
        self.starts, self.lengths, self.hits = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.count = 0
        self.pool, self.used = np.zeros(1 << 18, np.int32), 0

    def _shrink(self) -> None:
        """Forget what was met once, and of the rest all but the most frequent."""
        tables, starts, lengths, hits, pool = self.tables, self.starts, self.lengths, self.hits, self.pool
        self._forget()
        for name, table in tables.items():
            names = list(table)
            numbers = np.fromiter(table.values(), np.int64, len(names))
            often = np.flatnonzero(hits[numbers] > 1)
            if len(often) > self.keep // 2:
                often = often[np.argpartition(-hits[numbers[often]], self.keep // 2)[:self.keep // 2]]
            own = numbers[often]
            first = self._add(_gather(pool, starts[own], lengths[own]), lengths[own])
            self.tables[name] = dict(zip([names[k] for k in often], range(first, first + len(often))))

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Put the ids of new pieces into the pool; the number of the first."""
        first, n, m = self.count, len(lengths), len(ids)
        while self.count + n > len(self.starts):
            self.starts, self.lengths, self.hits = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lengths, self.hits))
        while self.used + m > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used:self.used + m] = ids
        self.lengths[first:first + n] = lengths
        self.starts[first:first + n] = self.used + np.cumsum(lengths) - lengths
        self.count, self.used = first + n, self.used + m
        return first

    def _numbers(self, pieces: list[str], name: str) -> np.ndarray:
        table = self.tables[name]
        numbers = np.fromiter(map(table.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            new = [pieces[k] for k in missing]
            own = self._learn(list(dict.fromkeys(new)), name)
            numbers[missing] = list(map(own.__getitem__, new))
        met = np.bincount(numbers, minlength=1)
        self.hits[:len(met)] += met
        return numbers

    def _learn(self, new: list[str], name: str) -> dict[str, int]:
        """Numbers of new pieces: words encoded, plain pieces made of words, others encoded whole."""
        lead = self.lead if name == "after" else ""
        words, made, other = [], [], []
        for p in new:
            found = _SIMPLE.match(p) if len(p) <= self.longest else None
            if not found or found.end() < len(p):
                other.append(p)
            elif found.end(1) == len(p):
                (other if p[0] in _MARKS else words).append(p)
            else:
                made.append(p)
        own = self._words(words, lead) if self.marked and (lead or self.dropped) else self._encoded(words, lead)
        self.tables[name].update(own)
        if made:
            parts = [_SEGMENT.findall(p) for p in made]
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            at = np.cumsum(counts) - counts
            if lead:
                first = np.zeros(int(counts.sum()), bool)
                first[at] = True
                numbers = np.zeros(len(first), np.int64)
                numbers[first] = self._numbers([p[0] for p in parts], "after")
                numbers[~first] = self._numbers([w for p in parts for w in p[1:]], "bare")
            else:
                numbers = self._numbers([w for p in parts for w in p], "bare")
            sizes = self.lengths[numbers]
            start = self._add(_gather(self.pool, self.starts[numbers], sizes), np.add.reduceat(sizes, at))
            composed = dict(zip(made, range(start, start + len(made))))
            self.tables[name].update(composed)
            own.update(composed)
        if other:
            whole = self._encoded(other, lead)
            self.tables[name].update((p, k) for p, k in whole.items() if len(p) <= self.longest)
            own.update(whole)
        return own

    def _words(self, new: list[str], lead: str) -> dict[str, int]:
        """Numbers of new words, encoded many at once; their ids show where each begins or ends."""
        own: dict[str, int] = {}
        for at in range(0, len(new), 512):
            part = new[at:at + 512]
            line = " " + " ".join(part)
            ids = np.array(self.model.encode_batch_fast([line if self.prefixed else line.lower()], add_special_tokens=False)[0].ids, np.int32)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(part):
                own.update(self._encoded(part, lead))
                continue
            cuts = np.append(edges, len(ids)) if self.prefixed else np.insert(edges + 1, 0, 0)
            first = self._add(ids, np.diff(cuts))
            own.update(zip(part, range(first, first + len(part))))
        return own

    def _encoded(self, new: list[str], lead: str) -> dict[str, int]:
        own: dict[str, int] = {}
        for at in range(0, len(new), 256):
            part = new[at:at + 256]
            ids, lengths = _joined(self._plain([lead + p for p in part]))
            first = self._add(ids, lengths)
            own.update(zip(part, range(first, first + len(part))))
        return own

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow string column end to end, and how many each text has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        if not (self.prefixed or self.dropped):
            return _joined(self._plain(texts.to_pylist()))
        if self.count > 2 * self.keep or self.used > 16 * self.keep:
            self._shrink()
        if self.dropped:
            # lower case comes anyway, and a mark after a letter is a word of its own: fewer words differ
            spaced = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z0-9])([.,;:!?])", r"\1 \2")
            lists = pc.ascii_split_whitespace(spaced)
        else:
            spaced = texts
            if not pc.any(pc.match_substring(texts, _GLUED)).as_py():
                # fewer pieces differ: a word is the same before a mark, a line end and a space
                spaced = pc.replace_substring_regex(pc.replace_substring_regex(texts, *_MARK), *_LINE)
            lists = pc.split_pattern(spaced, " ")
        offsets = np.asarray(lists.offsets).astype(np.int64)
        flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        place, distinct = np.asarray(coded.indices), coded.dictionary.to_pylist()
        counts = np.diff(offsets)
        if not self.prefixed:
            numbers = self._numbers(distinct, "bare")[place]
            return self._runs(numbers, counts)
        inner = np.ones(len(place), bool)
        inner[offsets[:-1]] = False
        used = np.flatnonzero(np.bincount(place[inner], minlength=len(distinct)))
        of = np.zeros(len(distinct), np.int64)
        odd = used[np.asarray(pc.match_substring_regex(coded.dictionary, _ODD))[used]]
        if len(odd):
            # white space right after a space isn't a cut: such texts are encoded whole
            strange = np.zeros(len(distinct), bool)
            strange[odd] = True
            text_of = np.repeat(np.arange(len(counts)), counts)
            whole = np.zeros(len(counts), bool)
            whole[text_of[inner & strange[place]]] = True
            return self._merged(texts, whole)
        glued = np.zeros(len(distinct), bool)
        if spaced is not texts:
            glued = np.asarray(pc.starts_with(coded.dictionary, _GLUED))
        apart, along = used[~glued[used]], used[glued[used]]
        of[apart] = self._numbers([distinct[k] for k in apart.tolist()], "after")
        of[along] = self._numbers([distinct[k][1:] for k in along.tolist()], "bare")
        numbers = of[place]
        numbers[offsets[:-1]] = self._numbers([distinct[k] for k in place[offsets[:-1]]], "bare")
        return self._runs(numbers, counts)

    def _runs(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers]
        sums, upto = np.concatenate(([0], np.cumsum(lengths))), np.cumsum(counts)
        return _gather(self.pool, self.starts[numbers], lengths), sums[upto] - sums[upto - counts]

    def _merged(self, texts, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa

        strange, strange_lengths = _joined(self._plain(texts.filter(pa.array(whole)).to_pylist()))
        plain, plain_lengths = self.encode(texts.filter(pa.array(~whole))) if not whole.all() else _joined([])
        lengths = np.zeros(len(whole), np.int64)
        lengths[whole], lengths[~whole] = strange_lengths, plain_lengths
        from_strange = np.repeat(whole, lengths)
        ids = np.zeros(len(from_strange), np.int32)
        ids[from_strange], ids[~from_strange] = strange, plain
        return ids, lengths


def _joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def coder(path: str, keep: int = 200_000) -> WordCoder:
    """The coder that this worker holds from task to task."""
    return held(lambda: WordCoder(path, keep), path, keep)


def batches(texts, chars: int = 2_000_000):
    """Spans of an Arrow string column of about so many characters; a longer text is a span of its own."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))
    begin, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and total + size > chars:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
