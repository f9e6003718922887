"""Language-model scoring with an Elias-Fano trie of words and word pairs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import parts_for, text_of
from .eliasfano import EliasFano, dump, load
from .worker import held

#: The end of a text as a token, and as the context of its first word: the hash of the empty word, which no text has.
END = 17241709254077376921  # XXH64 of no bytes with seed 0


@dataclass(frozen=True)
class LmParams:
    word_shard_bytes: int = 64 << 20  # of input to a shard of the level of words
    pair_shard_tokens: int = 3_000_000  # to a shard of the level of pairs
    flush: int = 2_500_000  # tokens whose pairs a task holds before it sends them on
    bins: int = 4096  # of the quantised likelihoods
    pair_discount: float = 0.75


@dataclass(frozen=True)
class LmModel:
    """Where the trie lies and the few numbers that all of it shares: one row per shard at most."""

    path: str
    bits: int  # word shards, as the first bits of a hash
    first_word: np.ndarray  # number of each word shard's first word
    first_count: np.ndarray  # tokens before each word shard
    tokens: int  # N
    words: int  # V
    pair_shards: int
    discount: float  # of words
    pair_discount: float
    split: dict  # contexts whose successors lie in several shards, with how many they have
    pair_files: frozenset = frozenset()  # shards that have pairs


# --- tokens ---


def _split(texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Distinct words of whole texts, the place of each token's word among them, and the words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    place = np.asarray(coded.indices)
    lengths = np.asarray(pc.binary_length(coded.dictionary))
    full = lengths[place] > 0  # the splitter gives an empty word at either end
    counts = np.bincount(np.repeat(np.arange(len(texts)), np.diff(offsets)), weights=full, minlength=len(texts)).astype(np.int64)
    return place[full], coded.dictionary.cast(pa.binary()).to_pylist(), counts


def _hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, all_counts = every[order], all_counts[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


def _pressed(numbers: np.ndarray) -> bytes:
    """Sorted or small numbers, byte by byte place, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def _unpressed(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


PACKED = "shard int, keys binary, counts binary"


def _packed(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """One row for each run of equal shards of sorted keys."""
    edges = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))) if len(shards) else np.zeros(0, np.int64)
    ends = np.append(edges[1:], len(shards))
    rows = [
        (int(shards[a]), _pressed(np.diff(keys[a:b], prepend=np.uint64(0))), _pressed(counts[a:b].astype(np.uint32))) for a, b in zip(edges, ends)
    ]
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["shard", "keys", "counts"])


def _unpacked(stream):
    """The rows of each shard, from rows sorted by shard."""
    shard, keys, counts = None, [], []
    for batch in stream:
        for k in range(batch.num_rows):
            own = batch.column(0)[k].as_py()
            if own != shard and keys:
                yield shard, *_merge(keys, counts)
                keys, counts = [], []
            shard = own
            keys.append(np.cumsum(_unpressed(batch.column(1)[k].as_py(), np.uint64), dtype=np.uint64))
            counts.append(_unpressed(batch.column(2)[k].as_py(), np.uint32).astype(np.int64))
            if len(keys) > 64:  # rows of one shard are merged as they come
                merged = _merge(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
    if keys:
        yield shard, *_merge(keys, counts)


# --- the level of words ---


def fit(train: DataFrame, path: str, text_column: str = "text", params: LmParams = LmParams()) -> LmModel:
    """Count all words and all pairs of neighbouring tokens of the training texts, and write the trie under ``path``.

    Counts are merged per task, sent packed to the shard of their range and written there: words by ranges of their hash,
    pairs by ranges of context and word. A frequent context is spread over shards by its words, so
    no shard grows with one word. The driver sees one row per shard.
    """
    spark = train.sparkSession
    texts = train.select(text_of(text_column).alias("text"))
    bits = max(3, (parts_for(texts, params.word_shard_bytes) - 1).bit_length())
    shards = 1 << bits

    def count_words(stream):
        keys, counts, held = [], [], 0
        from .tokens import batches

        def flush():
            merged, total = _merge(keys, counts)
            return _packed((merged >> np.uint64(64 - bits)).astype(np.int64), merged, total)

        for batch in stream:
            for a, b in batches(batch.column(0)):
                place, words, _ = _split(batch.column(0).slice(a, b - a))
                keys.append(np.append(_hashed(words), np.uint64(END)))
                counts.append(np.append(np.bincount(place, minlength=len(words)), b - a))
                held += len(words)
                if held > params.flush:
                    yield flush()
                    keys, counts, held = [], [], 0
        if keys:
            yield flush()

    def write_words(stream):
        for shard, keys, counts in _unpacked(stream):
            seen = counts > 0
            keys, counts = keys[seen], counts[seen]
            level = EliasFano.of(keys - (np.uint64(shard) << np.uint64(64 - bits)))
            before = EliasFano.of(np.concatenate(([0], np.cumsum(counts))))
            _write(path, f"words-{shard:06d}.trie", level.arrays("words") | before.arrays("before"))
            yield _shard_row(shard, len(keys), int(counts.sum()), int((counts == 1).sum()), int((counts == 2).sum()))

    sent = texts.mapInArrow(count_words, PACKED).repartition(shards, "shard").sortWithinPartitions("shard")
    sent.mapInArrow(write_words, SHARD).write.parquet(f"{path}/words")
    words = {r.shard: r for r in spark.read.parquet(f"{path}/words").collect()}
    sizes = np.array([words[k].entries if k in words else 0 for k in range(shards)], np.int64)
    tokens = np.array([words[k].tokens if k in words else 0 for k in range(shards)], np.int64)
    n, v = int(tokens.sum()), int(sizes.sum())
    parts = max(1, -(-n // params.pair_shard_tokens))
    model = LmModel(path, bits, np.cumsum(sizes) - sizes, np.cumsum(tokens) - tokens, n, v, parts, _discount(words.values()), params.pair_discount, {})
    if not n:
        return model

    def count_pairs(stream):
        from .tokens import batches

        trie, keys, held = Trie(model), [], 0

        def flush():
            merged, total = _merge(keys, [np.ones(len(k), np.int64) for k in keys])
            return _packed(trie.pair_shard(merged), merged, total)

        for batch in stream:
            for a, b in batches(batch.column(0)):
                own = trie.tokens(batch.column(0).slice(a, b - a))[0]
                keys.append(_pairs(own, trie.end))
                held += len(own)
                if held > params.flush:
                    yield flush()
                    keys, held = [], 0
        if keys:
            yield flush()

    def write_pairs(stream):
        trie = Trie(model)
        for shard, keys, counts in _unpacked(stream):
            context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
            contexts, kinds = context[first], np.diff(np.append(first, len(keys)))
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            # successors within their context: each context starts where the one before ends
            widths = word[np.append(first[1:], len(keys)) - 1] + 1
            offsets = np.cumsum(widths) - widths
            likelihood = (counts - params.pair_discount) / np.repeat(trie.counts_of(contexts)[1], kinds)
            codes, book = _quantised(np.log10(likelihood), params.bins)
            arrays = EliasFano.of(contexts).arrays("contexts") | EliasFano.of(np.append(first, len(keys))).arrays("pointers")
            arrays |= EliasFano.of(offsets).arrays("offsets") | EliasFano.of(word + np.repeat(offsets, kinds)).arrays("successors")
            _write(path, f"pairs-{shard:06d}.trie", arrays | {"codes": codes, "book": book})
            yield _shard_row(shard, len(keys), int(counts.sum()), ones, twos, int(contexts[0]), int(kinds[0]), int(contexts[-1]), int(kinds[-1]))

    sent = texts.mapInArrow(count_pairs, PACKED).repartition(parts, "shard").sortWithinPartitions("shard")
    sent.mapInArrow(write_pairs, SHARD).write.parquet(f"{path}/pairs")
    pairs = spark.read.parquet(f"{path}/pairs").collect()
    ends: dict[int, dict[int, int]] = {}
    for r in pairs:
        ends.setdefault(r.first, {})[r.shard] = r.first_kinds
        ends.setdefault(r.last, {})[r.shard] = r.last_kinds
    split = {c: sum(by.values()) for c, by in ends.items() if len(by) > 1}
    return LmModel(path, bits, model.first_word, model.first_count, n, v, parts, model.discount, params.pair_discount, split, frozenset(r.shard for r in pairs))


SHARD = "shard int, entries long, tokens long, ones long, twos long, first long, first_kinds long, last long, last_kinds long"


def _shard_row(shard: int, *numbers: int):
    numbers = [*numbers, *[0] * (8 - len(numbers))]
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *[pa.array([n], pa.int64()) for n in numbers]], names=[x.split()[0] for x in SHARD.split(", ")])


def _discount(shards) -> float:
    """Absolute discount from how many entries were counted once and twice."""
    ones, twos = sum(r.ones for r in shards), sum(r.twos for r in shards)
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _quantised(values: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of equal steps between the least and the largest value, and the value that each code stands for."""
    low, high = float(values.min()), float(values.max())
    step = (high - low) / (bins - 1) or 1.0
    codes = np.rint((values - low) / step).astype(np.int64)
    return codes.astype(np.uint8 if bins <= 256 else np.uint16), low + step * np.arange(bins)


def _write(path: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    from .files import Committed

    file = Committed(path, name, TaskContext.get().taskAttemptId())
    file.write(dump(arrays))
    file.commit()


def _pairs(tokens: np.ndarray, end: int) -> np.ndarray:
    """Context and word of each token; the context of a text's first token is the end before it."""
    before = np.concatenate(([end], tokens[:-1]))
    return before.astype(np.uint64) << np.uint64(32) | tokens.astype(np.uint64)


@lru_cache(maxsize=512)
def _level(uri: str) -> dict:
    """A shard's sequences, opened once per worker."""
    arrays = load(uri)
    names = {name.split(".")[0] for name in arrays if name.endswith(".shape")}
    return {name: EliasFano.from_arrays(arrays, name) for name in names} | {k: v for k, v in arrays.items() if "." not in k}


class Trie:
    """Lookups in the trie. A shard is opened when the first query needs it."""

    def __init__(self, model: LmModel):
        self.model = model
        self.end = int(self.words(np.array([END], np.uint64))[0][0]) if model.tokens else -1

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, -1 if unknown, and how often it was seen."""
        m = self.model
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if not m.tokens:
            return ids, counts
        order = np.argsort(hashes)
        shards = (hashes[order] >> np.uint64(64 - m.bits)).astype(np.int64)
        for a, b in _runs(shards):
            shard, own = int(shards[a]), order[a:b]
            if self._words_in(shard):
                level = _level(f"{m.path}/words-{shard:06d}.trie")
                at = level["words"].find(hashes[own] - (np.uint64(shard) << np.uint64(64 - m.bits)))
                known = own[at >= 0]
                at = at[at >= 0]
                ids[known] = m.first_word[shard] + at
                counts[known] = (level["before"].at(at + 1) - level["before"].at(at)).astype(np.int64)
        return ids, counts

    def _words_in(self, shard: int) -> int:
        after = self.model.first_word[shard + 1] if shard + 1 < len(self.model.first_word) else self.model.words
        return int(after - self.model.first_word[shard])

    def counts_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rising numbers of known words: the tokens of all words before, and their own."""
        m = self.model
        before, counts = np.zeros(len(ids)), np.zeros(len(ids))
        shards = np.searchsorted(m.first_word, ids, side="right") - 1
        for a, b in _runs(shards):
            shard = int(shards[a])
            sums = _level(f"{m.path}/words-{shard:06d}.trie")["before"]
            at = ids[a:b] - m.first_word[shard]
            low = sums.at(at).astype(np.float64)
            before[a:b], counts[a:b] = low + m.first_count[shard], sums.at(at + 1).astype(np.float64) - low
        return before, counts

    def tokens(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers and counts of all tokens of the texts, each text's end included, and how many each has."""
        place, words, lengths = _split(texts)
        ids, counts = self.words(np.append(_hashed(words), np.uint64(END)))
        every = np.insert(place, np.cumsum(lengths), len(words))
        return ids[every], counts[every], lengths + 1

    def pair_shard(self, keys: np.ndarray) -> np.ndarray:
        """The shard of each pair of rising keys: its place if words followed each other at random, which deals contexts evenly."""
        m = self.model
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        contexts, of = _distinct(context)
        before, own = self.counts_of(contexts)
        words, back = np.unique(word, return_inverse=True)
        share = self.counts_of(words)[0] / m.tokens
        return np.minimum(((before[of] + own[of] * share[back]) / m.tokens * m.pair_shards).astype(np.int64), m.pair_shards - 1)

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """The discounted likelihood of each of rising keys, 0 for pairs not seen."""
        m, out = self.model, np.zeros(len(keys))
        shards = self.pair_shard(keys)
        for a, b in _runs(shards):
            level = self._pair_level(int(shards[a]))
            if level is None:
                continue
            context, word = (keys[a:b] >> np.uint64(32)).astype(np.int64), (keys[a:b] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            contexts, of = _distinct(context)
            at = level["contexts"].find(contexts)
            known = at >= 0
            at = np.where(known, at, 0)
            offset, end = level["offsets"].at(at).astype(np.int64), level["pointers"].at(at + 1).astype(np.int64)
            asked = np.flatnonzero(known[of])
            place = level["successors"].find(offset[of[asked]] + word[asked])
            # beyond a context's last successor the next context's begin
            hit = (place >= 0) & (place < end[of[asked]])
            out[a + asked[hit]] = 10.0 ** level["book"][level["codes"][place[hit]]].astype(float)
        return out

    def kinds(self, contexts: np.ndarray) -> np.ndarray:
        """How many words follow each of rising contexts."""
        m = self.model
        before, own = self.counts_of(contexts)
        first = np.minimum((before / m.tokens * m.pair_shards).astype(np.int64), m.pair_shards - 1)
        last = np.minimum(((before + own) / m.tokens * m.pair_shards).astype(np.int64), m.pair_shards - 1)
        out = np.zeros(len(contexts), np.int64)
        for a, b in _runs(first):
            open_ = np.arange(a, b)
            shard = int(first[a])
            while len(open_):  # only a context at a shard's edge begins in a later one
                level = self._pair_level(shard)
                if level is not None:
                    at = level["contexts"].find(contexts[open_])
                    hit = at >= 0
                    pointers = level["pointers"]
                    out[open_[hit]] = (pointers.at(at[hit] + 1) - pointers.at(at[hit])).astype(np.int64)
                    open_ = open_[~hit]
                shard += 1
                open_ = open_[last[open_] >= shard]
        for k in np.flatnonzero(np.isin(contexts, np.array(list(m.split), np.int64))).tolist() if m.split else []:
            out[k] = m.split[int(contexts[k])]
        return out

    def _pair_level(self, shard: int):
        if shard not in self.model.pair_files:
            return None
        return _level(f"{self.model.path}/pairs-{shard:06d}.trie")


def _distinct(rising: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.concatenate(([True], rising[1:] != rising[:-1])) if len(rising) else np.zeros(0, bool)
    return rising[new], np.cumsum(new) - 1


def _runs(values: np.ndarray):
    """Spans of equal neighbours."""
    if not len(values):
        return
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(values)])


# --- scores ---


def _scores(trie: Trie, texts) -> tuple[np.ndarray, ...]:
    m = trie.model
    ids, counts, lengths = trie.tokens(texts)
    first = np.cumsum(lengths) - lengths
    base = np.log10((counts + 1) / (m.tokens + (m.words + 1)))
    if m.tokens:
        single = (np.maximum(counts - m.discount, 0) + m.discount * m.words / (m.words + 1)) / m.tokens
        before = np.concatenate(([trie.end], ids[:-1]))
        likelihood, rest = np.zeros(len(ids)), np.ones(len(ids))
        seen = np.flatnonzero(before >= 0)
        contexts, of = np.unique(before[seen], return_inverse=True)
        weight = m.pair_discount * trie.kinds(contexts) / np.maximum(trie.counts_of(contexts)[1], 1)
        rest[seen] = np.where(weight > 0, weight, 1.0)[of]
        both = np.flatnonzero((before >= 0) & (ids >= 0))
        keys, back = np.unique(before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64), return_inverse=True)
        likelihood[both] = trie.pairs(keys)[back]
        score = np.log10(likelihood + rest * single)
    else:
        score = base
    return lengths, np.add.reduceat(counts > 0, first, dtype=np.int64), np.add.reduceat(base, first), np.add.reduceat(score, first)


SCORES = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, keep: list[str], model: LmModel, text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with n_tokens, n_known, base_score and score, the log10 likelihood of the whole text.

    A pair's likelihood is its discounted share of its context plus what the discount left, times the word's own; a word never seen has
    an even share of what the words' discount left. Pairs are looked up in rising order, shard by shard.
    A null or empty text is an end alone. Without training texts the score is the base score. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers per shard

    def run(stream):
        from .tokens import batches

        trie = held(lambda: Trie(shared.value), shared.value.path)
        for batch in stream:
            texts = batch.column(batch.num_columns - 1)
            for a, b in batches(texts):
                found = _scores(trie, texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in range(batch.num_columns - 1)], *map(pa.array, found)],
                    names=[*batch.schema.names[:-1], *[x.split()[0] for x in SCORES.split(", ")]],
                )

    rows = docs.select(*keep, text_of(text_column).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, {SCORES}")
