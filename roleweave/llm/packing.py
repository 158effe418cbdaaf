"""Operator 12, best-fit packing of tokenized documents under several capacities.

1. One pass tokenizes whole texts, ends each document with an id of its own, cuts those that are longer than a sequence
   and writes one row for each piece: its place in the document, its length and a checksum of its ids.
2. What a piece asks of a sequence (tokens, one document, attention cost, the square of its length) follows from its
   length. So the counts of the lengths, at most as many rows as a sequence has tokens, say all there is to pack, and
   the vector best-fit runs over them: longest pieces first, each into the sequence whose residual capacities fit best
   by the weighted norm of what would be left, or the weighted dot product with what is asked, under every constraint.
   Sequences with the same content are one group, and pieces of a length fill a group at once, so the plan's size
   follows the number of lengths and not that of the documents. The result is the same as piece by piece.
3. Each piece gets its number among those of its length (a range shuffle without hot keys, however common a length is),
   and finds its sequence and offset in the plan.

Null text is the empty text, which is one id. Repeated rows and rows without an id, or with a shared one, are packed
each for itself. An empty table gives no sequences. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.operators.ordering import with_position
from roleweave.session import stage

# The id that ends a document.
END = 1
TOKENIZER = "word_bpe_49k.json"
# Distinct words from which on a task forgets those it met in one slice only; words that are encoded as one text.
WORDS_HELD, JOINED = 400_000, 1000
_APART, _STOPS = ~arrays.byte_class(" \n\t\r"), arrays.byte_class(".,:;!?")


@dataclass
class Capacity:
    """Limits of a sequence, and how much each counts when sequences are compared.

    By default tokens alone limit: a sequence of `tokens` can't hold more documents, nor cost more attention.
    """

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.int64)

    def longest(self) -> int:
        """Tokens of the longest piece that any sequence can hold."""
        return min(self.tokens, int(np.sqrt(self.attention)))


def lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with the letters A-Z and those of Latin-1 lower-cased, and flags of the bytes of such letters.

    These letters are lower-cased one by one, and Unicode normalization leaves words of them alone.
    """
    low = np.frombuffer(data.tobytes().translate(arrays.ASCII_LOWER), dtype=np.uint8).copy()
    flags = (low >= 97) & (low <= 122)
    second = np.flatnonzero(low[:-1] == 0xC3) + 1
    letters = second[(low[second] != 0x97) & (low[second] != 0xB7)]
    capital = letters[low[letters] < 0x9F]
    low[capital] += 0x20
    flags[letters] = flags[letters - 1] = True
    return low, flags


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of spans, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class WordIds:
    """Ids of texts from those of their words.

    Holds for tokenizers that drop white space, never join what stands on both sides of it, and take letters apart from
    a stop behind them. Others are asked for whole texts (`apart=False`). Words are looked up by a hash, and their bytes
    are compared.
    """

    def __init__(self, path: str, apart: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.apart, self.hasher = Tokenizer.from_file(path), apart, arrays.Hasher()
        # Tokens that end a word.
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[number] = token.endswith("</w>")
        self.stop = np.zeros(256, dtype=np.uint32)
        for byte in np.flatnonzero(_STOPS).tolist() if apart else ():
            (self.stop[byte],) = self.encoded([chr(byte)])[0]
        self.key, self.hits = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        # Where a word's bytes and ids start, and how many they are.
        self.at, self.length, self.first, self.size = (np.zeros(0, np.int64) for _ in range(4))
        self._sort()

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _sort(self) -> None:
        self.order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[self.order]

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Number of the word of each key, -1 if it isn't known."""
        if not len(self.key):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.key) - 1)
        return np.where(self.sorted[at] == keys, self.order[at], -1)

    def forget(self) -> None:
        """Forget the words that were met in one slice only; all, if the others are too many."""
        kept = np.flatnonzero(self.hits > 1)
        kept = kept if 2 * len(kept) <= WORDS_HELD else kept[:0]
        self.bytes, self.ids = self.bytes[gathered(self.at[kept], self.length[kept])], self.ids[gathered(self.first[kept], self.size[kept])]
        self.key, self.length, self.size = self.key[kept], self.length[kept], self.size[kept]
        self.at, self.first = np.cumsum(self.length) - self.length, np.cumsum(self.size) - self.size
        self.hits = np.zeros(len(kept), np.int64)
        self._sort()

    def _spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters and how many each has. As each has one token that ends a word, many are one text."""
        ids = np.concatenate([np.zeros(0, np.uint32), *self.encoded([" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)])])
        stops = np.flatnonzero(self.ends[ids]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(words) else self._each(words)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encoded(words)
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], dtype=np.int64)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray, keys: np.ndarray) -> None:
        """Make these words known."""
        raw = data.tobytes()
        for some, ask in ((np.flatnonzero(plain), self._spelled), (np.flatnonzero(~plain), self._each)):
            ids, sizes = ask([raw[a:b].decode() for a, b in zip(starts[some].tolist(), ends[some].tolist())])
            lengths = ends[some] - starts[some]
            self.at = np.concatenate((self.at, len(self.bytes) + np.cumsum(lengths) - lengths))
            self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(sizes) - sizes))
            self.length, self.size = np.concatenate((self.length, lengths)), np.concatenate((self.size, sizes))
            self.bytes, self.ids = np.concatenate((self.bytes, data[gathered(starts[some], lengths)])), np.concatenate((self.ids, ids))
            self.key, self.hits = np.concatenate((self.key, keys[some])), np.concatenate((self.hits, np.ones(len(some), np.int64)))
        self._sort()

    def of(self, texts: arrays.Texts) -> list[np.ndarray]:
        """Ids of each text."""
        data, spans = texts.data, arrays.words(texts, _APART)
        if not self.apart:
            return self._whole(texts)
        if len(self.key) > WORDS_HELD:
            self.forget()
        low, letters = lowered(data)
        starts, ends = spans.starts, spans.ends
        sums = np.concatenate(([0], np.cumsum(letters)))
        stop = _STOPS[data[ends - 1]] & (ends - starts > 1)
        plain = sums[ends - stop] - sums[starts] == ends - stop - starts
        stop &= plain
        ends = ends - stop
        # Words of anything else are taken as they are.
        other = gathered(starts[~plain], (ends - starts)[~plain])
        low[other] = data[other]
        keys = self.hasher.spans(low, starts, ends)
        keys = np.where(plain, keys, arrays.mixed(~keys))
        unique, example, which = np.unique(keys, return_index=True, return_inverse=True)
        numbers = self.known(unique)
        self.hits[numbers[numbers >= 0]] += 1
        new = example[numbers < 0]
        if len(new):
            self.learn(low, starts[new], ends[new], plain[new], unique[numbers < 0])
            numbers = self.known(unique)
        at = numbers[which]
        same = np.array_equal(self.length[at], ends - starts)
        if not same or not np.array_equal(self.bytes[gathered(self.at[at], self.length[at])], low[gathered(starts, ends - starts)]):
            return self._whole(texts)  # hashes that collide
        sizes = self.size[at]
        before = np.cumsum(sizes + stop) - sizes - stop
        out = np.empty(int((sizes + stop).sum()), np.uint32)
        out[gathered(before, sizes)] = self.ids[gathered(self.first[at], sizes)]
        out[(before + sizes)[stop]] = self.stop[data[ends[stop]]]
        cuts = np.concatenate((before, [len(out)]))[spans.first]
        return [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _whole(self, texts: arrays.Texts) -> list[np.ndarray]:
        raw = texts.data.tobytes()
        return self.encoded([raw[a:b].decode() for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())])


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Encoder:
    """Tokenizes texts in tasks; the words it has met are kept in the worker."""

    path: str
    apart: bool = True
    _words: WordIds | None = field(default=None, repr=False)

    def of(self, texts: arrays.Texts) -> list[np.ndarray]:
        if self._words is None:
            self._words = WordIds(self.path, self.apart)
        return self._words.of(texts)


def _cut(encoder, limit: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            rows, part, start, length, sums, ids = [], [], [], [], [], []
            for row, own in enumerate(encoder().of(arrays.texts_of(batch.column("text")))):
                own = np.append(own, np.uint32(END)).astype("<u4")
                for k, at in enumerate(range(0, len(own), limit)):
                    cut = own[at : at + limit]
                    rows.append(row)
                    part.append(k)
                    start.append(at)
                    length.append(len(cut))
                    sums.append(zlib.crc32(cut.tobytes()))
                    ids.append(cut.astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(part, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, sums)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def load(name: str = TOKENIZER) -> Encoder:
    """A tokenizer by the name of its public file."""
    import public_tokenizers

    return Encoder(public_tokenizers.path(name))


def pieces(docs: DataFrame, encoder: Encoder, limit: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 (and the ids) of every piece of at most `limit` tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(arrays.shared(docs.sparkSession, encoder), limit, with_ids), _PIECES + (", ids array<int>" if with_ids else ""))


@dataclass
class Plan:
    """Placements: pieces number `first` and on of a length fill `bins` sequences from `sequence` on, `each` to a sequence."""

    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0

    def add(self, *values: int) -> None:
        for column, value in zip((self.length, self.first, self.sequence, self.each, self.offset), values):
            column.append(int(value))


def scored(left: np.ndarray, asked: np.ndarray, capacity: Capacity) -> np.ndarray:
    """How much room sequences with these residual capacities would have left; the least fits best."""
    weights, limits = np.array(capacity.weights), capacity.limits()
    if capacity.rule == "dot":
        return ((left / limits) * (asked / limits) * weights).sum(axis=1)
    return np.sqrt((((left - asked) / limits) ** 2 * weights).sum(axis=1))


def plan(counts: dict[int, int], capacity: Capacity) -> Plan:
    """Vector best-fit of `counts` pieces by length, longest first, over groups of sequences that are alike."""
    out, limits = Plan(), capacity.limits()
    # Groups of sequences: residual capacities, first sequence, and how many.
    left, start, many = np.zeros((16, 3), np.int64), np.zeros(16, np.int64), np.zeros(16, np.int64)
    groups = 0

    def group(residual: np.ndarray, at: int, n: int) -> None:
        nonlocal left, start, many, groups
        if groups == len(many):
            # Groups that are used up make room.
            alive = np.flatnonzero(many[:groups])
            size = max(16, 2 * len(alive))
            fresh = np.zeros((size, 3), np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for new, old in zip(fresh, (left, start, many)):
                new[: len(alive)] = old[alive]
            left, start, many = fresh
            groups = len(alive)
        left[groups], start[groups], many[groups] = residual, at, n
        groups += 1

    for length in sorted(counts, reverse=True):
        asked, done, todo = np.array([length, 1, length * length], dtype=np.int64), 0, counts[length]
        if (asked > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of a sequence")
        while todo:
            fits = np.flatnonzero((left[:groups] >= asked).all(axis=1) & (many[:groups] > 0))
            if len(fits):
                own = int(fits[np.argmin(scored(left[fits], asked, capacity))])
                residual, at, bins = left[own].copy(), int(start[own]), int(many[own])
            else:
                own, residual, at, bins = -1, limits, out.sequences, todo
            # The sequence that was filled fits best again while it has room.
            each = min(int((residual // asked).min()), todo)
            used = min(bins, todo // each)
            out.add(length, done, at, each, limits[0] - residual[0])
            if own < 0:
                out.sequences += used
            else:
                start[own], many[own] = at + used, bins - used
            group(residual - each * asked, at, used)
            done, todo = done + each * used, todo - each * used
    return out


class Places:
    """Sequence and offset by length and number."""

    def __init__(self, made: Plan, counts: dict[int, int]) -> None:
        order = np.lexsort((made.first, made.length))
        columns = [np.array(c, dtype=np.int64)[order] for c in (made.length, made.first, made.sequence, made.each, made.offset)]
        self.length, self.first, self.sequence, self.each, self.offset = columns
        self.lengths = np.array(sorted(counts), dtype=np.int64)
        sizes = np.array([counts[x] for x in self.lengths.tolist()], dtype=np.int64)
        self.before = np.cumsum(sizes) - sizes
        # One ascending key over lengths and numbers: the position of the first piece of a placement.
        self.key = self.before[np.searchsorted(self.lengths, self.length)] + self.first

    def of(self, length: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, position, side="right") - 1
        number = position - self.key[at]
        return self.sequence[at] + number // self.each[at], self.offset[at] + number % self.each[at] * length


def _placed(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, position = (np.array(batch.column(c)).astype(np.int64) for c in ("length", "_position"))
            sequence, offset = places().of(length, position - 1)
            kept = batch.drop_columns(["_position", "_at"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def packed(docs: DataFrame, encoder: Encoder, capacity: Capacity | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark: SparkSession = docs.sparkSession
    capacity = capacity or Capacity()
    rows = stage(pieces(docs, encoder, capacity.longest()).withColumn("_at", F.monotonically_increasing_id()), "pack_pieces")
    # At most one row for each length.
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows.drop("_at").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = arrays.shared(spark, Places(plan(counts, capacity), counts))
    ordered = with_position(rows, [F.col("length"), F.col("_at")], "_position", staged=True)
    return ordered.mapInArrow(_placed(places), f"{_PIECES}, sequence_id long, offset long")
