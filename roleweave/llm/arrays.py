"""Words, lines and hashes of whole Arrow text columns as numpy arrays.

Every function works on the UTF-8 bytes of a slice of documents at once. Memory follows SLICE_BYTES, or the longest
single text where that is longer, never the partition.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Bytes of text that are worked on at once.
SLICE_BYTES = 2 << 20
# Bytes whose prefix hashes are held at once.
HASH_BYTES = 1 << 20
# An odd multiplier, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def byte_class(text: str) -> np.ndarray:
    """Lookup table over byte values: True for the given ASCII characters."""
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(text.encode("ascii"), dtype=np.uint8)] = True
    return table


# Words between white space: [^\x20\x09-\x0D]+
NOT_SPACE = ~byte_class(" \t\n\v\f\r")
# Words of lower-cased letters, digits and all non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


@dataclass
class Texts:
    """Bytes of some documents, one after the other; document i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Texts:
        """A-Z lower-cased; the length in bytes stays."""
        return Texts(np.frombuffer(self.data.tobytes().translate(ASCII_LOWER), dtype=np.uint8), self.offsets)

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        """How many of the bytes flagged fall into each document."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


@dataclass
class Spans:
    """Spans of bytes in document order; those of document i are starts[first[i]:first[i + 1]]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """Index of the document of each span."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def texts_of(column: pa.Array) -> Texts:
    """A string column without copying its bytes; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64))
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    return Texts(np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with at most `limit` bytes of text, or one row."""
    for batch in batches:
        ends = texts_of(batch.column(column)).offsets[1:]
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(row, stop - row)
            row = stop
    release()


def release() -> None:
    """Give unused memory back. A Python worker serves one task after the other and would keep what the largest needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def runs(texts: Texts, inside: np.ndarray) -> Spans:
    """Maximal runs of bytes flagged in `inside`, cut at the ends of documents."""
    n = len(texts.data)
    if not n:
        return Spans(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(texts.offsets))
    heads, tails = texts.offsets[full], texts.offsets[full + 1] - 1
    begin[heads] = inside[heads]
    end[tails] = inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Spans(starts, ends, np.searchsorted(starts, texts.offsets))


def words(texts: Texts, word_bytes: np.ndarray) -> Spans:
    """Maximal runs of the bytes that `word_bytes` (a table of 256) admits."""
    return runs(texts, word_bytes[texts.data])


def lines(texts: Texts) -> Spans:
    """What stands between line feeds, empty lines included; an empty text has one empty line."""
    feeds = np.flatnonzero(texts.data == 10)
    starts = np.sort(np.concatenate((texts.offsets[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((feeds, texts.offsets[1:])), kind="stable")
    per = np.searchsorted(feeds, texts.offsets)
    return Spans(starts, ends, per + np.arange(len(per)))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finalizer: spreads every input bit over the result."""
    values = values.astype(np.uint64)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64."""
    out = np.full(n, base & ((1 << 64) - 1), dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Polynomial hashes of spans from prefix sums, modulo 2**64, then mixed with the length."""

    def __init__(self) -> None:
        self.up, self.down = powers(BASE, HASH_BYTES + 1), powers(INVERSE, HASH_BYTES + 1)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        row = 0
        while row < len(starts):
            at = starts[row]
            stop = max(row + 1, int(np.searchsorted(ends, at + HASH_BYTES, side="right")))
            size = int(ends[stop - 1] - at)
            if size > len(self.up) - 1:
                self.up, self.down = powers(BASE, size + 1), powers(INVERSE, size + 1)
            prefix = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum((data[at : at + size].astype(np.uint64) + np.uint64(1)) * self.up[:size], out=prefix[1:])
            left, right = starts[row:stop] - at, ends[row:stop] - at
            out[row:stop] = (prefix[right] - prefix[left]) * self.down[left]
            row = stop
        return mixed(out + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each place on; len(hashes) - n + 1 values."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + hashes[i : i + size]
    return mixed(out)


def whole_grams(spans: Spans, n: int) -> np.ndarray:
    """For each gram of n spans whether it lies inside one document."""
    document = spans.document()
    size = max(0, len(document) - n + 1)
    return document[:size] == document[n - 1 :] if size else np.zeros(0, dtype=bool)


def covered(size: int, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Flags of the places in [start, start + width) of any start."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.astype(np.uint64, copy=False).view(np.int64)


def unused(columns: list[str], name: str) -> str:
    """`name`, lengthened until no column is called so."""
    while name in columns:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")



def sliding(reduce: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of each window of `width` values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = reduce(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return reduce(values[:-rest], values[rest:]) if rest else values


def winnow(hashes: np.ndarray, usable: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window of `width` hashes (all of them where it is tied).

    Hashes that aren't usable lose against all others, so a window of usable ones always keeps a place.
    """
    if len(hashes) <= width:
        return np.flatnonzero(usable)
    values = np.where(usable, hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
    least = sliding(np.minimum, values, width)
    padding = np.zeros(width - 1, dtype=np.uint64)
    most = sliding(np.maximum, np.concatenate((padding, least, padding)), width)
    return np.flatnonzero((most == values) & usable)


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """Send an object of proven bounded size to the executors; tasks call the result to get it.

    It travels with the code of its class, which executors needn't have installed. Tasks that run one after the other in
    one Python worker get the same object, so what it remembers serves them all.
    """
    sent = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    def get() -> object:
        held = sent.value
        if "object" not in held:
            held["object"] = pickle.loads(held.pop("packed"))
        return held["object"]

    return get
