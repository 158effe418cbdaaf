"""Operator 8, language-model scoring with a weighted backoff automaton in distributed tables.

Training counts all words of the training documents, and the n-grams of each order that occur LEAST times or more, at any
corpus size. As both parts of such an n-gram occur as often, a filter of fixed size per order (a bit for each cell of the
hash space that LEAST occurrences fall into) keeps most of the others out of the shuffle; it only ever lets too many
through, and the exact counts decide.

A word or n-gram with arcs is a state; its arcs are the n-grams that continue it. An arc weighs its count less DISCOUNT
over that of the state, and the failure arc to the next shorter state weighs what the arcs leave over. The empty state
gives every word its add-half probability. A state's row therefore holds its own count and the sum and number of its arcs
(`values`), nothing of other states. Suffixes of states are states. Rows of a bucket of hashes are kept and shuffled as one
list of few bytes (`packed`), so Spark's own rows are as few as the lists.

Each document is traversed once from left to right (`traverse`). The state after a token is the longest of its suffixes
that is a state; from there the next token's arc, if there is one, and the failure arc are followed down to the empty
state, and the logarithm of what was gathered is added to the score.

Values of at least RATE of all tokens (at most 1 / RATE of each order) are sent to the tasks. All others lie in buckets of
hashes. A block of documents sends each bucket the list of its words and n-grams there, each once; the counts come back in
the order of that list, which the traversal makes again from the texts, so hashes travel one way only. In a large corpus
nearly all cells are taken: then one half of the hashes is asked for after the other, so that shuffles don't grow by what the
filter no longer spares.

Null text is the empty text: one end token. Documents without an id hash as the empty string does. Repeated rows are
counted and scored as often as they come, also those that share an id. Without training documents every token is
unknown, with probability one. Blocks are numbered by partition and place, so the input must give each partition the same rows
whenever it is read, as tables in files do; lists that differ are noticed and end the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.session import stage

ORDER = 3
# Occurrences of an n-gram that has an arc.
LEAST = 2
# Share of all tokens from which on a value is held by every task; rarer ones are joined.
RATE = 2e-6
DISCOUNT = 0.7
FOLDS, HELD_OUT = 5, 1
# Keys that a task sums up before it sends them on.
SUMMED = 1_500_000
# Bytes of training text whose n-grams of an order a bucket takes on average.
BUCKET_BYTES = 8 << 20
# The end token's hash; words never hash to it except by collision.
END = np.uint64(0xE11D)
# Context of words.
NOTHING = np.uint64(0)
# Bytes of text that are counted at once; arrays of this size stay in a processor's cache.
COUNTED_BYTES = 1 << 19
# Bytes of text, or one text, whose documents ask for values and are traversed together.
BLOCK_BYTES = 1 << 21
# Values that a bucket of lists holds on average.
BUCKET_ROWS = 400_000
# Cells of the filter of an order, as a power of two.
FILTER_BITS = 27
# Cells that one task counts together, likewise.
CHUNK_BITS = 16
# Share of a filter's cells from which on it spares too little, and blocks ask for one half of the hashes after the other.
CROWDED = 0.25
# Bytes of answers that a task sends on at once.
ANSWER_BYTES = 4 << 20


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo FOLDS."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT


def tokens(column: pa.Array, hasher: arrays.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each document's end token included, and where each document starts."""
    texts = arrays.texts_of(column).lower()
    spans = arrays.words(texts, arrays.NOT_SPACE)
    words = hasher.spans(texts.data, spans.starts, spans.ends)
    first = spans.first + np.arange(len(spans.first))
    out = np.empty(first[-1], dtype=np.uint64)
    ends = first[1:] - 1
    is_word = np.ones(len(out), dtype=bool)
    is_word[ends] = False
    out[is_word], out[ends] = words, END
    return out, first


def training(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out("doc_id")).select("text")


def gram_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of all but the last and all but the first of their words."""
    return arrays.mixed(context * np.uint64(arrays.BASE) + suffix)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the cells of these keys have their bit."""
    cells = keys >> np.uint64(64 - FILTER_BITS)
    return (bits[(cells >> np.uint64(3)).astype(np.int64)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1


def starts_of(values: np.ndarray) -> np.ndarray:
    """Which values of a sorted column differ from the one before."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def distinct(keys: np.ndarray) -> np.ndarray:
    """Each key once, in order. Sorting takes a fraction of the time of np.unique, which hashes when nothing but the keys is asked for."""
    keys = np.sort(keys)
    return keys[starts_of(keys)]


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and where each of the given ones is among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = starts_of(keys)
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    return keys[new], at


def insides(first: np.ndarray) -> np.ndarray:
    """How many tokens of its document stand before each token."""
    return np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))


def places(hashes: np.ndarray, first: np.ndarray, filters: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 2 on: ends of its n-grams in the documents, their keys, those of the contexts, and whether they pass.

    All pass an order without a filter. N-grams of which a part doesn't pass the filter of its order are left out.
    """
    inside = insides(first)
    keys, usable = hashes, np.ones(len(hashes), dtype=bool)
    for n in range(2, ORDER + 1):
        whole = inside >= n - 1
        whole &= usable
        whole[1:] &= usable[:-1]
        ends = np.flatnonzero(whole)
        context = keys[ends - 1]
        own = gram_keys(context, keys[ends])
        passing = passes(filters[n - 2], own) if n - 2 < len(filters) else np.ones(len(own), dtype=bool)
        yield ends, own, context, passing
        keys, usable = np.zeros(len(hashes), dtype=np.uint64), np.zeros(len(hashes), dtype=bool)
        keys[ends], usable[ends] = own, passing


def _at_order(hashes: np.ndarray, first: np.ndarray, filters: list[np.ndarray], n: int) -> tuple[np.ndarray, ...]:
    return next(x for k, x in enumerate(places(hashes, first, filters), start=2) if k == n)


def by_order(hashes: np.ndarray, first: np.ndarray, filters: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: ends and keys of the words and of the n-grams that pass."""
    yield np.arange(len(hashes)), hashes
    for ends, keys, _, passing in places(hashes, first, filters):
        yield ends[passing], keys[passing]


def chunk_size() -> int:
    return 1 << min(CHUNK_BITS, FILTER_BITS)


def _cells_by_chunk(keys: list[np.ndarray], once: bool) -> pa.RecordBatch:
    """Cells of these keys by chunk: the place in it, two bytes each, and how often, up to LEAST, or LEAST if `once` is enough."""
    cells, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]) >> np.uint64(64 - FILTER_BITS), return_counts=True)
    size = np.uint64(chunk_size())
    chunk, low = (cells // size).astype(np.int64), (cells % size).astype("<u2")
    times = np.full(len(n), LEAST, np.uint8) if once else np.minimum(n, LEAST).astype(np.uint8)
    lists = [(c, low[a:b].tobytes(), times[a:b].tobytes()) for c, a, b in _lists(chunk)]
    return pa.RecordBatch.from_pydict({name: [x[k] for x in lists] for k, name in enumerate(_CHUNKS.names)}, schema=_CHUNKS)


_CHUNKS = pa.schema([("chunk", pa.int64()), ("low", pa.binary()), ("times", pa.binary())])


def _gathered(parts: Iterator[np.ndarray], once: bool) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for keys in parts:
        held.append(keys)
        size += len(keys)
        if size >= SUMMED:
            yield _cells_by_chunk(held, once)
            held, size = [], 0
    yield _cells_by_chunk(held, once)
    arrays.release()


def _count_cells(held, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, hasher = [get() for get in held], arrays.Hasher()
        texts = arrays.slices(batches, "text", COUNTED_BYTES)
        return _gathered((_at_order(*tokens(batch.column("text"), hasher), filters, n)[1] for batch in texts), False)

    return run


def _key_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _gathered((keys[rows[1] == 0] for _, keys, rows in _value_lists(batches)), True)


def _full_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of each chunk of cells. All rows of a chunk are in one task, which counts each cell up to LEAST."""
    counted: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, low, times in zip(*(batch.column(c).to_pylist() for c in _CHUNKS.names)):
            own = counted.setdefault(chunk, np.zeros(chunk_size(), dtype=np.uint8))
            cells = np.frombuffer(low, "<u2")
            own[cells] = np.minimum(own[cells] + np.frombuffer(times, np.uint8), LEAST)
    bits = [np.packbits(x >= LEAST, bitorder="little").tobytes() for x in counted.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(counted), pa.int64()), pa.array(bits, pa.binary())], ["chunk", "bits"])


def full_cells(cells: DataFrame) -> np.ndarray:
    """Bits of the cells that are counted LEAST times or more: a table of fixed size."""
    out = np.zeros(((1 << FILTER_BITS) // chunk_size(), chunk_size() // 8), dtype=np.uint8)
    for row in stage(cells.repartition("chunk").mapInArrow(_full_cells, "chunk long, bits binary"), "lm_cells").collect():
        out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def cell_filter(docs: DataFrame, held: list, n: int) -> np.ndarray:
    """Bits of the cells that LEAST or more n-grams of the training documents fall into."""
    return full_cells(training(docs).mapInArrow(_count_cells(held, n), "chunk long, low binary, times binary"))


def value_filter(lists: DataFrame) -> np.ndarray:
    """Bits of the cells of all n-grams that have a value."""
    return full_cells(lists.select("bucket", "data").mapInArrow(_key_cells, "chunk long, low binary, times binary"))


def _count(held: list, n: int, buckets: int):
    """N-grams of one order of which all parts pass their filters, the n-gram before the last word, and counts, in lists by
    bucket. Words, whose context is NOTHING, come with the pairs."""

    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        every, contexts = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in (zip(*parts) if parts else ((), ())))
        parts.clear()
        order = np.argsort(every)
        every = every[order]
        at = np.flatnonzero(starts_of(every))
        keys, context, times = every[at], contexts[order[at]], np.diff(at, append=len(every))
        del every, contexts, order, at
        lists = list(_lists(buckets_of(keys, buckets)))
        data = [packed([steps(keys[a:b]), context[a:b], times[a:b]]) for _, a, b in lists]
        return pa.RecordBatch.from_pydict({"bucket": [x for x, _, _ in lists], "data": data}, schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, hasher, parts, size = [get() for get in held], arrays.Hasher(), [], 0
        for batch in arrays.slices(batches, "text", COUNTED_BYTES):
            hashes, first = tokens(batch.column("text"), hasher)
            if n == 2:
                parts.append((hashes, np.full(len(hashes), NOTHING)))
                size += len(hashes)
            _, keys, context, own = _at_order(hashes, first, filters, n)
            parts.append((keys[own], context[own]))
            size += len(parts[-1][0])
            if size >= SUMMED:
                yield flush(parts)
                size = 0
        yield flush(parts)
        arrays.release()

    return run


_COUNTS = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])


def summed(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Each key once, in order, the sums of its columns, and where it comes first among those given."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(starts_of(keys))
    return keys[at], [np.add.reduceat(x[order], at) if len(at) else x for x in columns], order[at]


def _by_bucket(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Keys and further columns of each bucket, whose lists come one after the other."""
    current, parts = None, []
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
            if bucket != current and parts:
                yield current, *_joined(parts)
                parts = []
            current = bucket
            parts.append(unpacked(data.as_buffer(), columns))
            parts[-1][0] = arrays.signed(unstepped(parts[-1][0]))
    if parts:
        yield current, *_joined(parts)


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.concatenate(parts, axis=1)
    return rows[0].view(np.uint64), rows[1:]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By bucket: keys, contexts and counts of the words, and of the n-grams that occur LEAST times or more."""
    for bucket, keys, (contexts, n) in _by_bucket(batches, 3):
        keys, (n,), at = summed(keys, [n])
        context = contexts[at]
        kept = (context == int(NOTHING)) | (n >= LEAST)
        yield bucket, keys[kept], context[kept], n[kept]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, keys, context, n in _kept(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (arrays.signed(keys), context, n)], ["token", "context", "n"])


def _weigh(buckets: int):
    """Values of the words and n-grams of one order, and what they add to those of their contexts, in lists by bucket."""

    def listed(keys: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        lists = list(_lists(buckets_of(keys, buckets)))
        data = [packed([steps(keys[a:b]), *(x[a:b] for x in columns)]) for _, a, b in lists]
        return pa.RecordBatch.from_pydict({"bucket": [x for x, _, _ in lists], "data": data}, schema=_COUNTS)

    def flush(arcs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        contexts, n = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*arcs) if arcs else ((), ())))
        keys, (out, times), _ = summed(contexts.view(np.uint64), [n, np.ones(len(n), np.int64)])
        zero = np.zeros(len(keys), np.int64)
        return listed(keys, [zero, zero, out, times])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arcs, size = [], 0
        for _, keys, context, n in _kept(batches):
            known, zero = context == int(NOTHING), np.zeros(len(keys), np.int64)
            yield listed(keys, [n, known.astype(np.int64), zero, zero])
            arcs.append((context[~known], n[~known]))
            size += len(arcs[-1][0])
            if size >= SUMMED:
                yield flush(arcs)
                arcs, size = [], 0
        yield flush(arcs)
        arrays.release()

    return run


def _sum_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of each bucket as one list, how many they are, how many of them are words, and how often those occur."""
    for bucket, keys, rows in _by_bucket(batches, 5):
        keys, rows, _ = summed(keys, list(rows))
        known = rows[1] > 0
        sizes = {"size": [len(keys)], "words": [int(known.sum())], "tokens": [int(rows[0][known].sum())]}
        yield pa.RecordBatch.from_pydict({"bucket": [bucket], **sizes, "data": [packed([steps(keys), *rows])]})
    arrays.release()


def _value_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By bucket: keys, and n, known, out and arcs."""
    return _by_bucket(batches, 5)


def _value_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, keys, rows in _value_lists(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (arrays.signed(keys), *rows)], ["token", "n", "known", "out", "arcs"])


def counted(docs: DataFrame, held: list, n: int, buckets: int) -> DataFrame:
    """Lists of `_count` by bucket."""
    found = training(docs).mapInArrow(_count(held, n, buckets), "bucket long, data binary")
    return found.repartition("bucket").sortWithinPartitions("bucket")


def counts(docs: DataFrame, held: list, n: int, buckets: int) -> DataFrame:
    """token, context and n of the n-grams of one order that occur LEAST times, with the pairs also of all words."""
    return counted(docs, held, n, buckets).mapInArrow(_count_rows, "token long, context long, n long")


def value_lists(docs: DataFrame) -> tuple[DataFrame, list]:
    """The rows of `values` in lists by bucket, one list each, and the filters of all orders.

    One order is counted after the other, so that only one is in a shuffle. Lists pass Spark's rows as a whole, so what it
    spends on a row isn't spent on every n-gram.
    """
    buckets = (training(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES + 1
    held, found = [], []
    for n in range(2, ORDER + 1):
        held.append(arrays.shared(docs.sparkSession, cell_filter(docs, held, n)))
        own = counted(docs, held, n, buckets).mapInArrow(_weigh(buckets), "bucket long, data binary")
        found.append(stage(own, "lm_counts") if n < ORDER else own)
    rows = reduce(DataFrame.union, found).repartition("bucket").sortWithinPartitions("bucket")
    lists = stage(rows.mapInArrow(_sum_values, "bucket long, size long, words long, tokens long, data binary"), "lm_values")
    return lists, [arrays.shared(docs.sparkSession, value_filter(lists))] * (ORDER - 1)


def values(docs: DataFrame) -> tuple[DataFrame, list]:
    """token, n, known, out and arcs of every word and every n-gram of LEAST occurrences, and the filters of all orders.

    `n` is its count in the training documents, `known` 1 for words; `out` and `arcs` are the sum of the counts of its arcs
    and how many there are, zero if it is no state.
    """
    lists, held = value_lists(docs)
    return lists.select("bucket", "data").mapInArrow(_value_rows, "token long, n long, known long, out long, arcs long"), held


@dataclass
class Table:
    """Rows of `values` by sorted key: n, out and arcs."""

    keys: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, token: np.ndarray, *columns: np.ndarray) -> Table:
        keys = token.astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        return cls(keys[order], np.array(columns, dtype=np.float64).reshape(3, -1)[:, order])

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and where."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


def looked_up(keys: np.ndarray, tables: list[Table]) -> np.ndarray:
    """n, out and arcs of each key; zero for those in no table."""
    out = np.zeros((3, len(keys)))
    for table in tables:
        found, at = table.at(keys)
        out[:, found] = table.rows[:, at[found]]
    return out


def frequent_values(lists: DataFrame, cutoff: float) -> Table:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _value_rows(batches):
            yield batch.filter(pc.greater_equal(batch.column("n"), cutoff)).drop_columns(["known"])

    rows = lists.select("bucket", "data").mapInArrow(run, "token long, n long, out long, arcs long").toPandas()
    return Table.of(*(rows[c].to_numpy(dtype=np.int64) for c in rows.columns))


def traverse(
    first: np.ndarray, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray]], tables: list[Table], size: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of documents: its count, its add-half log10 probability, and that which the automaton gives it.

    `orders` holds ends, keys and the number of the key at each end (`numbered`), so each key is looked up once. All documents
    are read together, each from its own empty state: entry k of `found` holds the suffixes of k + 1 tokens at every place, so
    the state before a token is the longest of those one place earlier that has arcs.
    """
    found = [(ends, at, looked_up(keys, tables)) for ends, keys, at in orders]
    _, words, (n, _, _) = found[0]
    count, alone = n[words], (n + 0.5) / size
    continues = np.append(insides(first)[1:] > 0, False)
    weight, gathered = np.ones(len(words)), np.zeros(len(words))
    for k in range(ORDER - 1, 0, -1):
        ends, at, (n, out, arcs) = found[k - 1]
        state = (arcs > 0)[at] & continues[ends]
        here, at = ends[state] + 1, at[state]
        arc = np.zeros(len(words))
        arc[found[k][0]] = found[k][2][0][found[k][1]]
        arc = arc[here]
        gathered[here] += weight[here] * np.where(arc > 0, arc - DISCOUNT, 0) / n[at]
        weight[here] *= (1 - (out - DISCOUNT * arcs) / np.maximum(n, 1))[at]
    return count, np.log10(alone)[words], np.log10(gathered + weight * alone[words])


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal parts of the hash space, in its order."""
    return (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes, of which the leading bytes are zeros."""
    return np.diff(keys, prepend=np.uint64(0))


def unstepped(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences.view(np.uint64), dtype=np.uint64)


def asked(sets: Iterator[np.ndarray], frequent: Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a block, each order's in order and once, that its task doesn't hold, by bucket, and the buckets."""
    keys = np.sort(np.concatenate([x[~frequent.at(x)[0]] for x in sets]))
    return keys, buckets_of(keys, buckets)


def packed(columns: list[np.ndarray]) -> bytes:
    """Integers byte by byte, all lowest bytes of a column first, up to the highest that any of them needs; each column's
    number of bytes stands ahead."""
    rows = [np.ascontiguousarray(x).view(np.uint64) for x in columns]
    wide = [max(1, (int(x.max(initial=0)).bit_length() + 7) // 8) for x in rows]
    return b"".join([bytes(wide), *(x.view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for x, w in zip(rows, wide))])


def unpacked(data: bytes, columns: int) -> np.ndarray:
    """The columns of `packed`."""
    every = np.frombuffer(data, np.uint8)
    wide, at = every[:columns].tolist(), columns
    size = (len(every) - columns) // sum(wide)
    out = np.zeros((columns, size, 8), np.uint8)
    for own, w in zip(out, wide):
        own[:, :w] = every[at : at + w * size].reshape(w, size).T
        at += w * size
    return out.view(np.int64)[:, :, 0]


def checksum(keys: np.ndarray) -> bytes:
    return int(np.bitwise_xor.reduce(arrays.mixed(keys))).to_bytes(8, "little")


def _lists(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each bucket of a sorted column and where it lies."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for low, high in zip([0, *cuts], [*cuts, len(bucket)]):
        if high > low:
            yield int(bucket[low]), low, high


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks of documents and their numbers; `part` is the number of the input's partition, also below a union."""
    for number, batch in enumerate(arrays.slices(batches, "text", BLOCK_BYTES)):
        yield (batch.column("part")[0].as_py() << 32) + number, batch


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, batch in _numbered(batches):
        columns = [pa.array(np.full(batch.num_rows, block)), batch.column("doc_id"), batch.column("text")]
        yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "text"])


def _ask(model, held, buckets: int, rounds: int, turn: int):
    """The lists of every block in the buckets of this turn: bucket, block and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, filters, hasher = model(), [get() for get in held], arrays.Hasher()
        for block, batch in _numbered(batches):
            every = (keys for _, keys in by_order(*tokens(batch.column("text"), hasher), filters))
            sets = (distinct(keys if rounds == 1 else keys[buckets_of(keys, rounds) == turn]) for keys in every)
            keys, bucket = asked(sets, frequent, buckets)
            lists = [(b, packed([steps(keys[low:high])])) for b, low, high in _lists(bucket)]
            yield pa.RecordBatch.from_pydict({"bucket": [b for b, _ in lists], "block": [block] * len(lists), "data": [x for _, x in lists]}, schema=_LISTS)

    return run


_LISTS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])


def _fill(cutoff: float, buckets: int, rounds: int, turn: int):
    """Rare values in lists of the buckets of this turn, ahead of all lists of blocks (block -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, (n, _, out, arcs) in _value_lists(batches):
            rare = (n < cutoff) & (buckets_of(keys, rounds) == turn)
            keys, columns = keys[rare], [x[rare] for x in (n, out, arcs)]
            lists = list(_lists(buckets_of(keys, buckets)))
            data = [packed([steps(keys[low:high]), *(x[low:high] for x in columns)]) for _, low, high in lists]
            yield pa.RecordBatch.from_pydict({"bucket": [b for b, _, _ in lists], "block": [-1] * len(lists), "data": data}, schema=_LISTS)
        arrays.release()

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, bucket and the values of each list in its order, behind a checksum. A bucket's values come before its lists."""
    current, parts, table, out, size = None, [], None, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({name: [x[k] for x in out] for k, name in enumerate(_LISTS.names)}, schema=_LISTS)

    for batch in batches:
        for bucket, block, data in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), batch.column("data")):
            if bucket != current:
                current, parts, table = bucket, [], None
            if block < 0:
                rows = unpacked(data.as_buffer(), 4)
                rows[0] = arrays.signed(unstepped(rows[0]))
                parts.append(rows)
                continue
            if table is None:
                table = Table.of(*np.concatenate([np.zeros((4, 0), np.int64), *parts], axis=1))
                parts = []
            keys = unstepped(unpacked(data.as_buffer(), 1)[0])
            out.append((bucket, block, checksum(keys) + packed(list(looked_up(keys, [table]).astype(np.int64)))))
            size += len(out[-1][2])
            if size >= ANSWER_BYTES:
                yield flush()
                out, size = [], 0
    yield flush()
    arrays.release()


def _score(model, held, buckets: int, size: float):
    """Traverses the documents of each block, whose rows come one after the other, answers by bucket first."""

    def scored(doc_id: list[pa.Array], text: list[pa.Array], answers: list[bytes], hasher: arrays.Hasher) -> pa.RecordBatch:
        frequent, filters = model(), [get() for get in held]
        hashes, first = tokens(pa.concat_arrays(text), hasher)
        orders = [(ends, *numbered(keys)) for ends, keys in by_order(hashes, first, filters)]
        keys, bucket = asked((x for _, x, _ in orders), frequent, buckets)
        lists = [(low, high) for _, low, high in _lists(bucket)]
        if len(lists) != len(answers) or any(x[:8] != checksum(keys[low:high]) for (low, high), x in zip(lists, answers)):
            raise RuntimeError("the documents changed between two reads: write them to a table first")
        rows = np.concatenate([np.zeros((3, 0), np.int64), *(unpacked(memoryview(x)[8:], 3) for x in answers)], axis=1)
        rare = Table.of(arrays.signed(keys), *rows)
        del keys, bucket, hashes, rows
        count, base, own = traverse(first, orders, [frequent, rare], size)
        document = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total = lambda x: np.bincount(document, weights=x, minlength=len(first) - 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(doc_id),
                pa.array(np.diff(first), pa.int64()),
                pa.array(total(count > 0).astype(np.int64)),
                pa.array(total(base)),
                pa.array(total(own)),
            ],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, current, doc_id, text, answers = arrays.Hasher(), None, [], [], []
        for batch in batches:
            block, is_text = np.array(batch.column("block")), np.array(batch.column("bucket")) == buckets
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (is_text[1:] != is_text[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(block)]):
                if high == low:
                    continue
                if block[low] != current:
                    if text:
                        yield scored(doc_id, text, answers, hasher)
                    current, doc_id, text, answers = block[low], [], [], []
                if is_text[low]:
                    doc_id.append(batch.column("doc_id").slice(low, high - low))
                    text.append(batch.column("text").slice(low, high - low))
                else:
                    answers += batch.column("data").slice(low, high - low).to_pylist()
        if text:
            yield scored(doc_id, text, answers, hasher)
        arrays.release()

    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`."""
    found, held = value_lists(docs)
    total, distinct_words, rows = found.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words", "size")]).first()
    size, cutoff = float(total + 0.5 * (distinct_words + 1)), max(RATE * total, LEAST)
    model = arrays.shared(docs.sparkSession, frequent_values(found, cutoff))
    rounds = 2 if np.unpackbits(held[0]()).mean() > CROWDED else 1
    buckets = rounds * (rows // (rounds * BUCKET_ROWS) + 1)
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    schema = "bucket long, block long, data binary"
    answers = []
    for turn in range(rounds):
        lists = typed.mapInArrow(_ask(model, held, buckets, rounds, turn), schema)
        filled = found.select("bucket", "data").mapInArrow(_fill(cutoff, buckets, rounds, turn), schema)
        met = filled.union(lists).repartition("bucket").sortWithinPartitions("bucket", "block")
        answers.append(stage(met.mapInArrow(_answer, schema), "lm_answers"))
    answers = reduce(DataFrame.union, answers)
    texts = typed.mapInArrow(_texts, "block long, doc_id long, text string").withColumn("bucket", F.lit(buckets).cast("long"))
    met = texts.unionByName(answers, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "bucket")
    return met.mapInArrow(_score(model, held, buckets, size), "doc_id long, n_tokens long, n_known long, base_score double, score double").select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
