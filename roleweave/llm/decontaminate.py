"""Operator 5, benchmark decontamination by winnowing.

Both sides hash every k-gram of words and keep the least hash of each sliding window, wide enough that a shared span of
WINDOW words always holds a kept hash. Fingerprints of documents are looked up among those of the benchmark; a hit is
extended to all windows around it, and each is compared word by word, so hash collisions change nothing. Items shorter
than a window are whole windows of their own length, found by their first word.

The benchmark is a stated query set. It is indexed in blocks of bounded bytes, one broadcast each, and the documents
pass every block in turn without a shuffle; one block is one pass. Nothing of the documents reaches the driver.

Null or empty texts have no words and no hits. Items without words are ignored, null item ids are left out of the item
list, repeated item ids count once. Every row of `docs` gives one row. Empty tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.session import fits_broadcast, stage

WINDOW = 13
GRAM = 5
# Least share of hit words of a contaminated document, as its inverse.
INVERSE_SHARE = 20
# Benchmark text in one index.
BLOCK_BYTES = 2 << 20


@dataclass
class Index:
    """Windows of benchmark words, sorted by hash; window i stands at words[at[i]:at[i] + length[i]]."""

    texts: arrays.Texts
    spans: arrays.Spans
    fingerprints: np.ndarray
    firsts: np.ndarray
    hashes: np.ndarray
    at: np.ndarray
    length: np.ndarray
    items: list[list[str]]


def build_index(rows: list[tuple[object, str | None]]) -> Index:
    """Index of (item_id, text) rows."""
    texts = arrays.texts_of(pa.array([text for _, text in rows], pa.large_string())).lower()
    spans = arrays.words(texts, arrays.ALPHANUMERIC)
    hashes = arrays.Hasher().spans(texts.data, spans.starts, spans.ends)
    found: dict[tuple[bytes, ...], tuple[int, set[str]]] = {}
    fingerprints = []
    for row, (item, _) in enumerate(rows):
        first, last = int(spans.first[row]), int(spans.first[row + 1])
        length = min(WINDOW, last - first)
        own = [texts.data[a:b].tobytes() for a, b in zip(spans.starts[first:last], spans.ends[first:last])]
        for i in range(len(own) - length + 1 if length else 0):
            items = found.setdefault(tuple(own[i : i + length]), (first + i, set()))[1]
            if item is not None:
                items.add(str(item))
        if length == WINDOW:
            kept = arrays.grams(hashes[first:last], GRAM)
            fingerprints.append(kept[arrays.winnow(kept, np.ones(len(kept), dtype=bool), WINDOW - GRAM + 1)])
    at = np.array([x[0] for x in found.values()], dtype=np.int64)
    length = np.array([len(x) for x in found], dtype=np.int64)
    keys = window_hashes(hashes, at, length)
    order = np.argsort(keys, kind="stable")
    lists = [sorted(x[1]) for x in found.values()]
    return Index(
        texts,
        spans,
        np.unique(np.concatenate(fingerprints)) if fingerprints else np.zeros(0, dtype=np.uint64),
        np.unique(hashes[at[length < WINDOW]]),
        keys[order],
        at[order],
        length[order],
        [lists[i] for i in order],
    )


def window_hashes(hashes: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the words [start, start + length) for each start."""
    out = length.astype(np.uint64)
    for i in range(WINDOW):
        rest = i < length
        out[rest] = out[rest] * np.uint64(arrays.BASE) + hashes[starts[rest] + i]
    return arrays.mixed(out)


def among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def candidates(hashes: np.ndarray, spans: arrays.Spans, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the document windows worth comparing: around fingerprint hits, and of short items."""
    document_end = np.repeat(spans.first[1:], spans.counts())
    grams = arrays.grams(hashes, GRAM)
    kept = arrays.winnow(grams, arrays.whole_grams(spans, GRAM), WINDOW - GRAM + 1)
    hits = kept[among(grams[kept], index.fingerprints)]
    starts = np.unique((hits[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
    starts = starts[starts >= 0]
    parts = [(starts, np.full(len(starts), WINDOW))]
    begin = np.flatnonzero(among(hashes, index.firsts))
    parts += [(begin, np.full(len(begin), n)) for n in np.unique(index.length[index.length < WINDOW])]
    starts, length = (np.concatenate(x) for x in zip(*parts))
    inside = starts + length <= document_end[starts] if len(starts) else np.zeros(0, dtype=bool)
    return starts[inside], length[inside]


def verified(texts: arrays.Texts, spans: arrays.Spans, hashes: np.ndarray, index: Index) -> list[tuple[int, int, int]]:
    """(start, length, window of the index) of every occurrence of a window, compared word by word."""
    starts, length = candidates(hashes, spans, index)
    keys = window_hashes(hashes, starts, length)
    low, high = np.searchsorted(index.hashes, keys, "left"), np.searchsorted(index.hashes, keys, "right")
    out = []
    for i in np.flatnonzero(high > low):
        start, n = int(starts[i]), int(length[i])
        for window in range(low[i], high[i]):
            at = int(index.at[window])
            if n == index.length[window] and all(
                np.array_equal(
                    texts.data[spans.starts[start + j] : spans.ends[start + j]],
                    index.texts.data[index.spans.starts[at + j] : index.spans.ends[at + j]],
                )
                for j in range(n)
            ):
                out.append((start, n, window))
    return out


def _pass(block, last: bool):
    """One pass of documents over one block: adds hit word ranges and items, and at last turns them into digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hasher = block(), arrays.Hasher()
        for batch in arrays.slices(batches, "text"):
            texts = arrays.texts_of(batch.column("text")).lower()
            spans = arrays.words(texts, arrays.ALPHANUMERIC)
            hashes = hasher.spans(texts.data, spans.starts, spans.ends)
            occurrences = verified(texts, spans, hashes, index)
            starts = np.array([x[0] for x in occurrences], dtype=np.int64)
            hit = arrays.covered(len(spans), starts, np.array([x[1] for x in occurrences], dtype=np.int64))
            items: list[set[str]] = [set(x or ()) for x in batch.column("items").to_pylist()]
            for (_, _, window), document in zip(occurrences, spans.document()[starts]):
                items[document].update(index.items[window])
            for row, before in enumerate(batch.column("hits").to_pylist()):
                if before:
                    hit[spans.first[row] : spans.first[row + 1]] |= np.unpackbits(
                        np.frombuffer(before, np.uint8), count=int(spans.first[row + 1] - spans.first[row])
                    ).view(bool)
            if last:
                n_hit = np.bincount(spans.document()[hit], minlength=len(texts))
                n_words = spans.counts()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
                        pa.array((n_hit > 0) & (INVERSE_SHARE * n_hit >= n_words)),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
                )
            else:
                packed = [
                    np.packbits(hit[a:b]).tobytes() if hit[a:b].any() else None
                    for a, b in zip(spans.first[:-1], spans.first[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        pa.array(packed, pa.binary()),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["doc_id", "text", "hits", "items"],
                )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of `docs` doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the item list."""
    spark = docs.sparkSession
    test = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = test.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
        F.lit(None).cast("binary").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for i in range(blocks):
        part = test.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i) if blocks > 1 else test
        index = arrays.shared(spark, build_index([tuple(r) for r in part.collect()]))
        if i < blocks - 1:
            rows = stage(rows.mapInArrow(_pass(index, False), rows.schema), "decontaminate")
    return rows.mapInArrow(
        _pass(index, True),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text isn't contaminated, with their own columns.

    Rows go by a hash of id and text, so those that share an id, or have none, are judged each by its own text.
    """
    row = arrays.unused(docs.columns, "_row")
    key = F.xxhash64("doc_id", "text")
    found = contamination(docs.select(key.alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias(row)).distinct()
    found = stage(found, "contaminated")
    side = F.broadcast(found) if fits_broadcast(8 * found.count()) else found
    return docs.join(side, key == F.col(row), "left_anti")
