"""Operator 10, suffix-array dedup: bytes covered by a string of LENGTH bytes that also starts earlier are removed.

1. One pass keeps of each window of LENGTH bytes the place of its least GRAM-byte hash, its anchor. Equal windows have
   equal anchors, so repeats meet there. Consecutive windows with the same anchor are one segment; a segment travels as
   (anchor hash, segment hash, place), about one for 35 bytes. Segments that repeat within a slice are settled there.
2. Among equal segments all but the earliest are removed whole. Segments that share the anchor only (where a repeat begins,
   ends or was edited) are compared by their bytes.
3. Those bytes are fetched for the earliest of each segment and sorted as suffixes, to the right of the anchor and to the
   left of it: mergesort whose comparisons find common extensions by binary search on prefix polynomial hashes. The
   adjacent extensions are verified byte by byte. Windows whose both sides agree with an earlier segment are removed.
   Anchors of very many different segments are spread window by window instead.
4. The removed ranges of each document are joined with its text. A filter of fixed size over the ids concerned lets only
   their texts travel.

Null text is empty. A null id counts as after all others. Rows that share an id (or have none) count as the same document:
equal places don't remove each other. Each row loses what its own text repeats and nothing else: ranges and texts meet by id and
text hash (`own`). Equal rows lose the same. Texts shorter than LENGTH keep everything. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.session import stage

LENGTH = 100
GRAM = 32
# Bytes of text whose windows are looked at together; each byte takes some sixty bytes of arrays.
PART_BYTES = 1 << 18
# Segments sorted together.
BLOCK = 8_000
# Different segments of one anchor up to which they are sorted in one block.
MOST_OF_ANCHOR = 2_000
# Cells of 64 bits in the id filter.
FILTER_CELLS = 1 << 18
LAST_ID = (1 << 63) - 1


def windows(texts: arrays.Texts, hasher: arrays.Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of LENGTH bytes inside documents, their anchors, and the hash of each anchor's gram."""
    size = len(texts.data)
    if size < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    starts = np.arange(size - GRAM + 1)
    grams = hasher.spans(texts.data, starts, starts + GRAM)
    value, place, span, width = grams, starts, 1, LENGTH - GRAM + 1
    while span < width:
        move = min(span, width - span)
        smaller = value[move:] < value[:-move]
        value, place = np.where(smaller, value[move:], value[:-move]), np.where(smaller, place[move:], place[:-move])
        span += move
    sizes = np.maximum(np.diff(texts.offsets) - LENGTH + 1, 0)
    inside = np.repeat(texts.offsets[:-1] - np.concatenate(([0], np.cumsum(sizes)))[:-1], sizes) + np.arange(sizes.sum())
    return inside, place[inside], value[inside]


def segments(texts: arrays.Texts, hasher: arrays.Hasher) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: document, first and last start, anchor (all within the document), two hashes."""
    start, anchor, gram = windows(texts, hasher)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start))[: len(head)] - 1
    low, high = start[head], start[tail]
    document = np.searchsorted(texts.offsets, low, side="right") - 1
    base = texts.offsets[document]
    # The segment hash tells where in the segment the anchor lies.
    whole = hasher.spans(texts.data, low, high + LENGTH) + (anchor[head] - low).astype(np.uint64)
    return {"document": document, "low": low - base, "high": high - base, "anchor": anchor[head] - base, "gram": gram[head], "whole": arrays.mixed(whole)}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = arrays.Hasher()
    for batch in arrays.slices(batches, "text", PART_BYTES):
        found = segments(arrays.texts_of(batch.column("text")), hasher)
        doc = np.array(batch.column("doc"), dtype=np.int64)[found["document"]]
        own = np.array(batch.column("own"), dtype=np.int64)[found["document"]]
        low = found["low"]
        # Of equal segments in the slice only the earliest (and its equals) need to look further; the others are spread.
        order = np.lexsort((low, doc, found["whole"], found["gram"]))
        same = np.zeros(len(order), dtype=bool)
        same[1:] = (found["whole"][order][1:] == found["whole"][order][:-1]) & (found["gram"][order][1:] == found["gram"][order][:-1])
        group = np.flatnonzero(~same)
        first = order[group[np.cumsum(~same) - 1]] if len(order) else order
        settled = np.zeros(len(order), dtype=bool)
        settled[order] = (doc[order] != doc[first]) | (low[order] != low[first])
        gram = np.where(settled, arrays.mixed(found["gram"] + doc.astype(np.uint64) + low.astype(np.uint64)), found["gram"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(arrays.signed(gram)),
                pa.array(arrays.signed(found["whole"])),
                pa.array(doc),
                pa.array(own),
                pa.array(low, pa.int32()),
                pa.array(found["high"] - low, pa.int32()),
                pa.array(found["anchor"] - low, pa.int32()),
                pa.array(settled),
            ],
            ["gram", "whole", "doc", "own", "low", "more", "at", "settled"],
        )


def judged_segments(docs: DataFrame) -> DataFrame:
    """Staged segments that matter: `repeated` ones, and the earliest ones whose anchor other segments share (`open`).

    One shuffle by the anchor hash serves all windows.
    """
    rows = docs.mapInArrow(_segments, "gram long, whole long, doc long, own long, low int, more int, at int, settled boolean").repartition("gram")
    same, anchor = Window.partitionBy("gram", "whole"), Window.partitionBy("gram")
    place = F.struct("doc", "low")
    judged = rows.withColumn("first", F.min(place).over(same)).withColumns(
        {"open": (F.min("whole").over(anchor) != F.max("whole").over(anchor)) & ~F.col("settled")}
    )
    repeated = F.col("settled") | (place != F.col("first"))
    judged = judged.select("gram", "whole", "doc", "own", "low", "more", "at", repeated.alias("repeated"), "open")
    return stage(judged.where("repeated or open"), "suffix_segments")


def id_filter(ids: DataFrame):
    """A fixed-size filter over a column `doc`: lets every id of it pass, and few others while it isn't full."""
    cell, bit = _filter_place()
    rows = ids.select(cell.alias("cell"), F.expr("shiftleft(1L, cast(pmod(xxhash64(doc, 1), 64) as int))").alias("bits")).groupBy("cell").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(FILTER_CELLS, dtype=np.uint64)
    table[rows["cell"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return arrays.shared(ids.sparkSession, table)


def _filter_place():
    return F.pmod(F.xxhash64("doc"), F.lit(FILTER_CELLS)).cast("int"), F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(64)).cast("int")


def _passes(table: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    cell, bit = np.array(batch.column("cell"), dtype=np.int64), np.array(batch.column("bit"), dtype=np.uint64)
    return (table[cell] >> bit) & np.uint64(1) > 0


def _concerned(passes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = passes()
        for batch in batches:
            yield batch.filter(pa.array(_passes(table, batch))).select(["doc", "own", "text"])

    return run


def _bytes_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open segment of a document."""
    for batch in arrays.slices(batches, "text", PART_BYTES):
        texts = arrays.texts_of(batch.column("text"))
        out: dict[str, list] = {name: [] for name in ("gram", "doc", "own", "low", "at", "piece")}
        for row, (doc, own, places) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "own", "places")))):
            text = texts.data[texts.offsets[row] : texts.offsets[row + 1]].tobytes()
            for x in places:
                piece = text[x["low"] : x["low"] + x["more"] + LENGTH]
                if len(piece) >= LENGTH:
                    for name, value in zip(out, (x["gram"], doc, own, x["low"], x["at"], piece)):
                        out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], list(out))


class Suffixes:
    """Suffixes of a buffer, each with a length, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.data, self.starts, self.lengths = data, starts, lengths
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * arrays.powers(arrays.BASE, len(data)), out=self.prefix[1:])
        self.down = arrays.powers(arrays.INVERSE, len(data) + 1)

    def hashes(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, by binary search."""
        low, high = np.zeros(len(a), dtype=np.int64), np.minimum(self.lengths[a], self.lengths[b])
        x, y = self.starts[a], self.starts[b]
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            equal = self.hashes(x, middle) == self.hashes(y, middle)
            low, high = np.where(open_ & equal, middle, low), np.where(open_ & ~equal, middle - 1, high)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = self.common(a, b)
        ended = common == np.minimum(self.lengths[a], self.lengths[b])
        last = len(self.data) - 1
        by_byte = self.data[np.minimum(self.starts[a] + common, last)] < self.data[np.minimum(self.starts[b] + common, last)]
        return np.where(ended, self.lengths[a] < self.lengths[b], by_byte)

    def order(self) -> np.ndarray:
        """Stable bottom-up mergesort; each element finds its place in the neighbouring run by binary search."""
        n = len(self.starts)
        order, width = np.arange(n), 1
        place = np.arange(n)
        while width < n:
            run = place // width
            left = run % 2 == 0
            begin = np.minimum(np.where(left, (run + 1) * width, (run - 1) * width), n)
            end = np.minimum(begin + width, n)
            low, high = begin.copy(), end.copy()
            while (open_ := low < high).any():
                middle = (low + high) // 2
                own, other = order[open_], order[middle[open_]]
                # Equal suffixes of the left run stand first.
                before = np.where(left[open_], self.less(other, own), ~self.less(own, other))
                low[open_] = np.where(before, middle[open_] + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle[open_])
            target = np.where(left, place, place - width) + (low - begin)
            merged = np.empty(n, dtype=np.int64)
            merged[target] = order
            order, width = merged, width * 2
        return order

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """The order, and the common extension of each suffix with the one before it, verified byte by byte.

        Should a hash have collided, the suffixes are compared as bytes instead.
        """
        order = self.order()
        common = np.zeros(len(order), dtype=np.int64)
        if len(order) > 1:
            common[1:] = self.common(order[:-1], order[1:])
            steps = np.arange(common.sum()) - np.repeat(np.cumsum(common) - common, common)
            a, b = np.repeat(self.starts[order[:-1]], common[1:]) + steps, np.repeat(self.starts[order[1:]], common[1:]) + steps
            if not np.array_equal(self.data[a], self.data[b]):
                pieces = [self.data[s : s + n].tobytes() for s, n in zip(self.starts, self.lengths)]
                order = np.array(sorted(range(len(pieces)), key=pieces.__getitem__))
                for i in range(1, len(order)):
                    x, y = pieces[order[i - 1]], pieces[order[i]]
                    common[i] = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return order, common

    def classes(self, order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
        """For each suffix a number that equals another's if their first `depth` bytes are equal."""
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.cumsum(common < depth)
        return out


def repeated_windows(pieces: list[bytes], at: np.ndarray, doc: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the piece, start in its document) of every window that an earlier piece has too."""
    order = np.lexsort((low + at, doc))
    pieces, at, doc, low = [pieces[i] for i in order], at[order], doc[order], low[order]
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    base = np.cumsum(size) - size
    right = Suffixes(data, base + at, size - at)
    left = Suffixes(data[::-1], len(data) - (base + at), at)
    sorted_right, sorted_left = right.sorted(), left.sorted()
    found = []
    for before in range(LENGTH - GRAM + 1):
        fits = np.flatnonzero((at >= before) & (size - at >= LENGTH - before))
        if not len(fits):
            continue
        key = right.classes(*sorted_right, LENGTH - before)[fits] * (len(pieces) + 1) + left.classes(*sorted_left, before)[fits]
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        earliest, own = fits[first][back], low[fits] + at[fits] - before
        later = (doc[fits] != doc[earliest]) | (own != low[earliest] + at[earliest] - before)
        found.append((order[fits[later]], own[later]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def _sorted_block(table: pa.Table) -> pa.Table:
    doc, own = table.column("doc").to_numpy(), table.column("own").to_numpy()
    low = table.column("low").to_numpy().astype(np.int64)
    at = table.column("at").to_numpy().astype(np.int64)
    index, start = repeated_windows(table.column("piece").to_pylist(), at, doc, low)
    order = np.lexsort((start, own[index], doc[index]))
    doc, own, start = doc[index][order], own[index][order], start[order]
    # Neighbouring windows become one range.
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (own[1:] != own[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc))[: len(head)] - 1
    return pa.table({"doc": doc[head], "own": own[head], "low": pa.array(start[head], pa.int32()), "high": pa.array(start[tail] + LENGTH, pa.int32())})


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every piece by two hashes."""
    hasher = arrays.Hasher()
    for batch in batches:
        for row in range(batch.num_rows):
            piece = np.frombuffer(batch.column("piece")[row].as_py(), dtype=np.uint8)
            start = np.arange(len(piece) - LENGTH + 1)
            middle = start + LENGTH // 2
            halves = [hasher.spans(piece, start, middle), hasher.spans(piece, middle, start + LENGTH)]
            doc, own = (np.full(len(start), batch.column(c)[row].as_py()) for c in ("doc", "own"))
            yield pa.RecordBatch.from_arrays([*(pa.array(arrays.signed(h)) for h in halves), pa.array(doc, pa.int64()), pa.array(own, pa.int64()), pa.array(start + batch.column("low")[row].as_py(), pa.int32())], ["a", "b", "doc", "own", "low"])


def partial_repeats(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """Ranges (doc, own, low, high) of the windows that segments share without being equal."""
    open_ = judged.where("open and not repeated").dropDuplicates(["gram", "whole", "doc", "own", "low"])
    places = open_.groupBy("doc", "own").agg(F.collect_list(F.struct("gram", "low", "more", "at")).alias("places"))
    cell, bit = _filter_place()
    texts = docs.withColumns({"cell": cell, "bit": bit}).mapInArrow(_concerned(id_filter(open_)), "doc long, own long, text string")
    pieces = stage(texts.join(places, ["doc", "own"]).mapInArrow(_bytes_of_segments, "gram long, doc long, own long, low int, at int, piece binary"), "suffix_pieces")
    sizes = pieces.groupBy("gram").agg(F.count("*").alias("n"))
    wide = sizes.where(F.col("n") > MOST_OF_ANCHOR).select("gram")
    blocks = pieces.count() // BLOCK + 1
    block = F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block")
    narrow = pieces.join(wide, "gram", "left_anti").withColumn("block", block)
    ranges = narrow.groupBy("block").applyInArrow(_sorted_block, "doc long, own long, low int, high int")
    single = pieces.join(wide, "gram", "left_semi").mapInArrow(_single_windows, "a long, b long, doc long, own long, low int")
    first = single.groupBy("a", "b").agg(F.min(F.struct("doc", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    spread = single.join(first, ["a", "b"]).where(F.struct("doc", "low") != F.col("first"))
    return ranges.union(spread.select("doc", "own", "low", (F.col("low") + LENGTH).alias("high")))


def _split(passes):
    """Texts of documents that may lose something; of the others what is needed of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = passes()
        for batch in batches:
            may = _passes(table, batch)
            texts = batch.column("text").to_pylist()
            whole = [None if m else (t or "").encode() for m, t in zip(may, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("own"),
                    pa.array([t if m else None for m, t in zip(may, texts)], pa.string()),
                    pa.array([None if w is None else len(w) for w in whole], pa.int64()),
                    pa.array([None if w is None else hashlib.sha256(w).hexdigest() for w in whole], pa.string()),
                ],
                ["doc", "own", "text", "n_bytes", "sha256"],
            )

    return run


def merged(ranges: list[dict], size: int) -> list[list[int]]:
    """Maximal ranges of the union, cut at `size`."""
    out: list[list[int]] = []
    for low, high in sorted((r["low"], min(r["high"], size)) for r in ranges):
        if low >= high:
            continue
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            out = []
            columns = ("doc", "text", "n_bytes", "sha256", "ranges")
            for doc, text, n_bytes, digest, ranges in zip(*(part.column(c).to_pylist() for c in columns)):
                if digest is None:
                    data = (text or "").encode()
                    gone = merged(ranges or [], len(data))
                    edges = [0, *(x for r in gone for x in r), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((doc, len(data), sum(b - a for a, b in gone), [x for r in gone for x in r], hashlib.sha256(kept).hexdigest()))
                else:
                    out.append((doc, n_bytes, 0, [], digest))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["doc", "n_bytes", "n_removed", "removed", "kept_sha256"])


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed ranges (flat pairs of byte offsets) of every row."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), "text")
    rows = rows.withColumn("own", F.xxhash64("text"))
    judged = judged_segments(rows)
    whole = judged.where("repeated").select("doc", "own", "low", (F.col("low") + F.col("more") + LENGTH).alias("high"))
    ranges = stage(whole.union(partial_repeats(rows, judged)), "suffix_ranges")
    lists = ranges.groupBy("doc", "own").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    cell, bit = _filter_place()
    texts = rows.withColumns({"cell": cell, "bit": bit}).mapInArrow(_split(id_filter(ranges)), "doc long, own long, text string, n_bytes long, sha256 string")
    cut = texts.join(lists, ["doc", "own"], "left").mapInArrow(_cut, "doc long, n_bytes long, n_removed long, removed array<int>, kept_sha256 string")
    return cut.select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"),
        "n_bytes",
        "n_removed",
        (F.size("removed") / 2).cast("long").alias("n_spans"),
        "kept_sha256",
        "removed",
    )
