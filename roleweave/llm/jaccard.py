"""Operator 6, n-gram Jaccard join by rare-first prefix filtering, and the groups that its links form.

1. One pass counts all shingles in a sketch of fixed size; its counts, then the hash, order the shingles of every
   document alike, rare ones first. The order decides the cost only, never the result.
2. One pass keeps of each document its set size, a fingerprint of the set, and the prefix in that order that any
   document similar enough has to meet. Documents with the same set become one class.
3. All prefix shingles are shuffled as rows of three numbers; those that one class holds go, exactly and at any corpus size.
   Only the others take the counts of parts of their class along. Posting lists are cut into bands of set size and come to a
   task in the order of size. Short ones are paired under the length, positional and suffix filters; in a long one each member is linked to the first one of
   its sizes, which needs no more memory than these. Both only say who may be linked.
4. Connected candidates are verified together: their sets are fetched once and cut into blocks of bounded size, each pair
   of blocks is one task group, and each pair of documents meets in exactly one. Pairs that the length and suffix
   filters leave, and that aren't connected yet, are compared exactly. A block returns a spanning forest of its links,
   so large groups of near copies never become all their pairs.
5. The verified links give the components.

Null text and texts without words have an empty set and link with nothing. Repeated rows fall into one class and are
returned as often as they come; rows that share an id but not the text count as one document. A null id has no
component. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.llm.components import components
from roleweave.session import fits_broadcast, stage

# Words of a shingle, and links (100 * intersection >= percent * union), of the query. Others are arguments.
WORDS = 3
PERCENT = 90
SKETCH_BITS = 18
# Parts of the hash space whose counts bound the difference of two sets.
PARTS_BITS = 6
# Posting lists up to this length are joined with themselves, longer ones by a star.
SHORT_LIST = 200
# Parts of the hash space in the suffix filter of posting lists: 16 bits of count each, four to a long.
PACKED_PARTS = 16
# Shingles in each part of a signature, on average; the suffix filter of pairs compares signatures.
SIGNATURE_MEAN = 16
# Cells of the filter of prefix shingles, cells of a chunk of it, as powers of two, and shingles a task counts at once.
FILTER_BITS, CHUNK_BITS, CELLS_HELD = 27, 16, 2_000_000
# Steps of size whose postings of a shingle are one list.
BAND = 8
# Shingles in a block of documents that are verified together.
BLOCK_SHINGLES = 200_000


def shingle_hashes(texts: arrays.Texts, hasher: arrays.Hasher, length: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles, document by document, and where each document starts.

    A document of fewer than `length` words has its whole sequence as one shingle.
    """
    spans = arrays.words(texts.lower(), arrays.NOT_SPACE)
    words = hasher.spans(texts.lower().data, spans.starts, spans.ends)
    counts = spans.counts()
    grams = arrays.grams(words, length)[arrays.whole_grams(spans, length)]
    sizes = np.maximum(counts - length + 1, 0)
    for n in range(1, length):
        short = np.flatnonzero(counts == n)
        if len(short):
            own = arrays.mixed(arrays.grams(words, n)[spans.first[short]] + np.uint64(n))
            at = np.concatenate(([0], np.cumsum(sizes)))[short]
            grams = np.insert(grams, at, own)
            sizes[short] = 1
    return grams, np.concatenate(([0], np.cumsum(sizes)))


def sketch_cells(shingles: np.ndarray) -> np.ndarray:
    """The last bits of the hash: prefixes crowd where the counts are low, and the first bits deal out and filter shingles."""
    return (shingles & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = arrays.Hasher(), np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in arrays.slices(batches, "text"):
            grams, _ = shingle_hashes(arrays.texts_of(batch.column("text")), hasher, words)
            counts += np.bincount(sketch_cells(grams), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["cell", "n"])

    return run


def frequency_sketch(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Counts of all shingles by the last bits of their hash: a table of fixed size, merged by adding."""
    rows = docs.select("text").mapInArrow(_sketch(words), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    out[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def _profiles(sketch, words: int, percent: int):
    """Per document: set size, two order-free sums as fingerprint, and the prefix in rare-first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hasher = sketch(), arrays.Hasher()
        for batch in arrays.slices(batches, "text"):
            grams, first = shingle_hashes(arrays.texts_of(batch.column("text")), hasher, words)
            sizes, sums, others, prefixes, parts, signatures = [], [], [], [], [], []
            for a, b in zip(first[:-1], first[1:]):
                own = np.unique(grams[a:b])
                size = len(own)
                length = size - -(-percent * size // 100) + 1 if size else 0
                order = np.lexsort((own, counts[sketch_cells(own)]))[:length]
                sizes.append(size)
                sums.append(int(own.sum(dtype=np.uint64)))
                others.append(int(arrays.mixed(own).sum(dtype=np.uint64)))
                prefixes.append(arrays.signed(own[order]))
                counted = np.bincount((own >> np.uint64(60)).astype(np.int64), minlength=PACKED_PARTS)
                signatures.append(signature(own).tobytes())
                parts.append(np.minimum(counted, 0xFFFF).astype("<u2").view("<i8"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(arrays.signed(np.array(sums, dtype=np.uint64))),
                    pa.array(arrays.signed(np.array(others, dtype=np.uint64))),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    *(pa.array([x[k] for x in parts], pa.int64()) for k in range(PACKED_PARTS // 4)),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "n_shingles", "sum_a", "sum_b", "prefix", *_PARTS, "signature"],
            )

    return run


_PARTS = [f"parts_{k}" for k in range(PACKED_PARTS // 4)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Counts of as many parts of the hash space, a power of two, that about SIGNATURE_MEAN shingles fall into each."""
    bits = max(0, (len(shingles) // SIGNATURE_MEAN).bit_length())
    parts = (shingles >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(shingles), dtype=np.int64)
    return np.bincount(parts, minlength=1 << bits).astype("<u4")


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Lower bound of the difference of two sets from their signatures; the longer one is summed up to the shorter."""
    size = min(len(a), len(b))
    a, b = (x.reshape(size, -1).sum(axis=1, dtype=np.int64) for x in (a, b))
    return int(np.abs(a - b).sum())


def _near(percent: int):
    """Pairs whose signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y, n in zip(*(batch.column(c).to_pylist() for c in ("signature_a", "signature_b", "n"))):
                difference = apart(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"))
                kept.append((100 + percent) * difference <= (100 - percent) * n)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def part_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each part of the hash space."""
    return np.bincount((shingles >> np.uint64(64 - PARTS_BITS)).astype(np.int64), minlength=1 << PARTS_BITS)


def profiles(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, fingerprint (sum_a, sum_b) and prefix of every row."""
    sketch = arrays.shared(docs.sparkSession, frequency_sketch(docs, words))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_profiles(sketch, words, percent), f"doc_id long, n_shingles long, sum_a long, sum_b long, prefix array<long>, {', '.join(f'{p} long' for p in _PARTS)}, signature binary")


def classes(rows: DataFrame) -> DataFrame:
    """n_shingles, sum_a, sum_b and the least doc_id (as `class`) of each distinct set that isn't empty."""
    held = rows.where("n_shingles > 0 and doc_id is not null")
    return held.groupBy("n_shingles", "sum_a", "sum_b").agg(F.min("doc_id").alias("class"))


def _representatives(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One profile of each class, without moving the profiles of rows that are no copies of others."""
    keys = ["doc_id", "sum_a", "sum_b"]
    held = rows.where("n_shingles > 0 and doc_id is not null")
    times = held.groupBy("n_shingles", *keys).agg(F.count("*").alias("_times")).join(found, ["n_shingles", "sum_a", "sum_b"])
    copies = stage(times.where("doc_id <> class or _times > 1").select(*keys, (F.col("doc_id") == F.col("class")).alias("_stays")), "jaccard_copies")
    side = F.broadcast(copies) if fits_broadcast(32 * copies.count()) else copies
    marked = held.join(side, keys, "left")
    repeated = marked.where("_stays").dropDuplicates(keys)
    return marked.where("_stays is null").union(repeated).drop("_stays").withColumnRenamed("doc_id", "class")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the hash space that prefix shingles fall into, once or more often in this task, by chunk of cells."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        held.clear()
        chunks, low = (cells >> np.uint64(CHUNK_BITS)).astype(np.int64), (cells & np.uint64((1 << CHUNK_BITS) - 1)).astype("<u2")
        starts = np.flatnonzero(np.diff(chunks, prepend=-1))
        once, more = [], []
        for a, b in zip(starts, [*starts[1:], len(cells)]):
            once.append(low[a:b][n[a:b] == 1].tobytes())
            more.append(low[a:b][n[a:b] > 1].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(chunks[starts]), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["chunk", "once", "more"])

    size = 0
    for batch in batches:
        tokens = np.array(batch.column("prefix").flatten()).astype(np.int64).view(np.uint64)
        held.append(tokens >> np.uint64(64 - FILTER_BITS))
        size += len(tokens)
        if size >= CELLS_HELD:
            yield flush()
            size = 0
    yield flush()


def _met_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the cells of each chunk that two shingles or more fell into; all rows of a chunk are in one task."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, once, more in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "more"))):
            own = counts.setdefault(chunk, np.zeros(1 << CHUNK_BITS, dtype=np.uint8))
            for cells, n in ((np.frombuffer(once, "<u2"), 1), (np.frombuffer(more, "<u2"), 2)):
                own[cells] = np.minimum(own[cells] + n, 2)
    bits = [np.packbits(c >= 2, bitorder="little").tobytes() for c in counts.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(bits, pa.binary())], ["chunk", "bits"])


def met_filter(one: DataFrame) -> np.ndarray:
    """A bit for each cell that two prefix shingles or more fall into: a table of fixed size that lets none of these out."""
    cells = one.select("prefix").mapInArrow(_cells, "chunk long, once binary, more binary").repartition("chunk")
    out = np.zeros((1 << (FILTER_BITS - CHUNK_BITS), (1 << CHUNK_BITS) // 8), dtype=np.uint8)
    for row in cells.mapInArrow(_met_cells, "chunk long, bits binary").collect():
        out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _width(percent: int) -> float:
    """Linked sizes differ by less than one step of this logarithm, so they meet in a step or at its border."""
    return float(-np.log(percent / 100 - 0.01))


def _posted(percent: int):
    """Postings of all prefix shingles. A list is a shingle and a band of BAND steps of size; at a border a posting is in both.

    `place` is the set size and, in the last 32 bits, the position in the prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                lengths = np.array(pc.list_value_length(rows.column("prefix"))).astype(np.int64)
                tokens = np.array(rows.column("prefix").flatten()).astype(np.int64).view(np.uint64)
                n, own = (np.array(rows.column(c)).astype(np.int64) for c in ("n_shingles", "class"))
                owner = np.repeat(np.arange(rows.num_rows), lengths)
                pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                step = np.floor(np.log(np.maximum(n, 1)) / _width(percent)).astype(np.int64)[owner]
                border = np.flatnonzero((step + 1) // BAND != step // BAND)
                every = np.concatenate((np.arange(len(owner)), border))
                band = np.concatenate((step // BAND, step[border] // BAND + 1))
                lists = arrays.signed(arrays.mixed(tokens[every] + band.astype(np.uint64) * np.uint64(arrays.BASE)))
                columns = (lists, own[owner[every]], n[owner[every]] << 32 | pos[every])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["list", "class", "place"])
        arrays.release()

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of lists of two or more, which come in the order of lists."""
    last, met = None, False
    for batch in batches:
        if last is not None:
            batch = pa.concat_batches([last, batch])
        size = batch.num_rows
        if not size:
            continue
        lists = np.array(batch.column("list"))
        same = lists[1:] == lists[:-1]
        # Only the first row comes from the batch before, and may have met others there.
        kept = np.append(same, False) | np.concatenate(([met], same))
        # The last row waits for the next batch.
        last, met = batch.slice(size - 1), bool(kept[-1])
        yield batch.slice(0, size - 1).filter(pa.array(kept[:-1]))
    if met:
        yield last


def _between(i: np.ndarray, j: np.ndarray, rows: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of postings of one list pass the positional filter and, by the counts of parts, the suffix filter."""
    n, pos = rows["n"], rows["pos"]
    both = n[i] + n[j]
    needed = -(-percent * both // (100 + percent))
    good = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= needed
    at = np.flatnonzero(good)
    difference = np.abs(rows["parts"][i[at]].astype(np.int64) - rows["parts"][j[at]]).sum(axis=1)
    good[at] = (100 + percent) * difference <= (100 - percent) * both[at]
    return good


def _paired(percent: int):
    """Candidate pairs of lists that come in the order of list and size."""

    def short(rows: dict[str, np.ndarray], groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, d = np.arange(len(groups)), 1
        while len(i):
            i = i[i + d < len(groups)]
            i = i[groups[i] == groups[i + d]]
            # Sizes ascend, so what is too long for a posting now stays so.
            i = i[100 * rows["n"][i] >= percent * rows["n"][i + d]]
            good = _between(i, i + d, rows, percent)
            yield rows["class"][i[good]], rows["class"][i[good] + d]
            d += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        # The list that is too long to pair up, and the first posting of each of its steps.
        long, anchors = None, {}

        def stars(rows: dict[str, np.ndarray], a: int, b: int) -> tuple[list[int], list[int]]:
            nonlocal long, anchors
            key = int(rows["list"][a])
            if key != long:
                long, anchors = key, {}
            left, right = [], []
            steps = np.floor(np.log(np.maximum(rows["n"][a:b], 1)) / _width(percent)).astype(np.int64).tolist()
            for own, step in zip(rows["class"][a:b].tolist(), steps):
                for s in (step, step + 1):
                    anchor = anchors.setdefault(s, own)
                    if anchor != own:
                        left.append(anchor)
                        right.append(own)
            return left, right

        def paired(rows: dict[str, np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            size = len(rows["list"])
            change = np.flatnonzero(rows["list"][1:] != rows["list"][:-1]) + 1
            starts = np.concatenate(([0], change)) if size else np.zeros(0, np.int64)
            ends = np.append(starts[1:], size)
            lengths = ends - starts
            # A list goes on from one batch to the next; what is long is a star at once.
            begun = np.array([k for k in range(len(starts)) if int(rows["list"][starts[k]]) == long][:1], dtype=np.int64)
            is_long = lengths > SHORT_LIST
            is_long[begun] = True
            open_last = not last and size > 0 and not is_long[-1]
            held = {c: v[starts[-1] :] for c, v in rows.items()} if open_last else None
            stop = starts[-1] if open_last else size
            is_pair = ~is_long & (lengths > 1)
            if open_last:
                is_pair[-1] = False
            which = np.repeat(np.where(is_pair, np.arange(len(starts)), -1), lengths)
            at = np.flatnonzero(which >= 0)
            pairs = list(short({c: v[at] for c, v in rows.items()}, which[at])) if len(at) else []
            a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in pairs)])
            b = np.concatenate([np.zeros(0, np.int64), *(x for _, x in pairs)])
            n_pairs = len(a)
            linked = [stars(rows, starts[k], ends[k]) for k in np.flatnonzero(is_long) if starts[k] < stop]
            a = np.concatenate([a, *(np.array(x, dtype=np.int64) for x, _ in linked)])
            b = np.concatenate([b, *(np.array(x, dtype=np.int64) for _, x in linked)])
            low, high, star = np.minimum(a, b), np.maximum(a, b), np.arange(len(a)) >= n_pairs
            order = np.lexsort((star, high, low))
            low, high, star = low[order], high[order], star[order]
            new = (np.diff(low, prepend=low[:1] - 1) != 0) | (np.diff(high, prepend=high[:1] - 1) != 0) | (np.diff(star.astype(np.int8), prepend=2) != 0)
            yield pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (low, high, star)], ["a", "b", "star"])

        for batch in batches:
            rows = {c: np.array(batch.column(c)).astype(np.int64) for c in ("list", "class", "place")}
            place = rows.pop("place")
            rows["n"], rows["pos"] = place >> 32, place & 0xFFFFFFFF
            packed = np.stack([np.array(batch.column(p)).astype("<i8") for p in _PARTS], axis=1) if batch.num_rows else np.zeros((0, len(_PARTS)), "<i8")
            rows["parts"] = packed.view("<u2").reshape(batch.num_rows, PACKED_PARTS)
            if held is not None:
                rows = {c: np.concatenate((held[c], v)) for c, v in rows.items()}
            yield from paired(rows, False)
        if held is not None:
            yield from paired(held, True)

    return run


def candidates(rows: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of classes that may be linked, connected as in the module's description."""
    one = _representatives(rows, found)
    schema = "list long, class long, place long"
    postings = one.select("class", "n_shingles", "prefix").mapInArrow(_posted(percent), schema)
    # Lists of one posting, which are most, go before the others take the counts of parts along.
    met = stage(postings.repartition("list").sortWithinPartitions("list").mapInArrow(_met, schema), "jaccard_postings")
    lists = met.join(one.select("class", *_PARTS), "class").repartition("list").sortWithinPartitions("list", "place", "class")
    pairs = stage(lists.mapInArrow(_paired(percent), "a long, b long, star boolean"), "jaccard_pairs")
    star = pairs.where("star").select("a", "b")
    signed = one.select("class", F.col("n_shingles").alias("n"), "signature")
    left = signed.select(F.col("class").alias("a"), F.col("n").alias("_n"), F.col("signature").alias("signature_a"))
    right = signed.select(F.col("class").alias("b"), F.col("n").alias("_m"), F.col("signature").alias("signature_b"))
    asked = pairs.where("not star").select("a", "b").distinct().join(left, "a").join(right, "b")
    near = asked.select("a", "b", "signature_a", "signature_b", (F.col("_n") + F.col("_m")).alias("n")).mapInArrow(_near(percent), "a long, b long")
    return star.union(near).distinct()


def _sets(words: int):
    """Each document's sorted set, once for every pair of blocks that its own block takes part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrays.Hasher()
        for batch in arrays.slices(batches, "text", 1 << 18):
            grams, first = shingle_hashes(arrays.texts_of(batch.column("text")), hasher, words)
            out: dict[str, list] = {name: [] for name in ("root", "low", "high", "class", "block", "shingles")}
            for row, (root, own, block, blocks) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "class", "block", "blocks")))):
                packed = np.unique(grams[first[row] : first[row + 1]]).tobytes()
                for other in range(blocks):
                    for name, value in zip(out, (root, min(block, other), max(block, other), own, block, packed)):
                        out[name].append(value)
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return run


def forest(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect all linked documents of two blocks (or of one, if all are of the same block)."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.lexsort((ids, size))
    ids, blocks, size, sets = ids[order], blocks[order], size[order], [sets[i] for i in order]
    parts = np.array([part_counts(s) for s in sets], dtype=np.int32)
    apart = len(np.unique(blocks)) > 1
    root = np.arange(len(ids))
    links = []
    for i in range(len(ids)):
        # Larger documents within the length bound follow in the order.
        stop = int(np.searchsorted(size, 100 * size[i] // percent, side="right"))
        later = np.arange(i + 1, stop)
        later = later[(root[later] != root[i]) & ((blocks[later] != blocks[i]) if apart else True)]
        # The intersection needed leaves this much for the difference of the two sets.
        most = (size[later] + size[i]) * (100 - percent)
        difference = np.abs(parts[later] - parts[i]).sum(axis=1)
        near = difference * (100 + percent) <= most
        later = later[near][np.argsort(difference[near], kind="stable")]
        for j in later:
            if root[j] == root[i]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (size[i] + size[j] - common):
                links.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
    return links


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        links = forest(table.column("class").to_numpy(), table.column("block").to_numpy(), sets, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def links(docs: DataFrame, may_link: DataFrame, sizes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Verified links (a, b) that span the components, from candidate pairs and the set size of each class."""
    members = components(may_link, "jaccard_candidates").join(sizes.groupBy("class").agg(F.max("n_shingles").alias("n")), F.col("node") == F.col("class"))
    members = stage(members.select("class", "root", "n"), "jaccard_members")
    blocks = members.groupBy("root").agg(F.expr(f"cast(sum(n) div {BLOCK_SHINGLES} + 1 as int)").alias("blocks"))
    placed = members.join(blocks, "root").select("class", "root", "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"))
    # Texts stay where they are while their candidates are few.
    placed = stage(placed, "jaccard_placed")
    side = F.broadcast(placed) if fits_broadcast(32 * placed.count()) else placed
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc_id"), "text").join(side, F.col("_doc_id") == F.col("class")).select("root", "class", "block", "blocks", "text")
    sets = texts.mapInArrow(_sets(words), "root long, low int, high int, class long, block int, shingles binary")
    return sets.groupBy("root", "low", "high").applyInArrow(_verify(percent), "a long, b long")


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every row of `docs`."""
    rows = stage(profiles(docs, words, percent), "jaccard_profiles")
    found = stage(classes(rows), "jaccard_classes")
    verified = stage(links(docs, candidates(rows, found, percent), found, words, percent), "jaccard_links")
    roots = components(verified, "jaccard_components")
    labels = found.join(roots, F.col("class") == F.col("node"), "left").select("n_shingles", "sum_a", "sum_b", F.coalesce("root", "class").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "sum_a", "sum_b").join(labels, ["n_shingles", "sum_a", "sum_b"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each_text(docs: DataFrame, own: str, key: str) -> DataFrame:
    """One row of each text that has words, that with the least `own` (nulls last), and all rows without words.

    `key` is a hash of the text. Of rows that agree in both stays the one whose other columns have the least hash; only these are
    shuffled with their text.
    """
    copies, first, mine, hashed, number = (arrays.unused(docs.columns, c) for c in ("_copies", "_first", "_own", "_key", "_number"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = stage(docs.where(worded).groupBy(F.col(own).alias(mine), F.col(key).alias(hashed)).agg(F.count("*").alias(copies)), "jaccard_rows")
    least = F.min(F.struct(F.col(mine).isNull().alias("missing"), F.col(mine).alias("own"))).alias(first)
    firsts = rows.groupBy(F.col(hashed).alias("_of")).agg(least)
    marked = rows.join(firsts, F.col(hashed) == F.col("_of")).select(mine, hashed, copies, F.col(mine).eqNullSafe(F.col(f"{first}.own")).alias(first))
    others = stage(marked.where(f"not {first} or {copies} > 1").select(mine, hashed, first), "jaccard_copies")
    others = F.broadcast(others) if fits_broadcast(24 * others.count()) else others
    same = F.col(own).eqNullSafe(F.col(mine)) & (F.col(key) == F.col(hashed))
    repeated = docs.join(others.where(first), same, "left_semi")
    order = Window.partitionBy(own, key).orderBy(F.xxhash64(*docs.columns), *docs.columns)
    kept = repeated.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(number)
    return docs.join(others, same, "left_anti").union(kept)


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked texts, that with the least doc_id (nulls last), with the columns of `docs`.

    Texts are told apart by a hash and not by doc_id, so rows without an id, or with a repeated one, are treated alike.
    Rows without words link with nothing and all stay.
    """
    own, key = arrays.unused(docs.columns, "_own_id"), arrays.unused(docs.columns, "_text_key")
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), key: F.xxhash64("text")})
    single = one_of_each_text(keyed, own, key)
    found = groups(single.select(F.col(key).alias("doc_id"), "text"), words, percent).where("n_shingles > 0")
    ids = single.select(F.col(key).alias("_k"), F.col(own).alias("_own"))
    order = F.struct(F.col("_own").isNull().alias("missing"), "_own", "_k")
    named = stage(found.join(ids, F.col("doc_id") == F.col("_k")).select("component_id", order.alias("_order")), "jaccard_named")
    first = named.groupBy("component_id").agg(F.min("_order").alias("_first"))
    gone = arrays.unused(keyed.columns, "_gone")
    dropped = named.join(first, "component_id").where("_order._k <> _first._k").select(F.col("_order._k").alias(gone))
    dropped = stage(dropped, "jaccard_dropped")
    side = F.broadcast(dropped) if fits_broadcast(8 * dropped.count()) else dropped
    return single.join(side, F.col(key) == F.col(gone), "left_anti").drop(own, key)
