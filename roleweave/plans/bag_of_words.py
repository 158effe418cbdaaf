"""Cross-validated ridge on bags of words: all trials and folds are fitted together, one pass over the rows a step.

1. One aggregate counts, for each term, the documents of every fold that hold it. The vocabulary of a trial in a fold follows
   from it: the counts of all folds less those of the fold held out.
2. Rows become lists of term numbers once (`term_index`), whatever the number of trials.
3. Conjugate gradients minimize |y - b - Xw|^2 + alpha |w|^2 for all trials and folds in step. A pass adds up X'Xp for every
   unfinished model; a task holds one vector per model and never a matrix, so neither does the driver: a vector has at most
   `max_features` numbers.

Weights, idf and row norms are worked out from the term numbers in each pass, as they differ by trial and fold. What a row
holds doesn't, so all models go through a block of rows together, as columns of one matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roleweave.operators.tokens import ngrams
from roleweave.session import stage

# Residual, relative to the right-hand side, at which a model is done, and the most passes there are.
TOLERANCE = 1e-4
MOST_PASSES = 50
# Rows of a partition of the index; each pass sends one vector per model and partition.
ROWS = 250
# Most frequent terms, which a block of rows holds as a dense matrix; rows of a block; cells of a matrix of terms and models.
DENSE, BLOCK, CELLS = 800, 256, 1 << 21


@dataclass
class Model:
    """One trial without one fold: its terms, their weights, and the state of its descent."""

    trial: int
    fold: int
    alpha: float
    terms: np.ndarray
    weights: np.ndarray


def counts_by_fold(data: DataFrame, folds: Sequence[int]) -> DataFrame:
    """Staged (term, pair, f0, f1, ...): documents of each fold with the term; pairs of words are marked."""
    # Outer, because the optimizer would test a plain explode for emptiness first and make the pairs twice.
    one = data.select("fold", F.explode_outer(F.array_distinct(ngrams(F.col("tokens"), 2))).alias("term")).where("term is not null")
    counted = one.groupBy("term").agg(*[F.count_if(F.col("fold") == f).alias(f"f{i}") for i, f in enumerate(folds)])
    return stage(counted.withColumn("pair", F.contains("term", F.lit(" "))), "bow_counts")


def vocabularies(
    counts: DataFrame, sizes: dict[int, int], candidates: Sequence[dict]
) -> list[tuple[int, int, list[tuple[str, int]]]]:
    """(trial, fold held out, terms with their document frequency), the most frequent first, ties by term.

    What reaches the driver is bounded: for each fold and n-gram size the largest `max_features`, and the terms that more than
    the least `max_df` of all rows hold, of which there are no more than a mean document has terms, over that share.
    """
    folds, most = list(sizes), max(int(c["max_features"]) for c in candidates)
    share, least = min(float(c["max_df"]) for c in candidates), min(int(c["min_df"]) for c in candidates)
    total = sum(F.col(f"f{i}") for i in range(len(folds)))
    n = sum(sizes.values())
    # One row for each term and fold left out.
    left = F.explode(F.array(*[
        F.struct(F.lit(f).alias("fold"), (total - F.col(f"f{i}")).alias("df"), F.lit(float(n - sizes[f])).alias("rows"))
        for i, f in enumerate(folds)
    ]))
    rows = counts.select("term", "pair", left.alias("x")).select("term", "pair", "x.*").where(F.col("df") >= least)
    frequent = F.col("df") > share * F.col("rows")
    # Only terms as frequent as the last one needed are ranked; a table of how many terms have each frequency says which.
    low = _last_needed(rows.where(~frequent).groupBy("fold", "pair", "df").agg(F.count(F.lit(1)).alias("n")), most)
    ranked = rows.where(~frequent).join(F.broadcast(low), ["fold", "pair"]).where(F.col("df") >= F.col("_low")).drop("_low")
    place = F.row_number().over(Window.partitionBy("fold", "pair").orderBy(F.desc("df"), "term"))
    rest = ranked.withColumn("place", place).where(F.col("place") <= most).drop("place")
    found = rows.where(frequent).select("fold", "pair", "term", "df").unionByName(rest.select("fold", "pair", "term", "df")).collect()
    by_fold: dict[int, list[tuple[str, int, bool]]] = {f: [] for f in folds}
    for fold, pair, term, df in sorted(map(tuple, found), key=lambda r: (-r[3], r[2])):
        by_fold[fold].append((term, df, pair))
    out = []
    for trial, own in enumerate(candidates):
        for fold in folds:
            low, high = int(own["min_df"]), float(own["max_df"]) * (n - sizes[fold])
            fits = ((term, df) for term, df, pair in by_fold[fold] if low <= df <= high and (own["max_ngram"] == 2 or not pair))
            out.append((trial, fold, list(islice(fits, int(own["max_features"])))))
    return out


def _last_needed(counted: DataFrame, most: int) -> DataFrame:
    """(fold, pair, _low): the frequency of the term in place `most`, from how many terms (n) have each frequency (df)."""
    above = F.sum("n").over(Window.partitionBy("fold", "pair").orderBy(F.desc("df"))) - F.col("n")
    return counted.withColumn("_above", above).where(F.col("_above") < most).groupBy("fold", "pair").agg(F.min("df").alias("_low"))


def term_index(data: DataFrame, key: str, numbers: dict[str, int], rows_in_all: int) -> DataFrame:
    """Staged (fold, _key, score, terms): the numbers of each row's terms that some vocabulary holds, once each."""

    known = pa.array(list(numbers), pa.string())
    place = np.fromiter(numbers.values(), np.int32, len(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, row = batch.column("tokens").flatten(), np.array(pc.list_parent_indices(batch.column("tokens")))
            pairs = pc.binary_join_element_wise(words[:-1], words[1:], " ")
            at = [pc.fill_null(pc.index_in(x, known), -1).to_numpy(zero_copy_only=False) for x in (words, pairs)]
            # Two words of different rows are no pair.
            held = [at[0] >= 0, (at[1] >= 0) & (row[1:] == row[:-1])]
            rows = np.concatenate([row[held[0]], row[:-1][held[1]]]).astype(np.int64)
            both = np.unique(rows << 32 | np.concatenate([place[x[h]] for x, h in zip(at, held)]))
            ends = np.searchsorted(both >> 32, np.arange(batch.num_rows + 1))
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((both & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("_key"), batch.column("score"), found], ["fold", "_key", "score", "terms"])

    rows = data.select("fold", F.col(key).alias("_key"), F.col("score").cast("double").alias("score"), "tokens")
    kind = rows.schema["_key"].dataType.simpleString()
    indexed = rows.mapInArrow(run, f"fold int, _key {kind}, score double, terms array<int>")
    # Passes are many: a small index is spread over the cores, and a large one keeps the partitions it has.
    cores = data.sparkSession.sparkContext.defaultParallelism
    if rows_in_all < cores * ROWS * 20:
        indexed = indexed.repartition(max(1, min(cores, rows_in_all // ROWS)))
    return stage(indexed, "bow_index")


class Block:
    """Some rows: a dense matrix says which of the most frequent terms each holds, a list which of the others.

    Terms are numbered by frequency, so the first `dense` are the most frequent. With none of them, sums are taken term by term,
    so rows that hold the same terms of a model get the same value to the last bit.
    """

    def __init__(self, flat: np.ndarray, row: np.ndarray, rows: int, dense: int) -> None:
        common = flat < dense
        self.dense = np.zeros((rows, dense))
        self.dense[row[common], flat[common]] = 1.0
        self.rest = np.split(flat[~common], np.searchsorted(row[~common], np.arange(1, rows)))

    def dot(self, table: np.ndarray) -> np.ndarray:
        """Sum of the rows of `table` (terms by models) of the terms that each row holds."""
        out = self.dense @ table[: self.dense.shape[1]]
        for r, own in enumerate(self.rest):
            if len(own):
                out[r] += table[own].sum(axis=0)
        return out

    def add(self, values: np.ndarray, total: np.ndarray) -> None:
        """Adds each row's values to the rows of `total` of the terms it holds."""
        total[: self.dense.shape[1]] += self.dense.T @ values
        for r, own in enumerate(self.rest):
            if len(own):
                total[own] += values[r]


def _blocks(batch: pa.RecordBatch, dense: int) -> Iterator[tuple[slice, Block]]:
    """Blocks of the rows of a batch, and where they are."""
    lists = batch.column("terms")
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for low in range(0, batch.num_rows, BLOCK):
        ends = offsets[low : low + BLOCK + 1]
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        yield slice(low, low + len(ends) - 1), Block(flat[ends[0] : ends[-1]], row, len(ends) - 1, dense)


def _groups(numbers: Sequence[int], width: int) -> Iterator[list[int]]:
    """Models that are worked on together: a matrix with a column for each has about CELLS cells at most."""
    size = max(1, CELLS // max(width, 1))
    for low in range(0, len(numbers), size):
        yield list(numbers[low : low + size])


def _columns(models: Sequence[Model], vectors: Sequence[np.ndarray], width: int) -> np.ndarray:
    """Matrix of terms by models."""
    out = np.zeros((width, len(models)))
    for i, (m, vector) in enumerate(zip(models, vectors)):
        out[m.terms, i] = vector
    return out


def _inverse(squares: np.ndarray) -> np.ndarray:
    """One over the norm of each row in each model; zero for rows without a term of the model."""
    return np.where(squares > 0.0, 1.0 / np.sqrt(np.where(squares > 0.0, squares, 1.0)), 0.0)


def _summed(rows: DataFrame, sums: Callable) -> dict[int, np.ndarray]:
    """`sums` of each batch adds to one vector per model; added up by task, then by model."""

    def vectors(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        data = [v.tobytes() for v in total.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(data, pa.binary())], names=["model", "v"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                sums(batch, total)
        yield vectors(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("model").to_pylist(), batch.column("v")):
                vector = np.frombuffer(data.as_buffer(), np.float64)
                if number in total:
                    total[number] += vector
                else:
                    total[number] = vector.copy()
        yield vectors(total)

    schema = "model int, v binary"
    found = rows.mapInArrow(partial, schema).repartition("model").mapInArrow(added, schema).collect()
    return {r.model: np.frombuffer(r.v, np.float64) for r in found}


def _first_sums(models: Sequence[Model], width: int) -> Callable:
    """Sums of the features, of their products with the score and of their squares over a model's training rows."""

    def run(batch: pa.RecordBatch, total: dict[int, np.ndarray]) -> None:
        fold = batch.column("fold").to_numpy(zero_copy_only=False)
        y = batch.column("score").to_numpy(zero_copy_only=False)
        for group in _groups(range(len(models)), width):
            own = [models[i] for i in group]
            squares, held = _columns(own, [m.weights**2 for m in own], width), np.array([m.fold for m in own])
            three = [np.zeros((width, len(own))) for _ in range(3)]
            for at, block in _blocks(batch, min(DENSE, width)):
                value = _inverse(block.dot(squares)) * (fold[at, None] != held)
                for sums, v in zip(three, (value, value * y[at, None], value * value)):
                    block.add(v, sums)
            for k, (i, m) in enumerate(zip(group, own)):
                train = fold != m.fold
                x, xy, xx = (sums[m.terms, k] for sums in three)
                found = np.concatenate([m.weights * x, m.weights * xy, m.weights**2 * xx, [train.sum(), y[train].sum()]])
                total[i] = total.get(i, 0.0) + found

    return run


def _products(models: Sequence[Model], directions: dict[int, np.ndarray], width: int) -> Callable:
    """X'Xp over the training rows of each model that still has a direction p."""
    going = {i: models[i] for i in directions}

    def run(batch: pa.RecordBatch, total: dict[int, np.ndarray]) -> None:
        fold = batch.column("fold").to_numpy(zero_copy_only=False)
        for group in _groups(list(going), width):
            own, n = [going[i] for i in group], len(group)
            # Squares of the weights and weighted directions side by side, as the blocks are gone through once for both.
            tables = [_columns(own, [m.weights**2 for m in own], width), _columns(own, [m.weights * directions[i] for i, m in zip(group, own)], width)]
            both, held, sums = np.concatenate(tables, axis=1), np.array([m.fold for m in own]), np.zeros((width, n))
            for at, block in _blocks(batch, min(DENSE, width)):
                found = block.dot(both)
                block.add(_inverse(found[:, :n]) ** 2 * found[:, n:] * (fold[at, None] != held), sums)
            for k, (i, m) in enumerate(zip(group, own)):
                total[i] = total.get(i, 0.0) + m.weights * sums[m.terms, k]

    return run


def fitted(index: DataFrame, models: Sequence[Model], width: int) -> list[tuple[np.ndarray, float]]:
    """(weights, intercept) of every model.

    The descent is preconditioned by the diagonal and ends at TOLERANCE or after MOST_PASSES passes.
    """
    sums = _summed(index, _first_sums(models, width))
    mean, spread, y_mean, n, left, scale, w, p, gain = {}, {}, {}, {}, {}, {}, {}, {}, {}
    for i, m in enumerate(models):
        k = len(m.terms)
        own = sums.get(i, np.zeros(3 * k + 2))
        n[i] = max(own[-2], 1.0)
        mean[i], y_mean[i] = own[:k] / n[i], own[-1] / n[i]
        left[i] = own[k : 2 * k] - n[i] * mean[i] * y_mean[i]
        spread[i] = np.maximum(own[2 * k : 3 * k] - n[i] * mean[i] ** 2, 0.0) + m.alpha
        scale[i], w[i] = np.linalg.norm(left[i]), np.zeros(k)
        p[i] = left[i] / spread[i]
        gain[i] = left[i] @ p[i]
    for _ in range(MOST_PASSES):
        going = {i: p[i] for i in p if np.linalg.norm(left[i]) > TOLERANCE * scale[i]}
        if not going:
            break
        products = _summed(index, _products(models, going, width))
        for i, direction in going.items():
            through = products[i] - n[i] * mean[i] * (mean[i] @ direction) + models[i].alpha * direction
            step = gain[i] / (direction @ through)
            w[i] = w[i] + step * direction
            left[i] = left[i] - step * through
            eased = left[i] / spread[i]
            before, gain[i] = gain[i], left[i] @ eased
            p[i] = eased + gain[i] / before * direction
    return [(w[i], y_mean[i] - mean[i] @ w[i]) for i in range(len(models))]


def held_out(index: DataFrame, models: Sequence[Model], fits: Sequence[tuple[np.ndarray, float]], width: int) -> DataFrame:
    """(trial, fold, _key, score, prediction) of every row by every model that was fitted without it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for group in _groups(range(len(models)), width):
                own = [models[i] for i in group]
                tables = [_columns(own, [m.weights**2 for m in own], width), _columns(own, [m.weights * fits[i][0] for i, m in zip(group, own)], width)]
                both, n = np.concatenate(tables, axis=1), len(group)
                predicted = np.zeros((batch.num_rows, n))
                for at, block in _blocks(batch, 0):  # equal predictions must stay equal
                    found = block.dot(both)
                    predicted[at] = _inverse(found[:, :n]) * found[:, n:]
                for k, (i, m) in enumerate(zip(group, own)):
                    mine = fold == m.fold
                    if not mine.any():
                        continue
                    rows = batch.filter(pa.array(mine))
                    trial = pa.array(np.full(rows.num_rows, m.trial), pa.int32())
                    columns = [trial, rows.column("fold"), rows.column("_key"), rows.column("score"), pa.array(predicted[mine, k] + fits[i][1])]
                    yield pa.RecordBatch.from_arrays(columns, ["trial", "fold", "_key", "score", "prediction"])

    kind = index.schema["_key"].dataType.simpleString()
    return index.mapInArrow(run, f"trial int, fold int, _key {kind}, score double, prediction double")


def ridge_predictions(data: DataFrame, key: str, candidates: Sequence[dict]) -> DataFrame:
    """Held-out predictions of every candidate in every fold of `data` (key, fold, tokens, score)."""
    sizes = {r.fold: r.n for r in data.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).orderBy("fold").collect()}
    found = vocabularies(counts_by_fold(data, list(sizes)), sizes, candidates)
    n, models = sum(sizes.values()), []
    most: dict[str, int] = {}
    for _, _, terms in found:
        for term, df in terms:
            most[term] = max(df, most.get(term, 0))
    numbers = {term: i for i, term in enumerate(sorted(most, key=lambda t: (-most[t], t)))}
    for trial, fold, terms in found:
        own = candidates[trial]
        if n == sizes[fold]:
            continue  # no rows left to train on
        if not terms:
            raise ValueError("no term lies between the document frequency bounds")
        df = np.array([d for _, d in terms], dtype=np.float64)
        weights = np.log((1.0 + n - sizes[fold]) / (1.0 + df)) + 1.0 if own["use_idf"] else np.ones(len(df))
        places = np.array([numbers[t] for t, _ in terms], dtype=np.int64)
        models.append(Model(trial, fold, float(own["alpha"]), places, weights))
    index = term_index(data, key, numbers, n)
    return held_out(index, models, fitted(index, models, len(numbers)), len(numbers))
