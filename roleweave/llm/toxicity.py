"""Operator 3, toxicity: a chain of linear models, one per category, each fed the probabilities of the earlier ones.

Words and their stems are hashed to presence features, weighted by their log count ratio between the two classes. The models of the chain
are fitted on a bounded sample of labelled rows (SAMPLE, those with the least hash of doc_id): earlier probabilities
enter training out of fold, so that a later model sees them as noisy as they will be on new texts. Judging is one Arrow
pass over whole texts with the weight vectors, whose size is fixed by BITS.

Null and empty texts have no features and get the chain's bias. Labelled rows without a document, or with a null
label, are ignored; a category without both classes in the sample predicts its rate. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.llm import arrays

BITS = 18
# Besides each word its first bytes are features, for words that share a stem.
STEM_BYTES = (5, 7)
# Labelled rows that are fitted on.
SAMPLE = 6000
FOLDS = 3
# Documents of the sample that must hold a word before it counts.
LEAST_DOCUMENTS = 4
# Least log count ratio, either way, of a feature that is used.
LEAST_RATIO = 1.0
RIDGE = 0.5
STEPS = 120
REJECT_FROM = 0.5
# Words that tell the kinds of abuse apart among documents labelled toxic.
KINDS = {"insult": ("idiot", "moron", "clown", "loser", "stupid"), "contempt": ("trash", "scum", "worthless", "pathetic", "disgusting")}


@dataclass
class Chain:
    """Per category: name, bias, word weights, weights of the logits of all earlier categories."""

    names: list[str]
    bias: list[float]
    weights: list[np.ndarray]
    earlier: list[np.ndarray]


def word_features(texts: arrays.Texts, hasher: arrays.Hasher, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) pairs of words and stems, each once, by document; only features flagged in `used`, if given."""
    texts = texts.lower()
    spans = arrays.words(texts, arrays.ALPHANUMERIC)
    ends = [spans.ends, *(np.minimum(spans.ends, spans.starts + n) for n in STEM_BYTES)]
    hashes = np.concatenate([hasher.spans(texts.data, spans.starts, end) for end in ends])
    feature = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    document = np.tile(spans.document(), len(ends))
    if used is not None:
        keep = used[feature]
        feature, document = feature[keep], document[keep]
    pairs = np.unique((document << BITS) | feature)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(document: np.ndarray, feature: np.ndarray, y: np.ndarray, dense: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Ridge logistic regression on presence features scaled by their log count ratio, and on dense columns.

    Returns bias, word weights and dense weights. Plain accelerated gradient steps from zero: repeatable.
    """
    size = 1 << BITS
    n_pos, n_neg = max(y.sum(), 0.0), max((1 - y).sum(), 0.0)
    if not n_pos or not n_neg:
        rate = n_pos / max(len(y), 1)
        return float(_logit(np.array(rate))), np.zeros(size, np.float32), np.zeros(dense.shape[1], np.float32)
    pos = np.bincount(feature, weights=y[document], minlength=size)
    neg = np.bincount(feature, minlength=size) - pos
    ratio = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    ratio[(pos + neg < LEAST_DOCUMENTS) | (np.abs(ratio) < LEAST_RATIO)] = 0
    columns, at = np.unique(feature[ratio[feature] != 0], return_inverse=True)
    rows = document[ratio[feature] != 0]
    value = ratio[columns]
    width = len(columns)
    # Each class weighs half.
    weight = np.where(y > 0, 0.5 / n_pos, 0.5 / n_neg) * len(y)
    w, velocity = np.zeros(width + dense.shape[1] + 1), np.zeros(width + dense.shape[1] + 1)
    step = 4.0 / (np.bincount(rows, weights=value[at] ** 2, minlength=len(y)).mean() + (dense**2).sum(1).mean() + 1)
    penalty = np.concatenate((np.full(width + dense.shape[1], RIDGE / len(y)), [0.0]))

    def score(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=(w[:width] * value)[at], minlength=len(y)) + dense @ w[width:-1] + w[-1]

    for _ in range(STEPS):
        ahead = w + 0.9 * velocity
        error = weight * (_sigmoid(score(ahead)) - y) / len(y)
        gradient = np.concatenate((np.bincount(at, weights=error[rows], minlength=width) * value, dense.T @ error, [error.sum()])) + penalty * ahead
        velocity = 0.9 * velocity - step * gradient
        w = w + velocity
    words = np.zeros(size, dtype=np.float32)
    words[columns] = w[:width] * value
    return float(w[-1]), words, w[width:-1].astype(np.float32)


def _predict(model: tuple[float, np.ndarray, np.ndarray], document: np.ndarray, feature: np.ndarray, dense: np.ndarray) -> np.ndarray:
    bias, words, earlier = model
    return _sigmoid(np.bincount(document, weights=words[feature], minlength=len(dense)) + dense @ earlier + bias)


def fit_chain(document: np.ndarray, feature: np.ndarray, labels: dict[str, np.ndarray]) -> Chain:
    """Fit the categories in the order given on (document, feature) pairs; fold i holds the documents i modulo FOLDS."""
    size = len(next(iter(labels.values())))
    common = np.bincount(feature, minlength=1 << BITS)[feature] >= LEAST_DOCUMENTS
    document, feature = document[common], feature[common]
    fold = np.arange(size) % FOLDS
    dense = np.zeros((size, 0))
    chain = Chain([], [], [], [])
    for name, y in labels.items():
        y = np.asarray(y, dtype=float)
        out_of_fold = np.zeros(size)
        for i in range(FOLDS):
            train, held = fold != i, fold == i
            if not held.any() or not train.any():
                continue
            index = np.cumsum(train) - 1
            own, other = train[document], held[document]
            model = fit_linear(index[document[own]], feature[own], y[train], dense[train])
            place = np.cumsum(held) - 1
            out_of_fold[held] = _predict(model, place[document[other]], feature[other], dense[held])
        bias, words, earlier = fit_linear(document, feature, y, dense)
        chain.names.append(name)
        chain.bias.append(bias)
        chain.weights.append(words)
        chain.earlier.append(earlier)
        dense = np.column_stack((dense, _logit(out_of_fold)))
    return chain


def predict_chain(chain: Chain, texts: arrays.Texts, hasher: arrays.Hasher) -> list[np.ndarray]:
    """Probabilities of each category, in the chain's order."""
    used = np.logical_or.reduce([w != 0 for w in chain.weights])
    document, feature = word_features(texts, hasher, used)
    out, dense = [], np.zeros((len(texts), 0))
    for model in zip(chain.bias, chain.weights, chain.earlier):
        out.append(_predict(model, document, feature, dense))
        dense = np.column_stack((dense, _logit(out[-1])))
    return out


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic of at most `sample` labelled documents: those with the least hash of doc_id.

    Only the ids and labels are ordered; the chosen ones (a bounded table) are then joined with the documents.
    """
    chosen = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    chosen = chosen.select(F.col("doc_id").alias("_doc_id"), "_toxic")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc_id")).select("doc_id", "text", F.col("_toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, kinds: dict[str, tuple[str, ...]] = KINDS, sample: int = SAMPLE) -> Chain:
    """The chain kind by kind, and last `toxic` itself. A labelled toxic document is of each kind whose words it holds."""
    padded = F.concat(F.lit(" "), F.regexp_replace(arrays.ascii_lower(F.coalesce("text", F.lit(""))), "[^a-z]+", " "), F.lit(" "))
    holds = lambda words: F.greatest(*[padded.contains(f" {w} ") for w in words], F.lit(False))
    flags: dict[str, Column] = {name: (F.col("toxic") > 0) & holds(words) for name, words in kinds.items()}
    wanted = labelled(docs, labels, sample).select("doc_id", "text", (F.col("toxic") > 0).alias("toxic"), *[c.alias(f"_{n}") for n, c in flags.items()])
    names = [c for c in wanted.columns if c != "text"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields if f.name != "text")
    rows = wanted.mapInArrow(_packed_features(names), f"{fields}, features binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.features)))
    lists = [np.frombuffer(r.features, dtype=np.int32) for r in rows]
    document = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in lists])
    feature = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int32)
    columns = {name: np.array([float(r[f"_{name}"]) for r in rows]) for name in kinds}
    return fit_chain(document, feature, columns | {"toxic": np.array([float(r.toxic) for r in rows])})


def _packed_features(names: list[str]):
    """Distinct features of each text as packed 32-bit numbers; the texts stay with the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrays.Hasher()
        for batch in arrays.slices(batches, "text"):
            document, feature = word_features(arrays.texts_of(batch.column("text")), hasher)
            first = np.searchsorted(document, np.arange(batch.num_rows + 1))
            feature = feature.astype(np.int32)
            found = [feature[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(found, pa.binary())], [*names, "features"])

    return run


def scores(docs: DataFrame, chain: Chain, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all by default), p_<category> columns and `toxic_rejected`.

    A document is rejected if its last probability is at least REJECT_FROM. Columns of the same names are replaced.
    """
    model = arrays.shared(docs.sparkSession, chain)
    names = [f"p_{n}" for n in chain.names]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (*names, "toxic_rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, hasher = model(), arrays.Hasher()
        for batch in arrays.slices(batches, "text"):
            found = predict_chain(chain, arrays.texts_of(batch.column("text")), hasher)
            columns = [pa.array(p, pa.float64()) for p in found] + [pa.array(found[-1] >= REJECT_FROM)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + columns, [*kept, *names, "toxic_rejected"])

    fields = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in kept]
    read = docs.select(*dict.fromkeys([*kept, "text"]))
    return read.mapInArrow(run, ", ".join([*fields, *[f"{n} double" for n in names], "toxic_rejected boolean"]))


def clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of `docs` that the chain doesn't reject, with their own columns, whatever these are called."""
    aside = {c: arrays.unused(docs.columns, f"_own_{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    kept = scores(docs.withColumnsRenamed(aside), chain).where("not toxic_rejected")
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
