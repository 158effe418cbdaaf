"""Train, tune and compare score regressors."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
    StandardScaler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from roleweave.functions.text import labelled_paragraphs
from roleweave.operators.correlation import spearman
from roleweave.operators.encoding import Encoder
from roleweave.operators.tokens import tokens, vocabulary
from roleweave.plans.bag_of_words import ridge_predictions
from roleweave.plans.scoring import build_features, save_model
from roleweave.session import stage
from roleweave.sources.training_files import skipped_rows, training_rows

FOLDS = 5
REGRESSORS = ("ridge", "elasticnet", "gbt")
Params = dict[str, float | int | bool]


# ---------------------------------------------------------------- training rows

# Headings of the paragraphs that say what the work asks for.
PARAGRAPH_LABELS = r"(?:key )?responsibilities|(?:job )?requirements"


def labelled_features(
    scores: DataFrame, texts: DataFrame, encoder: Encoder, reference: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(name, score, features) of the scored texts, and the scored names that have no text."""
    rows = training_rows(scores, texts)
    if rows.isEmpty():
        raise ValueError("no usable training rows")
    features = build_features(rows, encoder, reference).select("name", "score", "features")
    return stage(features, "labelled"), skipped_rows(scores, texts)


def bow_rows(rows: DataFrame, text: str = "description", labels: str = PARAGRAPH_LABELS) -> DataFrame:
    """Adds `tokens` of the labelled paragraphs; rows without any token are dropped."""
    return rows.withColumn("tokens", tokens(labelled_paragraphs(F.col(text), labels))).filter(F.size("tokens") > 0)


# ---------------------------------------------------------------- search space


def _log_uniform(rng: random.Random, low: float, high: float) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high)))


def draw_params(regressor: str, rng: random.Random) -> Params:
    """One random point of the regressor's search space."""
    if regressor == "ridge":
        return {"alpha": _log_uniform(rng, 1e-4, 1e2)}
    if regressor == "elasticnet":
        return {
            "alpha": _log_uniform(rng, 1e-4, 1e2),
            "l1_ratio": rng.uniform(0.01, 0.99),
            "max_iter": rng.randrange(1000, 10001, 1000),
        }
    if regressor == "gbt":
        return {
            "iterations": rng.randrange(100, 401, 50),
            "learning_rate": _log_uniform(rng, 0.01, 0.2),
            "depth": rng.randint(2, 5),
            "subsample": rng.uniform(0.6, 1.0),
        }
    raise ValueError(f"unknown regressor: {regressor!r}")


def draw_bow_params(rng: random.Random) -> Params:
    """One random point of the bag-of-words search space."""
    return {
        "min_df": rng.randint(1, 5),
        "max_df": rng.uniform(0.8, 1.0),
        "max_features": rng.randrange(100, 3001, 100),
        "max_ngram": rng.randint(1, 2),
        "use_idf": rng.random() < 0.5,
    }


def trials(regressor: str, count: int, seed: int = 0) -> list[Params]:
    rng = random.Random(seed)
    return [draw_params(regressor, rng) for _ in range(count)]


def bow_trials(regressor: str, count: int, seed: int = 0) -> list[Params]:
    """Random points of the regressor's search space, each with one of the bag-of-words search space."""
    rng = random.Random(seed)
    return [{**draw_params(regressor, rng), **draw_bow_params(rng)} for _ in range(count)]


def boosted_trials(count: int, seed: int = 0, iterations: Sequence[int] = range(100, 401, 50)) -> list[Params]:
    """Points of the boosted trees' search space in families that differ by their number of trees only.

    A family costs one fit of its largest number in each fold, as all smaller numbers are its first trees.
    """
    rng, found = random.Random(seed), []
    while len(found) < count:
        drawn = draw_params("gbt", rng)
        found += [{**drawn, "iterations": n} for n in iterations]
    return found[:count]


# ---------------------------------------------------------------- estimators


def estimator(regressor: str, params: Params, stats: Row, features: str = "scaled"):
    """Spark ML estimator with the penalty of the textbook objective.

    `stats` holds n, std_pop and std_samp of the target. Spark divides its penalty by the target's
    deviation, so the weights are scaled to give the same coefficients as minimizing
    |y - Xw|^2 + alpha |w|^2, or the elastic net objective with alpha and l1_ratio.
    """
    common = dict(featuresCol=features, labelCol="score", predictionCol="prediction")
    if regressor == "ridge":
        reg = params["alpha"] / stats.n * (stats.std_pop or 0.0)
        return LinearRegression(solver="normal", regParam=reg, elasticNetParam=0.0, standardization=False, **common)
    if regressor == "elasticnet":
        l1 = params["alpha"] * params["l1_ratio"]
        l2 = params["alpha"] * (1.0 - params["l1_ratio"]) * (stats.std_samp or 0.0)
        return LinearRegression(
            solver="l-bfgs",
            regParam=l1 + l2,
            elasticNetParam=l1 / (l1 + l2),
            maxIter=int(params["max_iter"]),
            standardization=False,
            **common,
        )
    if regressor == "gbt":
        return GBTRegressor(
            maxIter=int(params["iterations"]),
            stepSize=params["learning_rate"],
            maxDepth=int(params["depth"]),
            subsamplingRate=params["subsample"],
            seed=42,
            **common,
        )
    raise ValueError(f"unknown regressor: {regressor!r}")


def target_stats(rows: DataFrame) -> Row:
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop("score").alias("std_pop"), F.stddev_samp("score").alias("std_samp")
    ).first()


def population_scaler(rows: DataFrame, n: int, dims: int) -> PipelineModel:
    """Mean 0, population deviation 1: Spark scales by the sample deviation, the second step corrects it."""
    correction = math.sqrt(n / (n - 1.0)) if n > 1 else 1.0
    scale = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="_standard")
    correct = ElementwiseProduct(
        scalingVec=Vectors.dense([correction] * dims), inputCol="_standard", outputCol="scaled"
    )
    return Pipeline(stages=[scale, correct]).fit(rows)


def embedding_preprocessor(rows: DataFrame, params: Params) -> PipelineModel:
    """Scaler for the embedding features."""
    return population_scaler(rows, rows.count(), rows.select("features").first().features.size)


def bow_preprocessor(rows: DataFrame, params: Params) -> PipelineModel:
    """Binary bag of words with smoothed idf (+1) and L2 norm, fitted on `tokens`."""
    words = "tokens"
    stages: list = []
    if params["max_ngram"] == 2:
        stages.append(SQLTransformer(statement=f"SELECT *, {_PAIRS} AS terms FROM __THIS__"))
        words = "terms"
    paired = PipelineModel(stages=stages).transform(rows)
    # Ranked by document frequency, ties by term; CountVectorizer itself would rank by total counts.
    table = vocabulary(paired, words, int(params["min_df"]), float(params["max_df"]), int(params["max_features"]))
    terms = [r.term for r in table.select("term", "df").orderBy(F.desc("df"), "term").collect()]  # at most max_features
    if not terms:
        raise ValueError("no term lies between the document frequency bounds")
    counts = CountVectorizerModel.from_vocabulary(terms, inputCol=words, outputCol="_counts").setBinary(True)
    counted = PipelineModel(stages=[*stages, counts])
    weighted_col = "_counts"
    fitted: list = list(counted.stages)
    if params["use_idf"]:
        idf = IDF(inputCol="_counts", outputCol="_idf").fit(counted.transform(rows))
        weights = Vectors.dense([float(w) + 1.0 for w in idf.idf])
        fitted.append(ElementwiseProduct(scalingVec=weights, inputCol="_counts", outputCol="_weighted"))
        weighted_col = "_weighted"
    fitted.append(Normalizer(p=2.0, inputCol=weighted_col, outputCol="scaled"))
    return PipelineModel(stages=fitted)


_PAIRS = (
    "concat(tokens, zip_with("
    "slice(tokens, 1, greatest(size(tokens) - 1, 0)), slice(tokens, 2, greatest(size(tokens) - 1, 0)), "
    "(a, b) -> concat_ws(' ', a, b)))"
)

Preprocessor = Callable[[DataFrame, Params], PipelineModel]


def fit(regressor: str, params: Params, rows: DataFrame, preprocessor: Preprocessor) -> PipelineModel:
    """Preprocessor and regressor fitted on all rows, as one pipeline."""
    pre = preprocessor(rows, params)
    model = estimator(regressor, params, target_stats(rows)).fit(pre.transform(rows))
    return PipelineModel(stages=[*pre.stages, model])


# ---------------------------------------------------------------- linear models from one pass

# Widest feature vector a linear model is solved for: one matrix of its square is the driver's.
MOMENT_DIMS = 4096


def fold_moments(rows: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """Sums of products of (1, features, score) per fold, from one pass over the rows.

    Each task adds up its rows; the partial sums, one small matrix per task and fold, are combined in
    two rounds so that no task receives all of them.
    """
    width = dims + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            y = batch.column("score").to_numpy(zero_copy_only=False)
            a = np.column_stack([np.ones(len(y)), flat.reshape(len(y), -1), y])
            for fold in np.unique(folds):
                part = a[folds == fold]
                sums[int(fold)] = sums.get(int(fold), 0.0) + part.T @ part
        names = ["fold", "moments"]
        for fold, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold], pa.int32()), pa.array([total.ravel()], pa.list_(pa.float64()))], names=names
            )

    vectors = rows.select("fold", vector_to_array("features").alias("x"), F.col("score").cast("double").alias("score"))
    parts = vectors.mapInArrow(partial, "fold int, moments array<double>").withColumn(
        "_group", F.pmod(F.spark_partition_id(), F.lit(32))
    )
    first = parts.groupBy("fold", "_group").agg(Summarizer.sum(array_to_vector("moments")).alias("m"))
    total = first.groupBy("fold").agg(Summarizer.sum(F.col("m")).alias("m"))
    return {r.fold: r.m.toArray().reshape(width, width) for r in total.collect()}  # one row per fold


def _spread(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of every feature; constant ones have deviation 1."""
    n, mean = moments[0, 0], moments[0, 1:-1] / moments[0, 0]
    variance = np.diag(moments)[1:-1] / n - mean**2
    # What is left of a constant column after the subtraction is rounding.
    flat = variance <= 1e-12 * np.maximum(np.diag(moments)[1:-1] / n, 1e-300)
    return mean, np.sqrt(np.where(flat, 1.0, variance))


Scale = tuple[np.ndarray, np.ndarray]


def _centred(train: np.ndarray, scale: Scale | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable]:
    """Gram matrix and cross products of centred, standardized features, and what leads weights back to the raw features.

    Features are standardized by `scale`, by the training rows themselves without it.
    """
    n, y_mean = train[0, 0], train[0, -1] / train[0, 0]
    _, deviation = scale or _spread(train)
    mean = train[0, 1:-1] / n
    gram = (train[1:-1, 1:-1] - n * np.outer(mean, mean)) / np.outer(deviation, deviation)
    cross = (train[1:-1, -1] - n * mean * y_mean) / deviation

    def raw(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = weights / deviation
        return weights, y_mean - weights @ mean

    return gram, cross, n, raw


def ridge_from_moments(train: np.ndarray, alphas: Sequence[float], scale: Scale | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights, intercepts) in the space of the raw features, one row per alpha.

    |y - Xw|^2 + alpha |w|^2 is minimized exactly, with the intercept left free.
    """
    gram, cross, _, raw = _centred(train, scale)
    values, vectors = np.linalg.eigh(gram)
    rotated = vectors.T @ cross
    return raw(np.array([vectors @ (rotated / (np.maximum(values, 0.0) + alpha)) for alpha in alphas]))


def elastic_from_moments(train: np.ndarray, candidates: Sequence[Params], scale: Scale | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights, intercepts) in the space of the raw features, one row per candidate.

    |y - Xw|^2 / 2n + alpha (l1_ratio |w| + (1 - l1_ratio) |w|^2 / 2) is minimized by coordinate descent on the Gram matrix,
    which needs no further look at the rows. Candidates are taken by falling alpha, each starting from the weights of the
    one before. Once the descent has settled which weights aren't zero and their signs, these solve a linear system, and
    the candidate is done when that changes no sign and no zero weight breaks its bound.
    """
    gram, cross, n, raw = _centred(train, scale)
    gram, cross = gram / n, cross / n
    diagonal, weights = np.diag(gram).copy(), np.zeros((len(candidates), len(cross)))
    w = np.zeros(len(cross))
    pull = np.zeros(len(cross))  # gram @ w
    for number in sorted(range(len(candidates)), key=lambda i: -candidates[i]["alpha"]):
        own = candidates[number]
        l1, l2 = own["alpha"] * own["l1_ratio"], own["alpha"] * (1.0 - own["l1_ratio"])
        active = np.flatnonzero(diagonal > 0.0)
        for _ in range(int(own.get("max_iter", 1000))):
            for j in active.tolist():
                lean = cross[j] - pull[j] + diagonal[j] * w[j]
                new = math.copysign(max(abs(lean) - l1, 0.0), lean) / (diagonal[j] + l2)
                if new != w[j]:
                    pull += gram[j] * (new - w[j])
                    w[j] = new
            active = np.flatnonzero(w)
            sign = np.sign(w[active])
            exact = np.linalg.solve(gram[np.ix_(active, active)] + l2 * np.eye(len(active)), cross[active] - l1 * sign)
            if (np.sign(exact) != sign).any():
                continue
            w[active] = exact
            pull = gram[:, active] @ exact
            broken = np.flatnonzero((w == 0.0) & (np.abs(cross - pull) > l1 * (1.0 + 1e-9)) & (diagonal > 0.0))
            if not len(broken):
                break
            active = np.union1d(active, broken)
        weights[number] = w
    return raw(weights)


# Linear models whose fits of all trials follow from the sums of one pass.
FROM_MOMENTS: dict[str, Callable] = {
    "ridge": lambda train, candidates, scale: ridge_from_moments(train, [c["alpha"] for c in candidates], scale),
    "elasticnet": elastic_from_moments,
}


def _linear_scores(weights: np.ndarray, intercepts: np.ndarray) -> Callable[[Column], Column]:
    """UDF: predictions of several linear models at once; refers to nothing of this package."""

    @F.arrow_udf("array<double>")
    def scores(vectors: pa.Array) -> pa.Array:
        n, k = len(vectors), len(intercepts)
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, weights.shape[1]))
        flat = pa.array((x @ weights.T + intercepts).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), flat)

    return scores


def _linear_predictions(
    data: DataFrame, key: str, regressor: str, candidates: Sequence[Params], dims: int, shared_scale: bool
) -> DataFrame:
    """Held-out predictions of every candidate in every fold: one pass for the sums, one for the predictions."""
    moments = fold_moments(data, dims)
    everything = sum(moments.values())
    scale = _spread(everything) if shared_scale else None
    parts = []
    for fold, own in moments.items():
        if everything[0, 0] == own[0, 0]:
            continue  # no rows left to train on
        predict = _linear_scores(*FROM_MOMENTS[regressor](everything - own, candidates, scale))
        held_out = data.filter(F.col("fold") == fold)
        predicted = held_out.select(
            "fold", F.col(key).alias("_key"), "score", predict(vector_to_array("features")).alias("_p")
        )
        parts.append(predicted.select("fold", "_key", "score", F.posexplode_outer("_p").alias("trial", "prediction")))
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- cross-validation


def with_fold(rows: DataFrame, key: str, folds: int = FOLDS, seed: int = 0) -> DataFrame:
    """Deterministic fold of every row from its key."""
    return rows.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int"))


def _families(regressor: str, candidates: Sequence[Params]) -> list[list[int]]:
    """Numbers of the candidates that one fit serves: boosted trees that differ by their number of iterations only."""
    found: dict[tuple, list[int]] = {}
    for number, own in enumerate(candidates):
        same = tuple(sorted((k, v) for k, v in own.items() if k != "iterations")) if regressor == "gbt" else number
        found.setdefault(same, []).append(number)
    return list(found.values())


def first_trees(model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The model of the first `count` iterations: boosting adds trees and never changes earlier ones."""
    context = SparkContext.getOrCreate()
    boosted = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(boosted.DecisionTreeRegressionModel, count)
    weights = context._gateway.new_array(context._jvm.double, count)
    for i, (tree, weight) in enumerate(zip(model.trees[:count], model.treeWeights[:count])):
        trees[i], weights[i] = tree._java_obj, weight
    short = GBTRegressionModel(boosted.GBTRegressionModel(f"{model.uid}_{count}", trees, weights))
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def _fitted_predictions(
    data: DataFrame,
    key: str,
    regressor: str,
    candidates: Sequence[Params],
    preprocessor: Preprocessor,
    shared: PipelineModel | None,
    parallelism: int,
) -> DataFrame:
    """Held-out predictions of one Spark ML fit per family of trials and fold, `parallelism` fits at a time."""

    def held_out_predictions(fold: int, family: list[int]) -> DataFrame:
        train, held_out = data.filter(F.col("fold") != fold), data.filter(F.col("fold") == fold)
        params = max((candidates[number] for number in family), key=lambda c: c.get("iterations", 0))
        pre = shared or preprocessor(train, params)
        model = estimator(regressor, params, target_stats(train)).fit(pre.transform(train))
        ready = pre.transform(held_out)
        parts = []
        for number in family:
            own = model if candidates[number] == params else first_trees(model, int(candidates[number]["iterations"]))
            parts.append(own.transform(ready).select(F.lit(number).alias("trial"), "fold", F.col(key).alias("_key"), "score", "prediction"))
        return reduce(DataFrame.unionByName, parts)

    present = sorted(r.fold for r in data.select("fold").distinct().collect())
    tasks = [(fold, family) for fold in present for family in _families(regressor, candidates)]
    run = inheritable_thread_target(data.sparkSession)(lambda task: held_out_predictions(*task))
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return reduce(DataFrame.unionByName, pool.map(run, tasks, chunksize=1))


def cross_validate(
    rows: DataFrame,
    key: str,
    regressor: str,
    candidates: Sequence[Params],
    preprocessor: Preprocessor = embedding_preprocessor,
    scale_before_split: bool = False,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> DataFrame:
    """(trial, spearman): mean over folds of the held-out rank correlation.

    Linear models on dense features need one pass for all trials and folds at any width up to MOMENT_DIMS,
    and beyond it are refused; ridge on bags of words is fitted for all of them in step; other models are fitted with Spark ML,
    boosted trees once for all numbers of iterations. Held-out predictions of all trials and folds are ranked together. By
    default features are scaled inside each fold; `scale_before_split` scales once on all rows, as the exported model has it.
    """
    data = stage(with_fold(rows, key, folds), "training")
    if regressor in FROM_MOMENTS and preprocessor is embedding_preprocessor:
        dims = data.select("features").first().features.size
        if dims > MOMENT_DIMS:
            raise ValueError(f"{regressor} takes at most {MOMENT_DIMS} features, not {dims}")
        predictions = _linear_predictions(data, key, regressor, candidates, dims, scale_before_split)
    elif regressor == "ridge" and preprocessor is bow_preprocessor and not scale_before_split:
        predictions = ridge_predictions(data, key, candidates)
    else:
        shared = preprocessor(data, candidates[0]) if scale_before_split else None
        predictions = _fitted_predictions(data, key, regressor, candidates, preprocessor, shared, parallelism)
    by_fold = spearman(stage(predictions, "predictions"), "score", "prediction", "_key", ("trial", "fold"))
    return by_fold.groupBy("trial").agg((F.sum("spearman") / F.lit(float(folds))).alias("spearman"))


@dataclass(frozen=True)
class Study:
    """Outcome of a search."""

    regressor: str
    params: Params
    spearman: float


def tune(
    rows: DataFrame,
    key: str,
    regressor: str,
    n_trials: int = 30,
    preprocessor: Preprocessor = embedding_preprocessor,
    bow: bool = False,
    scale_before_split: bool = False,
    seed: int = 0,
) -> Study:
    """Best of `n_trials` seeded random points."""
    if bow:
        candidates = bow_trials(regressor, n_trials, seed)
    else:
        candidates = boosted_trials(n_trials, seed) if regressor == "gbt" else trials(regressor, n_trials, seed)
    results = cross_validate(rows, key, regressor, candidates, preprocessor, scale_before_split)
    best = results.orderBy(F.desc("spearman"), "trial").first()
    return Study(regressor, candidates[best.trial], best.spearman)


def train_export(
    rows: DataFrame,
    key: str,
    regressor: str,
    fingerprint: dict[str, str],
    model_path: str,
    n_trials: int = 30,
    seed: int = 0,
) -> float:
    """Tune, refit on all rows, store model and metadata; returns the best cross-validated value.

    `rows` holds the key, `score` and `features`.
    """
    if regressor not in REGRESSORS:
        raise ValueError(f"unknown regressor: {regressor!r}")
    if rows.isEmpty():
        raise ValueError("no usable training rows")
    study = tune(rows, key, regressor, n_trials, scale_before_split=True, seed=seed)
    save_model(fit(regressor, study.params, rows, embedding_preprocessor), fingerprint, model_path)
    return study.spearman


def compare(
    rows: DataFrame, key: str, families: dict[str, tuple[Preprocessor, Sequence[str]]], n_trials: int = 30, seed: int = 0
) -> tuple[DataFrame, dict[tuple[str, str], Study]]:
    """(model, family, spearman) of every regressor in every feature family, and the studies."""
    studies = {
        (name, family): tune(rows, key, name, n_trials, pre, bow=pre is bow_preprocessor, seed=seed)
        for family, (pre, names) in families.items()
        for name in names
    }
    results = [(name, family, study.spearman) for (name, family), study in studies.items()]
    return rows.sparkSession.createDataFrame(results, "model string, family string, spearman double"), studies


def save_all(
    rows: DataFrame,
    studies: dict[tuple[str, str], Study],
    families: dict[str, tuple[Preprocessor, Sequence[str]]],
    folder: str,
) -> list[str]:
    """Fit every studied model at its best parameters on all rows and store it."""
    paths = []
    for (name, family), study in studies.items():
        path = f"{folder.rstrip('/')}/{family}_{name}"
        fit(name, study.params, rows, families[family][0]).write().overwrite().save(path)
        paths.append(path)
    return paths
