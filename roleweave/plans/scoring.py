"""Score pending postings with a trained model."""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from roleweave.operators.encoding import Encoder
from roleweave.operators.similarity import feature_vector, fit_features
from roleweave.operators.triage import pending_score
from roleweave.session import stage
from roleweave.sources.store import PostingStore


class ModelMissing(FileNotFoundError):
    """The model or its metadata is not there."""


class ModelMismatch(RuntimeError):
    """The model was trained on vectors of another encoder."""


def save_model(model: PipelineModel, fingerprint: dict[str, str], path: str) -> None:
    """Store the fitted pipeline (scaler and regressor) with the encoder it belongs to."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/pipeline")
    spark.createDataFrame([(json.dumps(fingerprint, sort_keys=True),)], "fingerprint string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/metadata")


def load_model(spark: SparkSession, path: str, fingerprint: dict[str, str]) -> PipelineModel:
    """Load a model, refusing it when it is absent or belongs to another encoder."""
    try:
        recorded = json.loads(spark.read.schema("fingerprint string").json(f"{path}/metadata").first().fingerprint)
    except AnalysisException as exc:
        raise ModelMissing(f"no model metadata under {path}; train a model first") from exc
    keys = sorted(recorded.keys() | fingerprint.keys())
    differing = [k for k in keys if recorded.get(k) != fingerprint.get(k)]
    if differing:
        detail = "; ".join(f"{k}: trained={recorded.get(k)!r}, now={fingerprint.get(k)!r}" for k in differing)
        raise ModelMismatch(f"the model was trained on another vector space ({detail})")
    try:
        return PipelineModel.load(f"{path}/pipeline")
    except Py4JJavaError as exc:
        raise ModelMissing(f"no model under {path}; train a model first") from exc
    except AnalysisException as exc:
        raise ModelMissing(f"no model under {path}; train a model first") from exc


def build_features(texts: DataFrame, encoder: Encoder, reference: DataFrame, text: str = "description") -> DataFrame:
    """Add the embedding, the three fit values and the model input `features`.

    `reference` is (kind, position, vector) as `reference_vectors` returns it.
    """
    sections = reference.filter("kind = 'section'").select(F.col("position").cast("long").alias("section_id"), "vector")
    resume = reference.filter("kind = 'resume'").select("vector")
    encoded = encoder.encode(texts, text, "embedding")
    return fit_features(encoded, sections, resume).withColumn("features", feature_vector())


def score_texts(texts: DataFrame, encoder: Encoder, reference: DataFrame, model: PipelineModel) -> DataFrame:
    """(url, score) of (url, description) rows. Embeddings run in Arrow batches, the rest in the JVM."""
    features = build_features(texts, encoder, reference).select("url", "features")
    return model.transform(features).select("url", F.col("prediction").alias("score"))


def score_pending(store: PostingStore, encoder: Encoder, reference: DataFrame, model_path: str) -> Row:
    """Score relevant postings that have a text and no score; nothing pending needs no model."""
    pending = pending_score(store.read())
    if pending.isEmpty():
        return Row(pending_count=0, scored_count=0)
    model = load_model(store.spark, model_path, encoder.fingerprint())
    return write_pending(store, score_texts(pending, encoder, reference, model))


def write_pending(store: PostingStore, scores: DataFrame) -> Row:
    """Append (url, score) to the store. Staged first, so the encoder runs once for the count and the write."""
    scores = stage(scores, "scores")
    return Row(pending_count=scores.count(), scored_count=store.write_scores(scores))


def batch_scorer(encoder: Encoder, reference: DataFrame, model_path: str) -> Callable[[PostingStore, str], Row]:
    """Scores what a batch of the store left pending, by its key; nothing pending needs no model."""

    def score(store: PostingStore, batch_key: str) -> Row:
        pending = stage(store.pending_of(batch_key), "pending")
        if pending.isEmpty():
            return Row(pending_count=0, scored_count=0)
        model = load_model(store.spark, model_path, encoder.fingerprint())
        return write_pending(store, score_texts(pending, encoder, reference, model))

    return score
