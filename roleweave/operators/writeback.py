"""Updates of stored postings by URL, and recomputation of derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules, relevance, remote_flag
from roleweave.vocabulary import STATUSES


def write_scores(snapshot: DataFrame, scores: DataFrame) -> DataFrame:
    """Set `score` from (url, score); URLs that are not stored are ignored. One row per URL expected."""
    new = scores.select("url", F.col("score").alias("_score"))
    return (
        snapshot.join(new, "url", "left")
        .withColumn("score", F.coalesce("_score", "score"))
        .select(*snapshot.columns)
    )


def write_descriptions(snapshot: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Set `description` from (url, description); null and empty texts are ignored."""
    new = descriptions.filter("description <> ''").select("url", F.col("description").alias("_description"))
    return (
        snapshot.join(new, "url", "left")
        .withColumn("description", F.coalesce("_description", "description"))
        .select(*snapshot.columns)
    )


def rows_updated(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """How many stored rows a write by URL touches."""
    return snapshot.join(changes.select("url"), "url", "left_semi").agg(F.count(F.lit(1)).alias("updated_count"))


def split_status_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected status changes."""
    valid = F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    return events.filter(valid), events.filter(~valid)


def latest_status(events: DataFrame, order: str = "changed_at") -> DataFrame:
    """Last valid change per URL. A mergeable aggregate, so a busy URL is reduced before the shuffle."""
    valid, _ = split_status_events(events)
    return valid.groupBy("url").agg(F.max_by("status", order).alias("status"), F.max(order).alias("changed_at"))


def apply_status(snapshot: DataFrame, last: DataFrame) -> DataFrame:
    """Set the application status from the outcome of `latest_status` and stamp its time.

    A change that is older than the stored one has come late and changes nothing.
    """
    stored = F.col("application_status_updated_at")
    newer = F.col("status").isNotNull() & (stored.isNull() | F.col("changed_at").isNull() | (F.col("changed_at") >= stored))
    return (
        snapshot.join(last.select("url", "status", "changed_at"), "url", "left")
        .withColumn("application_status", F.when(newer, F.col("status")).otherwise(F.col("application_status")))
        .withColumn("application_status_updated_at", F.when(newer, F.coalesce("changed_at", stored)).otherwise(stored))
        .select(*snapshot.columns)
    )


def recompute_relevance(snapshot: DataFrame, rules: RelevanceRules) -> DataFrame:
    """Relevance of every stored row under the given rules."""
    return snapshot.withColumn("is_relevant", relevance(rules, F.col("title"), F.col("description")))


def recompute_remote(snapshot: DataFrame) -> DataFrame:
    """Remote flag of every stored row from its location and its stored extras.

    Stored extras stay those of the first sighting, so this may differ from the flag the last
    upsert set.
    """
    return snapshot.withColumn("is_remote", remote_flag(F.col("location"), F.col("extra_json")))
