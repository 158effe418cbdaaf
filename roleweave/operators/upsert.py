"""Keyed upsert of a batch of postings, with the outcome of a row-by-row upsert.

Inside a batch the first occurrence of a URL sets the write-once columns and the last one sets the
columns that follow the feed. Both are mergeable aggregates, so a URL that fills a third of the
batch (the empty URL is a legal key) is reduced on the map side before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules, relevance, remote_flag
from roleweave.functions.text import is_empty_description
from roleweave.operators.ordering import with_position
from roleweave.schemas import REQUIRED, SNAPSHOT_COLUMNS, conform

# Set by the first sighting of a URL and kept from then on.
ONCE = ("raw_id", "source", "company", "posted_date", "extra_json")


def collapse(batch: DataFrame, rules: RelevanceRules, arrival: str = "arrival") -> DataFrame:
    """One row per URL: `once`, `latest`, first arrival, occurrences, and rows that break a rule."""
    order = F.col(arrival)
    broken = F.lit(False)
    for name in REQUIRED:
        broken = broken | F.col(name).isNull()
    latest = F.struct("title", "description", "location", F.col("_remote").alias("is_remote"))
    out = (
        batch.withColumn("_remote", remote_flag(F.col("location"), F.col("extra_json")))
        .groupBy("url")
        .agg(
            F.min_by(F.struct(*ONCE), order).alias("once"),
            F.max_by(latest, order).alias("latest"),
            F.min(order).alias("first_arrival"),
            F.count(F.lit(1)).alias("occurrences"),
            F.count_if(broken).alias("broken"),
        )
    )
    # The flag depends on the last occurrence only, so the patterns run once per URL.
    flag = relevance(rules, F.col("latest.title"), F.col("latest.description"))
    return out.withColumn("is_relevant", flag)


def assign_ids(fresh: DataFrame, after: int, staged: bool = False) -> DataFrame:
    """(url, new_id) for new URLs: consecutive ids in order of first arrival, starting past `after`."""
    order = [F.col("first_arrival"), F.col("url")]
    numbered = with_position(fresh.select("url", "first_arrival"), order, staged=staged)
    return numbered.select("url", (F.col("position") + F.lit(after)).alias("new_id"))


def updated_rows(
    snapshot: DataFrame, arrivals: DataFrame, now: Column, keep_filled_descriptions: bool = False
) -> DataFrame:
    """Stored rows after the batch. Both sides hold each URL once, so no join key is hot.

    Scores and application status survive, even when the description under a score changes. An empty
    description replaces a filled one unless `keep_filled_descriptions` is set. Broadcast `arrivals`
    when it is small and the snapshot is not shuffled at all.
    """
    new = arrivals.select("url", "latest", F.col("is_relevant").alias("_relevant"), F.lit(True).alias("_seen"))
    seen = F.col("_seen").isNotNull()
    text = F.col("latest.description")
    if keep_filled_descriptions:
        text = F.when(is_empty_description(text), F.col("description")).otherwise(text)
    following = {
        "title": F.col("latest.title"),
        "description": text,
        "location": F.col("latest.location"),
        "is_remote": F.col("latest.is_remote"),
        "is_relevant": F.col("_relevant"),
        "last_seen_at": now,
    }
    changed = {name: F.when(seen, value).otherwise(F.col(name)) for name, value in following.items()}
    return snapshot.join(new, "url", "left").withColumns(changed).select(*SNAPSHOT_COLUMNS)


def added_rows(arrivals: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Rows of URLs seen for the first time."""
    columns = {
        "id": F.col("new_id"),
        **{name: F.col(f"once.{name}") for name in ONCE},
        **{name: F.col(f"latest.{name}") for name in ("title", "description", "location", "is_remote")},
        "first_seen_at": now,
        "last_seen_at": now,
        "application_status": F.lit("new"),
    }
    return conform(arrivals.join(ids, "url").withColumns(columns))


def merge(
    snapshot: DataFrame,
    arrivals: DataFrame,
    ids: DataFrame,
    now: Column,
    keep_filled_descriptions: bool = False,
) -> DataFrame:
    """Snapshot after the batch: updated rows and added rows."""
    return updated_rows(snapshot, arrivals, now, keep_filled_descriptions).unionByName(added_rows(arrivals, ids, now))


def new_urls(arrivals: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Arrivals the snapshot does not hold yet; reads only its URL column."""
    return arrivals.join(snapshot.select("url"), "url", "left_anti")


def run_stats(arrivals: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row: rows fetched (duplicates included), URLs new, the rest updated."""
    fetched = arrivals.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("fetched_count"))
    new = fresh.agg(F.count(F.lit(1)).alias("new_count"))
    # Two one-row tables side by side.
    both = fetched.select("fetched_count", F.lit(1).alias("_k")).join(new.withColumn("_k", F.lit(1)), "_k")
    return both.select("fetched_count", "new_count", (F.col("fetched_count") - F.col("new_count")).alias("updated_count"))
