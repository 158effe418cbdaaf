"""Ingest landed feeds into the store."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.operators.triage import missing_description
from roleweave.operators.writeback import latest_status, recompute_relevance, recompute_remote
from roleweave.session import stage
from roleweave.sources.feeds import (
    BOARDS,
    SearchSettings,
    aggregator_postings,
    board_postings,
    board_rejects,
    planned_rows,
    route,
    workday_postings,
    workday_rejects,
)
from roleweave.sources.store import PostingStore
from roleweave.vocabulary import SOURCES, STATUSES


def normalized(
    source: str,
    landed: dict[str, DataFrame],
    search: SearchSettings | None = None,
    run_at: datetime | None = None,
) -> DataFrame:
    """Normalized postings of one source.

    `landed` holds `payloads` and `companies` for board feeds, `pages`, `details` and `companies` for
    paged listings, `rows` for the aggregator. With `search`, aggregator rows are held to the search
    plan: its terms, places and sites, the look-back before `run_at`, and the cap per query.
    """
    if source not in SOURCES:
        raise ValueError(f"unsupported source: {source!r}")
    if source in BOARDS:
        return board_postings(route(landed["companies"], landed["payloads"], source), source)
    if source == "workday":
        return workday_postings(_company_pages(landed), landed["details"])
    rows = landed["rows"]
    if search is not None:
        rows = planned_rows(rows, search, run_at or datetime.now(timezone.utc))
    return aggregator_postings(rows)


def ingest(
    store: PostingStore,
    source: str,
    landed: dict[str, DataFrame],
    rules: RelevanceRules | None = None,
    now: datetime | None = None,
    batch_key: str | None = None,
    search: SearchSettings | None = None,
) -> Row:
    """Normalize, classify and upsert one batch, and log the run; a failed run is logged and raised.

    Payloads dropped as malformed are appended to `store.rejects()`. A batch key that is known changes nothing
    and isn't logged again.
    """
    if source not in SOURCES:
        raise ValueError(f"unsupported source: {source!r}")
    started = datetime.now(timezone.utc)
    known = batch_key is not None and store.has_batch(batch_key)
    try:
        stats = store.upsert(normalized(source, landed, search, now), rules or RelevanceRules(), now, batch_key, run=(source, started))
        if not known:
            dropped = rejected(source, landed)
            if dropped is not None:
                store.record_rejects(dropped, source, started, batch_key)
    except Exception as exc:
        store.record_run(source, started, datetime.now(timezone.utc), error=str(exc))
        raise
    return stats


def rejected(source: str, landed: dict[str, DataFrame]) -> DataFrame | None:
    """(company_name, landed) of what `normalized` drops as malformed; none for sources that drop nothing."""
    if source in BOARDS:
        return board_rejects(route(landed["companies"], landed["payloads"], source), source)
    if source == "workday":
        return workday_rejects(_company_pages(landed), landed["details"]).select(
            "company_name", F.concat_ws("/", F.nullif("run", F.lit("")), "tenant").alias("landed")
        )
    return None


def _company_pages(landed: dict[str, DataFrame]) -> DataFrame:
    companies = landed["companies"].filter(F.col("ats_type") == "workday")
    return landed["pages"].join(companies.select("company_name", "tenant", "site", "wd_subdomain"), "tenant")


def backfill_descriptions(store: PostingStore, fetched: DataFrame) -> Row:
    """Fill missing LinkedIn descriptions from landed (url, description) rows.

    Returns attempted_count (postings that lack one) and updated_count (filled).
    """
    wanted = missing_description(store.read())
    usable = fetched.filter("description <> ''").dropDuplicates(["url"])
    changes = stage(wanted.join(usable, "url"), "descriptions")
    counts = Row(attempted_count=wanted.count(), updated_count=changes.count())
    store.write_descriptions(changes)
    return counts


def backfill_relevance(store: PostingStore, rules: RelevanceRules | None = None) -> int:
    """Recompute the relevance of every stored posting; returns how many there are."""
    store.rewrite(lambda df: recompute_relevance(df, rules or RelevanceRules()))
    return store.read().count()


def backfill_remote(store: PostingStore) -> int:
    """Recompute the remote flag of every stored posting; returns how many there are."""
    store.rewrite(recompute_remote)
    return store.read().count()


def set_status(store: PostingStore, url: str, status: str, at: datetime | None = None) -> None:
    """Set the application status of one posting; an unknown URL changes nothing."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {', '.join(STATUSES)}")
    event = [(url, status, at or datetime.now(timezone.utc))]
    events = store.spark.createDataFrame(event, "url string, status string, changed_at timestamp")
    store.write_statuses(latest_status(events))
