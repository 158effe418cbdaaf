"""Incremental ingest: every micro-batch goes through the same upsert as a batch run.

The state is the postings table itself, so no stateful operator and no watermark is needed; a late
file is an ordinary upsert in order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from roleweave.functions.classify import RelevanceRules
from roleweave.operators.writeback import latest_status
from roleweave.sources.feeds import board_postings, board_rejects, payload_rows, route
from roleweave.sources.store import PostingStore


def _run(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upserts(
    stream: DataFrame,
    store: PostingStore,
    source: str,
    checkpoint: str,
    rules: RelevanceRules | None = None,
    clock: Callable[[DataFrame], datetime | Column] | None = None,
    after: Callable[[], object] | None = None,
    scorer: Callable[[PostingStore, str], object] | None = None,
) -> StreamingQuery:
    """Upsert everything that has landed, then stop. One run-log row per micro-batch.

    A micro-batch replayed after a failure is recognized by its id and not applied again. Once it is stored, `scorer`
    scores it by its key: the batch's own URLs are looked at, not the table (`plans.scoring.batch_scorer`). What a replay
    finds scored already it leaves. `after` runs last.
    """
    return _run(stream, _upserting(store, source, checkpoint, rules, clock, after, scorer, lambda batch: batch), checkpoint)


def _upserting(store, source, checkpoint, rules, clock, after, scorer, postings, rejects=None):
    chosen = rules or RelevanceRules()

    def apply(batch: DataFrame, batch_id: int) -> None:
        key = f"{source}:{checkpoint}:{batch_id}"
        started = datetime.now(timezone.utc)
        if not store.has_batch(key):
            try:
                if rejects is not None:
                    store.record_rejects(rejects(batch), source, started, key)
                store.upsert(postings(batch), chosen, clock(batch) if clock else started, key, run=(source, started))
            except Exception as exc:
                store.record_run(source, started, datetime.now(timezone.utc), error=str(exc))
                raise
        if scorer is not None:
            scorer(store, key)
        if after is not None:
            after()

    return apply


def landed_boards(companies: DataFrame, path: str, source: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of (board, company_name, payload, landed) from board files that land as `<path>/<board>/<file>.json`.

    Files are read whole as they come, and each is joined with the company list, a static table, to the companies that
    publish on this board type; files of other boards are dropped there.
    """
    reader = companies.sparkSession.readStream.schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return route(companies, payload_rows(reader.format("text").load(path)), source)


def stream_boards(
    companies: DataFrame,
    path: str,
    store: PostingStore,
    source: str,
    checkpoint: str,
    rules: RelevanceRules | None = None,
    clock: Callable[[DataFrame], datetime | Column] | None = None,
    files_per_batch: int | None = None,
    scorer: Callable[[PostingStore, str], object] | None = None,
) -> StreamingQuery:
    """Raw board files that have landed, normalized and upserted by micro-batch, then stop.

    Payloads that are dropped as malformed go to the table of rejects under the batch's key, so a replay replaces them and
    changes no posting. Within a micro-batch files arrive in the order of their paths.
    """
    stream = landed_boards(companies, path, source, files_per_batch)
    steps = (lambda batch: board_postings(batch, source), lambda batch: board_rejects(batch, source))
    return _run(stream, _upserting(store, source, checkpoint, rules, clock, None, scorer, *steps), checkpoint)


def stream_statuses(stream: DataFrame, store: PostingStore, checkpoint: str) -> StreamingQuery:
    """Apply status changes (url, status, changed_at); the newest one of a URL wins, also when an older one comes late.

    Replays change nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.write_statuses(latest_status(batch))

    return _run(stream, apply, checkpoint)
