"""Queries over the postings table: triage list, options, details and work lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.functions.text import is_empty_description, lower_ascii
from roleweave.operators.ordering import with_next
from roleweave.vocabulary import REMOTE_FILTERS, STATUS_FILTERS

SUMMARY = ("id", "title", "company", "score", "posted_date", "url", "application_status")
DETAIL = ("id", "title", "company", "source", "description", "score", "posted_date", "url", "application_status")


def triage_filter(
    postings: DataFrame,
    *,
    include_all: bool = False,
    status: str | None = None,
    companies: Sequence[str] | None = None,
    sources: Sequence[str] | None = None,
    min_score: float | None = None,
    max_score: float | None = None,
    keyword: str | None = None,
    remote: str | None = None,
) -> DataFrame:
    """Postings a triage view shows.

    By default relevant ones that were not skipped. Empty allow-lists do not filter; a score bound
    (0 included) drops unscored postings; the keyword is a literal piece of the title, ASCII case
    ignored; postings without a remote signal only show when `remote` is not given.
    """
    if status is not None and status not in STATUS_FILTERS:
        raise ValueError(f"status must be one of {', '.join(STATUS_FILTERS)}")
    if remote is not None and remote not in REMOTE_FILTERS:
        raise ValueError(f"remote must be one of {', '.join(REMOTE_FILTERS)}")
    df = postings
    if not include_all:
        df = df.filter(F.col("is_relevant"))
    if status is None:
        df = df.filter(F.col("application_status") != "skip")
    elif status != "all":
        df = df.filter(F.col("application_status") == status)
    if companies:
        df = df.filter(F.col("company").isin(*companies))
    if sources:
        df = df.filter(F.col("source").isin(*sources))
    if min_score is not None:
        df = df.filter(F.col("score") >= float(min_score))
    if max_score is not None:
        df = df.filter(F.col("score") <= float(max_score))
    if keyword:
        df = df.filter(F.contains(lower_ascii(F.col("title")), lower_ascii(F.lit(keyword))))
    if remote is not None:
        df = df.filter(F.col("is_remote") == (1 if remote == "remote" else 0))
    return df


def triage(postings: DataFrame, **filters) -> DataFrame:
    """Filtered summaries, best score first, unscored last, ids breaking ties."""
    chosen = triage_filter(postings, **filters).select(*SUMMARY)
    return chosen.orderBy(F.desc_nulls_last("score"), "id")


def ranking_keys() -> list[Column]:
    """Ascending keys of the triage order."""
    return [F.col("score").isNull(), -F.col("score"), F.col("id")]


def triage_with_next(postings: DataFrame, **filters) -> DataFrame:
    """Filtered summaries with the id of the posting that follows in the list."""
    chosen = triage_filter(postings, **filters).select(*SUMMARY)
    return with_next(chosen, ranking_keys(), "id", "next_id")


def next_after(postings: DataFrame, posting_id: int, **filters) -> DataFrame:
    """(next_id) of one posting in the filtered list: no row if it is not listed, null at the end.

    One pass with a map-side reducible minimum instead of a ranking of the whole list.
    """
    chosen = triage_filter(postings, **filters).select("id", "score")
    key = F.struct(*ranking_keys())
    here = chosen.filter(F.col("id") == posting_id).select(F.lit(1).alias("_k"), key.alias("_here"))
    rest = chosen.select("id", key.alias("_key"), F.lit(1).alias("_k"))
    # `here` is one row at most: ids are unique.
    after = rest.join(F.broadcast(here), "_k").filter(F.col("_key") >= F.col("_here"))
    return after.groupBy("_k").agg(
        F.min_by("id", F.when(F.col("_key") > F.col("_here"), F.col("_key"))).alias("next_id")
    ).select("next_id")


def filter_options(postings: DataFrame) -> DataFrame:
    """(kind, value): distinct companies and sources over all rows, each sorted."""
    pairs = F.explode(
        F.array(
            F.struct(F.lit("company").alias("kind"), F.col("company").alias("value")),
            F.struct(F.lit("source").alias("kind"), F.col("source").alias("value")),
        )
    )
    # One scan and one shuffle for both lists.
    return postings.select(pairs.alias("o")).select("o.*").distinct().orderBy("kind", "value")


def detail(postings: DataFrame, posting_id: int) -> DataFrame:
    """One posting in full; no row when the id is unknown."""
    return postings.filter(F.col("id") == posting_id).select(*DETAIL)


def display(postings: DataFrame) -> DataFrame:
    """Score and date as the list shows them; a dash for nothing."""
    score = F.when(F.col("score").isNull(), F.lit("—")).otherwise(F.format_string("%.1f", F.col("score")))
    return postings.withColumn("score_text", score).withColumn(
        "posted_text", F.coalesce(F.col("posted_date").cast("string"), F.lit("—"))
    )


def pending_score(postings: DataFrame) -> DataFrame:
    """(url, description) of relevant postings with a text and no score."""
    return postings.filter(
        F.col("score").isNull() & F.col("is_relevant") & ~is_empty_description(F.col("description"))
    ).select("url", "description")


def _from_linkedin() -> Column:
    return lower_ascii(F.col("source")).startswith("jobspy:linkedin")


def missing_description(postings: DataFrame) -> DataFrame:
    """(url) of relevant LinkedIn postings without a description."""
    return postings.filter(
        F.col("is_relevant") & _from_linkedin() & is_empty_description(F.col("description"))
    ).select("url")


def new_since(postings: DataFrame, as_of: date | None = None, days: int = 1) -> DataFrame:
    """(company, title, url) of relevant postings first seen since `days` before the date."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return postings.filter(F.col("is_relevant") & (F.col("first_seen_at") >= F.date_sub(day, days))).select(
        "company", "title", "url"
    )


def backlog_count(postings: DataFrame) -> DataFrame:
    """Relevant LinkedIn postings still unscored."""
    return postings.filter(F.col("is_relevant") & F.col("score").isNull() & _from_linkedin()).agg(
        F.count(F.lit(1)).alias("n")
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that ended with an error."""
    return runs.filter(F.col("error").isNotNull())


def aggregator_companies(postings: DataFrame) -> DataFrame:
    """Distinct companies of aggregator rows, sorted."""
    return (
        postings.filter(lower_ascii(F.col("source")).startswith("jobspy")).select("company").distinct().orderBy("company")
    )
