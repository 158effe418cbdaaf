"""Queries over the shared test tables, one or more per operator; `oracle` holds the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.functions.text import (
    html_to_text,
    iso_date,
    labelled_paragraphs,
    millis_date,
    slug_candidates,
    split_sections,
    strip_front_matter,
    url_last_segment,
)
from roleweave.operators import boards, duplicates, tokens, triage, upsert, writeback
from roleweave.operators.correlation import column_stats, comparison, residuals, spearman, zero_shot
from roleweave.operators.encoding import HashingEncoder
from roleweave.operators.similarity import feature_vector, fit_features, mean_vectors, top_section_sims
from roleweave.plans import adapters, training
from roleweave.plans.scoring import build_features, score_texts, write_pending
from roleweave.schemas import SNAPSHOT, conform
from roleweave.session import scratch_path, stage
from roleweave.sources import feeds
from roleweave.sources.store import PostingStore
from roleweave.sources.training_files import skipped_rows, training_rows
from roleweave.streaming.ingest import stream_boards, stream_upserts

# Batch times as text: read and shown in the same session zone.
FIRST_NOW = "2024-01-16 00:00:00"
SECOND_NOW = "2024-02-01 00:00:00"
SEARCH_WORDS = ("tion", "the", "que", "der")
PARAGRAPH_LABELS = "the|and|en|de|la"


def _int(name: str):
    return F.col(name).cast("int").alias(name)


# ---------------------------------------------------------------- triage


def triage_default(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage(adapters.document_postings(spark, folder))


def triage_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage(
        adapters.document_postings(spark, folder),
        companies=["en", "fr"],
        sources=["jobspy:indeed", "src0", "src3", "src4", "jobspy:LinkedIn/src11"],
        remote="remote",
    )


def triage_score_range(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage(adapters.document_postings(spark, folder), min_score=0, max_score=50)


def triage_keyword(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage(adapters.document_postings(spark, folder), keyword="tHoN", include_all=True, status="new")


def triage_status_all(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage(adapters.document_postings(spark, folder), include_all=True, status="all", remote="onsite")


def triage_next(spark: SparkSession, folder: str) -> DataFrame:
    return triage.triage_with_next(adapters.document_postings(spark, folder), status="all").select("id", "score", "next_id")


def triage_display(spark: SparkSession, folder: str) -> DataFrame:
    return triage.display(adapters.document_postings(spark, folder)).select("id", "score_text", "posted_text")


def filter_options(spark: SparkSession, folder: str) -> DataFrame:
    return triage.filter_options(adapters.document_postings(spark, folder))


def posting_detail(spark: SparkSession, folder: str) -> DataFrame:
    return triage.detail(adapters.document_postings(spark, folder), 42)


def new_since(spark: SparkSession, folder: str) -> DataFrame:
    return triage.new_since(adapters.document_postings(spark, folder), date(2024, 1, 15))


def pending_score(spark: SparkSession, folder: str) -> DataFrame:
    return triage.pending_score(adapters.document_postings(spark, folder))


def missing_description(spark: SparkSession, folder: str) -> DataFrame:
    return triage.missing_description(adapters.document_postings(spark, folder))


def backlog_count(spark: SparkSession, folder: str) -> DataFrame:
    return triage.backlog_count(adapters.document_postings(spark, folder))


def aggregator_companies(spark: SparkSession, folder: str) -> DataFrame:
    return triage.aggregator_companies(adapters.document_postings(spark, folder))


def failed_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = adapters.table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.col("props")).alias("error")
    )
    return triage.failed_runs(runs)


# ---------------------------------------------------------------- classification and text


def relevance_flag(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.document_postings(spark, folder).select("id", _int("is_relevant"))


def relevance_default_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = writeback.recompute_relevance(adapters.document_postings(spark, folder), RelevanceRules())
    return rows.select("id", _int("is_relevant"))


def relevance_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = writeback.recompute_relevance(adapters.document_postings(spark, folder), adapters.PROSE_RULES)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("postings"), F.count_if(F.col("is_relevant")).alias("relevant")
    )


def remote_flag(spark: SparkSession, folder: str) -> DataFrame:
    return writeback.recompute_remote(adapters.document_postings(spark, folder)).select("id", "is_remote")


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.table(spark, folder, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


def date_from_iso(spark: SparkSession, folder: str) -> DataFrame:
    late = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    broken = F.when(F.col("event_type") == "error", F.col("props")).otherwise(late)
    return adapters.table(spark, folder, "events").select("event_id", iso_date(broken).alias("posted_date"))


def date_from_millis(spark: SparkSession, folder: str) -> DataFrame:
    millis = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.unix_millis(F.col("ts").cast("timestamp")))
    return adapters.table(spark, folder, "events").select("event_id", millis_date(millis).alias("posted_date"))


def url_segment(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.table(spark, folder, "pages").select("page_id", url_last_segment(F.col("url")).alias("segment"))


def slugs(spark: SparkSession, folder: str) -> DataFrame:
    named = F.concat(F.col("title"), F.lit(" & Co., Inc."))
    return adapters.page_titles(spark, folder).select(
        "page_id", F.array_join(slug_candidates(named), "|").alias("slugs")
    )


def section_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = split_sections(F.regexp_replace("text", "\n", "\n## "))
    return adapters.table(spark, folder, "documents").select(
        "doc_id",
        F.size(parts).alias("sections"),
        F.aggregate(parts, F.lit(0), lambda n, part: n + F.char_length(part)).alias("chars"),
    )


def front_matter(spark: SparkSession, folder: str) -> DataFrame:
    headed = F.concat(F.lit("---\nlang: "), "lang", F.lit("\nsource: "), "source", F.lit("\n---\n\n"), "text")
    return adapters.table(spark, folder, "documents").select("doc_id", strip_front_matter(headed).alias("text"))


def requirement_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    spaced = F.regexp_replace("text", "\n", "\n\n")
    return adapters.table(spark, folder, "documents").select(
        "doc_id", labelled_paragraphs(spaced, PARAGRAPH_LABELS).alias("text")
    )


# ---------------------------------------------------------------- feeds


def feed_greenhouse(spark: SparkSession, folder: str) -> DataFrame:
    routed = feeds.route(adapters.page_companies(spark, folder), adapters.page_payloads(spark, folder), "greenhouse")
    return feeds.board_postings(routed, "greenhouse").drop("arrival")


def feed_lever(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.board_postings(adapters.event_payloads(spark, folder), "lever").drop("arrival")


def feed_ashby(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.board_postings(adapters.document_payloads(spark, folder), "ashby").drop("arrival")


def feed_workday(spark: SparkSession, folder: str) -> DataFrame:
    listing, details = adapters.page_listing(spark, folder)
    return feeds.workday_postings(listing, details).drop("arrival")


def feed_aggregator(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.aggregator_postings(adapters.aggregator_rows(spark, folder)).drop("arrival")


def feed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed payloads of two feeds."""
    routed = feeds.route(adapters.page_companies(spark, folder), adapters.page_payloads(spark, folder), "greenhouse")
    pages = feeds.board_rejects(routed, "greenhouse")
    events = feeds.board_rejects(adapters.event_payloads(spark, folder), "lever")
    return pages.unionByName(events)


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    kept = feeds.listing_pages(adapters.conversation_pages(spark, folder))
    return kept.select(F.col("tenant").alias("conv_id"), F.col("offset").alias("turn"), F.size("_jobs").alias("jobs"))


def search_plan_capped(spark: SparkSession, folder: str) -> DataFrame:
    docs = adapters.table(spark, folder, "documents").withColumn("text", F.lower("text"))
    found = F.array_compact(F.array(*[F.when(F.col("text").contains(w), F.lit(w)) for w in SEARCH_WORDS]))
    landed = docs.select(
        "doc_id",
        F.explode_outer(found).alias("search_term"),
        F.col("lang").alias("search_location"),
        F.col("source").alias("site"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int")).alias("date_posted"),
    )
    plan = feeds.search_plan(spark, SEARCH_WORDS, ("en", "fr", "de"))
    planned = landed.join(plan, ["search_term", "search_location"])
    capped = feeds.capped_results(
        planned, 5, [F.col("date_posted").desc(), F.col("doc_id")], F.lit("2024-01-10").cast("date")
    )
    return capped.select("search_term", "search_location", "site", "doc_id", "result_rank")


# ---------------------------------------------------------------- store


def _snapshot_view(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "id",
        "url",
        "raw_id",
        "source",
        "company",
        "title",
        "location",
        "description",
        "posted_date",
        F.to_date("first_seen_at").alias("first_seen"),
        F.to_date("last_seen_at").alias("last_seen"),
        _int("is_relevant"),
        "extra_json",
        "score",
        "application_status",
        "is_remote",
    )


def _apply(snapshot: DataFrame, batch: DataFrame, now: str, last_id: int) -> DataFrame:
    arrivals = stage(upsert.collapse(batch, adapters.EVENT_RULES), "arrivals")
    ids = upsert.assign_ids(upsert.new_urls(arrivals, snapshot), last_id)
    return upsert.merge(snapshot, arrivals, ids, F.lit(now).cast("timestamp"))


def _event_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot after the first event batch."""
    first, _ = adapters.event_batches(spark, folder)
    return stage(_apply(spark.createDataFrame([], SNAPSHOT), first, FIRST_NOW, 0), "snapshot")


def upsert_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    _, second = adapters.event_batches(spark, folder)
    stored = _event_snapshot(spark, folder)
    last_id = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).first().id
    return _snapshot_view(_apply(stored, second, SECOND_NOW, last_id))


def upsert_run_stats(spark: SparkSession, folder: str) -> DataFrame:
    first, second = adapters.event_batches(spark, folder)
    stored = upsert.collapse(first, adapters.EVENT_RULES).select("url")
    arrivals = stage(upsert.collapse(second, adapters.EVENT_RULES), "arrivals")
    return upsert.run_stats(arrivals, upsert.new_urls(arrivals, stored))


def store_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Both batches through the store."""
    store = PostingStore(spark, scratch_path(spark, "store"))
    for batch, now in zip(adapters.event_batches(spark, folder), (FIRST_NOW, SECOND_NOW)):
        store.upsert(batch, adapters.EVENT_RULES, F.lit(now).cast("timestamp"))
    return _snapshot_view(store.read())


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The event files as a stream, upserted into a store by micro-batch."""
    schema = adapters.table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(folder)
    root = scratch_path(spark, "stream")
    store = PostingStore(spark, f"{root}/store")
    location = F.when(F.col("event_type") == "click", "Remote").when(F.col("event_type") == "purchase", "Hybrid")
    rows = stream.select(
        F.lit("events").alias("source"),
        F.col("event_type").alias("company"),
        F.col("event_type").alias("title"),
        location.alias("location"),
        F.col("props").alias("description"),
        F.concat(F.lit("user://"), F.col("user_id").cast("string")).alias("url"),
        F.to_date("ts").alias("posted_date"),
        F.col("event_id").cast("string").alias("raw_id"),
        F.col("props").alias("extra_json"),
        F.struct("ts", "event_id").alias("arrival"),
    )
    query = stream_upserts(
        rows, store, "events", f"{root}/checkpoint", adapters.EVENT_RULES, clock=lambda batch: F.lit(SECOND_NOW).cast("timestamp")
    )
    query.awaitTermination()
    return _snapshot_view(store.read())


def _board_stream(spark: SparkSession, folder: str) -> PostingStore:
    """Board files landed in three waves, streamed by one query that is started again for each."""
    root = scratch_path(spark, "boards")
    store, companies = PostingStore(spark, f"{root}/store"), stage(adapters.landed_companies(spark, folder), "companies")
    files = stage(adapters.board_files(spark, folder), "board_files")
    for wave in range(3):
        own = files.where(F.col("wave") == wave).select("b", "value")
        own.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("b").text(f"{root}/landing")
        query = stream_boards(
            companies, f"{root}/landing", store, "greenhouse", f"{root}/checkpoint", adapters.PROSE_RULES,
            clock=lambda batch: F.lit(SECOND_NOW).cast("timestamp"),
        )
        query.awaitTermination()
    return store


def stream_board_postings(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("url", "raw_id", "source", "company", "title", "location", "description", "posted_date", "extra_json")
    return _board_stream(spark, folder).read().select(*columns, _int("is_relevant"))


def stream_board_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed files by company."""
    return _board_stream(spark, folder).rejects().groupBy("source", "company_name").agg(F.count("*").alias("files"))


def stream_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Both event batches as a stream whose batches are scored by their own URLs; how many each batch had scored."""
    root = scratch_path(spark, "scored")
    store, scored = PostingStore(spark, f"{root}/store"), []

    def scorer(own: PostingStore, key: str) -> None:
        # Any model will do here: the score is the length of the text.
        pending = own.pending_of(key).select("url", F.length("description").cast("double").alias("score"))
        scored.append((len(scored) + 1, write_pending(own, pending).scored_count))

    for batch in adapters.event_batches(spark, folder):
        batch.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(batch.schema).parquet(f"{root}/landing")
        stream_upserts(stream, store, "events", f"{root}/checkpoint", adapters.EVENT_RULES, scorer=scorer).awaitTermination()
    counts = spark.createDataFrame(scored, "batch int, scored long")
    kept = store.read().where("score is not null").agg(F.count("*").alias("stored"), F.sum("score").cast("long").alias("total"))
    return counts.join(kept, F.lit(True))


def score_writeback(spark: SparkSession, folder: str) -> DataFrame:
    """Hand scores written onto the documents that have one."""
    scores = adapters.table(spark, folder, "labels").select(
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        (F.col("quality") * 100.0).alias("score"),
    )
    return writeback.write_scores(adapters.document_postings(spark, folder), scores).select("id", "score")


def score_writeback_count(spark: SparkSession, folder: str) -> DataFrame:
    scores = adapters.table(spark, folder, "labels").select(
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url")
    )
    return writeback.rows_updated(adapters.document_postings(spark, folder), scores)


def description_writeback(spark: SparkSession, folder: str) -> DataFrame:
    """Missing descriptions filled from a landed feed; empty texts change nothing."""
    postings = adapters.document_postings(spark, folder)
    fetched = adapters.table(spark, folder, "documents").select(
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("lang") == "en", F.col("text")).otherwise(F.lit("")).alias("description"),
    )
    wanted = triage.missing_description(postings)
    return writeback.write_descriptions(postings, wanted.join(fetched, "url")).select("id", "description")


def status_latest(spark: SparkSession, folder: str) -> DataFrame:
    last = writeback.latest_status(adapters.status_events(spark, folder))
    return last.select("url", "status", F.to_date("changed_at").alias("changed_on"))


def status_applied(spark: SparkSession, folder: str) -> DataFrame:
    stored = _event_snapshot(spark, folder)
    changed = writeback.apply_status(stored, writeback.latest_status(adapters.status_events(spark, folder)))
    return changed.select(
        "url", "application_status", F.to_date("application_status_updated_at").alias("changed_on")
    )


def status_validation(spark: SparkSession, folder: str) -> DataFrame:
    valid, rejected = writeback.split_status_events(adapters.status_events(spark, folder))
    both = valid.withColumn("valid", F.lit(1)).unionByName(rejected.withColumn("valid", F.lit(0)))
    return both.groupBy("valid", "status").agg(F.count(F.lit(1)).alias("events"))


def conform_older(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as a table written before scores, statuses and remote flags existed."""
    older = adapters.page_titles(spark, folder).select(F.col("page_id").alias("id"), "url", "title")
    return conform(older).select("id", "url", "title", "score", "application_status", "is_remote")


# ---------------------------------------------------------------- companies and boards


def known_company_anti(spark: SparkSession, folder: str) -> DataFrame:
    names = adapters.table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("  COMPANY "), F.substr("c_name", F.lit(10))).alias("name")
    )
    known = adapters.table(spark, folder, "supplier").select(
        F.concat(F.lit("Company "), F.substr("s_name", F.lit(10)), F.lit(" ")).alias("company_name")
    )
    return boards.unknown_names(names, known).select("c_custkey", "name")


def name_first_dedup(spark: SparkSession, folder: str) -> DataFrame:
    names = adapters.table(spark, folder, "documents").select(
        F.substring_index("text", " ", 2).alias("name"), F.col("doc_id").alias("line_no")
    )
    return boards.first_names(names)


def board_health(spark: SparkSession, folder: str) -> DataFrame:
    checked = boards.health(adapters.fetch_log(spark, folder))
    return checked.select("page_id", "status", boards.health_line().alias("line"))


def board_health_summary(spark: SparkSession, folder: str) -> DataFrame:
    return boards.health_summary(boards.health(adapters.fetch_log(spark, folder)))


def all_boards_healthy(spark: SparkSession, folder: str) -> DataFrame:
    checked = boards.health(adapters.fetch_log(spark, folder))
    return boards.all_healthy(checked).select(_int("all_ok"))


def first_board_hit(spark: SparkSession, folder: str) -> DataFrame:
    probes = adapters.fetch_log(spark, folder).select(
        F.col("company_name").alias("company"), F.col("ats_type"), F.col("page_id").cast("string").alias("slug"), "n_jobs"
    )
    hits = boards.first_hits(probes).withColumn("n_relevant", F.lit(None).cast("bigint"))
    return hits.select(
        "company", "ats_type", "slug", "n_jobs", boards.company_line(date(2024, 2, 1)).alias("line")
    )


def detect_boards(spark: SparkSession, folder: str) -> DataFrame:
    """Boards guessed from page titles, against probe results landed under the same slugs."""
    pages = adapters.page_titles(spark, folder)
    log = adapters.fetch_log(spark, folder).select("page_id", "ats_type", "n_jobs")
    landed = pages.join(log, "page_id").select(
        "ats_type", F.lower(F.regexp_replace("title", "[^A-Za-z0-9]", "")).alias("slug"), "n_jobs"
    )
    landed = landed.groupBy("ats_type", "slug").agg(F.max("n_jobs").alias("n_jobs"))
    names = pages.select(F.col("title").alias("name")).distinct()
    return boards.detect_boards(names, landed)


def cross_source_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = duplicates.cross_source_groups(adapters.sighted_postings(spark, folder))
    return groups.select("id", "group_id", _int("survives"))


def relevant_titles(spark: SparkSession, folder: str) -> DataFrame:
    jobs = adapters.document_postings(spark, folder)
    return boards.relevant_title_counts(jobs, adapters.PROSE_RULES, "source", "company")


# ---------------------------------------------------------------- similarity, ranks, statistics


def section_similarity(spark: SparkSession, folder: str) -> DataFrame:
    vectors, sections, _ = adapters.vector_profile(spark, folder)
    best = top_section_sims(vectors, sections).select("vec_id", F.posexplode("top_sims").alias("place", "s"))
    return best.select("vec_id", "place", "s.section", F.round("s.sim", 6).alias("sim"))


def _fits(spark: SparkSession, folder: str) -> DataFrame:
    return fit_features(*adapters.vector_profile(spark, folder))


def fits(spark: SparkSession, folder: str) -> DataFrame:
    return _fits(spark, folder).select(
        "vec_id",
        F.round("fit_max", 6).alias("fit_max"),
        F.round("fit_top3", 6).alias("fit_top3"),
        F.round("resume_cos", 6).alias("resume_cos"),
    )


def spearman_zero_shot(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("fit_max", "fit_top3", "resume_cos")
    # Rounded, so that sums in another order cannot make or break a tie.
    rounded = _fits(spark, folder).select("vec_id", "label", *[F.round(c, 9).alias(c) for c in columns])
    result = zero_shot(rounded, "label", "vec_id", columns)
    return result.select("feature", F.round("spearman", 6).alias("spearman"))


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of length and title length per language and hand label, as a pivot."""
    postings = adapters.document_postings(spark, folder).select(
        F.col("id").alias("doc_id"), F.col("company").alias("model"),
        F.char_length("title").alias("title_chars"), F.char_length("description").alias("chars"),
    )
    labels = adapters.table(spark, folder, "labels").select(
        "doc_id", F.concat(F.lit("quality_"), F.col("quality").cast("string")).alias("family")
    )
    by_group = spearman(postings.join(labels, "doc_id"), "chars", "title_chars", "doc_id", ("model", "family"))
    rounded = by_group.withColumn("spearman", F.round("spearman", 6))
    table = comparison(rounded, ("quality_0", "quality_1"))
    # NaN has no SQL twin on every engine; show gaps as null.
    return table.select("model", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("quality_0", "quality_1")])


def residual_table(spark: SparkSession, folder: str) -> DataFrame:
    predicted = adapters.document_postings(spark, folder).filter("score is not null").select(
        "id", "score", F.char_length("title").cast("double").alias("prediction")
    )
    return residuals(predicted)


def population_scaler(spark: SparkSession, folder: str) -> DataFrame:
    stats = column_stats(adapters.table(spark, folder, "embeddings"), "embedding")
    return stats.select("dim", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


def _hand_scores(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    labels = adapters.table(spark, folder, "labels")
    scores = labels.select(F.col("doc_id").cast("string").alias("name"), (F.col("quality") * 100.0).alias("score"))
    return scores, adapters.document_postings(spark, folder).select(F.col("id").cast("string").alias("name"), "description")


def training_join(spark: SparkSession, folder: str) -> DataFrame:
    return training_rows(*_hand_scores(spark, folder))


def training_skipped(spark: SparkSession, folder: str) -> DataFrame:
    return skipped_rows(*_hand_scores(spark, folder)).select("name", "score")


def _words(spark: SparkSession, folder: str) -> DataFrame:
    texts = adapters.dealt_out(adapters.table(spark, folder, "documents").select("doc_id", "text"))
    return texts.select("doc_id", tokens.tokens(F.col("text")).alias("tokens"))


def corpus_abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    """Abbreviations that the full stops of the documents show."""
    found = tokens.learnt_abbreviations(adapters.table(spark, folder, "documents"), "text")
    return found.select("word", "with_stop", "without_stop", F.round("score", 6).alias("score"))


def document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.document_frequency(_words(spark, folder), "tokens")


def bow_top_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Words and word pairs between the bounds, the most frequent thousand."""
    docs = _words(spark, folder).select("doc_id", tokens.ngrams(F.col("tokens"), 2).alias("terms"))
    top = tokens.vocabulary(docs, "terms", min_df=2, max_df=0.8, max_features=1000)
    return top.select("term", "df", F.round("idf", 6).alias("idf"))


# ---------------------------------------------------------------- models


def _vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _fits(spark, folder).select(
        "vec_id", (F.col("label") * 10.0).alias("score"), feature_vector().alias("features")
    )


def _cv(regressor: str, count: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Trees take a fit of 200 iterations for three candidates; those of more trees are left to `tune`.
        candidates = training.boosted_trials(count, iterations=(100, 150, 200)) if regressor == "gbt" else training.trials(regressor, count)
        rows = _vector_rows(spark, folder)
        result = training.cross_validate(rows, "vec_id", regressor, candidates, scale_before_split=True)
        return result.select("trial", F.round("spearman", 6).alias("spearman"))

    return run


def bow_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Bags of words of the hand-labelled documents, vocabularies of each fold's training rows, thirty trials of ridge."""
    labels = adapters.table(spark, folder, "labels").select("doc_id", (F.col("quality") * 100.0).alias("score"))
    texts = adapters.dealt_out(adapters.table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id"))
    rows = texts.select("doc_id", "score", tokens.tokens(F.col("text")).alias("tokens")).filter(F.size("tokens") > 0)
    result = training.cross_validate(rows, "doc_id", "ridge", training.bow_trials("ridge", 30), training.bow_preprocessor)
    return result.select("trial", F.round("spearman", 6).alias("spearman"))


def score_pending(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the hand-labelled documents, then score every relevant one that has no label."""
    postings = adapters.document_postings(spark, folder)
    labels = adapters.table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    labelled = postings.join(labels, "id").select("url", "description", (F.col("quality") * 100.0).alias("score"))
    encoder = HashingEncoder(dims=128)
    benchmark = adapters.table(spark, folder, "benchmark").select(
        F.lit("section").alias("kind"), F.col("item_id").alias("position"), "text"
    )
    embedded = encoder.encode(benchmark, "text", "vector").select("kind", "position", "vector")
    resume = mean_vectors(embedded, "vector").select(
        F.lit("resume").alias("kind"), F.lit(0).cast("long").alias("position"), F.col("vector").cast("array<float>").alias("vector")
    )
    reference = stage(embedded.unionByName(resume), "reference")
    rows = stage(build_features(labelled, encoder, reference).select("url", "score", "features"), "labelled")
    model = training.fit("ridge", {"alpha": 10.0}, rows, training.embedding_preprocessor)
    unlabelled = postings.join(labels.select("id"), "id", "left_anti").withColumn("score", F.lit(None).cast("double"))
    scores = score_texts(triage.pending_score(unlabelled), encoder, reference, model)
    return scores.select("url", F.round("score", 6).alias("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "triage_default": triage_default,
    "triage_filtered": triage_filtered,
    "triage_score_range": triage_score_range,
    "triage_keyword": triage_keyword,
    "triage_status_all": triage_status_all,
    "triage_next": triage_next,
    "triage_display": triage_display,
    "filter_options": filter_options,
    "posting_detail": posting_detail,
    "new_since": new_since,
    "pending_score": pending_score,
    "missing_description": missing_description,
    "backlog_count": backlog_count,
    "aggregator_companies": aggregator_companies,
    "failed_runs": failed_runs,
    "relevance_flag": relevance_flag,
    "relevance_default_rules": relevance_default_rules,
    "relevance_counts": relevance_counts,
    "remote_flag": remote_flag,
    "html_text": html_text,
    "date_from_iso": date_from_iso,
    "date_from_millis": date_from_millis,
    "url_last_segment": url_segment,
    "slug_candidates": slugs,
    "section_split": section_split,
    "front_matter": front_matter,
    "requirement_paragraphs": requirement_paragraphs,
    "feed_greenhouse": feed_greenhouse,
    "feed_lever": feed_lever,
    "feed_ashby": feed_ashby,
    "feed_workday": feed_workday,
    "feed_aggregator": feed_aggregator,
    "feed_rejects": feed_rejects,
    "listing_pages": listing_pages,
    "search_plan_capped": search_plan_capped,
    "upsert_snapshot": upsert_snapshot,
    "upsert_run_stats": upsert_run_stats,
    "store_round_trip": store_round_trip,
    "stream_ingest": stream_ingest,
    "stream_board_postings": stream_board_postings,
    "stream_board_rejects": stream_board_rejects,
    "stream_scored": stream_scored,
    "score_writeback": score_writeback,
    "score_writeback_count": score_writeback_count,
    "description_writeback": description_writeback,
    "status_latest": status_latest,
    "status_applied": status_applied,
    "status_validation": status_validation,
    "conform_older": conform_older,
    "known_company_anti": known_company_anti,
    "name_first_dedup": name_first_dedup,
    "board_health": board_health,
    "board_health_summary": board_health_summary,
    "all_boards_healthy": all_boards_healthy,
    "first_board_hit": first_board_hit,
    "detect_boards": detect_boards,
    "relevant_titles": relevant_titles,
    "cross_source_duplicates": cross_source_duplicates,
    "section_similarity": section_similarity,
    "fit_features": fits,
    "spearman_zero_shot": spearman_zero_shot,
    "model_comparison": model_comparison,
    "residual_table": residual_table,
    "population_scaler": population_scaler,
    "training_join": training_join,
    "training_skipped": training_skipped,
    "corpus_abbreviations": corpus_abbreviations,
    "document_frequency": document_frequency,
    "bow_top_terms": bow_top_terms,
    "ridge_cv": _cv("ridge", 30),
    "elastic_cv": _cv("elasticnet", 30),
    "gbt_cv": _cv("gbt", 3),
    "bow_cv": bow_cv,
    "score_pending": score_pending,
}
