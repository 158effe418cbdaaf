"""Landed feed payloads to normalized postings.

A landed payload is one row: the raw JSON text of one board, the company it belongs to, and a
`landed` key that orders payloads within a batch. Payloads are parsed as VARIANT, which keeps a
missing key, an explicit null and a wrong type apart: a malformed job rejects its whole payload,
and since the payload is still one row there, that is a filter and not a join.

Every reader returns postings with the columns of `schemas.POSTING` plus `arrival`, the order of
rows within the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from roleweave.functions.text import (
    first_filled,
    html_to_text,
    iso_date,
    joined_or_null,
    millis_date,
    plain_iso_date,
    text_or,
)
from roleweave.schemas import AGGREGATOR, POSTING_COLUMNS
from roleweave.session import stage
from roleweave.vocabulary import (
    HOURS_OLD,
    LISTING_PAGE_SIZE,
    RESULTS_WANTED,
    SEARCH_LOCATIONS,
    SEARCH_SITES,
    SEARCH_TERMS,
)

# ---------------------------------------------------------------- VARIANT helpers


def _at(value: Column, key: str) -> Column:
    """Member of an object; SQL null only when the key is missing."""
    return F.try_variant_get(value, f"$.{key}", "variant")


def _text(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$.{key}", "string")


def _text_or_empty(value: Column, key: str) -> Column:
    """Missing key gives an empty string; an explicit null stays null."""
    return F.when(_at(value, key).isNull(), F.lit("")).otherwise(_text(value, key))


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _nothing(value: Column) -> Column:
    """Missing, null, false, zero or empty. Writes the value out, so test for a good type first."""
    return value.isNull() | F.to_json(value).isin("null", "false", "0", "0.0", '""', "[]", "{}")


def _items(value: Column) -> Column:
    """Elements of an array; missing and empty give an empty array, anything else null."""
    empty = value.isNull() | F.to_json(value).isin('""', "{}")
    return F.when(_is(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>")).when(
        empty, F.array().cast("array<variant>")
    )


def _all_objects(value: Column) -> Column:
    items = _items(value)
    return items.isNotNull() & F.forall(items, lambda item: _is(item, "OBJECT"))


def _names(value: Column) -> Column:
    return F.transform(_items(value), lambda item: _text(item, "name"))


# ---------------------------------------------------------------- board feeds


@dataclass(frozen=True)
class Board:
    """How one board type lays out its payload."""

    source: str
    jobs: Callable[[Column], Column]  # parsed payload -> array of jobs, null when malformed
    well_formed: Callable[[Column], Column]  # one job
    columns: Callable[[Column], dict[str, Column]]  # one job


def _jobs_member(doc: Column) -> Column:
    return F.when(_is(doc, "OBJECT"), _items(_at(doc, "jobs")))


def _keep_nulls(**members: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in members.items()]), {"ignoreNullFields": "false"})


GREENHOUSE = Board(
    source="greenhouse",
    jobs=_jobs_member,
    well_formed=lambda job: _is(job, "OBJECT")
    & (_is(_at(job, "location"), "OBJECT") | _nothing(_at(job, "location")))
    & (_is(_at(job, "content"), "STRING") | _nothing(_at(job, "content")))
    & (_is(_at(job, "updated_at"), "STRING") | _nothing(_at(job, "updated_at")))
    & _all_objects(_at(job, "departments"))
    & _all_objects(_at(job, "offices")),
    columns=lambda job: {
        "title": _text_or_empty(job, "title"),
        "location": _text(job, "location.name"),
        "description": html_to_text(_text(job, "content")),
        "url": _text_or_empty(job, "absolute_url"),
        "posted_date": iso_date(_text(job, "updated_at")),
        "raw_id": _text(job, "id"),
        "extra_json": _keep_nulls(
            departments=_names(_at(job, "departments")), offices=_names(_at(job, "offices"))
        ),
    },
)

LEVER = Board(
    source="lever",
    jobs=_items,
    well_formed=lambda job: _is(job, "OBJECT")
    & (_is(_at(job, "categories"), "OBJECT") | _nothing(_at(job, "categories"))),
    columns=lambda job: {
        "title": _text_or_empty(job, "text"),
        "location": _text(job, "categories.location"),
        "description": text_or(_text(job, "descriptionPlain")),
        "url": _text_or_empty(job, "hostedUrl"),
        "posted_date": millis_date(F.try_variant_get(job, "$.createdAt", "double")),
        "raw_id": _text(job, "id"),
        "extra_json": F.concat(
            F.lit('{"categories":'),
            F.when(_is(_at(job, "categories"), "OBJECT"), F.to_json(_at(job, "categories"))).otherwise(F.lit("{}")),
            F.lit("}"),
        ),
    },
)

ASHBY = Board(
    source="ashby",
    jobs=_jobs_member,
    well_formed=lambda job: _is(job, "OBJECT")
    & (_is(_at(job, "publishedAt"), "STRING") | _nothing(_at(job, "publishedAt"))),
    columns=lambda job: {
        "title": _text_or_empty(job, "title"),
        "location": _text(job, "location"),
        "description": text_or(_text(job, "descriptionPlain")),
        "url": _text_or_empty(job, "jobUrl"),
        "posted_date": iso_date(_text(job, "publishedAt")),
        "raw_id": _text(job, "id"),
        "extra_json": _keep_nulls(
            department=_text(job, "department"),
            team=_text(job, "team"),
            employmentType=_text(job, "employmentType"),
        ),
    },
)

BOARDS = {board.source: board for board in (GREENHOUSE, LEVER, ASHBY)}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(board, payload, landed) of landed files laid out as `<path>/<board>/<file>.json`."""
    return payload_rows(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True))


def payload_rows(raw: DataFrame) -> DataFrame:
    """(board, payload, landed) of files read whole, streamed or not."""
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(
        F.try_element_at(F.split(file, "/"), F.lit(-2)).alias("board"), F.col("value").alias("payload"), file.alias("landed")
    )


def route(companies: DataFrame, payloads: DataFrame, source: str) -> DataFrame:
    """Payloads of the companies that publish on this board type, with the company name."""
    chosen = companies.filter(F.col("ats_type") == source).select(
        "company_name", F.col("board_identifier").alias("board")
    )
    return payloads.join(chosen, "board")


def _parsed(payloads: DataFrame, board: Board) -> DataFrame:
    """Adds `_jobs`: the jobs of a well-formed payload, else null."""
    # Text that isn't JSON at all is malformed too, whatever a board makes of a missing member.
    found = F.when(F.col("_doc").isNotNull(), board.jobs(F.col("_doc")))
    jobs = payloads.withColumn("_doc", F.try_parse_json("payload")).withColumn("_all", found)
    # A filter over a one-element array binds the jobs to a variable, so they are parsed once.
    sound = F.filter(F.array("_all"), lambda all_jobs: F.forall(all_jobs, board.well_formed))
    return jobs.withColumn("_jobs", F.try_element_at(sound, F.lit(1)))


def board_postings(payloads: DataFrame, source: str) -> DataFrame:
    """Postings of all well-formed payloads (company_name, payload, landed)."""
    board = BOARDS[source]
    # Outer, because the optimizer would test a plain explode for emptiness first and parse twice.
    exploded = _parsed(payloads, board).select(
        "company_name", "landed", F.posexplode_outer("_jobs").alias("_pos", "_job")
    )
    jobs = exploded.filter(F.col("_pos").isNotNull())
    columns = board.columns(F.col("_job"))
    return jobs.select(
        F.lit(source).alias("source"),
        F.col("company_name").alias("company"),
        *[c.alias(name) for name, c in columns.items()],
        F.struct("landed", "_pos").alias("arrival"),
    ).select(*POSTING_COLUMNS, "arrival")


def board_rejects(payloads: DataFrame, source: str) -> DataFrame:
    """(company_name, landed) of payloads that were dropped as malformed."""
    return _parsed(payloads, BOARDS[source]).filter(F.col("_jobs").isNull()).select("company_name", "landed")


# ---------------------------------------------------------------- paged listings with details


def _with_run(landed: DataFrame) -> DataFrame:
    """Landed rows with a `run` key; without one all landings are one run."""
    return landed if "run" in landed.columns else landed.withColumn("run", F.lit("").cast("string"))


def _one_landing(landed: DataFrame, *keys: str) -> DataFrame:
    """One row of each key; of several landings in a run the greatest payload, so that the choice is stable."""
    others = [c for c in landed.columns if c not in (*keys, "payload")]
    chosen = landed.groupBy(*keys).agg(F.max(F.struct("payload", *others)).alias("_row"))
    return chosen.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in ("payload", *others)])


def listing_pages(pages: DataFrame, page_size: int = LISTING_PAGE_SIZE) -> DataFrame:
    """Pages up to and including the first short one of each tenant and run; the advertised total is ignored.

    (tenant, run, offset, payload, ...) in, the same plus `_jobs` out. Every run lists afresh, so it has a
    cut-off of its own, and a page that landed twice in a run counts once. The cut-off is a mergeable minimum, not
    a window, so a tenant with a third of all pages is no bottleneck.
    """
    pages = _one_landing(_with_run(pages), "tenant", "run", "offset")
    doc = F.col("_doc")
    parsed = (
        pages.withColumn("_doc", F.try_parse_json("payload"))
        .withColumn("_jobs", F.when(_is(doc, "OBJECT"), _items(_at(doc, "jobPostings"))))
        .drop("_doc")
    )
    short = F.coalesce(F.size("_jobs"), F.lit(0)) < page_size
    ends = parsed.groupBy("tenant", "run").agg(F.min(F.when(short, F.col("offset"))).alias("_end"))
    # Staged, its size is known when the join is planned: unless there are very many tenants, the
    # payloads stay where they are.
    return parsed.join(stage(ends, "page_ends"), ["tenant", "run"]).filter(F.col("_end").isNull() | (F.col("offset") <= F.col("_end"))).drop("_end")


def _workday_rows(pages: DataFrame, details: DataFrame, page_size: int) -> DataFrame:
    """One normalized row per listed job with a `_bad` mark, staged; malformed pages keep one row."""
    jobs = listing_pages(pages, page_size).select(
        "company_name",
        "tenant",
        "site",
        "wd_subdomain",
        "run",
        "offset",
        F.col("_jobs").isNull().alias("_bad_page"),
        F.posexplode_outer("_jobs").alias("_pos", "_job"),
    )
    path = F.coalesce(_text(F.col("_job"), "externalPath"), F.lit(""))
    landed = _one_landing(_with_run(details).select("tenant", "run", "external_path", "payload"), "tenant", "run", "external_path")
    parsed = landed.select("tenant", "run", F.col("external_path").alias("_path"), F.try_parse_json("payload").alias("_detail"))
    joined = jobs.withColumn("_path", path).join(parsed, ["tenant", "run", "_path"], "left")
    job, detail, info = F.col("_job"), F.col("_detail"), _at(F.col("_detail"), "jobPostingInfo")
    well_formed = (
        _is(job, "OBJECT")
        & _is(detail, "OBJECT")
        & (info.isNull() | _is(info, "OBJECT"))
        & (_is(_at(info, "startDate"), "STRING") | _nothing(_at(info, "startDate")))
    )
    site = F.concat(
        F.lit("https://"), "tenant", F.lit("."), "wd_subdomain", F.lit(".myworkdayjobs.com/"), "site", "_path"
    )
    bullets = F.coalesce(F.to_json(_at(job, "bulletFields")), F.lit("null"))
    rows = joined.select(
        F.lit("workday").alias("source"),
        F.col("company_name").alias("company"),
        first_filled(_text(info, "title"), _text_or_empty(job, "title")).alias("title"),
        first_filled(_text(info, "location"), _text(job, "locationsText")).alias("location"),
        html_to_text(_text(info, "jobDescription")).alias("description"),
        first_filled(_text(info, "externalUrl"), site).alias("url"),
        plain_iso_date(_text(info, "startDate")).alias("posted_date"),
        _text(info, "jobReqId").alias("raw_id"),
        F.concat(F.lit('{"bulletFields":'), bullets, F.lit("}")).alias("extra_json"),
        F.struct("run", F.col("tenant").alias("landed"), "offset", "_pos").alias("arrival"),
        "tenant",
        "run",
        (F.col("_bad_page") | (F.col("_pos").isNotNull() & ~well_formed)).alias("_bad"),
        F.col("_pos").isNotNull().alias("_is_job"),
    )
    return stage(rows, "workday")


def workday_postings(pages: DataFrame, details: DataFrame, page_size: int = LISTING_PAGE_SIZE) -> DataFrame:
    """Postings of paged listings joined one to one with their detail records.

    `pages`: company_name, tenant, site, wd_subdomain, offset, payload. `details`: tenant,
    external_path, payload. Both may have a `run` key, which sorts as the runs came: pages and details of a run
    belong together, and arrival goes by run. Detail values win over listing values. A malformed page or a
    missing detail drops the company for that run.
    """
    rows = _workday_rows(pages, details, page_size)
    bad = stage(rows.filter("_bad").select("tenant", "run").distinct(), "bad_tenants")
    return rows.filter("_is_job").join(bad, ["tenant", "run"], "left_anti").select(*POSTING_COLUMNS, "arrival")


def workday_rejects(pages: DataFrame, details: DataFrame, page_size: int = LISTING_PAGE_SIZE) -> DataFrame:
    """(company_name, tenant, run) of companies dropped by `workday_postings`."""
    rows = _workday_rows(pages, details, page_size)
    return rows.filter("_bad").select(F.col("company").alias("company_name"), "tenant", "run").distinct()


def read_listings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed pages and details of `<path>/<run>/<tenant>/pages/<offset>.json` and `.../details/<any>.json`.

    A detail file holds one object per line: external_path and payload (the landed JSON text).
    """
    parts = F.split(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/")
    place = lambda n: F.try_element_at(parts, F.lit(n))
    pages = spark.read.option("pathGlobFilter", "*.json").text(f"{path}/*/*/pages", wholetext=True)
    details = spark.read.schema("external_path string, payload string").json(f"{path}/*/*/details")
    return (
        pages.select(
            place(-3).alias("tenant"),
            place(-4).alias("run"),
            F.regexp_replace(place(-1), r"\.json$", "").cast("int").alias("offset"),
            F.col("value").alias("payload"),
        ),
        details.select(place(-3).alias("tenant"), place(-4).alias("run"), "external_path", "payload"),
    )


def read_aggregator(spark: SparkSession, path: str) -> DataFrame:
    """Landed aggregator rows, JSON lines of `<path>/<run>/<any>.json`, with their run and an arrival order."""
    fields = (
        "site string, company string, title string, city string, state string, description string, job_url string, "
        "date_posted string, is_remote boolean, job_type string, min_amount double, max_amount double, currency string, "
        "company_industry string, search_term string, search_location string"
    )
    rows = spark.read.schema(fields).json(f"{path}/*/*.json")
    file = F.col("_metadata.file_path")
    return rows.withColumns(
        {
            "run": F.try_element_at(F.split(file, "/"), F.lit(-2)),
            "arrival": F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")),
        }
    )


# ---------------------------------------------------------------- aggregator feed

EXTRAS = ("is_remote", "job_type", "min_amount", "max_amount", "currency", "company_industry")


def aggregator_postings(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Aggregator rows to postings; rows without a URL are dropped, duplicates are kept."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in AGGREGATOR.fields if f.name not in rows.columns}
    return rows.withColumns(missing).filter("job_url <> ''").select(
        F.concat(F.lit("jobspy:"), text_or(F.col("site"), "unknown")).alias("source"),
        text_or(F.col("company")).alias("company"),
        text_or(F.col("title")).alias("title"),
        joined_or_null(", ", F.col("city"), F.col("state")).alias("location"),
        text_or(F.col("description")).alias("description"),
        F.col("job_url").alias("url"),
        iso_date(F.col("date_posted").cast("string")).alias("posted_date"),
        F.lit(None).cast("string").alias("raw_id"),
        F.to_json(F.struct(*EXTRAS)).alias("extra_json"),
        F.col(arrival).alias("arrival"),
    )


@dataclass(frozen=True)
class SearchSettings:
    """What the aggregator is asked for."""

    sites: Sequence[str] = SEARCH_SITES
    terms: Sequence[str] = SEARCH_TERMS
    locations: Sequence[str] = SEARCH_LOCATIONS
    results_wanted: int = RESULTS_WANTED
    hours_old: int | None = HOURS_OLD

    @classmethod
    def from_yaml(cls, path: str | Path) -> SearchSettings:
        import yaml

        raw = yaml.safe_load(Path(path).read_text())["jobspy"]
        return cls(
            sites=tuple(raw["site_names"]),
            terms=tuple(raw["search_terms"]),
            locations=tuple(raw["locations"]),
            results_wanted=raw.get("results_wanted", RESULTS_WANTED),
            hours_old=raw.get("hours_old"),
        )


def search_plan(spark: SparkSession, terms: Sequence[str], locations: Sequence[str]) -> DataFrame:
    """(search_term, search_location): every term with every location, from the configured lists."""
    lists = spark.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in terms])).alias("search_term"),
        F.array(*[F.lit(p) for p in locations]).alias("_places"),
    )
    return lists.select("search_term", F.explode("_places").alias("search_location"))


def capped_results(
    rows: DataFrame,
    results_wanted: int,
    order: Sequence[Column],
    since: Column | None = None,
    run: str | None = None,
) -> DataFrame:
    """At most `results_wanted` rows per search term, location and site, in the order given.

    With `run`, the column that tells landings apart, the cap holds for each run of a query.

    The cap is the feature here. Spark prunes to the cap inside each task before the shuffle
    (window group limit), so a query with a third of all rows stays cheap.
    """
    recent = rows if since is None else rows.filter(F.col("date_posted") >= since)
    keys = ["search_term", "search_location", "site", *([run] if run else [])]
    per_query = Window.partitionBy(*keys).orderBy(*order)
    return (
        recent.withColumn("result_rank", F.row_number().over(per_query))
        .filter(F.col("result_rank") <= results_wanted)
    )


def planned_rows(rows: DataFrame, search: SearchSettings, run_at: datetime) -> DataFrame:
    """Landed rows (search_term, search_location, arrival, ...) held to a search plan.

    A result found by several queries stays several rows, as the queries are not compared. A row
    that doesn't name its site stays: only a site that isn't asked for drops a row. If the rows
    have a `run` column, each run has its own cap.
    """
    plan = search_plan(rows.sparkSession, search.terms, search.locations)
    wanted = F.col("site").isNull() | F.col("site").isin(*search.sites)
    asked = rows.filter(wanted).join(plan, ["search_term", "search_location"])
    recent = asked
    if search.hours_old is not None:
        oldest = (run_at - timedelta(hours=search.hours_old)).date()
        posted = iso_date(F.col("date_posted").cast("string"))
        recent = asked.filter(posted.isNull() | (posted >= F.lit(oldest)))
    return capped_results(recent, search.results_wanted, [F.col("arrival")], run="run" if "run" in rows.columns else None)
