"""The shared test tables seen as postings, feeds, logs and vectors. Every row and whole text is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules, relevance, remote_flag
from roleweave.functions.text import html_to_text
from roleweave.operators.similarity import mean_vectors
from roleweave.session import stage

# Rules in the vocabulary of the invented prose.
PROSE_RULES = RelevanceRules(
    include=("anea", "thon(?:ou)?s?", "étion", "ciónas?", "ich(?:en)?", "ther[- ]than"),
    exclude=("stupid", "worthless", "mit license"),
    off_topic_titles=("attion", "que", "und", "thnt"),
)
# Rules in the vocabulary of the event stream.
EVENT_RULES = RelevanceRules(
    include=("click", "signup", r"7\d"),
    exclude=(r"9\d",),
    off_topic_titles=("error",),
)
# Day the second event batch starts.
SECOND_BATCH = "2024-01-16"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """The same rows, spread over all tasks. A file's row group is read by one task, and a large file may have just one."""
    return rows.withColumn("_row", F.monotonically_increasing_id()).repartition("_row").drop("_row")


def _title(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _body(text: Column) -> Column:
    return F.substr(text, F.char_length(_title(text)) + 2)


def document_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as stored postings: first line as title, the rest as description."""
    docs = table(spark, folder, "documents")
    source = (
        F.when(F.col("source").startswith("src1"), F.concat(F.lit("jobspy:LinkedIn/"), "source"))
        .when(F.col("source").startswith("src2"), F.lit("jobspy:indeed"))
        .otherwise(F.col("source"))
    )
    location = (
        F.when(F.col("lang") == "en", F.lit("Remote, anywhere"))
        .when(F.col("lang") == "fr", F.lit("Hybrid with remote days"))
        .when(F.col("lang") == "de", F.lit("Remoteville"))
        .otherwise(F.lit("  \n "))
    )
    extra = (
        F.when(F.col("source") == "src3", F.lit('{"is_remote":true}'))
        .when(F.col("source") == "src4", F.lit('{"is_remote":false}'))
        .when(F.col("source") == "src5", F.lit('{"is_remote":null}'))
        .otherwise(F.lit("{}"))
    )
    status = F.when(F.col("n_chars") % 5 == 0, "applied").when(F.col("n_chars") % 5 == 1, "skip").otherwise("new")
    posted = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int"))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("raw_id"),
        source.alias("source"),
        F.col("lang").alias("company"),
        _title(F.col("text")).alias("title"),
        location.alias("location"),
        _body(F.col("text")).alias("description"),
        posted.alias("posted_date"),
        posted.cast("timestamp").alias("first_seen_at"),
        posted.cast("timestamp").alias("last_seen_at"),
        extra.alias("extra_json"),
        F.when(F.col("n_chars") >= 200, (F.col("n_chars") % 101).cast("double")).alias("score"),
        status.alias("application_status"),
        F.lit(None).cast("timestamp").alias("application_status_updated_at"),
    )
    return rows.withColumn("is_relevant", relevance(PROSE_RULES, F.col("title"), F.col("description"))).withColumn(
        "is_remote", remote_flag(F.col("location"), F.col("extra_json"))
    )


def sighted_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as postings of several sources; some places aren't stated, some are written differently."""
    place = F.element_at(F.array(*[F.lit(p) for p in ("", "Boston, MA", "BOSTON (MA)", "Remote")]), (F.col("n_chars") % 4 + 1).cast("int"))
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("source").startswith("src1"), F.lit("jobspy:linkedin")).otherwise(F.col("source")).alias("source"),
        F.col("lang").alias("company"),
        _title(F.col("text")).alias("title"),
        place.alias("location"),
    )


def event_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a feed keyed by user: many sightings per key, in order of time."""
    events = table(spark, folder, "events")
    location = F.when(F.col("event_type") == "click", "Remote").when(F.col("event_type") == "purchase", "Hybrid")
    return events.select(
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


def event_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All events as two consecutive batches."""
    rows = event_postings(spark, folder)
    late = F.col("posted_date") >= F.lit(SECOND_BATCH).cast("date")
    return rows.filter(~late), rows.filter(late)


def status_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as status changes of users; views and errors are not valid statuses."""
    status = (
        F.when(F.col("event_type") == "click", "applied")
        .when(F.col("event_type") == "purchase", "skip")
        .when(F.col("event_type") == "signup", "new")
        .otherwise(F.col("event_type"))
    )
    return table(spark, folder, "events").select(
        F.concat(F.lit("user://"), F.col("user_id").cast("string")).alias("url"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("changed_at"),
    )


def _host(url: Column) -> Column:
    return F.regexp_extract(url, "^https?://([^/?#]+)", 1)


def _board_type(host: Column) -> Column:
    return (
        F.when(host.endswith(".com"), "greenhouse")
        .when(host.endswith(".net"), "lever")
        .when(host.endswith(".org"), "ashby")
        .otherwise("kula")
    )


def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, host, title)."""
    title = html_to_text(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    return table(spark, folder, "pages").select(
        "page_id", "url", _host(F.col("url")).alias("host"), title.alias("title")
    )


def page_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Hosts as companies; the top-level domain names the board type."""
    hosts = table(spark, folder, "pages").select(_host(F.col("url")).alias("host")).distinct()
    return hosts.select(
        F.col("host").alias("company_name"),
        _board_type(F.col("host")).alias("ats_type"),
        F.col("host").alias("board_identifier"),
        F.lit(None).cast("string").alias("tenant"),
    )


def page_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as a landed board payload with one job; the HTML is the job's content.

    A page whose address carries a fragment has `departments: null`, which makes its payload
    malformed.
    """
    job = F.struct(
        F.col("page_id").alias("id"),
        F.col("host").alias("title"),
        F.col("url").alias("absolute_url"),
        F.concat(F.lit("2024-02-"), F.lpad((F.length("html") % 28 + 1).cast("string"), 2, "0"), F.lit("T23:30:00-05:00")).alias("updated_at"),
        F.col("html").alias("content"),
        F.struct(F.col("lang").alias("name")).alias("location"),
        F.when(~F.col("url").contains("#"), F.array(F.struct(F.col("lang").alias("name")))).alias("departments"),
        F.array(F.struct(F.col("host").alias("name"))).alias("offices"),
    )
    pages = table(spark, folder, "pages").select(
        "*", _host(F.col("url")).alias("host"), F.regexp_extract("html", 'lang="(\\w+)"', 1).alias("lang")
    )
    payload = F.to_json(F.struct(F.array(job).alias("jobs")), {"ignoreNullFields": "false"})
    return pages.select(F.col("host").alias("board"), payload.alias("payload"), F.col("page_id").alias("landed"))


def board_files(spark: SparkSession, folder: str, waves: int = 3) -> DataFrame:
    """(wave, b, value): pages as board files to land in waves; a file holds the jobs of a host's pages in the order of page_id.

    Pages are dealt out by page_id. A page whose address carries a fragment makes its whole file malformed.
    """
    payloads = page_payloads(spark, folder).select("board", F.col("landed").alias("page_id"), (F.col("landed") % waves).alias("wave"), "payload")
    job = F.struct("page_id", F.substr("payload", F.lit(len('{"jobs":[') + 1), F.length("payload") - len('{"jobs":[]}')).alias("job"))
    # The jobs that one host lands at once, which are one file.
    files = payloads.groupBy("wave", "board").agg(F.array_sort(F.collect_list(job)).alias("jobs"))
    text = F.concat(F.lit('{"jobs":['), F.array_join(F.transform("jobs", lambda j: j["job"]), ","), F.lit("]}"))
    return files.select("wave", F.col("board").alias("b"), text.alias("value"))


def landed_companies(spark: SparkSession, folder: str) -> DataFrame:
    """The companies of the landed files, whose folders are called `b=<host>`."""
    return page_companies(spark, folder).withColumn("board_identifier", F.concat(F.lit("b="), "board_identifier"))


def event_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a landed payload holding a top-level array; errors carry a wrong type."""
    job = F.concat(
        F.lit('[{"id":'), F.col("event_id").cast("string"),
        F.lit(',"text":"'), "event_type",
        F.lit('","createdAt":'), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.lit(',"hostedUrl":"user://'), F.col("user_id").cast("string"),
        F.lit('","categories":'),
        F.when(F.col("event_type") == "error", F.lit('"none"')).otherwise(
            F.concat(F.lit('{"location":"'), "event_type", F.lit('","team":null}'))
        ),
        F.lit("}]"),
    )
    return table(spark, folder, "events").select(
        F.col("event_type").alias("company_name"), job.alias("payload"), F.col("event_id").alias("landed")
    )


def document_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a landed payload with one job in plain text."""
    job = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        _title(F.col("text")).alias("title"),
        F.col("lang").alias("location"),
        F.col("text").alias("descriptionPlain"),
        F.lit("2024-03-01T08:00:00.000Z").alias("publishedAt"),
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("jobUrl"),
        F.col("source").alias("department"),
        F.lit(None).cast("string").alias("team"),
        F.lit("full").alias("employmentType"),
    )
    payload = F.to_json(F.struct(F.array(job).alias("jobs")), {"ignoreNullFields": "false"})
    return table(spark, folder, "documents").select(
        F.col("source").alias("company_name"), payload.alias("payload"), F.col("doc_id").alias("landed")
    )


def page_listing(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Pages as jobs of tenants with fifty jobs each, listed twenty to a page by two runs.

    Run a lists every job, run b those with an even number. One job in two hundred lacks its detail in run b, and
    each tenth detail landed twice.
    """
    runs = F.explode(F.when(F.col("page_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))
    pages = table(spark, folder, "pages").select("*", _host(F.col("url")).alias("host"), runs.alias("run"))
    tenant = F.concat(F.lit("t"), F.expr("page_id div 50").cast("string"))
    path = F.concat(F.lit("/job/"), F.col("page_id").cast("string"))
    entry = F.struct(
        F.col("host").alias("title"), path.alias("externalPath"), F.lit("US - Remote").alias("locationsText"),
        F.array(tenant).alias("bulletFields"),
    )
    # At most fifty jobs come together here.
    jobs = pages.groupBy(tenant.alias("tenant"), "run").agg(F.sort_array(F.collect_list(F.struct("page_id", entry.alias("job")))).alias("jobs"))
    starts = F.sequence(F.lit(0), F.size("jobs") - 1, F.lit(20))
    paged = jobs.select("tenant", "run", "jobs", F.explode(starts).alias("offset"))
    page = F.transform(F.slice("jobs", F.col("offset") + 1, F.lit(20)), lambda j: j["job"])
    listing = paged.select(
        F.concat(F.lit("company "), F.col("tenant")).alias("company_name"),
        "tenant",
        F.lit("careers").alias("site"),
        F.lit("wd1").alias("wd_subdomain"),
        "run",
        "offset",
        F.to_json(F.struct(F.lit(0).alias("total"), page.alias("jobPostings"))).alias("payload"),
    )
    info = F.struct(
        F.lit("").alias("title"), F.col("html").alias("jobDescription"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("page_id") % 28).cast("int")).cast("string").alias("startDate"),
        F.col("page_id").cast("string").alias("jobReqId"),
    )
    landings = F.explode(F.sequence(F.lit(1), F.when(F.col("page_id") % 10 == 0, 2).otherwise(1)))
    landed = pages.where((F.col("run") == "a") | (F.col("page_id") % 200 != 120)).select("*", landings.alias("landing"))
    details = landed.select(
        tenant.alias("tenant"), "run", path.alias("external_path"), F.to_json(F.struct(info.alias("jobPostingInfo"))).alias("payload")
    )
    return listing, details


def conversation_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as paged listings: a turn is a page, its words are the jobs."""
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("title")))
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("tenant"),
        F.col("turn").alias("offset"),
        F.to_json(F.struct(F.lit(0).alias("total"), words.alias("jobPostings"))).alias("payload"),
    )


def aggregator_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw aggregator rows, with missing values in every column that may lack one."""
    return table(spark, folder, "documents").select(
        F.when(F.col("source") != "src7", F.col("source")).alias("site"),
        F.col("lang").alias("company"),
        _title(F.col("text")).alias("title"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("city"),
        F.when(F.col("lang") == "en", F.lit("US")).alias("state"),
        F.nullif(_body(F.col("text")), F.lit("")).alias("description"),
        F.when(F.col("source") == "src9", F.lit("")).otherwise(
            F.concat(F.lit("doc://"), F.col("doc_id").cast("string"))
        ).alias("job_url"),
        F.when(F.col("lang") != "fr", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int")).cast("string")).alias("date_posted"),
        F.when(F.col("lang") == "es", F.lit(True)).alias("is_remote"),
        F.when(F.col("lang") != "es", F.col("source")).alias("job_type"),
        F.col("doc_id").alias("arrival"),
    )


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as a log of board fetches: list items count as jobs, fragments as failed addresses."""
    pages = table(spark, folder, "pages")
    host = _host(F.col("url"))
    n_jobs = F.size(F.split("html", "<li>")) - 1
    return pages.select(
        "page_id",
        host.alias("company_name"),
        _board_type(host).alias("ats_type"),
        host.alias("board_identifier"),
        F.lit(None).cast("string").alias("tenant"),
        F.when(F.col("url").contains("#"), 404).otherwise(200).alias("http_status"),
        F.when(F.col("url").contains("?"), 0).otherwise(n_jobs).alias("n_jobs"),
        F.when(F.col("url").endswith("/"), F.lit("timed out")).alias("error"),
    )


def vector_profile(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, sections, resume): vectors, the mean vector of each label, and the mean of all."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    sections = mean_vectors(vectors, "embedding", "label").select(
        F.col("label").cast("long").alias("section_id"), "vector"
    )
    return vectors, sections, mean_vectors(vectors, "embedding")
