"""Health of known boards and detection of new ones, over landed fetch logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules, relevance
from roleweave.functions.text import name_key, slug_candidates, strip
from roleweave.vocabulary import BOARD_TYPES, CAREERS_URL


def health(log: DataFrame, supported: tuple[str, ...] = ("greenhouse", "lever", "ashby", "workday")) -> DataFrame:
    """Add `status` to fetch-log rows (ats_type, http_status, n_jobs, error).

    SKIP: board type not supported. ERROR: the fetch raised. OK: 200 with jobs. WARN: 200 without.
    FAIL: any other answer.
    """
    status = (
        F.when(~F.col("ats_type").isin(*supported), "SKIP")
        .when(F.col("error").isNotNull(), "ERROR")
        .when((F.col("http_status") == 200) & (F.col("n_jobs") > 0), "OK")
        .when(F.col("http_status") == 200, "WARN")
        .otherwise("FAIL")
    )
    return log.withColumn("status", status)


def health_summary(checked: DataFrame) -> DataFrame:
    """(status, boards, jobs) per status."""
    return checked.groupBy("status").agg(
        F.count(F.lit(1)).alias("boards"), F.coalesce(F.sum("n_jobs"), F.lit(0)).alias("jobs")
    )


def all_healthy(checked: DataFrame) -> DataFrame:
    """(all_ok): no WARN, FAIL or ERROR; skipped boards do not count."""
    return checked.agg(F.coalesce(F.bool_and(F.col("status").isin("OK", "SKIP")), F.lit(True)).alias("all_ok"))


def health_line() -> Column:
    """One printed line per board."""
    label = F.coalesce(F.nullif("board_identifier", F.lit("")), F.col("tenant"))
    named = F.concat(F.col("company_name"), F.lit(" ("), F.coalesce(label, F.lit("")), F.lit(")"))
    text = (
        F.when(F.col("status") == "OK", F.concat(named, F.format_string(": %d jobs", F.col("n_jobs").cast("bigint"))))
        .when(F.col("status") == "WARN", F.concat(named, F.lit(": 200 but no jobs returned")))
        .when(F.col("status") == "FAIL", F.concat(named, F.lit(": HTTP "), F.col("http_status").cast("string")))
        .when(F.col("status") == "ERROR", F.concat(named, F.lit(": "), F.col("error")))
        .otherwise(
            F.concat("company_name", F.lit(" (ats_type="), "ats_type", F.lit(", not yet supported)"))
        )
    )
    return F.concat(F.rpad("status", 8, " "), text)


def first_names(names: DataFrame, name: str = "name", order: str = "line_no") -> DataFrame:
    """(name, line_no): first spelling of every name, case ignored. Blank names are dropped.

    A mergeable minimum instead of a window, so a name repeated without end costs one row per task.
    """
    clean = names.select(strip(F.col(name)).alias("name"), F.col(order).alias("line_no")).filter("name <> ''")
    best = clean.groupBy(F.lower("name").alias("_key")).agg(F.min_by("name", "line_no").alias("name"), F.min("line_no").alias("line_no"))
    return best.select("name", "line_no")


def unknown_names(names: DataFrame, companies: DataFrame, name: str = "name") -> DataFrame:
    """Names that are not on the company list."""
    known = companies.select(name_key(F.col("company_name")).alias("_key")).distinct()
    return names.withColumn("_key", name_key(F.col(name))).join(known, "_key", "left_anti").drop("_key")


def probe_plan(names: DataFrame, name: str = "name") -> DataFrame:
    """(company, slug, ats_type): every slug candidate on every board type, a bounded set per name."""
    slugs = names.select(F.col(name).alias("company"), F.explode_outer(slug_candidates(F.col(name))).alias("slug"))
    return slugs.filter("slug is not null").withColumn("ats_type", F.explode(F.array(*[F.lit(t) for t in BOARD_TYPES])))


def first_hits(probes: DataFrame) -> DataFrame:
    """(company, ats_type, slug, n_jobs): first board with jobs, by slug, then by board type order."""
    rank = F.array_position(F.array(*[F.lit(t) for t in BOARD_TYPES]), F.col("ats_type"))
    hit = F.struct("ats_type", "slug", "n_jobs")
    best = (
        probes.filter((F.col("n_jobs") > 0) & F.col("ats_type").isin(*BOARD_TYPES))
        .groupBy("company")
        .agg(F.min_by(hit, F.struct("slug", rank)).alias("h"))
    )
    return best.select("company", "h.*")


def detect_boards(names: DataFrame, probe_results: DataFrame) -> DataFrame:
    """First hit of every name among landed probe results (ats_type, slug, n_jobs)."""
    planned = probe_plan(names)
    return first_hits(planned.join(probe_results.select("ats_type", "slug", "n_jobs"), ["ats_type", "slug"]))


def relevant_title_counts(jobs: DataFrame, rules: RelevanceRules, *keys: str, title: str = "title") -> DataFrame:
    """(keys..., n_jobs, n_relevant) for boards with at least one title that is relevant by itself."""
    flag = relevance(rules, F.col(title), F.lit(""))
    counts = jobs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_jobs"), F.count_if(flag).alias("n_relevant"))
    return counts.filter("n_relevant > 0")


def careers_url() -> Column:
    """Public careers page of a hit."""
    url = F.lit(None).cast("string")
    for ats_type, template in CAREERS_URL.items():
        url = F.when(F.col("ats_type") == ats_type, F.format_string(template, "slug")).otherwise(url)
    return url


def company_line(verified_on: date) -> Column:
    """CSV line to append to the company list; `n_relevant` may be null when it was not counted."""
    note = F.concat(
        F.lit(f"verified {verified_on.isoformat()} - "),
        F.col("n_jobs").cast("string"),
        F.lit(" jobs"),
        F.when(
            F.col("n_relevant").isNotNull(),
            F.concat(F.lit(" ("), F.col("n_relevant").cast("string"), F.lit(" relevant by title)")),
        ).otherwise(F.lit("")),
    )
    return F.concat_ws(",", "company", "ats_type", "slug", F.lit(""), careers_url(), note)
