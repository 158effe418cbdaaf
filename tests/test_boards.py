from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.operators import boards


def log(spark, *rows):
    return spark.createDataFrame(
        [(f"C{i}", *r) for i, r in enumerate(rows)],
        "company_name string, ats_type string, board_identifier string, tenant string, http_status int, n_jobs int, error string",
    )


def test_health(spark):
    checked = boards.health(
        log(
            spark,
            ("greenhouse", "a", None, 200, 3, None),
            ("workday", "", "t", 200, 0, None),
            ("lever", "b", None, 404, None, None),
            ("ashby", "c", None, None, None, "timed out"),
            ("kula", "d", None, None, None, None),
        )
    )
    rows = checked.select("status", boards.health_line().alias("line")).collect()
    assert [r.status for r in rows] == ["OK", "WARN", "FAIL", "ERROR", "SKIP"]
    assert [r.line for r in rows] == [
        "OK      C0 (a): 3 jobs",
        "WARN    C1 (t): 200 but no jobs returned",
        "FAIL    C2 (b): HTTP 404",
        "ERROR   C3 (c): timed out",
        "SKIP    C4 (ats_type=kula, not yet supported)",
    ]
    assert boards.all_healthy(checked).first().all_ok is False
    assert boards.all_healthy(checked.filter("status in ('OK', 'SKIP')")).first().all_ok is True


def test_names(spark):
    names = spark.createDataFrame(
        [(0, "Acme"), (1, " ACME "), (2, "Beta"), (3, ""), (4, "beta"), (5, "Gamma")], "line_no int, name string"
    )
    known = spark.createDataFrame([(" beta ",)], "company_name string")
    found = boards.unknown_names(boards.first_names(names), known).orderBy("line_no").collect()
    assert [(r.name, r.line_no) for r in found] == [("Acme", 0), ("Gamma", 5)]


def test_detection_takes_the_first_board_with_jobs(spark):
    names = spark.createDataFrame([("Acme Bio, Inc.",), ("Nobody",)], "name string")
    probes = spark.createDataFrame(
        [
            ("greenhouse", "acme-bio", 0),
            ("ashby", "acme-bio", 4),
            ("lever", "acme-bio", 2),
            ("greenhouse", "acmebio", 9),
            ("workday", "acme-bio", 9),
        ],
        "ats_type string, slug string, n_jobs int",
    )
    hits = boards.detect_boards(names, probes).withColumn("n_relevant", F.lit(1).cast("bigint"))
    rows = hits.select("company", "ats_type", "slug", "n_jobs", boards.company_line(date(2026, 9, 1)).alias("line")).collect()
    assert len(rows) == 1 and (rows[0].ats_type, rows[0].slug, rows[0].n_jobs) == ("lever", "acme-bio", 2)
    assert rows[0].line == (
        "Acme Bio, Inc.,lever,acme-bio,,https://jobs.lever.co/acme-bio,verified 2026-09-01 - 2 jobs (1 relevant by title)"
    )


def test_relevant_titles(spark):
    jobs = spark.createDataFrame([("a", "NGS Lead"), ("a", "Chef"), ("b", "Chef")], "board string, title string")
    rules = RelevanceRules(include=("NGS",), exclude=(), off_topic_titles=())
    rows = boards.relevant_title_counts(jobs, rules, "board").collect()
    assert [(r.board, r.n_jobs, r.n_relevant) for r in rows] == [("a", 2, 1)]
