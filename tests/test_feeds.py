from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import day, plan_of
from pyspark.sql import functions as F

from roleweave.plans.ingest import normalized
from roleweave.sources import feeds
from roleweave.sources.companies import read_companies

JOB = {
    "id": 123,
    "title": "Bioinformatics Scientist",
    "updated_at": "2026-06-20T23:30:00-05:00",
    "absolute_url": "https://boards.example.com/acme/123",
    "content": "<p>We need <b>NGS</b>.</p>",
    "location": {"name": "Remote"},
    "departments": [{"name": "R&D"}],
    "offices": [{"name": "Boston"}, {}],
}


@pytest.fixture
def payloads(spark):
    def build(*documents):
        rows = [(f"C{i}", d if isinstance(d, str) else json.dumps(d), i) for i, d in enumerate(documents)]
        return spark.createDataFrame(rows, "company_name string, payload string, landed int")

    return build


def test_greenhouse(payloads):
    row = feeds.board_postings(payloads({"jobs": [JOB]}), "greenhouse").first()
    assert (row.source, row.company, row.title, row.location) == ("greenhouse", "C0", "Bioinformatics Scientist", "Remote")
    assert (row.description, row.url, row.raw_id) == ("We need NGS .", "https://boards.example.com/acme/123", "123")
    assert row.posted_date == day("2026-06-20")
    assert json.loads(row.extra_json) == {"departments": ["R&D"], "offices": ["Boston", None]}


def test_missing_keys_and_nulls_differ(payloads):
    df = feeds.board_postings(payloads({"jobs": [{}, {"title": None, "location": None, "content": None}]}), "greenhouse")
    rows = df.orderBy("arrival").collect()
    assert [(r.title, r.url, r.location, r.description, r.raw_id, r.posted_date) for r in rows] == [
        ("", "", None, "", None, None),
        (None, "", None, "", None, None),
    ]
    assert json.loads(rows[0].extra_json) == {"departments": [], "offices": []}


@pytest.mark.parametrize(
    "bad",
    [
        "not json",
        "[1]",
        {"jobs": None},
        {"jobs": [JOB, {"departments": None}]},
        {"jobs": [JOB, {"location": "Boston"}]},
        {"jobs": [JOB, 5]},
        {"jobs": [{"updated_at": 5}]},
        {"jobs": [{"offices": ["x"]}]},
    ],
)
def test_malformed_payload_drops_only_its_company(payloads, bad):
    df = payloads(bad, {"jobs": [JOB]}, {}, {"jobs": []})
    assert [r.company for r in feeds.board_postings(df, "greenhouse").collect()] == ["C1"]
    assert [r.company_name for r in feeds.board_rejects(df, "greenhouse").collect()] == ["C0"]


def test_lever(payloads):
    job = {
        "id": "abc", "text": "Data Scientist", "createdAt": 1718841600000, "hostedUrl": "https://jobs/1",
        "descriptionPlain": "Plain.", "categories": {"location": "Toronto", "team": None},
    }
    df = payloads([job, {"categories": None, "createdAt": "soon", "descriptionPlain": None}], {"ok": False})
    rows = feeds.board_postings(df, "lever").orderBy("arrival").collect()
    assert (rows[0].title, rows[0].location, rows[0].description, rows[0].raw_id) == ("Data Scientist", "Toronto", "Plain.", "abc")
    assert rows[0].posted_date == day("2024-06-20")
    assert json.loads(rows[0].extra_json) == {"categories": {"location": "Toronto", "team": None}}
    assert (rows[1].location, rows[1].description, rows[1].posted_date) == (None, "", None)
    assert json.loads(rows[1].extra_json) == {"categories": {}}
    assert [r.company_name for r in feeds.board_rejects(df, "lever").collect()] == ["C1"]


def test_ashby(payloads):
    job = {
        "id": "u-1", "title": "Engineer", "location": "SF", "descriptionPlain": "Text", "jobUrl": "https://a/1",
        "publishedAt": "2026-06-20T10:00:00.000Z", "department": "Eng", "team": "Core",
    }
    row = feeds.board_postings(payloads({"jobs": [job]}), "ashby").first()
    assert (row.title, row.url, row.raw_id, row.posted_date) == ("Engineer", "https://a/1", "u-1", day("2026-06-20"))
    assert json.loads(row.extra_json) == {"department": "Eng", "team": "Core", "employmentType": None}


def _listing(spark, *pages, tenant="acme"):
    rows = [("Acme Inc", tenant, "acme-careers", "wd1", offset, json.dumps(doc)) for offset, doc in pages]
    return spark.createDataFrame(
        rows, "company_name string, tenant string, site string, wd_subdomain string, offset int, payload string"
    )


def _job(n):
    return {"title": f"Job {n}", "externalPath": f"/job/{n}", "locationsText": "US - Remote", "bulletFields": [f"R{n}"]}


def _details(spark, *numbers, tenant="acme", **info):
    rows = [
        (tenant, f"/job/{n}", json.dumps({"jobPostingInfo": {"jobDescription": "<p>NGS</p>", "startDate": "2026-06-20", "jobReqId": f"R{n}", **info}}))
        for n in numbers
    ]
    return spark.createDataFrame(rows, "tenant string, external_path string, payload string")


def test_workday_pages_and_details(spark):
    pages = _listing(
        spark,
        (0, {"total": 3, "jobPostings": [_job(1), _job(2)]}),
        (2, {"total": 0, "jobPostings": [_job(3)]}),
        (3, {"total": 0, "jobPostings": [_job(4), _job(5)]}),  # behind the short page
    )
    details = _details(spark, 1, 2, 3, externalUrl="")
    rows = feeds.workday_postings(pages, details, page_size=2).orderBy("arrival").collect()
    assert [r.raw_id for r in rows] == ["R1", "R2", "R3"]
    assert rows[0].title == "Job 1" and rows[0].location == "US - Remote" and rows[0].description == "NGS"
    assert rows[0].url == "https://acme.wd1.myworkdayjobs.com/acme-careers/job/1"
    assert rows[0].posted_date == day("2026-06-20") and json.loads(rows[0].extra_json) == {"bulletFields": ["R1"]}


def test_workday_detail_values_win(spark):
    pages = _listing(spark, (0, {"jobPostings": [_job(1)]}))
    details = _details(spark, 1, title="Better", location="Boston", externalUrl="https://x/1", startDate="soon")
    row = feeds.workday_postings(pages, details).first()
    assert (row.title, row.location, row.url, row.posted_date) == ("Better", "Boston", "https://x/1", None)


def test_workday_empty_and_broken_tenants(spark):
    good = _listing(spark, (0, {"jobPostings": [_job(1)]}), tenant="good")
    empty = _listing(spark, (0, {"total": 0, "jobPostings": []}), tenant="empty")
    lost = _listing(spark, (0, {"jobPostings": [_job(1), _job(2)]}), tenant="lost")
    pages = good.unionByName(empty).unionByName(lost)
    details = _details(spark, 1, tenant="good").unionByName(_details(spark, 1, tenant="lost"))
    assert feeds.workday_postings(pages, details).count() == 1
    assert [r.tenant for r in feeds.workday_rejects(pages, details).collect()] == ["lost"]


def test_workday_runs_stay_apart(spark):
    """The same tenant landed in two runs, one of them twice: each run lists its own jobs once."""
    def run(name, n_jobs, landings=1, lost=()):
        numbers = list(range(1, n_jobs + 1))
        pages = [(i, {"total": 0, "jobPostings": [_job(n) for n in numbers[i : i + 2]]}) for i in range(0, n_jobs, 2)] * landings
        details = _details(spark, *[n for n in numbers * landings if n not in lost])
        return _listing(spark, *pages).withColumn("run", F.lit(name)), details.withColumn("run", F.lit(name))

    pages, details = run("2026-01-01", 3, landings=2)
    for more in (run("2026-01-02", 5), run("2026-01-03", 3, lost=(2,))):
        pages, details = pages.unionByName(more[0]), details.unionByName(more[1])
    rows = feeds.workday_postings(pages, details, page_size=2).orderBy("arrival").collect()
    assert [(r.arrival.run, r.raw_id) for r in rows] == [("2026-01-01", f"R{n}") for n in (1, 2, 3)] + [("2026-01-02", f"R{n}") for n in (1, 2, 3, 4, 5)]
    assert [(r.tenant, r.run) for r in feeds.workday_rejects(pages, details, page_size=2).collect()] == [("acme", "2026-01-03")]


def test_landed_listings_and_aggregator_rows_are_read(spark, tmp_path):
    for name, text in {
        "w/r1/acme/pages/0.json": json.dumps({"jobPostings": [_job(1)]}),
        "w/r1/acme/details/a.json": json.dumps({"external_path": "/job/1", "payload": json.dumps({"jobPostingInfo": {"jobReqId": "R1"}})}),
        "g/r1/a.json": json.dumps({"site": None, "title": "t", "job_url": "u", "search_term": "x", "search_location": "y"}),
        "g/r2/a.json": json.dumps({"site": "other", "title": "t2", "job_url": "u2", "search_term": "x", "search_location": "y"}),
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    pages, details = feeds.read_listings(spark, str(tmp_path / "w"))
    pages = pages.select(F.lit("Acme").alias("company_name"), "*", F.lit("s").alias("site"), F.lit("wd1").alias("wd_subdomain"))
    assert [(r.raw_id, r.arrival.run) for r in feeds.workday_postings(pages, details).collect()] == [("R1", "r1")]
    rows = feeds.read_aggregator(spark, str(tmp_path / "g"))
    search = feeds.SearchSettings(sites=("asked",), terms=("x",), locations=("y",), results_wanted=1)
    kept = feeds.planned_rows(rows, search, datetime(2026, 1, 1)).collect()
    assert [(r.site, r.run) for r in kept] == [(None, "r1")]


def test_aggregator_rows(spark):
    rows = spark.createDataFrame(
        [
            ("linkedin", "Acme", "Scientist", "Boston", "MA", None, "https://l/1", "2026-06-20", True, 0),
            (None, None, None, None, "MA", "d", "https://l/2", None, None, 1),
            ("indeed", "Acme", "No url", None, None, "d", "", None, None, 2),
            ("indeed", "Acme", "No url", None, None, "d", None, None, None, 3),
            ("linkedin", "Acme", "Scientist", "Boston", "MA", None, "https://l/1", "2026-06-20", True, 4),
        ],
        "site string, company string, title string, city string, state string, description string, job_url string, date_posted string, is_remote boolean, arrival int",
    )
    found = feeds.aggregator_postings(rows).orderBy("arrival").collect()
    assert len(found) == 3  # duplicates stay
    a, b, _ = found
    assert (a.source, a.location, a.description, a.posted_date) == ("jobspy:linkedin", "Boston, MA", "", day("2026-06-20"))
    assert json.loads(a.extra_json) == {"is_remote": True} and a.raw_id is None
    assert (b.source, b.company, b.title, b.location, b.extra_json) == ("jobspy:unknown", "", "", "MA", "{}")


def test_search_plan_and_cap(spark):
    plan = feeds.search_plan(spark, ("a", "b"), ("x", "y"))
    assert plan.count() == 4
    # One query holds nearly all rows; the cap is applied before the shuffle.
    rows = spark.range(1000).select(
        F.when(F.col("id") < 990, "a").otherwise("b").alias("search_term"), F.lit("x").alias("search_location"),
        F.lit("linkedin").alias("site"), F.col("id"), F.lit("2026-01-01").cast("date").alias("date_posted"),
    )
    capped = feeds.capped_results(rows, 3, [F.col("id")])
    assert sorted((r.search_term, r.id) for r in capped.collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 990), ("b", 991), ("b", 992)]
    plan_text = plan_of(capped)
    assert plan_text.count("WindowGroupLimit") >= 2
    assert feeds.capped_results(rows, 3, [F.col("id")], F.lit("2026-02-01").cast("date")).count() == 0


def test_rows_are_held_to_the_search_plan(spark, tmp_path):
    path = tmp_path / "settings.yaml"
    path.write_text(
        "jobspy:\n  site_names: [linkedin]\n  search_terms: [bio, chem]\n  locations: [US]\n  results_wanted: 2\n  hours_old: 72\n"
    )
    search = feeds.SearchSettings.from_yaml(path)
    rows = [(t, "US", "linkedin", f"https://x/{t}{i}", "2026-06-20", i) for t in ("bio", "chem", "law") for i in range(3)]
    rows += [("bio", "US", "indeed", "https://x/i", "2026-06-20", 9), ("bio", "EU", "linkedin", "https://x/e", "2026-06-20", 10)]
    rows += [("chem", "US", "linkedin", "https://x/old", "2026-06-01", -1), ("chem", "US", "linkedin", "https://x/undated", None, -2)]
    landed = spark.createDataFrame(
        rows, "search_term string, search_location string, site string, job_url string, date_posted string, arrival int"
    )
    found = normalized("jobspy", {"rows": landed}, search, datetime(2026, 6, 21, tzinfo=timezone.utc))
    assert sorted(r.url for r in found.collect()) == [
        "https://x/bio0", "https://x/bio1", "https://x/chem0", "https://x/undated"
    ]


def test_companies_and_landed_files(spark, tmp_path: Path):
    csv = tmp_path / "companies.csv"
    csv.write_text(
        "company_name,ats_type,board_identifier,tenant,careers_url,notes\n"
        'Acme,greenhouse,acme,,https://a,"verified, ok"\n'
        "Other,lever,other,t,,\n"
    )
    companies = read_companies(spark, str(csv))
    rows = {r.company_name: r for r in companies.collect()}
    assert rows["Acme"].tenant is None and rows["Acme"].site is None and rows["Acme"].notes == "verified, ok"
    assert rows["Other"].tenant == "t" and rows["Other"].careers_url == ""
    for board in ("acme", "other"):
        folder = tmp_path / "landing" / board
        folder.mkdir(parents=True)
        (folder / "run 1+2.json").write_text(json.dumps({"jobs": [JOB]}, indent=1))
    landed = feeds.read_payloads(spark, str(tmp_path / "landing"))
    df = normalized("greenhouse", {"companies": companies, "payloads": landed})
    assert [(r.company, r.raw_id) for r in df.collect()] == [("Acme", "123")]
    with pytest.raises(ValueError, match="unsupported source"):
        normalized("kula", {})
