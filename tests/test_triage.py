from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from conftest import plan_of

from roleweave.operators import triage as q
from roleweave.schemas import SNAPSHOT

AT = datetime(2026, 1, 10, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def postings(spark):
    defaults = dict(source="greenhouse", company="Acme", is_relevant=True, application_status="new", first_seen_at=AT, last_seen_at=AT, extra_json="{}", description="text")
    rows = [
        dict(id=1, url="1", title="Lead Scientist", score=90.0, is_remote=1),
        dict(id=2, url="2", title="100% remote_role", company="Beta", source="jobspy:linkedin", score=40.0, is_remote=0),
        dict(id=3, url="3", title="Sales", company="Gamma", is_relevant=False, score=99.0),
        dict(id=4, url="4", title="LEAD engineer É", score=None),
        dict(id=5, url="5", title="Skipped", score=95.0, application_status="skip"),
        dict(id=6, url="6", title="Tied", score=40.0, application_status="applied", is_remote=0),
        dict(id=7, url="7", title="Empty", score=None, description=" \t\r\n", source="jobspy:LinkedIn"),
        dict(id=8, url="8", title="Zero", score=0.0, first_seen_at=datetime(2026, 1, 1, tzinfo=timezone.utc)),
    ]
    return spark.createDataFrame([tuple({**defaults, **r}.get(f) for f in SNAPSHOT.fieldNames()) for r in rows], SNAPSHOT)


def ids(df):
    return [r.id for r in df.collect()]


def test_default_view(postings):
    assert ids(q.triage(postings)) == [1, 2, 6, 8, 4, 7]
    assert q.triage(postings).columns == list(q.SUMMARY)


@pytest.mark.parametrize(
    "filters, expected",
    [
        (dict(include_all=True), [3, 1, 2, 6, 8, 4, 7]),
        (dict(status="all"), [5, 1, 2, 6, 8, 4, 7]),
        (dict(status="skip"), [5]),
        (dict(status="applied"), [6]),
        (dict(companies=["Beta"]), [2]),
        (dict(companies=[], sources=[]), [1, 2, 6, 8, 4, 7]),
        (dict(companies=["beta"]), []),
        (dict(sources=["jobspy:linkedin"]), [2]),
        (dict(min_score=0), [1, 2, 6, 8]),
        (dict(max_score=40), [2, 6, 8]),
        (dict(min_score=40, max_score=40), [2, 6]),
        (dict(keyword="lead"), [1, 4]),
        (dict(keyword="%"), [2]),
        (dict(keyword="_"), [2]),
        (dict(keyword="é"), []),
        (dict(keyword=""), [1, 2, 6, 8, 4, 7]),
        (dict(remote="remote"), [1]),
        (dict(remote="onsite"), [2, 6]),
    ],
)
def test_filters(postings, filters, expected):
    assert ids(q.triage(postings, **filters)) == expected


def test_unknown_filter_values(postings):
    with pytest.raises(ValueError):
        q.triage(postings, status="gone")
    with pytest.raises(ValueError):
        q.triage(postings, remote="maybe")


def test_next_pointers(postings):
    found = {r.id: r.next_id for r in q.triage_with_next(postings).collect()}
    assert found == {1: 2, 2: 6, 6: 8, 8: 4, 4: 7, 7: None}
    for posting_id, following in found.items():
        assert [r.next_id for r in q.next_after(postings, posting_id).collect()] == [following]
    assert q.next_after(postings, 3).count() == 0


def test_skip_advances_within_the_filter(postings):
    rest = postings.filter("id <> 1")
    assert [r.next_id for r in q.next_after(rest, 2, companies=["Acme", "Beta"]).collect()] == [6]
    assert [r.next_id for r in q.next_after(rest, 7).collect()] == [None]


def test_options_and_details(postings):
    options = [(r.kind, r.value) for r in q.filter_options(postings).collect()]
    assert options == [
        ("company", "Acme"), ("company", "Beta"), ("company", "Gamma"),
        ("source", "greenhouse"), ("source", "jobspy:LinkedIn"), ("source", "jobspy:linkedin"),
    ]
    assert q.detail(postings, 3).first().title == "Sales" and q.detail(postings, 99).count() == 0
    assert q.detail(postings, 3).columns == list(q.DETAIL)


def test_work_lists(postings):
    assert [r.url for r in q.pending_score(postings).collect()] == ["4"]
    assert [r.url for r in q.missing_description(postings).collect()] == ["7"]
    assert q.backlog_count(postings).first().n == 1
    assert sorted(r.url for r in q.new_since(postings, date(2026, 1, 10)).collect()) == list("124567")
    assert [r.company for r in q.aggregator_companies(postings).collect()] == ["Acme", "Beta"]


def test_display(postings):
    shown = {r.id: (r.score_text, r.posted_text) for r in q.display(postings).collect()}
    assert shown[1] == ("90.0", "—") and shown[4][0] == "—"


def test_filters_reach_the_scan(spark, postings, root):
    postings.write.parquet(root)
    stored = spark.read.parquet(root)
    plan = plan_of(q.triage(stored, min_score=50))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(score,50.0)" in plan
    assert "description" not in plan
