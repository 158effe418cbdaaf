from __future__ import annotations

import random
from datetime import datetime, timezone

import pytest
from conftest import day
from pyspark.sql import Row
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.operators.upsert import collapse
from roleweave.operators.writeback import latest_status, rows_updated, split_status_events, write_descriptions
from roleweave.plans.ingest import backfill_descriptions, backfill_relevance, backfill_remote, ingest, set_status
from roleweave.schemas import SNAPSHOT_COLUMNS, conform
from roleweave.session import stage
from roleweave.sources.store import BatchRejected, PostingStore

RULES = RelevanceRules(include=("bioinformatics", "NGS"), exclude=("data entry",), off_topic_titles=("sales",))
T1 = datetime(2026, 1, 1, tzinfo=timezone.utc)
T2 = datetime(2026, 1, 2, tzinfo=timezone.utc)


@pytest.fixture
def store(spark, root):
    return PostingStore(spark, root)


def by_url(store):
    return {r.url: r for r in store.read().collect()}


def test_insert_then_update(store, batch):
    first = store.upsert(
        batch(dict(raw_id="1", posted_date=day("2026-01-01"), extra_json='{"a":1}', location="Remote")), RULES, T1
    )
    assert tuple(first) == (1, 1, 0)
    row = by_url(store)["https://example.com/1"]
    assert row.first_seen_at == row.last_seen_at
    assert (row.id, row.application_status, row.score, row.is_remote, row.is_relevant) == (1, "new", None, 1, True)

    second = store.upsert(
        batch(dict(title="Sales Lead", raw_id="2", company="Other", source="lever", location=None, extra_json='{"b":2}', description="")),
        RULES,
        T2,
    )
    assert tuple(second) == (1, 0, 1)
    row = by_url(store)["https://example.com/1"]
    assert (row.title, row.description, row.is_relevant, row.is_remote) == ("Sales Lead", "", False, None)
    assert (row.raw_id, row.company, row.source, row.extra_json) == ("1", "Acme", "greenhouse", '{"a":1}')
    assert row.posted_date == day("2026-01-01")
    assert row.first_seen_at < row.last_seen_at


def test_duplicates_inside_a_batch(store, batch):
    stats = store.upsert(
        batch(
            dict(url="u", raw_id="first", title="Bioinformatics", company="A"),
            dict(url="u", raw_id="second", title="Sales", company="B", description=None),
            dict(url="v"),
        ),
        RULES,
        T1,
    )
    assert tuple(stats) == (3, 2, 1)
    row = by_url(store)["u"]
    assert (row.raw_id, row.company, row.title, row.description, row.is_relevant) == ("first", "A", "Sales", None, False)


def test_empty_url_is_one_key(store, batch):
    store.upsert(batch(dict(url="", company="A"), dict(url="", company="B")), RULES, T1)
    assert [r.company for r in store.read().collect()] == ["A"]


def test_scores_and_status_survive(spark, store, batch):
    store.upsert(batch(dict()), RULES, T1)
    scores = stage(spark.createDataFrame([("https://example.com/1", 0.42), ("unknown", 1.0)], "url string, score double"), "s")
    assert rows_updated(store.read(), scores).first().updated_count == 1
    assert store.write_scores(scores) == 1
    events = spark.createDataFrame([("https://example.com/1", "applied", T1)], "url string, status string, changed_at timestamp")
    store.write_statuses(latest_status(events))
    store.upsert(batch(dict(description="new text")), RULES, T2)
    row = by_url(store)["https://example.com/1"]
    assert (row.score, row.application_status, row.description) == (0.42, "applied", "new text")
    assert row.application_status_updated_at is not None


def test_null_title_rejects_the_whole_batch(store, batch):
    store.upsert(batch(dict(url="kept")), RULES, T1)
    with pytest.raises(BatchRejected):
        store.upsert(batch(dict(url="a"), dict(url="b", title=None)), RULES, T2)
    assert set(by_url(store)) == {"kept"}


def test_batch_key_is_applied_once(store, batch):
    store.upsert(batch(dict(title="NGS")), RULES, T1, batch_key="k")
    again = store.upsert(batch(dict(title="changed")), RULES, T2, batch_key="k")
    assert tuple(again) == (1, 1, 0)
    assert by_url(store)["https://example.com/1"].title == "NGS"
    assert store.has_batch("k") and not store.has_batch("other")


def test_filled_descriptions_can_be_kept(store, batch):
    store.upsert(batch(dict(description="full")), RULES, T1)
    store.upsert(batch(dict(description=" \n")), RULES, T2, keep_filled_descriptions=True)
    assert by_url(store)["https://example.com/1"].description == "full"


def test_empty_batch(store, batch):
    assert tuple(store.upsert(batch(dict()).filter("false"), RULES, T1)) == (0, 0, 0)
    assert store.read().count() == 0


def test_large_batch_path_gives_the_same(spark, root, batch, monkeypatch):
    import roleweave.sources.store as module

    rows = [dict(url=f"u{i % 7}", title=f"NGS {i}", raw_id=str(i)) for i in range(20)]
    stores = []
    for small in (True, False):
        monkeypatch.setattr(module, "fits_broadcast", lambda size, small=small: small)
        store = PostingStore(spark, f"{root}/{small}")
        store.upsert(batch(*rows[:9]), RULES, T1)
        store.upsert(batch(*rows[9:]), RULES, T2)
        stores.append(sorted(tuple(r) for r in store.read().select("id", "url", "title", "raw_id", "first_seen_at").collect()))
    assert stores[0] == stores[1]


class Sequential:
    """Row-by-row reference model."""

    def __init__(self):
        self.rows, self.next_id = {}, 1

    def apply(self, batch, now):
        new = 0
        for row in batch:
            old = self.rows.get(row["url"])
            if old is None:
                self.rows[row["url"]] = dict(row, id=self.next_id, first=now, last=now)
                self.next_id += 1
                new += 1
            else:
                old.update(title=row["title"], location=row["location"], last=now)
        return len(batch), new, len(batch) - new


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_matches_sequential_upserts(store, batch, seed):
    rng = random.Random(seed)
    model = Sequential()
    for number, now in enumerate((T1, T2)):
        rows = []
        for i in range(60):
            # One URL holds a third of the batch.
            url = "hot" if rng.random() < 0.33 else f"u{rng.randint(0, 25)}"
            rows.append(
                dict(url=url, title=f"t{number}-{i}", location=rng.choice([None, "Remote", "Boston"]), raw_id=f"{number}-{i}")
            )
        assert tuple(store.upsert(batch(*rows), RULES, now)) == model.apply(rows, now)
    found = {
        r.url: (r.id, r.title, r.location, r.raw_id, r.first_seen_at == r.last_seen_at) for r in store.read().collect()
    }
    expected = {
        u: (r["id"], r["title"], r["location"], r["raw_id"], r["first"] == r["last"]) for u, r in model.rows.items()
    }
    assert found == expected


def test_collapse_reduces_before_the_shuffle(batch):
    plan = collapse(batch(dict()), RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") and plan.index("partial_min_by") > plan.index("Exchange hashpartitioning(url")


def test_ingest_logs_runs(spark, store, batch):
    rows = spark.createDataFrame([("linkedin", "Acme", "NGS lead", "https://x/1", 0)], "site string, company string, title string, job_url string, arrival int")
    stats = ingest(store, "jobspy", {"rows": rows}, RULES, T1)
    assert tuple(stats) == (1, 1, 0)
    broken = rows.withColumn("job_url", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        ingest(store, "jobspy", {"rows": broken}, RULES, T2)
    with pytest.raises(ValueError, match="unsupported source"):
        ingest(store, "monster", {})
    runs = sorted(store.runs().collect(), key=lambda r: r.started_at)
    assert [(r.source, r.fetched_count, r.new_count, r.updated_count) for r in runs] == [("jobspy", 1, 1, 0), ("jobspy", None, None, None)]
    assert [r.id for r in runs] == [1, 2]
    assert runs[0].error is None and "unreadable" in runs[1].error


def test_a_known_batch_is_logged_once(spark, store):
    rows = spark.createDataFrame([("linkedin", "Acme", "lead", "https://x/1", 0)], "site string, company string, title string, job_url string, arrival int")
    for _ in range(2):
        assert tuple(ingest(store, "jobspy", {"rows": rows}, RULES, T1, batch_key="k")) == (1, 1, 0)
    assert [(r.id, r.source, r.fetched_count) for r in store.runs().collect()] == [(1, "jobspy", 1)]
    # The log is what makes the rows visible: nothing else had to be written for it.
    assert store.log().where("run_id = 1 and number = 1").count() == 1 == store.log().count()


def test_dropped_payloads_are_kept_as_rejects(spark, store):
    companies = spark.createDataFrame(
        [("Good", "lever", "good", None, None, None), ("Bad", "lever", "bad", None, None, None)],
        "company_name string, ats_type string, board_identifier string, tenant string, site string, wd_subdomain string",
    )
    payloads = spark.createDataFrame(
        [("good", '[{"id":"1","text":"t","hostedUrl":"https://x/1"}]', "good/1.json"), ("bad", "{oops", "bad/1.json")],
        "board string, payload string, landed string",
    )
    assert ingest(store, "lever", {"companies": companies, "payloads": payloads}, RULES, T1).new_count == 1
    assert [(r.source, r.company_name, r.landed) for r in store.rejects().collect()] == [("lever", "Bad", "bad/1.json")]


def test_recompute_flags(store, batch):
    store.upsert(batch(dict(url="a", location="Remote"), dict(url="b", title="Sales", location=None)), RULES, T1)
    rules = RelevanceRules(include=("sales",), exclude=(), off_topic_titles=())
    assert backfill_relevance(store, rules) == 2
    store.rewrite(lambda df: df.withColumn("location", F.lit("Hybrid")))
    assert backfill_remote(store) == 2
    rows = by_url(store)
    assert (rows["a"].is_relevant, rows["b"].is_relevant) == (False, True)
    assert (rows["a"].is_remote, rows["b"].is_remote) == (0, 0)


def test_set_status(store, batch):
    store.upsert(batch(dict(url="a"), dict(url="b")), RULES, T1)
    set_status(store, "a", "skip", T2)
    set_status(store, "unknown", "applied", T2)
    assert {u: r.application_status for u, r in by_url(store).items()} == {"a": "skip", "b": "new"}
    with pytest.raises(ValueError):
        set_status(store, "a", "bogus")


def test_backfill_descriptions(spark, store, batch):
    store.upsert(
        batch(
            dict(url="1", source="jobspy:linkedin", description="", title="NGS"),
            dict(url="2", source="jobspy:linkedin", description="filled", title="NGS"),
            dict(url="3", source="jobspy:linkedin", description="", title="Sales"),
            dict(url="4", source="jobspy:indeed", description="", title="NGS"),
            dict(url="5", source="JobSpy:LinkedIn", description=None, title="NGS"),
        ),
        RULES,
        T1,
    )
    fetched = spark.createDataFrame([(u, "text") for u in "124"] + [("5", "")], "url string, description string")
    assert backfill_descriptions(store, fetched) == Row(attempted_count=2, updated_count=1)
    assert {u: r.description for u, r in by_url(store).items()} == {"1": "text", "2": "filled", "3": "", "4": "", "5": None}


def test_write_descriptions_ignores_unknown_and_empty(spark, store, batch):
    store.upsert(batch(dict(url="a", description="old")), RULES, T1)
    changes = spark.createDataFrame([("a", ""), ("z", "x")], "url string, description string")
    assert write_descriptions(store.read(), changes).first().description == "old"


def test_status_events(spark):
    rows = [("a", "applied", 1), ("a", "skip", 2), ("a", "bogus", 3), ("b", None, 1)]
    events = spark.createDataFrame(rows, "url string, status string, changed_at int")
    valid, rejected = split_status_events(events)
    assert valid.count() == 2 and rejected.count() == 2
    assert [(r.url, r.status) for r in latest_status(events).collect()] == [("a", "skip")]


def test_conform_older_table(spark):
    older = spark.createDataFrame([(1, "u", "t")], "id int, url string, title string")
    row = conform(older).first()
    assert list(row.asDict()) == SNAPSHOT_COLUMNS
    assert (row.id, row.application_status, row.score, row.is_remote) == (1, "new", None, None)


def test_a_batch_writes_its_own_rows_only(store, batch):
    """One change for each URL of a batch, however many postings are stored; only new ones say what is fixed."""
    store.upsert(batch(*[dict(url=f"u{i}") for i in range(50)]), RULES, T1)
    store.upsert(batch(dict(url="u7", title="NGS"), dict(url="new")), RULES, T2)
    second = {r.url: r for r in store.changes().where("number = 2").collect()}
    assert set(second) == {"u7", "new"} and second["u7"].first is None and second["new"].first.id == 51
    assert (second["u7"].kind, second["new"].kind) == ("seen", "first")


def test_a_write_that_broke_off_is_not_read(spark, store, batch):
    """Changes without their row of the log: unseen, and replaced by the next write."""
    store.upsert(batch(dict(url="a", title="one")), RULES, T1)
    before = [tuple(r) for r in store.read().collect()]
    broken = store.changes().drop("number").withColumn("seen", F.struct(F.lit("lost").alias("title"), F.lit(None).cast("string").alias("location"), F.lit(T2).alias("last_seen_at")))
    broken.write.partitionBy("kind").parquet(f"{store.root}/changes/number=2")
    assert [tuple(r) for r in store.read().collect()] == before
    store.upsert(batch(dict(url="b")), RULES, T2)
    assert {u: r.title for u, r in by_url(store).items()} == {"a": "one", "b": "Bioinformatics Scientist"}
    assert by_url(store)["b"].id == 2


def test_compaction_keeps_everything(spark, root, store, batch):
    store.upsert(batch(dict(url="a", location="Remote"), dict(url="b"), dict(url="c", description=None)), RULES, T1, batch_key="k")
    store.write_scores(spark.createDataFrame([("a", 0.5)], "url string, score double"))
    set_status(store, "b", "skip", T2)
    store.upsert(batch(dict(url="a", title="Sales"), dict(url="d")), RULES, T2)
    small = store.compacted(f"{root}/small")
    rows = lambda s: sorted((tuple(r) for r in s.read().collect()), key=str)
    assert rows(small) == rows(store) and small.changes("first").count() == 4
    # Both go on alike.
    for s in (store, small):
        assert s.has_batch("k")
        s.upsert(batch(dict(url="b", title="NGS"), dict(url="e")), RULES, T2)
        set_status(s, "b", "applied", T1)  # late
        s.write_scores(spark.createDataFrame([("b", 0.7), ("zz", 1.0)], "url string, score double"))
    assert rows(small) == rows(store) and by_url(small)["e"].id == 5 and by_url(small)["b"].application_status == "skip"
    assert PostingStore(spark, f"{root}/none").compacted(f"{root}/none2").read().count() == 0


def test_a_busy_url_is_reduced_before_the_shuffle(store, batch):
    store.upsert(batch(dict()), RULES, T1)
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(url") < plan.index("partial_max_by") and plan.count("Exchange") == 1


def test_a_change_without_a_time_takes_the_stored_one(spark, store, batch):
    store.upsert(batch(dict(url="a")), RULES, T1)
    set_status(store, "a", "applied", T2)
    late = spark.createDataFrame([("a", "skip", None)], "url string, status string, changed_at timestamp")
    store.write_statuses(late)
    row = by_url(store)["a"]
    assert row.application_status == "skip" and row.application_status_updated_at is not None
