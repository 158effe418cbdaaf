from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.sources.store import PostingStore
from roleweave.streaming.ingest import stream_statuses, stream_upserts

RULES = RelevanceRules(include=("NGS",), exclude=(), off_topic_titles=())


def test_landed_files_are_upserted_once(spark, root, batch):
    store = PostingStore(spark, f"{root}/store")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    calls = []

    def run():
        stream = spark.readStream.schema(batch(dict()).schema).parquet(landing)
        stream_upserts(stream, store, "greenhouse", checkpoint, RULES, after=lambda: calls.append(1)).awaitTermination()

    batch(dict(url="a", title="NGS"), dict(url="b")).write.mode("append").parquet(landing)
    run()
    run()  # nothing new
    batch(dict(url="a", title="changed")).write.mode("append").parquet(landing)
    run()
    assert {r.url: (r.title, r.id) for r in store.read().collect()} == {"a": ("changed", 1), "b": ("Bioinformatics Scientist", 2)}
    runs = sorted(store.runs().collect(), key=lambda r: r.started_at)
    assert [(r.fetched_count, r.new_count, r.updated_count) for r in runs] == [(2, 2, 0), (1, 0, 1)]
    assert len(calls) == 2


def test_status_stream(spark, root, batch):
    store = PostingStore(spark, f"{root}/store")
    store.upsert(batch(dict(url="a"), dict(url="b")), RULES, datetime(2026, 1, 1, tzinfo=timezone.utc))
    events = spark.createDataFrame(
        [("a", "applied", 1), ("a", "skip", 2), ("b", "nonsense", 3), ("z", "skip", 1)], "url string, status string, t int"
    ).select("url", "status", F.timestamp_seconds("t").alias("changed_at"))
    events.write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
    stream_statuses(stream, store, f"{root}/checkpoint").awaitTermination()
    assert {r.url: r.application_status for r in store.read().collect()} == {"a": "skip", "b": "new"}


def test_a_late_status_changes_nothing(spark, root, batch):
    store = PostingStore(spark, f"{root}/store")
    store.upsert(batch(dict(url="a")), RULES, datetime(2026, 1, 1, tzinfo=timezone.utc))
    for number, (status, t) in enumerate([("applied", 20), ("skip", 10), ("offer", 30), ("skip", 30)]):
        event = spark.createDataFrame([("a", status, t)], "url string, status string, t int")
        event.select("url", "status", F.timestamp_seconds("t").alias("changed_at")).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema("url string, status string, changed_at timestamp").parquet(f"{root}/events")
        stream_statuses(stream, store, f"{root}/checkpoint").awaitTermination()
        row = store.read().first()
        expected = ["applied", "applied", "applied", "skip"][number]
        assert row.application_status == expected, (number, row.application_status)


COMPANIES = "company_name string, ats_type string, board_identifier string, tenant string, site string, wd_subdomain string"


def job(number, title="NGS lead"):
    return f'{{"id":{number},"title":"{title}","absolute_url":"https://x/{number}","content":"text"}}'


def land(path, text):
    from pathlib import Path

    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text)


def test_raw_board_files_in_micro_batches(spark, root):
    """Three micro-batches give what one batch gives; a malformed file is kept as a reject, another board's file is left out."""
    from roleweave.plans.ingest import ingest
    from roleweave.sources.feeds import read_payloads
    from roleweave.streaming.ingest import stream_boards

    companies = spark.createDataFrame(
        [("Acme", "greenhouse", "acme", None, None, None), ("Bad", "greenhouse", "bad", None, None, None), ("Else", "lever", "else", None, None, None)], COMPANIES
    )
    landing, store = f"{root}/landing", PostingStore(spark, f"{root}/store")

    def run():
        stream_boards(companies, landing, store, "greenhouse", f"{root}/checkpoint", RULES).awaitTermination()

    for wave, files in enumerate([{"acme": f'{{"jobs":[{job(1)},{job(2)}]}}', "else": "[]"}, {"acme": f'{{"jobs":[{job(2, "changed")},{job(3)}]}}', "bad": "{oops"}, {"none": "{}"}]):
        for board, text in files.items():
            land(f"{landing}/{board}/{wave}.json", text)
        run()
        run()  # nothing new
    whole = PostingStore(spark, f"{root}/whole")
    ingest(whole, "greenhouse", {"companies": companies, "payloads": read_payloads(spark, landing)}, RULES)
    rows = lambda s: sorted((r.id, r.url, r.title, r.company, r.is_relevant) for r in s.read().collect())
    assert rows(store) == rows(whole) and [r[2] for r in rows(store)] == ["NGS lead", "changed", "NGS lead"]
    assert [r.company_name for r in store.rejects().collect()] == ["Bad"] == [r.company_name for r in whole.rejects().collect()]


def test_a_replayed_micro_batch_changes_nothing(spark, root):
    """The sink runs again for a batch that was stored: same rows, same rejects, one run of the log, no second score."""
    from roleweave.streaming import ingest as module

    store = PostingStore(spark, f"{root}/store")
    payloads = spark.createDataFrame([("Acme", f'{{"jobs":[{job(1)}]}}', "a/1"), ("Bad", "{oops", "b/1")], "company_name string, payload string, landed string")
    scored = []

    def scorer(own, key):
        scored.append(own.write_scores(own.pending_of(key).select("url", F.lit(0.5).alias("score"))))

    steps = (lambda b: module.board_postings(b, "greenhouse"), lambda b: module.board_rejects(b, "greenhouse"))
    apply = module._upserting(store, "greenhouse", "c", RULES, None, None, scorer, *steps)
    for _ in range(3):
        apply(payloads, 7)
    assert scored == [1, 0, 0]
    assert store.read().count() == store.rejects().count() == store.runs().count() == 1


def test_batches_are_scored_by_their_own_urls(spark, root, batch):
    """What an earlier batch left unscored isn't looked at; a posting that was scored isn't scored again."""
    store = PostingStore(spark, f"{root}/store")
    store.upsert(batch(dict(url="a", title="NGS"), dict(url="old", title="NGS"), dict(url="no")), RULES, batch_key="1")
    store.write_scores(spark.createDataFrame([("a", 1.0)], "url string, score double"))
    store.upsert(batch(dict(url="a", title="NGS again"), dict(url="b", title="NGS"), dict(url="c", title="NGS", description=" ")), RULES, batch_key="2")
    assert [r.url for r in store.pending_of("2").collect()] == ["b"]
    assert [r.url for r in store.pending_of("1").collect()] == ["old"]
    assert store.pending_of("3").count() == 0
    plan = store.pending_of("2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "number" in plan
