"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from roleweave.plans.catalogue import QUERIES
from roleweave.session import build_session

HEADLINE = (
    "triage_default",
    "triage_next",
    "filter_options",
    "relevance_flag",
    "relevance_default_rules",
    "remote_flag",
    "pending_score",
    "html_text",
    "feed_greenhouse",
    "feed_lever",
    "feed_ashby",
    "feed_workday",
    "feed_aggregator",
    "search_plan_capped",
    "upsert_snapshot",
    "store_round_trip",
    "stream_ingest",
    "score_writeback",
    "status_latest",
    "name_first_dedup",
    "detect_boards",
    "section_similarity",
    "fit_features",
    "spearman_zero_shot",
    "population_scaler",
    "document_frequency",
    "bow_top_terms",
    "ridge_cv",
    "elastic_cv",
    "gbt_cv",
    "bow_cv",
    "score_pending",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["failed_runs"](spark, folder).count()  # start the session before the clock
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # Every column of every row is computed; nothing is pruned as a count would.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
