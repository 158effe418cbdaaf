from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from compare import difference, oracle_connection
from conftest import SMALL
from corpus_fixtures import docs, edge_rows  # noqa: F401

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from roleweave.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) < set(QUERIES) < set(queries()) and set(ORACLE_SQL) < set(oracle_sql())
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    out = QUERIES[name](spark, SMALL)
    if name in ORACLE_SQL:
        assert difference(out, oracle_connection(SMALL), ORACLE_SQL[name]) is None
    else:
        table = "pages" if name.startswith("op2") else "documents"
        rows = out.select("doc_id").distinct() if name.startswith("op12") else out
        assert rows.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_stages_take_effect(spark):
    from roleweave.llm import decontaminate, jaccard, pieces, secrets
    from roleweave.session import stage

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "secrets", "sentencepiece"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, []
    for _, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SMALL), "test")
        assert docs.columns[: len(columns)] == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[2] > 0
    assert docs.where("round_trip").count() == counts[-1]
    plain = docs.select(*columns)
    assert jaccard.groups(plain).where("doc_id <> component_id").count() == 0
    assert decontaminate.contamination(plain, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated").count() == 0
    assert secrets.digest(secrets.secret_spans(plain)).where("n_assign + n_access + n_hex > 0").count() == 0
    assert pieces.encoded(plain, pieces.load()).count() == counts[-1]


@pytest.mark.parametrize("place", range(5))
def test_stages_on_edges(spark, docs, edge_rows, place):
    _, apply = corpus_pipeline.STAGES[place]
    clashing = {c: F.lit(c) for c in ("decoded", "piece_ids", "n_pieces", "round_trip")}
    out = apply(spark, docs(edge_rows).withColumns(clashing), SMALL)
    assert set(docs([]).columns) <= set(out.columns) and out.count() > 0
    assert all(r[c] == c for r in out.select(*clashing).collect() for c in clashing)
    assert apply(spark, docs([]), SMALL).count() == 0
