from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import arrays, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    """Invented prose; one in six documents holds an insult, or words of one stem."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        toxic = i % 6 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["Idiot", "scum", "moron", "zubbelkop" + rng.choice(words)])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs, tables):
    rows, labels = tables
    chain = toxicity.fit(docs(rows), label_table(spark, labels[:600]))
    assert chain.names == ["insult", "contempt", "toxic"] and [len(e) for e in chain.earlier] == [0, 1, 2]
    out = {r.doc_id: r for r in toxicity.scores(docs(rows), chain, keep=["doc_id"]).collect()}
    wrong = [i for i, _, toxic in labels[600:] if out[i].toxic_rejected != bool(toxic)]
    assert len(wrong) <= 12
    clean = toxicity.clean(docs(rows), chain)
    assert clean.columns == docs(rows).columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in out.items() if not r.toxic_rejected}
    assert clean.first().toxic_rejected == "toxic_rejected"


def test_scores_are_the_chain_by_hand(spark, docs, tables):
    rows, labels = tables
    chain = toxicity.fit(docs(rows), label_table(spark, labels))
    texts = [t for _, t in rows[:20]]
    found = toxicity.predict_chain(chain, arrays.texts_of(pa.array(texts)), arrays.Hasher())
    for i, text in enumerate(texts):
        _, feature = toxicity.word_features(arrays.texts_of(pa.array([text])), arrays.Hasher())
        logits = []
        for k, (bias, weights, earlier) in enumerate(zip(chain.bias, chain.weights, chain.earlier)):
            p = 1 / (1 + np.exp(-(bias + weights[feature].sum() + sum(w * x for w, x in zip(earlier, logits)))))
            assert found[k][i] == pytest.approx(p, abs=1e-6)
            logits.append(toxicity._logit(np.array(p)))


def test_edges(spark, docs, edge_rows, tables):
    rows, labels = tables
    messy = labels + [(None, 1, 1), (5, None, None), (10_000_000, 1, 1), (0, 0, 1)]
    chain = toxicity.fit(docs(rows + edge_rows[:0]), label_table(spark, messy))
    assert toxicity.scores(docs(edge_rows), chain).count() == len(edge_rows)
    assert toxicity.scores(docs([]), chain).count() == 0
    # Without labels nothing is rejected.
    empty = toxicity.fit(docs(edge_rows), label_table(spark, []))
    assert toxicity.scores(docs(edge_rows), empty).where("toxic_rejected").count() == 0
    assert toxicity.clean(docs(edge_rows), empty).count() == len(edge_rows)


def test_sample_is_bounded_and_repeatable(spark, docs, tables):
    rows, labels = tables
    a, b = (toxicity.labelled(docs(rows), label_table(spark, labels), 50).collect() for _ in range(2))
    assert len(a) == 50 and {r.doc_id for r in a} == {r.doc_id for r in b}
