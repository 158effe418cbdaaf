from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import backoff

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 5 == 1


class Brute:
    """The same model with dictionaries, one token after the other."""

    def __init__(self, texts):
        self.c = [None] + [Counter() for _ in range(backoff.ORDER)]
        for text in texts:
            t = tokens(text)
            for n in range(1, backoff.ORDER + 1):
                self.c[n].update(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
        self.n, self.v = sum(self.c[1].values()), len(self.c[1])
        self.arcs = [None, None] + [{g: k for g, k in self.c[n].items() if k >= backoff.LEAST} for n in range(2, backoff.ORDER + 1)]
        self.after = {}
        for n in range(2, backoff.ORDER + 1):
            for g in self.arcs[n]:
                self.after.setdefault(g[:-1], []).append(g)

    def p(self, context, word):
        if not context:
            return (self.c[1][(word,)] + 0.5) / (self.n + 0.5 * (self.v + 1))
        own = self.after.get(context)
        if not own:
            return self.p(context[1:], word)
        n = len(context)
        below, gram = self.c[n][context], context + (word,)
        arc = (self.c[n + 1][gram] - backoff.DISCOUNT) / below if gram in own else 0
        left = 1 - sum((self.c[n + 1][g] - backoff.DISCOUNT) / below for g in own)
        return arc + left * self.p(context[1:], word)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(tuple(t[max(0, i - backoff.ORDER + 1) : i]), w)) for i, w in enumerate(t))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    text = lambda: " ".join(rng.choice(words[: rng.choice([3, 8, 40])]) for _ in range(rng.randint(0, 25)))
    return [(i, text()) for i in range(160)] + [(500, "never seen zzz"), (7, "w1 W2 w1")]


def test_equals_brute_force(docs, edge_rows, rows):
    every = rows + [(1000 + i, t) for i, t in edge_rows if i is not None and i < 9] + [(None, "w1 w2 w3")]
    model = Brute([t for i, t in every if not held(i)])
    expected = []
    for doc, text in every:
        t = tokens(text)
        base = sum(math.log10((model.c[1][(w,)] + 0.5) / (model.n + 0.5 * (model.v + 1))) for w in t)
        expected.append((doc, held(doc), len(t), sum(model.c[1][(w,)] > 0 for w in t), model.n, round(base, 6), round(model.score(text), 6)))
    out = [(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in backoff.scores(docs(every)).collect()]
    assert sorted(out, key=str) == sorted(expected, key=str)


def test_every_state_sums_to_one(docs, rows):
    model = Brute([t for i, t in rows if not held(i)])
    words = [w for (w,) in model.c[1]]
    for context in list(model.after)[:40]:
        unseen = 0.5 / (model.n + 0.5 * (model.v + 1))
        scale = model.p(context, "zzz") / model.p((), "zzz")
        assert sum(model.p(context, w) for w in words) + scale * unseen == pytest.approx(1)


def test_held_out_texts_score_better_than_by_words_alone(spark):
    from conftest import SMALL

    table = backoff.scores(spark.read.parquet(f"{SMALL}/documents.parquet"))
    row = table.where("held_out").selectExpr("sum(score) as score", "sum(base_score) as base").first()
    assert row.score > row.base


def test_empty_and_all_held_out(docs):
    assert backoff.scores(docs([])).count() == 0
    ids = [i for i in range(60) if held(i)]
    out = backoff.scores(docs([(i, "a b") for i in ids])).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(0) for r in out) and len(out) == len(ids)


@pytest.mark.parametrize("bits", [backoff.FILTER_BITS, 6])
def test_rare_ngrams_are_kept_at_any_size(docs, rows, monkeypatch, bits):
    """N-grams far below RATE of all tokens have arcs, however few values the tasks hold and however full the filters are."""
    least = Brute([t for i, t in rows if not held(i)])
    expected = {i: round(least.score(t), 6) for i, t in rows}
    monkeypatch.setattr(backoff, "RATE", 0.02)
    monkeypatch.setattr(backoff, "FILTER_BITS", bits)
    assert {r.doc_id: round(r.score, 6) for r in backoff.scores(docs(rows)).collect()} == expected


def test_blocks_and_batches_of_any_size(spark, docs, rows, monkeypatch):
    """Small blocks ask for nearly all values; their answers and texts come in batches of a few rows, across blocks."""
    model = Brute([t for i, t in rows if not held(i)])
    monkeypatch.setattr(backoff, "RATE", 0.02)
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 300)
    monkeypatch.setattr(backoff, "BUCKET_ROWS", 9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = {r.doc_id: round(r.score, 6) for r in backoff.scores(docs(rows).coalesce(2)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == {i: round(model.score(t), 6) for i, t in rows}


def test_orders_are_counted_apart_and_asked_for_by_their_values(docs, rows, monkeypatch):
    """A shuffle holds one order; blocks ask by a filter of what has a value, however full those of counting are."""
    import numpy as np

    monkeypatch.setattr(backoff, "FILTER_BITS", 12)
    rng = random.Random(3)
    every = docs(rows + [(1000 + i, " ".join(f"x{rng.random()}" for _ in range(40))) for i in range(200)])
    open_filter = lambda: np.full((1 << 12) // 8, 255, np.uint8)
    model = Brute([r.text for r in every.collect() if not held(r.doc_id)])
    pairs, triples = ([r.n for r in backoff.counts(every, [open_filter] * (n - 1), n, 3).where("context <> 0").collect()] for n in (2, 3))
    assert sorted(pairs) == sorted(model.arcs[2].values()) and sorted(triples) == sorted(model.arcs[3].values())
    table, filters = backoff.values(every)
    keys = np.array([r.token for r in table.where("known = 0").collect()], dtype=np.int64).view(np.uint64)
    for get in filters:
        assert backoff.passes(get(), keys).all()
        assert np.unpackbits(get()).sum() <= len(keys) < (1 << 12) / 2


def test_values_of_many_buckets_and_flushes(docs, rows, monkeypatch):
    """Counts and arcs meet from many lists of a bucket; what passes Spark is one short list per bucket, not a row per n-gram."""
    monkeypatch.setattr(backoff, "BUCKET_BYTES", 500)
    monkeypatch.setattr(backoff, "SUMMED", 100)
    monkeypatch.setattr(backoff, "BUCKET_ROWS", 30)
    monkeypatch.setattr(backoff, "RATE", 0.02)
    model = Brute([t for i, t in rows if not held(i)])
    found, _ = backoff.value_lists(docs(rows))
    lists, table = found.collect(), backoff.values(docs(rows))[0].collect()
    assert len({r.bucket for r in lists}) == len(lists) > 5
    assert sum(r["size"] for r in lists) == len(table) and sum(len(r.data) for r in lists) < 16 * len(table)
    assert (sum(r.tokens for r in lists), sum(r.words for r in lists)) == (model.n, model.v)
    assert sorted(r.n for r in table) == sorted([*model.c[1].values(), *model.arcs[2].values(), *model.arcs[3].values()])
    expected = sorted((sum(model.c[len(g[0])][x] for x in g), len(g)) for g in model.after.values())
    assert sorted((r.out, r.arcs) for r in table if r.arcs) == expected
    out = {r.doc_id: round(r.score, 6) for r in backoff.scores(docs(rows)).collect()}
    assert out == {i: round(model.score(t), 6) for i, t in rows}


def test_lists_take_the_bytes_that_their_numbers_need():
    import numpy as np

    rng = np.random.default_rng(5)
    for columns in (
        [np.zeros(0, np.int64)] * 3,
        [np.zeros(4, np.int64), np.arange(4) * 90],
        [np.array([0, 2**64 - 1], np.uint64), np.array([255, 256])],
        [backoff.steps(np.sort(rng.integers(0, 2**64, 1000, np.uint64))), rng.integers(0, 256, 1000)],
    ):
        data = backoff.packed(columns)
        got = backoff.unpacked(data, len(columns))
        assert all((a == b.astype(np.uint64).view(np.int64)).all() and len(a) == len(b) for a, b in zip(got, columns))
    assert len(data) <= 1000 * 9 + 2
    keys = rng.integers(0, 50, 1000).astype(np.uint64)
    own, at = backoff.numbered(keys)
    assert (own[at] == keys).all() and (own == np.unique(keys)).all() and (backoff.distinct(keys) == own).all()


def test_a_crowded_filter_halves_the_lists(docs, rows, monkeypatch):
    """When nearly all n-grams pass the filter, a shuffle holds the lists and values of one half of the hashes only."""
    monkeypatch.setattr(backoff, "FILTER_BITS", 6)
    monkeypatch.setattr(backoff, "RATE", 0.02)
    monkeypatch.setattr(backoff, "BUCKET_ROWS", 30)
    monkeypatch.setattr(backoff, "ANSWER_BYTES", 200)
    model = Brute([t for i, t in rows if not held(i)])
    staged, plain = [], backoff.stage

    def stage(df, name):
        staged.append((name, plain(df, name)))
        return staged[-1][1]

    monkeypatch.setattr(backoff, "stage", stage)
    out = {r.doc_id: round(r.score, 6) for r in backoff.scores(docs(rows)).collect()}
    assert out == {i: round(model.score(t), 6) for i, t in rows}
    halves = [{r.bucket for r in table.collect()} for name, table in staged if name == "lm_answers"]
    assert len(halves) == 2 and min(map(len, halves)) > 3 and max(halves[0]) < min(halves[1])
