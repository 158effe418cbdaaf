from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import arrays, packing


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def expected_pieces(tokenizer, rows, limit):
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), limit)):
            cut = ids[at : at + limit]
            out.append((doc, k, at, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes())))
    return out


def check(out, capacity, expected):
    assert sorted([tuple(r)[:5] for r in out], key=str) == sorted(expected, key=str)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(own) <= capacity.documents
        assert sum(n * n for _, n in own) <= capacity.attention
    return len(sequences)


def one_by_one(lengths, capacity):
    """The same rule, piece by piece and sequence by sequence."""
    bins, limits = [], capacity.limits()
    for length in sorted(lengths, reverse=True):
        asked = np.array([length, 1, length * length])
        fits = [i for i, b in enumerate(bins) if (b >= asked).all()]
        if fits:
            scores = packing.scored(np.array([bins[i] for i in fits]), asked, capacity)
            bins[fits[int(np.argmin(scores))]] -= asked
        else:
            bins.append(limits - asked)
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(64, 4096), (3, 4096), (64, 1500), (5, 1800)])
def test_plan_equals_piece_by_piece(rule, documents, attention):
    rng = random.Random(documents + attention)
    capacity = packing.Capacity(64, documents, attention, (1.0, 0.3, 0.2), rule)
    for _ in range(20):
        lengths = [min(rng.choice([3, 9, 30, 60]) + rng.randint(0, 4), capacity.longest()) for _ in range(rng.randint(1, 200))]
        made = packing.plan(Counter(lengths), capacity)
        assert made.sequences == len(one_by_one(lengths, capacity))


def test_plan_size_follows_lengths_and_not_documents():
    counts = {n: 10**9 + n for n in range(1, 4097)}
    made = packing.plan(counts, packing.Capacity())
    assert len(made.length) < 20 * len(counts)
    least = -(-sum(k * n for k, n in counts.items()) // 4096)
    assert made.sequences <= 1.001 * least


def test_whole_table(spark, tokenizer):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    expected = expected_pieces(tokenizer, rows, 4096)
    n = check(packing.packed(table, packing.load()).collect(), packing.Capacity(), expected)
    assert n <= -(-sum(p[3] for p in expected) // 4096) + 1


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(50, 3, 900), packing.Capacity(4096, 2, 4096**2, (0.2, 1, 0.1), "dot")])
def test_edges(docs, edge_rows, tokenizer, capacity):
    """Null, empty and very long texts, equal rows, shared and null ids, several capacities."""
    rows = edge_rows + [(None, "x"), (20, "It's we'll 12345!? é ﬁ İ Σας <|endoftext|>, a\tb\r\nc\x0bd　e"), (21, "stop. STOP, stop.. (stop)")]
    out = packing.packed(docs(rows), packing.load(), capacity).collect()
    check(out, capacity, expected_pieces(tokenizer, rows, capacity.longest()))


def test_one_common_length(docs, tokenizer):
    rows = [(i % 7, "same words here") for i in range(3000)]
    n = check(packing.packed(docs(rows), packing.load(), packing.Capacity(40)).collect(), packing.Capacity(40), expected_pieces(tokenizer, rows, 40))
    assert n == 300


def encoded(words, texts):
    return [x.tolist() for x in words.of(arrays.texts_of(pa.array(texts, pa.string())))]


MIXED = ["alpha", "Beta.", "ÉTÉ,", "x" * 70, "eta,", "naïve", "×", "a÷b", "ÿß!", "don't", "a.b", "..", ".", "Ÿ", "e\u0301", "straße?", "1st", "ǅ"]


@pytest.mark.parametrize("held", [5, 40, 400_000])
def test_words_are_forgotten_beyond_the_bound(tokenizer, monkeypatch, held):
    monkeypatch.setattr(packing, "WORDS_HELD", held)
    rng = random.Random(4)
    texts = [rng.choice(" \n\t\r").join(rng.choice(MIXED) + rng.choice(["", "", "a", "3"]) for _ in range(20)) for _ in range(100)]
    words = packing.load()
    for i in range(0, 100, 5):
        assert encoded(words, texts[i : i + 5]) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[i : i + 5]]


def test_hashes_that_collide(tokenizer, monkeypatch):
    words = packing.load()
    texts = ["one two three. Three", "four"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoded(words, texts) == expected
    monkeypatch.setattr(words._words.hasher, "spans", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert encoded(words, texts) == expected


def test_whole_texts_give_the_same(tokenizer):
    import public_tokenizers

    texts = ["One two, three.", None, "", "a  b\n\nc"]
    whole = packing.Encoder(public_tokenizers.path(packing.TOKENIZER), apart=False)
    assert encoded(whole, texts) == encoded(packing.load(), texts) == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_empty_table_and_ids(docs):
    assert packing.packed(docs([]), packing.load()).count() == 0
    (row,) = packing.pieces(docs([(1, "a b")]), packing.load(), 4096, with_ids=True).collect()
    assert len(row.ids) == row.length and row.ids[-1] == 1


def test_too_small_a_capacity_is_refused():
    with pytest.raises(ValueError, match="exceeds"):
        packing.plan({9: 1}, packing.Capacity(8))
