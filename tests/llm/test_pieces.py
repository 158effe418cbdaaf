from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
import sentencepiece
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import pieces

ALPHABET = ["a", "b", "t", "h", "e", " ", "  ", "\n", "é", "☃", "the", "ing", "0", "1", "\t", "▁", "in", "tion", "//", "==", "--", "er", "梦", "²", "."]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def test_equals_the_model_on_random_texts(vocabulary, model):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    found = pieces.WordTable(vocabulary).encode(texts)
    decoder = pieces.Decoder(vocabulary)
    assert [x.tolist() for x in found] == model.encode(texts)
    assert [decoder.text(x) for x in found] == [model.decode(x.tolist()) for x in found]


def test_unigram_path_is_the_best_of_all():
    rng = random.Random(4)
    names = {"".join(p) for n in (1, 2, 3) for p in itertools.product("ab▁", repeat=n)}
    ids = {p: i for i, p in enumerate(sorted(names))}
    scores = {p: -rng.random() * (1 + len(p)) for p in ids}
    encoder = pieces.Encoder(pieces.Vocabulary(ids, scores, list(range(100, 356)), byte_pair=False))

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores)

    for word in sorted("".join(rng.choice("ab▁") for _ in range(rng.randint(1, 9))) for _ in range(200)):
        path = encoder.pieces(word)
        assert "".join(path) == word and sum(scores[p] for p in path) == pytest.approx(best(word))


def test_shared_prefixes_change_nothing(vocabulary):
    words = ["▁thing", "▁things", "▁thin", "▁the", "▁", "▁▁the", "zebra", "zeb", "zebras", "zebra"]
    shared, apart = pieces.Encoder(vocabulary), lambda w: pieces.Encoder(vocabulary).pieces(w)
    assert [shared.pieces(w) for w in words] == [apart(w) for w in words]


def test_query_and_edges(docs, edge_rows, vocabulary, model):
    out = pieces.round_trips(docs(edge_rows), vocabulary).collect()
    assert len(out) == len(edge_rows)
    texts = dict(edge_rows)
    for row in out:
        text = texts[row.doc_id]
        if text is None:
            assert row.n_pieces is None and row.round_trip is None
        else:
            ids = model.encode(text)
            assert row.n_pieces == len(ids) and row.round_trip
            assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<i4").tobytes()).hexdigest()
    assert pieces.round_trips(docs([]), vocabulary).count() == 0


def test_columns_and_decoding(docs, edge_rows, vocabulary):
    table = docs(edge_rows)
    coded = pieces.encoded(table, vocabulary)
    assert coded.columns == [*table.columns, "piece_ids"]
    back = pieces.decoded(coded, vocabulary)
    assert back.where("not (decoded <=> text)").count() == 0
    assert pieces.encoded(coded, vocabulary).columns == coded.columns


def test_one_pass_equals_encoding_and_decoding(docs, edge_rows):
    from pyspark.sql import functions as F

    from roleweave.llm import pieces

    vocabulary, table = pieces.load(), docs(edge_rows).drop("piece_ids", "decoded", "n_pieces", "round_trip")
    found = pieces.tokenized(table, vocabulary)
    other = pieces.decoded(pieces.encoded(table, vocabulary), vocabulary)
    other = other.select(*table.columns, "piece_ids", F.size("piece_ids").alias("n_pieces"), (F.col("decoded") == F.col("text")).alias("round_trip"))
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.collect()))
    assert rows(found) == rows(other)
