from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import arrays, suffixes

LENGTH = suffixes.LENGTH


def brute(rows):
    """Documents in order of their ids; rows that share an id are one document whose equal places don't count."""
    first, data = {}, [(suffixes.LAST_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for doc, x in data:
        for s in range(len(x) - LENGTH + 1):
            key = x[s : s + LENGTH]
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for (doc, x), (own, _) in zip(data, rows):
        gone = bytearray(len(x))
        for s in range(len(x) - LENGTH + 1):
            if first[x[s : s + LENGTH]] != (doc, s):
                gone[s : s + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for p in range(len(x)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((own, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(14)
    words = ["alpha", "beta", "ga", "délta", "e", "zeta,", "eta.\n", "thêta", "io"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(40) for _ in range(5)]
    out = []
    for i in range(90):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts.insert(rng.randint(0, len(parts)), p[a : a + rng.randint(60, 200)])
        out.append((i, rng.choice(["", " "]).join(parts)))
    out += [(200, out[3][1]), (201, out[3][1] + "!"), (202, "ab" * 150), (203, "x" * 500), (204, "x" * 99), (205, "x" * 100)]
    return out


@pytest.mark.parametrize("most", [suffixes.MOST_OF_ANCHOR, 1])
def test_equals_brute_force(docs, edge_rows, rows, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_OF_ANCHOR", most)
    short = [(i, t) for i, t in edge_rows if len(t or "") < 20_000]
    every = rows + [(300 + i if i is not None else None, t) for i, t in short] + [rows[0], rows[0]]
    out = suffixes.removals(docs(every)).drop("removed").collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(every)


@pytest.mark.parametrize("most", [suffixes.MOST_OF_ANCHOR, 1])
@pytest.mark.parametrize("shared", [None, 5])
def test_rows_of_one_id_keep_what_only_others_repeat(docs, rows, monkeypatch, shared, most):
    """Different texts under one id, or under none: each loses what it repeats itself."""
    monkeypatch.setattr(suffixes, "MOST_OF_ANCHOR", most)
    clean = " ".join(f"only{i * i}" for i in range(60))
    source = " ".join(f"said{i * 7}" for i in range(60))
    every = [(1, source), (shared, clean), (shared, "x" + source[5:250]), (shared, source[:200] + "tail"), *((shared, t) for _, t in rows[:30])]
    out = suffixes.removals(docs(every)).drop("removed").collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(every)
    kept = hashlib.sha256(clean.encode()).hexdigest()
    assert [r.n_removed for r in out if r.kept_sha256 == kept] == [0]


def test_very_long_and_empty(docs, edge_rows):
    out = {r.doc_id: r for r in suffixes.removals(docs(edge_rows)).collect()}
    assert out[9].n_removed == 300_000 - 1 and out[9].n_spans == 1
    assert suffixes.removals(docs([])).count() == 0


def test_suffix_sort_equals_sorting_bytes():
    rng = random.Random(15)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(400)), dtype=np.uint8)
    starts = np.array([rng.randrange(390) for _ in range(150)])
    lengths = np.array([rng.randint(0, min(100, 400 - s)) for s in starts])
    suffix = suffixes.Suffixes(data, starts, lengths)
    order, common = suffix.sorted()
    pieces = [data[s : s + n].tobytes() for s, n in zip(starts, lengths)]
    assert [pieces[i] for i in order] == sorted(pieces)
    assert order.tolist() == sorted(range(len(pieces)), key=lambda i: (pieces[i], i))
    for k in range(1, len(order)):
        a, b = pieces[order[k - 1]], pieces[order[k]]
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_collisions_are_noticed():
    data = np.frombuffer(b"abcabdabcabd" * 9, dtype=np.uint8)
    starts, lengths = np.arange(0, 100, 3), np.full(34, 8)
    right = suffixes.Suffixes(data, starts, lengths)
    broken = suffixes.Suffixes(data, starts, lengths)
    broken.prefix = broken.prefix * np.uint64(0)  # every hash is equal
    pieces = [data[s : s + 8].tobytes() for s in starts]
    assert [pieces[i] for i in broken.sorted()[0]] == [pieces[i] for i in right.sorted()[0]] == sorted(pieces)
    assert broken.sorted()[1].tolist() == right.sorted()[1].tolist()


def test_windows_have_the_least_gram_as_anchor():
    data = ("abc" * 70 + "xyz" * 30).encode()
    texts = arrays.texts_of(pa.array([data.decode(), "", data.decode()[3:]]))
    hasher = arrays.Hasher()
    starts, anchors, grams = suffixes.windows(texts, hasher)
    every = hasher.spans(texts.data, np.arange(len(texts.data) - 31), np.arange(len(texts.data) - 31) + 32)
    assert len(starts) == 2 * 300 - 3 - 2 * (LENGTH - 1)
    for s, a, g in zip(starts, anchors, grams):
        own = every[s : s + LENGTH - 31]
        assert a == s + int(np.argmin(own)) and g == own.min()
